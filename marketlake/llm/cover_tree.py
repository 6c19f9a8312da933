"""Near-duplicate vectors: dual traversal of cover trees, exact pairs above a cosine.

Vectors are scaled to length 1, so a cosine of at least c is a distance of at most sqrt(2 - 2c). Equal vectors of a label
become one class first. Each label's classes are cut into blocks of bounded size along a tree of cells (the sides of fixed
random planes), as deep as the label needs; a block is a row with its vectors, and a top node of a cover tree: a centre and
a covering radius. Pairs of blocks whose balls are too far apart are pruned in Spark; for each other pair a task builds the
two trees (nested levels, radii halving) and walks them together: pairs of nodes too far apart for their covering radii are
pruned, and where no more levels gather anything the vectors are compared by matrix products in double precision. A task
gives each class its number of links and the links that join its classes, never all pairs.

Vectors without any structure (all about equally far apart) leave nothing to prune: all blocks of a label are then compared,
which is a square of the label's blocks. Blocks are large so that its constant is small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from marketlake.llm.common import release, written
from marketlake.llm.components import components

#: Classes of a block (twice as many at most, where cells are not all alike), planes that cells are told apart by.
BLOCK, PLANES = 16_384, 16
#: Candidates for centres that are looked at together; products that a walk holds at once.
BATCH, CELLS = 256, 1 << 22
#: Radii of the levels below a block's root.
RADII = (1.0, 0.5, 0.25, 0.125, 0.0625)
#: What rounding may add to a distance.
SLACK = 1e-6


class Tree:
    """A cover tree over rows of unit vectors, a level after the other.

    Level k holds centres; `children[k]` gives those one level down, `reach[k]` the largest distance from a centre to a
    vector below it. The last level is the vectors themselves. A level that gathers too little is left out.
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        self.levels: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.reach: list[np.ndarray] = [np.array([self._far(x, x[:1])])]
        self.children: list[list[np.ndarray]] = []
        place = np.zeros(len(x), np.int64)  # each vector's node on the level above
        for radius in RADII:
            made = self._level(place, radius)
            if made is None:  # nothing gathers: the vectors come next
                break
            centres, own, above = made
            reach = np.zeros(len(centres))
            d = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", x, x[centres[own]])))
            np.maximum.at(reach, own, d)
            self.children.append(self._split(above, len(self.levels[-1])))
            self.levels.append(centres)
            self.reach.append(reach)
            place = own
        self.children.append(self._split(place, len(self.levels[-1])))
        self.levels.append(np.arange(len(x)))
        self.reach.append(np.zeros(len(x)))

    @staticmethod
    def _split(place: np.ndarray, n: int) -> list[np.ndarray]:
        order = np.argsort(place, kind="stable")
        return np.split(order, np.searchsorted(place[order], np.arange(1, n)))

    def _level(self, place: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Centres that cover all vectors within the radius, each vector's centre, and each centre's node one level up."""
        x, least = self.x, 1 - radius * radius / 2  # of the product
        centres: list[int] = []
        own = np.full(len(x), -1, np.int64)
        covered = 0
        for node in range(len(self.levels[-1])):
            left = np.flatnonzero(place == node)
            while len(left):
                first = left[:BATCH]
                near = x[first] @ x[first].T >= least
                free = np.ones(len(first), bool)  # centres of this batch: the first of those that lie near one another
                taken = []
                for i in range(len(first)):
                    if free[i]:
                        taken.append(i)
                        free &= ~near[i]
                new = first[taken]
                for at in range(0, len(left), CELLS // BATCH):
                    part = left[at : at + CELLS // BATCH]
                    dot = x[part] @ x[new].T
                    best = dot.argmax(axis=1)
                    hit = dot[np.arange(len(part)), best] >= least
                    own[part[hit]] = len(centres) + best[hit]
                own[new] = len(centres) + np.arange(len(new))
                centres.extend(new.tolist())
                rest = left[own[left] < 0]
                covered += len(left) - len(rest)
                left = rest
                if len(centres) > max(BATCH // 2, covered // 2):
                    return None
        if len(centres) > len(x) // 2:
            return None
        at = np.array(centres, np.int64)
        return at, own, place[at]

    @staticmethod
    def _far(x: np.ndarray, c: np.ndarray) -> float:
        return float(np.sqrt(np.maximum(0, 2 - 2 * (x @ c[0]))).max())

    def below(self, level: int, node: int) -> np.ndarray:
        return self.children[level][node]


def traverse(a: Tree, b: Tree, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of a, row of b) with a cosine of at least the threshold; both trees walked down together."""
    limit = np.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    stack = [(0, np.zeros(1, np.int64), 0, np.zeros(1, np.int64))]
    while stack:
        la, na, lb, nb = stack.pop()
        if len(na) * len(nb) > CELLS:  # in parts
            if len(na) >= len(nb):
                stack.extend((la, part, lb, nb) for part in np.array_split(na, 2))
            else:
                stack.extend((la, na, lb, part) for part in np.array_split(nb, 2))
            continue
        dot = a.x[a.levels[la][na]] @ b.x[b.levels[lb][nb]].T
        if la == len(a.levels) - 1 and lb == len(b.levels) - 1:
            i, j = np.nonzero(dot >= cosine)
            if len(i):
                yield na[i], nb[j]
            continue
        # nodes farther apart than the limit and both their reaches have no pair below them
        near = np.sqrt(np.maximum(0, 2 - 2 * dot)) <= limit + a.reach[la][na][:, None] + b.reach[lb][nb][None, :]
        down_a = la < len(a.levels) - 1 and (lb == len(b.levels) - 1 or la <= lb)
        if down_a:
            for k in np.flatnonzero(near.any(axis=1)):
                stack.append((la + 1, a.below(la, int(na[k])), lb, nb[near[k]]))
        else:
            for k in np.flatnonzero(near.any(axis=0)):
                stack.append((la, na[near[:, k]], lb + 1, b.below(lb, int(nb[k]))))


def find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = int(parent[i])
    return i


def settle(xa: np.ndarray, na: np.ndarray, xb: np.ndarray | None, nb: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links of each row of a and of b (copies counted), and joining links (i, j) over a's rows followed by b's."""
    a = Tree(xa)
    same = xb is None
    b = a if same else Tree(xb)
    nb = na if same else nb
    la, lb = np.zeros(len(xa), np.int64), np.zeros(len(b.x), np.int64)
    shift = 0 if same else len(xa)
    parent = np.arange(shift + len(b.x))
    joins: list[tuple[int, int]] = []
    for i, j in traverse(a, b, cosine):
        if same:
            other = i != j
            i, j = i[other], j[other]
        la += np.bincount(i, nb[j], len(la)).astype(np.int64)
        if not same:
            lb += np.bincount(j, na[i], len(lb)).astype(np.int64)
        for p, q in zip(i.tolist(), (j + shift).tolist(), strict=True) if len(i) < 4096 else _thin(i, j + shift):
            rp, rq = find(parent, p), find(parent, q)
            if rp != rq:
                parent[max(rp, rq)] = min(rp, rq)
                joins.append((p, q))
    return la, lb, joins


def _thin(i: np.ndarray, j: np.ndarray) -> Iterator[tuple[int, int]]:
    """Of many links those that join: a spanning forest."""
    n = int(max(i.max(), j.max())) + 1
    label = np.arange(n)
    while True:  # hand the smaller label along the links until nothing changes
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    used = np.unique(np.r_[i, j])
    yield from ((int(x), int(label[x])) for x in used if label[x] != x)


def near_duplicates(rows: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Vectors are compared only under one label that is not null. A vector that is null, empty, zero, or holds a null or a
    number that is not finite links with nothing; so does a row without an id (its component is null and it is not kept).
    Equal vectors link with one another. Rows that share an id are counted as vectors of their own, in one component if they link.
    """
    v = F.col("v")
    single = rows.schema[vector_col].dataType.simpleString() == "array<float>"
    base = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("raw"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    inf = F.lit(float("inf"))
    usable = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == inf)) & F.exists(v, lambda x: x != 0)
    # a class: one label, one direction as the numbers stand (-0 is 0)
    key = F.md5(F.concat_ws(",", F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x).cast("string"))))
    base = base.withColumn("class", F.when(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(usable, F.lit(False)), F.concat_ws(":", F.col("label").cast("string"), F.size(v).cast("string"), key)))
    base = written(base.withColumn("v", F.col("raw").cast("array<float>" if single else "array<double>")).drop("raw"), "vectors")
    classes = base.where("class is not null").groupBy("class").agg(F.min("label").alias("label"), F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.any_value("v").alias("v"))
    classes = written(_coded(classes.withColumn("dim", F.size("v"))), "classes")

    blocks, paired = _blocks(classes, cosine, block, "<f4" if single else "<f8")
    found = written(_settled(blocks, paired, cosine, "<f4" if single else "<f8"), "links")
    release(blocks, paired)
    links = found.where("other is null").groupBy("class").agg(F.sum("links").alias("links"))
    # classes of one id are one node
    joined = components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    per = classes.select("class", "node", "copies").join(links, "class", "left").join(joined.withColumnRenamed("node", "n_"), F.col("node") == F.col("n_"), "left")
    per = per.select("class", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "node").alias("c"))
    df = base.select("vec_id", "class").join(per, "class", "left")
    component = F.coalesce("c", "vec_id")
    return df.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _coded(classes: DataFrame) -> DataFrame:
    """Adds `code`: on which side of each plane a vector lies, a bit each. The planes depend on nothing but the dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("v")
            dims = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            start = np.cumsum(dims) - dims
            code = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                x = flat[start[rows][:, None] + np.arange(dim)]
                planes = np.random.default_rng(dim).normal(size=(dim, PLANES))
                code[rows] = (x @ planes > 0) @ (1 << np.arange(PLANES))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(code.astype(np.int32))], [*b.schema.names, "code"])

    return classes.mapInArrow(run, StructType([*classes.schema, StructField("code", IntegerType())]))


def _blocks(classes: DataFrame, cosine: float, block: int, kind: str) -> tuple[DataFrame, DataFrame]:
    """A row for each block with what lies in it, and the pairs of blocks that may hold links."""
    # cells of a label in order of their codes go into blocks until these are full; a cell larger than a block is dealt out
    cells = classes.groupBy("label", "dim", "code").agg(F.count("*").alias("n"))
    w = Window.partitionBy("label", "dim").orderBy("code")  # 2 ** PLANES rows at most
    cells = cells.withColumn("number", F.floor((F.sum("n").over(w) - F.col("n")) / block)).withColumn("subs", F.ceil(F.col("n") / block).cast("int"))
    cells = cells.select("label", "dim", "code", "subs", F.concat_ws("/", F.col("label").cast("string"), "dim", "number", F.when(F.col("subs") > 1, F.col("code"))).alias("of"))
    placed = classes.join(cells, ["label", "dim", "code"])
    placed = placed.select("label", "dim", F.concat_ws("/", "of", F.pmod(F.xxhash64("class"), F.col("subs"))).alias("block"), "class", "node", "copies", "v")
    types = {c: classes.schema[c].dataType.simpleString() for c in ("label", "node")}

    def pack(t: pa.Table) -> pa.Table:
        raw = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1).astype(kind)
        x = unit(raw)
        mean = x.mean(axis=0)
        centre = mean / max(1e-12, float(np.sqrt(mean @ mean)))
        reach = float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))
        one = {c: [t.column(c)[0].as_py()] for c in ("label", "dim", "block")} | {c: [t.column(c).to_pylist()] for c in ("class", "node", "copies")}
        return pa.Table.from_pydict(one | {"vectors": [raw.tobytes()], "centre": [centre.tolist()], "reach": [reach]}, made)

    field = lambda c: classes_arrow[c]
    classes_arrow = {f.name: f.type for f in _arrow(classes.select("label", "node"))}
    made = pa.schema([("label", field("label")), ("dim", pa.int32()), ("block", pa.string()), ("class", pa.list_(pa.string())), ("node", pa.list_(field("node"))), ("copies", pa.list_(pa.int64())), ("vectors", pa.binary()), ("centre", pa.list_(pa.float64())), ("reach", pa.float64())])
    schema = f"label {types['label']}, dim int, block string, class array<string>, node array<{types['node']}>, copies array<long>, vectors binary, centre array<double>, reach double"
    blocks = written(placed.groupBy("block").applyInArrow(pack, schema), "blocks")
    balls = blocks.select("label", "dim", "block", "centre", "reach")
    limit = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + SLACK
    gap = F.expr("sqrt(aggregate(zip_with(a.centre, b.centre, (x, y) -> (x - y) * (x - y)), 0D, (s, z) -> s + z))")
    a, b = balls.alias("a"), balls.alias("b")
    near = (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim")) & (F.col("a.block") <= F.col("b.block"))
    paired = a.join(b, near & (gap <= F.col("a.reach") + F.col("b.reach") + limit)).select(F.col("a.block").alias("left"), F.col("b.block").alias("right"))
    return blocks, written(paired, "pairs")


def _arrow(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision; the largest component is taken out first, so no square overflows."""
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _settled(blocks: DataFrame, paired: DataFrame, cosine: float, kind: str) -> DataFrame:
    """Rows (class, links) and rows (node, other) of each pair of blocks."""
    node_kind = blocks.schema["node"].dataType.elementType.simpleString()
    cols = ["class", "node", "copies", "vectors", "dim"]
    one = paired.join(blocks, F.col("left") == F.col("block")).select("left", "right", F.lit(0).alias("side"), *cols)
    two = paired.where("left <> right").join(blocks, F.col("right") == F.col("block")).select("left", "right", F.lit(1).alias("side"), *cols)

    def work(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["side"])
        x = [unit(np.frombuffer(r["vectors"], kind).reshape(-1, r["dim"])) for r in rows]
        copies = [np.array(r["copies"], np.int64) for r in rows]
        names = np.concatenate([np.array(r["class"], object) for r in rows])
        nodes = [n for r in rows for n in r["node"]]
        if len(rows) == 1:
            count, _, joins = settle(x[0], copies[0], None, None, cosine)
        else:
            la, lb, joins = settle(x[0], copies[0], x[1], copies[1], cosine)
            count = np.r_[la, lb]
        some = np.flatnonzero(count)
        node_type = t.schema.field("node").type.value_type
        none = pa.nulls(len(some), node_type)
        counts = pa.table([pa.array(names[some].tolist(), pa.string()), pa.array(count[some]), none, none], ["class", "links", "node", "other"])
        ends = [pa.array([nodes[p[k]] for p in joins], node_type) for k in (0, 1)]
        return pa.concat_tables([counts, pa.table([pa.nulls(len(joins), pa.string()), pa.nulls(len(joins), pa.int64()), *ends], ["class", "links", "node", "other"])])

    return one.union(two).groupBy("left", "right").applyInArrow(work, f"class string, links long, node {node_kind}, other {node_kind}")
