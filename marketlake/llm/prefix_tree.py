"""N-gram Jaccard join by prefix trees: documents link when their sets of word n-grams overlap enough.

All n-grams have one order: first those that are not frequent, by hash, then the frequent ones, the most frequent last. Two
sets that overlap enough share some of their first n-grams in that order (their heads), so documents meet under those,
passing over as many of the most shared ones as a head is longer than it must be. Under each, all hang on the smallest
document (the hub), and the documents of a hub, in chunks of bounded size, go into a prefix tree of their ordered heads,
and those whose heads leave hope into one of their whole sets. All documents of a chunk walk down the tree together: a node's overlap is counted once for all sets
below it, and a subtree is left as soon as what remains of the sets cannot make up the overlap that is needed, or all its
documents already hang together with the one that walks. Only links that join something leave a task.

Hubs of one chunk are complete. In larger ones documents that are joined already need no comparing: the others are
compared with all, in pairs of blocks. So copies in any number cost one document, near copies about one walk each, and
no link between different texts is lost to a limit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import chain
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import release, sieve, sift, text_slices, written
from marketlake.llm.components import components

#: Documents of a chunk, and n-grams of all its documents, at most (on average; chunks are filled by hash).
CHUNK, CHUNK_GRAMS = 256, 1_000_000
#: Frequent n-grams that are ordered by their frequency; the others' order is that of their hashes.
FREQUENT = 1 << 17
#: Counters of a task that looks for frequent n-grams; one in more than a thousandth of its documents is reported.
COUNTERS, SHARE = 1 << 20, 1000
#: A head is longer than it must be by one in SPARE of a set's n-grams; so many of its most shared n-grams are passed over.
SPARE = 20
#: Cells of the membership table that a walk uses at once.
CELLS = 1 << 24
#: Words whose hashes a task remembers.
MEMORY = 400_000

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_seen: dict[bytes, int] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def gram_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The set of each text as sorted 64-bit hashes of its n-grams. A-Z are lower-cased, words end at ASCII white space.

    A text of fewer words than `size` has one n-gram, all of it; one without words has none.
    """
    lists = [t.encode().lower().split() if t else [] for t in texts]
    fresh = set().union(*lists).difference(_seen)
    if len(_seen) + len(fresh) > MEMORY:
        _seen.clear()
        fresh = set().union(*lists)
    for w in fresh:
        _seen[w] = xxhash.xxh3_64_intdigest(w)
    sizes = [len(words) for words in lists]
    h = np.fromiter(map(_seen.__getitem__, chain.from_iterable(lists)), np.uint64, sum(sizes))
    whole = _grams(h, size) if len(h) >= size else h[:0]
    out, at = [], 0
    for n in sizes:
        out.append(np.unique(whole[at : at + n - size + 1]) if n >= size else _grams(h[at : at + n], n))
        at += n
    return out


def _grams(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words, from the words' hashes."""
    if not size:
        return h
    acc = np.full(len(h) - size + 1, size, np.uint64)
    for j in range(size):
        acc = _mix((acc + _MIX[0]) * _MIX[0] ^ h[j : len(h) - size + 1 + j])
    return acc


class Order:
    """The order of all n-grams: keys of frequent ones sorted by hash, with their rank."""

    def __init__(self, frequent: np.ndarray):
        """frequent: hashes, the least frequent first."""
        by = np.argsort(frequent)
        self.keys, self.rank = frequent[by], (by + 1).astype(np.int64)

    def ranks(self, grams: np.ndarray) -> np.ndarray:
        """0 for n-grams that are not frequent."""
        if not len(self.keys):
            return np.zeros(len(grams), np.int64)
        at = np.minimum(np.searchsorted(self.keys, grams), len(self.keys) - 1)
        return np.where(self.keys[at] == grams, self.rank[at], 0)

    def sort(self, grams: np.ndarray) -> np.ndarray:
        """Sorted hashes in the order of all n-grams."""
        return grams[np.argsort(self.ranks(grams), kind="stable")]


def needed(a: np.ndarray | int, b: np.ndarray | int, t: Fraction) -> np.ndarray | int:
    """Least overlap of linked sets of sizes a and b: t / (1 + t) of their sum, rounded up."""
    p, q = t.numerator, t.numerator + t.denominator
    return -((-p * (a + b)) // q)


def spare(n: int) -> int:
    """n-grams that a head has beyond the least; so many of a document's, those that most heads hold, need not be met under."""
    return n // SPARE


def prefix_size(n: int, t: Fraction) -> int:
    """Size of a head: linked sets share 1 + spare of their heads' n-grams; 0 if only an equal set can be linked."""
    least = ceil(t * n)
    return 0 if least == n and int(n / t) == n else min(n, n - least + 1 + spare(n))


def join(sets: list[np.ndarray], labels: list, order: Order, t: Fraction, whole: list[int] | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Pairs (i, j) of linked sets that join what hangs apart; sets of equal labels hang together from the start.

    With `whole` the sets are but heads (the first n-grams in order) of sets of those sizes. Then the second result tells
    of each set whether its head lets it link with any other: with an overlap so far, no more can follow than what
    remains beyond the n-grams that both heads cover.
    """
    heads = whole is not None
    grams, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    place = np.empty(len(grams), np.int64)
    place[np.argsort(order.ranks(grams), kind="stable")] = np.arange(len(grams))
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    rows = [np.sort(x) for x in np.split(place[inverse], cuts)]
    by = sorted(range(len(rows)), key=lambda i: rows[i].astype(">i8").tobytes())
    rows = [rows[i] for i in by]
    n = len(rows)
    size = np.array([len(r) for r in rows])
    full = np.array([whole[i] for i in by]) if heads else size
    reach = np.array([r[-1] for r in rows]) if heads else np.full(n, len(grams))  # how far a set is known
    alive = np.zeros(n, bool)
    first: dict = {}
    comp = np.array([first.setdefault(labels[i], k) for k, i in enumerate(by)])
    # how far neighbours in the sorted order run alike
    alike = np.zeros(n + 1, np.int64)
    for k in range(1, n):
        m = min(size[k - 1], size[k])
        differ = np.flatnonzero(rows[k - 1][:m] != rows[k][:m])
        alike[k] = differ[0] if len(differ) else m
    links: list[tuple[int, int]] = []
    step = max(1, CELLS // max(1, len(grams)))
    for at in range(0, n - 1, step):
        walkers = np.arange(at, min(n, at + step))
        member = np.zeros((len(grams), len(walkers)), bool)
        for k in walkers:
            member[rows[k], k - at] = True
        flat = np.concatenate([rows[k] + (k - at) * len(grams) for k in walkers])
        begin = np.r_[0, np.cumsum(size[walkers])]
        stack = [(0, n, 0, walkers, np.zeros(len(walkers), np.int64), np.zeros(len(walkers), np.int64))]
        while stack:
            lo, hi, depth, who, overlap, used = stack.pop()
            # each pair is met once: by the walker that sorts first
            stay = who < hi - 1
            if heads:
                if alive[lo:hi].all():
                    stay &= ~alive[who]
            elif (comp[lo:hi] == comp[lo]).all():
                stay &= comp[who] != comp[lo]
            who, overlap, used = who[stay], overlap[stay], used[stay]
            if not len(who):
                continue
            to = size[lo] if hi - lo == 1 else int(min(size[lo], alike[lo + 1 : hi].min()))
            if to > depth:
                segment = rows[lo][depth:to]
                overlap = overlap + member[np.ix_(segment, who - at)].sum(axis=0)
                used = used + np.searchsorted(segment, reach[who], side="right")
                own = full[who] - (np.searchsorted(flat, (who - at) * len(grams) + segment[-1], side="right") - begin[who - at])
            else:
                own = full[who] - overlap
            low, high = full[lo:hi].min(), full[lo:hi].max()
            most = overlap + np.minimum(own, high - used)
            stay = most >= needed(full[who], low, t)
            who, overlap, used, own = who[stay], overlap[stay], used[stay], own[stay]
            if not len(who):
                continue
            if size[lo] == to:
                met = (who < lo) & (overlap + np.minimum(own, full[lo] - used) >= needed(full[who], full[lo], t))
                if heads and met.any():
                    alive[lo] = True
                    alive[who[met]] = True
                for k in np.flatnonzero(met) if not heads else ():
                    if comp[who[k]] != comp[lo]:
                        links.append((by[who[k]], by[lo]))
                        comp[comp == comp[who[k]]] = comp[lo]
                lo += 1
            borders = [lo, *(np.flatnonzero(alike[lo + 1 : hi] == to) + lo + 1).tolist(), hi] if hi > lo else []
            stack.extend((a, b, to, who, overlap, used) for a, b in zip(borders[:-1], borders[1:], strict=True))
    found = np.zeros(n, bool)
    found[by] = alive
    return links, found


def _frequent(docs: DataFrame, size: int) -> np.ndarray:
    """Hashes of the most frequent n-grams, the least frequent first; FREQUENT at most reach the driver."""

    def merge(keys: np.ndarray, counts: np.ndarray, more: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        k, c = np.unique(np.concatenate(more), return_counts=True)
        seen = np.searchsorted(keys, k)
        hit = (keys[np.minimum(seen, len(keys) - 1)] == k) if len(keys) else np.zeros(len(k), bool)
        counts = counts.copy()
        counts[seen[hit]] += c[hit]
        both = np.insert(keys, seen[~hit], k[~hit])
        total = np.insert(counts, seen[~hit], c[~hit])
        if len(both) > COUNTERS:
            total -= np.partition(total, len(both) - COUNTERS)[len(both) - COUNTERS]
            both, total = both[total > 0], total[total > 0]
        return both, total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []
        docs_, grams = 0, 0
        for b in text_slices(batches, "text"):
            sets = gram_sets(b.column("text").to_pylist(), size)
            docs_ += len(sets)
            held += sets
            grams += sum(map(len, sets))
            if grams > COUNTERS:
                keys, counts = merge(keys, counts, held)
                held, grams = [], 0
        if held:
            keys, counts = merge(keys, counts, held)
        some = (counts * SHARE >= docs_) & (counts > 2)
        yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(counts[some])], ["gram", "n"])

    counted = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "gram").limit(FREQUENT).toPandas()
    return top["gram"].to_numpy(np.int64)[::-1].copy().view(np.uint64)


def linked(docs: DataFrame, size: int = 5, threshold: str = "4/5", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    Two documents link when |A and B| >= threshold * |A or B| over their sets of `size`-word n-grams; the component is the
    smallest id that links reach. A null or empty text, or one of white space, has no n-grams and links with nothing. A
    row without an id links with nothing and has no component. Rows of equal text are one node, named by their smallest
    id; other texts under the same smallest id are that node too.
    """
    t = Fraction(threshold)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(_frequent(rows, size))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(shared.value)
        for b in text_slices(batches, "text"):
            ids = b.column("doc_id")
            sets = gram_sets(b.column("text").to_pylist(), size)
            marks, heads = [], []
            for s, i in zip(sets, ids.to_pylist(), strict=True):
                whole = len(s) and i is not None
                marks.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if whole else None)
                k = prefix_size(len(s), t) if whole else 0
                heads.append(order.sort(s)[:k].view(np.int64) if k else s[:0].view(np.int64))
            ends = np.r_[0, np.cumsum([len(h) for h in heads])].astype(np.int32)
            grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(heads) if heads else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(marks, pa.binary()), grams], ["doc_id", "n", "mark", "head"])

    described = written(rows.mapInArrow(describe, f"doc_id {kind}, n long, mark binary, head array<long>"), "sets")
    # equal sets have equal heads: one row a set, copies are folded before the shuffle
    nodes = written(described.where("mark is not null").groupBy("mark").agg(F.min("doc_id").alias("node"), F.max("n").alias("whole"), F.first("head").alias("head")), "nodes")
    headed, described = described, written(described.select("doc_id", "n", "mark"), "marks")  # the heads are with the nodes now
    release(headed)
    heads = nodes.where("size(head) > 0").select(F.col("node").alias("of"), "whole", "head")
    own = heads.select(F.col("of").alias("node"), F.explode("head").alias("gram"))
    # a document is in a group for each shared n-gram of its head, but for the `spare` that most heads hold: linked sets
    # share one n-gram more than that, and the one that fewest heads hold stays on both sides
    hubs = own.groupBy("gram").agg(F.min("node").alias("hub"), F.max("node").alias("last"), F.count("*").alias("held")).where("hub < last").select("gram", "hub", "held")
    several = own.join(hubs, "gram").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("held", "gram", "hub"))).alias("g"))  # of one document
    # of several texts under one node the smallest decides how many are passed over
    kept = several.join(heads.groupBy("of").agg(F.min("whole").alias("whole")), F.col("node") == F.col("of")).withColumn("some", F.size("g") - F.floor(F.col("whole") / SPARE).cast("int")).where("some > 0")
    met = kept.select("node", F.col("whole").alias("n"), F.explode(F.array_distinct(F.transform(F.slice("g", 1, F.col("some")), lambda x: x["hub"]))).alias("hub")).groupBy("hub", "node").agg(F.max("n").alias("n"))
    met = written(met, "met")
    # a hub whose documents all hang on one smaller hub too, in one chunk, adds nothing: they are compared there
    counts = met.groupBy("hub").agg(F.count("*").alias("docs"), F.sum("n").alias("grams"))
    small = counts.where((F.col("docs") <= CHUNK) & (F.col("grams") <= CHUNK_GRAMS)).select(F.col("hub").alias("lead"))
    lead = met.groupBy("node").agg(F.min("hub").alias("lead"))
    idle = met.join(lead, "node").groupBy("hub").agg(F.min("lead").alias("lead"), F.max("lead").alias("last")).where("lead = last and lead < hub").join(small, "lead", "left_semi").select("hub")
    every_met, met = met, written(met.join(idle, "hub", "left_anti"), "groups")
    release(every_met)
    counts = met.groupBy("hub").agg(F.count("*").alias("docs"), F.sum("n").alias("grams"))
    chunks = counts.select("hub", F.greatest(F.ceil(F.col("docs") / CHUNK), F.ceil(F.col("grams") / CHUNK_GRAMS)).cast("int").alias("chunks"))
    # the hub goes into each of its chunks
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    one = F.array(F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    dealt = met.join(chunks, "hub").select("hub", "node", F.col("node").alias("label"), F.explode(F.when(F.col("node") == F.col("hub"), every).otherwise(one)).alias("part"), F.lit(0).alias("other"))

    def hopeful(dealt: DataFrame) -> DataFrame:
        """Of each group those that, by their heads, may link with another of it."""
        headed = sift(heads, "of", sieve(dealt, "node")).join(dealt, F.col("node") == F.col("of")).select("hub", "part", "other", "node", "label", "whole", "head")

        def group(table: pa.Table) -> pa.Table:
            alive = np.zeros(table.num_rows, bool)
            if table.num_rows > 1:
                column = table.column("head").combine_chunks()
                ends, flat = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
                sets = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                alive = join(sets, list(range(len(sets))), Order(shared.value), t, table.column("whole").to_pylist())[1]
            return table.select(["hub", "part", "other", "node", "label"]).filter(pa.array(alive))

        return headed.groupBy("hub", "part", "other").applyInArrow(group, f"hub {kind}, part int, other int, node {kind}, label {kind}")

    def settle(all_: DataFrame) -> DataFrame:
        """Links of groups; their table goes."""
        dealt = written(hopeful(all_).distinct(), "hopeful")
        release(all_)
        # texts that may be of use, each once however often its row repeats
        useful = sift(rows, "doc_id", sieve(dealt, "node")).dropDuplicates(["doc_id", "text"])
        texts = useful.join(dealt, F.col("node") == F.col("doc_id")).select("hub", "part", "other", "node", "label", "text")

        def group(table: pa.Table) -> pa.Table:
            order = Order(shared.value)
            ids, labels = table.column("node").to_pylist(), table.column("label").to_pylist()
            sets = gram_sets(table.column("text").to_pylist(), size)
            kept: dict[tuple, tuple] = {}
            for i, label, s in zip(ids, labels, sets, strict=True):
                if len(s):
                    kept.setdefault((i, s.tobytes()), (i, label, s))
            known = list(kept.values())
            pairs = join([s for *_, s in known], [label for _, label, _ in known], order, t)[0] if len(known) > 1 else []
            node_type = table.schema.field("node").type
            return pa.table({"a": pa.array([known[i][0] for i, _ in pairs], node_type), "b": pa.array([known[j][0] for _, j in pairs], node_type)})

        links = written(texts.groupBy("hub", "part", "other").applyInArrow(group, f"a {kind}, b {kind}"), "links")
        release(dealt)
        return links

    links = settle(written(dealt, "dealt"))
    joined = components(links)
    large = written(met.join(chunks.where("chunks > 1"), "hub").join(joined.withColumnRenamed("node", "n_"), F.col("node") == F.col("n_"), "left").select("hub", "node", "n", F.coalesce("component", "node").alias("label")), "large")
    release(met)
    rest = written(_apart(large), "dealt")
    if not rest.isEmpty():
        more = settle(rest)
        # what the first links joined is told by its stars
        joined = joined if more.isEmpty() else components(joined.toDF("a", "b").union(more))
    named = nodes.select("mark", "node").join(joined.withColumnRenamed("node", "n_"), F.col("node") == F.col("n_"), "left").select("mark", F.coalesce("component", "node").alias("c"))
    df = described.select("doc_id", "n", "mark").join(named, "mark", "left")
    return df.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id"))


def _apart(large: DataFrame) -> DataFrame:
    """Groups for what hangs apart in hubs of several chunks: all but the hub's largest component, against all."""
    parts = large.groupBy("hub", "label").agg(F.count("*").alias("docs"))
    main = parts.groupBy("hub").agg(F.max_by("label", F.struct("docs", "label")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("hub", "main")
    sided = large.join(main, "hub").withColumn("apart", (F.col("label") != F.col("main")).cast("int")).drop("main")
    blocks = lambda cond: F.greatest(F.lit(1), F.ceil(F.sum(F.when(cond, 1).otherwise(0)) / (CHUNK / 2)), F.ceil(F.sum(F.when(cond, F.col("n")).otherwise(0)) / (CHUNK_GRAMS / 2))).cast("int")
    sizes = sided.groupBy("hub").agg(blocks(F.col("apart") == 1).alias("few"), blocks(F.col("apart") == 0).alias("many"))
    placed = sided.join(sizes, "hub").withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.when(F.col("apart") == 1, F.col("few")).otherwise(F.col("many"))).cast("int"))
    # a group is a block of those apart (part) with another of them (other >= 0) or one of the main component (other < 0)
    pair = lambda j: F.struct(F.least("block", j).alias("part"), F.greatest("block", j).alias("other"))
    mine = F.concat(F.transform(F.sequence(F.lit(0), F.col("few") - 1), pair), F.transform(F.sequence(F.lit(1), F.col("many")), lambda j: F.struct(F.col("block").alias("part"), (-j).alias("other"))))
    theirs = F.transform(F.sequence(F.lit(0), F.col("few") - 1), lambda i: F.struct(i.alias("part"), (-F.col("block") - 1).alias("other")))
    return placed.select("hub", "node", "label", F.explode(F.when(F.col("apart") == 1, mine).otherwise(theirs)).alias("g")).select("hub", "node", "label", "g.part", "g.other")


def keep_one(docs: DataFrame, size: int = 5, threshold: str = "4/5") -> DataFrame:
    """One row of each group of linked documents: that of the smallest id. Columns stay as they are.

    Rows that link with nothing all stay, those without an id among them. Of rows that repeat an id that stays, with
    n-grams, one stays.
    """
    found = linked(docs, size, threshold).where("doc_id is not null")
    own = F.col("doc_id") == F.col("component_id")
    ids = found.groupBy(F.col("doc_id").alias("id")).agg(F.count(F.when(own, 1)).alias("times"), F.max(F.when(own, F.col("n_shingles"))).alias("n"))
    ids = written(ids.where("times = 0 or (times > 1 and n > 0)").select("id", (F.col("times") == 0).alias("leaves")), "leave")
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("key"))
    # texts that surely are not among these stay where they are; of the others, few as a rule, each is looked up
    told = sieve(ids, "id")
    looked = sift(packed, "key", told).join(ids, F.col("key") == F.col("id"), "left").where("leaves is null or not leaves")
    looked = written(looked.select("row", "key", F.col("leaves").isNotNull().alias("again")), "looked-up")
    kept = sift(packed, "key", told, out=True).select("row").unionByName(looked.where("not again").select("row"))
    return kept.unionByName(looked.where("again").dropDuplicates(["key"]).select("row")).select("row.*")
