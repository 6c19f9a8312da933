"""Ranked lexical search: an inverted index of compressed blocks with maximum impacts, searched by Block-Max WAND.

The index is a table. A shard is some megabytes of documents; each of its terms is a row with the term's postings in blocks of
BLOCK documents. A block holds document gaps and occurrences in one, two or four bytes each; beside it stand its last document
and its largest impact, so that a search passes over blocks without opening them. Another row holds the shard's ids and lengths.

A search takes a block of queries and goes through shards side by side. Short lists (a block, or less than a document in 32) are
opened; their documents are the first pivots. For the long lists come shallow moves: between two block ends the sum of the
weighted maxima bounds what they add to any document. Pivots, then whole stretches between block ends, are taken by falling
bound, a few at first and then twice as many each time; once a bound is below the k-th score so far, nothing that is left can
be a result and its blocks are never opened. The classic walk moves one pivot at a time; this one weighs all of them at once,
with the same bounds. Scores are exact integers and equal scores go by ascending id, so nothing depends on the shards.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from marketlake.llm.common import text_slices, written

#: A term: letters and digits of ASCII (A-Z as a-z) and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = 128
#: Bytes of text of a shard, about; a longer document is a shard of its own.
SHARD_BYTES = 8 << 20
#: Bytes of the terms of a block of queries, about: what the driver and each task hold of the queries. A longer query is a block of its own.
QUERY_BYTES = 4 << 20
#: What a search reads of a block before opening it: last document, largest impact, end of its bytes, bytes of a gap and of a count.
SKIP = np.dtype([("last", "<i4"), ("impact", "<i4"), ("end", "<i4"), ("gap", "u1"), ("tf", "u1")])


def terms(text: Column) -> Column:
    """All terms of a text in order; none for null."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({TERM})"), F.lit(1)), F.array().cast("array<string>"))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def length_term(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """100 - 90 + (90 n N) div L."""
    if len(n) and 90 * int(n.max()) * n_docs >= 1 << 63:
        return np.array([10 + 90 * int(x) * n_docs // n_terms for x in n], np.int64)
    return 10 + 90 * n * n_docs // max(n_terms, 1)


def pack(doc: np.ndarray, tf: np.ndarray, m: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of lists that lie one after another (list i begins at starts[i]): skips, first block of each list, bytes, first byte of each list."""
    sizes = np.diff(np.r_[starts, len(doc)])
    of = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(len(doc)) - starts[of]
    gaps = np.diff(doc, prepend=-1)
    gaps[starts] = doc[starts] + 1
    heads = np.flatnonzero(place % BLOCK == 0)
    counts = np.diff(np.r_[heads, len(doc)])
    block = np.repeat(np.arange(len(heads)), counts)
    width = lambda x: np.select([(top := np.maximum.reduceat(x, heads)) < 1 << 8, top < 1 << 16], [1, 2], 4)
    wide = {"gap": width(gaps), "tf": width(tf)}
    bytes_ = counts * (wide["gap"] + wide["tf"])
    begin = np.r_[0, np.cumsum(bytes_)]
    out = np.zeros(begin[-1], np.uint8)
    inside = np.arange(len(doc)) - heads[block]
    for name, values, skip in (("gap", gaps, np.zeros(len(heads), np.int64)), ("tf", tf, counts * wide["gap"])):
        w = wide[name]
        at = (begin[:-1] + skip)[block] + inside * w[block]
        for k in range(4):
            here = w[block] > k
            out[at[here] + k] = (values[here] >> 8 * k) & 255
    first_block = np.searchsorted(heads, starts)
    first_byte = begin[first_block]
    skips = np.zeros(len(heads), SKIP)
    skips["last"] = doc[heads + counts - 1]
    skips["impact"] = np.maximum.reduceat(impact(tf, m[doc]), heads)
    skips["end"] = begin[1:] - np.repeat(first_byte, np.diff(np.r_[first_block, len(heads)]))
    skips["gap"], skips["tf"] = wide["gap"], wide["tf"]
    return skips, first_block, out, first_byte


class Postings:
    """A list of a shard; blocks are opened when a search needs them and then kept."""

    def __init__(self, df: int, skips: bytes, data: bytes, m: np.ndarray):
        self.skips, self.data, self.m = np.frombuffer(skips, SKIP), np.frombuffer(data, np.uint8), m
        self.last, self.most = self.skips["last"], self.skips["impact"].astype(np.int64)
        self.docs, self.impacts, self.open = np.empty(df, np.int64), np.empty(df, np.int64), np.zeros(len(self.skips), bool)

    def read(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks, given in ascending order."""
        for b in blocks[~self.open[blocks]]:
            skip, n, at = self.skips[b], min(BLOCK, len(self.docs) - b * BLOCK), int(self.skips["end"][b - 1]) if b else 0
            mid, end = at + n * int(skip["gap"]), int(skip["end"])
            gaps, tf = (self.data[x:y].view(f"<u{w}").astype(np.int64) for x, y, w in ((at, mid, skip["gap"]), (mid, end, skip["tf"])))
            here = slice(b * BLOCK, b * BLOCK + n)
            self.docs[here] = np.cumsum(gaps) + (int(self.last[b - 1]) if b else -1)
            self.impacts[here] = impact(tf, self.m[self.docs[here]])
            self.open[b] = True
        if len(blocks) == len(self.open):
            return self.docs, self.impacts
        at = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        at = at[at < len(self.docs)]
        return self.docs[at], self.impacts[at]


def best(lists: Sequence[tuple[int, Postings]], n_docs: int, k: int) -> list[tuple[int, int]]:
    """The k documents (number, score) of highest score above 0, given (weight, list); equal scores by ascending number."""
    lists = [(w, p) for w, p in lists if w > 0]
    if not lists:
        return []
    few = max(BLOCK, n_docs >> 5)
    score_of_few = np.zeros(n_docs, np.int64)
    for w, p in lists:
        if len(p.docs) <= few:
            docs, impacts = p.read(np.arange(len(p.open)))
            score_of_few[docs] += w * impacts
    points = np.flatnonzero(score_of_few)
    lists = [(w, p) for w, p in lists if len(p.docs) > few]
    top = np.zeros((0, 2), np.int64)

    def keep(found: np.ndarray, scores: np.ndarray) -> np.ndarray:
        if len(found) > k:
            near = scores >= np.partition(scores, -k)[-k]
            found, scores = found[near], scores[near]
        both = np.concatenate([top, np.stack([found, scores], axis=1)])
        both = both[np.unique(both[:, 0], return_index=True)[1]]
        return both[np.lexsort((both[:, 0], -both[:, 1]))][:k]

    if not lists:
        return [(int(d), int(s)) for d, s in keep(points, score_of_few[points])]
    ends = np.unique(np.concatenate([p.last for _, p in lists]))
    where = [np.searchsorted(p.last, ends) for _, p in lists]
    bound = np.zeros(len(ends) + 1, np.int64)  # the last: behind all blocks
    for (w, p), at in zip(lists, where, strict=True):
        bound[:-1] += np.where(at < len(p.last), w * p.most[np.minimum(at, len(p.last) - 1)], 0)
    begins = np.r_[0, ends[:-1] + 1]
    stretch = np.searchsorted(ends, points)
    # documents of short lists one by one, then whole stretches, each by falling bound
    for bounds, of in ((score_of_few[points] + bound[stretch], stretch), (bound[:-1], np.arange(len(ends)))):
        order = np.argsort(-bounds, kind="stable")
        done, step = 0, max(8, 2 * k)
        while done < len(order) and (len(top) < k or bounds[order[done]] >= top[-1, 1]):  # an equal bound may hide a smaller id
            take = order[done : done + step]
            done, step = done + step, 2 * step
            if len(top) == k:
                take = take[bounds[take] >= top[-1, 1]]
            active = np.zeros(n_docs + 1, np.int64)
            if of is stretch:
                active[points[take]] = 1
            else:
                np.add.at(active, begins[take], 1)
                np.add.at(active, ends[take] + 1, -1)
                active = np.cumsum(active)
            opened = np.unique(of[take])
            opened = opened[opened < len(ends)]
            score = score_of_few.copy()
            for (w, p), at in zip(lists, where, strict=True):
                blocks = np.unique(at[opened])
                docs, impacts = p.read(blocks[blocks < len(p.last)])
                score[docs] += w * impacts
            found = np.flatnonzero((active[:-1] > 0) & (score > 0))
            top = keep(found, score[found])
    return [(int(d), int(s)) for d, s in top]


class Index:
    """A written index: rows (shard, term, df, skips, blocks), and one row a shard with its ids and lengths, of null term."""

    def __init__(self, rows: DataFrame, n_docs: int, n_terms: int):
        self.rows, self.n_docs, self.n_terms = rows, n_docs, n_terms


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> Index:
    """Indexes whole texts of all rows that hold a term; each row is a document, rows of equal id too. One narrow pass after that for the totals."""
    own = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where("text is not null")
    n = F.regexp_count("text", F.lit(TERM))
    totals = own.select(n.cast("long").alias("n")).agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = totals["docs"], totals["terms"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        from pyspark import TaskContext

        find = re.compile(rb"[0-9A-Za-z\x80-\xff]+").findall
        number = TaskContext.get().partitionId() << 32
        for b in text_slices(batches, "text", shard_bytes):
            b = b.take(pc.sort_indices(b.column("id"), null_placement="at_start"))  # numbers inside a shard ascend with the ids
            seen: dict[bytes, int] = {}
            found, sizes, keep = [], [], []
            for i, text in enumerate(b.column("text").cast(pa.binary())):
                words = find(text.as_py().lower())
                if words:
                    keep.append(i)
                    sizes.append(len(words))
                    found.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)))
            if not keep:
                continue
            names = sorted(seen)
            rank = np.empty(len(names), np.int64)
            rank[[seen[w] for w in names]] = np.arange(len(names))
            width, n = len(keep), np.array(sizes, np.int64)
            key, tf = np.unique(rank[np.concatenate(found)] * width + np.repeat(np.arange(width), n), return_counts=True)
            doc, m = key % width, length_term(n, n_docs, n_terms)
            starts = np.searchsorted(key, np.arange(len(names)) * width)
            skips, first_block, data, first_byte = pack(doc, tf.astype(np.int64), m, starts)
            cut = lambda raw, at, unit: pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.r_[at * unit, len(raw) * unit].astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])
            ids, kind = b.column("id").take(pa.array(keep)), b.schema.field("id").type
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([None], pa.string()), pa.array([width], pa.int32()), pa.array([None], pa.binary()), pa.array([m.astype("<i8").tobytes()]), pa.ListArray.from_arrays(pa.array([0, width], pa.int32()), ids)], list(COLUMNS))
            df = np.diff(np.r_[starts, len(doc)]).astype(np.int32)
            text = pa.array([w.decode("utf-8", "replace") for w in names], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(names), number)), text, pa.array(df), cut(skips, first_block, SKIP.itemsize), cut(data, first_byte, 1), pa.nulls(len(names), pa.list_(kind))], list(COLUMNS))
            number += 1

    schema = f"shard long, term string, df int, skips binary, blocks binary, ids array<{own.schema['id'].dataType.simpleString()}>"
    return Index(written(own.mapInArrow(run, schema), "block-max"), n_docs, n_terms)


COLUMNS = ("shard", "term", "df", "skips", "blocks", "ids")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(index: Index, queries: DataFrame, k: int = 10, query_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """query_col, rank, doc_id, score: the k documents of highest score above 0 for each query, fewer if there are no more.

    A query's terms count once; rows of equal query id (null is one too) are one query with the terms of all. Null and empty
    texts have no terms and no results. Queries are taken in blocks of about QUERY_TERMS terms, each against all shards.
    """
    asked = written(queries.select(queries[query_col].alias("item"), F.explode(terms(queries[text_col])).alias("term")).distinct(), "queries")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // QUERY_BYTES))
    shards = index.rows.where("term is null").count()
    hits = None
    for b in range(blocks):
        found = _search_block(index, asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), shards, k)
        hits = found if hits is None else hits.unionByName(found)
    w = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(F.col("item").alias(query_col), "rank", "doc_id", "score")


def _search_block(index: Index, asked: DataFrame, shards: int, k: int) -> DataFrame:
    """item, doc_id, score: the k best documents of each shard for a block of queries (item, term)."""
    names = asked.select("term").distinct()  # QUERY_BYTES bounds it
    lists = index.rows.where("term is not null").join(F.broadcast(names), "term", "left_semi")
    weights = {r["term"]: weight(index.n_docs, r["df"]) for r in lists.groupBy("term").agg(F.sum("df").alias("df")).collect()}  # a row a term of the block
    items: dict[object, list[str]] = {}
    for r in asked.collect():
        items.setdefault(r["item"], []).append(r["term"])
    shared = asked.sparkSession.sparkContext.broadcast((items, weights))
    kind = to_arrow_type(asked.schema["item"].dataType)

    def run(shard: pa.Table) -> pa.Table:
        items, weights = shared.value
        is_head = pc.is_null(shard["term"])
        head, rows = shard.filter(is_head), shard.filter(pc.invert(is_head))
        ids, m = head["ids"].combine_chunks().flatten(), np.frombuffer(head["blocks"][0].as_py(), "<i8")
        lists = {t: (weights[t], Postings(n, s, d, m)) for t, n, s, d in zip(*(rows[c].to_pylist() for c in ("term", "df", "skips", "blocks")), strict=True)}
        found = [(item, *hit) for item, names in items.items() for hit in best([lists[t] for t in names if t in lists], len(m), k)]
        who, at, scores = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"item": pa.array(who, kind), "doc_id": ids.take(pa.array(at, pa.int64())), "score": pa.array(scores, pa.int64())})

    element = index.rows.schema["ids"].dataType.elementType.simpleString()
    rows = lists.unionByName(index.rows.where("term is null")).repartition(max(1, min(shards, 1 << 14)), "shard")
    return rows.groupBy("shard").applyInArrow(run, f"item {asked.schema['item'].dataType.simpleString()}, doc_id {element}, score long")


def report(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: `search` over an index of all documents. An empty table on either side gives no rows."""
    return search(build(docs), queries, k)
