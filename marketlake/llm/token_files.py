"""Token ids in a binary format: ids ranked by frequency, byte-aligned codes of one to four bytes, control bytes apart.

A table of shards, written by Spark's Parquet writer so that any store that Spark reaches will do. A shard holds a run of
documents in ascending order of id, and these binary columns (all numbers little-endian):

- `ranks`: the shard's different ids as unsigned 32-bit integers, the most frequent first (ties: the smaller id first);
- `control`: a byte for each four tokens, two bits a token (the first in the lowest bits): bytes of its code less one;
- `codes`: of each token the place of its id in `ranks`, in as many bytes as it needs;
- `sizes`: tokens of each document as unsigned 32-bit integers; `keys`: the documents' ids in the same order.

A shard is closed as soon as it holds `shard_tokens` tokens, so a task holds one shard and one slice of texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.llm.common import text_slices
from marketlake.llm.pretokens import Pieces

#: For each control byte the lengths of its four codes.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def pack(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """ranks, control and codes of a shard's ids."""
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    used = np.flatnonzero(counts)
    ranks = used[np.argsort(-counts[used], kind="stable")]
    place = np.zeros(len(counts), np.uint32)
    place[ranks] = np.arange(len(ranks), dtype=np.uint32)
    code = place[ids] if len(ids) else np.zeros(0, np.uint32)
    size = 1 + (code > 0xFF).astype(np.uint8) + (code > 0xFFFF) + (code > 0xFFFFFF)
    fours = np.zeros(-len(code) % 4 + len(code), np.uint8)
    fours[: len(code)] = size - 1
    control = (fours.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    raw = code.astype("<u4").view(np.uint8).reshape(-1, 4)
    codes = raw[np.arange(4, dtype=np.uint8) < size[:, None]]
    return ranks.astype("<u4").tobytes(), control.tobytes(), codes.tobytes()


def unpack(ranks: bytes, control: bytes, codes: bytes, n: int) -> np.ndarray:
    """The n ids that `pack` was given; the lengths come from a table, the bytes by their offsets."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    offset = np.cumsum(size, dtype=np.int64) - size
    raw = np.frombuffer(codes, np.uint8)
    code = raw[offset].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        code[more] |= raw[offset[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return np.frombuffer(ranks, "<u4")[code]


class LibraryEncoder(Pieces):
    """Encodes with the tokenizers library: its model for words, all of it for pieces that are not plain."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        model = tokenizer.model
        super().__init__(
            path,
            lambda word: np.array([t.id for t in model.tokenize(word)], "<u4").tobytes(),
            lambda pieces: [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)],
        )


_ENCODERS: dict[str, LibraryEncoder] = {}

SHARD = "first_key {0}, task int, number int, n_ids long, ranks binary, control binary, codes binary, sizes binary, keys array<{0}>"


def write(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = 2_000_000) -> None:
    """Writes the shards of all rows to `path`.

    Documents are dealt out by ranges of id and sorted inside (nulls first; rows of one id by their text), so shards in
    the order of (first_key, task, number) hold the documents in ascending order. A null or empty text has the end id
    alone. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text")).repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions("key", F.xxhash64("text"), "text")
    rows = rows.select("key", "text", F.spark_partition_id().alias("task"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_file not in _ENCODERS:
            _ENCODERS[tokenizer_file] = LibraryEncoder(tokenizer_file)
        e = _ENCODERS[tokenizer_file]
        keys: list = []
        held: list[bytes] = []
        task = number = size = 0

        def shard() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            sizes = np.array([len(x) // 4 for x in held], "<u4").tobytes()
            cols = [[keys[0]], [task], [number], [len(ids)], *([x] for x in pack(ids)), [sizes], [keys]]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, (c[0] for c in cols), strict=True))], schema)

        schema = None
        for b in text_slices(batches, "text"):
            key_type = b.schema.field("key").type
            schema = pa.schema([("first_key", key_type), ("task", pa.int32()), ("number", pa.int32()), ("n_ids", pa.int64()), *((n, pa.binary()) for n in ("ranks", "control", "codes", "sizes")), ("keys", pa.list_(key_type))])
            task = b.column("task")[0].as_py()
            for key, coded in zip(b.column("key").to_pylist(), e.encode(b.column("text").to_pylist()), strict=True):
                keys.append(key)
                held.append(coded + end)
                size += len(coded) // 4 + 1
                if size >= shard_tokens:
                    yield shard()
                    keys, held, size, number = [], [], 0, number + 1
        if keys:
            yield shard()

    rows.mapInArrow(run, SHARD.format(kind)).write.mode("overwrite").option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files; what goes over the wire is a few numbers each."""
    shards = spark.read.parquet(path)
    kind = shards.schema["first_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in b.to_pylist():
                sizes = np.frombuffer(s["sizes"], "<u4").astype(np.int64)
                end = np.cumsum(sizes)
                ids = unpack(s["ranks"], s["control"], s["codes"], s["n_ids"]).astype("<u4").tobytes()
                crc = [zlib.crc32(ids[4 * (z - n) : 4 * z]) for z, n in zip(end.tolist(), sizes.tolist(), strict=True)]
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s["keys"], b.schema.field("first_key").type), pa.array([s["task"]] * n, pa.int32()), pa.array([s["number"]] * n, pa.int32()), pa.array(end - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                    ["doc_id", "task", "number", "inside", "n_tokens", "ids_crc32"],
                )

    docs = shards.mapInArrow(run, f"doc_id {kind}, task int, number int, inside long, n_tokens long, ids_crc32 long")
    # tokens before each shard: first of tasks, then of a task's shards; a row a task or shard, no blobs
    sums = shards.groupBy("task").agg(F.sum("n_ids").alias("n"))
    before = sums.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("of_tasks"))
    own = F.sum("n_ids").over(Window.partitionBy("task").orderBy("number")) - F.col("n_ids")
    base = shards.select("task", "number", own.alias("of_shards")).join(before, "task")
    return docs.join(base, ["task", "number"]).select("doc_id", (F.col("of_tasks") + F.col("of_shards") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every document in the files."""
    shards = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in b.to_pylist():
                ends = np.r_[0, np.cumsum(np.frombuffer(s["sizes"], "<u4").astype(np.int64))].astype(np.int32)
                ids = unpack(s["ranks"], s["control"], s["codes"], s["n_ids"]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(s["keys"], b.schema.field("first_key").type), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], ["doc_id", "ids"])

    return shards.mapInArrow(run, f"doc_id {shards.schema['first_key'].dataType.simpleString()}, ids array<int>")
