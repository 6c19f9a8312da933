"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a Python task handles at a time.
SLICE_BYTES = 4 << 20
#: Bits of a sieve (a power of two): a table of at most SIEVE / PAGE rows of PAGE bits each, however many keys go in.
SIEVE, PAGE = 1 << 24, 1 << 12
#: Spark's setting by which a query's shuffle files are deleted when it ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new local one where that is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """Cuts the lineage: writes df as a table in the shared folder and reads it back, so a lost executor costs no rerun.

    The write's shuffle files go as soon as the table stands: executors hold those of one step at a time.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)
    back = spark.read.schema(df.schema).parquet(path)
    _PLACES[id(back)] = (weakref.ref(back), path)
    return back


_PLACES: dict[int, tuple[weakref.ref, str]] = {}


def release(*tables: DataFrame) -> None:
    """Deletes tables that `written` made, once all that was made from them is written itself."""
    for df in tables:
        ref, path = _PLACES.pop(id(df), (None, ""))
        if ref is not None and ref() is df:
            jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def sieve(keys: DataFrame, column: str) -> DataFrame:
    """sieve_page, sieve_words: a bit for the hash of each key. Bounded in size, so it may be broadcast; `sift` tells keys by it.

    A row is a page of 64 words, so the driver, which holds all rows and a hash table of them, needs little more than the bits.
    """
    bit = F.pmod(F.xxhash64(column), F.lit(SIEVE))
    words = keys.select(F.shiftright(bit, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int")).alias("b"))
    words = words.groupBy("word").agg(F.bit_or("b").alias("b"))
    n = PAGE // 64
    place = F.struct(F.pmod("word", F.lit(n)).cast("int").alias("at"), "b")
    pages = words.groupBy(F.floor(F.col("word") / n).alias("sieve_page")).agg(F.map_from_entries(F.collect_list(place)).alias("m"))
    return pages.select("sieve_page", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))).alias("sieve_words"))


def sift(rows: DataFrame, column: str, held: DataFrame, out: bool = False) -> DataFrame:
    """Rows whose key may be in the sieve (out: all others, which surely are not among its keys). A narrow step.

    All keys of the sieve pass. Of other keys as many pass as the sieve is full: few while there are far fewer keys than
    bits, all in the end. Whoever joins what passes gets the same result either way, at the cost of one shuffle of it.
    """
    bit = F.pmod(F.xxhash64(column), F.lit(SIEVE))
    df = rows.withColumns({"sieve_at": F.floor(bit / PAGE), "sieve_bit": F.pmod(bit, F.lit(PAGE)).cast("int")})
    df = df.join(F.broadcast(held), F.col("sieve_at") == F.col("sieve_page"), "left")
    word = F.get("sieve_words", F.shiftright("sieve_bit", 6))
    hit = F.coalesce(F.call_function("shiftrightunsigned", word, F.pmod("sieve_bit", F.lit(64)).cast("int")).bitwiseAND(1) == 1, F.lit(False))
    return df.where(~hit if out else hit).select(*rows.columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that a slice holds at most about `limit` bytes of the column, one row at least."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        at = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += n
        if at < len(sizes):
            yield batch.slice(at, len(sizes) - at)


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
