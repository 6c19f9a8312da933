"""Readers and writers of the archive's files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.sources.archive import ArchiveSource, digests

CANDLE = ("open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume", "ignore")


def read_archive(spark: SparkSession, path: str, columns: Sequence[str], first: int | None = None) -> DataFrame:
    """The rows of zipped CSV files, each read as a stream by a task of its own; see archive.ArchiveSource."""
    spark.dataSource.register(ArchiveSource)
    r = spark.read.format(ArchiveSource.name()).option("columns", ",".join(columns))
    return (r if first is None else r.option("first", first)).load(path)


def parse_archives(files: DataFrame, columns: Sequence[str], first: int | None = None) -> DataFrame:
    """file, row_idx and the columns (text) of archives (path, content) with one CSV in each; `first` rows of each at most.

    For files under 2 GB in a store that only Spark reaches: a cell holds a file. A first line whose first cell is not all digits is a header.
    """

    def rows(it: Iterator) -> Iterator:
        import csv
        import io
        import zipfile

        import pandas as pd

        for batch in it:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    inside = [n for n in z.namelist() if n.endswith(".csv")]
                    if len(inside) != 1:
                        raise ValueError(f"{name}: one CSV expected, found {len(inside)}")
                    lines = csv.reader(io.TextIOWrapper(z.open(inside[0]), "utf-8"))
                    held, at = [], 0
                    for k, line in enumerate(lines):
                        if k == 0 and not line[0].isdigit():
                            continue
                        if len(line) != len(columns):
                            raise ValueError(f"{name}: {len(line)} columns, expected {len(columns)}")
                        if first is not None and at >= first:
                            break
                        held.append((name, at, *line))
                        at += 1
                        if len(held) >= 50_000:
                            yield pd.DataFrame(held, columns=["file", "row_idx", *columns])
                            held = []
                    if held:
                        yield pd.DataFrame(held, columns=["file", "row_idx", *columns])

    return files.select("path", "content").mapInPandas(rows, "file string, row_idx long, " + ", ".join(f"`{c}` string" for c in columns))


def read_candles(spark: SparkSession, path: str) -> DataFrame:
    """Unzipped candle CSVs with or without a header; the order of rows inside a file is kept in row_idx. A line of other than 12 cells is an error."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row_idx"))
    cells = F.split("value", ",", -1)
    right = F.when(F.size(cells) == len(CANDLE), cells).otherwise(F.raise_error(F.concat(F.lit(f"not {len(CANDLE)} columns: "), "file", F.lit(": "), "value")).cast("array<string>"))
    kinds = {c: "string" if c == "ignore" else "long" if c in ("open_time", "close_time", "count") else "double" for c in CANDLE}
    rows = lines.withColumn("cells", right).where(F.get("cells", F.lit(0)) != "open_time")
    return rows.select(*(F.get("cells", F.lit(i)).cast(kinds[c]).alias(c) for i, c in enumerate(CANDLE)), "file", "row_idx")


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 of the files of a folder, however large: Spark lists them, tasks read them in chunks.

    Files are dealt out one by one, the largest tasks being one file each.
    """
    listed = spark.read.format("binaryFile").load(path).select("path")  # no content is read
    return digests(listed.repartition(max(1, min(listed.count(), 10_000)), "path"))


def inventory(files: DataFrame) -> DataFrame:
    """path, bytes, sha256 of small files that are rows already (path, content)."""
    return files.select("path", F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify_checksums(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    return check_inventory(file_inventory(spark, path), manifest)


def check_inventory(have: DataFrame, manifest: DataFrame) -> DataFrame:
    """name, path, sha256, expected, ok for each file of the manifest (name, sha256); a file that is not there is not ok."""
    have = have.select("path", "sha256", F.element_at(F.split("path", "/"), -1).alias("name"))
    j = manifest.select("name", F.col("sha256").alias("expected")).join(have, "name", "left")
    return j.select("name", "path", "sha256", "expected", F.coalesce(F.col("sha256") == F.col("expected"), F.lit(False)).alias("ok"))


def read_manifest(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The manifest's records from a JSON list, or (lines) from JSON lines as write_manifest leaves them."""
    schema = "key string, url string, symbol string, category string, period string, date string, interval string, status string, relative_path string, source_sha256 string, repair_for string, bytes long"
    return spark.read.option("multiLine", not lines).schema(schema).json(path)


def read_funding_pages(spark: SparkSession, path: str, symbol: str) -> DataFrame:
    """Pages of a symbol's funding history, one JSON list a file. See parse_funding_pages."""
    return parse_funding_pages(spark.read.text(path, wholetext=True).select(F.lit(symbol).alias("symbol"), F.col("value").alias("page")))


def parse_funding_pages(pages: DataFrame) -> DataFrame:
    """symbol, funding_time, event_time_utc, last_funding_rate from rows (symbol, page), a page being a JSON list.

    A page that is no list, or a row of another symbol, is an error.
    """
    rows = F.from_json("page", "array<struct<symbol: string, fundingTime: bigint, fundingRate: string>>")
    right = F.trim("page").startswith("[") & rows.isNotNull() & F.forall(rows, lambda r: F.coalesce(r["symbol"] == F.col("symbol"), F.lit(False)))
    checked = F.when(right, rows).otherwise(F.raise_error(F.concat(F.lit("unexpected funding history of "), "symbol")).cast("array<struct<symbol: string, fundingTime: bigint, fundingRate: string>>"))
    r = pages.select(F.explode(checked).alias("r"))
    return r.select("r.symbol", F.col("r.fundingTime").alias("funding_time"), F.timestamp_millis("r.fundingTime").alias("event_time_utc"), F.col("r.fundingRate").cast("double").alias("last_funding_rate"))


def read_envelopes(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Order-book envelopes (JSON lines). See parse_envelopes."""
    return parse_envelopes((spark.readStream if streaming else spark.read).format("text").load(path))


def parse_envelopes(lines: DataFrame) -> DataFrame:
    """symbol, type, session, seq, first, u, pu, bids, asks of JSON lines (value). U and u differ by case only, so the ids are taken by path from the text."""
    j = lambda p: F.get_json_object("value", f"$.{p}")
    side = lambda p: F.array_join(F.transform(F.from_json(F.coalesce(*(j(f"payload.{x}") for x in p)), "array<array<string>>"), lambda l: F.concat_ws(":", l)), ";")
    u = F.coalesce(j("payload.u"), j("payload.lastUpdateId")).cast("long")
    cols = {"symbol": j("symbol"), "type": j("type"), "session": j("session").cast("int"), "seq": j("seq").cast("long"), "first": F.coalesce(j("payload.U").cast("long"), u), "u": u, "pu": F.coalesce(j("payload.pu").cast("long"), u), "bids": side(("b", "bids")), "asks": side(("a", "asks"))}
    return lines.select(*(c.alias(n) for n, c in cols.items()))


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A new folder beside `path` to write to; it takes the place of `path` once all is written, else it goes and `path` stays.

    Readers see the old table or the new one. The swap is two renames: if the second fails, the first is taken back. On stores
    whose renames copy (object stores) the swap is not atomic; there a catalog table with versions serves better.
    """
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    beside = lambda kind: jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}-{kind}-{uuid.uuid4().hex}")
    staged, old = beside("new"), beside("old")

    def moved(a: object, b: object) -> bool:
        try:
            return fs.rename(a, b)
        except Py4JJavaError:
            return False

    try:
        yield staged.toString()
        there = fs.exists(at)
        if there and not moved(at, old):
            raise OSError(f"{path} could not be moved away")
        if not moved(staged, at):
            if there:
                moved(old, at)
            raise OSError(f"{path} could not be replaced")
        fs.delete(old, True)
    finally:
        fs.delete(staged, True)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Replaces the table, or, with partitions, the partitions that the rows touch; a write that fails leaves the old ones.

    With `sort_by` the files follow one another in that order and are sorted inside: rows are dealt out by ranges, never gathered.
    """
    if sort_by:
        order = [*partition_by, *sort_by]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("compression", "gzip")
    if partition_by:  # Spark stages these itself and moves them when all tasks are done
        w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic").save(path)
    elif mode == "overwrite":
        with replacing(df.sparkSession, path) as staged:
            w.save(staged)
    else:
        w.save(path)


def write_report(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """A report of few rows (a row a source, partition or symbol) as one JSON file, in order (of all columns by default)."""
    with replacing(df.sparkSession, path) as staged:
        df.orderBy(*(order_by or df.columns)).coalesce(1).write.json(staged)


def write_manifest(records: DataFrame, path: str) -> None:
    """The manifest's records as JSON lines in the order of their keys, in as many files as they need."""
    write_table(records, path, sort_by=["key"], fmt="json")
