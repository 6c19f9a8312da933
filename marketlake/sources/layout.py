"""Bars stored by symbol and part of time, so that grids, sections and panels join and run their windows where the rows lie.

A table is cut into buckets by (symbol, part), part being the start of the day or week that a bar lies in. Whatever groups,
joins or orders by symbol and part then needs no exchange of the stored rows. A symbol alone would be a poor key: two of them
hold everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("symbol", "part")
#: What the column part's metadata tells: the length of a part and the number of buckets.
BLOCK, BUCKETS = "bars.part", "bars.buckets"


def save_bars(df: DataFrame, name: str, block: str = "day", buckets: int = 64, path: str | None = None, time: str = "open_time") -> DataFrame:
    """Replaces table `name` by the bars, a file a bucket, and reads it. Buckets are as many as tasks should work on the table."""
    part = F.date_trunc(block, time).cast(df.schema[time].dataType)
    rows = df.withColumn("part", part).withMetadata("part", {BLOCK: block, BUCKETS: buckets}).repartition(buckets, *KEYS)
    w = rows.write.mode("overwrite").format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS, time)
    (w if path is None else w.option("path", path)).saveAsTable(name)
    return read_bars(df.sparkSession, name)


def read_bars(spark: SparkSession, name: str) -> DataFrame:
    """The table. Joins by symbol, part and time use its buckets, which are by fewer columns: the session is set to allow that."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark.table(name)


def dealt(df: DataFrame, like: DataFrame) -> DataFrame:
    """Rows with symbol and part, dealt out as the stored bars `like` lie."""
    return df.repartition(like.schema["part"].metadata[BUCKETS], *KEYS)


def part_of(df: DataFrame, time: str = "open_time") -> Column:
    """The part of a time, as the stored bars `df` have it."""
    block = df.schema["part"].metadata.get(BLOCK, "day")
    return F.date_trunc(block, time).cast(df.schema["part"].dataType)
