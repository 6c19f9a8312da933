"""Macro series and release calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.coverage import latest


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """series (the file's name), observation_date, value of CSV files; see parse_series."""
    files = spark.read.text(path, wholetext=True)
    return parse_series(files.select(F.regexp_extract(F.col("_metadata.file_name"), r"([^/]+?)\.csv", 1).alias("series"), F.col("value").alias("content")))


def parse_series(files: DataFrame) -> DataFrame:
    """series, observation_date, value from rows (series, content): a line an observation after the header; a dot is a null.

    The first column is the date whatever its name.
    """
    lines = files.select("series", F.explode(F.expr(r"slice(split(content, '\\r?\\n'), 2, 2147483647)")).alias("line")).where("line <> ''")
    cells = F.split("line", ",")
    return lines.select("series", F.get(cells, F.lit(0)).try_cast("date").alias("observation_date"), F.get(cells, F.lit(1)).try_cast("double").alias("value"))


def html_rows(df: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """cells: the cells of each table row, tags stripped, white space collapsed; columns to keep beside them."""
    rows = df.select(*keep, F.explode(F.regexp_extract_all(F.col(col), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))).alias("r"))
    cells = F.regexp_extract_all("r", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1))
    return rows.select(*keep, F.transform(cells, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]*>", ""), r"\s+", " "))).alias("cells"))


def release_events(rows: DataFrame, start: str, end: str, event_type: str | Column, zone: str = "America/New_York") -> DataFrame:
    """Releases in [start, end): cells are the period, the day (with its year) and the local time. Values stay null.

    event_type is one for all rows, or a column that html_rows kept.
    """
    local = F.try_to_timestamp(F.concat_ws(" ", F.get("cells", F.lit(1)), F.get("cells", F.lit(2))), F.lit("MMM d, yyyy hh:mm a"))
    df = rows.where(F.size("cells") >= 3).withColumn("at", F.to_utc_timestamp(local, zone))
    df = df.where((F.col("at") >= F.lit(start).cast("timestamp")) & (F.col("at") < F.lit(end).cast("timestamp")))
    none = F.lit(None).cast("double")
    return df.select((event_type if isinstance(event_type, Column) else F.lit(event_type)).alias("event_type"), F.get("cells", F.lit(0)).alias("reference_period"), F.col("at").alias("scheduled_release_at_utc"), none.alias("actual_value"), none.alias("consensus"), none.alias("surprise"))


def merge_sources(old: DataFrame, new: DataFrame) -> DataFrame:
    """The new record of each series. Where it failed and the old one was acquired with bytes that still match (old.bytes_match),
    the whole old record stands, marked resumed_from_initial_release, with the new attempt's error as new_fetch_error.

    A series that is not asked for any more is not there. `new` may have a column error.
    """
    names = [c for c in old.columns if c not in ("series", "bytes_match", "error")]
    o, n = old.alias("o"), new.alias("n")
    back = F.coalesce((F.col("n.status") != "acquired") & (F.col("o.status") == "acquired") & F.col("o.bytes_match"), F.lit(False))
    pick = lambda c: F.when(back, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}") if c in new.columns else F.lit(None)).alias(c)
    error = F.col("n.error") if "error" in new.columns else F.lit(None).cast("string")
    return n.join(o, F.col("o.series") == F.col("n.series"), "left").select(F.col("n.series").alias("series"), *map(pick, names), back.alias("resumed_from_initial_release"), F.when(back, error).alias("new_fetch_error"))


def merge_events(old: DataFrame, new: DataFrame) -> DataFrame:
    """Events of both, the new one for each type and time."""
    both = old.withColumn("_p", F.lit(0)).unionByName(new.withColumn("_p", F.lit(1)))
    return latest(both, ["event_type", "scheduled_release_at_utc"], "_p").drop("_p")
