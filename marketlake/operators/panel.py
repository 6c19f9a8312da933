"""The joint panel: one row a minute, the symbols beside each other, only exact times joined."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def attach_close(frame: DataFrame, aux: DataFrame, name: str) -> DataFrame:
    """Adds the close of another price of the same symbol and minute. Tables stored by symbol and part are joined where they lie."""
    keys = ["symbol", *(["part"] if "part" in frame.columns and "part" in aux.columns else []), "open_time"]
    return frame.join(aux.select(*keys, F.col("close").alias(name)), keys, "left")


def attach_exact(frame: DataFrame, events: DataFrame, value: str, name: str, time: str = "event_time_utc") -> DataFrame:
    """Adds the value at exactly this time, and whether it is ambiguous: a time that comes twice gives no value at all."""
    n = F.count("*").over(Window.partitionBy("symbol", time))
    keyed = events.withColumn("_n", n).groupBy("symbol", F.col(time).alias("open_time")).agg(F.max("_n").alias("_n"), F.max(value).alias("_v"))
    keyed = keyed.select("symbol", "open_time", F.when(F.col("_n") == 1, F.col("_v")).alias(name), (F.col("_n") > 1).alias(f"{name}_ambiguous"))
    return frame.join(keyed, ["symbol", "open_time"], "left").withColumn(f"{name}_ambiguous", F.coalesce(f"{name}_ambiguous", F.lit(False)))


def build(long: DataFrame, symbols: list[str], columns: list[str]) -> DataFrame:
    """Wide rows by one pivot: <symbol>_<column>, validity of all symbols, and constant honesty flags."""
    g = long.groupBy("open_time").pivot("symbol", symbols).agg(*(F.max(c).alias(c) for c in columns))
    valid = F.lit(True)
    for s in symbols:
        valid = valid & F.col(f"{s}_close").isNotNull()
    flags = {k: F.lit(False) for k in ("prices_filled", "open_interest_interpolated", "macro_values_filled")}
    return g.withColumn("both_ohlcv_valid", valid).withColumns(flags)
