"""Order books from absolute level updates, in batch; the streaming replay is in streaming.book."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ENVELOPE = """symbol string, type string, received_at_utc timestamp, session int, error string,
payload struct<first: long, last: long, prior: long, b: array<array<string>>, a: array<array<string>>>"""


def sequence_gaps(diffs: DataFrame) -> DataFrame:
    """Adds gap and island: an update whose `pu` is not the `u` before it starts a new island. Stale updates are dropped."""
    w = Window.partitionBy("symbol", "session").orderBy("seq")
    seen = F.max("u").over(w.rowsBetween(Window.unboundedPreceding, -1))
    df = diffs.withColumn("_seen", seen).where(F.col("_seen").isNull() | (F.col("u") >= F.col("_seen"))).drop("_seen")
    gap = F.coalesce(F.col("pu") != F.lag("u").over(w), F.lit(False))
    return df.withColumn("gap", gap).withColumn("island", F.sum(F.col("gap").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def final_levels(updates: DataFrame) -> DataFrame:
    """The last quantity of each level of a session; quantity 0 removes it."""
    df = updates.groupBy("symbol", "session", "side", "price").agg(F.max_by("qty", "seq").alias("qty"))
    return df.where("qty > 0")


def best(levels: DataFrame) -> DataFrame:
    return levels.groupBy("symbol", "session").agg(F.max(F.when(F.col("side") == "bid", F.col("price"))).alias("best_bid"), F.min(F.when(F.col("side") == "ask", F.col("price"))).alias("best_ask"))


def report(replayed: DataFrame) -> DataFrame:
    """Updates, applied updates, sessions, gaps and status of each symbol from the rows of a replay; a snapshot is no update.

    A session that failed (too many updates before its snapshot) blocks its symbol's capture.
    """
    n = lambda outcome: F.count_if(F.col("outcome") == outcome)
    g = replayed.groupBy("symbol").agg(F.count_if(F.col("outcome") != "snapshot").alias("events"), n("applied").alias("synchronized_events"), F.count_distinct("session").alias("sessions"), n("gap").alias("gaps"), n("failed").alias("_failed"))
    return g.withColumn("status", F.when(F.col("_failed") > 0, "blocked_or_failed").when(F.col("synchronized_events") > 0, "captured").otherwise("no_synchronized_data")).drop("_failed")
