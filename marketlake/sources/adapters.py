"""Market schemas over the driver's tables: events as a trade tape, orders as positions, and what follows from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START, END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
ALL = "ALL"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tape(spark: SparkSession, sf_dir: str, faults: bool = False) -> DataFrame:
    """Trades: symbol, id, row_idx, ts, date, time, price, qty, quote_qty, is_buyer_maker; `faults` plants errors by modulus."""
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    df = e.select(
        F.col("event_type").alias("symbol"), F.col("event_id").alias("id"), F.col("event_id").alias("row_idx"), "ts", F.to_date("ts").alias("date"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("time"), F.col("value").alias("price"), k.alias("qty"), (F.col("value") * k).alias("quote_qty"), (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
    )
    if not faults:
        return df
    n = F.col("row_idx")
    return df.withColumns({
        "quote_qty": F.when(n % 97 == 0, F.col("quote_qty") * 1.01).otherwise(F.col("quote_qty")),
        "price": F.when(n % 101 == 0, 0.0).otherwise(F.col("price")),
        "time": F.when(n % 103 == 0, F.col("time") - 7_200_000).otherwise(F.col("time")),
        "id": F.when(n % 107 == 0, n - 1).otherwise(n),
    })


def both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tape by symbol, and again as one symbol ALL."""
    t = tape(spark, sf_dir)
    return t.unionByName(t.withColumn("symbol", F.lit(ALL)))


def candles(spark: SparkSession, sf_dir: str, bars: DataFrame) -> DataFrame:
    """Hourly candles in the archive's form, a file for each symbol and day, with errors planted by hour."""
    h = F.hour("open_time")
    ms = F.unix_millis(F.col("open_time").cast("timestamp"))
    odd = (F.dayofmonth("open_time") % 5 == 0) & (h == 7)
    df = bars.withColumns({
        "file": F.concat_ws("/", "symbol", F.date_format("open_time", "yyyy-MM-dd")), "row_idx": F.when((F.dayofmonth("open_time") % 7 == 0) & (h == 9), ms - 7_200_001).otherwise(ms),
        "close_time": ms + F.when(odd, 0).otherwise(3_599_999), "high": F.when((F.dayofmonth("open_time") % 11 == 0) & (h == 3), F.col("low") - 1).otherwise(F.col("high")), "open_time": ms,
    })
    return df.where("close is not null")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, items = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    last = items.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("exit"))
    return o.join(last, "o_orderkey").select(
        F.col("o_orderkey").alias("position_id"), F.when(F.col("o_orderkey") % 3 == 0, "A").otherwise("B").alias("symbol"), F.col("o_orderdate").alias("entry"), "exit",
        F.col("o_totalprice").alias("notional"), F.when(F.col("o_orderkey") % 2 == 0, "long").otherwise("short").alias("side"),
    )


def funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payment a month and symbol over the span of the orders, rates by modulus."""
    span = read(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    t = span.select(F.explode(F.expr("sequence(trunc(a, 'month'), add_months(trunc(b, 'month'), 6), interval 1 month)")).alias("d"), F.explode(F.array(F.lit("A"), F.lit("B"))).alias("symbol"))
    return t.select("symbol", F.col("d").cast("timestamp_ntz").alias("paid_at"), ((F.month("d") % 5 - 2) * 0.0001).alias("rate"))
