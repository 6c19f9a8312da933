"""Bars: half-open clipping, dense grids with explicit nulls, down-sampling of complete bars only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.sources.layout import dealt, part_of

SUMS = ("volume", "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume")


def clip_window(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Rows with start <= time < end."""
    return df.where((F.col(time) >= F.lit(start).cast(df.schema[time].dataType)) & (F.col(time) < F.lit(end).cast(df.schema[time].dataType)))


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows themselves; reading them raises if a key comes twice."""
    bad = df.groupBy(*keys).count().where("count > 1").limit(1)
    if not bad.isEmpty():
        raise ValueError(f"a key of {keys} comes twice: {bad.first()}")
    return df


def to_grid(df: DataFrame, symbols: DataFrame, start: str, end: str, step: str = "1 minute", time: str = "open_time") -> DataFrame:
    """A row for each symbol and step of [start, end); steps without a row have nulls, nothing is filled.

    Bars that are stored by symbol and part (sources.layout) are not moved: the grid's empty steps are dealt out as they are.
    """
    # a symbol's days are exploded one by one, so no row holds a long array
    kind = df.schema[time].dataType.simpleString()
    days = symbols.select("symbol").distinct().withColumn("d", F.explode(F.expr(f"sequence(cast('{start}' as {kind}), cast('{end}' as {kind}) - interval {step}, interval 1 day)")))
    last = f"least(d + interval 1 day, cast('{end}' as {kind})) - interval {step}"
    grid = days.select("symbol", F.explode(F.expr(f"sequence(d, {last}, interval {step})")).alias(time))
    if "part" not in df.columns:
        return grid.join(df, ["symbol", time], "left")
    return dealt(grid.withColumn("part", part_of(df, time)), df).join(df, ["symbol", "part", time], "left")


def resample(df: DataFrame, rule: str, n: int, time: str = "open_time") -> DataFrame:
    """Bars of length `rule` from bars of the grid; only those with all n parts present. Left-closed, labelled by their start."""
    has = F.col("close").isNotNull()
    at = lambda c, f: f(F.when(has, F.col(c)), F.when(has, F.col(time)))
    g = df.groupBy("symbol", F.window(time, rule).alias("w")).agg(
        at("open", F.min_by).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), at("close", F.max_by).alias("close"), *(F.sum(c).alias(c) for c in SUMS), F.count("close").alias("parts")
    )
    return g.where(F.col("parts") == n).select("symbol", F.col("w.start").alias(time), "open", "high", "low", "close", *SUMS)


def with_available_at(df: DataFrame, length: str, time: str = "open_time") -> DataFrame:
    """Adds the instant from which a bar may be used: its start plus its length."""
    return df.withColumn("bar_available_at", F.col(time) + F.expr(f"interval {length}"))


def from_trades(trades: DataFrame, rule: str, time: str = "ts") -> DataFrame:
    """Bars from trades; ids give the order inside a bar."""
    q = lambda c: F.sum(c.cast("decimal(20,4)")).cast("double")
    taker = ~F.col("is_buyer_maker")
    money = F.col("price").cast("decimal(18,4)") * F.col("qty")
    g = trades.groupBy("symbol", F.window(time, rule).alias("w")).agg(
        F.min_by("price", "id").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "id").alias("close"),
        q(F.col("qty")).alias("volume"),
        q(money).alias("quote_volume"),
        F.count("*").alias("count"),
        q(F.when(taker, F.col("qty")).otherwise(0)).alias("taker_buy_volume"),
        q(F.when(taker, money).otherwise(0)).alias("taker_buy_quote_volume"),
    )
    return g.select("symbol", F.col("w.start").alias("open_time"), "open", "high", "low", "close", *SUMS)


