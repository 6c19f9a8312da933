"""Causal indicators that start afresh after every gap of the grid.

A series is cut into parts, a day say, and windows run within a part. The rows just before a part are copied to it, as many
as the longest window looks back; what reaches farther (the gaps so far, the bars of a section that goes on) is carried over
in a row a part. So a symbol is as many tasks as it has parts, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketlake.functions.ewm import ewm
from marketlake.sources.layout import dealt

#: Rows before a part that are copied to it: returns over 60 bars look at one bar more.
LEAD = 60


def _in_order(*keys: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("open_time")


def _so_far(*keys: str) -> WindowSpec:
    return _in_order(*keys).rowsBetween(Window.unboundedPreceding, 0)


def _run() -> WindowSpec:
    return _in_order("symbol", "part")


def with_section(grid: DataFrame, block: str = "day", rows: int = LEAD) -> DataFrame:
    """Adds data_valid, section (gaps so far) and row_in_section (valid bars of the section so far; null at a gap).

    The result is in parts of one `block`: columns part and lead, the latter true for copies of rows before the part. The
    functions below take such rows; `whole` drops the copies in the end. `rows` is the longest look back in bars.

    A column part that the grid has already (see sources.layout) is taken as it is: rows that are stored by symbol and part
    stay where they are while sections are found; only copies and a row a part move.
    """
    df = grid.withColumn("data_valid", F.col("close").isNotNull())
    df = df if "part" in grid.columns else df.withColumn("part", F.date_trunc(block, "open_time"))
    df = df.withColumn("section", F.count_if(~F.col("data_valid")).over(_so_far("symbol", "part")))
    df = df.withColumns({"row_in_section": F.count("close").over(_so_far("symbol", "part", "section")), "_row": F.row_number().over(_run())})
    # the last row is taken with all its columns, so that this side and the join below read one exchange
    last = df.groupBy("symbol", "part").agg(F.max_by(F.struct(*df.columns), "open_time").alias("last"))
    last = last.select("symbol", "part", F.col("last.section").alias("gaps"), F.col("last.row_in_section").alias("bars"), F.col("last._row").alias("n"))
    w = Window.partitionBy("symbol").orderBy("part")  # a row a part
    last = last.withColumns({"run": F.count_if(F.col("gaps") > 0).over(w), "first": F.sum("n").over(w) - F.col("n")})
    last = last.withColumns({"after": F.sum("bars").over(Window.partitionBy("symbol", "run").orderBy("part")), "next": F.collect_list(F.struct("part", "first")).over(w.rowsBetween(1, rows))})
    near = F.filter("next", lambda x: x["first"] - F.col("first") - F.col("n") < rows)
    carried = last.select("symbol", "part", (F.sum("gaps").over(w) - F.col("gaps")).alias("_gaps"), F.coalesce(F.lag("after").over(w), F.lit(0)).alias("_bars"), F.col("first").alias("_first"), near.alias("_next"))
    df = df.join(carried, ["symbol", "part"])
    n = F.col("row_in_section") + F.when(F.col("section") == 0, F.col("_bars")).otherwise(0)
    df = df.withColumn("row_in_section", F.when(F.col("data_valid"), n)).withColumn("section", F.col("section") + F.col("_gaps"))
    later = F.filter("_next", lambda x: x["first"] - F.col("_first") - F.col("_row") < rows)
    if "part" in grid.columns:
        names = [*grid.columns, "data_valid", "section", "row_in_section"]
        copies = df.where(F.size(later) > 0).select(*(c for c in names if c != "part"), F.explode(F.transform(later, lambda x: x["part"])).alias("part"))
        copies = dealt(copies.select(*names, F.lit(True).alias("lead")), grid)
        return df.select(*names, F.lit(False).alias("lead")).unionByName(copies)
    df = df.withColumn("_at", F.explode(F.concat(F.array("part"), F.transform(later, lambda x: x["part"]))))
    return df.withColumn("lead", F.col("_at") != F.col("part")).withColumn("part", F.col("_at")).drop("_gaps", "_bars", "_first", "_next", "_row", "_at")


def whole(df: DataFrame) -> DataFrame:
    """The rows themselves, without the copies that windows looked back at."""
    return df.where(~F.col("lead")).drop("lead", "part")


def _before() -> Column:
    return F.lag("close").over(_run())


def returns(df: DataFrame) -> DataFrame:
    """Adds the return, log return and difference to the bar before; null at a gap and after one."""
    b = _before()
    return df.withColumns({"return_1": F.try_divide("close", b) - 1, "log_return": F.when((F.col("close") > 0) & (b > 0), F.log("close") - F.log(b)), "delta": F.col("close") - b})


def true_range(df: DataFrame) -> DataFrame:
    """Adds the largest of high - low and both distances to the close before (a section's first bar: high - low)."""
    b = _before()
    return df.withColumn("true_range", F.when(F.col("data_valid"), F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - b), F.abs(F.col("low") - b))))


def volatility(df: DataFrame, windows: tuple[int, ...] = (30, 60)) -> DataFrame:
    """Adds the sample deviation of log returns over full windows."""
    for w in windows:
        over = _run().rowsBetween(-(w - 1), 0)
        df = df.withColumn(f"volatility_{w}", F.when(F.count("log_return").over(over) == w, F.stddev_samp("log_return").over(over)))
    return df


def zscore(df: DataFrame, n: int = 20) -> DataFrame:
    """Adds the distance of the close from its mean over n bars, in sample deviations; null if they are 0."""
    over = _run().rowsBetween(-(n - 1), 0)
    z = F.try_divide(F.col("close") - F.avg("close").over(over), F.stddev_samp("close").over(over))
    return df.withColumn(f"zscore_{n}", F.when(F.count("close").over(over) == n, z))


def vwap_day(df: DataFrame) -> DataFrame:
    """Adds the volume-weighted price of the UTC day so far; null at and after the day's first gap, and before any volume."""
    df = df.withColumn("day", F.to_date("open_time"))
    whole = F.min(F.col("close").isNotNull().cast("int")).over(_so_far("symbol", "day")) == 1
    v = F.try_divide(F.sum("quote_volume").over(_so_far("symbol", "day")), F.nullif(F.sum("volume").over(_so_far("symbol", "day")), F.lit(0.0)))
    return df.withColumn("vwap_utc_day", F.when(whole, v)).drop("day")


def averages(df: DataFrame, block: str = "day") -> DataFrame:
    """Adds EMA 20/50/200, ATR 14, RSI 14 and the trend in basis points. Needs returns() and true_range(), and whole rows."""
    df = df.withColumns({"gain": F.greatest("delta", F.lit(0.0)), "loss": F.greatest(-F.col("delta"), F.lit(0.0))})
    df = df.withColumns({c: F.when(F.col("delta").isNotNull(), F.col(c)) for c in ("gain", "loss")})
    means = [(f"ema_{n}", "close", 2 / (n + 1), n) for n in (20, 50, 200)]
    means += [("atr_14", "true_range", 1 / 14, 14), ("_up", "gain", 1 / 14, 14), ("_down", "loss", 1 / 14, 14)]
    df = ewm(df, means, block=block)
    rsi = F.when((F.col("_down") == 0) & (F.col("_up") > 0), 100.0).when((F.col("_down") == 0) & (F.col("_up") == 0), 50.0).otherwise(100 - 100 / (1 + F.try_divide("_up", "_down")))
    return df.withColumn("rsi_14", rsi).withColumn("trend_20_50_bps", (F.try_divide("ema_20", "ema_50") - 1) * 10000).drop("_up", "_down", "gain", "loss")


def features(grid: DataFrame, length: str = "1 minute", block: str = "day") -> DataFrame:
    """All indicators of a dense grid, with the instant from which each bar may be used."""
    df = with_section(vwap_day(grid), block)
    return averages(whole(zscore(volatility(true_range(returns(df))))), block).withColumn("bar_available_at", F.col("open_time") + F.expr(f"interval {length}"))
