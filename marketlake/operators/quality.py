"""Row and file checks of the sources; a file that fails is set aside whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NUMBERS = ("open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "count", "taker_buy_volume", "taker_buy_quote_volume")


def finite(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))


def _no(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def epoch_ms(df: DataFrame, col: str, file_col: str = "file") -> DataFrame:
    """Adds <col>_ms and <col>_bad: a file whose largest value is over 1e14 is in microseconds; a remainder there is an error."""
    micro = df.groupBy(file_col).agg((F.max(col) > F.lit(10**14)).alias("_us"))
    df = df.join(micro, file_col)
    ms = F.when(F.col("_us"), F.expr(f"`{col}` div 1000")).otherwise(F.col(col))
    return df.withColumns({f"{col}_ms": ms, f"{col}_bad": _no(F.col("_us") & (F.pmod(F.col(col), F.lit(1000)) != 0))}).drop("_us")


def candle_invalid(interval_ms: int = 60_000, positive_prices: bool = True) -> Column:
    """Whether a candle breaks a rule; a missing or not finite number does."""
    c = F.col
    bad = [c("high") < F.greatest("open", "close"), c("low") > F.least("open", "close"), c("high") < c("low"), c("volume") < 0, c("quote_volume") < 0, c("count") < 0]
    bad += [F.pmod(c("open_time"), F.lit(interval_ms)) != 0, c("close_time") != c("open_time") + interval_ms - 1, c("taker_buy_volume") < 0, c("taker_buy_volume") > c("volume") + 1e-8]
    if positive_prices:
        bad.append(c("low") <= 0)
    out = F.lit(False)
    for n in NUMBERS:
        out = out | ~finite(n)
    for b in bad:
        out = out | _no(b)
    return out


def candle_qa(df: DataFrame, by: str = "file", interval_ms: int = 60_000, positive_prices: bool = True, order: str = "row_idx") -> DataFrame:
    """A row for each file: rows, invalid_rows, duplicate_times, out_of_order, observed_gap_intervals."""
    step = F.col("open_time") - F.lag("open_time").over(Window.partitionBy(by).orderBy(order))
    gap = F.col("open_time") - F.lag("open_time").over(Window.partitionBy(by).orderBy("open_time"))
    df = df.withColumns({"_bad": candle_invalid(interval_ms, positive_prices), "_back": _no(step < 0), "_gap": _no(gap > interval_ms)})
    return df.groupBy(by).agg(
        F.count("*").alias("rows"),
        F.sum(F.col("_bad").cast("long")).alias("invalid_rows"),
        (F.count("*") - F.count_distinct(F.struct("open_time"))).alias("duplicate_times"),
        F.max("_back").alias("out_of_order"),
        F.sum(F.col("_gap").cast("long")).alias("observed_gap_intervals"),
    )


def metrics_invalid(expected_symbol: Column) -> Column:
    """Open-interest rows: another symbol, a negative or not finite figure."""
    return ~F.coalesce(F.col("symbol") == expected_symbol, F.lit(False)) | _no(F.col("sum_open_interest") < 0) | ~finite("sum_open_interest") | ~finite("sum_open_interest_value")


def depth_invalid() -> Column:
    return _no((F.col("depth") < 0) | (F.col("notional") < 0))


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def with_event_time(df: DataFrame, category: str) -> DataFrame:
    """Adds event_time_utc: parsed from text for metrics and depth, from epochs for funding."""
    source = {"metrics": "create_time", "depth": "timestamp", "funding": "calc_time"}[category]
    made = F.timestamp_millis("calc_time_ms") if category == "funding" else F.try_to_timestamp(F.col(source))
    return (epoch_ms(df, "calc_time") if category == "funding" else df).withColumn("event_time_utc", made)


def duplicates(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """duplicate_rows of each group: rows less different keys, a null being a value."""
    return df.groupBy(*by).agg((F.count("*") - F.count_distinct(F.struct(*keys))).alias("duplicate_rows"))


def funding_qa(df: DataFrame, start_ms: int, end_ms: int, time: str = "funding_time", order: str = "row_idx") -> DataFrame:
    """unique, increasing and inside of each symbol's funding history."""
    step = F.col(time) - F.lag(time).over(Window.partitionBy("symbol").orderBy(order))
    df = df.withColumns({"_back": _no(step < 0), "_out": (F.col(time) < start_ms) | (F.col(time) > end_ms)})
    return df.groupBy("symbol").agg((F.count("*") == F.count_distinct(F.struct(time))).alias("is_unique"), (~F.max("_back")).alias("is_increasing"), (~F.max("_out")).alias("is_inside"))


def quarantine(rows: DataFrame, qa: DataFrame, by: str = "file") -> DataFrame:
    """Rows of files without any finding; `qa` are the rows of candle_qa, or those of file_reasons."""
    bad = qa.select(F.col("file").alias(by)) if "broken" in qa.columns else reasons(qa, by).select(by)
    return rows.join(bad, by, "left_anti")


def reasons(qa: DataFrame, by: str = "file") -> DataFrame:
    """file, reason: the files that are set aside whole, and for what."""
    found = [F.when(F.col(c) > 0, F.concat(F.lit(f"{c}="), F.col(c))) for c in ("invalid_rows", "duplicate_times")] + [F.when(F.col("out_of_order"), "out_of_order")]
    return qa.select(by, F.concat_ws(", ", *found).alias("reason")).where("reason <> ''")


#: The columns that a category's files must have.
REQUIRED = {
    "trades": ("id", "price", "qty", "quote_qty", "time", "is_buyer_maker"),
    "metrics": ("create_time", "symbol", "sum_open_interest", "sum_open_interest_value"),
    "bookDepth": ("timestamp", "percentage", "depth", "notional"),
    "fundingRate": ("calc_time", "funding_interval_hours", "last_funding_rate"),
}


def _findings(rows: DataFrame, counts: dict[str, Column], by: str) -> DataFrame:
    """file, broken: for each file the rules that it breaks and how often; one aggregation without a shuffle of rows."""
    names = list(counts)
    g = rows.groupBy(by).agg(*(counts[n].alias(f"_{i}") for i, n in enumerate(names)))
    made = F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(n).alias("key"), F.col(f"_{i}").cast("long").alias("value")) for i, n in enumerate(names))), lambda e: e["value"] > 0))
    return g.select(F.col(by).alias("file"), made.alias("broken"))


def row_findings(rows: DataFrame, category: str, expected_symbol: Column | None = None, first: int = 1000, by: str = "file") -> DataFrame:
    """What the rows of a category's files break. Trades: their first rows (by row_idx), as a pre-check; others: all rows."""
    n = F.count_if
    if category == "metrics":
        counts = {
            "other_symbol": n(~F.coalesce(F.col("symbol") == expected_symbol, F.lit(False))),
            "negative_open_interest": n(_no(F.col("sum_open_interest") < 0)),
            "open_interest_not_finite": n(~finite("sum_open_interest") | ~finite("sum_open_interest_value")),
        }
    elif category == "bookDepth":
        counts = {"negative_depth": n(depth_invalid())}
    elif category == "fundingRate":
        counts = {"funding_rate_not_finite": n(~finite("last_funding_rate")), "funding_time_missing": n(F.col("calc_time").isNull())}
    elif category == "trades":
        rows = rows.where(F.col("row_idx") < first)
        step = F.col("id") - F.lag("id").over(Window.partitionBy(by).orderBy("row_idx"))
        rows = rows.withColumn("_step", step)
        fine = (F.col("price") > 0) & (F.col("qty") > 0) & F.col("time").isNotNull()
        flag = F.lower(F.col("is_buyer_maker").cast("string")).isin("true", "false")
        counts = {"invalid_sampled_trade": n(~F.coalesce(fine, F.lit(False))), "invalid_sampled_ids": n(_no(F.col("_step") <= 0)), "invalid_sampled_maker_side": n(~F.coalesce(flag, F.lit(False)))}
    else:
        raise ValueError(f"no rules for {category}")
    return _findings(rows, counts, by)


def candle_findings(qa: DataFrame, by: str = "file") -> DataFrame:
    """The findings of candle_qa; gaps of the grid are none."""
    entries = [F.struct(F.lit(c).alias("key"), F.col(c).cast("int").cast("long").alias("value")) for c in ("invalid_rows", "duplicate_times", "out_of_order")]
    return qa.select(F.col(by).alias("file"), F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"] > 0)).alias("broken"))


def schema_findings(headers: DataFrame) -> DataFrame:
    """From file, category, columns (names of its header): the required columns that are not there."""
    required = F.create_map(*(x for k, v in REQUIRED.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    missing = F.array_except(F.coalesce(F.try_element_at(required, F.col("category")), F.array().cast("array<string>")), F.col("columns"))
    return headers.select("file", F.map_from_entries(F.transform(missing, lambda c: F.struct(F.concat(F.lit("missing_column:"), c).alias("key"), F.lit(1).cast("long").alias("value")))).alias("broken"))


def checksum_findings(checked: DataFrame, by: str = "name") -> DataFrame:
    """From the rows of readers.check_inventory: files whose bytes are not those of the manifest, and files that are not there."""
    rule = F.when(F.col("path").isNull(), "file_missing").otherwise("checksum_changed")
    return checked.where(~F.col("ok")).select(F.col(by).alias("file"), F.create_map(rule, F.lit(1).cast("long")).alias("broken"))


def file_reasons(*findings: DataFrame) -> DataFrame:
    """file, broken: every file that breaks any rule of any category, with all of its rules and counts as one map.

    Findings have a row a file; a rule found by two of them adds up. Files without any are not there: `quarantine` takes the
    rest. A stricter reader would stop at a file's first error; here all are told.
    """
    df = findings[0]
    for more in findings[1:]:
        df = df.unionByName(more)
    one = df.select("file", F.explode("broken").alias("rule", "n")).groupBy("file", "rule").agg(F.sum("n").alias("n"))
    return one.groupBy("file").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", "n")))).alias("broken"))  # a file's rules


def reason_text(broken: Column) -> Column:
    """rule=count, ... in the rules' order."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(broken)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ", ")
