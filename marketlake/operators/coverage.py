"""What should exist, what does, and the verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CANDLES = ("klines", "markPriceKlines", "indexPriceKlines", "premiumIndexKlines")


def expected_sources(symbols: DataFrame, categories: Sequence[str], start: str, end: str) -> DataFrame:
    """key, symbol, category, period, date of every row of `symbols` (column symbol).

    Candles come by whole months, else by days; funding by months; the rest by days.
    """
    if start >= end:
        raise ValueError("the window is empty")
    days = F.expr(f"sequence(date'{start}', date'{end}' - interval 1 day, interval 1 day)")
    df = symbols.select("symbol").distinct().withColumn("category", F.explode(F.array(*map(F.lit, categories)))).withColumn("d", F.explode(days))
    df = df.withColumn("m", F.trunc("d", "month"))
    whole = (F.col("m") >= F.lit(start).cast("date")) & (F.last_day("d") < F.lit(end).cast("date"))
    monthly = (F.col("category") == "fundingRate") | (F.col("category").isin(*CANDLES) & whole)
    df = df.select("symbol", "category", F.when(monthly, "monthly").otherwise("daily").alias("period"), F.when(monthly, F.date_format("d", "yyyy-MM")).otherwise(F.date_format("d", "yyyy-MM-dd")).alias("date")).distinct()
    return df.withColumn("key", F.concat_ws("/", "symbol", "category", "period", "date"))


def month_scope(start: str, end: str, month: str) -> tuple[str, str]:
    """The window cut to a month (yyyy-MM)."""
    y, m = map(int, month.split("-"))
    first, after = f"{y:04d}-{m:02d}-01", f"{y + m // 12:04d}-{m % 12 + 1:02d}-01"
    return max(start, first), min(end, after)


def in_scope(records: DataFrame, requested: DataFrame) -> DataFrame:
    """Records whose key, or whose repair_for, is requested."""
    keys = requested.select(F.col("key").alias("_k")).distinct()
    own = records.join(keys, F.col("key") == F.col("_k"), "left_semi")
    repairs = records.join(keys, F.col("repair_for") == F.col("_k"), "left_semi")
    return own.unionByName(repairs.join(own.select("key"), "key", "left_anti"))


def missing_sources(requested: DataFrame, records: DataFrame) -> DataFrame:
    return requested.join(records.where("status = 'verified'").select("key"), "key", "left_anti")


def summary(requested: DataFrame, records: DataFrame, counts: DataFrame) -> DataFrame:
    """A row for each symbol and category: expected, verified and supplemental files, rows, and the share observed."""
    want = requested.groupBy("symbol", "category").agg(F.count("*").alias("expected_files"))
    keys = requested.select("key", F.lit(True).alias("asked"))
    good = records.where("status = 'verified'").join(keys, "key", "left")
    have = good.groupBy("symbol", "category").agg(F.count_if("asked").alias("verified_files"), F.count_if(F.col("asked").isNull()).alias("supplemental_files"))
    df = want.join(have, ["symbol", "category"], "left").join(counts, ["symbol", "category"], "left").fillna(0)
    return df.withColumn("missing_rows", F.col("expected_rows") - F.col("observed_rows")).withColumn("coverage_fraction", F.round(F.try_divide("observed_rows", "expected_rows"), 6))


def trade_summary(requested: DataFrame, records: DataFrame, audits: DataFrame) -> DataFrame:
    """A row for each symbol that is asked for: expected and verified files, rows summed from the audits, and files audited in full."""
    want = requested.groupBy("symbol").agg(F.count("*").alias("expected_files"))
    have = records.where("status = 'verified'").groupBy("symbol").agg(F.count("*").alias("verified_files"))
    seen = audits.groupBy("symbol").agg(F.sum("rows").alias("observed_rows"), F.count_if(F.col("status") == "audited_all_rows").alias("fully_audited_files"))
    return want.join(have, "symbol", "left").join(seen, "symbol", "left").fillna(0).withColumn("category", F.lit("trades"))


def grid_diff(events: DataFrame, expected: DataFrame, time: str = "event_time") -> tuple[DataFrame, DataFrame]:
    """Times that are missing, and times off the grid, each once."""
    a, b = expected.select("symbol", time), events.select("symbol", time)
    return a.subtract(b), b.subtract(a)


def missing_days(grid: DataFrame, rows_a_day: int = 1440) -> DataFrame:
    """Days of the grid without a single close."""
    g = grid.groupBy("symbol", F.to_date("open_time").alias("day")).agg(F.count("*").alias("n"), F.count("close").alias("seen"))
    return g.where((F.col("n") == rows_a_day) & (F.col("seen") == 0)).select("symbol", "day")


def repair_days(base: DataFrame, daily: DataFrame, days: DataFrame) -> DataFrame:
    """The base rows, and the daily source's rows for days that lack all; partial gaps stay."""
    more = daily.withColumn("day", F.to_date("open_time")).join(days, ["symbol", "day"], "left_semi").drop("day")
    return base.unionByName(more)


#: Fields that tell of the first acquisition: a later record that lacks them does not make them later.
ACQUISITION = ("retrieved_at_utc", "last_modified", "etag", "checksum_last_modified")


def merge_manifests(old: DataFrame, new: DataFrame, keep: Sequence[str] = ACQUISITION) -> DataFrame:
    """The newer record of each key; of the fields in `keep` those that it lacks come from the older one."""
    names = [c for c in old.columns if c != "key"]
    o, n = old.alias("o"), new.alias("n")
    pick = lambda c: F.coalesce(f"n.{c}", f"o.{c}") if c in keep else F.when(F.col("n.key").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return o.join(n, F.col("o.key") == F.col("n.key"), "full_outer").select(F.coalesce("n.key", "o.key").alias("key"), *(pick(c).alias(c) for c in names))


def latest(records: DataFrame, keys: Sequence[str], priority: str) -> DataFrame:
    """The record of the highest priority for each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(priority))
    return records.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def check_scopes(expected: DataFrame, found: DataFrame) -> DataFrame:
    """symbol, month, error: scopes that are absent, unexpected, twice there, or not published."""
    e, f = expected.select("symbol", "month").distinct(), found.groupBy("symbol", "month").agg(F.count("*").alias("n"), F.bool_and(F.col("status") == "published").alias("ok"))
    j = e.withColumn("e", F.lit(1)).join(f, ["symbol", "month"], "full_outer")
    error = F.when(F.col("n").isNull(), "absent").when(F.col("e").isNull(), "unexpected").when(F.col("n") > 1, "duplicate").when(~F.col("ok"), "unpublished")
    return j.select("symbol", "month", error.alias("error")).where("error is not null")


def keys_in_scopes(records: DataFrame) -> DataFrame:
    """key, scopes of every key that comes in more than one scope (symbol, month), or twice in one: an error of the campaign."""
    g = records.groupBy("key").agg(F.count("*").alias("times"), F.count_distinct("symbol", "month").alias("scopes"))
    return g.where("times > 1")


def catalog_diff(published: DataFrame, actual: DataFrame) -> DataFrame:
    """asset, member, problem: members on one side only, or outside data/."""
    p = published.select("asset", F.explode("members").alias("member")).withColumn("p", F.lit(1))
    j = p.join(actual.select("asset", "member").withColumn("a", F.lit(1)), ["asset", "member"], "full_outer")
    problem = F.when(F.col("a").isNull(), "not in archive").when(F.col("p").isNull(), "not in catalog").when(~F.col("member").startswith("data/"), "outside data/")
    return j.select("asset", "member", problem.alias("problem")).where("problem is not null")


def bad_partitions(audit: DataFrame) -> DataFrame:
    """Not fully audited, or any counter but that of jumping ids above 0."""
    counters = ["invalid_rows", "non_increasing_id_transitions", "regressing_time_transitions", "outside_partition_rows", "quote_product_mismatch_rows"]
    bad = F.col("status") != "audited_all_rows"
    for c in counters:
        bad = bad | (F.col(c) > 0)
    return audit.where(F.coalesce(bad, F.lit(True)))


#: Categories that the verdict rests on.
CORE = ("klines", "trades")


def verdict(audit: DataFrame, boundary: DataFrame, coverage: DataFrame, errors: DataFrame | None = None, core: Sequence[str] = CORE) -> DataFrame:
    """One row: bad partitions, boundary errors, incomplete core categories, errors of the row checks, and whether the core is complete."""
    one = bad_partitions(audit).agg(F.count("*").alias("bad_partitions"))
    two = boundary.agg(F.count("*").alias("boundary_errors"))
    three = coverage.where(F.col("category").isin(*core)).agg(F.count_if((F.col("verified_files") != F.col("expected_files")) | (F.coalesce("missing_rows", F.lit(0)) > 0)).alias("incomplete_categories"))
    four = errors.agg(F.count("*").alias("errors")) if errors is not None else one.select(F.lit(0).cast("long").alias("errors"))
    df = one.crossJoin(two).crossJoin(three).crossJoin(four)  # four single rows
    return df.withColumn("core_complete", (F.col("bad_partitions") + F.col("boundary_errors") + F.col("incomplete_categories") + F.col("errors")) == 0)


def status_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("status").agg(F.count("*").alias("n"))
