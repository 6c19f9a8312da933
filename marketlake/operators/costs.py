"""Trading costs by scenario, and funding paid by open positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scenarios(spark: SparkSession, fees: Sequence[float], slippages: Sequence[float]) -> DataFrame:
    return spark.createDataFrame([(float(f), float(s)) for f in fees for s in slippages], "fee_bps double, slippage_bps double")


def round_trip(positions: DataFrame, cases: DataFrame) -> DataFrame:
    """Entry and exit cost of each position in each scenario, each on its own notional."""
    side = lambda n: F.col(n) * F.col("fee_bps") / 10000 + F.col(n) * F.col("slippage_bps") / 10000
    df = positions.crossJoin(F.broadcast(cases))  # a few scenarios of the configuration
    return df.withColumns({"entry_cost": side("entry_notional"), "exit_cost": side("exit_notional")}).withColumn("total_cost", F.col("entry_cost") + F.col("exit_cost"))


def _timeline(funding: DataFrame) -> DataFrame | None:
    """symbol, month, times and rates of the month in order, and count and sum of all payments before it; a row for every month of the span."""
    span = funding.agg(F.min(F.trunc("paid_at", "month")).alias("a"), F.max(F.trunc("paid_at", "month")).alias("b")).first()
    if span["a"] is None:
        return None
    own = F.struct("paid_at", F.col("rate").cast("decimal(38,18)").alias("rate"))
    per = funding.where("paid_at is not null").groupBy("symbol", F.trunc("paid_at", "month").alias("month")).agg(F.sort_array(F.collect_list(own)).alias("paid"))  # a month's payments
    months = funding.select("symbol").distinct().withColumn("month", F.explode(F.sequence(F.lit(span["a"]), F.lit(span["b"]), F.expr("interval 1 month"))))
    df = months.join(per, ["symbol", "month"], "left").withColumn("paid", F.coalesce("paid", F.array().cast(per.schema["paid"].dataType)))
    total = F.aggregate("paid", F.lit(0).cast("decimal(38,18)"), lambda s, x: (s + F.coalesce(x["rate"], F.lit(0))).cast("decimal(38,18)"))
    w = Window.partitionBy("symbol").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)  # a row a month
    df = df.withColumns({"n": F.coalesce(F.sum(F.size("paid")).over(w), F.lit(0)), "sum": F.coalesce(F.sum(total).over(w).cast("decimal(38,18)"), F.lit(0).cast("decimal(38,18)"))})
    return df.select("symbol", "month", "paid", "n", "sum")


def funding_paid(positions: DataFrame, funding: DataFrame) -> DataFrame:
    """position_id, payments, paid: payments with entry < time <= exit. Longs pay a positive rate, shorts receive it.

    What a position pays is the difference of two look-ups, all payments up to its exit less all up to its entry, times its
    notional. A look-up is an exact join to the time's month, whose row has the payments before the month and those in it; so
    no position is multiplied, whatever it spans. Rates are added as decimals. Without payments in the span everything is 0.
    """
    own = positions.select("position_id", "symbol", "side", "notional", "entry", "exit")
    months = _timeline(funding)
    if months is None:
        return own.select("position_id", F.lit(0).cast("long").alias("payments"), F.lit(0.0).alias("paid"))
    first, last = months.agg(F.min("month").alias("a"), F.max("month").alias("b")).first()
    for end in ("entry", "exit"):
        row = months.select(F.col("symbol").alias("_s"), F.col("month").alias("_m"), F.col("paid").alias("_paid"), F.col("n").alias("_n"), F.col("sum").alias("_sum"))
        at = F.least(F.greatest(F.trunc(end, "month"), F.lit(first)), F.lit(last))
        own = own.join(row, (F.col("symbol") == F.col("_s")) & (at == F.col("_m")), "left")
        time = F.col(end)
        upto = F.filter("_paid", lambda x: x["paid_at"] <= time)  # noqa: B023
        rate = F.aggregate(upto, F.col("_sum"), lambda s, x: (s + F.coalesce(x["rate"], F.lit(0))).cast("decimal(38,18)"))
        own = own.withColumns({f"_n_{end}": F.col("_n") + F.size(upto), f"_rate_{end}": rate}).drop("_s", "_m", "_paid", "_n", "_sum")
    open_ = F.coalesce(F.col("entry") < F.col("exit"), F.lit(False)) & F.col("_n_exit").isNotNull()
    sign = F.when(F.col("side") == "long", -1).otherwise(1)
    paid = sign * F.col("notional") * (F.col("_rate_exit") - F.col("_rate_entry")).cast("double")
    n = F.when(open_, F.col("_n_exit") - F.col("_n_entry")).otherwise(0)
    return own.select("position_id", n.cast("long").alias("payments"), F.when(n > 0, F.coalesce(paid, F.lit(0.0))).otherwise(0.0).alias("paid"))
