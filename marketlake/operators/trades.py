"""Audit of trades by daily partition: row flags, transitions in file order, stitching of partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.quality import _no, finite

DAY = 86_400_000
FLAGS = {
    "invalid_rows": "invalid",
    "non_increasing_id_transitions": "id_back",
    "non_consecutive_id_transitions": "id_jump",
    "regressing_time_transitions": "time_back",
    "outside_partition_rows": "outside",
    "quote_product_mismatch_rows": "mismatch",
}


def trade_invalid() -> Column:
    out = F.lit(False)
    for c in ("id", "price", "qty", "quote_qty", "time"):
        out = out | ~finite(c)
    for c in ("price", "qty", "quote_qty"):
        out = out | _no(F.col(c) <= 0)
    return out | ~F.coalesce(F.lower(F.col("is_buyer_maker").cast("string")).isin("true", "false"), F.lit(False))


def quote_mismatch() -> Column:
    product = F.col("price") * F.col("qty")
    off = F.abs(product - F.col("quote_qty")) > 1e-8 + F.abs(product) * 1e-10
    return _no(off & ~F.isnan(product) & ~F.isnan("quote_qty"))


def day_ms() -> Column:
    return F.datediff("date", F.lit("1970-01-01").cast("date")).cast("long") * DAY


def outside_partition() -> Column:
    return _no((F.col("time") < day_ms()) | (F.col("time") >= day_ms() + DAY))


def taker_side() -> Column:
    """A buyer that is the maker means that the taker sold."""
    return F.when(F.lower(F.col("is_buyer_maker").cast("string")) == "true", "sell").otherwise("buy")


def transitions(df: DataFrame) -> DataFrame:
    """Adds id_back, id_jump and time_back against the row before in the file; a partition's first row has none."""
    w = Window.partitionBy("symbol", "date").orderBy("row_idx")
    step = F.col("id") - F.lag("id").over(w)
    return df.withColumns({"id_back": _no(step <= 0), "id_jump": _no(step > 1), "time_back": _no(F.col("time") - F.lag("time").over(w) < 0)})


def flagged(df: DataFrame) -> DataFrame:
    return df.withColumns({"invalid": trade_invalid(), "outside": outside_partition(), "mismatch": quote_mismatch()})


def _results(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.when(F.col("rows") > 0, "audited_all_rows").otherwise("failed"))


def audit(df: DataFrame) -> DataFrame:
    """A row for each symbol and date: counters, first and last id and time in file order."""
    df = flagged(transitions(df))
    ends = [f(c, "row_idx").alias(n) for n, f, c in (("first_id", F.min_by, "id"), ("last_id", F.max_by, "id"), ("first_time_ms", F.min_by, "time"), ("last_time_ms", F.max_by, "time"))]
    return _results(df.groupBy("symbol", "date").agg(F.count("*").alias("rows"), *(F.sum(F.col(c).cast("long")).alias(n) for n, c in FLAGS.items()), *ends))


KEY = ("symbol", "date")
ENDS = ("first_row", "last_row", "first_id", "last_id", "first_time_ms", "last_time_ms")
RUN = "symbol string, date date, version long, rows long, " + ", ".join(f"{n} long" for n in FLAGS) + ", " + ", ".join(f"{n} long" for n in ENDS)


def runs(df: DataFrame, version: str | None = None) -> DataFrame:
    """A row for each run of neighbouring rows (row_idx one after another) of a file, with its counters and ends; no shuffle.

    Rows may come in any split and order: what a task does not see beside each other is a run of its own, and `combined` adds
    the seams. `version` names a number that grows when a file is replaced; without it there is one version.
    """
    cols = [*KEY, "row_idx", "id", "time", "invalid", "outside", "mismatch", "version"]

    def walk(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in it:
            if g.empty:
                continue
            new = (g["row_idx"].diff() != 1).to_numpy()
            for c in (*KEY, "version"):
                new |= (g[c] != g[c].shift()).to_numpy()
            start = np.flatnonzero(new)
            end = np.r_[start[1:], len(g)] - 1
            ids, times = g["id"].astype("Float64").diff().mask(new), g["time"].astype("Float64").diff().mask(new)
            if g["id"].dtype == np.int64:  # differences of large ids stay exact
                ids = g["id"].diff().astype("Float64").mask(new)
            g = g.assign(id_back=(ids <= 0).fillna(False), id_jump=(ids > 1).fillna(False), time_back=(times < 0).fillna(False))
            first, last = g.iloc[start].reset_index(drop=True), g.iloc[end].reset_index(drop=True)
            sums = {n: np.add.reduceat(g[c].to_numpy(np.int64), start) for n, c in FLAGS.items()}
            out = pd.DataFrame({"symbol": first["symbol"], "date": first["date"], "version": first["version"], "rows": end - start + 1, **sums})
            yield out.assign(first_row=first["row_idx"], last_row=last["row_idx"], first_id=first["id"], last_id=last["id"], first_time_ms=first["time"], last_time_ms=last["time"])

    numbered = flagged(df).withColumn("version", F.col(version).cast("long") if version else F.lit(0).cast("long"))
    return numbered.select(*cols).mapInPandas(walk, RUN)


def combined(found: DataFrame) -> DataFrame:
    """A row for each partition from the runs of its newest version: counters with the seams between runs, and the ends.

    The same run twice, of a file that was read again, counts once. Runs that overlap otherwise cannot be put in order: such a
    partition has failed.
    """
    newest = found.withColumn("_newest", F.max("version").over(Window.partitionBy(*KEY))).where("version = _newest").drop("_newest")
    w = Window.partitionBy(*KEY).orderBy("first_row", "last_row")
    one = newest.withColumn("_again", F.row_number().over(Window.partitionBy(*KEY, "first_row", "last_row").orderBy("rows"))).where("_again = 1").drop("_again")
    step, back = F.col("first_id") - F.lag("last_id").over(w), F.col("first_time_ms") - F.lag("last_time_ms").over(w)
    over = _no(F.col("first_row") <= F.max("last_row").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    one = one.withColumns({"s1": _no(step <= 0).cast("long"), "s2": _no(step > 1).cast("long"), "s3": _no(back < 0).cast("long"), "over": over})
    seams = dict(zip(list(FLAGS)[1:4], ("s1", "s2", "s3"), strict=True))
    sums = [F.sum(F.col(n) + F.col(seams[n]) if n in seams else F.col(n)).alias(n) for n in FLAGS]
    ends = [F.min_by("first_id", "first_row").alias("first_id"), F.max_by("last_id", "first_row").alias("last_id"), F.min_by("first_time_ms", "first_row").alias("first_time_ms"), F.max_by("last_time_ms", "first_row").alias("last_time_ms")]
    out = one.groupBy(*KEY).agg(F.sum("rows").alias("rows"), *sums, *ends, F.max("over").alias("over"))
    return out.withColumn("status", F.when(F.col("over") | (F.col("rows") <= 0), "failed").otherwise("audited_all_rows")).drop("over")


def audit_partial(df: DataFrame) -> DataFrame:
    """The same as `audit` without a shuffle of rows: tasks sum up their runs, and only those meet."""
    return combined(runs(df))


def verified(results: DataFrame, checked: DataFrame) -> DataFrame:
    """The results (with column name, the file) and an error: where a file's bytes are not those of the manifest, or it is not
    there, its partition has failed, whatever its rows say. `checked` are the rows of readers.check_inventory.
    """
    bad = checked.where(~F.col("ok")).groupBy("name").agg(F.when(F.count("path") > 0, "source checksum changed").otherwise("source is missing").alias("error"))
    df = results.join(bad, "name", "left")
    return df.withColumn("status", F.when(F.col("error").isNotNull(), "failed").otherwise(F.col("status")))


def precheck(df: DataFrame, n: int = 1000) -> DataFrame:
    """Whether the first n rows of each partition look right: positive numbers, times, flags, ids that strictly increase."""
    head = transitions(df.where(F.col("row_idx") < n))
    ok = (F.col("price") > 0) & (F.col("qty") > 0) & F.col("time").isNotNull() & F.lower(F.col("is_buyer_maker").cast("string")).isin("true", "false") & ~F.col("id_back")
    return head.groupBy("symbol", "date").agg(F.count("*").alias("rows"), F.min(F.coalesce(ok, F.lit(False))).alias("passed"))


def stitch(results: DataFrame) -> DataFrame:
    """Adds the last good partition before each and the distance of ids to it."""
    good = results.where("status = 'audited_all_rows'")
    w = Window.partitionBy("symbol").orderBy("date")
    return good.withColumns({"prior_partition_date": F.lag("date").over(w), "id_delta_from_prior_partition": F.col("first_id") - F.lag("last_id").over(w)})


def boundary_errors(results: DataFrame) -> DataFrame:
    """Neighbouring days whose ids or times run back."""
    w = Window.partitionBy("symbol").orderBy("date")
    df = results.withColumns({"left_date": F.lag("date").over(w), "left_id": F.lag("last_id").over(w), "left_time": F.lag("last_time_ms").over(w)})
    return df.where((F.datediff("date", "left_date") == 1) & ((F.col("first_id") <= F.col("left_id")) | (F.col("first_time_ms") < F.col("left_time")))).select("symbol", "left_date", F.col("date").alias("right_date"))


def incremental(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Manifest rows still to audit: without an earlier good result of the same bytes."""
    return manifest.join(done.where("status = 'audited_all_rows'"), ["key", "sha256"], "left_anti")


def united(manifest: DataFrame, done: DataFrame, fresh: DataFrame) -> DataFrame:
    """A result for each manifest row: the earlier good one of the same bytes, else that of `fresh` (key, sha256 and the same columns)."""
    same = done.where("status = 'audited_all_rows'").join(manifest.select("key", "sha256"), ["key", "sha256"], "left_semi")
    return same.unionByName(fresh.join(manifest.select("key"), "key", "left_semi").join(same.select("key"), "key", "left_anti"))
