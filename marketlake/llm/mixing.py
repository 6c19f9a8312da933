"""Mixing sources to target weights along a curriculum that changes in time. DataFrame functions only.

A source's share of the words at time t (0 to 1 of the training) follows a weight schedule, straight between knots. The
integral of the schedule is the source's cumulative demand; a document takes the position where its source's demand
reaches the middle of the words that the document adds. Ordering all documents by position gives the training order.

A source whose target is q times its size and a rest gives every document q times, and those documents once more that
come first in a fixed pseudo-random order, up to the rest. The document at that border is taken in part (`split`), so a
source's taken words differ from its target by less than one word; or whole if at least half of it fits, for a mix that
never cuts a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import n_words, sieve, sift, written

#: Parts of a source's pseudo-random order that are summed apart, so that no task holds a whole source.
PARTS = 4096
#: A source gives at most so many times its size.
MOST = 3.0
#: Tilt of the schedules: weight at the start and at the end of the training, by place in the cycle of three.
TILT = ((1.25, 0.75), (1.0, 1.0), (0.75, 1.25))


def cycle_weights(sources: DataFrame) -> DataFrame:
    """Adds `weight` (1, 2, 3, repeating, sources in order of code points, null last) and `place` (0, 1, 2)."""
    w = Window.orderBy(F.col("source").isNull(), "source")  # a row a source
    return sources.withColumn("place", ((F.row_number().over(w) - 1) % 3).cast("int")).withColumn("weight", (F.col("place") + 1).cast("double"))


def targets(sources: DataFrame, total: Column | None = None, most: float = MOST) -> DataFrame:
    """Adds `target` to rows (source, source_size, weight): shares of the total by weight, none above most * source_size.

    What a capped source leaves is shared by weight among the others, again and again. The end of that is a level L with
    target = min(most * size, L * weight): sources in order of size a weight are capped up to the first that stays below.
    """
    w = Window.orderBy(F.col("ratio"), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    df = sources.withColumn("all", total if total is not None else F.sum("source_size").over(every)).withColumn("ratio", most * F.col("source_size") / F.col("weight"))
    capped = F.coalesce(F.sum(most * F.col("source_size")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_ = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    df = df.withColumn("level", (F.col("all") - capped) / open_)
    # the first source in order whose own cap is not below the level; if none, all are capped
    level = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).over(every)["level"]
    df = df.withColumn("target", F.coalesce(F.least(most * F.col("source_size"), level * F.col("weight")), most * F.col("source_size")).cast("double"))
    return df.drop("all", "ratio", "level")


def schedules(sources: DataFrame, tilt: tuple[tuple[float, float], ...] = TILT) -> DataFrame:
    """Adds `knots`: array of (t, weight), here a straight line by the source's place; any number of knots may be given."""
    made = F.array(*(F.array(*(F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w")) for t, w in enumerate(ends))) for ends in tilt))
    return sources.withColumn("knots", made[F.col("place")])


def _integrated(sources: DataFrame) -> DataFrame:
    """Adds `parts`: for each stretch between knots its start, end, weights at both, and share of the demand before it."""
    df = sources.withColumn("steps", F.expr("transform(slice(knots, 2, size(knots)), (k, j) -> named_struct('t0', knots[j].t, 't1', k.t, 'w0', knots[j].w, 'w1', k.w, 'area', (k.t - knots[j].t) * (k.w + knots[j].w) / 2))"))
    df = df.withColumn("whole", F.expr("aggregate(steps, 0D, (a, s) -> a + s.area)"))
    before = "aggregate(slice(steps, 1, i), 0D, (a, x) -> a + x.area)"
    return df.withColumn("parts", F.expr(f"transform(steps, (s, i) -> named_struct('t0', s.t0, 't1', s.t1, 'w0', s.w0, 'w1', s.w1, 'from', {before} / whole, 'share', s.area / whole))")).drop("steps", "whole", "knots")


def _time(share: Column, parts: Column) -> Column:
    """The time at which a source's demand reaches a share (0 to 1) of its whole: the inverse of the integral."""
    s = F.element_at(F.filter(parts, lambda p: (p["from"] <= share) | (p["t0"] == 0)), -1)
    # within the stretch: w0 x + (w1 - w0) x^2 / (2 d) = the area wanted, solved in the form that has no cancellation
    d = s["t1"] - s["t0"]
    want = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(share - s["from"], s["share"])))
    mean = (s["w0"] + s["w1"]) / 2
    root = F.sqrt(F.greatest(F.lit(0.0), s["w0"] * s["w0"] + 2 * (s["w1"] - s["w0"]) * want * mean))
    return s["t0"] + d * F.coalesce(F.try_divide(2 * want * mean, s["w0"] + root), F.lit(0.0))


def plan(docs: DataFrame, split: bool, weights=cycle_weights, curriculum=schedules, most: float = MOST, parts: int = PARTS) -> DataFrame:
    """doc_id, size, source, source_size, target, taken, times, positions (array, ascending, one for each time) of every row.

    Rows are ordered inside a source by a hash of id and text, so that reruns agree; equal rows in any order, which shows
    nowhere. A null text or one without words has size 0 and is taken once (at no cost) if its source is taken at all. A
    null source is a source. A size is never exceeded more than `most` times. With no words at all every target is 0 and every row is taken 0 times.
    """
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("order"))
    sized = written(sized.withColumn("part", F.pmod("order", F.lit(parts)).cast("int")), "sizes")
    sums = sized.groupBy("source", "part").agg(F.sum("size").alias("n"))
    sources = sums.groupBy("source").agg(F.sum("n").alias("source_size"))
    sources = _integrated(curriculum(targets(weights(sources), most=most)))
    w = Window.partitionBy("source").orderBy("part")
    starts = sums.withColumn("start", F.sum("n").over(w) - F.col("n")).drop("n")
    base = starts.join(sources, starts["source"].eqNullSafe(sources["source"])).select(starts["source"].alias("of"), F.col("part").alias("at"), "start", "source_size", "target", "parts")
    inside = F.sum("size").over(Window.partitionBy("source", "part").orderBy("order", "doc_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    df = sized.withColumn("inside", inside).join(base, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at")))
    rest = F.col("target") - F.col("source_size") * F.floor(F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
    first = F.col("start") + F.col("inside")
    full = F.floor(F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
    if split:
        words = F.greatest(F.lit(0), F.least(F.col("size"), F.floor(rest) - first))
    else:
        words = F.when(first + F.col("size") / 2 <= rest, F.col("size")).otherwise(0)
    more = (rest > 0) & ((words > 0) | ((F.col("size") == 0) & (first <= rest)))
    df = df.withColumn("taken", (full * F.col("size") + F.when(more, words).otherwise(0)).cast("long")).withColumn("times", (full + more.cast("int")).cast("int"))
    df = df.withColumn("middle", first + F.col("size") / 2)
    # the k-th time round a source's documents, the words before a document are k sizes of the source and those before it
    share = lambda k: F.least(F.lit(1.0), (k * F.col("source_size") + F.col("middle")) / F.col("target"))
    at = F.when(F.col("times") > 0, F.transform(F.sequence(F.lit(0), F.col("times") - 1), lambda k: _time(share(k), F.col("parts")))).otherwise(F.array().cast("array<double>"))
    return df.select("doc_id", "size", "source", "source_size", "target", "taken", "times", at.alias("positions"), "order")


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns and each document's first position, range-sorted by it (documents left out come last)."""
    df = plan(docs, split=True).withColumn("position", F.get("positions", F.lit(0)))
    return df.select("doc_id", "size", "source_size", "target", "taken", "position").orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: every row as often as it is taken, in training order, with the columns as they are.

    Rows are matched to the plan by id, text and source, nulls included. Of rows equal in all three as many are taken as the
    plan takes, each as often as one of the plan's rows; only such rows are numbered, and moved for it.
    """
    nth = lambda order: F.row_number().over(Window.partitionBy("k").orderBy(order))
    p = plan(docs, split=False).select(F.xxhash64("order", "source").alias("k"), "positions", "times")
    p = written(p.withColumn("nth", nth(F.desc("times"))), "plan")
    repeated = sieve(p.where("nth = 2"), "k")
    p = p.where("times > 0").select("k", "nth", "positions")
    packed = docs.select(F.struct("*").alias("row"), F.xxhash64("doc_id", "text").alias("key")).withColumn("k", F.xxhash64("key", "row.source"))
    single = sift(packed, "k", repeated, out=True).join(p.where("nth = 1").drop("nth"), "k")
    again = sift(packed, "k", repeated).withColumn("nth", nth("key")).join(p, ["k", "nth"])
    names = ["row", "key", "positions"]
    df = single.select(*names).unionByName(again.select(*names)).withColumn("at", F.explode("positions"))
    return df.orderBy("at", "key").select("row.*")
