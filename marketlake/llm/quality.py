r"""Quality rules whose thresholds follow the corpus: quantile sketches for each language and source, then a joined filter.

DataFrame functions only. The sketch is a histogram over buckets whose borders grow by a constant factor, so a quantile is
right to within that factor, sketches of parts add up to the sketch of the whole, and the result depends neither on the
order of rows nor on their partitions. A group too small for quantiles of its own takes those of its language, then of all.

A fence is the median plus STEEP times the spread of the quiet half (median less first quartile, for an upper fence) plus
the least distance that counts, so that junk, as long as it is under half of a group, cannot move it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import written

#: Borders of the sketch's buckets grow by this factor; values from LEAST on are told apart.
GROWTH, LEAST = 1.02, 1e-6
STEEP = 6.0
#: Documents that a group needs for thresholds of its own.
ENOUGH = 200
#: metric: (least distance of the upper fence from the median, of the lower fence or None)
RULES: dict[str, tuple[float, float | None]] = {"symbol_share": (0.05, None), "dup_line_share": (0.4, None), "repeat_share": (0.35, None), "mean_word": (0.7, 0.7)}

_SPACES = r"[\\x20\\x09-\\x0D]+"


def with_counts(docs: DataFrame, text: str = "text", prefix: str = "q_") -> DataFrame:
    """Adds the counts of each row's text: words, word_chars, symbols, lines (with a word), dup_lines, repeat_words.

    A null text counts as an empty one. Work is linear in the text but for one sort of a document's window hashes, and is
    skipped for documents without a repeated window.
    """
    p = prefix
    e = F.expr
    df = docs.withColumn(f"{p}t", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    df = df.withColumn(f"{p}w", e(f"array_remove(split({p}t, '{_SPACES}'), '')"))
    df = df.withColumn(f"{p}words", F.size(f"{p}w").cast("long"))
    df = df.withColumn(f"{p}h", e(f"case when {p}words < 4 then cast(array() as array<bigint>) else transform(sequence(0, cast({p}words as int) - 3), i -> xxhash64({p}w[i], {p}w[i + 1], {p}w[i + 2])) end"))
    df = df.withColumn(f"{p}lines_", e(f"filter(split({p}t, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"))
    df = df.select(
        *docs.columns,
        f"{p}words",
        F.length(F.array_join(f"{p}w", "")).cast("long").alias(f"{p}word_chars"),
        F.length(F.regexp_replace(f"{p}t", r"[^#*$%&|<>]+", "")).cast("long").alias(f"{p}symbols"),
        F.size(f"{p}lines_").cast("long").alias(f"{p}lines"),
        (F.size(f"{p}lines_") - F.size(F.array_distinct(f"{p}lines_"))).cast("long").alias(f"{p}dup_lines"),
        # sorting by hash and place brings equal windows together, in order
        e(f"case when size(array_distinct({p}h)) = size({p}h) then null else sort_array(transform({p}h, (h, i) -> named_struct('h', h, 'i', cast(i as bigint)))) end").alias(f"{p}s"),
    )
    same = f"x.h <=> get({p}s, k - 1).h or x.h <=> get({p}s, k + 1).h"
    df = df.withColumn(f"{p}r", e(f"sort_array(transform(filter({p}s, (x, k) -> {same}), x -> x.i))"))
    covered = f"coalesce(aggregate({p}r, named_struct('to', 0L, 'n', 0L), (a, x) -> named_struct('to', x + 3, 'n', a.n + x + 3 - greatest(x, a.to)), a -> a.n), 0L)"
    return df.withColumn(f"{p}repeat_words", e(covered)).drop(f"{p}s", f"{p}r")


def base_failed(prefix: str = "q_") -> Column:
    return (F.col(f"{prefix}words") < 50) | (100 * F.col(f"{prefix}repeat_words") > 50 * F.col(f"{prefix}words"))


def metric(name: str, prefix: str = "q_") -> Column:
    top, bottom = {"symbol_share": ("symbols", "word_chars"), "dup_line_share": ("dup_lines", "lines"), "repeat_share": ("repeat_words", "words"), "mean_word": ("word_chars", "words")}[name]
    return F.coalesce(F.try_divide(F.col(prefix + top), F.col(prefix + bottom)), F.lit(0.0))


def sketch(counted: DataFrame, lang: str = "lang", source: str = "source", prefix: str = "q_") -> DataFrame:
    """Bucket counts of each metric for each language and source, over rows that pass the base rules.

    Sketches of parts of a corpus add up: union them and sum `n`.
    """
    sized = F.array(*(F.struct(F.lit(m).alias("metric"), metric(m, prefix).alias("v")) for m in RULES))
    rows = counted.where(~base_failed(prefix)).select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(sized).alias("x"))
    bucket = F.when(F.col("x.v") < LEAST, F.lit(0)).otherwise(F.greatest(F.lit(1), F.ceil(F.log(F.col("x.v") / LEAST) / F.log(F.lit(GROWTH))))).cast("int")
    return rows.groupBy("lang", "source", F.col("x.metric").alias("metric"), bucket.alias("bucket")).agg(F.count("*").alias("n"))


def fences(sketches: DataFrame) -> DataFrame:
    """lang, source and for each metric <metric>_high and <metric>_low: a row for each language and source in the sketch."""
    one = sketches.groupBy("lang", "source", "metric", "bucket").agg(F.sum("n").alias("n"))
    lang = one.groupBy("lang", "metric", "bucket").agg(F.sum("n").alias("n"))
    every = lang.groupBy("metric", "bucket").agg(F.sum("n").alias("n"))

    def quantiles(df: DataFrame, *keys: str) -> DataFrame:
        w = Window.partitionBy(*keys, "metric")
        df = df.withColumn("upto", F.sum("n").over(w.orderBy("bucket"))).withColumn("all", F.sum("n").over(w))
        value = F.when(F.col("bucket") == 0, 0.0).otherwise(F.lit(LEAST) * F.pow(F.lit(GROWTH), F.col("bucket") - 0.5))
        at = {q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("bucket"))) for q in (0.25, 0.5, 0.75)}
        rows = df.groupBy(*keys, "metric").agg(F.max("all").alias("docs"), *(F.min(F.when(F.col("upto") >= q * F.col("all"), value)).alias(f"v{int(100 * q)}") for q in at))
        high = F.col("v50") + STEEP * (F.col("v50") - F.col("v25"))
        low = F.col("v50") - STEEP * (F.col("v75") - F.col("v50"))
        return rows.groupBy(*keys).agg(
            F.max("docs").alias("docs"),
            *(F.max(F.when(F.col("metric") == m, high + up)).alias(f"{m}_high") for m, (up, _) in RULES.items()),
            *(F.max(F.when(F.col("metric") == m, low - down)).alias(f"{m}_low") for m, (_, down) in RULES.items() if down is not None),
        )

    names = [f"{m}_high" for m in RULES] + [f"{m}_low" for m, (_, down) in RULES.items() if down is not None]
    a, b, c = quantiles(one, "lang", "source").alias("a"), quantiles(lang, "lang").alias("b"), quantiles(every).alias("c")
    joined = a.join(b, F.col("a.lang").eqNullSafe(F.col("b.lang"))).join(F.broadcast(c), how="left")  # c has one row
    pick = lambda n: F.when(F.col("a.docs") >= ENOUGH, F.col(f"a.{n}")).when(F.col("b.docs") >= ENOUGH, F.col(f"b.{n}")).otherwise(F.col(f"c.{n}"))
    return joined.select(F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), *(pick(n).alias(n) for n in names))


def judge(counted: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source", prefix: str = "q_") -> DataFrame:
    """Adds <prefix>base_failed and <prefix>kept. A row whose group has no fences (all its rows fail the base rules) fails too."""
    p = prefix
    limits = limits.select(F.struct(*limits.columns).alias(f"{p}f"))
    df = counted.join(limits, F.col(lang).eqNullSafe(F.col(f"{p}f.lang")) & F.col(source).eqNullSafe(F.col(f"{p}f.source")), "left")
    good = F.lit(True)
    for m, (_, down) in RULES.items():
        good = good & (metric(m, p) <= F.col(f"{p}f.{m}_high"))
        if down is not None:
            good = good & (metric(m, p) >= F.col(f"{p}f.{m}_low"))
    return df.withColumn(f"{p}base_failed", base_failed(p)).withColumn(f"{p}kept", ~base_failed(p) & F.coalesce(good, F.lit(False))).drop(f"{p}f")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row. Texts are read once: the counts are written down between."""
    ids = docs.select("doc_id", "lang", "source", "text")
    counted = written(with_counts(ids).drop("text"), "quality")
    df = judge(counted, fences(sketch(counted)))
    return df.select("doc_id", F.col("q_words").alias("n_words"), F.col("q_word_chars").alias("word_chars"), F.col("q_symbols").alias("n_symbols"), F.col("q_dup_lines").alias("n_dup_lines"), F.col("q_repeat_words").alias("n_repeat_words"), F.col("q_base_failed").alias("base_failed"), F.col("q_kept").alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that the rules keep, with their columns as they are, whatever their names.

    Texts are never shuffled: rows are written down with their counts, the small table of fences is joined to them.
    """
    rows = docs.select(F.struct("*").alias("q_row"), "lang", "source", "text")
    counted = written(with_counts(rows).drop("text"), "counted")
    return judge(counted, written(fences(sketch(counted)), "fences")).where("q_kept").select("q_row.*")
