"""Toxic passages: maximum-scoring segments over log-odds of tokens, with extreme-value calibration.

Tokens are words (runs of letters, in lower case; a letter of a script without spaces stands alone). A token's score is the
log-odds of toxic against clean documents that hold it, with Dirichlet priors in a chain: a word's prior mean is the rate of
its first seven letters, theirs the rate of the first six, and so on down to four, theirs even odds. A word that was never
seen so has the score of its beginning. The scores say what holding a word means, so its k-th occurrence in a text counts a
k-th of them. From every token a penalty is taken, so that clean text scores below zero: the everyday words of a language or
kind of text that is toxic a little more often all have small positive scores, which long texts would add up without end. The
penalty is therefore above the mean score of a token in 99 of 100 clean documents.

A linear scan gives all maximal scoring segments of a whole text. The scores that clean documents reach by chance have an
exponential tail, score s in a text of n tokens being expected K n exp(-lambda s) times; lambda and K come from the highest
segments, one to four documents, of clean documents, and lower segments count nothing. Penalty and tail are taken from documents that the scores were not
learnt from (four folds). What a text's segments exceed chance by is added up, and a logistic curve, fitted to a histogram of
that sum by label, gives the probability. A passage is a segment that fewer than one clean text in a hundred has by chance.

The fit takes about `per_label` labelled rows of each label, picked by the hash of their id; equal texts of a label count
once. At most `vocab` beginnings and words that differ most between the labels make the model, so it may be broadcast; words
over 40 characters are kept by a digest. Scores cover every row and whole texts, in one narrow pass.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import text_slices, written

FOLDS = 4
PREFIXES = (7, 6, 5, 4)
#: Scripts that are written without spaces: Thai, kana, ideographs.
ALONE = "฀-๿぀-ヿ㐀-䶿一-鿿豈-﫿"
WORDS = re.compile(r"[^\W\d_]+(?:[̀-ͯ]+[^\W\d_]*)*")
MIXED = re.compile(rf"[{ALONE}]|(?:(?![{ALONE}])[^\W\d_]|[̀-ͯ])+")
HAS_ALONE = re.compile(f"[{ALONE}]")
LONG = 40
#: Weight of the prior in documents, and the least log-likelihood ratio of a piece that the model keeps.
PRIOR, EVIDENT = 4.0, 12.0
#: The penalty of a token, at least (a score of 4 reaches over 100 tokens); this much it is above the mean score of a token in
#: the given share of clean documents. A token counts 1 at most in a mean, so that words that tell leave it low.
PENALTY, BELOW, ORDINARY = 0.04, 0.99, 1.0
#: Means by thousandths; the clean segments that make the tail are one to so many documents, each with so much above the least.
MEANS, TAIL, REACH = 1000, 4, 8.0
#: How often chance gives a clean text such a segment, at most, for it to be a passage.
CHANCE = 0.01
#: Words that a task remembers the scores of.
MEMORY = 200_000
#: The histogram of the calibration: bins of a half up to 40; that of clean segments: bins of a twentieth up to 100.
BIN, BINS = 0.5, 80
FINE, FINES = 0.05, 2000


def word_pattern(text: str) -> re.Pattern[str]:
    return MIXED if HAS_ALONE.search(text) else WORDS


def short(word: str) -> str:
    return word if len(word) <= LONG else word[:8] + "#" + blake2b(word.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def pieces(word: str) -> list[str]:
    """The word and its beginnings, the longest first; a beginning ends in a star."""
    return [short(word), *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def segments(at: list[int], scores: list[float], penalty: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score) of a text, given its tokens of scores other than 0.

    Token at[i] scores scores[i] - penalty, every other -penalty. Each new positive token is a segment; it swallows the
    earlier ones up to the nearest that starts lower, as long as it ends higher. Every segment is pushed and popped once.
    """
    found: list[tuple[int, int, float, float]] = []  # first, last, sum before it, sum at its end
    lower: list[int] = []  # for each segment the nearest earlier one with a smaller sum before it, or -1
    total, seen = 0.0, 0
    for i, s in zip(at, scores, strict=True):
        total -= penalty * (i - seen)
        seen = i + 1
        s -= penalty
        if s <= 0:
            total += s
            continue
        first, before = i, total
        total += s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = lower[j]
            if j < 0 or found[j][3] >= total:
                break
            first, before = found[j][0], found[j][2]
            del found[j:], lower[j:]
        found.append((first, i, before, total))
        lower.append(j)
    return [(a, b, end - before) for a, b, before, end in found]


class Scores(dict):
    """Scores of words by their pieces, looked up once a word and remembered, MEMORY words at most."""

    def __init__(self, table: dict[str, float], penalty: float):
        super().__init__()
        self.table, self.penalty = table, penalty

    def __reduce__(self) -> tuple[object, ...]:
        return Scores, (self.table, self.penalty)

    def __missing__(self, word: str) -> float:
        known = next((self.table[p] for p in pieces(word) if p in self.table), 0.0)
        if len(word) <= LONG and len(self) < MEMORY:
            self[word] = known
        return known

    def scored(self, text: str | None) -> tuple[int, list[int], list[float]]:
        """The number of tokens, and the places and scores of those that score; a word's k-th occurrence scores a k-th."""
        words = word_pattern(text).findall(text.lower()) if text else []
        scores = list(map(self.__getitem__, words))
        at = [i for i, s in enumerate(scores) if s]
        times: dict[str, int] = {}
        for i in at:
            if scores[i] > PENALTY:
                k = times[words[i]] = times.get(words[i], 0) + 1
                scores[i] /= k
        return len(words), at, [scores[i] for i in at]

    def mean(self, text: str | None) -> float:
        """The mean score of a token, each ORDINARY at most."""
        n, _, scores = self.scored(text)
        return sum(min(s, ORDINARY) for s in scores) / max(n, 1)

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """The number of tokens, and the maximal segments by token."""
        n, at, scores = self.scored(text)
        return n, segments(at, scores, self.penalty)


def scores_of(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> Scores:
    """From (piece, toxic documents, clean documents) of all labelled documents, with the least penalty."""
    ratio = n_toxic / n_clean
    share: dict[str, float] = {}
    table: dict[str, float] = {}
    for p, t, c in sorted(rows, key=lambda r: (not r[0].endswith("*"), len(r[0]), r[0])):  # beginnings first
        stem = p.rstrip("*")
        above = next((share[stem[:n] + "*"] for n in PREFIXES if len(stem) > n and stem[:n] + "*" in share), 0.5)
        yes, no = t + PRIOR * above, c * ratio + PRIOR * (1 - above)
        share[p] = yes / (yes + no)
        table[p] = math.log(yes / no)
    return Scores(table, PENALTY)


def highest(counts: np.ndarray, wanted: float) -> int:
    """The last bin that at least `wanted` lie in or above; the first if fewer are there."""
    above = np.cumsum(counts[::-1])[::-1]
    return int(max(np.count_nonzero(above >= wanted) - 1, 0))


def tail_of(counts: np.ndarray, documents: int, tokens: int) -> tuple[float, float, float]:
    """lambda, log K and the least score of the tail, from the counts by FINE of clean segments' scores: the mean excess over the least.

    As if one more segment with an excess of 1 had been seen. An excess counts REACH at most, so wrong labels move it little.
    """
    first = highest(counts, max(documents / TAIL, 1))
    n = counts[first:].sum()
    excess = np.minimum((np.arange(len(counts) - first) + 0.5) * FINE, REACH) @ counts[first:]
    decay, least = float((n + 1) / (excess + 1)), first * FINE
    return decay, math.log((n + 1) / max(tokens, 1)) + decay * least, least


class Model:
    """Scores of tokens and the calibration: decay (lambda), scale (log K), the tail's least score, and the logistic curve's two numbers."""

    def __init__(self, scores: Scores, decay: float, scale: float, least: float, curve: tuple[float, float]):
        self.scores, self.decay, self.scale, self.least, self.curve = scores, decay, scale, least, curve

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, int, float, float]]]:
        """The probability, and the passages (first token, last token, score, times expected by chance)."""
        n, found = self.scores.scan(text)
        kept, total = [], 0.0
        for first, last, s in found:
            over = self.decay * s - self.scale - math.log(n) if s >= self.least else 0.0
            total += max(over, 0.0)
            if over > -math.log(CHANCE):
                kept.append((first, last, s, math.exp(-over)))
        total = min(total, BIN * BINS)
        a, b = self.curve
        return 1 / (1 + math.exp(-(a + b * total))), kept


def logistic(bins: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """The curve a + b x that fits counts by bin best (Newton steps, a small ridge on b keeps separable data finite)."""
    n = clean + toxic
    ab = np.array([math.log((toxic.sum() + 0.5) / (clean.sum() + 0.5)), 0.1])
    x = np.stack([np.ones(len(bins)), bins])
    ridge = np.diag([1e-6, 0.05])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(ab @ x, -40, 40)))
        step = np.linalg.solve((x * (n * p * (1 - p))) @ x.T + ridge, x @ (toxic - n * p) - ridge @ ab)
        ab += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(ab[0]), float(max(ab[1], 0.0))


def labelled(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """fold, toxic, text of about per_label documents of each label; a document labelled both ways is toxic."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = known.where(learn)
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    lot = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 40)) / float(1 << 40)
    share = F.when(F.col("toxic") == 1, F.lit(min(1.0, per_label / max(sizes.get(1, 0), 1)))).otherwise(F.lit(min(1.0, per_label / max(sizes.get(0, 0), 1))))
    chosen = known.where(lot < share)  # about 2 * per_label rows of two numbers
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    rows = own.join(F.broadcast(chosen), "id").select("toxic", "text", F.xxhash64("text").alias("h"))
    return rows.dropDuplicates(["toxic", "h"]).select(F.pmod("h", F.lit(FOLDS)).cast("int").alias("fold"), "toxic", "text")


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int = 20_000, vocab: int = 100_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """Learns from labelled documents where `learn` (of column id) holds; None without both labels."""
    spark = docs.sparkSession
    picked = written(labelled(docs, labels, learn, per_label, id_col, text_col, label_col), "labelled")
    of = {(r["fold"], r["toxic"]): r["n"] for r in picked.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}  # eight rows
    n_toxic, n_clean = (sum(n for (_, t), n in of.items() if t == k) for k in (1, 0))
    if not n_toxic or not n_clean:
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """piece, fold, toxic and clean documents that hold it."""
        held: Counter[tuple[str, int, int]] = Counter()

        def flush() -> pa.RecordBatch:
            keys = list(held)
            n = np.array([held[k] for k in keys], np.int64)
            yes = np.array([k[2] for k in keys], np.int64)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array(n * yes), pa.array(n * (1 - yes))], ["piece", "fold", "toxic", "clean"])

        for b in text_slices(batches, "text"):
            for fold, yes, text in zip(*(b.column(c).to_pylist() for c in ("fold", "toxic", "text")), strict=True):
                words = word_pattern(text).findall(text.lower())
                held.update((p, fold, yes) for p in {p for w in set(words) for p in pieces(w)})
                if len(held) > 500_000:
                    yield flush()
        yield flush()

    parts = picked.mapInArrow(count, "piece string, fold int, toxic long, clean long")
    by_fold = [F.sum(F.when(F.col("fold") == f, F.col(k)).otherwise(0)).alias(f"{k}{f}") for k in ("toxic", "clean") for f in range(FOLDS)]
    counted = parts.groupBy("piece").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"), *by_fold)
    share = n_toxic / (n_toxic + n_clean)
    both = F.col("t") + F.col("c")
    part = lambda n, expected: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / expected)).otherwise(0.0)
    evidence = 2 * (part("t", both * share) + part("c", both * (1 - share)))
    counted = written(counted.withColumn("evidence", evidence).where(F.col("evidence") >= EVIDENT), "pieces")
    rows = counted.orderBy(F.desc("evidence"), "piece").limit(vocab).collect()  # at most vocab

    def without(fold: int | None) -> Scores:
        """The scores, learnt from all folds but one."""
        left = lambda r, k: sum(r[f"{k}{f}"] for f in range(FOLDS) if f != fold)
        yes, no = (max(1, sum(n for (f, t), n in of.items() if t == k and f != fold)) for k in (1, 0))
        return scores_of([(r["piece"], left(r, "toxic"), left(r, "clean")) for r in rows], yes, no)

    parted = [without(f) for f in range(FOLDS)]
    first = spark.sparkContext.broadcast(parted)

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text"):
            got = [first.value[f].mean(t) for f, t in zip(b.column("fold").to_pylist(), b.column("text").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.float64())], ["mean"])

    means = np.zeros(MEANS + 1, np.int64)
    of_clean = picked.where("toxic = 0").mapInArrow(mean, "mean double")
    for r in of_clean.groupBy(F.greatest(F.lit(0), F.ceil(F.col("mean") * MEANS)).alias("bin")).agg(F.count("*").alias("n")).collect():  # at most MEANS + 1
        means[r["bin"]] += r["n"]
    penalty = PENALTY + highest(means, (1 - BELOW) * n_clean) / MEANS
    folds = spark.sparkContext.broadcast([Scores(s.table, penalty) for s in parted])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text"):
            got = [folds.value[f].scan(t) for f, t in zip(b.column("fold").to_pylist(), b.column("text").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array([n for n, _ in got], pa.int64()), pa.array([[s for *_, s in found] for _, found in got], pa.list_(pa.float64()))], ["toxic", "n", "found"])

    scanned = written(picked.mapInArrow(scan, "toxic int, n long, found array<double>"), "scanned")
    clean = scanned.where("toxic = 0")
    size = clean.agg(F.sum("n").alias("n"), F.count("*").alias("docs")).first()
    counts = np.zeros(FINES + 1, np.int64)
    fine = clean.select(F.explode("found").alias("s")).groupBy(F.least(F.lit(FINES), F.floor(F.col("s") / FINE)).alias("bin"))
    for r in fine.agg(F.count("*").alias("n")).collect():  # at most FINES + 1
        counts[r["bin"]] += r["n"]
    decay, scale, least = tail_of(counts, size["docs"], size["n"])
    add = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    over = F.transform("found", lambda s: F.when(s >= least, F.greatest(F.lit(0.0), decay * s - scale - F.log("n"))).otherwise(0.0))
    bins = scanned.select("toxic", F.least(F.lit(BINS), F.floor(add(over) / BIN)).alias("bin")).groupBy("toxic", "bin").agg(F.count("*").alias("n")).collect()  # at most two a bin
    hist = np.zeros((2, BINS + 1))
    for r in bins:
        hist[r["toxic"], r["bin"]] += r["n"]
    return Model(Scores(without(None).table, penalty), decay, scale, least, logistic(np.r_[0.0, np.arange(1, BINS + 1) + 0.5] * BIN, hist[0], hist[1]))


PASSAGES = "array<struct<start: int, end: int, score: double, expected: double>>"


def passages(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, passages of every row: the segments beyond chance by code points, end excluded.

    Null and empty texts and texts without letters have no passages and the score of a text without any; without a model
    every score is 0.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value.judge if shared.value is not None else lambda t: (0.0, [])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
        for b in text_slices(batches, "text"):
            scores, spans = [], []
            for text in b.column("text").to_pylist():
                p, kept = judge(text)
                at = [m.span() for m in word_pattern(text).finditer(text.lower())] if kept else []
                scores.append(p)
                spans.append([{"start": at[i][0], "end": at[j][1], "score": s, "expected": e} for i, j, s, e in kept])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "passages"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, passages {PASSAGES}")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learnt from: crc32 of the id as text is divisible by 5. A null id is not held out (nor ever labelled)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages of every row; nulls, empty texts and tables as in `passages`, repeated rows each for itself."""
    model = fit(docs, labels, ~held_out("id"))
    df = passages(docs, model)
    return df.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
