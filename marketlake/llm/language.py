"""Language identification by string kernels: presence of n-grams, Nyström landmarks, one-versus-rest kernel ridge.

The kernel of two texts is the number of different n-grams (of 1 to 4 characters: the blended spectrum, by presence) that
both hold, over the geometric mean of their own numbers. n-grams are told apart by 64 bits and kept as sparse sets, so long
texts and large alphabets do not become alike. The n-grams of the landmarks are a sorted list with a bit for each landmark;
a text's n-grams are looked up there, and the counts of common ones times the solved weights are its scores.

The fit takes at most `per_lang` rows of each language (those with the smallest hashes) and only of `max_langs` languages,
the most frequent. Tasks add their rows up to the normal equations (a number for each pair of landmarks, and for each
landmark and language), Spark adds the tasks' sums, and the driver solves those: what it holds depends on the numbers of
landmarks and languages, not on texts, but for the n-grams of the landmarks themselves, 8 bytes each and a bit a landmark.
Landmarks are the first rows of every language, those of at most LONGEST characters before longer ones. Every text is
scored whole, in one narrow pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import text_slices, written

ORDERS = (1, 2, 3, 4)
UNKNOWN = "und"
#: Longer texts are landmarks only where a language has no others; they are learnt from and scored like all.
LONGEST = 100_000
#: n-grams of a text whose landmark bits are unpacked at a time.
CHUNK = 255 * 128


def presence(text: str) -> np.ndarray:
    """64-bit ids of the different n-grams that a text holds; white space and digits count as one mark, letters as lower case."""
    code = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.uint64)
    code = np.where((code < 65) | ((code > 90) & (code < 97)), 32, code)
    if len(code) > 1:  # runs of marks are one
        code = code[np.r_[True, (code[1:] != 32) | (code[:-1] != 32)]]
    found = [np.zeros(0, np.uint64)]
    h = np.zeros(len(code), np.uint64)
    for n in ORDERS:
        if len(code) < n:
            break
        h = (h[: len(code) - n + 1] * np.uint64(0x100000001B3) + code[n - 1 :] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        ids = np.sort(h)
        found.append(ids[np.r_[True, ids[1:] != ids[:-1]]])
    return np.concatenate(found)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Landmarks:
    """The n-grams of some texts, sorted, with a bit for each text that holds them."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets], np.float64)
        self.ids = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]))
        self.bits = np.zeros((len(self.ids), (len(sets) + 7) // 8), np.uint8)
        for k, x in enumerate(sets):
            self.bits[np.searchsorted(self.ids, x), k // 8] |= np.uint8(128 >> k % 8)

    def kernel(self, ids: np.ndarray) -> np.ndarray:
        """The kernel of a text, given by the ids of its n-grams, with each landmark."""
        return self.kernels([ids])[0]

    def kernels(self, sets: list[np.ndarray]) -> np.ndarray:
        """The kernel of each of some texts, given by the ids of their n-grams, with each landmark: a row a text.

        The sets are looked up as one array. A product of landmark bits is a gather of bytes: rows of bits are added up in
        blocks of 255, as many as a byte can count, and CHUNK rows at a time, whatever the texts' lengths.
        """
        common = np.zeros((len(sets), len(self.sizes)), np.int64)
        sizes = np.array([len(x) for x in sets])
        if len(self.ids) and sizes.sum():
            ids = np.concatenate(sets)
            at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
            known = self.ids[at] == ids
            ends = np.r_[0, np.cumsum(known)][np.cumsum(sizes)]
            at = at[known]
            for i, (x, y) in enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True)):
                for j in range(x, y, CHUNK):
                    rows = self.bits[at[j : min(j + CHUNK, y)]]
                    whole = len(rows) // 255 * 255
                    count = np.unpackbits(rows[:whole], axis=1, count=len(self.sizes)).reshape(-1, 255, len(self.sizes)).sum(axis=1, dtype=np.uint8)
                    common[i] += count.sum(axis=0, dtype=np.int64) + np.unpackbits(rows[whole:], axis=1, count=len(self.sizes)).sum(axis=0, dtype=np.int64)
        return common / np.sqrt(np.maximum(sizes, 1)[:, None] * self.sizes)


class Model:
    def __init__(self, langs: list[str], marks: Landmarks, weights: np.ndarray):
        self.langs, self.marks, self.weights = langs, marks, weights

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language of each text, and how sure: the softmax of the scores, 0 where there is nothing to go by."""
        names, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return names, sure
        told = [i for i, t in enumerate(texts) if has_letter(t)]
        if told:
            score = self.marks.kernels([presence(texts[i]) for i in told]) @ self.weights  # texts by landmarks, landmarks by languages
            p = np.exp(4 * (score - score.max(axis=1, keepdims=True)))
            best = score.argmax(axis=1)
            sure[told] = p[np.arange(len(told)), best] / p.sum(axis=1)
            for i, k in zip(told, best, strict=True):
                names[i] = self.langs[k]
        return names, sure


def solve(gram: np.ndarray, sides: np.ndarray, inner: np.ndarray, names: list[str], rows: int, marks: Landmarks, ridge: float = 1e-3) -> Model:
    """Kernel ridge on Nyström features, one language against the rest.

    gram: the sum over all rows of weight * k k', k being a row's kernel with the landmarks; sides: for each language the
    sum of weight * k * (1 for its rows, -1 for others); inner: the kernel of the landmarks themselves.
    """
    if not names:
        return Model([], marks, np.zeros((0, 0)))
    return Model(names, marks, np.linalg.lstsq(gram + ridge * rows * inner + 1e-9 * np.eye(len(inner)), sides.T, rcond=None)[0])


def fit(docs: DataFrame, learn: Column, per_lang: int = 500, max_langs: int = 200, n_landmarks: int = 256, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from rows where `learn` holds, the language is known and the text has a letter; landmarks are spread over the languages.

    Equal rows (id, language and text) count as one. Every language weighs the same, however many rows it has.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), learn.alias("learn"))
    rows = own.where("learn and lang is not null").where(F.col("text").rlike(r"\p{L}")).withColumns({"key": F.xxhash64("id", "text"), "long": F.length("text") > LONGEST})
    few = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs)
    # keys alone are ranked: equal rows are folded and each partition keeps its first per_lang of a language before the shuffle
    w = Window.partitionBy("lang").orderBy("long", "key")
    ranked = rows.select("lang", "long", "key").distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= per_lang)
    chosen = ranked.join(F.broadcast(few.select("lang")), "lang", "left_semi").select("lang", "key", "rank")  # at most per_lang * max_langs
    picked = rows.join(F.broadcast(chosen), ["lang", "key"]).dropDuplicates(["lang", "rank"]).select("lang", "rank", "text")
    picked = written(picked, "picked")
    sizes = {r["lang"]: r["n"] for r in picked.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    names, n = sorted(sizes), sum(sizes.values())
    if not names:
        return solve(np.zeros((0, 0)), np.zeros((0, 0)), np.zeros((0, 0)), [], 0, Landmarks([]))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("rank"), b.column("lang"), pa.array([presence(t).tobytes() for t in b.column("text").to_pylist()], pa.binary())], ["rank", "lang", "grams"])

    first = picked.orderBy("rank", "lang").limit(n_landmarks).mapInArrow(sets, "rank int, lang string, grams binary").toPandas().sort_values(["rank", "lang"])
    grams = [np.frombuffer(x, np.uint64) for x in first["grams"]]
    marks = Landmarks(grams)
    inner = marks.kernels(grams)
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    weight = {lang: n / (len(names) * size) for lang, size in sizes.items()}
    width = len(grams)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Row i of the Gram matrix, or (place width + j) the sum of the rows of language j."""
        gram, of = np.zeros((width, width)), np.zeros((len(names), width))
        for b in text_slices(batches, "text"):
            langs = b.column("lang").to_pylist()
            k = shared.value.kernels([presence(t) for t in b.column("text").to_pylist()])
            scale = np.array([weight[x] for x in langs])[:, None]
            gram += k.T @ (scale * k)
            np.add.at(of, [names.index(x) for x in langs], scale * k)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + len(names)), pa.int32()), pa.array([*gram.tolist(), *of.tolist()], pa.list_(pa.float64()))], ["place", "values"])

    parts = picked.select("lang", "text").mapInArrow(sums, "place int, values array<double>").select("place", F.posexplode("values").alias("at", "x"))
    total = parts.groupBy("place", "at").agg(F.sum("x").alias("x")).groupBy("place").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v"))  # a number a landmark
    got = np.array([r["x"] for r in total.orderBy("place").select(F.col("v.x").alias("x")).collect()])  # landmarks and languages
    gram, of = got[:width], got[width:]
    return solve(gram, 2 * of - of.sum(axis=0), inner, names, n, marks)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score of every row. A null text or one without a letter is 'und' with score 0; so is any if nothing was learnt."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text"):
            names, sure = shared.value.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names, pa.string()), pa.array(sure, pa.float64())], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learnt from: crc32 of the id as text leaves 2 when divided by 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learnt from the rows that are not held out. Nulls, empty texts and tables as in `predict`."""
    model = fit(docs, ~held_out())
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
