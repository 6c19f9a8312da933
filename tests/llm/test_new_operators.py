"""Toxic passages, ranked search and centroid clustering against brute-force versions, on nasty rows and empty tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import block_max, elkan, toxicity
from tests.llm.test_operators import DOCS, SCHEMA, TEXT


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), 5, 6, "o", "r", "k", "v", 1, "h") for r in DOCS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# toxicity


def plain_segments(scores, lo=0):
    """The best stretch, then what lies left and right of it."""
    best, at = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-9:
                best, at = total, (i, j)
    if at is None:
        return []
    i, j = at
    return plain_segments(scores[:i], lo) + [(lo + i, lo + j, best)] + plain_segments(scores[j + 1 :], lo + j + 1)


def test_segments_by_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(0, 25)
        raw = [rng.choice([0, 0, 0, 1.37, 2.71, -0.83, -2.19, 0.31]) + (rng.random() / 1000 if rng.random() < 0.5 else 0) for _ in range(n)]
        raw = [0 if rng.random() < 0.4 else x for x in raw]
        at = [i for i, x in enumerate(raw) if x]
        got = toxicity.segments(at, [raw[i] for i in at], 0.25)
        want = plain_segments([x - 0.25 for x in raw])
        assert [x[:2] for x in got] == [x[:2] for x in want] and np.allclose([x[2] for x in got], [x[2] for x in want])


def test_segments_are_linear():
    n = 200_000
    got = toxicity.segments(list(range(n)), [1.0 if i % 2 else -1.2 for i in range(n)], 0.1)
    assert len(got) == n // 2


def planted(n=600):
    """Documents with insults that only toxic ones hold, some labels missing, and their true labels."""
    rng = random.Random(1)
    vocab = ["".join(rng.choice("aeioumnrst") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    bad = ["wretch", "vermin", "blaggard", "wretched", "ölkopf"]
    rows, truth = [], {}
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(20, 200))]
        truth[i] = int(i % 5 == 0)
        if truth[i]:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", ",", "!"]))
        rows.append((i, " ".join(w)))
    return rows, truth


def test_toxicity_finds_what_is_planted(spark):
    rows, truth = planted()
    docs = spark.createDataFrame(rows + rows[:50], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, t) for i, t in truth.items() if i % 3] + [(1, None), (None, 1), (2, 0), (2, 1)], "doc_id long, toxic int")
    got = toxicity.report(docs, labels).collect()
    assert len(got) == 650 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    unseen = [r for r in got if r.held_out or not r.doc_id % 3]
    assert sum(r.predicted != truth[r.doc_id] for r in unseen) <= 2 and all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    model = toxicity.fit(docs, labels, ~toxicity.held_out("id"))
    p = {r.doc_id: r for r in toxicity.passages(docs.limit(40), model).collect()}
    text = dict(rows)
    for i, r in p.items():
        assert bool(r.passages) == bool(truth[i])
        assert all(re.search("wretch|vermin|blaggard|ölkopf", text[i][s.start : s.end]) and s.expected < 1 for s in r.passages)


def test_toxicity_of_long_texts_of_a_language_that_is_toxic_more_often(spark):
    """Everyday words that tell a little about the label stand in every text of their language, in long ones many times."""
    rng = random.Random(3)
    everyday = ["".join(rng.choice("aeioumnrst") for _ in range(rng.randint(2, 6))) for _ in range(120)]
    rows, truth = [], {}
    for i in range(1500):
        own = everyday[:60] if i % 2 else everyday[60:]
        w = [rng.choice(own) for _ in range(rng.choice([30, 200, 1500]))]
        truth[i] = int(rng.random() < (0.3 if i % 2 else 0.03))
        if truth[i]:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["wretch", "vermin", "blaggard"]))
        rows.append((i, " ".join(w)))
    labels = spark.createDataFrame(list(truth.items()), "doc_id long, toxic int")
    got = [r for r in toxicity.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), labels).collect() if r.held_out]
    yes, no = ([r for r in got if truth[r.doc_id] == k] for k in (1, 0))
    ahead = lambda of: sum((of(y) > of(n)) + (of(y) == of(n)) / 2 for y in yes for n in no) / len(yes) / len(no)
    assert len(yes) > 30 and ahead(lambda r: r.score) > 0.99 and ahead(lambda r: r.n_passages) > 0.95
    assert sum(r.predicted for r in no) <= 0.02 * len(no) and sum(r.predicted for r in yes) >= 0.95 * len(yes)


def test_repeated_words_tell_less():
    s = toxicity.Scores({"ha": 1.0, "vermin": 6.0}, 0.1)
    assert s.scan("ha " * 400)[1][0][2] < 3 and s.scan("vermin vermin x")[1] == [(0, 1, 6.0 + 3.0 - 0.2)]
    assert s.mean("vermin x x x") == 0.25 and s.mean(None) == s.mean("") == 0


def test_tail_of_chance_scores():
    """Of one exponential tail that is cut off anywhere, decay and scale come back; a few wrong labels move them little."""
    rng = np.random.default_rng(1)
    s = rng.exponential(1 / 1.7, 40_000)
    for wrong in (0, 20):
        at = np.minimum(np.r_[s, np.full(wrong, 60.0)] // toxicity.FINE, toxicity.FINES).astype(int)
        decay, scale, least = toxicity.tail_of(np.bincount(at, minlength=toxicity.FINES + 1), 10_000, 1_000_000)
        assert abs(decay - 1.7) < 0.2 and 1.5 < least < 1.7 and abs(scale - math.log(40_000 / 1_000_000)) < 0.3
    assert toxicity.tail_of(np.zeros(toxicity.FINES + 1, int), 5, 0) == (1.0, 0.0, 0.0)


def test_toxicity_scores_do_not_see_held_out_labels(spark):
    rows, truth = planted(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    a, b = (spark.createDataFrame([(i, (1 - t) if flip and out(i) else t) for i, t in truth.items()], "doc_id long, toxic int") for flip in (False, True))
    assert sorted(map(tuple, toxicity.report(docs, a).collect())) == sorted(map(tuple, toxicity.report(docs, b).collect()))


def test_toxicity_nasty_rows(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (7, 0), (9, 1), (10, 0)], "doc_id long, toxic int")
    got = toxicity.report(docs, labels).collect()
    assert len(got) == len(DOCS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (4, 5, 6)}) == 1  # null, empty and blank texts
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.report(docs, one).collect()} == {0.0}
    assert {r.predicted for r in toxicity.report(docs, labels.limit(0)).collect()} == {0} and toxicity.report(none, labels).count() == 0


def test_words_of_any_script_and_length():
    assert toxicity.word_pattern("漢字").findall("漢字ab c1d") == ["漢", "字", "ab", "c", "d"]
    assert toxicity.word_pattern("x").findall("éa it's") == ["éa", "it", "s"]
    s = toxicity.Scores({toxicity.short("z" * 90): 2.0, "vermi*": 1.0}, 0.1)
    assert s["z" * 90] == 2.0 and s["z" * 91] == 0.0 and s["verminous"] == 1.0 and s["vermi"] == 0.0


# search


def plain_search(rows, queries, k=10):
    find = lambda t: re.findall("[0-9a-z\u0080-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    docs = [(i, w) for i, t in rows if (w := find(t))]
    n_docs, n_terms = len(docs), sum(len(w) for _, w in docs)
    df = {}
    for _, w in docs:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    items = {}
    for i, t in queries:
        items.setdefault(i, set()).update(find(t))
    out = []
    for item, terms in items.items():
        found = []
        for i, w in docs:
            m = 10 + 90 * len(w) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 8 * m)) for t in terms if (tf := w.count(t)))
            if s > 0:
                found.append((-s, i is not None, i or 0))
        out += [(item, r, i if real else None, -s) for r, (s, real, i) in enumerate(sorted(found)[:k], 1)]
    return out


key = lambda rows: sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("shard", [1, 600, 8 << 20])
def test_search_by_brute_force(spark, docs, shard):
    queries = [(1, "The CAT and a road"), (1, "home 漢字"), (2, "ab12cd34ef56ab78cd w3x4"), (2, "ab12cd34ef56ab78cd w3x4"), (3, None), (4, "  "), (None, "one é"), (5, "nothing-here"), (6, TEXT)]
    q = spark.createDataFrame([(*r, "x") for r in queries], "item_id long, text string, term string")
    got = block_max.search(block_max.build(docs, shard_bytes=shard), q, k=3).select("item_id", "rank", "doc_id", "score").collect()
    assert key(got) == key(plain_search([r[:2] for r in DOCS], queries, 3))


def test_search_many_documents_and_blocks_of_queries(spark, monkeypatch):
    rng = random.Random(3)
    vocab = [f"t{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    rows = [(rng.randrange(10**6), " ".join(rng.choices(vocab, k=rng.randint(1, 60)))) for _ in range(2500)]
    queries = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 30)))) for i in range(40)]
    docs, q = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(queries, "item_id long, text string")
    want = key(plain_search(rows, queries))
    assert key(block_max.report(docs, q).select("item_id", "rank", "doc_id", "score").collect()) == want
    monkeypatch.setattr(block_max, "QUERY_BYTES", 2000)
    monkeypatch.setattr(block_max, "BLOCK", 128)
    assert key(block_max.report(docs, q).select("item_id", "rank", "doc_id", "score").collect()) == want


def test_blocks_round_trip_and_stay_closed():
    rng = np.random.default_rng(0)
    n_docs = 200_000
    m = rng.integers(10, 400, n_docs)
    lists = [np.sort(rng.choice(n_docs, size, replace=False)) for size in (15, 1, 127, 128, 129, 5000, 50_000)]
    tf = [rng.integers(1, 3, len(x)) for x in lists]
    tf[1][0], tf[4][5], tf[5][17] = 70_000, 300, 900
    starts = np.cumsum([0] + [len(x) for x in lists[:-1]])
    skips, first, data, byte = block_max.pack(np.concatenate(lists), np.concatenate(tf), m, starts)
    ends, bytes_ = np.r_[first[1:], len(skips)], np.r_[byte[1:], len(data)]
    made = lambda: [block_max.Postings(len(x), skips[a:b].tobytes(), data[c:d].tobytes(), m) for x, a, b, c, d in zip(lists, first, ends, byte, bytes_, strict=True)]
    for p, x, t in zip(made(), lists, tf, strict=True):
        docs, impacts = p.read(np.arange(len(p.open)))
        assert (docs == x).all() and (impacts == block_max.impact(t, m[x])).all()
    fresh = made()
    weights = [9000, 50, 50, 50, 50, 40, 1]
    score = np.zeros(n_docs, np.int64)
    for w, x, t in zip(weights, lists, tf, strict=True):
        score[x] += w * block_max.impact(t, m[x])
    order = np.lexsort((np.arange(n_docs), -score))[:10]
    assert block_max.best(list(zip(weights, fresh, strict=True)), n_docs, 10) == [(int(d), int(score[d])) for d in order]
    assert sum(p.open.sum() for p in fresh) < sum(len(p.open) for p in fresh) / 2


def test_search_empty_tables(spark, docs, none):
    q = spark.createDataFrame([(1, "the cat")], "item_id long, text string")
    assert block_max.report(none, q).count() == 0 and block_max.report(docs, q.limit(0)).count() == 0


# clustering


def plain_clusters(rows, k, rounds, size):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [list(v) for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x, strict=True)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        c = [[sum(col) // len(mine) for col in zip(*mine, strict=True)] if (mine := [v for (_, v), o in zip(kept, of, strict=True) if o == j]) else c[j] for j in range(len(c))]
    last = [(i, *near(v)) for i, v in kept]
    per = [sum(d for _, d, j in last if j == x) for x in range(len(c))]
    fits = lambda v: v if v < 1 << 63 else None
    return [(i, j, fits(d), fits(per[j]), fits(sum(per)), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in last]


NASTY = [(None, [0.5, 0.25, 1.0]), (1, None), (2, [1.0, None, 2.0]), (3, [1.0, float("nan"), 2.0]), (4, [1.0, float("-inf"), 2.0]), (5, [1.0, 2.0]), (6, []), (7, [0.0, 0.0, 0.0]), (7, [0.0, 0.0, 0.0]), (8, [-0.0001, 0.0001, 0.0])]


@pytest.mark.parametrize("unit,block", [(0.001, 7), (1.0, 4096), (1e9, 50), (1e30, 50)])
def test_clusters_by_brute_force(spark, unit, block, monkeypatch):
    """Few different values make many ties; large units go beyond 64 bits."""
    rng = random.Random(block)
    rows = NASTY + [(100 + i % 180, [rng.randint(-4, 4) * unit for _ in range(3)]) for i in range(200)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, cluster int").repartition(3)
    monkeypatch.setattr(elkan, "BLOCK", block)
    got = elkan.report(df, k=5, rounds=4, size=3)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert key(got.collect()) == key(plain_clusters(rows, 5, 4, 3))


def test_bounds_save_distances_and_change_nothing(spark):
    rng = np.random.default_rng(2)
    hubs = rng.normal(size=(8, 64))
    rows = [(i, (hubs[i % 8] + 0.05 * rng.normal(size=64)).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    assert key(elkan.report(df).collect()) == key(plain_clusters(rows, 8, 10, 64))
    blocks, _ = elkan.cluster(df)
    n, computed = blocks.agg(F.sum("n"), F.sum("computed")).first()
    assert n == 1500 and computed < 2 * n  # of 8 n


def test_assign_on_equal_distances():
    c = elkan.Centroids([[0, 0], [2, 0], [0, 2], [1, 1]])
    x = np.array([[1, 0], [1, 1], [0, 1], [2, 2], [1, 0]])
    of, upper, lower = np.full(5, 3, np.int32), np.full(5, np.inf), np.zeros((5, 4))
    elkan.assign(x, c, of, upper, lower)
    want = [min(((v - w) @ (v - w), j) for j, w in enumerate(c.rows))[1] for v in x]
    assert of.tolist() == want


def test_clusters_of_few_or_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert elkan.report(empty).count() == 0
    few = spark.createDataFrame([(1, [0.5] * 64), (2, [0.25] * 64), (3, [1.0])], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id, r.distance) for r in elkan.report(few).collect()) == [(1, 0), (2, 0)]


