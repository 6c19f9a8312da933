"""The pipeline against a plain version of each stage's decisions, and on nasty rows."""

import collections
import re
from fractions import Fraction

from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm.queries import tokenizer_file
from tests.llm.test_operators import brute_components, brute_kept, grams, words


def mixed_times(rows, order):
    """How often each row of (id, text, source) comes: whole rounds of its source, then those first in the order, up to the rest."""
    size = {k: len(words(t)) for k, t, _ in rows}
    of = collections.Counter()
    for k, _, s in rows:
        of[s] += size[k]
    names = sorted(of, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    want, left, open_ = {}, float(sum(size.values())), set(names)
    while open_:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 3 * of[s]}
        want |= {s: 3.0 * of[s] if s in over else left * weight[s] / w for s in over or open_}
        left -= sum(want[s] for s in over)
        open_ = open_ - over if over else set()
    times = {}
    for s in names:
        full = int(want[s] // of[s])
        rest, before = want[s] - full * of[s], 0
        for k in sorted((k for k, _, x in rows if x == s), key=lambda k: (order[k] % 4096, order[k])):
            times[k] = full + (before + size[k] / 2 <= rest)
            before += size[k]
    return {k: n for k, n in times.items() if n}


def test_against_plain_decisions(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df, seen = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, "")
        assert df.schema == docs.schema
        seen.append(df.collect())
    good, single, clean, mix = seen
    kept = brute_kept([(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()])
    assert sorted(r.doc_id for r in good) == sorted(k for k, v in kept.items() if v)
    sets = {r.doc_id: grams(r.text, 5) for r in good}
    groups = brute_components(sets, lambda a, b: bool(a and b) and Fraction(len(a & b), len(a | b)) >= Fraction(4, 5))
    assert sorted(r.doc_id for r in single) == sorted(k for k, v in groups.items() if k == v)
    planted = re.compile(r'((?i:token) = ")[0-9a-fA-F]{40}')
    assert {r.doc_id: r.text for r in clean} == {r.doc_id: planted.sub(r"\1[secret]", r.text) for r in single}
    assert any("[secret]" in r.text for r in clean) or not any(planted.search(r.text) for r in single)
    made = spark.createDataFrame([(r.doc_id, r.text) for r in clean], "doc_id long, text string")
    order = {r.doc_id: r.h for r in made.select("doc_id", F.xxhash64("doc_id", "text").alias("h")).collect()}
    assert collections.Counter(r.doc_id for r in mix) == mixed_times([(r.doc_id, r.text, r.source) for r in clean], order)
    lib = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    last = corpus_pipeline.STAGES[-1][1](spark, df, "").collect()
    text = {r.doc_id: r.text for r in mix}
    assert len(last) == len(mix)
    for r in last:
        ids = lib.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == lib.decode(ids, skip_special_tokens=False)


def test_nasty_rows_end_to_end(spark, tmp_path):
    """Nulls everywhere, repeated rows, a long text, and columns named like the stages' own; then an empty table."""
    prose = [" ".join(f"w{(i * 7 + j * j) % 211}a{j % (i + 3)}" for j in range(120 + i)) for i in range(30)]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else "web", len(t)) for i, t in enumerate(prose)] * 2
    rows += [(None, prose[0], None, None, None), (50, None, "en", "web", 0), (51, "", None, None, None), (52, " ".join(prose), "en", "web", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, key long, `values` string, q_row int, sieve_at int, node long, position double"
    df = spark.createDataFrame([(*r, "r", 1, "v", 2, 3, 4, 0.5) for r in rows], schema)
    for name, table in (("full", df), ("none", df.limit(0))):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        got = corpus_pipeline.run(spark, str(tmp_path / name))
        assert got.columns == ["doc_id", "ids", "decoded"]
        assert (got.count() > 0) == (name == "full")
