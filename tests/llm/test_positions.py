"""Positions of a mix against a plain inverse of the integrated schedule, found by halving."""

import collections

import pytest
from pyspark.sql import functions as F

from marketlake.llm import mixing
from tests.llm.test_operators import words


def when(share, w0, w1):
    """The time by which a straight schedule from w0 to w1 has asked for this share of its words."""
    low, high = 0.0, 1.0
    for _ in range(80):
        t = (low + high) / 2
        if (w0 * t + (w1 - w0) * t * t / 2) / ((w0 + w1) / 2) < share:
            low = t
        else:
            high = t
    return low


def test_positions_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "source", "text", F.xxhash64("doc_id", "text").alias("h")).collect()
    got = {r.doc_id: r for r in mixing.report(docs).collect()}
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    placed = 0
    for i, s in enumerate(names):
        before = 0
        for r in sorted(by[s], key=lambda r: (r.h % mixing.PARTS, r.h)):
            size, one = len(words(r.text)), got[r.doc_id]
            if one.taken:
                assert one.position == pytest.approx(when(min(1.0, (before + size / 2) / one.target), *mixing.TILT[i % 3]), abs=1e-9)
                placed += 1
            elif size:
                assert one.position is None
            before += size
    assert placed > 100
    order = [r.position for r in mixing.report(docs).collect() if r.position is not None]
    assert order == sorted(order)
