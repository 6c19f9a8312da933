import datetime as dt
import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from marketlake.operators import book, coverage, macro, panel
from marketlake.sources import readers
from marketlake.streaming import jobs


def test_plan_of_a_window(spark):
    one = spark.createDataFrame([("A",)], "symbol string")
    p = coverage.expected_sources(one, ["klines"], "2026-05-09", "2026-10-09").collect()
    dates = {(r.period, r.date) for r in p}
    assert len(p) == 35 and ("monthly", "2026-06") in dates and ("monthly", "2026-05") not in dates
    assert min(d for k, d in dates if k == "daily") == "2026-05-09" and max(d for k, d in dates if k == "daily") == "2026-10-08"
    with pytest.raises(ValueError):
        coverage.expected_sources(one, ["klines"], "2026-05-09", "2026-05-09")
    assert coverage.month_scope("2026-05-09", "2026-10-09", "2026-06") == ("2026-06-01", "2026-07-01") and coverage.month_scope("2025-05-09", "2026-10-09", "2025-12")[1] == "2026-01-01"


def test_archives_and_checksums(spark, tmp_path):
    for name, text in (("a.zip", "1,2\n3,4\n"), ("b.zip", "x,y\n5,6\n")):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("t.csv", text)
    got = sorted((r.file[-5:], r.row_idx, r.x, r.y) for r in readers.read_archive(spark, str(tmp_path), ["x", "y"]).collect())
    assert got == [("a.zip", 0, "1", "2"), ("a.zip", 1, "3", "4"), ("b.zip", 0, "5", "6")]
    sha = hashlib.sha256((tmp_path / "a.zip").read_bytes()).hexdigest()
    m = spark.createDataFrame([("a.zip", sha), ("b.zip", "0"), ("c.zip", "0")], "name string, sha256 string")
    assert {r.name: r.ok for r in readers.verify_checksums(spark, str(tmp_path), m).collect()} == {"a.zip": True, "b.zip": False, "c.zip": False}


def test_ambiguous_times_give_no_value(spark):
    t = dt.datetime(2024, 1, 1)
    f = spark.createDataFrame([("A", t), ("A", t + dt.timedelta(minutes=5)), ("A", t + dt.timedelta(minutes=10))], "symbol string, open_time timestamp_ntz")
    e = spark.createDataFrame([("A", t, 1.0), ("A", t + dt.timedelta(minutes=5), 2.0), ("A", t + dt.timedelta(minutes=5), 2.0)], "symbol string, event_time_utc timestamp_ntz, v double")
    got = panel.attach_exact(f, e, "v", "oi").orderBy("open_time").collect()
    assert [(r.oi, r.oi_ambiguous) for r in got] == [(1.0, False), (None, True), (None, False)]


def test_book_replay(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    d = lambda seq, s, kind, **p: {"symbol": "A", "session": s, "seq": seq, "type": kind, "payload": p}
    lines = [
        d(1, 1, "diff", U=90, u=95, pu=89, b=[["99", "9"]], a=[]),  # before the snapshot: stale
        d(2, 1, "diff", U=99, u=101, pu=98, b=[["99", "4"]], a=[]),  # bridges
        d(3, 1, "snapshot", lastUpdateId=100, bids=[["99", "2"]], asks=[["101", "3"]]),
        d(4, 1, "diff", U=102, u=102, pu=101, b=[["99", "0"]], a=[]),
        d(5, 1, "diff", U=104, u=104, pu=103, b=[], a=[]),  # a gap
        d(6, 1, "diff", U=105, u=105, pu=104, b=[], a=[]),
        d(7, 2, "snapshot", lastUpdateId=200, bids=[["99", "2"]], asks=[["101", "3"]]),
        d(8, 2, "diff", U=200, u=201, pu=199, b=[["102", "1"]], a=[]),  # crosses
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.jsonl").write_text("\n".join(map(json.dumps, lines)))
    jobs.replay_files(readers.read_envelopes(spark, str(tmp_path / "in"), streaming=True), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.schema(jobs.REPLAYED).parquet(str(tmp_path / "out"))
    assert {r.seq: r.outcome for r in got.collect()} == {1: "stale", 2: "applied", 3: "snapshot", 4: "applied", 5: "gap", 6: "ignored", 7: "snapshot", 8: "gap"}
    r = book.report(got.withColumn("symbol", F.col("symbol"))).first()
    assert (r.events, r.synchronized_events, r.sessions, r.gaps) == (6, 2, 2, 2)


def test_readers_refuse_other_forms(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join("1" * 12) + "\n" + ",".join("1" * 11) + "\n")
    with pytest.raises(Exception, match="not 12 columns"):
        readers.read_candles(spark, str(tmp_path / "a.csv")).collect()
    (tmp_path / "b.csv").write_text(",".join(readers.CANDLE) + "\n" + ",".join("1" * 12) + "\n")
    assert [r.open for r in readers.read_candles(spark, str(tmp_path / "b.csv")).collect()] == [1.0]
    page = '[{"symbol":"A","fundingTime":1,"fundingRate":"0.1"},{"symbol":"%s","fundingTime":2,"fundingRate":"0.2"}]'
    (tmp_path / "p.json").write_text(page % "A")
    assert [r.funding_time for r in readers.read_funding_pages(spark, str(tmp_path / "p.json"), "A").orderBy("funding_time").collect()] == [1, 2]
    (tmp_path / "q.json").write_text(page % "B")
    for name in ("q.json",):
        with pytest.raises(Exception, match="unexpected funding history"):
            readers.read_funding_pages(spark, str(tmp_path / name), "A").collect()
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "GDP.csv").write_text("observation_date,GDP\n2024-01-01,1.5\n2024-02-01,.\n")
    assert [(r.series, r.value) for r in macro.read_series(spark, str(tmp_path / "x" / "*.csv")).orderBy("observation_date").collect()] == [("GDP", 1.5), ("GDP", None)]


def test_tables_and_manifests_are_in_order(spark, tmp_path):
    df = spark.range(200).select(F.concat(F.lit("k"), F.lpad((F.col("id") * 37 % 200).cast("string"), 3, "0")).alias("key"), F.lit("verified").alias("status")).repartition(7)
    readers.write_manifest(df, str(tmp_path / "m"))
    lines = [json.loads(x)["key"] for p in sorted((tmp_path / "m").glob("part-*")) for x in p.read_text().splitlines()]
    assert lines == sorted(lines) and len(lines) == 200
    assert readers.read_manifest(spark, str(tmp_path / "m"), lines=True).count() == 200
    readers.write_table(df, str(tmp_path / "t"), sort_by=["key"])
    keys = [r.key for p in sorted((tmp_path / "t").glob("part-*")) for r in spark.read.parquet(str(p)).collect()]
    assert keys == sorted(keys)


def test_manifest_keeps_the_first_acquisition(spark):
    schema = "key string, status string, etag string, bytes long"
    old = spark.createDataFrame([("a", "verified", "e1", 5), ("b", "verified", "e2", 6)], schema)
    new = spark.createDataFrame([("a", "failed", None, None), ("b", "verified", "e3", 7), ("c", "verified", None, 8)], schema)
    got = {r.key: (r.status, r.etag, r.bytes) for r in coverage.merge_manifests(old, new).collect()}
    assert got == {"a": ("failed", "e1", None), "b": ("verified", "e3", 7), "c": ("verified", None, 8)}
