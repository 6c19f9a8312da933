"""Archives and digests as streams, replacement of tables, reasons of all categories, funding by look-ups."""

import datetime as dt
import hashlib
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from marketlake.operators import bars, costs, coverage, features, macro, panel, quality, trades
from marketlake.sources import archive, layout, readers


def test_archive_source(spark, tmp_path):
    for name, text in (("a.zip", "1,2\n3,4\n"), ("b.zip", "x,y\n5,6\n"), ("c.zip", "x,y\n")):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("t.csv", text)
    (tmp_path / "readme.txt").write_text("no archive")
    df = readers.read_archive(spark, str(tmp_path), ["x", "y"])
    assert df.rdd.getNumPartitions() == 3  # one an archive
    got = sorted((r.file[-5:], r.row_idx, r.x, r.y) for r in df.collect())
    assert got == [("a.zip", 0, "1", "2"), ("a.zip", 1, "3", "4"), ("b.zip", 0, "5", "6")]
    assert readers.read_archive(spark, str(tmp_path), ["x", "y"], first=1).count() == 2
    assert readers.read_archive(spark, f"file://{tmp_path}/a*.zip", ["x", "y"]).count() == 2
    assert readers.read_archive(spark, str(tmp_path / "a.zip"), ["x", "y"]).count() == 2
    with pytest.raises(Exception, match="2 columns, expected 3"):
        readers.read_archive(spark, str(tmp_path), ["x", "y", "z"]).collect()
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("t.csv", "1,2\n")
        z.writestr("u.csv", "1,2\n")
    with pytest.raises(Exception, match="one CSV expected"):
        readers.read_archive(spark, str(tmp_path), ["x", "y"]).collect()
    with pytest.raises(Exception, match="no archives"):
        readers.read_archive(spark, str(tmp_path / "none*.zip"), ["x", "y"]).collect()


def test_archive_is_left_at_the_first_rows(tmp_path):
    """Batches come while the file is read: 10 MB of rows need a few batches' memory, and the first rows less still."""
    import tracemalloc

    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("t.csv", "w") as f:
        for i in range(4):
            f.write(b"".join(b"%d,%020d\n" % (i, j) for j in range(100_000)))
    reader = archive.ArchiveReader({"path": str(tmp_path / "big.zip"), "columns": "x,y"})
    (part,) = reader.partitions()
    tracemalloc.start()
    n = sum(len(b) for b in reader.read(part))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 400_000 and peak < 40 << 20
    reader.first = 10
    assert sum(len(b) for b in reader.read(part)) == 10


def test_digest_of_a_file_over_two_gigabytes(spark, tmp_path):
    size = (2 << 30) + 12345
    with open(tmp_path / "big.bin", "wb") as f:
        f.truncate(size)
        f.seek(size - 1)
        f.write(b"x")
    (tmp_path / "small.bin").write_bytes(b"abc")
    h = hashlib.sha256()
    for _ in range(size // (1 << 20)):
        h.update(bytes(1 << 20))
    h.update(bytes(12344) + b"x")
    manifest = spark.createDataFrame([("big.bin", h.hexdigest()), ("small.bin", "0"), ("gone.bin", "0")], "name string, sha256 string")
    assert {r.name: r.ok for r in readers.verify_checksums(spark, str(tmp_path), manifest).collect()} == {"big.bin": True, "small.bin": False, "gone.bin": False}
    assert {os.path.basename(r.path): r.bytes for r in readers.file_inventory(spark, str(tmp_path)).collect()} == {"big.bin": size, "small.bin": 3}


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_a_failing_write_leaves_the_old_table(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    good = spark.range(10).select(F.col("id").cast("string").alias("x"))
    readers.write_table(good, path, fmt=fmt)
    broken = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("torn"))).otherwise(F.col("id").cast("string")).cast("string").alias("x"))
    with pytest.raises(Exception, match="torn"):
        readers.write_table(broken, path, fmt=fmt)
    read = lambda: spark.read.format(fmt).option("header", True).schema("x string").load(path).count()
    assert read() == 10 and [p.name for p in tmp_path.iterdir()] == ["t"]
    readers.write_table(good.limit(3), path, fmt=fmt)
    assert read() == 3 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_failing_write_leaves_the_old_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    readers.write_table(spark.range(10).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("torn"))).otherwise(F.col("id").cast("string")).cast("long").alias("id"), (F.col("id") % 2).alias("p"))
    with pytest.raises(Exception, match="torn"):
        readers.write_table(broken, path, partition_by=["p"])
    assert spark.read.parquet(path).count() == 10
    readers.write_table(spark.range(3).withColumn("p", F.lit(1)), path, partition_by=["p"])
    assert spark.read.parquet(path).count() == 8


def test_a_failing_swap_is_taken_back(spark, tmp_path):
    path = str(tmp_path / "t")
    readers.write_table(spark.range(10), path)
    with pytest.raises(OSError, match="could not be replaced"), readers.replacing(spark, path):
        pass  # nothing was staged
    assert spark.read.parquet(path).count() == 10


def test_reports_come_in_order(spark, tmp_path):
    readers.write_report(spark.createDataFrame([("b", 1), ("a", 2), ("a", 1)], "k string, n int").repartition(3), str(tmp_path / "r"))
    lines = [x for p in (tmp_path / "r").glob("part-*") for x in p.read_text().split()]
    assert lines == ['{"k":"a","n":1}', '{"k":"a","n":2}', '{"k":"b","n":1}']


def test_every_broken_rule_of_a_file_is_told(spark):
    m = spark.createDataFrame([("m1", "A", 1.0, 2.0), ("m1", "B", -1.0, float("nan")), ("m2", "A", 1.0, 1.0)], "file string, symbol string, sum_open_interest double, sum_open_interest_value double")
    d = spark.createDataFrame([("d1", -1.0, 1.0), ("d1", None, 1.0), ("d2", 0.0, 0.0)], "file string, depth double, notional double")
    f = spark.createDataFrame([("f1", 5, float("inf")), ("f1", None, 0.1), ("f2", 1, 0.1)], "file string, calc_time long, last_funding_rate double")
    t = spark.createDataFrame([("t1", 0, 5, 1.0, 1.0, 1, "true"), ("t1", 1, 5, -1.0, 1.0, 2, "maybe"), ("t1", 2, 1, -1.0, 1.0, 2, "true")], "file string, row_idx long, id long, price double, qty double, time long, is_buyer_maker string")
    heads = spark.createDataFrame([("m1", "metrics", ["symbol", "create_time"]), ("m2", "metrics", list(quality.REQUIRED["metrics"])), ("k1", "klines", [])], "file string, category string, columns array<string>")
    sums = spark.createDataFrame([("m1", "p", False), ("m2", "p", True), ("gone", None, False)], "name string, path string, ok boolean")
    found = quality.file_reasons(
        quality.row_findings(m, "metrics", F.lit("A")), quality.row_findings(d, "bookDepth"), quality.row_findings(f, "fundingRate"), quality.row_findings(t, "trades", first=2), quality.schema_findings(heads), quality.checksum_findings(sums)
    )
    assert {r.file: r.broken for r in found.collect()} == {
        "m1": {"other_symbol": 1, "negative_open_interest": 1, "open_interest_not_finite": 1, "missing_column:sum_open_interest": 1, "missing_column:sum_open_interest_value": 1, "checksum_changed": 1},
        "d1": {"negative_depth": 1}, "f1": {"funding_rate_not_finite": 1, "funding_time_missing": 1}, "gone": {"file_missing": 1},
        "t1": {"invalid_sampled_trade": 1, "invalid_sampled_ids": 1, "invalid_sampled_maker_side": 1},
    }
    assert quality.quarantine(m, found).select("file").collect() == [("m2",)]
    assert found.where("file = 'f1'").select(quality.reason_text(F.col("broken"))).first()[0] == "funding_rate_not_finite=1, funding_time_missing=1"


@pytest.mark.parametrize("seed", range(3))
def test_funding_by_brute_force(spark, seed):
    rng = random.Random(seed)
    t = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=8 * rng.randint(0, 900))
    paid = sorted({(s, t()) for s in "AB" for _ in range(80)} if seed else [])
    funding = [(s, at, rng.randint(-50, 50) / 10_000) for s, at in paid if s == "A" or dt.datetime(2024, 4, 1) <= at < dt.datetime(2024, 6, 1)]
    positions = [(i, rng.choice("ABC"), t(), t(), float(rng.randint(1, 1000)), rng.choice(["long", "short"])) for i in range(300)] + [(999, "A", None, t(), 1.0, "long")]
    schema = "position_id long, symbol string, entry timestamp_ntz, exit timestamp_ntz, notional double, side string"
    f = spark.createDataFrame(funding, "symbol string, paid_at timestamp_ntz, rate double")
    df = costs.funding_paid(spark.createDataFrame(positions, schema), f)
    got = {r.position_id: (r.payments, round(r.paid, 8)) for r in df.collect()}
    want = {}
    for i, s, a, b, n, side in positions:
        hit = [r for x, at, r in funding if x == s and a is not None and a < at <= b]
        want[i] = (len(hit), round(sum((-1 if side == "long" else 1) * n * r for r in hit), 8) + 0.0)
    assert got == want and df.count() == len(positions)


def test_macro_records_come_back_whole(spark):
    old = spark.createDataFrame([("a", "acquired", True, 5, "e1"), ("b", "acquired", False, 6, None), ("gone", "acquired", True, 1, None)], "series string, status string, bytes_match boolean, rows long, etag string")
    new = spark.createDataFrame([("a", "failed", None, "timeout"), ("b", "failed", None, "404"), ("c", "acquired", 9, None)], "series string, status string, rows long, error string")
    got = {r.series: r.asDict() for r in macro.merge_sources(old, new).collect()}
    assert got["a"] == {"series": "a", "status": "acquired", "rows": 5, "etag": "e1", "resumed_from_initial_release": True, "new_fetch_error": "timeout"}
    assert (got["b"]["status"], got["b"]["resumed_from_initial_release"], got["b"]["etag"]) == ("failed", False, None) and set(got) == {"a", "b", "c"}


def test_partitions_of_changed_files_have_failed(spark):
    results = spark.createDataFrame([("a", "audited_all_rows"), ("b", "audited_all_rows"), ("c", "failed"), ("d", "audited_all_rows")], "name string, status string")
    checked = spark.createDataFrame([("a", "p", True), ("b", "p", False), ("c", "p", True), ("d", None, False)], "name string, path string, ok boolean")
    got = {r.name: (r.status, r.error) for r in trades.verified(results, checked).collect()}
    assert got == {"a": ("audited_all_rows", None), "b": ("failed", "source checksum changed"), "c": ("failed", None), "d": ("failed", "source is missing")}


def test_trade_coverage(spark):
    want = spark.createDataFrame([("A/1", "A"), ("A/2", "A"), ("B/1", "B")], "key string, symbol string")
    audits = spark.createDataFrame([("A", 10, "audited_all_rows"), ("A", 0, "failed")], "symbol string, rows long, status string")
    got = {r.symbol: (r.expected_files, r.verified_files, r.observed_rows, r.fully_audited_files) for r in coverage.trade_summary(want, want.withColumn("status", F.lit("verified")), audits).collect()}
    assert got == {"A": (2, 2, 10, 1), "B": (1, 1, 0, 0)}


def moved(df):
    """Rows that each exchange of the executed plan moved."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    stack, found = [plan], []
    while stack:
        node = stack.pop()
        for name in ("finalPhysicalPlan", "plan"):
            if node.getClass().getSimpleName() in ("AdaptiveSparkPlanExec", "ShuffleQueryStageExec", "BroadcastQueryStageExec") and hasattr(node, name):
                try:
                    stack.append(getattr(node, name)())
                except Exception:  # noqa: BLE001, S110  (not of this class)
                    pass
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        kids = node.children()
        stack.extend(kids.apply(i) for i in range(kids.size()))
    return found


@pytest.fixture
def minutes(spark):
    days = [(s, dt.datetime(2024, 1, 1 + d, h, m), None if (d * 7 + h + m) % 50 == 0 else float(h + m)) for s in "ABC" for d in range(6) for h in range(24) for m in range(0, 60, 5)]
    return spark.createDataFrame(days, "symbol string, open_time timestamp_ntz, close double")


def test_stored_bars_stay_where_they_lie(spark, minutes, tmp_path):
    n = minutes.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = layout.save_bars(minutes, "bars_t", "day", 4, str(tmp_path / "t"))
        u = layout.save_bars(minutes.where("minute(open_time) % 10 = 0"), "bars_u", "day", 4, str(tmp_path / "u"))
        sections = features.with_section(t, rows=3)
        rows = moved(sections)
        assert rows and max(rows) < n / 20  # a row a part, and copies
        assert moved(panel.attach_close(t, u, "other")) == []
        assert max(moved(features.with_section(minutes, "day", rows=3))) >= n  # rows that are not stored are dealt out
        own = lambda df: sorted(map(tuple, df.select("symbol", "part", "open_time", "close", "section", "row_in_section", "lead").collect()), key=repr)
        assert own(sections) == own(features.with_section(minutes, "day", rows=3))
        grid = bars.to_grid(t.where("close is not null"), t, "2024-01-01 00:00:00", "2024-01-07 00:00:00", "5 minutes")
        assert sorted(map(tuple, grid.select("symbol", "open_time", "close").collect()), key=repr) == sorted(map(tuple, minutes.collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS bars_t")
        spark.sql("DROP TABLE IF EXISTS bars_u")
