import datetime as dt

import pytest

from marketlake.operators import quality, trades

DAY = dt.date(2024, 1, 2)
MS = 1704153600000
SCHEMA = "symbol string, date date, row_idx long, id long, price double, qty double, quote_qty double, time long, is_buyer_maker string"


def rows():
    out = [["A", DAY, i, 100 + i, 2.0, 3.0, 6.0, MS + 1000 * i, "true"] for i in range(40)]
    out[5][3] = 104  # the id before again
    out[9][7] = MS - 1  # the day before, time runs back
    out[12][6] = 6.000001  # quote off
    out[15][4] = float("nan")
    out[18][8] = "maybe"
    return [tuple(x) for x in out]


@pytest.mark.parametrize("parts", [1, 4, 37])
def test_both_audits_agree_for_any_split(spark, parts):
    df = spark.createDataFrame(rows(), SCHEMA)
    a = trades.audit(df).first().asDict()
    ranged = df.repartitionByRange(parts, "row_idx").sortWithinPartitions("row_idx") if parts > 1 else df.coalesce(1)
    b = trades.audit_partial(ranged).first().asDict()
    assert a == b
    want = {"rows": 40, "invalid_rows": 2, "non_increasing_id_transitions": 1, "non_consecutive_id_transitions": 1, "regressing_time_transitions": 1, "outside_partition_rows": 1, "quote_product_mismatch_rows": 1, "first_id": 100, "last_id": 139}
    assert {k: a[k] for k in want} == want


def test_boundaries_and_incremental(spark):
    cols = "symbol string, date date, status string, first_id long, last_id long, first_time_ms long, last_time_ms long"
    day = lambda k: DAY + dt.timedelta(days=k)
    res = spark.createDataFrame([("A", day(0), "audited_all_rows", 1, 9, 0, 5), ("A", day(1), "audited_all_rows", 9, 20, 6, 8), ("A", day(3), "audited_all_rows", 5, 30, 1, 9)], cols)
    assert [(r.left_date, r.right_date) for r in trades.boundary_errors(res).collect()] == [(day(0), day(1))]
    assert [r.id_delta_from_prior_partition for r in trades.stitch(res).orderBy("date").collect()] == [None, 0, -15]
    m = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "key string, sha256 string")
    done = spark.createDataFrame([("a", "1", "audited_all_rows"), ("b", "x", "audited_all_rows"), ("c", "3", "failed")], "key string, sha256 string, status string")
    assert sorted(r.key for r in trades.incremental(m, done).collect()) == ["b", "c"]


def test_each_candle_fault_marks_its_row(spark):
    good = dict(open_time=60_000, open=2.0, high=3.0, low=1.0, close=2.0, volume=1.0, close_time=119_999, quote_volume=2.0, count=1, taker_buy_volume=0.5, taker_buy_quote_volume=1.0)
    faults = [{"high": 1.5}, {"low": 2.5, "high": 3.0}, {"low": 0.0}, {"volume": -1.0}, {"quote_volume": -1.0}, {"count": -1}, {"open_time": 60_001}, {"close_time": 1}, {"open": float("nan")}, {"close": None}, {"taker_buy_volume": 1.1}]
    schema = ", ".join(f"{k} {'long' if isinstance(v, int) else 'double'}" for k, v in good.items())
    df = spark.createDataFrame([tuple((good | f).values()) for f in [{}, *faults]], schema)
    assert [r[0] for r in df.select(quality.candle_invalid()).collect()] == [False] + [True] * len(faults)


def test_epoch_units(spark):
    df = spark.createDataFrame([("ms", 1700000000000), ("us", 1700000000000000), ("odd", 1700000000000001)], "file string, t long")
    got = {r.file: (r.t_ms, r.t_bad) for r in quality.epoch_ms(df, "t").collect()}
    assert got == {"ms": (1700000000000, False), "us": (1700000000000, False), "odd": (1700000000000, True)}
