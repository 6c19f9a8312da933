"""Streaming audits over any split into batches, and order books whose sessions end."""

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlake.operators import book, trades
from marketlake.sources import readers
from marketlake.streaming import jobs

ROW = "symbol string, date date, row_idx long, id long, price double, qty double, quote_qty double, time long, is_buyer_maker boolean, version long"


def ticks(n=400, days=3, version=1, shift=0):
    """Trades of some days with faults of every kind."""
    import datetime as dt

    rng = random.Random(7)
    rows = []
    for d in range(days):
        for i in range(n):
            bad = rng.random() < 0.05
            t = 86_400_000 * (19_723 + d) + i * 1000 + (-5000 if rng.random() < 0.05 else 0)
            rows.append(("A", dt.date(2024, 1, 1) + dt.timedelta(d), i, 1000 * d + i - (2 if rng.random() < 0.05 else 0) + shift, 0.0 if bad else 2.0, 3.0, 6.0, t, bool(i % 2), version))
    return rows


def result(df):
    return sorted(tuple(r[c] for c in ("symbol", "date", "rows", *trades.FLAGS, "first_id", "last_id", "first_time_ms", "last_time_ms", "status")) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_runs_of_any_split_make_the_audit(spark, parts):
    rows = ticks()
    want = result(trades.audit(spark.createDataFrame(rows, ROW)))
    random.Random(parts).shuffle(rows)
    assert result(trades.audit_partial(spark.createDataFrame(rows, ROW).repartition(parts))) == want
    halves = [trades.runs(spark.createDataFrame([r for r in rows if r[2] % 7 // 4 == k], ROW).repartition(2)) for k in (0, 1)]
    assert result(trades.combined(halves[0].unionByName(halves[1]))) == want


def test_runs_that_overlap_have_failed(spark):
    rows = ticks(10, 1)
    one = trades.runs(spark.createDataFrame(rows, ROW).coalesce(1))
    part = trades.runs(spark.createDataFrame(rows[3:6], ROW).coalesce(1))
    assert [r.status for r in trades.combined(one.unionByName(one)).collect()] == ["audited_all_rows"]  # read twice
    assert [r.status for r in trades.combined(one.unionByName(part)).collect()] == ["failed"]


def land(spark, rows, at):
    spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(str(at))


def test_streamed_audit_is_one_row_a_partition(spark, tmp_path):
    """A day in two files and two runs, a batch tried again, and a file that is replaced."""
    landed, out, state = tmp_path / "landed", str(tmp_path / "out"), str(tmp_path / "state")
    rows = ticks()
    want = result(trades.audit(spark.createDataFrame(rows, ROW)))

    def run():
        stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(str(landed))
        jobs.audit_stream(stream, out, state, version="version").awaitTermination()
        return result(jobs.audited(spark, out))

    land(spark, [r for r in rows if r[2] < 150], landed)
    land(spark, [r for r in rows if 150 <= r[2] < 300], landed)
    assert [x[2] for x in run()] == [300] * 3
    land(spark, [r for r in rows if r[2] >= 300], landed)
    assert run() == want and run() == want
    # the last batch as if it had failed before its commit: it runs once more under its number
    last = max(int(p.name) for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit())
    (tmp_path / "state" / "commits" / str(last)).unlink()
    (tmp_path / "state" / "commits" / f".{last}.crc").unlink(missing_ok=True)
    assert run() == want
    again = [r for r in ticks(version=2, shift=5) if r[1].day == 2]
    land(spark, again, landed)
    got = run()
    assert [x for x in got if x[1].day != 2] == [x for x in want if x[1].day != 2]
    assert [x for x in got if x[1].day == 2] == result(trades.audit(spark.createDataFrame(again, ROW)))


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def replay(spark, at, idle_ms=3_600_000):
    q = jobs.replay_files(readers.read_envelopes(spark, str(at / "in"), streaming=True), str(at / "out"), str(at / "ck"), idle_ms)
    q.awaitTermination()
    state = [s.numRowsTotal for p in q.recentProgress for s in p.stateOperators]
    return spark.read.schema(jobs.REPLAYED).parquet(str(at / "out")), state


def envelopes(at, name, lines):
    (at / "in").mkdir(exist_ok=True)
    (at / "in" / name).write_text("\n".join(map(json.dumps, lines)))


def line(seq, session, kind, **p):
    return {"symbol": "A", "session": session, "seq": seq, "type": kind, "payload": p}


def session(s, levels=50, gap=True):
    snap = line(1, s, "snapshot", lastUpdateId=100, bids=[[str(50 - i), "1"] for i in range(levels)], asks=[[str(51 + i), "1"] for i in range(levels)])
    rows = [snap, line(2, s, "diff", U=100, u=101, pu=99, b=[["50", "0"]], a=[])]
    return rows + ([line(3, s, "diff", U=105, u=106, pu=104, b=[], a=[])] if gap else [])


def test_ended_sessions_leave_no_state(spark, tmp_path, rocks):
    envelopes(tmp_path, "a.jsonl", [x for s in range(30) for x in session(s)] + session(99, gap=False))
    got, state = replay(spark, tmp_path, idle_ms=1)
    ended = {(r.session, r.seq): r.outcome for r in got.collect()}
    assert ended[0, 3] == "gap" and ended[99, 2] == "applied"
    # heads and timers of 31 sessions, and the 99 levels of the one that goes on; 3,000 levels went with their sessions
    assert 99 <= state[0] <= 99 + 31 * 3
    envelopes(tmp_path, "b.jsonl", [line(4, 99, "diff", U=102, u=102, pu=101, b=[], a=[])])
    got, state = replay(spark, tmp_path, idle_ms=1)
    assert state[-1] <= 99 + 3
    assert {(r.session, r.seq): r.outcome for r in got.collect()}[99, 4] == "applied"


def test_too_many_updates_before_the_snapshot_end_the_capture(spark, tmp_path, rocks):
    n = jobs.MOST_WAITING + 1
    early = [line(i, 1, "diff", U=i, u=i, pu=i - 1, b=[["9", "1"]], a=[]) for i in range(1, n + 1)]
    late = [line(n + 1, 1, "snapshot", lastUpdateId=5, bids=[["9", "2"]], asks=[["11", "3"]]), line(n + 2, 1, "diff", U=n, u=n + 2, pu=n + 1, b=[], a=[])]
    envelopes(tmp_path, "a.jsonl", early[: n // 2])
    replay(spark, tmp_path)
    envelopes(tmp_path, "b.jsonl", early[n // 2 :])
    replay(spark, tmp_path)
    envelopes(tmp_path, "c.jsonl", late)
    got, state = replay(spark, tmp_path)
    assert {r.outcome: r.n for r in got.groupBy("outcome").agg(F.count("*").alias("n")).collect()} == {"failed": n + 2} and got.select("seq").distinct().count() == n + 2
    assert state[-1] <= 3
    assert book.report(got).first().status == "blocked_or_failed"


def test_report_counts_updates_only(spark):
    rows = [("A", 1, i, o) for i, o in enumerate(["snapshot", "applied", "gap", "ignored", "stale"])] + [("B", 1, 0, "snapshot"), ("B", 1, 1, "gap")]
    got = {r.symbol: (r.events, r.synchronized_events, r.sessions, r.gaps, r.status) for r in book.report(spark.createDataFrame(rows, jobs.REPLAYED)).collect()}
    assert got == {"A": (4, 1, 1, 1, "captured"), "B": (1, 0, 1, 1, "no_synchronized_data")}


def test_best_price_of_a_side_by_brute_force():
    rng = random.Random(4)
    for sign in (1, -1):
        stored = {str(Decimal(rng.randint(1, 400)) / 10): "1" for _ in range(60)}
        walks = []
        pick = min if sign == 1 else max
        side = jobs.Side(lambda s=stored, w=walks: w.append(1) or list(s), str(pick(map(Decimal, stored))), sign)
        live = dict(stored)
        for _ in range(3000):
            price = rng.choice([*live, str(Decimal(rng.randint(1, 400)) / 10)]) if live else "7.0"
            if rng.random() < 0.3 and live:
                price = str(pick(map(Decimal, live)))
            if rng.random() < 0.55:
                live.pop(price, None)
                side.put(f"{price}:0")
            else:
                live[price] = "2"
                side.put(f"{price}:2")
            assert side.best == (pick(map(Decimal, live)) if live else None)
        assert len(walks) == 1 and {p for p, q in side.changed.items() if q} <= set(live)


def test_book_over_batches(spark, tmp_path, rocks):
    """The best price is found among levels of earlier batches when it goes."""
    envelopes(tmp_path, "a.jsonl", session(1, gap=False))
    replay(spark, tmp_path)
    envelopes(tmp_path, "b.jsonl", [line(4, 1, "diff", U=102, u=102, pu=101, b=[["49", "0"]], a=[["51", "0"], ["48.5", "1"]]), line(5, 1, "diff", U=103, u=103, pu=102, b=[["48.5", "1"]], a=[])])
    got, _ = replay(spark, tmp_path)
    assert {r.seq: r.outcome for r in got.collect()} == {1: "snapshot", 2: "applied", 4: "applied", 5: "gap"}
