"""Streaming jobs: bars from minutes as they arrive, audits of partitions as they land, replay of order books."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal
from heapq import heapify, heappop, heappush, merge

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from marketlake.operators import trades
from marketlake.operators.bars import SUMS

#: Updates that wait for their session's snapshot, at most.
MOST_WAITING = 20_000


def resample_stream(minutes: DataFrame, rule: str, n: int, watermark: str = "2 minutes") -> DataFrame:
    """Bars that have closed and are complete; late rows are dropped by the watermark."""
    has = lambda f, c: f(c, "open_time")
    g = minutes.where("close is not null").withWatermark("open_time", watermark).groupBy("symbol", F.window("open_time", rule).alias("w"))
    df = g.agg(has(F.min_by, "open").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), has(F.max_by, "close").alias("close"), *(F.sum(c).alias(c) for c in SUMS), F.count("*").alias("parts"))
    return df.where(F.col("parts") == n).select("symbol", F.col("w.start").alias("open_time"), "open", "high", "low", "close", *SUMS)


def audit_stream(stream: DataFrame, out: str, checkpoint: str, version: str | None = None) -> StreamingQuery:
    """Sums up the runs of each batch of landed rows; `audited` puts them together, a row a partition.

    A partition may come in any number of files and batches. A batch has a folder of its own that it replaces, so one that is
    tried again changes nothing. What a checkpoint has seen is not read again; a file that lands anew with a higher `version`
    takes the place of what its partition had before.
    """

    def each(batch: DataFrame, number: int) -> None:
        trades.runs(batch, version).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def audited(spark: SparkSession, out: str) -> DataFrame:
    """The audit so far: one row for each partition that audit_stream has seen any row of."""
    return trades.combined(spark.read.schema(trades.RUN).option("basePath", out).parquet(out))


class Side:
    """The best price of one side of a book during a batch. A heap is filled from the levels once a batch, if a best level goes."""

    def __init__(self, stored: Callable[[], Iterable[str]], best: str | None, sign: int):
        self.stored, self.sign = stored, sign
        self.best = Decimal(best) if best else None
        self.changed: dict[str, str | None] = {}  # price: quantity, or None if it is gone
        self.heap: list[tuple[Decimal, str]] | None = None
        self.known: set[str] = set()  # the prices when the heap was filled

    def put(self, text: str | None) -> None:
        for level in filter(None, (text or "").split(";")):
            price, qty = level.split(":")
            p = Decimal(price)
            if Decimal(qty) != 0:
                self.changed[price] = qty
                if self.heap is not None:
                    heappush(self.heap, (self.sign * p, price))
                if self.best is None or self.sign * p < self.sign * self.best:
                    self.best = p
            else:
                self.changed[price] = None
                if p == self.best:
                    self._next()

    def _next(self) -> None:
        if self.heap is None:
            live = set(self.stored()) - {p for p, q in self.changed.items() if q is None} | {p for p, q in self.changed.items() if q is not None}
            self.heap = [(self.sign * Decimal(x), x) for x in live]
            heapify(self.heap)
            self.known = live
        while self.heap and (self.changed[self.heap[0][1]] is None if self.heap[0][1] in self.changed else self.heap[0][1] not in self.known):
            heappop(self.heap)
        self.best = self.sign * self.heap[0][0] if self.heap else None


class Replay(StatefulProcessor):
    """The book of a symbol's session: levels with the best of both sides, last update id, and what waits for the snapshot.

    An update with u < last is stale; the first after a snapshot must bridge it, each further one must follow the one
    before; else the session ends with a gap until another snapshot of it. A crossed book is a gap too, its update having
    been applied. More than MOST_WAITING updates before the snapshot end the session for good: all of them have failed, and
    so has whatever comes later.

    An ended session keeps no levels and no updates, only its head, so that what still comes is told apart from a new
    session; the head goes when nothing has come for `idle` (processing time). A session that just stops goes then, too.
    """

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", "last long, started boolean, live boolean, failed boolean, bid string, ask string")
        self.levels = handle.getMapState("levels", "side string, price string", "qty string")
        self.waiting = handle.getListState("waiting", "seq long, first long, u long, pu long, bids string, asks string")
        self.held = handle.getValueState("held", "n int")

    def _prices(self, side: str) -> Iterator[str]:
        return (price for s, price in self.levels.keys() if s == side) if not self.cleared else iter(())

    def _open(self, bid: str | None, ask: str | None, cleared: bool) -> None:
        self.cleared = cleared
        self.sides = {"bid": Side(lambda: self._prices("bid"), bid, -1), "ask": Side(lambda: self._prices("ask"), ask, 1)}

    def _apply(self, first: int, u: int, pu: int, bids: str, asks: str) -> str:
        if self.failed:
            return "failed"
        if not self.live:
            return "ignored"
        if u < self.last:
            return "stale"
        if not (first <= self.last <= u) if not self.started else pu != self.last:
            self.live = False
            return "gap"
        self.sides["bid"].put(bids)
        self.sides["ask"].put(asks)
        bid, ask = self.sides["bid"].best, self.sides["ask"].best
        self.last, self.started, self.live = u, True, bid is None or ask is None or bid < ask
        return "applied" if self.live else "gap"

    def _store(self) -> None:
        """Writes the batch's changes down; an ended session's levels go."""
        if self.cleared or not self.live:
            self.levels.clear()
        if self.live:
            for name, side in self.sides.items():
                for price, qty in side.changed.items():
                    if qty is not None:
                        self.levels.updateValue((name, price), (qty,))
                    elif not self.cleared:
                        self.levels.removeKey((name, price))
        best = [None if s.best is None or not self.live else str(s.best) for s in self.sides.values()]
        self.head.update((self.last, self.started, self.live, self.failed, *best))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802
        out: list[tuple] = []
        known = self.head.exists()
        self.last, self.started, self.live, self.failed, bid, ask = self.head.get() if known else (0, False, False, False, None, None)
        self._open(bid, ask, cleared=False)
        n = self.held.get()[0] if self.held.exists() else 0
        fresh: list[tuple] = []  # this batch's updates that wait
        ordered = (f.sort_values("seq").itertuples(index=False) for f in rows)
        for r in merge(*ordered, key=lambda r: r.seq):  # of one session and batch
            item = (int(r.first), int(r.u), int(r.pu), r.bids, r.asks)
            if self.failed:
                out.append((*key, int(r.seq), "failed"))
            elif r.type == "snapshot":
                self._open(None, None, cleared=True)
                self.sides["bid"].put(r.bids)
                self.sides["ask"].put(r.asks)
                self.last, self.started, self.live, known = int(r.u), False, True, True
                out.append((*key, int(r.seq), "snapshot"))
                if n:
                    out.extend((*key, seq, self._apply(*update)) for seq, *update in [*(self.waiting.get() if n > len(fresh) else ()), *fresh])
                    n, fresh = 0, []
                    self.waiting.clear()
                    self.held.clear()
            elif known:
                out.append((*key, int(r.seq), self._apply(*item)))
            elif n >= MOST_WAITING:
                held = [*(self.waiting.get() if n > len(fresh) else ()), *fresh]
                out.extend((*key, int(x[0]), "failed") for x in held)
                out.append((*key, int(r.seq), "failed"))
                self.failed = known = True
                n, fresh = 0, []
                self.waiting.clear()
                self.held.clear()
            else:
                fresh.append((int(r.seq), *item))
                n += 1
        if known:
            self._store()
        elif fresh:
            self.waiting.appendList(fresh)
            self.held.update((n,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield pd.DataFrame(out, columns=["symbol", "session", "seq", "outcome"])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802
        """The session is over: nothing of it stays. Updates that still wait never had a snapshot; they have failed."""
        lost = [(*key, int(x[0]), "failed") for x in self.waiting.get()] if self.held.exists() else []
        for state in (self.head, self.levels, self.waiting, self.held):
            state.clear()
        yield pd.DataFrame(lost, columns=["symbol", "session", "seq", "outcome"])

    def close(self) -> None:
        pass


REPLAYED = "symbol string, session int, seq long, outcome string"


def replay_stream(envelopes: DataFrame, idle_ms: int = 3_600_000) -> DataFrame:
    """symbol, session, seq, outcome of every update (applied, stale, gap, ignored, failed) and snapshot.

    Input: symbol, session, seq (order of arrival), type, first, u, pu, bids, asks (price:qty;...). A book starts from its
    session's snapshot, so sessions are replayed side by side. A session's state goes `idle_ms` after its last row. A session's
    rows of one batch are held by a task: maxFilesPerTrigger bounds a batch. Needs the RocksDB state store.
    """
    return envelopes.groupBy("symbol", "session").transformWithStateInPandas(Replay(idle_ms), outputStructType=StructType.fromDDL(REPLAYED), outputMode="append", timeMode="ProcessingTime")


def replay_files(envelopes: DataFrame, out: str, checkpoint: str, idle_ms: int = 3_600_000) -> StreamingQuery:
    """Replays what has landed and appends the outcomes to files; run again, it goes on from its checkpoint.

    Batches without data are off for this query: timers of processing time would have them follow one another for ever. A
    session that is due so goes with the next batch that has data.
    """
    conf, name = envelopes.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name, None)
    conf.set(name, "false")
    try:  # a query keeps the settings that it was started with
        return replay_stream(envelopes, idle_ms).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.unset(name) if before is None else conf.set(name, before)
