"""The library's queries over the driver's tables, and the same in DuckDB's SQL."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.operators import bars, book, costs, coverage, features, macro, panel, quality, trades
from marketlake.shipping import ship
from marketlake.sources import adapters as ad
from marketlake.sources import layout
from marketlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def shared(spark: SparkSession, name: str) -> str:
    """A new place in the folder that driver and executors share; a local folder will do on a local master only."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return f"{path}/{name}-{uuid.uuid4().hex}"


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


OHLCV = 'open, high, low, close, volume, quote_volume, "count", taker_buy_volume, taker_buy_quote_volume'
TAPE = """WITH tape AS (SELECT event_type AS symbol, event_id AS id, event_id AS row_idx, ts, CAST(ts AS DATE) AS date, epoch_us(ts) // 1000 AS time, value AS price,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS qty, value * CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quote_qty, user_id % 2 = 0 AS is_buyer_maker FROM events)"""
BARS = TAPE + """, both_ AS (SELECT * FROM tape UNION ALL SELECT * REPLACE ('ALL' AS symbol) FROM tape),
bars AS (SELECT symbol, date_trunc('hour', ts) AS open_time, arg_min(price, id) AS open, max(price) AS high, min(price) AS low, arg_max(price, id) AS close, sum(qty) AS volume,
  CAST(sum(CAST(price * qty AS DECIMAL(20,4))) AS DOUBLE) AS quote_volume, count(*) AS "count", sum(CASE WHEN is_buyer_maker THEN 0.0::DOUBLE ELSE qty END) AS taker_buy_volume,
  CAST(sum(CASE WHEN is_buyer_maker THEN 0 ELSE CAST(price * qty AS DECIMAL(20,4)) END) AS DOUBLE) AS taker_buy_quote_volume FROM both_ GROUP BY 1, 2)"""
GRID = BARS + f""", g AS (SELECT s.symbol, t.t AS open_time FROM (SELECT DISTINCT symbol FROM both_) s, generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR) t(t)),
grid AS (SELECT symbol, open_time, {OHLCV} FROM g LEFT JOIN bars USING (symbol, open_time))"""
SEC = GRID + """, sec AS (SELECT *, close IS NOT NULL AS data_valid, CAST(sum(CASE WHEN close IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY open_time ROWS UNBOUNDED PRECEDING) AS BIGINT) AS section FROM grid),
lagged AS (SELECT *, lag(close) OVER w AS before, CASE WHEN data_valid THEN count(close) OVER w END AS row_in_section FROM sec WINDOW w AS (PARTITION BY symbol, section ORDER BY open_time)),
ret AS (SELECT *, close / nullif(before, 0) - 1 AS return_1, CASE WHEN close > 0 AND before > 0 THEN ln(close) - ln(before) END AS log_return, close - before AS delta,
  CASE WHEN data_valid THEN greatest(high - low, abs(high - before), abs(low - before)) END AS true_range FROM lagged)"""
ROLL = SEC + """, roll AS (SELECT *, CASE WHEN count(log_return) OVER w30 = 30 THEN stddev_samp(log_return) OVER w30 END AS volatility_30, CASE WHEN count(log_return) OVER w60 = 60 THEN stddev_samp(log_return) OVER w60 END AS volatility_60,
  CASE WHEN count(close) OVER w20 = 20 THEN (close - avg(close) OVER w20) / nullif(stddev_samp(close) OVER w20, 0) END AS zscore_20,
  CASE WHEN min(CASE WHEN close IS NULL THEN 0 ELSE 1 END) OVER d = 1 THEN sum(quote_volume) OVER d / nullif(sum(volume) OVER d, 0) END AS vwap_utc_day
  FROM ret WINDOW w20 AS (PARTITION BY symbol, section ORDER BY open_time ROWS 19 PRECEDING), w30 AS (PARTITION BY symbol, section ORDER BY open_time ROWS 29 PRECEDING),
  w60 AS (PARTITION BY symbol, section ORDER BY open_time ROWS 59 PRECEDING), d AS (PARTITION BY symbol, CAST(open_time AS DATE) ORDER BY open_time ROWS UNBOUNDED PRECEDING))"""


def _mean(column: str, alpha: str, least: int) -> str:
    return f"CASE WHEN {column} IS NOT NULL AND len({column}_l) >= {least} THEN list_reduce({column}_l, lambda acc, x: (1 - {alpha}) * acc + {alpha} * x) END"


EMA = ROLL + f""", up AS (SELECT *, CASE WHEN delta IS NOT NULL THEN greatest(delta, 0) END AS gain, CASE WHEN delta IS NOT NULL THEN greatest(-delta, 0) END AS loss FROM roll),
lists AS (SELECT *, {", ".join(f"list({c}) FILTER (WHERE {c} IS NOT NULL) OVER w AS {c}_l" for c in ("close", "true_range", "gain", "loss"))} FROM up WINDOW w AS (PARTITION BY symbol, section ORDER BY open_time ROWS UNBOUNDED PRECEDING)),
m AS (SELECT *, {_mean("close", "(2.0::DOUBLE / 21)", 20)} AS ema_20, {_mean("close", "(2.0::DOUBLE / 51)", 50)} AS ema_50, {_mean("close", "(2.0::DOUBLE / 201)", 200)} AS ema_200,
  {_mean("true_range", "(1.0::DOUBLE / 14)", 14)} AS atr_14, {_mean("gain", "(1.0::DOUBLE / 14)", 14)} AS up_, {_mean("loss", "(1.0::DOUBLE / 14)", 14)} AS down_ FROM lists),
means AS (SELECT *, CASE WHEN down_ = 0 AND up_ > 0 THEN 100.0 WHEN down_ = 0 AND up_ = 0 THEN 50.0 ELSE 100 - 100 / (1 + up_ / nullif(down_, 0)) END AS rsi_14, (ema_20 / nullif(ema_50, 0) - 1) * 10000 AS trend_20_50_bps FROM m)"""


def r(*names: str, places: int = 6) -> str:
    return ", ".join(f"round({n}, {places}) AS {n}" for n in names)


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense hourly grid of each symbol and of the whole tape."""
    t = ad.both(spark, sf_dir)
    return bars.to_grid(bars.from_trades(t, "1 hour"), t, ad.START, ad.END, "1 hour")


def sections(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Hourly bars with these columns, cut into sections, in parts of a week."""
    return features.with_section(hourly(spark, sf_dir).select("symbol", "open_time", *names), "week")


@query(GRID + f" SELECT symbol, open_time, {OHLCV} FROM grid")
def hourly_grid(spark, sf_dir):
    return hourly(spark, sf_dir)


@query(GRID + """ SELECT symbol, time_bucket(INTERVAL 4 HOUR, open_time) AS open_time, arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, open_time) AS close, sum(volume) AS volume,
  round(sum(quote_volume), 4) AS quote_volume, CAST(sum("count") AS BIGINT) AS "count", sum(taker_buy_volume) AS taker_buy_volume, round(sum(taker_buy_quote_volume), 4) AS taker_buy_quote_volume FROM grid GROUP BY 1, 2 HAVING count(close) = 4""")
def bars_complete_4h(spark, sf_dir):
    return rounded(bars.resample(hourly(spark, sf_dir), "4 hours", 4), "quote_volume", "taker_buy_quote_volume", places=4)


@query(GRID + " SELECT symbol, open_time, close, open_time + INTERVAL 1 HOUR AS bar_available_at FROM grid WHERE open_time >= TIMESTAMP '2024-01-05' AND open_time < TIMESTAMP '2024-01-20'")
def bars_available_at(spark, sf_dir):
    df = bars.clip_window(hourly(spark, sf_dir), "open_time", "2024-01-05 00:00:00", "2024-01-20 00:00:00")
    return bars.with_available_at(df, "1 hour").select("symbol", "open_time", "close", "bar_available_at")


@query(SEC + f" SELECT symbol, open_time, data_valid, section, row_in_section, {r('return_1', 'log_return')} FROM ret")
def section_returns(spark, sf_dir):
    df = features.whole(features.returns(sections(spark, sf_dir, "close")))
    return rounded(df.select("symbol", "open_time", "data_valid", "section", "row_in_section", "return_1", "log_return"), "return_1", "log_return")


def stored(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Hourly bars as a table in buckets by symbol and week."""
    h = hourly(spark, sf_dir).select("symbol", "open_time", *names)
    return layout.save_bars(h, f"bars_{uuid.uuid4().hex}", "week", 16, shared(spark, "stored"))


@query(SEC + " SELECT symbol, open_time, data_valid, section, row_in_section FROM ret")
def stored_sections(spark, sf_dir):
    """Sections of stored bars: their rows are not moved."""
    df = features.whole(features.with_section(stored(spark, sf_dir, "close")))
    return df.select("symbol", "open_time", "data_valid", "section", "row_in_section")


@query(GRID + " SELECT g1.symbol, g1.open_time, g1.close, g1.volume, i.close AS before FROM grid g1 LEFT JOIN grid i ON i.symbol = g1.symbol AND i.open_time = g1.open_time AND hour(i.open_time) % 3 <> 0")
def stored_attach(spark, sf_dir):
    """The close of another stored table beside each bar, and a grid over stored bars: both tables are joined where they lie."""
    t = stored(spark, sf_dir, "close", "volume")
    other = layout.save_bars(t.drop("part").where(F.hour("open_time") % 3 != 0), f"bars_{uuid.uuid4().hex}", "week", 16, shared(spark, "stored"))
    grid = bars.to_grid(t, t, ad.START, ad.END, "1 hour")
    return panel.attach_close(grid, other, "before").select("symbol", "open_time", "close", "volume", "before")


@query(SEC + f" SELECT symbol, open_time, {r('true_range')} FROM ret")
def true_range(spark, sf_dir):
    return rounded(features.whole(features.true_range(sections(spark, sf_dir, "high", "low", "close"))).select("symbol", "open_time", "true_range"), "true_range")


@query(ROLL + f" SELECT symbol, open_time, {r('vwap_utc_day')} FROM roll")
def vwap_day(spark, sf_dir):
    return rounded(features.vwap_day(hourly(spark, sf_dir)).select("symbol", "open_time", "vwap_utc_day"), "vwap_utc_day")


@query(ROLL + f" SELECT symbol, open_time, {r('volatility_30', 'volatility_60')} FROM roll")
def rolling_vol(spark, sf_dir):
    df = features.whole(features.volatility(features.returns(sections(spark, sf_dir, "close"))))
    return rounded(df.select("symbol", "open_time", "volatility_30", "volatility_60"), "volatility_30", "volatility_60")


@query(ROLL + f" SELECT symbol, open_time, {r('zscore_20')} FROM roll")
def zscore_20(spark, sf_dir):
    return rounded(features.whole(features.zscore(sections(spark, sf_dir, "close"))).select("symbol", "open_time", "zscore_20"), "zscore_20")


MEANS = ("ema_20", "ema_50", "ema_200", "atr_14", "rsi_14", "trend_20_50_bps")
ROLLED = ("return_1", "volatility_30", "volatility_60", "zscore_20", "vwap_utc_day")


@query(EMA + f" SELECT symbol, open_time, {r(*MEANS)} FROM means")
def exponential_means(spark, sf_dir):
    df = features.averages(features.whole(features.true_range(features.returns(sections(spark, sf_dir, "high", "low", "close")))), "week")
    return rounded(df.select("symbol", "open_time", *MEANS), *MEANS)


@query(EMA + f" SELECT symbol, open_time, {OHLCV}, data_valid, {r(*ROLLED, *MEANS)}, open_time + INTERVAL 1 HOUR AS bar_available_at FROM means")
def features_full(spark, sf_dir):
    df = features.features(hourly(spark, sf_dir), "1 hour", "week")
    own = ["symbol", "open_time", "open", "high", "low", "close", *bars.SUMS, "data_valid"]
    return rounded(df.select(*own, *ROLLED, *MEANS, "bar_available_at"), *ROLLED, *MEANS)


CANDLES = GRID + """, src AS (SELECT symbol || '/' || strftime(open_time, '%Y-%m-%d') AS file, symbol, epoch_ms(open_time) AS t, open_time AS ts_, day(open_time) AS d, hour(open_time) AS hh, open, high, low, close, volume, quote_volume, "count", taker_buy_volume, taker_buy_quote_volume FROM grid WHERE close IS NOT NULL),
c AS (SELECT file, symbol, t AS open_time, CASE WHEN d % 7 = 0 AND hh = 9 THEN t - 7200001 ELSE t END AS row_idx, t + CASE WHEN d % 5 = 0 AND hh = 7 THEN 0 ELSE 3599999 END AS close_time, open, CASE WHEN d % 11 = 0 AND hh = 3 THEN low - 1 ELSE high END AS high, low, close, volume, quote_volume, "count", taker_buy_volume, taker_buy_quote_volume FROM src),
flag AS (SELECT *, (high < greatest(open, close) OR low > least(open, close) OR high < low OR low <= 0 OR volume < 0 OR quote_volume < 0 OR "count" < 0 OR open_time % 3600000 <> 0 OR close_time <> open_time + 3599999 OR taker_buy_volume < 0 OR taker_buy_volume > volume + 1e-8) AS bad,
  open_time < lag(open_time) OVER (PARTITION BY file ORDER BY row_idx) AS back, open_time - lag(open_time) OVER (PARTITION BY file ORDER BY open_time) > 3600000 AS gap FROM c),
qa AS (SELECT file, count(*) AS "rows", count(*) FILTER (WHERE bad) AS invalid_rows, count(*) - count(DISTINCT open_time) AS duplicate_times, coalesce(bool_or(back), false) AS out_of_order, count(*) FILTER (WHERE gap) AS observed_gap_intervals FROM flag GROUP BY 1)"""


@query(CANDLES + " SELECT * FROM qa")
def candle_qa(spark, sf_dir):
    return quality.candle_qa(ad.candles(spark, sf_dir, hourly(spark, sf_dir)), interval_ms=3_600_000)


@query(CANDLES + " SELECT file, open_time FROM flag WHERE bad")
def candle_invalid_rows(spark, sf_dir):
    return ad.candles(spark, sf_dir, hourly(spark, sf_dir)).where(quality.candle_invalid(3_600_000)).select("file", "open_time")


@query(CANDLES + " SELECT file, open_time, close FROM c WHERE file NOT IN (SELECT file FROM qa WHERE invalid_rows > 0 OR duplicate_times > 0 OR out_of_order)")
def quarantine_rows(spark, sf_dir):
    c = ad.candles(spark, sf_dir, hourly(spark, sf_dir))
    return quality.quarantine(c, quality.candle_qa(c, interval_ms=3_600_000)).select("file", "open_time", "close")


@query(CANDLES + """ SELECT file, concat_ws(', ', CASE WHEN invalid_rows > 0 THEN 'invalid_rows=' || invalid_rows END, CASE WHEN duplicate_times > 0 THEN 'duplicate_times=' || duplicate_times END, CASE WHEN out_of_order THEN 'out_of_order' END) AS reason FROM qa
 WHERE invalid_rows > 0 OR duplicate_times > 0 OR out_of_order""")
def quarantine_reasons(spark, sf_dir):
    return quality.reasons(quality.candle_qa(ad.candles(spark, sf_dir, hourly(spark, sf_dir)), interval_ms=3_600_000))


@query(TAPE + """, e AS (SELECT symbol AS file, CASE symbol WHEN 'click' THEN time * 1000 WHEN 'view' THEN time * 1000 + id % 3 ELSE time END AS t FROM tape), m AS (SELECT file, max(t) > 100000000000000 AS us FROM e GROUP BY 1)
 SELECT file, count(*) AS n, CAST(sum(CASE WHEN us THEN t // 1000 ELSE t END) AS BIGINT) AS total_ms, count(*) FILTER (WHERE us AND t % 1000 <> 0) AS bad FROM e JOIN m USING (file) GROUP BY 1""")
def epoch_units(spark, sf_dir):
    t = ad.tape(spark, sf_dir)
    micro = F.when(F.col("symbol") == "click", F.col("time") * 1000).when(F.col("symbol") == "view", F.col("time") * 1000 + F.col("id") % 3).otherwise(F.col("time"))
    df = quality.epoch_ms(t.select(F.col("symbol").alias("file"), micro.alias("t")), "t")
    return df.groupBy("file").agg(F.count("*").alias("n"), F.sum("t_ms").alias("total_ms"), F.count_if("t_bad").alias("bad"))


FAULTS = TAPE + """, f AS (SELECT symbol, row_idx, date, CASE WHEN row_idx % 97 = 0 THEN quote_qty * 1.01::DOUBLE ELSE quote_qty END AS quote_qty, CASE WHEN row_idx % 101 = 0 THEN 0.0::DOUBLE ELSE price END AS price, qty, CASE WHEN row_idx % 103 = 0 THEN time - 7200000 ELSE time END AS time, CASE WHEN row_idx % 107 = 0 THEN row_idx - 1 ELSE row_idx END AS id FROM tape),
x AS (SELECT *, price <= 0 OR qty <= 0 OR quote_qty <= 0 AS invalid, id - lag(id) OVER w AS di, time - lag(time) OVER w AS dt, time < epoch_ms(CAST(date AS TIMESTAMP)) OR time >= epoch_ms(CAST(date AS TIMESTAMP)) + 86400000 AS outside, abs(price * qty - quote_qty) > 1e-8::DOUBLE + abs(price * qty) * 1e-10::DOUBLE AS mismatch FROM f WINDOW w AS (PARTITION BY symbol, date ORDER BY row_idx)),
audit AS (SELECT symbol, date, count(*) AS "rows", count(*) FILTER (WHERE invalid) AS invalid_rows, count(*) FILTER (WHERE di <= 0) AS non_increasing_id_transitions, count(*) FILTER (WHERE di > 1) AS non_consecutive_id_transitions, count(*) FILTER (WHERE dt < 0) AS regressing_time_transitions, count(*) FILTER (WHERE outside) AS outside_partition_rows, count(*) FILTER (WHERE mismatch) AS quote_product_mismatch_rows,
  arg_min(id, row_idx) AS first_id, arg_max(id, row_idx) AS last_id, arg_min(time, row_idx) AS first_time_ms, arg_max(time, row_idx) AS last_time_ms, 'audited_all_rows' AS status FROM x GROUP BY 1, 2)"""


@query(FAULTS + " SELECT * FROM audit")
def trade_audit(spark, sf_dir):
    return trades.audit(ad.tape(spark, sf_dir, faults=True))


@query(FAULTS + " SELECT * FROM audit")
def trade_audit_partial(spark, sf_dir):
    t = ad.tape(spark, sf_dir, faults=True)
    return trades.audit_partial(t)


@query(FAULTS + " SELECT symbol, date, lag(date) OVER w AS prior_partition_date, first_id - lag(last_id) OVER w AS id_delta_from_prior_partition FROM audit WINDOW w AS (PARTITION BY symbol ORDER BY date)")
def trade_stitch(spark, sf_dir):
    return trades.stitch(trades.audit(ad.tape(spark, sf_dir, faults=True))).select("symbol", "date", "prior_partition_date", "id_delta_from_prior_partition")


@query(FAULTS + """, l AS (SELECT symbol, date, lag(date) OVER w AS left_date, first_id, first_time_ms, lag(last_id) OVER w AS li, lag(last_time_ms) OVER w AS lt FROM (SELECT * REPLACE (CASE WHEN day(date) % 6 = 0 THEN first_id - 5000 ELSE first_id END AS first_id) FROM audit) WINDOW w AS (PARTITION BY symbol ORDER BY date))
 SELECT symbol, left_date, date AS right_date FROM l WHERE date_diff('day', left_date, date) = 1 AND (first_id <= li OR first_time_ms < lt)""")
def trade_boundary_errors(spark, sf_dir):
    a = trades.audit(ad.tape(spark, sf_dir, faults=True))
    planted = a.withColumn("first_id", F.when(F.dayofmonth("date") % 6 == 0, F.col("first_id") - 5000).otherwise(F.col("first_id")))
    return trades.boundary_errors(planted)


HEAD = TAPE + ", n AS (SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY id) - 1 AS pos FROM tape)"


@query(HEAD + " SELECT symbol, date, count(*) AS \"rows\", bool_and(price > 0 AND qty > 0) AS passed FROM n WHERE pos < 1000 GROUP BY 1, 2")
def trade_precheck(spark, sf_dir):
    w = Window.partitionBy("symbol", "date").orderBy("id")
    return trades.precheck(ad.tape(spark, sf_dir).withColumn("row_idx", F.row_number().over(w) - 1))


MANIFEST = TAPE + """, man AS (SELECT symbol || '/' || CAST(date AS VARCHAR) AS key, symbol, date, CAST(count(*) AS VARCHAR) AS sha256, CASE WHEN (day(date) + length(symbol)) % 4 = 0 THEN 'failed' ELSE 'verified' END AS status FROM tape GROUP BY 2, 3)"""


def manifest(spark, sf_dir):
    g = ad.tape(spark, sf_dir).groupBy("symbol", "date").agg(F.count("*").cast("string").alias("sha256"))
    status = F.when((F.dayofmonth("date") + F.length("symbol")) % 4 == 0, "failed").otherwise("verified")
    return g.withColumns({"key": F.concat_ws("/", "symbol", F.col("date").cast("string")), "status": status})


@query(MANIFEST + " SELECT key, sha256 FROM man WHERE NOT (status = 'verified' AND day(date) % 3 <> 0)")
def trade_incremental(spark, sf_dir):
    m = manifest(spark, sf_dir)
    done = m.withColumns({"status": F.when(F.col("status") == "verified", "audited_all_rows").otherwise("failed"), "sha256": F.when(F.dayofmonth("date") % 3 == 0, "old").otherwise(F.col("sha256"))})
    return trades.incremental(m.select("key", "sha256"), done.select("key", "sha256", "status"))


@query(MANIFEST + " SELECT key, sha256, CASE WHEN status = 'verified' AND day(date) % 3 <> 0 THEN 'earlier' ELSE 'now' END AS audited FROM man")
def trade_results_united(spark, sf_dir):
    m = manifest(spark, sf_dir)
    done = m.select("key", F.when(F.dayofmonth("date") % 3 == 0, "old").otherwise(F.col("sha256")).alias("sha256"), F.when(F.col("status") == "verified", "audited_all_rows").otherwise("failed").alias("status"), F.lit("earlier").alias("audited"))
    wanted = m.select("key", "sha256")
    fresh = trades.incremental(wanted, done).withColumns({"status": F.lit("audited_all_rows"), "audited": F.lit("now")})
    return trades.united(wanted, done, fresh).drop("status")


@query(TAPE + " SELECT symbol, count(*) - count(DISTINCT (date_trunc('hour', ts), qty)) AS duplicate_rows FROM tape GROUP BY 1")
def duplicate_rows(spark, sf_dir):
    return quality.duplicates(ad.tape(spark, sf_dir).withColumn("h", F.date_trunc("hour", "ts")), ["h", "qty"], ["symbol"])


def _grid_events(spark, sf_dir):
    t = ad.tape(spark, sf_dir)
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    moved = (F.hour("ts") + F.dayofmonth("ts")) % 5 == 0  # whole hours that come 7 minutes late
    events = t.select("symbol", F.when(moved, hour + F.expr("interval 7 minutes")).otherwise(hour).alias("event_time"))
    expected = bars.to_grid(t.select("symbol", F.col("ts").alias("open_time")).limit(0), t, ad.START, ad.END, "1 hour").select("symbol", F.col("open_time").alias("event_time"))
    return coverage.grid_diff(events, expected)


DIFF = GRID + """, ev AS (SELECT DISTINCT symbol, date_trunc('hour', ts) + CASE WHEN (hour(ts) + day(ts)) % 5 = 0 THEN INTERVAL 7 MINUTE ELSE INTERVAL 0 MINUTE END AS event_time FROM tape), ex AS (SELECT symbol, open_time AS event_time FROM g WHERE symbol <> 'ALL')"""


@query(DIFF + " SELECT symbol, event_time FROM ex EXCEPT SELECT symbol, event_time FROM ev")
def grid_missing(spark, sf_dir):
    return _grid_events(spark, sf_dir)[0]


@query(DIFF + " SELECT symbol, event_time FROM ev EXCEPT SELECT symbol, event_time FROM ex")
def grid_off(spark, sf_dir):
    return _grid_events(spark, sf_dir)[1]


HOLES = GRID + """, holes AS (SELECT symbol, open_time, CASE WHEN (day(open_time) + length(symbol)) % 9 = 0 OR hour(open_time) = 5 THEN NULL ELSE close END AS close FROM grid), md AS (SELECT symbol, CAST(open_time AS DATE) AS day FROM holes GROUP BY 1, 2 HAVING count(*) = 24 AND count(close) = 0)"""


def _holes(spark, sf_dir):
    cut = ((F.dayofmonth("open_time") + F.length("symbol")) % 9 == 0) | (F.hour("open_time") == 5)
    return hourly(spark, sf_dir).select("symbol", "open_time", F.when(~cut, F.col("close")).alias("close"))


@query(HOLES + " SELECT symbol, day FROM md")
def missing_days(spark, sf_dir):
    return coverage.missing_days(_holes(spark, sf_dir), 24)


@query(HOLES + " SELECT symbol, open_time, close FROM holes WHERE close IS NOT NULL UNION ALL SELECT b.symbol, b.open_time, b.close FROM bars b JOIN md ON md.symbol = b.symbol AND md.day = CAST(b.open_time AS DATE)")
def repair_days(spark, sf_dir):
    h = _holes(spark, sf_dir)
    daily = hourly(spark, sf_dir).where("close is not null").select("symbol", "open_time", "close")
    return coverage.repair_days(h.where("close is not null"), daily, coverage.missing_days(h, 24))


def requested(spark, sf_dir):
    """Every symbol's daily partitions in the window."""
    t = ad.tape(spark, sf_dir).select("symbol").distinct()
    days = t.withColumn("date", F.explode(F.expr("sequence(date'2024-01-01', date'2024-01-30', interval 1 day)")))
    return days.withColumns({"key": F.concat_ws("/", "symbol", F.col("date").cast("string")), "category": F.lit("trades")})


REQ = MANIFEST + ", req AS (SELECT s.symbol || '/' || CAST(CAST(d.d AS DATE) AS VARCHAR) AS key, s.symbol, 'trades' AS category FROM (SELECT DISTINCT symbol FROM tape) s, generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY) d(d))"


@query("""WITH s AS (SELECT DISTINCT event_type AS symbol FROM events), d AS (SELECT CAST(d AS DATE) AS d FROM generate_series(TIMESTAMP '2024-01-09', TIMESTAMP '2024-04-14', INTERVAL 1 DAY) g(d)), c AS (SELECT unnest(['klines', 'trades', 'fundingRate']) AS category),
x AS (SELECT symbol, category, d, category = 'fundingRate' OR (category = 'klines' AND date_trunc('month', d) >= DATE '2024-01-09' AND last_day(d) < DATE '2024-04-15') AS m FROM s, d, c),
y AS (SELECT DISTINCT symbol, category, CASE WHEN m THEN 'monthly' ELSE 'daily' END AS period, CASE WHEN m THEN strftime(d, '%Y-%m') ELSE strftime(d, '%Y-%m-%d') END AS date FROM x) SELECT *, concat_ws('/', symbol, category, period, date) AS key FROM y""")
def expected_sources(spark, sf_dir):
    return coverage.expected_sources(ad.tape(spark, sf_dir), ["klines", "trades", "fundingRate"], "2024-01-09", "2024-04-15")


@query(REQ + " SELECT key, symbol FROM req WHERE key NOT IN (SELECT key FROM man WHERE status = 'verified')")
def missing_sources(spark, sf_dir):
    return coverage.missing_sources(requested(spark, sf_dir), manifest(spark, sf_dir)).select("key", "symbol")


COVER = REQ.replace("bars AS", "bars_ AS") + """, counts AS (SELECT symbol, 'trades' AS category, count(DISTINCT date_trunc('hour', ts)) AS observed_rows, 720 AS expected_rows FROM tape GROUP BY 1),
cov AS (SELECT symbol, category, count(*) AS expected_files, count(*) FILTER (WHERE key IN (SELECT key FROM man WHERE status = 'verified')) AS verified_files, 0 AS supplemental_files, any_value(observed_rows) AS observed_rows, any_value(expected_rows) AS expected_rows FROM req JOIN counts USING (symbol, category) GROUP BY 1, 2)"""


def _coverage(spark, sf_dir):
    t = ad.tape(spark, sf_dir)
    counts = t.groupBy("symbol").agg(F.count_distinct(F.date_trunc("hour", "ts")).alias("observed_rows")).withColumns({"category": F.lit("trades"), "expected_rows": F.lit(720).cast("long")})
    return coverage.summary(requested(spark, sf_dir), manifest(spark, sf_dir).withColumn("category", F.lit("trades")), counts)


@query(COVER + " SELECT symbol, category, expected_files, verified_files, CAST(supplemental_files AS BIGINT) AS supplemental_files, observed_rows, CAST(expected_rows AS BIGINT) AS expected_rows, CAST(expected_rows - observed_rows AS BIGINT) AS missing_rows, round(observed_rows / expected_rows, 6) AS coverage_fraction FROM cov")
def coverage_summary(spark, sf_dir):
    return _coverage(spark, sf_dir)


@query(FAULTS + """, bad AS (SELECT count(*) AS n FROM audit WHERE invalid_rows + non_increasing_id_transitions + regressing_time_transitions + outside_partition_rows + quote_product_mismatch_rows > 0),
b AS (SELECT count(*) AS n FROM (SELECT date, lag(date) OVER w AS ld, first_id, lag(last_id) OVER w AS li, first_time_ms, lag(last_time_ms) OVER w AS lt FROM audit WINDOW w AS (PARTITION BY symbol ORDER BY date)) WHERE date_diff('day', ld, date) = 1 AND (first_id <= li OR first_time_ms < lt)),
k AS (SELECT count(*) AS n FROM (SELECT symbol, count(*) FILTER (WHERE (day(date) + length(symbol)) % 4 <> 0) AS v, 30 AS e FROM (SELECT DISTINCT symbol, date FROM tape) GROUP BY 1) WHERE v <> e),
er AS (SELECT count(*) AS n FROM (SELECT DISTINCT symbol, date FROM tape) WHERE day(date) % 13 = 0)
SELECT bad.n AS bad_partitions, b.n AS boundary_errors, k.n AS incomplete_categories, er.n AS errors, bad.n + b.n + k.n + er.n = 0 AS core_complete FROM bad, b, k, er""")
def verdict(spark, sf_dir):
    a = trades.audit(ad.tape(spark, sf_dir, faults=True))
    cover = _coverage(spark, sf_dir)
    # a category outside of the core does not count, whatever it lacks
    cover = cover.unionByName(cover.withColumns({"category": F.lit("metrics"), "verified_files": F.lit(0).cast("long")}))
    return coverage.verdict(a, trades.boundary_errors(a), cover, a.where(F.dayofmonth("date") % 13 == 0))


@query(MANIFEST + " SELECT status, count(*) AS n FROM man GROUP BY 1")
def status_counts(spark, sf_dir):
    return coverage.status_counts(manifest(spark, sf_dir))


@query(MANIFEST + """, o AS (SELECT key, 'old' AS status, sha256 AS source_sha256, 'o' || sha256 AS etag, CASE WHEN day(date) % 4 = 0 THEN 'then' END AS retrieved_at_utc FROM man WHERE day(date) % 2 = 0), n AS (SELECT key, status, CASE WHEN status = 'failed' THEN NULL ELSE 'n' || sha256 END AS source_sha256, CASE WHEN status = 'failed' THEN NULL ELSE 'n' || sha256 END AS etag, CASE WHEN day(date) % 9 = 0 THEN 'now' END AS retrieved_at_utc FROM man WHERE day(date) % 3 = 0)
 SELECT coalesce(n.key, o.key) AS key, CASE WHEN n.key IS NOT NULL THEN n.status ELSE o.status END AS status, CASE WHEN n.key IS NOT NULL THEN n.source_sha256 ELSE o.source_sha256 END AS source_sha256, coalesce(n.etag, o.etag) AS etag, coalesce(n.retrieved_at_utc, o.retrieved_at_utc) AS retrieved_at_utc FROM o FULL JOIN n ON o.key = n.key""")
def merge_manifests(spark, sf_dir):
    m, day = manifest(spark, sf_dir), F.dayofmonth("date")
    sha = F.when(F.col("status") != "failed", F.concat(F.lit("n"), "sha256"))
    old = m.where(day % 2 == 0).select("key", F.lit("old").alias("status"), F.col("sha256").alias("source_sha256"), F.concat(F.lit("o"), "sha256").alias("etag"), F.when(day % 4 == 0, "then").alias("retrieved_at_utc"))
    new = m.where(day % 3 == 0).select("key", "status", sha.alias("source_sha256"), sha.alias("etag"), F.when(day % 9 == 0, "now").alias("retrieved_at_utc"))
    return coverage.merge_manifests(old, new)


@query("""WITH e AS (SELECT DISTINCT event_type AS symbol, strftime(ts, '%d') AS month FROM events), f AS (SELECT symbol, month, CASE WHEN month = '07' THEN 'failed' ELSE 'published' END AS status FROM e WHERE month <> '03' UNION ALL SELECT symbol, month, 'published' FROM e WHERE month = '05' UNION ALL SELECT symbol, '99', 'published' FROM e WHERE month = '01'),
 g AS (SELECT symbol, month, count(*) AS n, bool_and(status = 'published') AS ok FROM f GROUP BY 1, 2), j AS (SELECT coalesce(e.symbol, g.symbol) AS symbol, coalesce(e.month, g.month) AS month, CASE WHEN g.n IS NULL THEN 'absent' WHEN e.month IS NULL THEN 'unexpected' WHEN n > 1 THEN 'duplicate' WHEN NOT ok THEN 'unpublished' END AS error FROM e FULL JOIN g ON e.symbol = g.symbol AND e.month = g.month) SELECT * FROM j WHERE error IS NOT NULL""")
def scope_check(spark, sf_dir):
    e = ad.read(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), F.date_format("ts", "dd").alias("month")).distinct()
    f = e.where("month <> '03'").withColumn("status", F.when(F.col("month") == "07", "failed").otherwise("published"))
    twice = e.where("month = '05'").withColumn("status", F.lit("published"))
    odd = e.where("month = '01'").select("symbol", F.lit("99").alias("month"), F.lit("published").alias("status"))
    return coverage.check_scopes(e, f.unionByName(twice).unionByName(odd))


@query("""WITH p AS (SELECT DISTINCT event_type AS asset, 'data/' || strftime(ts, '%Y-%m-%d') AS member FROM events), a AS (SELECT asset, member FROM p WHERE right(member, 1) <> '4' UNION ALL SELECT asset, 'tmp/x' FROM p WHERE right(member, 2) = '01' UNION ALL SELECT asset, 'etc/y' FROM p WHERE right(member, 2) = '02'), q AS (SELECT asset, member FROM p UNION SELECT asset, 'etc/y' FROM p WHERE right(member, 2) = '02')
 SELECT coalesce(q.asset, a.asset) AS asset, coalesce(q.member, a.member) AS member, CASE WHEN a.member IS NULL THEN 'not in archive' WHEN q.member IS NULL THEN 'not in catalog' ELSE 'outside data/' END AS problem FROM q FULL JOIN a ON q.asset = a.asset AND q.member = a.member WHERE a.member IS NULL OR q.member IS NULL OR NOT starts_with(q.member, 'data/')""")
def catalog_diff(spark, sf_dir):
    p = ad.read(spark, sf_dir, "events").select(F.col("event_type").alias("asset"), F.concat(F.lit("data/"), F.date_format("ts", "yyyy-MM-dd")).alias("member")).distinct()
    y = p.where("right(member, 2) = '02'").select("asset", F.lit("etc/y").alias("member"))
    actual = p.where("right(member, 1) <> '4'").unionByName(p.where("right(member, 2) = '01'").select("asset", F.lit("tmp/x").alias("member"))).unionByName(y)
    published = p.unionByName(y).groupBy("asset").agg(F.collect_set("member").alias("members"))  # a catalog's asset lists its members
    return coverage.catalog_diff(published, actual)


PAIR = ("click", "view")


@query(GRID + """ SELECT open_time, max(close) FILTER (WHERE symbol = 'click') AS click_close, max(volume) FILTER (WHERE symbol = 'click') AS click_volume, max(index_close) FILTER (WHERE symbol = 'click') AS click_index_close, max(close) FILTER (WHERE symbol = 'view') AS view_close, max(volume) FILTER (WHERE symbol = 'view') AS view_volume, max(index_close) FILTER (WHERE symbol = 'view') AS view_index_close,
 bool_and(close IS NOT NULL) AS both_ohlcv_valid, false AS prices_filled, false AS open_interest_interpolated, false AS macro_values_filled FROM (SELECT g1.*, i.close AS index_close FROM grid g1 JOIN grid i ON i.symbol = 'ALL' AND i.open_time = g1.open_time WHERE g1.symbol IN ('click', 'view')) GROUP BY 1""")
def panel_joint(spark, sf_dir):
    h = hourly(spark, sf_dir)
    pair = h.where(F.col("symbol").isin(*PAIR))
    index = h.where("symbol = 'ALL'").select(F.explode(F.array(*map(F.lit, PAIR))).alias("symbol"), "open_time", "close")
    return panel.build(panel.attach_close(pair, index, "index_close"), list(PAIR), ["close", "volume", "index_close"])


@query(GRID + """, oi AS (SELECT symbol, date_trunc('hour', ts) AS open_time, count(*) AS n, max(qty) AS v FROM tape GROUP BY 1, 2)
 SELECT symbol, open_time, close, CASE WHEN n = 1 THEN v END AS open_interest, coalesce(n > 1, false) AS open_interest_ambiguous FROM grid LEFT JOIN oi USING (symbol, open_time)""")
def panel_oi_exact(spark, sf_dir):
    oi = ad.tape(spark, sf_dir).select("symbol", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("event_time_utc"), "qty")
    return panel.attach_exact(hourly(spark, sf_dir), oi, "qty", "open_interest").select("symbol", "open_time", "close", "open_interest", "open_interest_ambiguous")


POS = """WITH pos AS (SELECT o_orderkey AS position_id, CASE WHEN o_orderkey % 3 = 0 THEN 'A' ELSE 'B' END AS symbol, o_orderdate AS entry, x.exit, o_totalprice AS notional, CASE WHEN o_orderkey % 2 = 0 THEN 'long' ELSE 'short' END AS side FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS exit FROM lineitem GROUP BY 1) x ON l_orderkey = o_orderkey)"""


@query(POS + """ SELECT position_id, CAST(f AS DOUBLE) AS fee_bps, CAST(s AS DOUBLE) AS slippage_bps, round(notional * f / 10000 + notional * s / 10000, 8) AS entry_cost, round(notional * 1.01 * f / 10000 + notional * 1.01 * s / 10000, 8) AS exit_cost FROM pos, (SELECT unnest([2.0, 4.0, 5.0]) AS f) a, (SELECT unnest([0.0, 1.0]) AS s) b""")
def cost_scenarios(spark, sf_dir):
    p = ad.positions(spark, sf_dir).withColumns({"entry_notional": F.col("notional"), "exit_notional": F.col("notional") * 1.01})
    df = costs.round_trip(p, costs.scenarios(spark, [2, 4, 5], [0, 1]))
    return rounded(df.select("position_id", "fee_bps", "slippage_bps", "entry_cost", "exit_cost"), "entry_cost", "exit_cost", places=8)


@query(POS + """, fund AS (SELECT s AS symbol, d AS paid_at, (month(d) % 5 - 2) * 0.0001::DOUBLE AS rate FROM (SELECT unnest(generate_series(CAST(date_trunc('month', min(o_orderdate)) AS TIMESTAMP), CAST(date_trunc('month', max(o_orderdate)) AS TIMESTAMP) + INTERVAL 6 MONTH, INTERVAL 1 MONTH)) AS d FROM orders), (SELECT unnest(['A', 'B']) AS s))
 SELECT position_id, count(paid_at) AS payments, round(coalesce(sum(CASE WHEN side = 'long' THEN -1 ELSE 1 END * notional * rate), 0), 8) AS paid FROM pos LEFT JOIN fund ON fund.symbol = pos.symbol AND paid_at > entry AND paid_at <= exit GROUP BY 1""")
def funding_paid(spark, sf_dir):
    return rounded(costs.funding_paid(ad.positions(spark, sf_dir), ad.funding(spark, sf_dir)), "paid", places=8)


@query("SELECT event_type AS symbol, CASE WHEN user_id % 2 = 0 THEN 'sell' ELSE 'buy' END AS taker_side, count(*) AS n FROM events GROUP BY 1, 2")
def taker_side(spark, sf_dir):
    return ad.tape(spark, sf_dir).groupBy("symbol", trades.taker_side().alias("taker_side")).agg(F.count("*").alias("n"))


@query("""WITH d AS (SELECT DISTINCT event_type AS t, CAST(ts AS DATE) AS d FROM events)
 SELECT t AS event_type, strftime(d, '%Y-%m') AS reference_period, CAST(d AS TIMESTAMP) + INTERVAL 810 MINUTE AS scheduled_release_at_utc FROM d WHERE d >= DATE '2024-01-04' AND d < DATE '2024-01-28'""")
def release_events(spark, sf_dir):
    d = ad.read(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("d")).distinct()
    cell = "<tr><th> {} </th><td><b>{}</b></td>\n<td>08:30  AM</td></tr><tr><td>no date</td></tr>"
    text = F.format_string(cell.replace("{}", "%s"), F.date_format("d", "yyyy-MM"), F.date_format("d", "MMM d, yyyy"))
    rows = macro.html_rows(d.select("event_type", text.alias("value")), keep=["event_type"])
    return macro.release_events(rows, "2024-01-04", "2024-01-28", F.col("event_type")).select("event_type", "reference_period", F.col("scheduled_release_at_utc").cast("timestamp_ntz").alias("scheduled_release_at_utc"))


@query("""WITH s AS (SELECT 'u' || user_id AS series, user_id AS u, count(*) AS n FROM events GROUP BY 2), o AS (SELECT series, CASE WHEN u % 3 = 0 THEN 'failed' ELSE 'acquired' END AS status, u % 5 <> 0 AS bytes_match, n AS "rows", 'raw/' || series AS relative_path FROM s WHERE u % 2 = 0),
 n AS (SELECT series, CASE WHEN u % 4 = 0 THEN 'failed' ELSE 'acquired' END AS status, n + 1 AS "rows", CASE WHEN u % 4 = 0 THEN 'timeout' END AS error, CASE WHEN u % 4 <> 0 THEN 'new/' || series END AS relative_path FROM s WHERE u % 7 <> 0),
 j AS (SELECT n.*, coalesce(n.status <> 'acquired' AND o.status = 'acquired' AND o.bytes_match, false) AS back, o.status AS os, o."rows" AS orows, o.relative_path AS opath FROM n LEFT JOIN o ON o.series = n.series)
 SELECT series, CASE WHEN back THEN os ELSE status END AS status, CASE WHEN back THEN orows ELSE "rows" END AS "rows", CASE WHEN back THEN opath ELSE relative_path END AS relative_path, back AS resumed_from_initial_release, CASE WHEN back THEN error END AS new_fetch_error FROM j""")
def macro_merge(spark, sf_dir):
    s = ad.read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("u")).agg(F.count("*").alias("rows")).withColumn("series", F.concat(F.lit("u"), "u"))
    failed = F.col("u") % 4 == 0
    old = s.where("u % 2 = 0").select("series", F.when(F.col("u") % 3 == 0, "failed").otherwise("acquired").alias("status"), (F.col("u") % 5 != 0).alias("bytes_match"), "rows", F.concat(F.lit("raw/"), "series").alias("relative_path"))
    new = s.where("u % 7 <> 0").select("series", F.when(failed, "failed").otherwise("acquired").alias("status"), (F.col("rows") + 1).alias("rows"), F.when(failed, "timeout").alias("error"), F.when(~failed, F.concat(F.lit("new/"), "series")).alias("relative_path"))
    return macro.merge_sources(old, new)


DIFFS = TAPE + """, l AS (SELECT symbol, CAST(date_diff('day', TIMESTAMP '2024-01-01', ts) AS INTEGER) AS session, id AS seq, id AS u, lag(id) OVER (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY id) AS p, price, qty FROM tape), d AS (SELECT *, CASE WHEN u % 211 = 0 THEN p - 1 ELSE p END AS pu FROM l)"""


def _diffs(spark, sf_dir):
    t = ad.tape(spark, sf_dir)
    p = F.lag("id").over(Window.partitionBy("symbol", "date").orderBy("id"))
    df = t.select("symbol", F.datediff("date", F.lit("2024-01-01").cast("date")).alias("session"), F.col("id").alias("seq"), F.col("id").alias("u"), p.alias("p"), "price", "qty")
    return df.withColumn("pu", F.when(F.col("u") % 211 == 0, F.col("p") - 1).otherwise(F.col("p")))


@query(DIFFS + " SELECT symbol, session, u, coalesce(pu <> lag(u) OVER w, false) AS gap, CAST(sum(CASE WHEN pu <> p THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, session ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM d WINDOW w AS (PARTITION BY symbol, session ORDER BY seq)")
def l2_gaps(spark, sf_dir):
    return book.sequence_gaps(_diffs(spark, sf_dir)).select("symbol", "session", "u", "gap", "island")


@query(DIFFS + ", v AS (SELECT symbol, session, CASE WHEN u % 2 = 0 THEN 'bid' ELSE 'ask' END AS side, CAST(round(price) AS DOUBLE) AS price, arg_max(qty, seq) AS qty FROM d GROUP BY 1, 2, 3, 4) SELECT * FROM v WHERE qty > 0")
def l2_final_levels(spark, sf_dir):
    d = _diffs(spark, sf_dir).withColumns({"side": F.when(F.col("u") % 2 == 0, "bid").otherwise("ask"), "price": F.round("price")})
    return book.final_levels(d)


@query(DIFFS + ", o AS (SELECT symbol, session, seq, p IS NULL AS first_, sum(CASE WHEN p IS NOT NULL AND u % 211 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY symbol, session ORDER BY seq ROWS UNBOUNDED PRECEDING) AS breaks, p IS NOT NULL AND u % 211 = 0 AS brk FROM d) SELECT symbol, session, seq, CASE WHEN first_ THEN 'snapshot' WHEN breaks = 0 THEN 'applied' WHEN breaks = 1 AND brk THEN 'gap' ELSE 'ignored' END AS outcome FROM o")
def l2_replay_stream(spark, sf_dir):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    d = _diffs(spark, sf_dir)
    level = F.concat(F.col("price").cast("string"), F.lit(":"), F.col("qty").cast("string"))
    e = d.select("symbol", "session", "seq", F.when(F.col("p").isNull(), "snapshot").otherwise("diff").alias("type"), F.coalesce("p", "u").alias("first"), "u", F.coalesce("pu", "u").alias("pu"), level.alias("bids"), F.lit("").alias("asks"))
    path = shared(spark, "envelopes")
    e.write.parquet(path)
    done = shared(spark, "replayed")
    jobs.replay_files(spark.readStream.schema(e.schema).parquet(path), done, shared(spark, "state")).awaitTermination()
    return spark.read.schema(jobs.REPLAYED).parquet(done)


@query(GRID + """ SELECT symbol, time_bucket(INTERVAL 4 HOUR, open_time) AS open_time, arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, open_time) AS close, sum(volume) AS volume, CAST(sum("count") AS BIGINT) AS "count" FROM grid GROUP BY 1, 2
 HAVING count(close) = 4 AND time_bucket(INTERVAL 4 HOUR, any_value(open_time)) + INTERVAL 4 HOUR <= (SELECT max(open_time) FROM bars) - INTERVAL 2 MINUTE""")
def resample_stream(spark, sf_dir):
    minutes = hourly(spark, sf_dir).withColumn("open_time", F.col("open_time").cast("timestamp"))
    path, out = shared(spark, "minutes"), shared(spark, "bars")
    minutes.write.parquet(path)
    df = jobs.resample_stream(spark.readStream.schema(minutes.schema).parquet(path), "4 hours", 4)
    df.writeStream.format("parquet").option("path", out).option("checkpointLocation", shared(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(out).select("symbol", F.col("open_time").cast("timestamp_ntz").alias("open_time"), "open", "high", "low", "close", "volume", "count")


@query(FAULTS + " SELECT * FROM audit")
def audit_stream(spark, sf_dir):
    """Rows land by time, so days are split over files and batches; a second run finds nothing new."""
    t = ad.tape(spark, sf_dir, faults=True)
    place = F.row_number().over(Window.partitionBy("symbol", "date").orderBy("row_idx")) - 1
    path, out, state = shared(spark, "landed"), shared(spark, "audits"), shared(spark, "state")
    t.withColumn("row_idx", place.cast("long")).repartitionByRange(8, "ts").sortWithinPartitions("symbol", "date", "row_idx").write.parquet(path)
    for _ in range(2):
        landed = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 3).parquet(path)
        jobs.audit_stream(landed, out, state).awaitTermination()
    return jobs.audited(spark, out)
