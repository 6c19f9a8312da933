"""Queries of readers, writers and row checks: files are made from the driver's tables by Spark, written, and read back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.jobs.queries import BARS, CANDLES, DIFFS, FAULTS, GRID, MANIFEST, REQ, TAPE, _diffs, hourly, manifest, query, requested, rounded, shared
from marketlake.operators import bars, book, coverage, macro, quality, trades
from marketlake.sources import adapters as ad
from marketlake.sources import readers
from marketlake.streaming import jobs

TRADE = ["id", "price", "qty", "quote_qty", "time", "is_buyer_maker"]


def _write_files(rows, path, name, begin, end):
    """Writes a file for each (symbol, date) of rows (symbol, date, id, ...), in order of id, while the rows stream by; nothing is gathered.

    name(symbol, date): the file below path. begin(stream, symbol, date): what takes the rows' chunks; end: closes it.
    """

    def run(it):
        import pandas as pd

        from marketlake.sources.archive import file_system

        fs, at = file_system(path)
        now = out = None
        made = 0
        for g in it:
            for key, rows in g.groupby(["symbol", "date"], sort=False):
                if key != now:
                    if out is not None:
                        end(out)
                    now, made = key, made + 1
                    file = f"{at}/{name(*key)}"
                    fs.create_dir(file.rpartition("/")[0], recursive=True)
                    out = begin(fs.open_output_stream(file), *key)
                out["add"](rows)
        if out is not None:
            end(out)
        yield pd.DataFrame({"files": [made]})

    dealt = rows.repartition("symbol", "date").sortWithinPartitions("symbol", "date", "id")
    dealt.mapInPandas(run, "files long").agg(F.sum("files")).first()


def _zip_begin(stream, symbol, date):
    import zipfile

    z = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
    member = z.open("trades.csv", "w")
    state = {"header": bool(date.day % 2)}

    def add(rows):
        text = rows[TRADE].assign(is_buyer_maker=rows["is_buyer_maker"].map({True: "true", False: "false"})).to_csv(index=False, header=state["header"])
        state["header"] = False
        member.write(text.encode())

    return {"add": add, "close": (member, z, stream)}


def _ids_begin(stream, symbol, date):
    state = {"first": True}

    def add(rows):
        stream.write((("" if state["first"] else ",") + ",".join(map(str, rows["id"]))).encode())
        state["first"] = False

    return {"add": add, "close": (stream,)}


def _end(out):
    for x in out["close"]:
        x.close()


@query(TAPE + """ SELECT symbol || '/' || CAST(date AS VARCHAR) || '.zip' AS file, row_number() OVER (PARTITION BY symbol, date ORDER BY id) - 1 AS row_idx, id, price, qty, quote_qty, time, CASE WHEN is_buyer_maker THEN 'true' ELSE 'false' END AS is_buyer_maker FROM tape""")
def archive_rows(spark, sf_dir):
    """Every partition as an archive of one CSV, half of them with a header, and back through the data source."""
    path = shared(spark, "archives")
    _write_files(ad.tape(spark, sf_dir).select("symbol", "date", *TRADE), path, lambda symbol, date: f"{symbol}/{date}.zip", _zip_begin, _end)
    rows = readers.read_archive(spark, path, TRADE)
    kinds = {"id": "long", "price": "double", "qty": "double", "quote_qty": "double", "time": "long", "is_buyer_maker": "string"}
    return rows.select(F.regexp_extract("file", "([^/]+/[^/]+)$", 1).alias("file"), "row_idx", *(F.col(c).cast(k).alias(c) for c, k in kinds.items()))


def _id_files(spark, sf_dir, path, some=None):
    """Files of ids, a file a partition, and what they are: path, bytes, sha256, name."""
    t = ad.tape(spark, sf_dir).select("symbol", "date", "id")
    _write_files(t if some is None else t.where(some), path, lambda symbol, date: f"{symbol}-{date}", _ids_begin, _end)
    return readers.file_inventory(spark, path).withColumn("name", F.element_at(F.split("path", "/"), -1))


@query(TAPE + """, f AS (SELECT symbol || '-' || CAST(date AS VARCHAR) AS name, day(date) AS d, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS content FROM tape GROUP BY symbol, date)
 SELECT name, d % 7 <> 0 AND d % 11 <> 0 AS ok, CASE WHEN d % 11 <> 0 THEN sha256(content) END AS sha256 FROM f""")
def checksums(spark, sf_dir):
    return _checked(spark, sf_dir).select("name", "ok", "sha256")


def _checked(spark, sf_dir):
    """Partitions as files: some of other bytes than the manifest says, some not there. The manifest is of an earlier reading."""
    whole = _id_files(spark, sf_dir, shared(spark, "acquired"))
    day = F.regexp_extract("name", "-([0-9]+)$", 1).cast("int")
    manifest = whole.select("name", F.when(day % 7 == 0, "other").otherwise(F.col("sha256")).alias("sha256"))
    have = _id_files(spark, sf_dir, shared(spark, "raw"), F.dayofmonth("date") % 11 != 0)
    return readers.check_inventory(have, manifest)


@query(TAPE + " SELECT symbol || '-' || CAST(date AS VARCHAR) AS path, length(string_agg(CAST(id AS VARCHAR), ',' ORDER BY id)) AS bytes FROM tape GROUP BY symbol, date")
def file_sizes(spark, sf_dir):
    return _id_files(spark, sf_dir, shared(spark, "sized")).select(F.col("name").alias("path"), "bytes")


CANDLE_ROWS = GRID + """ SELECT symbol, epoch_ms(open_time) AS open_time, open, high, low, close, volume, epoch_ms(open_time) + 3599999 AS close_time, round(quote_volume, 4) AS quote_volume, "count", taker_buy_volume, round(taker_buy_quote_volume, 4) AS taker_buy_quote_volume FROM grid WHERE close IS NOT NULL"""


def _candles(spark, sf_dir):
    ms = F.unix_millis(F.col("open_time").cast("timestamp"))
    h = hourly(spark, sf_dir).where("close is not null").withColumns({"open_time": ms, "close_time": ms + 3_599_999, "ignore": F.lit(0)})
    return rounded(h, "quote_volume", "taker_buy_quote_volume", places=4).select("symbol", *readers.CANDLE)


@query(CANDLE_ROWS)
def candle_files(spark, sf_dir):
    """Candles as CSV files without a header, a folder a symbol, and back."""
    path = shared(spark, "candles")
    _candles(spark, sf_dir).write.partitionBy("symbol").option("header", False).csv(path)
    df = readers.read_candles(spark, f"{path}/*/*.csv")
    return df.withColumn("symbol", F.regexp_extract("file", "symbol=([^/]+)/", 1)).drop("file", "row_idx", "ignore")


@query(FAULTS + """ SELECT symbol, date, "rows", CASE WHEN day(date) % 7 = 0 OR day(date) % 11 = 0 THEN 'failed' ELSE status END AS status, CASE WHEN day(date) % 11 = 0 THEN 'source is missing' WHEN day(date) % 7 = 0 THEN 'source checksum changed' END AS error FROM audit""")
def trade_audit_verified(spark, sf_dir):
    """Audits of partitions whose files are not what the manifest says have failed."""
    audit = trades.audit(ad.tape(spark, sf_dir, faults=True)).withColumn("name", F.concat_ws("-", "symbol", F.col("date").cast("string")))
    return trades.verified(audit, _checked(spark, sf_dir)).select("symbol", "date", "rows", "status", "error")


@query(MANIFEST + " SELECT key, symbol, 'trades' AS category, CAST(date AS VARCHAR) AS date, status, sha256 AS source_sha256, length(sha256) AS bytes, CAST(NULL AS VARCHAR) AS repair_for FROM man")
def manifest_files(spark, sf_dir):
    """The manifest as JSON, ordered by key, and back."""
    path = shared(spark, "manifest")
    m = manifest(spark, sf_dir).withColumns({"category": F.lit("trades"), "date": F.col("date").cast("string"), "source_sha256": F.col("sha256"), "bytes": F.length("sha256").cast("long")})
    readers.write_manifest(m.drop("sha256"), path)
    return readers.read_manifest(spark, path, lines=True).select("key", "symbol", "category", "date", "status", "source_sha256", "bytes", "repair_for")


@query("""SELECT event_type AS series, CAST(ts AS DATE) AS observation_date, CASE WHEN day(ts) % 5 = 0 THEN NULL ELSE CAST(count(*) AS DOUBLE) END AS "value" FROM events GROUP BY event_type, CAST(ts AS DATE), day(ts)""")
def macro_series(spark, sf_dir):
    """A CSV a series, a line a day, dots for what was not observed."""
    d = ad.read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("d")).agg(F.count("*").alias("n"))
    line = F.concat_ws(",", F.col("d").cast("string"), F.when(F.dayofmonth("d") % 5 == 0, ".").otherwise(F.col("n").cast("string")))
    files = d.groupBy("series").agg(F.concat(F.lit("DATE,VALUE\r\n"), F.array_join(F.sort_array(F.collect_list(line)), "\r\n"), F.lit("\n")).alias("content"))  # a line a day
    return macro.parse_series(files)


@query(DIFFS + " SELECT symbol, session, seq, CASE WHEN p IS NULL THEN 'snapshot' ELSE 'diff' END AS type, coalesce(p, u) AS first, u, coalesce(pu, u) AS pu, CAST(id_price AS VARCHAR) || ':' || CAST(id_qty AS VARCHAR) AS bids, '' AS asks FROM (SELECT *, CAST(floor(price * 100) AS BIGINT) AS id_price, CAST(qty AS BIGINT) AS id_qty FROM d)")
def l2_envelopes(spark, sf_dir):
    """Updates as JSON envelopes with ids that differ by case only, and back."""
    d = _diffs(spark, sf_dir)
    level = F.concat(F.lit('[["'), F.floor(F.col("price") * 100).cast("string"), F.lit('","'), F.col("qty").cast("long").cast("string"), F.lit('"]]'))
    snapshot = F.format_string('{"lastUpdateId":%d,"bids":%s,"asks":[]}', "u", level)
    diff = F.format_string('{"U":%d,"u":%d,"pu":%d,"b":%s,"a":[]}', "p", "u", "pu", level)
    text = F.format_string('{"symbol":"%s","type":"%s","session":%d,"seq":%d,"payload":%s}', "symbol", F.when(F.col("p").isNull(), "snapshot").otherwise("diff"), "session", "seq", F.when(F.col("p").isNull(), snapshot).otherwise(diff))
    path = shared(spark, "lines")
    d.select(text.alias("value")).write.text(path)
    return readers.read_envelopes(spark, path)


@query("""SELECT event_type AS symbol, CAST(epoch_ms(date_trunc('hour', ts)) AS BIGINT) AS funding_time, date_trunc('hour', ts) AS event_time_utc, CAST(count(*) AS DOUBLE) / 10000 AS last_funding_rate FROM events GROUP BY event_type, date_trunc('hour', ts)""")
def funding_pages(spark, sf_dir):
    """Pages of a funding history, a JSON list a symbol and day."""
    h = ad.read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("t")).agg(F.count("*").alias("n"))
    row = F.struct("symbol", F.unix_millis(F.col("t").cast("timestamp")).alias("fundingTime"), (F.col("n") / 10000).cast("string").alias("fundingRate"))
    pages = h.groupBy("symbol", F.to_date("t").alias("d")).agg(F.to_json(F.sort_array(F.collect_list(row))).alias("page"))  # 24 rows at most
    df = readers.parse_funding_pages(pages)
    return df.withColumn("event_time_utc", F.col("event_time_utc").cast("timestamp_ntz"))


@query(CANDLE_ROWS)
def table_files(spark, sf_dir):
    """Candles as a table by symbol, its files sorted by time, and back."""
    path = shared(spark, "table")
    readers.write_table(_candles(spark, sf_dir).drop("ignore"), path, partition_by=["symbol"], sort_by=["open_time"])
    return spark.read.parquet(path)


@query(MANIFEST + " SELECT status, count(*) AS n FROM man GROUP BY 1")
def report_file(spark, sf_dir):
    path = shared(spark, "report")
    readers.write_report(coverage.status_counts(manifest(spark, sf_dir)), path, order_by=["status"])
    return spark.read.schema("status string, n long").json(path)


def _metrics(spark, sf_dir):
    """Open-interest rows in the archive's form: another symbol, a negative and a missing figure planted by modulus."""
    t, n = ad.tape(spark, sf_dir), F.col("id")
    return t.select(
        F.col("symbol").alias("asked"), "id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("create_time"), F.when(n % 97 == 0, "other").otherwise(F.col("symbol")).alias("symbol"),
        F.when(n % 89 == 0, -F.col("qty") - 1).otherwise(F.col("qty")).alias("sum_open_interest"), F.when(n % 83 == 0, F.lit(float("nan"))).when(n % 79 != 0, F.col("price")).alias("sum_open_interest_value"),
    )


@query(TAPE + " SELECT symbol, id FROM tape WHERE id % 97 = 0 OR id % 89 = 0 OR id % 83 = 0 OR id % 79 = 0")
def metrics_invalid_rows(spark, sf_dir):
    m = quality.require_columns(_metrics(spark, sf_dir), ["create_time", "symbol", "sum_open_interest", "sum_open_interest_value"])
    return m.where(quality.metrics_invalid(F.col("asked"))).select(F.col("asked").alias("symbol"), "id")


def _depth(spark, sf_dir):
    n = F.col("id")
    figures = {"depth": F.when(n % 53 == 0, -F.col("qty") - 1).otherwise(F.col("qty")), "notional": F.when(n % 59 == 0, -1.0).otherwise(F.col("price"))}
    return ad.tape(spark, sf_dir).select("symbol", "date", "id", F.col("ts").cast("string").alias("timestamp"), F.lit(1.0).alias("percentage"), *(c.alias(k) for k, c in figures.items()))


@query(TAPE + " SELECT symbol, id FROM tape WHERE id % 53 = 0 OR id % 59 = 0")
def depth_invalid_rows(spark, sf_dir):
    return quality.require_columns(_depth(spark, sf_dir), ["timestamp", "percentage", "depth", "notional"]).where(quality.depth_invalid()).select("symbol", "id")


@query(TAPE + """ SELECT 'metrics' AS category, id, date_trunc('second', ts) AS event_time FROM tape UNION ALL SELECT 'depth', id, date_trunc('second', ts) FROM tape UNION ALL SELECT 'funding', id, make_timestamp(time * 1000) FROM tape""")
def event_times(spark, sf_dir):
    """Times of the three kinds of sources: text, text, and epochs, in microseconds in some files."""
    t = ad.tape(spark, sf_dir)
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    made = {
        "metrics": quality.with_event_time(t.select("id", text.alias("create_time")), "metrics"),
        "depth": quality.with_event_time(t.select("id", text.alias("timestamp")), "depth"),
        "funding": quality.with_event_time(t.select("id", F.col("symbol").alias("file"), F.when(F.col("symbol") == "click", F.col("time") * 1000).otherwise(F.col("time")).alias("calc_time")), "funding"),
    }
    parts = [df.select(F.lit(k).alias("category"), "id", F.col("event_time_utc").cast("timestamp_ntz").alias("event_time")) for k, df in made.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(TAPE + " SELECT symbol, id FROM tape WHERE ts >= TIMESTAMP '2024-01-09' AND ts < TIMESTAMP '2024-02-01'")
def month_scoped(spark, sf_dir):
    start, end = coverage.month_scope("2024-01-09", "2024-04-15", "2024-01")
    return bars.clip_window(ad.tape(spark, sf_dir), "ts", start, end).select("symbol", "id")


@query(REQ + """, r AS (SELECT key, symbol, CAST(NULL AS VARCHAR) AS repair_for FROM man UNION ALL SELECT key || '/again', symbol, key FROM man WHERE day(date) % 5 = 0) SELECT key, symbol, repair_for FROM r WHERE key IN (SELECT key FROM req WHERE right(key, 1) <> '7') OR repair_for IN (SELECT key FROM req WHERE right(key, 1) <> '7')""")
def records_in_scope(spark, sf_dir):
    m = manifest(spark, sf_dir)
    repairs = m.where(F.dayofmonth("date") % 5 == 0).select(F.concat("key", F.lit("/again")).alias("key"), "symbol", F.col("key").alias("repair_for"))
    records = m.select("key", "symbol", F.lit(None).cast("string").alias("repair_for")).unionByName(repairs)
    return coverage.in_scope(records, requested(spark, sf_dir).where("right(key, 1) <> '7'"))


@query(MANIFEST + ", r AS (SELECT key, symbol, strftime(date, '%d') AS month FROM man UNION ALL SELECT key, symbol, '99' FROM man WHERE day(date) = 7 UNION ALL SELECT key, symbol, strftime(date, '%d') FROM man WHERE day(date) = 9) SELECT key, count(*) AS times, count(DISTINCT (symbol, month)) AS scopes FROM r GROUP BY 1 HAVING count(*) > 1")
def scope_keys(spark, sf_dir):
    m = manifest(spark, sf_dir).select("key", "symbol", F.date_format("date", "dd").alias("month"))
    return coverage.keys_in_scopes(m.unionByName(m.where("month = '07'").withColumn("month", F.lit("99"))).unionByName(m.where("month = '09'")))


@query(TAPE + """, f AS (SELECT symbol || '/' || CAST(day(date) % 7 AS VARCHAR) AS symbol, id AS row_idx, CASE WHEN symbol = 'click' AND id % 501 = 0 THEN 0 WHEN symbol = 'view' AND id % 401 = 0 THEN 1704067200001 ELSE time END AS t FROM tape), x AS (SELECT *, t - lag(t) OVER (PARTITION BY symbol ORDER BY row_idx) AS step FROM f)
 SELECT symbol, count(*) = count(DISTINCT t) AS is_unique, NOT coalesce(bool_or(step < 0), false) AS is_increasing, NOT bool_or(t < 1704067200000 OR t > 1706572800000) AS is_inside FROM x GROUP BY 1""")
def funding_qa(spark, sf_dir):
    t, n = ad.tape(spark, sf_dir), F.col("id")
    time = F.when((F.col("symbol") == "click") & (n % 501 == 0), 0).when((F.col("symbol") == "view") & (n % 401 == 0), 1704067200001).otherwise(F.col("time"))
    df = t.select(F.concat_ws("/", "symbol", (F.dayofmonth("date") % 7).cast("string")).alias("symbol"), n.alias("row_idx"), time.alias("funding_time"))
    return quality.funding_qa(df, 1704067200000, 1706572800000)


@query(BARS + " SELECT symbol, open_time, close FROM bars")
def union_unique_times(spark, sf_dir):
    """Daily and monthly files of one series put together; a time that came twice would be an error."""
    t = ad.both(spark, sf_dir)
    early, late = (bars.from_trades(t.where(cond), "1 hour") for cond in ("date < date'2024-01-16'", "date >= date'2024-01-16'"))
    path = shared(spark, "parts")
    early.write.parquet(f"{path}/monthly")
    late.write.parquet(f"{path}/daily")
    return bars.assert_unique(spark.read.parquet(f"{path}/monthly", f"{path}/daily"), ["symbol", "open_time"]).select("symbol", "open_time", "close")


@query("""WITH e AS (SELECT DISTINCT event_type, date_trunc('hour', ts) AS t FROM events), o AS (SELECT event_type, t, 'old' AS source FROM e WHERE hour(t) % 2 = 0), n AS (SELECT event_type, t, 'new' AS source FROM e WHERE hour(t) % 3 = 0)
 SELECT coalesce(n.event_type, o.event_type) AS event_type, coalesce(n.t, o.t) AS scheduled_release_at_utc, coalesce(n.source, o.source) AS source FROM o FULL JOIN n ON o.event_type = n.event_type AND o.t = n.t""")
def calendar_merge(spark, sf_dir):
    e = ad.read(spark, sf_dir, "events").select("event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("scheduled_release_at_utc")).distinct()
    part = lambda k, name: e.where(F.hour("scheduled_release_at_utc") % k == 0).withColumn("source", F.lit(name))
    return macro.merge_events(part(2, "old"), part(3, "new"))


REPLAY = TAPE + """, n AS (SELECT symbol, CAST(date_diff('day', TIMESTAMP '2024-01-01', ts) AS INTEGER) AS session, id AS seq, row_number() OVER w AS rn, count(*) OVER (PARTITION BY symbol, CAST(ts AS DATE)) AS n FROM tape WINDOW w AS (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY id)),
x AS (SELECT *, CAST(CASE WHEN rn NOT IN (1, 4) AND seq % 47 = 0 THEN 1 ELSE 0 END AS INTEGER) AS crossing FROM n WHERE n >= 4), y AS (SELECT *, sum(crossing) OVER (PARTITION BY symbol, session ORDER BY seq ROWS UNBOUNDED PRECEDING) AS upto FROM x),
replayed AS (SELECT symbol, session, seq, CASE WHEN rn = 4 THEN 'snapshot' WHEN rn = 1 THEN 'stale' WHEN upto = 0 THEN 'applied' WHEN upto = 1 AND crossing = 1 THEN 'gap' ELSE 'ignored' END AS outcome FROM y)"""


def _replayed(spark, sf_dir):
    """Sessions whose snapshot comes fourth and holds the second update: the first is stale, the next two wait; some bids cross."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    w = Window.partitionBy("symbol", "date").orderBy("id")
    u = F.col("id")
    t = ad.tape(spark, sf_dir).withColumns({"rn": F.row_number().over(w), "p": F.lag("id").over(w), "before": F.lag("id", 2).over(w)})
    snapshot = F.col("rn") == 4
    # what follows the snapshot continues from the third update, as if the fourth had never been one
    prior = F.when(F.col("rn") == 5, F.col("before")).otherwise(F.col("p"))
    bid = F.when(~snapshot & (F.col("rn") != 1) & (u % 47 == 0), F.lit("90000:1")).otherwise(F.concat(F.floor(F.col("price")).cast("string"), F.lit(":"), F.col("qty").cast("string")))
    ask = F.concat((F.floor(F.col("price")) + 50000).cast("string"), F.lit(":"), (u % 3).cast("string"))
    e = t.select(
        "symbol", F.datediff("date", F.lit("2024-01-01").cast("date")).alias("session"), u.alias("seq"), F.when(snapshot, "snapshot").otherwise("diff").alias("type"),
        F.coalesce(prior, u).alias("first"), F.when(snapshot, F.col("before")).otherwise(u).alias("u"), F.coalesce(prior, u - 1).alias("pu"), bid.alias("bids"), ask.alias("asks"),
    )
    path, done = shared(spark, "envelopes"), shared(spark, "replayed")
    e.write.parquet(path)
    jobs.replay_files(spark.readStream.schema(e.schema).parquet(path), done, shared(spark, "state")).awaitTermination()
    return spark.read.schema(jobs.REPLAYED).parquet(done)


@query(REPLAY + " SELECT * FROM replayed")
def l2_replay_waiting(spark, sf_dir):
    return _replayed(spark, sf_dir)


@query(REPLAY + """ SELECT symbol, count(*) FILTER (WHERE outcome <> 'snapshot') AS events, count(*) FILTER (WHERE outcome = 'applied') AS synchronized_events, count(DISTINCT session) AS sessions, count(*) FILTER (WHERE outcome = 'gap') AS gaps,
 CASE WHEN bool_or(outcome = 'failed') THEN 'blocked_or_failed' WHEN bool_or(outcome = 'applied') THEN 'captured' ELSE 'no_synchronized_data' END AS status FROM replayed GROUP BY 1""")
def l2_report(spark, sf_dir):
    return book.report(_replayed(spark, sf_dir))


FILES = CANDLES + """, trade_rows AS (SELECT 'trades/' || symbol || '/' || CAST(date AS VARCHAR) AS file, row_number() OVER w - 1 AS pos, CASE WHEN id % 101 = 0 THEN 0.0::DOUBLE ELSE price END AS price, qty, CASE WHEN id % 107 = 0 THEN id - 1 ELSE id END - lag(CASE WHEN id % 107 = 0 THEN id - 1 ELSE id END) OVER w AS step FROM tape WINDOW w AS (PARTITION BY symbol, date ORDER BY id)),
found AS (SELECT 'klines/' || file AS file, unnest([struct_pack(rule := 'invalid_rows', n := invalid_rows), struct_pack(rule := 'duplicate_times', n := duplicate_times), struct_pack(rule := 'out_of_order', n := CAST(out_of_order AS INTEGER))]) AS f FROM qa
 UNION ALL SELECT 'trades/' || symbol || '/' || CAST(date AS VARCHAR), struct_pack(rule := 'checksum_changed', n := 1) FROM (SELECT DISTINCT symbol, date FROM tape) WHERE day(date) % 7 = 0
 UNION ALL SELECT file, unnest([struct_pack(rule := 'invalid_sampled_trade', n := count(*) FILTER (WHERE price <= 0 OR qty <= 0)), struct_pack(rule := 'invalid_sampled_ids', n := count(*) FILTER (WHERE step <= 0))]) FROM trade_rows WHERE pos < 1000 GROUP BY file
 UNION ALL SELECT 'metrics/' || symbol || '/' || CAST(date AS VARCHAR), unnest([struct_pack(rule := 'other_symbol', n := count(*) FILTER (WHERE id % 97 = 0)), struct_pack(rule := 'negative_open_interest', n := count(*) FILTER (WHERE id % 89 = 0)), struct_pack(rule := 'open_interest_not_finite', n := count(*) FILTER (WHERE id % 83 = 0 OR id % 79 = 0))]) FROM tape GROUP BY symbol, date
 UNION ALL SELECT 'bookDepth/' || symbol || '/' || CAST(date AS VARCHAR), struct_pack(rule := 'negative_depth', n := count(*) FILTER (WHERE id % 53 = 0 OR id % 59 = 0)) FROM tape GROUP BY symbol, date
 UNION ALL SELECT 'fundingRate/' || symbol || '/' || CAST(date AS VARCHAR), struct_pack(rule := 'missing_column:last_funding_rate', n := 1) FROM (SELECT DISTINCT symbol, date FROM tape) WHERE day(date) % 9 = 0)
 SELECT file, string_agg(f.rule || '=' || CAST(f.n AS VARCHAR), ', ' ORDER BY f.rule) AS reasons FROM found WHERE f.n > 0 GROUP BY file"""


@query(FILES)
def file_reasons(spark, sf_dir):
    """Files of five categories, some with bytes or columns that are not as they should be: every broken rule of each."""
    t = ad.tape(spark, sf_dir)
    file = lambda kind, symbol="symbol": F.concat_ws("/", F.lit(kind), symbol, F.col("date").cast("string"))
    files = t.select("symbol", "date").distinct()
    day = F.dayofmonth("date")
    w = Window.partitionBy("symbol", "date").orderBy("row_idx")
    qa = quality.candle_qa(ad.candles(spark, sf_dir, hourly(spark, sf_dir)), interval_ms=3_600_000).withColumn("file", F.concat(F.lit("klines/"), "file"))
    checked = files.select(file("trades").alias("name"), file("trades").alias("path"), (day % 7 != 0).alias("ok"))
    faulty = ad.tape(spark, sf_dir, faults=True).withColumns({"row_idx": F.row_number().over(w) - 1, "file": file("trades")})
    metrics = _metrics(spark, sf_dir).withColumn("file", F.concat_ws("/", F.lit("metrics"), "asked", F.substring("create_time", 1, 10)))
    header = F.when(day % 9 == 0, F.array(F.lit("calc_time"), F.lit("funding_interval_hours"))).otherwise(F.array(*map(F.lit, quality.REQUIRED["fundingRate"])))
    found = quality.file_reasons(
        quality.candle_findings(qa),
        quality.checksum_findings(checked),
        quality.schema_findings(files.select(file("fundingRate").alias("file"), F.lit("fundingRate").alias("category"), header.alias("columns"))),
        quality.row_findings(faulty, "trades"),
        quality.row_findings(metrics, "metrics", expected_symbol=F.col("asked")),
        quality.row_findings(_depth(spark, sf_dir).withColumn("file", file("bookDepth")), "bookDepth"),
    )
    return found.select("file", quality.reason_text(F.col("broken")).alias("reasons"))


@query(FAULTS + """, r AS (SELECT symbol, count(*) AS expected_files, count(*) FILTER (WHERE (day(date) + length(symbol)) % 4 <> 0) AS verified_files FROM (SELECT DISTINCT symbol, date FROM tape) GROUP BY 1)
 SELECT symbol, 'trades' AS category, expected_files, verified_files, CAST(sum("rows") AS BIGINT) AS observed_rows, count(*) AS fully_audited_files FROM audit JOIN r USING (symbol) GROUP BY symbol, expected_files, verified_files""")
def trade_coverage(spark, sf_dir):
    """Coverage of trades from their audits."""
    m = manifest(spark, sf_dir)
    return coverage.trade_summary(m, m, trades.audit(ad.tape(spark, sf_dir, faults=True)))
