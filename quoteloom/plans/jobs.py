"""Whole runs of the job and of the streams, on feeds that Spark writes from the driver tables."""

from dataclasses import replace
from datetime import datetime, timedelta, timezone
from functools import partial

from pyspark.sql import functions as F

from ..operators import normalize
from ..sources import FeedSpec, Store, get_source, read_csv_feed, read_markets_json, register_source, remove_source
from ..streaming import stream_csv, stream_json
from ..workspace import remove_path, scratch_path
from . import bindings as b
from .feeds import market_pages
from .ingest import recover, run_all, run_source, start_job
from .registry import query

_RUN_TS = datetime(2024, 6, 1, tzinfo=timezone.utc)
_QUOTES = """SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, '{source}' AS source, ts AS "timestamp",
       max(value) AS price_usd FROM events WHERE {where} GROUP BY user_id, ts"""


def _csv_rows(spark, sf_dir, where="true", swapped=False):
    """Ticker, price, volume and date of events; ``swapped`` has the columns in the opposite order."""
    columns = ["ticker", "price", "vol", "date"]
    rows = b.table(spark, sf_dir, "events").where(where).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("ticker"),
        F.col("value").cast("string").alias("price"),
        F.lit("7").alias("vol"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("date"),
    )
    return rows.select(*(reversed(columns) if swapped else columns))


def _csv_pages(spark, sf_dir):
    path = scratch_path(spark, "csv")
    _csv_rows(spark, sf_dir).write.option("header", "true").csv(path)
    return path


def _facts(store):
    """Quotes by symbol; no two events share user and time, so each is a quote."""
    coins = store.read("coins").select("coin_id", F.col("symbol").alias("coin"))
    return store.read("quotes").join(coins, "coin_id").select(
        F.col("coin").alias("symbol"), "source", "timestamp", F.col("price_usd").cast("double").alias("price_usd")
    )


def _states(store):
    return store.runs().select("id", "source", "status", "records_processed")


@query(
    "run_all_states",
    """WITH m AS (SELECT count(*) AS n FROM (
  SELECT DISTINCT user_id, CASE WHEN event_type = 'signup' THEN TIMESTAMP '2024-06-01 00:00:00' ELSE ts END
  FROM events WHERE event_type <> 'error')),
c AS (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, ts FROM events))
SELECT * FROM (
  SELECT CAST(1 AS BIGINT) AS id, 'coinpaprika' AS source, 'failure' AS status, 0 AS records_processed
  UNION ALL SELECT 2, 'coingecko', 'success', n FROM m
  UNION ALL SELECT 3, 'csv', 'success', n FROM c
  UNION ALL SELECT 4, 'coingecko', 'success', 0
  UNION ALL SELECT 5, 'coingecko', 'success', n FROM m
  UNION ALL SELECT 6, 'coinpaprika', 'success', 0)""",
)
def run_all_states(spark, sf_dir):
    """All sources, one of them without a feed; one again with nothing new; one in full; an empty feed."""
    store = Store(spark, scratch_path(spark, "run_all"))
    markets = market_pages(spark, sf_dir)
    paths = {"coinpaprika": markets + "-missing", "coingecko": markets, "csv": _csv_pages(spark, sf_dir)}
    registered = get_source("coingecko")
    register_source("coingecko", replace(registered, read=partial(read_markets_json, pages="lines")))
    try:
        run_all(store, paths, run_ts=_RUN_TS)
        run_all(store, paths, ["coingecko"], run_ts=_RUN_TS)
        run_all(store, paths, ["coingecko"], force_full=True, run_ts=_RUN_TS)
    finally:
        register_source("coingecko", registered)
    empty = scratch_path(spark, "empty")
    spark.createDataFrame([("[]",)], "value string").write.text(empty)
    run_all(store, {"coinpaprika": empty}, run_ts=_RUN_TS)
    return _states(store)


@query(
    "run_after_crash",
    """SELECT CAST(1 AS BIGINT) AS id, 'csv' AS source, 'failure' AS status, 0 AS records_processed
UNION ALL SELECT 2, 'csv', 'success', count(*) FROM (SELECT DISTINCT user_id, ts FROM events)""",
)
def run_after_crash(spark, sf_dir):
    """A run that was opened and never closed is a failure once the next run begins."""
    store = Store(spark, scratch_path(spark, "crash"))
    start_job(store, "csv", _RUN_TS)
    run_source(store, "csv", _csv_pages(spark, sf_dir), run_ts=_RUN_TS)
    recover(store)
    return _states(store)


@query(
    "custom_feed",
    """SELECT 'quotes' AS kind, 'U' || CAST(user_id AS VARCHAR) AS name, count(DISTINCT ts) AS n FROM events GROUP BY user_id
UNION ALL SELECT * FROM (VALUES ('schema_extra', 'info', 1), ('schema_missing', 'critical', 1))""",
)
def custom_feed(spark, sf_dir):
    """A source of one's own, registered with its reader and the columns that its drift check expects."""
    spec = FeedSpec(
        lambda session, path: read_csv_feed(session, path).withColumnRenamed("vol", "depth"),
        normalize.normalize_csv,
        get_source("csv").newer,
        ("ticker", "price", "date", "venue_code"),
        columnar=True,
    )
    register_source("exchange", spec)
    store = Store(spark, scratch_path(spark, "custom"))
    try:
        run_source(store, "exchange", _csv_pages(spark, sf_dir), run_ts=_RUN_TS)
    finally:
        remove_source("exchange")
    quotes = _facts(store).groupBy(F.lit("quotes").alias("kind"), F.col("symbol").alias("name")).agg(F.count("*").alias("n"))
    log = store.committed("drift_log").groupBy(F.col("drift_type").alias("kind"), F.col("severity").alias("name"))
    return quotes.union(log.agg(F.count("*").alias("n")))


@query("stream_csv_feed", _QUOTES.format(source="csv", where="true"))
def stream_csv_feed(spark, sf_dir):
    """Files with different column orders in one landing folder, as a stream."""
    store = Store(spark, scratch_path(spark, "stream_csv"))
    landing = scratch_path(spark, "landing")
    for part, swapped in ((0, False), (1, True)):
        rows = _csv_rows(spark, sf_dir, f"event_id % 2 = {part}", swapped)
        rows.write.option("header", "true").csv(f"{landing}/{part}")
    stream_csv(store, "csv", landing, scratch_path(spark, "ckpt"), run_ts=_RUN_TS).awaitTermination()
    return _facts(store)


_LATE_AFTER = timedelta(days=10)


@query(
    "late_rows",
    """WITH e AS (SELECT user_id, event_id % 2 AS part, event_type = 'signup' AS undated, ts,
                   CASE WHEN event_type = 'signup' THEN TIMESTAMP '2024-06-01 00:00:00' ELSE ts END AS t
            FROM events WHERE event_type <> 'error'),
s AS (SELECT max(t) AS checkpoint, max(ts) FILTER (NOT undated) - INTERVAL 10 DAY AS bound FROM e WHERE part = 0),
m AS (SELECT 'drop_late' AS mode, user_id, t, false AS late FROM e, s WHERE part = 0 OR undated OR ts > checkpoint
  UNION ALL SELECT 'keep_late', user_id, t, false FROM e
  UNION ALL SELECT 'late_after', user_id, t, part = 1 AND NOT undated AND ts < bound FROM e, s)
SELECT mode, count(DISTINCT (user_id, t)) FILTER (NOT late) AS quotes, count(*) FILTER (late) AS late FROM m GROUP BY mode""",
)
def late_rows(spark, sf_dir):
    """Two deliveries of a stream; the second has rows older than the first's newest.

    They enter, are dropped, or go to the quarantine beyond a bound. Errors are rejected in any case.
    """
    counts = []
    landing = {part: market_pages(spark, sf_dir, f"event_id % 2 = {part}") for part in (0, 1)}
    modes = {"drop_late": {"drop_late": True}, "keep_late": {}, "late_after": {"late_after": _LATE_AFTER}}
    for mode, options in modes.items():
        store = Store(spark, scratch_path(spark, mode))
        checkpoint = scratch_path(spark, "ckpt")
        folder = scratch_path(spark, "landing")
        for part in (0, 1):
            spark.read.text(landing[part]).write.mode("append").text(folder)
            stream_json(
                store, "coingecko", folder, checkpoint, pages="lines", run_ts=_RUN_TS, **options
            ).awaitTermination()
        late = store.quarantine().where("reject_reason = 'late'").agg(F.count("*").alias("late"))
        counts.append(store.read("quotes").agg(F.count("*").alias("quotes")).select(
            F.lit(mode).alias("mode"), "quotes", late.select("late").scalar().alias("late")
        ))
    return counts[0].union(counts[1]).union(counts[2])


@query(
    "redelivery",
    """WITH q AS (
  SELECT user_id, CASE WHEN event_type = 'signup' THEN TIMESTAMP '2024-06-01 00:00:00' ELSE ts END AS t,
         arg_max(value, event_id) AS price FROM events WHERE event_type <> 'error' GROUP BY ALL)
SELECT 'quote' AS kind, 'U' || CAST(user_id AS VARCHAR) AS name, t AS "timestamp", price AS value FROM q
UNION ALL SELECT 'success', CAST(run AS VARCHAR), NULL, (SELECT CAST(count(*) AS DOUBLE) FROM q) FROM (VALUES (1), (2)) r(run)""",
)
def redelivery(spark, sf_dir):
    """A batch that Spark delivers again opens no run; a stream that lost its checkpoint overwrites the same keys.

    The result has all quotes, and all runs of the ledger with their number of rows.
    """
    store = Store(spark, scratch_path(spark, "redelivery"))
    landing = market_pages(spark, sf_dir)
    checkpoint = scratch_path(spark, "ckpt")
    for folder in (checkpoint, checkpoint, scratch_path(spark, "ckpt")):
        remove_path(spark, f"{checkpoint}/commits")  # as if Spark had died before it noted the batch as done
        stream_json(store, "coingecko", landing, folder, pages="lines", run_ts=_RUN_TS).awaitTermination()
    quotes = _facts(store).select(F.lit("quote").alias("kind"), F.col("symbol").alias("name"), "timestamp", F.col("price_usd").alias("value"))
    return quotes.union(store.runs().select(
        "status", F.col("id").cast("string"), F.lit(None).cast("timestamp"), F.col("records_processed").cast("double")
    ))
