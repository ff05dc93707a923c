"""Feed files that Spark writes from the driver tables, read back through the feed readers."""

from dataclasses import replace
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import functions as F

from ..operators import normalize
from ..schemas import OVERFLOW
from ..sources import Store, get_source, read_csv_feed, read_markets_json, read_tickers_json
from ..streaming import stream_table
from ..workspace import scratch_path, set_file_times
from . import bindings as b
from .ingest import run_source
from .registry import query


@query(
    "csv_feed",
    f"""WITH {b.DIRTY_SQL}
SELECT event_id, trim(replace(ticker, chr(9), '')) AS ticker, NULLIF(price, '') AS price, vol,
       NULLIF("date", '') AS "date" FROM dirty""",
)
def csv_feed(spark, sf_dir):
    """Semicolon-separated files with padded upper-case headers."""
    path = scratch_path(spark, "csv_feed")
    feed = b.dirty_feed(spark, sf_dir)
    feed.select(
        F.col("event_id").alias(" EVENT_ID "),
        F.trim(F.regexp_replace("ticker", "\t", "")).alias("Ticker"),
        F.col("price").alias("PRICE"),
        F.col("vol").alias(" Vol"),
        F.col("date").alias("DATE "),
    ).write.option("header", "true").option("sep", ";").option("emptyValue", "").option(
        "ignoreLeadingWhiteSpace", "false"
    ).option("ignoreTrailingWhiteSpace", "false").csv(path)
    rows = read_csv_feed(spark, path).drop("arrival", OVERFLOW)
    return rows.withColumn("event_id", F.col("event_id").cast("long"))


_PAGE_ROWS = 250
_RUN_TS = datetime(2024, 6, 1, tzinfo=timezone.utc)


def _write_pages(rows, path):
    """API pages of 250 objects, one JSON array per line, in the order of the events.

    All files get one time: rows then arrive in the order of the files' names, which is that of the pages.
    """
    item = F.array_sort(F.collect_list(F.struct("event_id", "item")))
    pages = rows.groupBy(F.expr(f"event_id DIV {_PAGE_ROWS}").alias("page")).agg(
        F.concat(F.lit("["), F.array_join(F.transform(item, lambda x: x["item"]), ","), F.lit("]")).alias("value")
    )
    pages.repartitionByRange("page").sortWithinPartitions("page").select("value").write.text(path)
    set_file_times(rows.sparkSession, path, _RUN_TS)


def market_pages(spark, sf_dir, where="true"):
    """Flat objects. An error's price is the text "N/A", which rejects the row; signups have no time."""
    events = b.table(spark, sf_dir, "events").where(where)
    item = F.struct(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("event_id").cast("string").alias("name"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("current_price"),
        F.when(F.col("event_type") != "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .alias("last_updated"),
        F.struct(F.lit(1.5).alias("times")).alias("roi"),
    )
    text = F.to_json(item)
    bad = F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(',"current_price":"N/A"}'))
    text = F.when(F.col("event_type") == "error", bad).otherwise(text)
    path = scratch_path(spark, "markets")
    _write_pages(events.select("event_id", text.alias("item")), path)
    return path


@query(
    "markets_feed",
    """SELECT event_id, 'user-' || CAST(user_id AS VARCHAR) AS source_id,
       'U' || CAST(user_id AS VARCHAR) AS symbol,
       CASE WHEN event_type <> 'error' THEN value END AS price_usd,
       CASE WHEN event_type = 'signup' THEN TIMESTAMP '2024-06-01 00:00:00' ELSE ts END AS "timestamp",
       CASE WHEN event_type = 'error' THEN 'bad_number' END AS reject_reason FROM events""",
)
def markets_feed(spark, sf_dir):
    pages = read_markets_json(spark, market_pages(spark, sf_dir), pages="lines")
    rows = normalize.normalize_markets(pages, run_ts=_RUN_TS)
    return rows.select(
        F.col("name").cast("long").alias("event_id"),
        "source_id",
        "symbol",
        F.col("price_usd").cast("double").alias("price_usd"),
        "timestamp",
        "reject_reason",
    )


@query(
    "ingest_feed",
    """WITH feed AS (
  SELECT user_id, event_id, value, CASE WHEN event_type = 'signup' THEN TIMESTAMP '2024-06-01 00:00:00' ELSE ts END AS t
  FROM events WHERE event_type <> 'error')
SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, 'coingecko' AS source, t AS "timestamp",
       arg_max(value, event_id) AS price_usd
FROM feed GROUP BY user_id, t""",
)
def ingest_feed(spark, sf_dir):
    """The whole job on market pages: one quote per coin and time, the last that arrives.

    Signups have no time of their own and stand at the time of the run.
    """
    store = Store(spark, scratch_path(spark, "ingest_feed"))
    spec = replace(get_source("coingecko"), read=partial(read_markets_json, pages="lines"))
    run_source(store, "coingecko", market_pages(spark, sf_dir), run_ts=_RUN_TS, spec=spec)
    coins = store.read("coins").select("coin_id", F.col("symbol").alias("coin"))
    return store.read("quotes").join(coins, "coin_id").select(
        F.col("coin").alias("symbol"), "source", "timestamp", F.col("price_usd").cast("double").alias("price_usd")
    )


@query(
    "tickers_feed",
    """SELECT CAST(event_id AS VARCHAR) || '-x' AS source_id, 'U' || CAST(user_id AS VARCHAR) AS symbol,
       CASE WHEN event_type IN ('click', 'view') THEN value END AS price_usd,
       CASE WHEN event_type = 'view' THEN value * 2 END AS volume_24h,
       CASE WHEN event_type = 'error' THEN 'bad_quotes' END AS reject_reason FROM events""",
)
def tickers_feed(spark, sf_dir):
    """Nested quotes: complete, price only, empty, without USD, or not an object (rejected)."""
    events = b.table(spark, sf_dir, "events")
    price = F.col("value").cast("string")
    usd = (
        F.when(
            F.col("event_type") == "view",
            F.concat(F.lit('{"USD":{"price":'), price, F.lit(',"volume_24h":'), (F.col("value") * 2).cast("string"), F.lit("}}")),
        )
        .when(F.col("event_type") == "click", F.concat(F.lit('{"USD":{"price":'), price, F.lit("}}")))
        .when(F.col("event_type") == "signup", F.lit('{"EUR":{"price":1}}'))
        .when(F.col("event_type") == "error", F.lit("[1]"))
        .otherwise(F.lit("{}"))
    )
    item = F.format_string(
        '{"id":"%d-x","name":"N%d","symbol":" u%d ","rank":%d,"quotes":%s,"last_updated":"2024-01-15T12:00:00Z"}',
        "event_id", "event_id", "user_id", "user_id", usd,
    )
    path = scratch_path(spark, "tickers")
    _write_pages(events.select("event_id", item.alias("item")), path)
    # Several pages in one file, read whole: every line is an array of its own.
    rows = normalize.normalize_tickers(read_tickers_json(spark, path, pages="files"))
    money = [F.col(c).cast("double").alias(c) for c in ("price_usd", "volume_24h")]
    return rows.select("source_id", "symbol", *money, "reject_reason")


@query(
    "stream_upsert",
    """SELECT user_id AS coin_id, event_type AS source, date_trunc('hour', ts) AS "timestamp",
       'U' || CAST(user_id AS VARCHAR) AS symbol, arg_max(value, (ts, event_id)) AS price_usd
FROM events GROUP BY ALL""",
)
def stream_upsert(spark, sf_dir):
    """The events file as a stream, upserted into a new quote table at hour grain."""
    store = Store(spark, scratch_path(spark, "stream_upsert"))
    events = (
        spark.readStream.schema(b.TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    rows = events.select(
        F.col("user_id").alias("coin_id"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("value").try_cast("decimal(20,8)").alias("price_usd"),
        F.lit(None).cast("decimal(30,2)").alias("market_cap"),
        F.lit(None).cast("decimal(30,2)").alias("volume_24h"),
        F.col("event_type").alias("source"),
        F.col("ts").alias("ingested_at"),
        F.date_trunc("hour", "ts").alias("timestamp"),
        F.struct("ts", "event_id").alias("arrival"),
    )
    running = stream_table(store, rows, f"{store.root}/_checkpoint")
    running.awaitTermination()
    return store.read("quotes").select(
        "coin_id", "source", "timestamp", "symbol", F.col("price_usd").cast("double").alias("price_usd")
    )
