"""Driver tables seen as quotes, assets and a run ledger, in Spark and in SQL.

Schemas are given, so opening a table runs no job, and times are read as UTC instants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import AMOUNT, FAILURE, PRICE, RUNNING, SUCCESS

TABLES = {
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes from events; arrival orders them by time, then event id."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("coin_id"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("value").try_cast(PRICE).alias("price_usd"),
        F.when(F.col("event_type") != "error", F.col("value") * 1000).try_cast(AMOUNT).alias("market_cap"),
        F.get_json_object("props", "$.k").try_cast(AMOUNT).alias("volume_24h"),
        F.col("event_type").alias("source"),
        F.col("ts").alias("timestamp"),
        F.concat_ws("-", F.col("event_type"), F.col("user_id").cast("string")).alias("source_id"),
        F.col("props").alias("payload"),
        F.col("event_id"),
        F.struct("ts", "event_id").alias("arrival"),
    )


QUOTES_SQL = """quotes AS (
  SELECT user_id AS coin_id, 'U' || CAST(user_id AS VARCHAR) AS symbol,
         CAST(value AS DECIMAL(20,8)) AS price_usd,
         CASE WHEN event_type <> 'error' THEN CAST(value * 1000 AS DECIMAL(30,2)) END AS market_cap,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(30,2)) AS volume_24h,
         event_type AS source, ts AS "timestamp",
         event_type || '-' || CAST(user_id AS VARCHAR) AS source_id, props AS payload, event_id
  FROM events)"""


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_brand").alias("source"),
        F.upper("p_name").alias("symbol"),
        F.col("p_partkey").cast("string").alias("source_id"),
        F.col("p_type").alias("name"),
        F.col("p_name").alias("raw_symbol"),
        F.col("p_partkey").cast("string").alias("raw_id"),
        F.col("p_partkey").alias("arrival"),
    )


ASSETS_SQL = """assets AS (
  SELECT p_brand AS source, upper(p_name) AS symbol, CAST(p_partkey AS VARCHAR) AS source_id,
         p_type AS name, p_partkey AS arrival
  FROM part)"""


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs from orders. Every 97th run lasts ten times as long, every 89th has twenty times the rows."""
    o = table(spark, sf_dir, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "P", RUNNING)
        .when((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") >= "3"), FAILURE)
        .otherwise(SUCCESS)
    )
    seconds = F.floor("o_totalprice") * F.when(F.col("o_orderkey") % 97 == 0, 10).otherwise(1)
    records = F.col("o_custkey") * F.when(F.col("o_orderkey") % 89 == 0, 20).otherwise(1)
    ended = F.timestamp_seconds(F.unix_seconds("o_orderdate") + seconds)
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("source"),
        status.alias("status"),
        F.col("o_orderdate").alias("last_processed_timestamp"),
        records.alias("records_processed"),
        F.col("o_orderdate").alias("started_at"),
        F.when(F.col("o_orderstatus") != "P", ended).alias("completed_at"),
        F.when(status == FAILURE, F.concat(F.lit("run of customer "), F.col("o_custkey").cast("string")))
        .alias("error_message"),
    )


LEDGER_SQL = """ledger AS (
  SELECT o_orderkey AS id, o_orderpriority AS source,
         CASE WHEN o_orderstatus = 'P' THEN 'running'
              WHEN o_orderstatus = 'F' AND o_orderpriority >= '3' THEN 'failure'
              ELSE 'success' END AS status,
         o_orderdate AS last_processed_timestamp,
         o_custkey * (CASE WHEN o_orderkey % 89 = 0 THEN 20 ELSE 1 END) AS records_processed,
         o_orderdate AS started_at,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_seconds(
              CAST(floor(o_totalprice) AS BIGINT) * (CASE WHEN o_orderkey % 97 = 0 THEN 10 ELSE 1 END))
              END AS completed_at,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority >= '3'
              THEN 'run of customer ' || CAST(o_custkey AS VARCHAR) END AS error_message
  FROM orders),
runs AS (
  SELECT *, CAST(epoch_us(completed_at) - epoch_us(started_at) AS DOUBLE) / 1000000 AS duration
  FROM ledger)"""


def dirty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns as a CSV feed would have them: padded symbols, bad numbers, several time formats."""
    e = table(spark, sf_dir, "events")
    price = F.col("value").cast("decimal(18,2)").cast("string")
    kind, form = F.col("event_id") % 7, F.col("event_id") % 8
    ticker = F.concat(F.lit(" u"), F.col("user_id").cast("string"), F.lit("\t"))
    return e.select(
        "event_id",
        F.when(F.col("event_id") % 11 == 0, F.concat(ticker, F.lit("-a-rather-long-ticker")))
        .otherwise(ticker)
        .alias("ticker"),
        F.when(kind == 0, price)
        .when(kind == 1, "")
        .when(kind == 2, "N/A")
        .when(kind == 3, "5d")
        .when(kind == 4, F.concat(F.lit("  "), price, F.lit(" ")))
        .when(kind == 5, F.concat(price, F.lit("e1")))
        .alias("price"),
        F.get_json_object("props", "$.k").alias("vol"),
        F.when(form == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(form == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(form == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(form == 3, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(form == 4, F.date_format("ts", "yyyy-MM-dd"))
        .when(form == 5, F.unix_seconds("ts").cast("string"))
        .when(form == 6, "not a time")
        .otherwise("")
        .alias("date"),
        F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("name"),
        F.col("event_type").alias("feed_source"),
        F.struct("ts", "event_id").alias("arrival"),
    )


DIRTY_SQL = r"""dirty AS (
  SELECT event_id, event_type AS source,
         ' u' || CAST(user_id AS VARCHAR) || chr(9)
           || (CASE WHEN event_id % 11 = 0 THEN '-a-rather-long-ticker' ELSE '' END) AS ticker,
         CASE event_id % 7
           WHEN 0 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
           WHEN 1 THEN '' WHEN 2 THEN 'N/A' WHEN 3 THEN '5d'
           WHEN 4 THEN '  ' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || ' '
           WHEN 5 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || 'e1' END AS price,
         json_extract_string(props, '$.k') AS vol,
         CASE event_id % 8
           WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
           WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
           WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
           WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
           WHEN 4 THEN strftime(ts, '%Y-%m-%d')
           WHEN 5 THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR)
           WHEN 6 THEN 'not a time' ELSE '' END AS "date",
         CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS name
  FROM events),
cleaned AS (
  SELECT event_id, source, upper(trim(ticker, ' ' || chr(9))) AS symbol,
         COALESCE(NULLIF(name, ''), ticker) AS name, ticker AS source_id,
         TRY_CAST(price AS DOUBLE) AS price_usd, TRY_CAST(vol AS DOUBLE) AS volume_24h,
         try_strptime("date", ['%Y-%m-%dT%H:%M:%S.%fZ', '%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%dT%H:%M:%S',
                               '%Y-%m-%d %H:%M:%S', '%Y-%m-%d']) AS "timestamp"
  FROM dirty),
checked AS (
  SELECT *, CASE WHEN "timestamp" IS NULL THEN 'bad_timestamp'
                 WHEN length(symbol) > 20 THEN 'symbol_too_long' END AS reject_reason
  FROM cleaned)"""
