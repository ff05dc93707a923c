"""Writes: audit rows, duplicate removal and upsert."""

from pyspark.sql import functions as F

from ..operators import merge
from ..sources.store import raw_rows
from . import bindings as b
from .registry import query

_HOUR_KEY = ["coin_id", "source", "timestamp"]


@query("raw_audit", "SELECT event_type AS source, props AS payload FROM events")
def raw_audit(spark, sf_dir):
    return raw_rows(b.quotes(spark, sf_dir)).select("source", "payload")


@query(
    "raw_audit_rows",
    """SELECT conv_id, turn, role AS source, text FROM conversations""",
)
def raw_audit_rows(spark, sf_dir):
    """Columns packed into a JSON payload and read back from it, whole texts included."""
    rows = b.table(spark, sf_dir, "conversations").withColumnRenamed("role", "source")
    packed = raw_rows(rows)
    fields = F.from_json("payload", "conv_id long, turn long, text string")
    return packed.select(fields.alias("p"), "source").select("p.conv_id", "p.turn", "source", "p.text")


def _hourly(spark, sf_dir, grain="hour"):
    rows = b.quotes(spark, sf_dir)
    return rows.withColumn("timestamp", F.date_trunc(grain, "timestamp"))


@query(
    "dedup_last",
    """SELECT user_id AS coin_id, event_type AS source, date_trunc('hour', ts) AS "timestamp",
       arg_max(value, (ts, event_id)) AS price_usd, arg_max(event_id, (ts, event_id)) AS event_id
FROM events GROUP BY ALL""",
)
def dedup_last(spark, sf_dir):
    kept = merge.last_per_key(
        _hourly(spark, sf_dir).select(*_HOUR_KEY, "price_usd", "event_id", "arrival"), _HOUR_KEY
    )
    return kept.withColumn("price_usd", F.col("price_usd").cast("double")).drop("arrival")


@query(
    "dedup_report",
    """WITH g AS (SELECT event_type AS source, count(*) AS n FROM events
           GROUP BY user_id, event_type, date_trunc('hour', ts))
SELECT source, CAST(sum(n) AS BIGINT) AS rows_in, count(*) AS rows_kept,
       CAST(sum(n) - count(*) AS BIGINT) AS rows_dropped
FROM g GROUP BY source""",
)
def dedup_report(spark, sf_dir):
    return merge.dedup_report(_hourly(spark, sf_dir), _HOUR_KEY, ["source"])


# Upsert at day grain: the target holds what came before 14:00 of each day, the batch the rest.
_MERGE_SQL = f"""{b.QUOTES_SQL},
daily AS (SELECT *, date_trunc('day', "timestamp") AS d, hour("timestamp") < 14 AS is_base FROM quotes),
best AS (
  SELECT * FROM daily
  QUALIFY row_number() OVER (PARTITION BY is_base, coin_id, source, d ORDER BY "timestamp" DESC, event_id DESC) = 1),
base AS (SELECT * FROM best WHERE is_base),
batch AS (SELECT * FROM best WHERE NOT is_base)"""


def _base_and_batch(spark, sf_dir):
    rows = _hourly(spark, sf_dir, "day").withColumn("ingested_at", F.col("arrival.ts"))
    columns = [*_HOUR_KEY, "symbol", "price_usd", "market_cap", "volume_24h", "ingested_at", "event_id", "arrival"]
    early = F.hour("arrival.ts") < 14
    base, batch = rows.where(early).select(*columns), rows.where(~early).select(*columns)
    return merge.last_per_key(base, _HOUR_KEY), merge.last_per_key(batch, _HOUR_KEY)


@query(
    "upsert_merge",
    f"""WITH {_MERGE_SQL}
SELECT COALESCE(t.coin_id, b.coin_id) AS coin_id, COALESCE(t.source, b.source) AS source,
       CAST(COALESCE(t.d, b.d) AS TIMESTAMP) AS "timestamp", COALESCE(t.symbol, b.symbol) AS symbol,
       CAST(CASE WHEN b.d IS NULL THEN t.price_usd ELSE b.price_usd END AS DOUBLE) AS price_usd,
       CAST(CASE WHEN b.d IS NULL THEN t.market_cap ELSE b.market_cap END AS DOUBLE) AS market_cap,
       CAST(CASE WHEN b.d IS NULL THEN t.volume_24h ELSE b.volume_24h END AS DOUBLE) AS volume_24h,
       CASE WHEN b.d IS NULL THEN t."timestamp" ELSE b."timestamp" END AS ingested_at,
       COALESCE(t.event_id, b.event_id) AS event_id
FROM base t FULL JOIN batch b ON t.coin_id = b.coin_id AND t.source = b.source AND t.d = b.d""",
)
def upsert_merge(spark, sf_dir):
    base, batch = _base_and_batch(spark, sf_dir)
    merged = merge.merge_rows(base, batch).drop("arrival")
    money = {c: F.col(c).cast("double") for c in ("price_usd", "market_cap", "volume_24h")}
    return merged.withColumns(money)


@query(
    "upsert_counts",
    f"""WITH {_MERGE_SQL}
SELECT count(*) FILTER (t.d IS NOT NULL AND b.d IS NOT NULL) AS rows_updated,
       count(*) FILTER (t.d IS NULL) AS rows_inserted, count(b.d) AS rows_affected
FROM base t FULL JOIN batch b ON t.coin_id = b.coin_id AND t.source = b.source AND t.d = b.d""",
)
def upsert_counts(spark, sf_dir):
    return merge.merge_counts(*_base_and_batch(spark, sf_dir))


@query(
    "insert_ignore",
    f"""WITH {_MERGE_SQL}
SELECT coin_id, source, CAST(d AS TIMESTAMP) AS "timestamp", event_id FROM base
UNION ALL
SELECT coin_id, source, CAST(d AS TIMESTAMP), event_id FROM batch
WHERE NOT EXISTS (SELECT 1 FROM base t
                  WHERE t.coin_id = batch.coin_id AND t.source = batch.source AND t.d = batch.d)""",
)
def insert_ignore(spark, sf_dir):
    base, batch = _base_and_batch(spark, sf_dir)
    return merge.insert_ignore(base, batch, _HOUR_KEY).select(*_HOUR_KEY, "event_id")
