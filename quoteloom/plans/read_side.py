"""Quote listings and statistics."""

from pyspark.sql import functions as F

from ..operators import quotes as q
from ..operators import relations
from . import bindings as b
from .registry import query

_LIST = """coin_id, symbol, CAST(price_usd AS DOUBLE) AS price_usd, CAST(market_cap AS DOUBLE) AS market_cap,
  CAST(volume_24h AS DOUBLE) AS volume_24h, source, "timestamp" """


def _listed(quotes):
    money = [F.col(c).cast("double").alias(c) for c in ("price_usd", "market_cap", "volume_24h")]
    return quotes.select("coin_id", "symbol", *money, "source", "timestamp")


@query(
    "symbol_stats",
    f"""WITH {b.QUOTES_SQL}
SELECT symbol, count(*) AS record_count,
       COALESCE(CAST(sum(price_usd) AS DOUBLE) / count(price_usd), 0) AS avg_price_usd,
       COALESCE(CAST(max(price_usd) AS DOUBLE), 0) AS max_price_usd,
       COALESCE(CAST(min(price_usd) AS DOUBLE), 0) AS min_price_usd,
       string_agg(DISTINCT source, ',' ORDER BY source) AS sources
FROM quotes GROUP BY symbol""",
)
def symbol_stats(spark, sf_dir):
    stats = q.symbol_stats(b.quotes(spark, sf_dir))
    return stats.withColumn("sources", F.array_join("sources", ","))


@query(
    "overview_stats",
    f"""WITH {b.QUOTES_SQL}
SELECT count(*) AS total_records, count(DISTINCT symbol) AS unique_symbols,
       max("timestamp") AS data_freshness FROM quotes""",
)
def overview_stats(spark, sf_dir):
    return q.overview(b.quotes(spark, sf_dir))


@query(
    "count_quotes",
    f"""WITH {b.QUOTES_SQL}
SELECT count(*) AS total FROM quotes WHERE source = 'view'""",
)
def count_quotes(spark, sf_dir):
    return q.count_quotes(b.quotes(spark, sf_dir), source="view")


@query(
    "list_quotes",
    f"""WITH {b.QUOTES_SQL}
SELECT {_LIST} FROM quotes WHERE source = 'click'
ORDER BY "timestamp" DESC, event_id LIMIT 50 OFFSET 20""",
)
def list_quotes(spark, sf_dir):
    rows = q.filter_quotes(b.quotes(spark, sf_dir), source="click")
    return _listed(q.page(rows, ["event_id"], limit=50, offset=20))


@query(
    "list_quotes_symbol",
    f"""WITH {b.QUOTES_SQL}
SELECT {_LIST} FROM quotes WHERE symbol = 'U7' ORDER BY "timestamp" DESC, event_id LIMIT 500""",
)
def list_quotes_symbol(spark, sf_dir):
    rows = q.filter_quotes(b.quotes(spark, sf_dir), symbol="u7")
    return _listed(q.page(rows, ["event_id"], limit=500))


@query(
    "list_quotes_tied",
    f"""WITH {b.QUOTES_SQL}, days AS (SELECT * REPLACE (date_trunc('month', "timestamp") AS "timestamp") FROM quotes)
SELECT {_LIST} FROM days ORDER BY "timestamp" DESC, event_id LIMIT 500 OFFSET 8000""",
)
def list_quotes_tied(spark, sf_dir):
    """A deep page among rows that share their time."""
    rows = b.quotes(spark, sf_dir).withColumn("timestamp", F.date_trunc("month", "timestamp"))
    return _listed(q.page(rows, ["event_id"], limit=500, offset=8000))


@query(
    "list_quotes_deep",
    f"""WITH {b.QUOTES_SQL}
SELECT {_LIST} FROM quotes ORDER BY "timestamp" DESC, event_id LIMIT 500 OFFSET 6000""",
)
def list_quotes_deep(spark, sf_dir):
    return _listed(q.page(b.quotes(spark, sf_dir), ["event_id"], limit=500, offset=6000))


@query(
    "list_quotes_after",
    f"""WITH {b.QUOTES_SQL}, days AS (SELECT * REPLACE (date_trunc('day', "timestamp") AS "timestamp") FROM quotes)
SELECT {_LIST} FROM days ORDER BY "timestamp" DESC, event_id LIMIT 500 OFFSET 500""",
)
def list_quotes_after(spark, sf_dir):
    """The second page, found by the last row of the first, among rows that share their time."""
    rows = b.quotes(spark, sf_dir).withColumn("timestamp", F.date_trunc("day", "timestamp"))
    first = q.page(rows, ["event_id"], limit=500).select("timestamp", "event_id").collect()
    return _listed(q.page_after(rows, ["event_id"], first[-1], limit=500))


@query(
    "list_quotes_range",
    f"""WITH {b.QUOTES_SQL}
SELECT {_LIST} FROM quotes
WHERE "timestamp" BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
)
def list_quotes_range(spark, sf_dir):
    rows = b.quotes(spark, sf_dir)
    return _listed(q.filter_quotes(rows, start="2024-01-10 00:00:00", end="2024-01-20 12:00:00"))


@query(
    "entity_history",
    f"""WITH {b.QUOTES_SQL}
SELECT {_LIST} FROM quotes WHERE coin_id = 7""",
)
def entity_history(spark, sf_dir):
    return _listed(q.filter_quotes(b.quotes(spark, sf_dir), coin_id=7))


@query("list_sources", "SELECT DISTINCT event_type AS source FROM events")
def list_sources(spark, sf_dir):
    return b.quotes(spark, sf_dir).select("source").distinct()


@query("batch_checkpoint", 'SELECT max(ts) AS "checkpoint" FROM events')
def batch_checkpoint(spark, sf_dir):
    return q.latest_timestamp(b.quotes(spark, sf_dir))


@query(
    "quotes_with_entity",
    f"""WITH {b.QUOTES_SQL}
SELECT event_id, q.coin_id, symbol, source, "timestamp", CAST(price_usd AS DOUBLE) AS price_usd,
       c_custkey AS entity_id, upper(c_mktsegment) AS entity_symbol, c_name AS entity_name
FROM quotes q LEFT JOIN customer ON c_custkey = q.coin_id""",
)
def quotes_with_entity(spark, sf_dir):
    coins = b.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("coin_id"),
        F.upper("c_mktsegment").alias("symbol"),
        F.col("c_name").alias("name"),
    )
    rows = relations.quotes_with_entity(b.quotes(spark, sf_dir), coins)
    return rows.select(
        "event_id",
        "coin_id",
        "symbol",
        "source",
        "timestamp",
        F.col("price_usd").cast("double").alias("price_usd"),
        F.col("coin.id").alias("entity_id"),
        F.col("coin.symbol").alias("entity_symbol"),
        F.col("coin.name").alias("entity_name"),
    )


@query(
    "entity_mappings",
    """SELECT c_custkey AS coin_id, c_mktsegment AS symbol, c_name AS name, o_orderpriority AS source,
       CAST(o_orderkey AS VARCHAR) AS source_id, o_orderstatus AS source_symbol
FROM customer LEFT JOIN orders ON o_custkey = c_custkey""",
)
def entity_mappings(spark, sf_dir):
    coins = b.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("coin_id"), F.col("c_mktsegment").alias("symbol"), F.col("c_name").alias("name")
    )
    mappings = b.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("coin_id"),
        F.col("o_orderpriority").alias("source"),
        F.col("o_orderkey").cast("string").alias("source_id"),
        F.col("o_orderstatus").alias("source_symbol"),
        F.lit(None).cast("string").alias("source_name"),
    )
    return relations.entity_mappings(coins, mappings).drop("source_name")


@query(
    "union_sources",
    """SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, event_type AS source, ts AS "timestamp", value AS price
FROM events
UNION ALL
SELECT 'C' || CAST(o_custkey AS VARCHAR), 'orders', o_orderdate, o_totalprice FROM orders
UNION ALL
SELECT 'P' || CAST(l_partkey AS VARCHAR), 'lineitem', l_shipdate, NULL FROM lineitem""",
)
def union_sources(spark, sf_dir):
    events = b.table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("event_type").alias("source"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price"),
    )
    orders = b.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"),
        F.lit("orders").alias("source"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_totalprice").alias("price"),
    )
    lines = b.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"),
        F.lit("lineitem").alias("source"),
        F.col("l_shipdate").alias("timestamp"),
    )
    return q.union_sources(events, orders, lines)
