"""Normalization, filtering and alias queries."""

from pyspark.sql import functions as F

from ..functions import clean_symbol, coerce_number, coin_slug, parse_timestamp, unix_seconds
from ..operators import aliases, incremental, normalize
from . import bindings as b
from .registry import query


@query(
    "normalize_quotes",
    f"""WITH {b.DIRTY_SQL}
SELECT event_id, source, source_id, name, symbol, price_usd, volume_24h, "timestamp"
FROM checked WHERE reject_reason IS NULL""",
)
def normalize_quotes(spark, sf_dir):
    rows = _normalized_feed(spark, sf_dir)
    return normalize.accepted(rows).select(
        F.col("arrival.event_id").alias("event_id"),
        "source",
        "source_id",
        "name",
        "symbol",
        F.col("price_usd").cast("double").alias("price_usd"),
        F.col("volume_24h").cast("double").alias("volume_24h"),
        "timestamp",
    )


def _normalized_feed(spark, sf_dir):
    feed = b.dirty_feed(spark, sf_dir).drop("event_id")
    return normalize.normalize_csv(feed, F.col("feed_source"))


@query(
    "validate_split",
    f"""WITH {b.DIRTY_SQL}
SELECT source, COALESCE(reject_reason, 'ok') AS reason, count(*) AS n_rows
FROM checked GROUP BY source, reason""",
)
def validate_split(spark, sf_dir):
    return normalize.reject_counts(_normalized_feed(spark, sf_dir))


@query(
    "quarantine",
    f"""WITH {b.DIRTY_SQL}
SELECT event_id, source, reject_reason FROM checked WHERE reject_reason IS NOT NULL""",
)
def quarantine(spark, sf_dir):
    rows = normalize.rejected(_normalized_feed(spark, sf_dir))
    return rows.select(F.col("arrival.event_id").alias("event_id"), "source", "reject_reason")


@query("normalize_symbols", "SELECT p_partkey, upper(trim(p_name)) AS symbol FROM part")
def normalize_symbols(spark, sf_dir):
    parts = b.table(spark, sf_dir, "part")
    padded = F.concat(F.lit(" \t"), F.col("p_name"), F.lit(" \n"))
    return parts.select("p_partkey", clean_symbol(padded).alias("symbol"))


@query(
    "coerce_numeric",
    f"""WITH {b.DIRTY_SQL}
SELECT event_id, price AS text, TRY_CAST(price AS DOUBLE) AS number FROM dirty""",
)
def coerce_numeric(spark, sf_dir):
    feed = b.dirty_feed(spark, sf_dir)
    return feed.select("event_id", F.col("price").alias("text"), coerce_number(F.col("price")).alias("number"))


@query(
    "parse_timestamps",
    f"""WITH {b.DIRTY_SQL}
SELECT event_id, "date" AS text,
       try_strptime("date", ['%Y-%m-%dT%H:%M:%S.%fZ', '%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%dT%H:%M:%S',
                             '%Y-%m-%d %H:%M:%S', '%Y-%m-%d']) AS "timestamp"
FROM dirty""",
)
def parse_timestamps(spark, sf_dir):
    feed = b.dirty_feed(spark, sf_dir)
    return feed.select("event_id", F.col("date").alias("text"), parse_timestamp(F.col("date")).alias("timestamp"))


@query(
    "parse_unix_times",
    """SELECT event_id, epoch_us(ts) // 1000000 AS seconds, date_trunc('second', ts) AS "timestamp" FROM events""",
)
def parse_unix_times(spark, sf_dir):
    seconds = b.table(spark, sf_dir, "events").select("event_id", F.unix_seconds("ts").alias("seconds"))
    return seconds.withColumn("timestamp", unix_seconds(F.col("seconds")))


@query(
    "json_extract",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS price,
       json_extract_string(props, '$.missing') AS market_cap FROM events""",
)
def json_extract(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("double").alias("price"),
        F.get_json_object("props", "$.missing").alias("market_cap"),
    )


@query(
    "coin_slug",
    """SELECT p_partkey, lower(p_name) || CASE WHEN upper(p_type) <> upper(p_name) THEN
         '-' || substr(regexp_replace(lower(p_type), '[^a-z0-9-]', '', 'g'), 1, 20) ELSE '' END AS slug
FROM part""",
)
def coin_slugs(spark, sf_dir):
    parts = b.table(spark, sf_dir, "part")
    return parts.select("p_partkey", coin_slug(F.upper("p_name"), F.col("p_type")).alias("slug"))


@query(
    "incremental_filter",
    """SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00' OR ts IS NULL""",
)
def incremental_filter(spark, sf_dir):
    events = b.table(spark, sf_dir, "events").select("event_id", "ts")
    return incremental.newer_than(events, "ts", "2024-01-20 00:00:00")


@query(
    "incremental_filter_csv",
    f"""WITH {b.DIRTY_SQL}
SELECT event_id, "date" AS text FROM checked JOIN dirty USING (event_id)
WHERE COALESCE("timestamp" > TIMESTAMP '2024-01-20 00:00:00', true)""",
)
def incremental_filter_csv(spark, sf_dir):
    kept = incremental.newer_csv(b.dirty_feed(spark, sf_dir), "2024-01-20 00:00:00")
    return kept.select("event_id", F.col("date").alias("text"))


# Every event gets an alias in changing case; with a letter left out for the fuzzy query; every
# 15th gets its (unknown) event type instead.
_ALIASES = list(aliases.CANONICAL.items())
_ALIAS_VALUES = ", ".join(f"({i}, '{name}', '{symbol}')" for i, (name, symbol) in enumerate(_ALIASES))
_TOKENS_SQL = f"""alias_list(i, name, symbol) AS (VALUES {_ALIAS_VALUES}),
tokens AS (
  SELECT event_id, CASE WHEN i IS NULL THEN event_type ELSE name END AS name, symbol
  FROM events LEFT JOIN alias_list ON i = event_id % 15)"""


def _alias_tokens(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    names = F.array(*[F.lit(name) for name, _ in _ALIASES])
    name = F.coalesce(F.get(names, (F.col("event_id") % 15).cast("int")), F.col("event_type"))
    return events.select("event_id", name.alias("name"))


@query(
    "alias_lookup",
    f"""WITH {_TOKENS_SQL}
SELECT event_id, ' ' || upper(name) AS token, symbol AS canonical FROM tokens""",
)
def alias_lookup(spark, sf_dir):
    tokens = _alias_tokens(spark, sf_dir).select(
        "event_id", F.concat(F.lit(" "), F.upper("name")).alias("token")
    )
    return tokens.withColumn("canonical", aliases.exact_symbol(F.col("token")))


@query(
    "alias_table_lookup",
    f"""WITH {_TOKENS_SQL}
SELECT event_id, upper(name) AS token, symbol AS canonical FROM tokens""",
)
def alias_table_lookup(spark, sf_dir):
    tokens = _alias_tokens(spark, sf_dir).select("event_id", F.upper("name").alias("token"))
    table = spark.createDataFrame(_ALIASES, "alias string, canonical string")
    return aliases.with_exact_symbol(tokens, "token", table)


@query(
    "fuzzy_alias",
    f"""WITH {_TOKENS_SQL},
cut AS (SELECT event_id, symbol, 1 + CAST(event_id // 15 AS BIGINT) % length(name) AS p, name FROM tokens)
SELECT event_id, substr(name, 1, p - 1) || substr(name, p + 1) AS token, symbol AS canonical FROM cut""",
)
def fuzzy_alias(spark, sf_dir):
    at = F.expr("CAST(event_id DIV 15 AS INT) % length(name)")
    tokens = _alias_tokens(spark, sf_dir).select(
        "event_id",
        F.concat(F.substr("name", F.lit(1), at), F.substr("name", at + 2)).alias("token"),
    )
    return aliases.with_canonical_symbol(tokens, "token")
