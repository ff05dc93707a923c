"""Entity resolution, backfill and referential checks."""

from pyspark.sql import functions as F

from ..operators import backfill, identity, relations
from ..operators.quality import unique_violations
from ..schemas import COINS, MAPPINGS
from . import bindings as b
from .registry import query


@query(
    "source_id_map",
    f"""WITH {b.ASSETS_SQL}
SELECT source, symbol, arg_max(source_id, arrival) AS source_id FROM assets GROUP BY source, symbol""",
)
def source_id_map(spark, sf_dir):
    return identity.source_id_map(b.assets(spark, sf_dir))


@query(
    "attach_source_id",
    f"""WITH {b.ASSETS_SQL},
m AS (SELECT source, symbol, arg_max(source_id, arrival) AS mapped FROM assets GROUP BY source, symbol)
SELECT a.arrival AS p_partkey, source, symbol, COALESCE(mapped, symbol) AS source_id
FROM assets a LEFT JOIN m USING (source, symbol)""",
)
def attach_source_id(spark, sf_dir):
    rows = b.assets(spark, sf_dir)
    attached = identity.attach_source_ids(rows, identity.source_id_map(rows))
    return attached.select(F.col("arrival").alias("p_partkey"), "source", "symbol", "source_id")


# Known before the run: the coins of one brand, and their mappings.
_KNOWN = "Brand#1"

_RESOLVE_SQL = f"""{b.ASSETS_SQL},
coins AS (
  SELECT row_number() OVER (ORDER BY lower(symbol)) AS coin_id, symbol
  FROM (SELECT DISTINCT symbol FROM assets WHERE source = '{_KNOWN}')),
id_map AS (SELECT source, symbol, arg_max(source_id, arrival) AS sid FROM assets GROUP BY source, symbol),
mappings AS (SELECT source, sid, coin_id FROM id_map JOIN coins USING (symbol) WHERE source = '{_KNOWN}'),
firsts AS (
  SELECT source, symbol, sid, arg_min(name, arrival) AS name, min(arrival) AS arrival
  FROM assets JOIN id_map USING (source, symbol) GROUP BY source, symbol, sid),
created AS (
  SELECT symbol, arg_min(name, arrival) AS name, arg_min(source, arrival) AS source,
         (SELECT max(coin_id) FROM coins) + row_number() OVER (ORDER BY min(arrival)) AS coin_id
  FROM firsts WHERE symbol NOT IN (SELECT symbol FROM coins) GROUP BY symbol),
all_coins AS (SELECT coin_id, symbol FROM coins UNION ALL SELECT coin_id, symbol FROM created)"""


def _known_master(spark, sf_dir):
    rows = b.assets(spark, sf_dir)
    known = rows.where(F.col("source") == _KNOWN)
    coins = backfill.seed_coins(known, spark.createDataFrame([], COINS), after=0)
    mappings = identity.source_id_map(known).join(coins.select("symbol", "coin_id"), "symbol")
    return rows, coins, mappings.select("source", "source_id", "coin_id")


def _resolution(spark, sf_dir):
    rows, coins, mappings = _known_master(spark, sf_dir)
    return rows, identity.resolve_entities(rows, coins, mappings, raw=rows)


@query(
    "resolve_entities",
    f"""WITH {_RESOLVE_SQL}
SELECT arrival AS p_partkey, source, symbol, coin_id FROM assets JOIN all_coins USING (symbol)""",
)
def resolve_entities(spark, sf_dir):
    rows, found = _resolution(spark, sf_dir)
    return found.attach(rows).select(F.col("arrival").alias("p_partkey"), "source", "symbol", "coin_id")


@query(
    "new_coins",
    f"""WITH {_RESOLVE_SQL}
SELECT coin_id, symbol, name, lower(symbol) || '-' || lower(name) AS slug FROM created""",
)
def new_coins(spark, sf_dir):
    return _resolution(spark, sf_dir)[1].new_coins.select("coin_id", "symbol", "name", "slug")


@query(
    "new_mappings",
    f"""WITH {_RESOLVE_SQL}
SELECT coin_id, source, sid AS source_id, symbol AS source_symbol, firsts.name AS source_name
FROM firsts JOIN all_coins USING (symbol)
WHERE NOT EXISTS (SELECT 1 FROM mappings m WHERE m.source = firsts.source AND m.sid = firsts.sid)""",
)
def new_mappings(spark, sf_dir):
    found = _resolution(spark, sf_dir)[1].new_mappings
    return found.select("coin_id", "source", "source_id", "source_symbol", "source_name")


@query(
    "new_mappings_by_record_id",
    f"""WITH {_RESOLVE_SQL}
SELECT coin_id, source, source_id, symbol AS source_symbol, assets.name AS source_name
FROM assets JOIN all_coins USING (symbol)
WHERE NOT EXISTS (SELECT 1 FROM mappings m WHERE m.source = assets.source AND m.sid = assets.source_id)""",
)
def new_mappings_by_record_id(spark, sf_dir):
    rows, coins, mappings = _known_master(spark, sf_dir)
    found = identity.resolve_entities(rows, coins, mappings, use_record_source_id=True).new_mappings
    return found.select("coin_id", "source", "source_id", "source_symbol", "source_name")


@query(
    "resolve_by_symbol",
    f"""WITH {_RESOLVE_SQL}
SELECT DISTINCT coin_id, source, symbol AS source_id FROM assets JOIN all_coins USING (symbol)""",
)
def resolve_by_symbol(spark, sf_dir):
    rows, coins, _ = _known_master(spark, sf_dir)
    found = identity.resolve_by_symbol(rows, coins, spark.createDataFrame([], MAPPINGS))
    return found.new_mappings.select("coin_id", "source", "source_id")


@query(
    "lookup_coin_ids",
    f"""WITH {_RESOLVE_SQL}
SELECT arrival AS p_partkey, symbol, coin_id FROM assets LEFT JOIN coins USING (symbol)""",
)
def lookup_coin_ids(spark, sf_dir):
    rows, coins, _ = _known_master(spark, sf_dir)
    found = identity.lookup_coin_ids(rows, coins)
    return found.select(F.col("arrival").alias("p_partkey"), "symbol", "coin_id")


@query(
    "seed_coins",
    """SELECT row_number() OVER (ORDER BY slug) AS coin_id, upper(slug) AS symbol, upper(slug) AS name, slug
FROM (SELECT DISTINCT lower(p_name) AS slug FROM part)""",
)
def seed_coins(spark, sf_dir):
    return backfill.seed_coins(b.assets(spark, sf_dir), spark.createDataFrame([], COINS))


@query(
    "backfill_mappings",
    f"""WITH {_RESOLVE_SQL}
SELECT DISTINCT coin_id, source, symbol AS source_id, symbol AS source_symbol
FROM assets JOIN coins USING (symbol)""",
)
def backfill_mappings(spark, sf_dir):
    rows, coins, _ = _known_master(spark, sf_dir)
    lowered = rows.withColumn("symbol", F.lower("symbol"))
    return backfill.backfill_mappings(lowered, coins, spark.createDataFrame([], MAPPINGS))


@query(
    "backfill_coin_id",
    f"""WITH {_RESOLVE_SQL}
SELECT arrival AS p_partkey, CASE WHEN p_size > 25 THEN -1 ELSE coin_id END AS coin_id
FROM assets JOIN part ON p_partkey = arrival LEFT JOIN coins USING (symbol)""",
)
def backfill_coin_id(spark, sf_dir):
    """Parts above size 25 are linked already (to coin -1) and keep their id."""
    _, coins, _ = _known_master(spark, sf_dir)
    parts = b.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("symbol"), F.when(F.col("p_size") > 25, -1).cast("long").alias("coin_id")
    )
    return backfill.backfill_coin_id(parts, coins).select("p_partkey", "coin_id")


@query(
    "orphan_quotes",
    """SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')""",
)
def orphan_quotes(spark, sf_dir):
    """Orders whose customer is gone after the HOUSEHOLD segment was removed without a cascade."""
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parents = b.table(spark, sf_dir, "customer").where("c_mktsegment <> 'HOUSEHOLD'")
    return relations.orphans(orders, parents, "o_custkey", "c_custkey")


@query(
    "cascade_delete",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_orderkey NOT IN (
  SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'HOUSEHOLD')""",
)
def cascade_delete(spark, sf_dir):
    """What stays of lineitem when the HOUSEHOLD customers go, with their orders and lines."""
    removed = b.table(spark, sf_dir, "customer").where("c_mktsegment = 'HOUSEHOLD'").select("c_custkey")
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    gone = orders.join(removed, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return relations.without_children_of(lines, gone, "l_orderkey", "o_orderkey")


@query(
    "unique_violations",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def unique_keys(spark, sf_dir):
    return unique_violations(b.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
