"""Plans and results under a key that holds a third of the rows."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from quoteloom.operators import aliases, backfill, identity, merge, quotes, relations

N = 300_000


@contextmanager
def settings(spark, **conf):
    keys = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


SHUFFLE_JOINS = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "100000",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "200000",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


@pytest.fixture(scope="module")
def facts(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000 + 10).cast("long")
    return spark.range(0, N, numPartitions=16).select(
        key.alias("coin_id"),
        F.concat(F.lit("S"), key.cast("string")).alias("symbol"),
        F.lit("a").alias("source"),
        F.timestamp_seconds(F.col("id") % 50).alias("timestamp"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.col("id").cast("decimal(20,8)").alias("price_usd"),
        F.col("id").alias("arrival"),
    )


@pytest.fixture(scope="module")
def coins(spark):
    ids = spark.range(0, 1010)
    name = F.concat(F.lit("S"), F.col("id").cast("string"))
    return ids.select(F.col("id").alias("coin_id"), name.alias("symbol"), name.alias("name"))


def final_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def counted(frame):
    """Row count with every column computed, and the final plan."""
    digest = frame.agg(F.count("*").alias("n"), F.sum(F.hash(*frame.columns).cast("long")).alias("h"))
    (row,) = digest.collect()
    return row["n"], final_plan(digest)


@pytest.mark.parametrize("join", ["entity", "backfill", "lookup", "source_ids", "orphans", "aliases"])
def test_joins_split_the_hot_key(spark, facts, coins, join):
    builders = {
        "entity": lambda: relations.quotes_with_entity(facts, coins),
        "backfill": lambda: backfill.backfill_coin_id(facts.withColumn("coin_id", F.lit(None).cast("long")), coins),
        "lookup": lambda: identity.lookup_coin_ids(facts.drop("coin_id"), coins),
        "source_ids": lambda: identity.attach_source_ids(
            facts.withColumn("source_id", F.lit("")),
            identity.source_id_map(
                coins.select(
                    F.lit("a").alias("source"),
                    F.col("symbol").alias("raw_symbol"),
                    F.col("name").alias("raw_id"),
                    F.col("coin_id").alias("arrival"),
                )
            ),
        ),
        "aliases": lambda: aliases.with_exact_symbol(
            facts, "symbol", coins.select(F.col("name").alias("alias"), F.lower("symbol").alias("canonical"))
        ),
        "orphans": lambda: relations.orphans(facts, coins.where("coin_id <> 7"), "coin_id", "coin_id"),
    }
    with settings(spark, **SHUFFLE_JOINS):
        n, plan = counted(builders[join]())
        assert "skew=true" in plan
    assert n == (N // 3 if join == "orphans" else N)


def test_rows_per_key_are_reduced_before_the_shuffle(spark, facts):
    last = merge.last_per_key(facts, ["coin_id", "source", "timestamp"])
    plan = final_plan(last)
    assert plan.index("partial_max_by") > plan.index("Exchange") > plan.index("max_by")
    got = last.where("coin_id = 7").agg(F.count("*"), F.max("arrival")).first()
    assert tuple(got) == (50, N - 3)
    stats = quotes.symbol_stats(facts)
    row = stats.where("symbol = 'S7'").first()
    assert (row["record_count"], row["max_price_usd"]) == (N // 3, float(N - 3))
    assert final_plan(stats).count("partial_sum") >= 2


def test_small_masters_are_broadcast_by_size_and_large_ones_are_not(spark, facts, coins, folder):
    path = folder("coins")
    coins.write.parquet(path)
    stored = spark.read.parquet(path)
    assert "BroadcastHashJoin" in final_plan(relations.quotes_with_entity(facts, stored))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="1000"):
        assert "SortMergeJoin" in final_plan(relations.quotes_with_entity(facts, stored))


def test_hot_day_is_written_by_several_tasks(spark, facts, folder):
    from quoteloom.sources import Store
    from quoteloom.sources.store import with_event_date

    store = Store(spark, folder("store"))
    times = F.when(F.col("arrival") % 3 == 0, F.timestamp_seconds(F.col("arrival") % 80_000)).otherwise(
        F.timestamp_seconds(F.col("arrival") % 10 * 86_400 + 86_400)
    )
    rows = facts.withColumn("timestamp", times).withColumn("coin_id", F.col("arrival"))
    rows = with_event_date(rows.withColumns({c: F.lit(None) for c in ("market_cap", "volume_24h", "ingested_at")}))
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="800000"):
        store.publish_quotes(store.stage_quotes(rows.drop("payload", "arrival"), 1))
    files = store.read("quotes").select("event_date", F.input_file_name().alias("f")).distinct()
    per_day = {str(r["event_date"]): r["count"] for r in files.groupBy("event_date").count().collect()}
    assert per_day["1970-01-01"] >= 3, per_day  # several tasks share the hot day
    assert sum(per_day.values()) < 40, per_day  # yet not every task writes every day
    assert store.read("quotes").count() == N
