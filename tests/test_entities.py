import random

import pytest
from conftest import rows
from model import Resolver, id_map
from pyspark.sql import functions as F

from quoteloom.operators import backfill, identity, ids, quality, relations
from quoteloom.schemas import COINS, MAPPINGS

RECORD = "source string, symbol string, source_id string, name string, raw_symbol string, raw_id string, arrival long"


def master(spark, coins, mappings):
    c = spark.createDataFrame(coins, "coin_id long, symbol string") if coins else spark.createDataFrame([], COINS)
    m = (
        spark.createDataFrame(mappings, "source string, source_id string, coin_id long")
        if mappings
        else spark.createDataFrame([], MAPPINGS)
    )
    return c, m


def check(spark, records, coins=(), mappings=(), own_ids=False, parts=3):
    """records: (source, symbol, source_id, name) in order."""
    model = Resolver(coins, mappings)
    ids_by_symbol = id_map([(s, sym, sid) for s, sym, sid, _ in records])
    want = []
    for source, symbol, source_id, name in records:
        sid = source_id if own_ids else ids_by_symbol.get((source, symbol))
        want.append(model.resolve(source, sid or symbol, symbol, name))

    frame = spark.createDataFrame(
        [(s, sym, sid, name, sym, sid, i) for i, (s, sym, sid, name) in enumerate(records)], RECORD
    ).repartition(parts)
    c, m = master(spark, list(coins), list(mappings))
    found = identity.resolve_entities(frame, c, m, raw=frame, use_record_source_id=own_ids)
    got = {r["arrival"]: r["coin_id"] for r in found.attach(frame).collect()}
    assert [got[i] for i in range(len(records))] == want
    assert rows(found.new_coins.select("coin_id", "symbol", "name", "slug")) == sorted(
        model.new_coins(), key=lambda r: tuple((v is None, str(v)) for v in r)
    )
    columns = ["coin_id", "source", "source_id", "source_symbol", "source_name"]
    assert sorted(rows(found.new_mappings.select(*columns)), key=str) == model.new_mappings()


SEQUENCES = [
    [("coingecko", "BTC", "bitcoin", "Bitcoin"), ("coinpaprika", "BTC", "btc-bitcoin", "Bitcoin"), ("csv", "BTC", "BTC", "BTC")],
    [("coingecko", "BTC", "bitcoin", "Bitcoin")] * 2,
    [("coingecko", "BTC", "bitcoin", "Bitcoin"), ("coingecko", "ETH", "ethereum", "Ethereum")],
    [("coingecko", "ATOM", "cosmos", "Cosmos"), ("coinpaprika", "ATOM", "atom-cosmos", "Cosmos")],
    # One id under two symbols, and two ids under one symbol.
    [("a", "X", "one", "N1"), ("a", "Y", "one", "N2"), ("a", "Y", "two", None), ("b", "Y", "", "N3")],
]


@pytest.mark.parametrize("own_ids", [False, True])
@pytest.mark.parametrize("records", SEQUENCES)
def test_sequences(spark, records, own_ids):
    check(spark, records, own_ids=own_ids)


def test_four_records_of_one_asset_make_one_coin_and_three_mappings(spark):
    frame = spark.createDataFrame(
        [(s, sym, sid, n, sym, sid, i) for i, (s, sym, sid, n) in enumerate(SEQUENCES[0])], RECORD
    )
    found = identity.resolve_entities(frame, *master(spark, [], []), raw=frame)
    assert found.new_coins.count() == 1 and found.new_mappings.count() == 3
    assert rows(found.new_coins.select("symbol", "slug")) == [("BTC", "btc-bitcoin")]


@pytest.mark.parametrize("seed", range(6))
def test_random_batches_agree_with_the_sequential_model(spark, seed):
    rng = random.Random(seed)
    symbols = [f"S{i}" for i in range(rng.randint(2, 6))]
    sids = [f"id{i}" for i in range(rng.randint(1, 6))] + ["", None]
    known = rng.sample(symbols, rng.randint(0, len(symbols) // 2))
    coins = [(i + 1, s) for i, s in enumerate(known)]
    mappings = [("a", sid, rng.choice(coins)[0]) for sid in sids[:2] if coins and sid and rng.random() < 0.6]
    records = [
        (rng.choice("ab"), rng.choice(symbols), rng.choice(sids), rng.choice(["", None, "name x", "other-1", "S1"]))
        for _ in range(rng.randint(1, 40))
    ]
    check(spark, records, coins, mappings, own_ids=bool(seed % 2), parts=rng.randint(1, 7))


def test_a_hot_symbol_changes_nothing(spark):
    hot = [("a", "HOT", "hot-id", "Hot")] * 700
    check(spark, [*hot[:300], *[("a", f"C{i}", f"c{i}", None) for i in range(300)], *hot[300:]], parts=8)


def test_mapped_id_keeps_its_coin_when_the_symbol_changes(spark):
    check(spark, [("a", "NEW", "bitcoin", "B")], coins=[(1, "BTC"), (2, "NEW")], mappings=[("a", "bitcoin", 1)])


def test_symbol_shared_by_two_coins_fails_only_when_used(spark):
    frame = spark.createDataFrame([("a", "BTC", "x", "n", "BTC", "x", 1)], RECORD)
    coins, mappings = master(spark, [(1, "BTC"), (2, "BTC")], [("a", "x", 2)])
    assert rows(identity.resolve_entities(frame, coins, mappings, raw=frame).attach(frame).select("coin_id")) == [(2,)]
    with pytest.raises(Exception, match="several coins have the symbol BTC"):
        identity.resolve_entities(frame, coins, mappings.limit(0), raw=frame).keys.collect()


def test_raw_symbols_are_upper_cased_but_not_trimmed(spark):
    raw = spark.createDataFrame(
        [("a", "btc", "1", 1), ("a", "BTC", "2", 2), ("a", " btc", "3", 3), ("a", "eth", "", 4), ("a", "", "5", 5)],
        "source string, raw_symbol string, raw_id string, arrival long",
    )
    assert rows(identity.source_id_map(raw)) == [("a", " BTC", "3"), ("a", "BTC", "2")]


def test_dense_ids_follow_the_order(spark):
    df = spark.range(0, 5000, numPartitions=11).select(((F.col("id") * 7919) % 5003).alias("k"))
    got = ids.with_dense_ids(df, ["k"], "n", 100).orderBy("k").collect()
    assert [r["n"] for r in got] == list(range(101, 5101))
    assert ids.with_dense_ids(df.limit(0), ["k"], "n", 3).count() == 0


def test_resolve_by_symbol(spark):
    frame = spark.createDataFrame(
        [("csv", "BTC", None, "x", "", "", 1), ("csv", "ETH", None, "y", "", "", 2), ("b", "ETH", None, "z", "", "", 3)],
        RECORD,
    )
    coins, mappings = master(spark, [(4, "BTC"), (5, "ADA")], [("csv", "BTC", 5)])
    found = identity.resolve_by_symbol(frame, coins, mappings)
    assert rows(found.attach(frame).select("arrival", "coin_id")) == [(1, 4), (2, 6), (3, 6)]
    assert rows(found.new_coins.select("coin_id", "symbol", "name", "slug")) == [(6, "ETH", "ETH", "eth")]
    assert rows(found.new_mappings.select("coin_id", "source", "source_id", "source_name")) == [
        (6, "b", "ETH", None), (6, "csv", "ETH", "ETH"),
    ]


def test_backfill(spark):
    quotes = spark.createDataFrame(
        [(None, "btc", "a"), (None, "BTC", "b"), (9, "btc", "a"), (None, "zzz", "a"), (None, None, "a")],
        "coin_id long, symbol string, source string",
    )
    coins = spark.createDataFrame([(1, "BTC"), (3, "btc"), (2, "ETH")], "coin_id long, symbol string")
    assert rows(backfill.backfill_coin_id(quotes, coins).select("coin_id", "symbol")) == [
        (1, "BTC"), (1, "btc"), (9, "btc"), (None, "zzz"), (None, None),
    ]
    known = spark.createDataFrame([("b", "BTC")], "source string, source_id string")
    assert rows(backfill.backfill_mappings(quotes, coins, known)) == [(1, "a", "BTC", "BTC")]
    seeded = backfill.seed_coins(quotes, spark.createDataFrame([(1, "zzz")], "coin_id long, slug string"))
    assert rows(seeded) == [(2, "BTC", "BTC", "btc")]


def test_relations(spark):
    coins = spark.createDataFrame([(1, "BTC", "Bitcoin"), (2, "ETH", "Ethereum")], "coin_id long, symbol string, name string")
    quotes = spark.createDataFrame([(1, "q1"), (7, "q2"), (None, "q3")], "coin_id long, q string")
    mappings = spark.createDataFrame(
        [(1, "a", "x", "s", "n"), (1, "b", "y", "s", "n")],
        "coin_id long, source string, source_id string, source_symbol string, source_name string",
    )
    embedded = {r["q"]: r["coin"] for r in relations.quotes_with_entity(quotes, coins).collect()}
    assert embedded["q1"].asDict() == {"id": 1, "symbol": "BTC", "name": "Bitcoin"}
    assert embedded["q2"] is None and embedded["q3"] is None
    assert rows(relations.entity_mappings(coins, mappings).select("coin_id", "source_id")) == [(1, "x"), (1, "y"), (2, None)]
    assert rows(relations.orphans(quotes, coins, "coin_id", "coin_id").select("q")) == [("q2",)]
    left = relations.delete_coins(coins.where("coin_id = 1"), coins, mappings, quotes)
    assert [t.count() for t in left] == [1, 0, 2]


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a"), (2, "a")], "k long, s string")
    assert rows(quality.unique_violations(df, ["k", "s"])) == [(1, "a", 2)]
    with pytest.raises(ValueError, match="duplicate key"):
        quality.assert_insertable(df, df.limit(0), ["k"], "key")
    with pytest.raises(ValueError, match="duplicate key"):
        quality.assert_insertable(df.where("k = 2"), df, ["k"], "key")
    quality.assert_insertable(df.where("k = 2"), df.where("k = 1"), ["k"], "key")
