import json
import os
import random
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quoteloom.operators import drift, runs
from quoteloom.plans import ingest
from quoteloom.sources import Store, commits, get_source
from quoteloom.sources import store as store_module
from quoteloom.sources.commits import CommitLog, Conflict
from quoteloom.sources.store import Stage
from quoteloom.streaming import stream_csv, stream_json

T1 = datetime(2024, 6, 1, tzinfo=timezone.utc)
T2 = T1 + timedelta(days=1)


def market(symbol, price, when="2024-01-15T12:00:00Z", **extra):
    return {"id": extra.pop("id", symbol.lower() + "-id"), "symbol": symbol, "name": symbol.title(), "current_price": price,
            "market_cap": 1, "total_volume": 2, "last_updated": when, **extra}


def ticker(symbol, price, when="2024-01-15T12:00:00Z"):
    return {"id": "t-" + symbol.lower(), "name": symbol, "symbol": symbol, "rank": 1, "last_updated": when,
            "quotes": {"USD": {"price": price}}}


def put(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(data if isinstance(data, str) else json.dumps(data))
    return folder


@pytest.fixture
def store(spark, folder):
    return Store(spark, folder("store"))


def facts(store):
    q = store.read("quotes").join(store.read("coins").select("coin_id", F.col("symbol").alias("coin")), "coin_id", "left")
    return rows(q.select("coin", "source", "timestamp", F.col("price_usd").cast("double")))


NOON = datetime(2024, 1, 15, 12)


def test_three_feeds_share_coins(store, folder):
    paths = {
        "coingecko": put(folder(), "a.json", [market("btc", 1.0), market("eth", 2.0), market("bad", "N/A")]),
        "coinpaprika": put(folder(), "a.json", [ticker("BTC", 1.5)]),
        "csv": put(folder(), "a.csv", "ticker,price,vol,date\nBTC,3,4,2024-01-15\nXRP,x,,2024-01-15\n"),
    }
    results = ingest.run_all(store, paths, run_ts=T1)
    assert {s: r.records_processed for s, r in results.items()} == {"coingecko": 2, "coinpaprika": 1, "csv": 2}
    assert results["coingecko"].rows_rejected == 1
    day = datetime(2024, 1, 15)
    assert facts(store) == sorted(
        [("BTC", "coingecko", NOON, 1.0), ("BTC", "coinpaprika", NOON, 1.5), ("BTC", "csv", day, 3.0),
         ("ETH", "coingecko", NOON, 2.0), ("XRP", "csv", day, None)],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    assert rows(store.read("coins").select("coin_id", "symbol", "slug")) == [
        (1, "BTC", "btc"), (2, "ETH", "eth"), (3, "XRP", "xrp"),
    ]
    assert store.read("mappings").count() == 5
    assert rows(store.quarantine().select("source", "reject_reason")) == [("coingecko", "bad_number")]
    assert store.committed("raw").groupBy("source").count().count() == 3
    assert store.read("raw").count() == 6
    assert rows(store.runs().select("id", "source", "status", "records_processed")) == [
        (1, "coingecko", "success", 2), (2, "coinpaprika", "success", 1), (3, "csv", "success", 2),
    ]
    assert runs.health(store.runs()).first()["status"] == "healthy"
    assert store.read("quotes").where("ingested_at <> timestamp'2024-06-01 00:00:00'").count() == 0


def test_running_twice_equals_running_once(store, folder):
    path = put(folder(), "a.json", [market("btc", 1.0), market("eth", 2.0)])
    first = ingest.run_source(store, "coingecko", path, run_ts=T1)
    before = facts(store)
    again = ingest.run_source(store, "coingecko", path, force_full=True, run_ts=T2)
    assert facts(store) == before
    assert (first.records_processed, again.records_processed) == (2, 2)
    assert store.read("coins").count() == 2 and store.read("mappings").count() == 2
    assert len([e for e in store.log.entries() if e.table == "coins"]) == 1  # the second run appended nothing


def test_incremental_empty_and_forced_runs(store, folder):
    path = put(folder(), "a.json", [market("btc", 1.0)])
    assert ingest.run_source(store, "coingecko", path, run_ts=T1).checkpoint == NOON.replace(tzinfo=timezone.utc)
    empty = ingest.run_source(store, "coingecko", path, run_ts=T2)
    assert (empty.status, empty.records_processed, empty.rows_read) == ("success", 0, 0)
    assert store.read("raw").count() == 1
    assert ingest.checkpoint_of(store, "coingecko", literal=True) is None
    assert ingest.checkpoint_of(store, "coingecko") == NOON.replace(tzinfo=timezone.utc)
    put(path, "b.json", [market("btc", 9.0, "2024-01-15T13:00:00Z"), market("old", 1.0, "2024-01-01T00:00:00Z")])
    third = ingest.run_source(store, "coingecko", path, run_ts=T2 + timedelta(days=1))
    assert third.records_processed == 1
    assert ingest.run_source(store, "coingecko", path, True, T2 + timedelta(days=2)).records_processed == 3


def test_duplicates_and_order(store, folder):
    path = put(folder(), "a.json", [market("btc", 1.0), market("btc", 2.0), market("btc", 3.0)])
    done = ingest.run_source(store, "coingecko", path, run_ts=T1)
    assert (done.records_processed, done.duplicates_dropped) == (1, 2)
    assert facts(store) == [("BTC", "coingecko", NOON, 3.0)]


def test_update_overwrites_values_with_null_but_not_the_symbol(store, folder):
    path = put(folder(), "a.json", [market("btc", 1.0, id="one")])
    ingest.run_source(store, "coingecko", path, run_ts=T1)
    other = put(folder(), "a.json", [market("xbt", None, id="one")])
    ingest.run_source(store, "coingecko", other, force_full=True, run_ts=T2)
    (row,) = store.read("quotes").collect()
    assert (row["symbol"], row["price_usd"], row["ingested_at"]) == ("BTC", None, datetime(2024, 6, 2))


def test_only_touched_days_are_rewritten(store, folder):
    path = put(folder(), "a.json", [market("btc", 1.0, f"2024-01-{d}T00:00:00Z") for d in (10, 11, 12)])
    ingest.run_source(store, "coingecko", path, run_ts=T1)

    before = {e.day: e.path for e in store.log.entries() if e.table == "quotes"}
    late = put(folder(), "a.json", [market("eth", 5.0, "2024-01-11T00:00:00Z")])
    ingest.run_source(store, "coingecko", late, force_full=True, run_ts=T2)
    after = {e.day: e.path for e in store.log.entries() if e.table == "quotes"}
    assert [d for d in before if before[d] != after[d]] == ["2024-01-11"]
    assert store.read("quotes").count() == 4


def test_failures_are_recorded_and_leave_the_quotes_alone(store, folder):
    good = put(folder(), "a.json", [market("btc", 1.0)])
    results = ingest.run_all(
        store, {"csv": folder() + "/none.csv", "coinpaprika": put(folder(), "a.json", {"error": "x" * 5}), "coingecko": good}, run_ts=T1
    )
    assert isinstance(results["csv"], ingest.RunFailed) and isinstance(results["coinpaprika"], ingest.RunFailed)
    assert results["coingecko"].records_processed == 1
    state = {r["source"]: r for r in store.runs().collect()}
    assert state["csv"]["status"] == "failure" and "CSV file not found" in state["csv"]["error_message"]
    assert state["coinpaprika"]["records_processed"] == 0 and state["coinpaprika"]["last_processed_timestamp"] is None
    with pytest.raises(ValueError, match="No extractor registered"):
        ingest.run_source(store, "nope", good)


def test_long_error_messages_are_cut(store):
    job = ingest.start_job(store, "csv", T1)
    ingest.finish_job(store, job, "csv", "failure", T1, T2, error="e" * 2000)
    assert store.runs().first()["error_message"] == "e" * 990 + "..."
    job = ingest.start_job(store, "csv", T2)
    assert job == 2 and store.runs().where("id = 2").first()["status"] == "running"


def test_failed_attempt_is_not_committed_and_a_retry_repairs_it(store, folder, monkeypatch):
    path = put(folder(), "a.json", [market("btc", 1.0)])
    monkeypatch.setattr(Stage, "commit", lambda self, *a, **b: (_ for _ in ()).throw(IOError("disk")))
    with pytest.raises(ingest.RunFailed, match="disk"):
        ingest.run_source(store, "coingecko", path, run_ts=T1)
    assert store.read("quotes").count() == 0 and store.committed("raw").count() == 0
    assert store.read("coins").count() == 0 and store.read("mappings").count() == 0
    assert ingest.checkpoint_of(store, "coingecko") is None
    monkeypatch.undo()
    ingest.run_source(store, "coingecko", path, run_ts=T2)
    assert facts(store) == [("BTC", "coingecko", NOON, 1.0)]
    assert store.committed("raw").count() == 1 and store.read("raw").count() == 2
    assert store.read("coins").count() == 1


def test_a_stage_is_seen_from_its_commit_on(store, folder):
    path = put(folder(), "a.json", [market("btc", 1.0)])
    ingest.run_source(store, "coingecko", path, run_ts=T1)
    batch = store.read("quotes").withColumn("price_usd", F.lit(7).cast("decimal(20,8)"))
    stage = store.stage_quotes(batch)
    other = store.stage_quotes(batch.withColumn("price_usd", F.lit(8).cast("decimal(20,8)")))
    assert facts(store) == [("BTC", "coingecko", NOON, 1.0)]
    earlier = store.read("quotes")
    store.publish_quotes(stage)
    assert facts(store) == [("BTC", "coingecko", NOON, 7.0)]
    assert float(earlier.first()["price_usd"]) == 1.0  # a frame stays as of its commit
    with pytest.raises(Conflict):  # made upon the same commit, it would undo the first one
        store.publish_quotes(other)
    assert len(store.vacuum()) == 2 and facts(store) == [("BTC", "coingecko", NOON, 7.0)] and store.vacuum() == []


def test_drift_log(store, folder):
    path = put(folder(), "a.json", [market("btc", 1.0) | {"quotes_": 1}, {**market("eth", 2.0), "name": None}])
    ingest.run_source(store, "coingecko", path, run_ts=T1)
    log = store.committed("drift_log")
    kinds = {r["drift_type"] for r in log.collect()}
    assert kinds == {"schema_extra", "quality_nulls"}
    assert rows(drift.drift_summary(log).where("level = 'total'").select("issues")) == [(3,)]
    csv = put(folder(), "a.csv", "ticker,price,vol,date\nBTC,,4,2024-01-15\n")
    ingest.run_source(store, "csv", csv, run_ts=T2)
    found = store.committed("drift_log").where("source = 'csv'").collect()
    assert [(r["drift_type"], r["severity"]) for r in found] == [("quality_nulls", "critical")]


def test_slug_collision_fails_the_run(store, folder):
    long = "a" * 20
    path = put(folder(), "a.json", [market("btc", 1.0, id="1")])
    store.append("coins", store.spark.createDataFrame([(1, "OTHER", "n", "btc-" + long)], "coin_id long, symbol string, name string, slug string").withColumns(
        {"created_at": F.lit(None).cast("timestamp"), "updated_at": F.lit(None).cast("timestamp")}))
    put(path, "a.json", [{**market("btc", 1.0), "name": long + "b"}])
    with pytest.raises(ingest.RunFailed, match="duplicate coin slug"):
        ingest.run_source(store, "coingecko", path, run_ts=T1)
    assert store.read("coins").count() == 1 and store.read("quotes").count() == 0


def test_a_run_with_only_bad_rows_succeeds_and_fills_the_quarantine(store, folder):
    path = put(folder(), "a.json", [market("btc", "N/A"), market("eth", "x")])
    done = ingest.run_source(store, "coingecko", path, run_ts=T1)
    assert (done.status, done.records_processed, done.rows_rejected, done.checkpoint) == ("success", 0, 2, None)
    assert store.committed("raw").count() == 0 and store.quarantine().count() == 2
    assert store.read("coins").count() == 0


STEPS = [
    (Stage, "add_rows", 1), (Stage, "add_rows", 2), (Stage, "add_rows", 3), (Stage, "upsert_quotes", 1),
    (CommitLog, "write_manifest", 1), (commits, "create_text", 2), (commits, "create_text", 3), (Stage, "commit", 1),
]


class Killed(BaseException):
    """Ends a run as a lost driver would: nothing after it runs."""


@pytest.mark.parametrize("kind,after", [(OSError, False), (Killed, True)])
@pytest.mark.parametrize("owner,name,number", STEPS)
def test_a_run_is_whole_or_absent_wherever_it_breaks(store, folder, monkeypatch, owner, name, number, kind, after):
    path = put(folder(), "a.json", [market("btc", 1.0)])
    ingest.run_source(store, "coingecko", path, run_ts=T1)
    real, calls = getattr(owner, name), []

    def breaking(*args, **kwargs):
        calls.append(1)
        if len(calls) != number:
            return real(*args, **kwargs)
        if after:
            real(*args, **kwargs)
        raise kind("broken")

    more = [market("btc", 2.0), market("eth", 3.0), market("sol", 4.0, "2024-01-17T00:00:00Z")]
    put(path, "a.json", more)
    monkeypatch.setattr(owner, name, breaking)
    try:
        ingest.run_source(store, "coingecko", path, force_full=True, run_ts=T2)
    except (ingest.RunFailed, Killed):
        pass
    monkeypatch.undo()
    ingest.recover(store)
    last = store.runs().where("id = 2").first()
    got = [(f[0], f[3]) for f in facts(store)]
    masters = store.read("coins").count(), store.read("mappings").count()
    loaded = (last["status"], last["records_processed"], got, masters, store.committed("raw").count())
    checkpoint = ingest.checkpoint_of(store, "coingecko")
    if last["status"] == "success":
        assert loaded[1:] == (3, [("BTC", 2.0), ("ETH", 3.0), ("SOL", 4.0)], (3, 3), 4)
        assert checkpoint == datetime(2024, 1, 17, tzinfo=timezone.utc)
    else:
        assert loaded == ("failure", 0, [("BTC", 1.0)], (1, 1), 1)
        assert checkpoint == NOON.replace(tzinfo=timezone.utc)
    assert ingest.recover(store) == []


def test_rows_without_a_time_are_upserted(spark, store):
    schema = store.read("quotes").schema
    for price, coin in ((1, 1), (2, 2), (3, 1)):
        row = [(coin, "A", price, None, None, "s", None, None, None)]
        batch = spark.createDataFrame(row, "coin_id long, symbol string, price_usd int, market_cap int, volume_24h int, source string, ingested_at timestamp, timestamp timestamp, event_date date")
        batch = batch.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        store.publish_quotes(store.stage_quotes(batch, price))
    assert sorted((r.coin_id, float(r.price_usd)) for r in store.read("quotes").collect()) == [(1, 3.0), (2, 2.0)]


def test_compaction_keeps_the_rows(store, folder, monkeypatch):
    for k in range(3):
        ingest.run_source(store, "coingecko", put(folder(), "a.json", [market(f"c{k}", 1.0)]), True, T1)
    before = rows(store.read("coins"))
    assert len([e for e in store.log.entries() if e.table == "coins"]) == 3
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.compact("coins")
    assert rows(store.read("coins")) == before
    store.compact("coins")
    assert rows(store.read("coins")) == before
    assert len([e for e in store.log.entries() if e.table == "coins"]) == 1
    with pytest.raises(ValueError, match="partitioned"):
        store.compact("quotes")
    monkeypatch.setattr(store_module, "MOST_PARTS", 3)
    for k in range(3, 7):
        ingest.run_source(store, "coingecko", put(folder(), "a.json", [market(f"c{k}", 1.0)]), True, T1)
    assert len([e for e in store.log.entries() if e.table == "coins"]) <= 3
    assert rows(store.read("coins").select("symbol")) == [(f"C{k}",) for k in range(7)]


def test_the_ledger_is_a_snapshot_and_a_tail(store, monkeypatch):
    monkeypatch.setattr(commits, "BLOCK", 4)
    for k in range(11):
        job = ingest.start_job(store, "csv", T1 + timedelta(hours=k))
        ingest.finish_job(store, job, "csv", "success", T1, T2, records=k)
    found = store.read("ledger")
    assert found.count() == 22 and rows(store.runs().select("id", "records_processed")) == sorted(
        [(k + 1, k) for k in range(11)], key=lambda r: str(r[0])
    )
    assert store.log.head().number == 22 and len([f for f in found.inputFiles() if f.endswith(".json")]) == 3
    assert ingest.start_job(store, "csv", T2) == 12


def test_two_writers_of_one_store(store):
    head = store.log.head()
    ingest.start_job(store, "csv", T1)
    with pytest.raises(Conflict):
        store.log.commit(head, last_job=1, open_job=1)


def quote_rows(spark, store, data):
    """Quotes of (coin, price) at (day, second)."""
    fields = "coin_id long, price int, time timestamp"
    base = datetime(2024, 1, 1)
    given = [(coin, price, base + timedelta(days=day, seconds=second)) for coin, price, day, second in data]
    made = spark.createDataFrame(given, fields).select(
        "coin_id", F.lit("A").alias("symbol"), F.col("price").cast("decimal(20,8)").alias("price_usd"),
        F.lit(None).cast("decimal(30,2)").alias("market_cap"), F.lit(None).cast("decimal(30,2)").alias("volume_24h"),
        F.lit("s").alias("source"), F.lit(T1).cast("timestamp").alias("ingested_at"), F.col("time").alias("timestamp"),
        F.to_date("time").alias("event_date"),
    )
    return made.select(*store.read("quotes").columns)


def test_a_late_row_rewrites_one_bucket(spark, folder):
    store = Store(spark, folder("store"), bucket_rows=20)
    data = [(coin, 1, day, second) for coin in range(20) for day in range(2) for second in range(10)]
    store.publish_quotes(store.stage_quotes(quote_rows(spark, store, data)))
    before = {(e.day, e.bucket): e for e in store.log.entries()}
    assert {e.buckets for e in before.values()} == {8} and sum(e.rows for e in before.values()) == 400
    store.publish_quotes(store.stage_quotes(quote_rows(spark, store, [(3, 9, 1, 4), (99, 5, 1, 4)][:1])))
    after = {(e.day, e.bucket): e for e in store.log.entries()}
    changed = [k for k in before if before[k].path != after[k].path]
    assert len(changed) == 1 and changed[0][0] == "2024-01-02" and before[changed[0]].rows == after[changed[0]].rows
    assert store.read("quotes").count() == 400 and store.read("quotes").where("price_usd = 9").count() == 1


def test_days_are_dealt_anew_as_they_grow(spark, folder):
    rng = random.Random(7)
    store, model = Store(spark, folder("store"), bucket_rows=5), {}
    for price in range(1, 7):
        data = {(rng.randrange(12), price, rng.randrange(2), rng.randrange(6)) for _ in range(5 * price)}
        data.add((1, price, 7, 0))
        model |= {(coin, day, second): price for coin, price, day, second in data}
        store.publish_quotes(store.stage_quotes(quote_rows(spark, store, sorted(data))))
        found = store.read("quotes").selectExpr(
            "coin_id", "datediff(event_date, '2024-01-01')", "second(timestamp)", "cast(price_usd as int)"
        )
        assert sorted(tuple(r) for r in found.collect()) == sorted((*k, v) for k, v in model.items())
        live = [e for e in store.log.entries() if e.table == "quotes"]
        assert sum(e.rows for e in live) == len(model) and len({(e.day, e.bucket) for e in live}) == len(live)
    assert max(e.buckets for e in live) > 1 and min(e.buckets for e in live) == 1
    store.vacuum()
    assert store.read("quotes").count() == len(model)


def test_loaded_files_are_not_read_again(store, folder, monkeypatch):
    path = folder("feed")
    for k in range(30):
        put(path, f"{k}.json", [market(f"c{k}", 1.0)])
    spec = get_source("coingecko")
    read = []

    def reading(spark, given):
        read.append(given)
        return spec.read(spark, given)

    spied = replace(spec, read=reading)
    ingest.run_source(store, "coingecko", path, run_ts=T1, spec=spied)
    put(path, "new.json", [market("btc", 2.0, "2024-01-16T00:00:00Z"), market("old", 2.0, "2024-01-01T00:00:00Z")])
    done = ingest.run_source(store, "coingecko", path, run_ts=T2, spec=spied)
    assert read[0] == path and [f.rsplit("/", 1)[1] for f in read[1]] == ["new.json"]
    assert (done.records_processed, done.rows_read) == (1, 1)  # the checkpoint holds for rows of new files
    assert ingest.run_source(store, "coingecko", path, run_ts=T2, spec=spied).rows_read == 0 and len(read) == 2
    put(path, "3.json", [market("c3", 5.0, "2024-01-20T00:00:00Z"), market("c3", 6.0, "2024-01-21T00:00:00Z")])
    with monkeypatch.context() as patch:  # a failed run has loaded nothing
        patch.setattr(Stage, "commit", lambda *a, **b: 1 / 0)
        with pytest.raises(ingest.RunFailed):
            ingest.run_source(store, "coingecko", path, run_ts=T2, spec=spied)
    assert ingest.run_source(store, "coingecko", path, run_ts=T2, spec=spied).records_processed == 2
    assert [f.rsplit("/", 1)[1] for f in read[-1]] == ["3.json"]
    # Another source has a log of its own, and a full run reads everything.
    assert ingest.run_source(store, "csv", put(folder(), "a.csv", "ticker,price\nbtc,1\n"), run_ts=T2).rows_read == 1
    ingest.run_source(store, "coingecko", path, force_full=True, run_ts=T2, spec=spied)
    assert read[-1] == path


def state(store):
    return facts(store), rows(store.read("coins").select("symbol", "slug")), store.read("mappings").count()


def test_stream_equals_batch(spark, store, folder):
    items = [[market("btc", 1.0), market("eth", 2.0)], [market("btc", 5.0), market("sol", 3.0, "2024-01-16T00:00:00Z")]]
    landing = folder("landing")
    for i, page in enumerate(items):
        put(landing, f"{i}.json", page)
        os.utime(f"{landing}/{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    query = stream_json(store, "coingecko", landing, folder("ckpt"), files_per_batch=1, run_ts=T1)
    query.awaitTermination()
    assert [r["batch_id"] for r in store.runs().orderBy("id").collect()] == [0, 1]
    other = Store(spark, folder("batch"))
    ingest.run_source(other, "coingecko", landing, run_ts=T1)
    assert state(store) == state(other)


def test_stream_resumes_redelivers_and_handles_late_rows(store, folder):
    landing, ckpt = folder("landing"), folder("ckpt")
    put(landing, "0.json", [market("btc", 1.0)])
    stream_json(store, "coingecko", landing, ckpt, run_ts=T1).awaitTermination()
    put(landing, "1.json", [market("btc", 2.0), market("eth", 1.0, "2024-01-01T00:00:00Z")])
    stream_json(store, "coingecko", landing, ckpt, run_ts=T2).awaitTermination()
    assert facts(store) == [
        ("BTC", "coingecko", NOON, 2.0), ("ETH", "coingecko", datetime(2024, 1, 1), 1.0),
    ]
    put(landing, "2.json", [market("ada", 1.0, "2024-01-02T00:00:00Z"), market("btc", 4.0, "2024-01-20T00:00:00Z")])
    stream_json(store, "coingecko", landing, ckpt, drop_late=True, run_ts=T2).awaitTermination()
    assert [f[0] for f in facts(store)] == ["BTC", "BTC", "ETH"]
    # The same files again, from a lost stream checkpoint: same keys, same table.
    before = facts(store)
    stream_json(store, "coingecko", landing, folder("new"), files_per_batch=1, drop_late=True, run_ts=T2).awaitTermination()
    assert facts(store) == before


def test_a_batch_that_is_delivered_again_opens_no_run(store, folder):
    landing, ckpt = folder("landing"), folder("ckpt")
    put(landing, "0.json", [market("btc", 1.0)])
    stream_json(store, "coingecko", landing, ckpt, run_ts=T1).awaitTermination()
    before = facts(store), rows(store.runs()), store.log.head()
    assert before[2].streams and list(before[2].streams.values())[0].number == 0
    os.rename(f"{ckpt}/commits", f"{ckpt}/lost")  # as if Spark had died before it noted the batch
    stream_json(store, "coingecko", landing, ckpt, run_ts=T2).awaitTermination()
    assert (facts(store), rows(store.runs()), store.log.head()) == before
    put(landing, "1.json", [market("btc", 2.0)])
    stream_json(store, "coingecko", landing, ckpt, run_ts=T2).awaitTermination()
    assert [r["batch_id"] for r in store.runs().orderBy("id").collect()] == [0, 1]
    # A new checkpoint is a new stream, whose batches count from 0 again.
    stream_json(store, "coingecko", landing, folder("other"), run_ts=T2).awaitTermination()
    assert [r["batch_id"] for r in store.runs().orderBy("id").collect()] == [0, 1, 0]
    assert len(store.log.head().streams) == 2


def test_rows_beyond_the_lateness_go_to_the_quarantine(store, folder):
    landing, ckpt = folder("landing"), folder("ckpt")

    def deliver(number, *items):
        put(landing, f"{number}.json", list(items))
        stream_json(store, "coingecko", landing, ckpt, late_after=timedelta(days=2), run_ts=T1).awaitTermination()

    deliver(0, market("btc", 1.0, "2024-01-10T00:00:00Z"), market("eth", 1.0, "2024-01-01T00:00:00Z"))
    deliver(1, market("sol", 2.0, "2024-01-08T00:00:00Z"), market("old", 2.0, "2024-01-07T23:59:59Z"), market("bad", "N/A"))
    deliver(2, market("btc", 3.0, "2024-01-20T00:00:00Z"), market("xrp", 3.0, "2024-01-08T00:00:00Z"))
    deliver(3, market("xrp", 4.0, "2024-01-09T00:00:00Z"), market("xrp", 4.0, None))
    assert sorted((f[0], f[2].day) for f in facts(store)) == [
        ("BTC", 10), ("BTC", 20), ("ETH", 1), ("SOL", 8), ("XRP", 1), ("XRP", 8),
    ]
    assert rows(store.quarantine().select("job_id", "reject_reason")) == [(2, "bad_number"), (2, "late"), (4, "late")]


def test_csv_stream(store, folder):
    landing = put(folder("landing"), "a.csv", 'ticker,price,vol,date\nBTC,1,2,2024-01-15\nBTC,"3",2,2024-01-15\n')
    stream_csv(store, "csv", landing, folder("ckpt"), run_ts=T1).awaitTermination()
    assert facts(store) == [("BTC", "csv", datetime(2024, 1, 15), 3.0)]


def test_csv_stream_reads_each_file_by_its_own_header(store, folder):
    landing = put(folder("landing"), "a.csv", "ticker,vol,price,date\nBTC,7,100,2024-01-15\n")
    put(landing, "b c.csv", 'Date;TICKER;Price\n2024-01-16;"E\nTH";5\n')
    stream_csv(store, "csv", landing, folder("ckpt"), run_ts=T1).awaitTermination()
    assert [(s, p) for s, _, _, p in facts(store)] == [("BTC", 100.0), ("E\nTH", 5.0)]
