import json
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from conftest import rows
from model import upsert

from quoteloom.operators import drift, merge, quotes, runs
from quoteloom.schemas import LEDGER

T0 = datetime(2024, 1, 15, 12)


def ledger(spark, specs):
    """specs: (id, status, minutes or None, records); one run per hour."""
    out = []
    for i, status, minutes, records in specs:
        start = T0 + timedelta(hours=i)
        end = None if minutes is None else start + timedelta(minutes=minutes)
        out.append((i, "csv", status, start, records, start, end, None, None, 1))
    return spark.createDataFrame(out, LEDGER)


def test_duration_outlier_needs_six_runs(spark):
    six = ledger(spark, [(i, "success", 5, 100) for i in range(5)] + [(5, "success", 60, 100)])
    (found,) = runs.duration_outliers(six).collect()
    assert found["job_id"] == 5 and found["value"] == 3600 and round(found["z_score"], 2) == 2.04
    values = [300.0] * 5 + [3600.0]
    low = statistics.mean(values) - 2 * statistics.stdev(values)
    assert found["expected_low"] == pytest.approx(low)
    assert found["expected_range"].startswith(f"{low:.1f} - ")
    five = ledger(spark, [(i, "success", 5, 100) for i in range(4)] + [(5, "success", 60, 100)])
    assert runs.duration_outliers(five).count() == 0
    assert runs.duration_outliers(ledger(spark, [(1, "success", 1, 1), (2, "success", 100, 1)])).count() == 0
    assert runs.record_outliers(six).count() == 0


def test_record_outlier_range_is_not_negative(spark):
    frame = ledger(spark, [(i, "success", 5, 1) for i in range(9)] + [(9, "success", 5, 1000)])
    (found,) = runs.record_outliers(frame).collect()
    assert found["job_id"] == 9 and found["expected_low"] == 0.0 and found["expected_range"].startswith("0 - ")


def test_failure_rate(spark):
    frame = ledger(spark, [(1, "success", 1, 1), (2, "success", 1, 1)] + [(i, "failure", 1, 0) for i in (3, 4, 5)])
    (found,) = runs.failure_rates(frame).collect()
    assert (found["value"], found["threshold"]) == (0.6, 0.3)
    assert runs.failure_rates(ledger(spark, [(1, "running", None, 0)])).count() == 0
    kinds = [r["type"] for r in runs.run_report(frame, 100).anomalies.collect()]
    assert kinds == ["high_failure_rate"]


def test_compare(spark):
    frame = ledger(spark, [(1, "success", 5, 100), (2, "success", 6, 150), (3, "running", None, 0)])
    assert rows(runs.compare_runs(frame, 1, 2)) == [(1, 2, 50, 60.0)]
    assert rows(runs.compare_runs(frame, 2, 1)) == [(2, 1, -50, -60.0)]
    assert rows(runs.compare_runs(frame, 1, 3)) == [(1, 3, -100, None)]
    for first, second in ((1, 99), (1, 1), (98, 99)):
        with pytest.raises(Exception, match="One or both runs not found"):
            runs.compare_runs(frame, first, second).collect()


def test_statistics(spark):
    frame = ledger(spark, [(i, "success", 5, 100) for i in range(4)])
    assert rows(runs.run_statistics(frame)) == [(4, 4, 0, 1.0, 300.0, 100.0)]
    only_running = ledger(spark, [(1, "running", None, 0)])
    assert rows(runs.run_statistics(only_running)) == [(1, 0, 0, 0.0, None, 0.0)]
    assert rows(runs.run_statistics(frame.limit(0)))[0][0] == 0


def test_history_health_and_checkpoints(spark):
    frame = ledger(spark, [(1, "success", 5, 1), (2, "failure", 5, 0), (3, "success", 5, 2)])
    assert [r["id"] for r in runs.run_history(frame, 2).collect()] == [3, 2]
    assert [r["id"] for r in runs.run_history(frame, 5, status="failure").collect()] == [2]
    with pytest.raises(ValueError):
        runs.run_history(frame, 101)
    assert runs.health(frame).first()["status"] == "healthy"
    assert runs.health(frame.where("id < 3")).first()["status"] == "degraded"
    assert rows(runs.health(frame.limit(0)).select("status", "last_run_status")) == [("healthy", None)]
    assert rows(runs.latest_checkpoint(frame)) == [("csv", T0 + timedelta(hours=3))]
    empty_run = spark.createDataFrame([(4, "csv", "success", None, 0, T0, T0 + timedelta(days=1), None, None, 1)], LEDGER)
    both = frame.unionByName(empty_run)
    assert rows(runs.latest_checkpoint(both)) == [("csv", None)]
    assert rows(runs.carried_checkpoint(both, "csv")) == [("csv", T0 + timedelta(hours=3))]
    unfinished = spark.createDataFrame([(5, "csv", "success", T0, 0, T0, None, None, None, 1)], LEDGER)
    assert rows(runs.latest_checkpoint(both.unionByName(unfinished))) == [("csv", T0)]


def test_metrics_text(spark, folder):
    frame = ledger(spark, [(1, "success", 5, 1), (2, "failure", 1, 0), (3, "success", 2, 2), (4, "running", None, 0)])
    path = folder()
    runs.write_metrics(frame, path)
    assert [r[0] for r in spark.read.text(path).collect()] == [
        "# HELP etl_runs_total Total number of ETL runs",
        "# TYPE etl_runs_total counter",
        'etl_runs_total{source="csv",status="failure"} 1',
        'etl_runs_total{source="csv",status="success"} 2',
        "",
        "# HELP etl_last_duration_seconds Duration of last ETL run in seconds",
        "# TYPE etl_last_duration_seconds gauge",
        'etl_last_duration_seconds{source="csv"} 120.000',
    ]


QUOTES = "symbol string, price_usd decimal(20,8), source string, timestamp timestamp, coin_id long"


def test_symbol_stats_and_overview(spark):
    from decimal import Decimal

    frame = spark.createDataFrame(
        [("BTC", Decimal(10), "b", T0, 1), ("BTC", Decimal(20), "a", T0 + timedelta(1), 1), ("BTC", None, "a", T0, 1),
         ("NIL", None, "a", T0, 2)],
        QUOTES,
    )
    got = {r["symbol"]: r for r in quotes.symbol_stats(frame).collect()}
    assert tuple(got["BTC"])[1:] == (3, 15.0, 20.0, 10.0, ["a", "b"])
    assert tuple(got["NIL"])[1:] == (1, 0.0, 0.0, 0.0, ["a"])
    assert rows(quotes.overview(frame)) == [(4, 2, T0 + timedelta(1))]
    assert rows(quotes.overview(frame.limit(0))) == [(0, 0, None)]
    assert quotes.filter_quotes(frame, symbol="btc", source="a").count() == 2
    assert [r["timestamp"] for r in quotes.page(frame, ["symbol"], 2).collect()] == [T0 + timedelta(1), T0]
    for bad in ({"limit": 0}, {"limit": 501}, {"offset": -1}):
        with pytest.raises(ValueError):
            quotes.page(frame, ["symbol"], **bad)


def test_time_range_with_and_without_day_column(spark):
    times = [T0 + timedelta(hours=12 * i) for i in range(6)]
    frame = spark.createDataFrame([(t,) for t in times], "timestamp timestamp")
    dated = frame.withColumn("event_date", F.to_date("timestamp"))
    for table in (frame, dated):
        for start, end in ((times[1], times[3]), ("2024-01-16 00:00:00", "2024-01-17 00:00:00")):
            assert rows(quotes.filter_quotes(table, start=start, end=end).select("timestamp")) == [(t,) for t in times[1:4]]
    plan = quotes.filter_quotes(dated, start=times[1])._jdf.queryExecution().optimizedPlan().toString()
    assert "event_date" in plan or "to_date" in plan or "cast(timestamp" in plan


@pytest.mark.parametrize("offset", [0, 3, 40, 41, 75, 98, 140, 200])
def test_deep_pages_equal_direct_pages(spark, monkeypatch, offset):
    import random

    rng = random.Random(offset)
    times = [rng.choice([None, T0, T0 + timedelta(seconds=rng.randint(0, 200_000)), T0 + timedelta(days=3)]) for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(times)), "k int, timestamp timestamp").repartition(4)
    frame = frame.withColumn("event_date", F.to_date("timestamp")) if offset % 2 else frame
    newest_first = sorted(range(150), key=lambda i: (times[i] is not None, -times[i].timestamp() if times[i] else 0, i))
    monkeypatch.setattr(quotes, "DIRECT_ROWS", 10)
    got = [r["k"] for r in quotes.page(frame, ["k"], 20, offset).collect()]
    assert got == newest_first[offset : offset + 20]


@pytest.mark.parametrize("dated", [False, True])
def test_pages_follow_each_other_by_their_last_rows(spark, dated):
    import random

    rng = random.Random(3)
    times = [rng.choice([None, T0, T0, T0 + timedelta(seconds=rng.randint(0, 9)), T0 + timedelta(days=3)]) for _ in range(60)]
    keys = [(i % 7 if i % 5 else None, i) for i in range(60)]
    frame = spark.createDataFrame([(*k, t) for k, t in zip(keys, times)], "a int, b int, timestamp timestamp").repartition(4)
    frame = frame.withColumn("event_date", F.to_date("timestamp")) if dated else frame
    order = sorted(range(60), key=lambda i: (times[i] is not None, -times[i].timestamp() if times[i] else 0, keys[i][0] is not None, keys[i][0] or 0, i))
    page, got = quotes.page(frame, ["a", "b"], 13).collect(), []
    while page:
        got += [r["b"] for r in page]
        page = quotes.page_after(frame, ["a", "b"], page[-1], 13).collect()
    assert got == order


def test_upsert_matches_the_model(spark):
    import random

    rng = random.Random(5)

    def make(n, base):
        return [
            {"coin_id": rng.randint(1, 9), "source": rng.choice("ab"), "timestamp": T0 + timedelta(hours=rng.randint(0, 5)),
             "symbol": f"S{base + i}", "price_usd": rng.choice([None, float(i)]), "market_cap": float(i),
             "volume_24h": None, "ingested_at": T0 + timedelta(seconds=base + i), "arrival": i}
            for i in range(n)
        ]

    kind = "coin_id long, source string, timestamp timestamp, symbol string, price_usd double, market_cap double, volume_24h double, ingested_at timestamp, arrival long"
    keys, updates = ["coin_id", "source", "timestamp"], ["price_usd", "market_cap", "volume_24h", "ingested_at"]
    target = list({tuple(r[k] for k in keys): r for r in make(60, 0)}.values())
    batch = make(80, 1000)
    t = spark.createDataFrame([tuple(r.values()) for r in target], kind).drop("arrival")
    b = spark.createDataFrame([tuple(r.values()) for r in batch], kind).repartition(5)
    last = merge.last_per_key(b, keys).drop("arrival")
    got = {tuple(r[k] for k in keys): r.asDict() for r in merge.merge_rows(t, last).collect()}
    want = upsert(target, batch, keys, updates)
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key] == {c: row[c] for c in got[key]}
    counts = merge.merge_counts(t, last).first()
    assert counts["rows_affected"] == len({tuple(r[k] for k in keys) for r in batch})
    report = merge.dedup_report(b, keys, ["source"]).collect()
    assert sum(r["rows_dropped"] for r in report) == len(batch) - counts["rows_affected"]


def test_insert_ignore(spark):
    target = spark.createDataFrame([(1, "old")], "k long, v string")
    new = spark.createDataFrame([(1, "x", 1), (2, "second", 2), (2, "first", 1)], "k long, v string, arrival long")
    assert rows(merge.insert_ignore(target, new, ["k"], "arrival")) == [(1, "old"), (2, "first")]


def brief(frame):
    return [(r["drift_type"], r["severity"]) for r in frame.collect()]


def test_schema_drift(spark):
    assert brief(drift.check_schema(spark, ["col1", "col2x"], ["col1"])) == [("schema_missing", "critical")]
    (extra,) = drift.check_schema(spark, ["symbol", "price"], ["symbol", "price", "new_field", "another_new"]).collect()
    assert (extra["drift_type"], extra["severity"]) == ("schema_extra", "info")
    assert json.loads(extra["details"]) == {"extra_columns": ["another_new", "new_field"]}
    found = {r["drift_type"]: r for r in drift.check_schema(spark, ["id", "quotes"], ["id", "quote"]).collect()}
    details = json.loads(found["schema_rename"]["details"])
    assert details == {"expected_column": "quotes", "matched_column": "quote", "similarity_score": 0.909}
    assert found["schema_extra"]["confidence"] == 1.0
    assert drift.check_schema(spark, ["a"], ["a"]).count() == 0


@pytest.mark.parametrize(
    ("filled", "severity"), [(1, "critical"), (5, "warning"), (7, "warning"), (8, "info"), (9, None), (10, None)]
)
def test_null_severity(spark, filled, severity):
    frame = spark.createDataFrame([(1.0 if i < filled else None, float("nan") if i >= filled else 1.0) for i in range(10)], "a double, b double")
    found = drift.null_drift(drift.null_counts(frame)).collect()
    assert [(r["column"], r["severity"]) for r in found] == ([("a", severity), ("b", severity)] if severity else [])
    if severity:
        details = json.loads(found[0]["details"])
        assert details == {"column": "a", "null_ratio": (10 - filled) / 10, "threshold": 0.1, "row_count": 10, "null_count": 10 - filled}


def test_json_and_columnar_drift_agree(spark):
    data = [("x", 1, None), ("y", None, None), ("z", 3, 4)]
    frame = spark.createDataFrame(data, "id string, a int, b int")
    texts = [json.dumps({k: v for k, v in zip(("id", "a", "b"), row)}) for row in data]
    payloads = spark.createDataFrame([(t,) for t in texts], "payload string")
    assert rows(drift.null_counts(frame)) == rows(drift.json_null_counts(payloads))
    expected = ["id", "price"]
    assert rows(drift.detect(frame, expected)) == rows(drift.detect_json(payloads, expected))
    assert drift.has_critical(drift.detect(frame, expected))
    assert not drift.has_critical(drift.detect(frame.select("id"), ["id"]))


def test_types_and_summary(spark):
    frame = spark.createDataFrame([(1, "x")], "a long, b string")
    found = drift.check_types(frame, {"a": "string", "b": "STR", "c": "int"}).collect()
    assert [(r["drift_type"], r["message"]) for r in found] == [
        ("type_change", "Column 'a' type changed from 'string' to 'bigint'")
    ]
    assert drift.check_types(frame, None).count() == 0
    log = drift.detect(frame, ["a", "zz"], T0)
    assert rows(drift.drift_summary(log).select("level", "label", "issues")) == [
        ("severity", "critical", 1), ("severity", "info", 1), ("total", "all", 2), ("type", "schema_extra", 1),
        ("type", "schema_missing", 1),
    ]


@pytest.mark.parametrize("n", [999, 1001, 2500])
def test_any_number_of_json_keys_gives_the_same_rows(spark, n):
    rows_in = [('{"id_%05d":1,"pricee":2,"symbol":3}' % i,) for i in range(n)]
    payloads = spark.createDataFrame(rows_in, "payload string")
    found = drift.detect_json(payloads, ["symbol", "price", "volume_total"], T0).where("drift_type <> 'quality_nulls'")
    keys = sorted([f"id_{i:05d}" for i in range(n)] + ["pricee", "symbol"])
    assert rows(found) == rows(drift.check_schema(spark, ["symbol", "price", "volume_total"], keys, T0))
    details = {r["drift_type"]: json.loads(r["details"]) for r in found.collect()}
    assert details["schema_missing"] == {"missing_column": "volume_total", "available_columns": keys}
    assert details["schema_extra"] == {"extra_columns": [k for k in keys if k != "symbol"]}
    assert details["schema_rename"]["matched_column"] == "pricee"


def test_the_closest_of_all_keys_is_found_across_tasks(spark):
    names = ["prices", "xprice", "pricex", "price_", "é" * 5, "pri\tce"]
    payloads = spark.createDataFrame([(json.dumps({n: 1}),) for n in names * 3], "payload string").repartition(7)
    found = rows(drift.detect_json(payloads, ["price"], T0).where("drift_type like 'schema%'"))
    assert found == rows(drift.check_schema(spark, ["price"], names, T0))


def test_deep_page_among_tied_times(spark):
    rows_in = spark.range(20_000).select(F.col("id"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"))
    page = quotes.page(rows_in.repartition(7), ["id"], limit=5, offset=12_345)
    assert [r["id"] for r in page.collect()] == list(range(12_345, 12_350))
    assert "TakeOrderedAndProject(limit=1" not in page._jdf.queryExecution().toString()
    assert quotes.page(rows_in, ["id"], limit=5, offset=30_000).collect() == []
