import json
import os
from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quoteloom.operators import incremental, normalize
from quoteloom.sources import FeedError, FeedSpec, get_source, list_sources, read_csv_feed, read_markets_json
from quoteloom.sources import read_tickers_json, register_source

RUN_TS = datetime(2024, 6, 1, tzinfo=timezone.utc)
CSV_ROWS = [
    ("BTC", "45000.50", "25000000000", "2024-01-15", "850000000000"),
    ("ETH", "2500.00", "15000000000", "2024-01-15", "300000000000"),
    ("XRP", "0.55", "5000000000", "2024-01-15", "28000000000"),
]
HEADER = ("ticker", "price", "vol", "date", "market_cap")


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def csv_text(sep=",", header=HEADER, body=CSV_ROWS):
    return "\n".join(sep.join(r) for r in [header, *body]) + "\n"


def normalized(spark, path, **options):
    out = normalize.normalize_csv(read_csv_feed(spark, path, **options), "csv", RUN_TS)
    return {r["symbol"]: r for r in out.orderBy("arrival").collect()}


@pytest.mark.parametrize("sep", [",", ";", "\t"])
def test_csv_separators_and_headers(spark, folder, sep):
    header = tuple(f" {name.upper()} " for name in HEADER)
    path = write(folder() + "/a.csv", csv_text(sep, header))
    got = normalized(spark, path)
    assert float(got["BTC"]["price_usd"]) == 45000.5
    assert float(got["XRP"]["market_cap"]) == 28000000000
    assert got["ETH"]["timestamp"] == datetime(2024, 1, 15)
    assert all(r["reject_reason"] is None for r in got.values())


def test_csv_files_may_differ_in_separator_and_columns(spark, folder):
    base = folder()
    write(base + "/a.csv", csv_text(","))
    write(base + "/b.csv", csv_text(";", HEADER[:4], [("SOL", "95.5", "1", "2024-01-16")]))
    got = normalized(spark, base)
    assert set(got) == {"BTC", "ETH", "XRP", "SOL"}
    assert got["SOL"]["market_cap"] is None


def test_csv_extra_columns_only_reach_the_payload(spark, folder):
    body = [(*r, "w", "x") for r in CSV_ROWS]
    got = normalized(spark, write(folder() + "/a.csv", csv_text(",", (*HEADER, "weird_col", "extra_field"), body)))
    assert json.loads(got["BTC"]["payload"]) == {
        "symbol": "BTC", "price_usd": "45000.50", "volume_24h": "25000000000", "timestamp": "2024-01-15",
        "market_cap": "850000000000", "weird_col": "w", "extra_field": "x",
    }


def test_csv_without_usable_columns(spark, folder):
    path = write(folder() + "/a.csv", "random_field,another_field\n1,2\n")
    (row,) = normalize.normalize_csv(read_csv_feed(spark, path), "csv", RUN_TS).collect()
    assert (row["symbol"], row["price_usd"], row["timestamp"]) == ("UNKNOWN", None, datetime(2024, 6, 1))
    assert row["reject_reason"] is None


def test_csv_internal_names(spark, folder):
    text = "symbol,name,price_usd,market_cap_usd,date\nBTC,Bitcoin,50000.0,1,2024-01-15\nETH,,4000.5,2,2024-01-15\n"
    got = normalized(spark, write(folder() + "/a.csv", text))
    assert float(got["BTC"]["price_usd"]) == 50000.0 and got["BTC"]["market_cap"] is None
    assert (got["BTC"]["name"], got["ETH"]["name"]) == ("Bitcoin", "ETH")


def test_mapped_header_wins_over_the_internal_name(spark, folder):
    got = normalized(spark, write(folder() + "/a.csv", "symbol,ticker,price\nAAA,BTC,1\n"))
    assert set(got) == {"BTC"}


def test_csv_bad_values(spark, folder):
    text = "symbol,price,date\nBTC,not_a_number,2024-01-15\nETH,,2024-01-15\nXRP,1,\nSOL,1,soon\n"
    text += "ABCDEFGHIJKLMNOPQRSTU,1,2024-01-15\nBIG,1e30,2024-01-15\n"
    got = normalized(spark, write(folder() + "/a.csv", text))
    assert {s: r["reject_reason"] for s, r in got.items()} == {
        "BTC": None, "ETH": None, "XRP": "bad_timestamp", "SOL": "bad_timestamp",
        "ABCDEFGHIJKLMNOPQRSTU": "symbol_too_long", "BIG": "number_out_of_range",
    }
    assert got["BTC"]["price_usd"] is None


def test_csv_line_breaks_inside_quotes(spark, folder):
    text = 'ticker,price,name\nBTC,1,"two\nlines, ""quoted"""\nETH,2,plain\n'
    path = write(folder() + "/a.csv", text)
    got = normalized(spark, path)
    assert got["BTC"]["name"] == 'two\nlines, "quoted"'
    assert float(got["ETH"]["price_usd"]) == 2


def test_missing_and_shapeless_feeds_fail(spark, folder):
    with pytest.raises(FeedError, match="not found"):
        read_csv_feed(spark, folder() + "/nonexistent.csv")
    with pytest.raises(FeedError, match="not found"):
        read_markets_json(spark, folder() + "/none.json")
    path = write(folder() + "/a.json", '{"id": "x"}')
    with pytest.raises(Exception, match="not a JSON array"):
        read_tickers_json(spark, path).collect()


MARKET = {
    "id": "bitcoin", "symbol": "btc", "name": "Bitcoin", "current_price": 45000.5, "market_cap": 850000000000,
    "total_volume": 25000000000, "last_updated": "2024-01-15T12:00:00.000Z",
}
TICKER = {
    "id": "btc-bitcoin", "name": "Bitcoin", "symbol": "BTC", "rank": 1,
    "quotes": {"USD": {"price": 45000.5, "market_cap": 850000000000, "volume_24h": 25000000000}},
    "last_updated": "2024-01-15T12:00:00Z",
}


def without(base, *names, **changes):
    return {**{k: v for k, v in base.items() if k not in names}, **changes}


def read_items(spark, folder, reader, items, pages="files"):
    path = folder()
    if pages == "files":
        write(path + "/a.json", json.dumps(items, indent=1))
    else:
        write(path + "/a.json", "\n".join(json.dumps([i]) for i in items) + "\n\n")
    return reader(spark, path, pages)


@pytest.mark.parametrize("pages", ["files", "lines"])
def test_markets_feed(spark, folder, pages):
    items = [
        MARKET,
        without(MARKET, "last_updated", symbol=" eth ", roi={"times": 1.5, "list": [1, None]}, ath=None),
        without(MARKET, current_price="12.5", market_cap=None, total_volume=True, last_updated=""),
        without(MARKET, current_price="N/A"),
        without(MARKET, "id"),
        without(MARKET, id=5),
        without(MARKET, symbol=None),
        without(MARKET, name=7),
        without(MARKET, last_updated="2024-01-15T12:00:00+00:00"),
        without(MARKET, last_updated=1705315800),
        without(MARKET, symbol="x" * 21),
        "no object",
    ]
    raw = read_items(spark, folder, read_markets_json, items, pages)
    got = normalize.normalize_markets(raw, run_ts=RUN_TS).orderBy("arrival").collect()
    assert [r["reject_reason"] for r in got] == [
        None, None, None, "bad_number", "bad_id", "bad_id", "bad_symbol", "bad_name", "bad_timestamp",
        "bad_timestamp", "symbol_too_long", "bad_id",
    ]
    assert got[0]["symbol"] == "BTC" and float(got[0]["price_usd"]) == 45000.5
    assert got[0]["timestamp"] == datetime(2024, 1, 15, 12)
    assert got[1]["symbol"] == "ETH" and got[1]["timestamp"] == datetime(2024, 6, 1)
    assert json.loads(got[1]["payload"]) == items[1]
    assert (float(got[2]["price_usd"]), got[2]["market_cap"], float(got[2]["volume_24h"])) == (12.5, None, 1.0)
    assert got[2]["timestamp"] == datetime(2024, 6, 1)


@pytest.mark.parametrize("pages", ["files", "lines"])
def test_tickers_feed(spark, folder, pages):
    items = [
        TICKER,
        without(TICKER, quotes={}),
        without(TICKER, "quotes", "rank"),
        without(TICKER, quotes={"USD": {"price": "N/A", "market_cap": "7"}}),
        without(TICKER, quotes={"EUR": {"price": 1}}),
        without(TICKER, quotes=None),
        without(TICKER, quotes={"USD": None}),
        without(TICKER, quotes=[1]),
        without(TICKER, "name"),
        without(TICKER, rank=1.5),
        without(TICKER, rank="3"),
        without(TICKER, last_updated="never"),
    ]
    raw = read_items(spark, folder, read_tickers_json, items, pages)
    got = normalize.normalize_tickers(raw, run_ts=RUN_TS).orderBy("arrival").collect()
    assert [r["reject_reason"] for r in got] == [
        None, None, None, None, None, "bad_quotes", "bad_quotes", "bad_quotes", "bad_name", "bad_rank", None,
        "bad_timestamp",
    ]
    assert float(got[0]["volume_24h"]) == 25000000000
    assert [r["price_usd"] for r in got[1:5]] == [None] * 4
    assert float(got[3]["market_cap"]) == 7


def test_incremental_json_keeps_unknown_times(spark, folder):
    times = ["2024-01-15T12:00:00Z", "2024-01-15T12:00:01Z", "2024-01-01T00:00:00", "x", "", None,
             "2024-01-15T14:00:00+02:00", "2024-01-15T14:00:00.5+02:00"]
    raw = read_items(spark, folder, read_markets_json, [without(MARKET, id=str(i), last_updated=t) for i, t in enumerate(times)])
    kept = incremental.newer_json(raw, datetime(2024, 1, 15, 12, tzinfo=timezone.utc))
    ids = sorted(int(r[0]) for r in kept.select(normalize.variant_text("item", "id")).collect())
    assert ids == [1, 2, 3, 4, 5, 7]
    assert incremental.newer_json(raw, None).count() == len(times)


def test_incremental_csv(spark, folder):
    text = "ticker,price,date\nA,1,2024-01-15\nB,1,2024-01-16\nC,1,\nD,1,x\nE,1,2024-01-15T00:00:01\n"
    raw = read_csv_feed(spark, write(folder() + "/a.csv", text))
    kept = incremental.newer_csv(raw, datetime(2024, 1, 15, tzinfo=timezone.utc))
    assert sorted(r["ticker"] for r in kept.collect()) == ["B", "C", "D", "E"]


def test_typed_incremental_filter_reaches_the_scan(spark, sf_dir):
    from quoteloom.plans import bindings

    events = bindings.table(spark, sf_dir, "events").select("event_id", "ts")
    plan = incremental.newer_than(events, "ts", "2024-01-20 00:00:00")._jdf.queryExecution().toString()
    assert "Or(GreaterThan(ts,2024-01-20 00:00:00.0),IsNull(ts))" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp>" in plan


def test_registry(spark):
    assert rows(list_sources(spark)) == [("coingecko",), ("coinpaprika",), ("csv",)]
    with pytest.raises(ValueError, match="No extractor registered"):
        get_source("unknown")
    spec = get_source("csv")
    assert isinstance(spec, FeedSpec) and spec.expected_columns == ("ticker", "price", "vol", "date")
    register_source("other_csv", spec)
    assert get_source("other_csv") is spec
    from quoteloom.sources import registry

    del registry._REGISTRY["other_csv"]


def test_large_csv_is_split_and_keeps_file_order(spark, folder):
    path = folder()
    body = [(f"S{i % 7}", str(i), "1", "2024-01-15", "1") for i in range(20000)]
    write(path + "/a.csv", csv_text(",", HEADER, body))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        raw = read_csv_feed(spark, path)
        assert raw.rdd.getNumPartitions() > 4
        last = raw.groupBy("ticker").agg(F.max_by("price", "arrival").alias("p"))
        assert {r["ticker"]: int(r["p"]) for r in last.collect()} == {
            f"S{k}": max(i for i in range(20000) if i % 7 == k) for k in range(7)
        }
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("pages", ["files", "lines"])
def test_every_array_of_a_json_file_is_read(spark, folder, pages):
    path = folder()
    write(path + "/a.json", '[{"id":"a"},{"id":"b","x":"]["}]\n\n[{"id":"c"}]\r\n[]\n')
    got = [json.loads(r.payload)["id"] for r in read_markets_json(spark, path, pages).collect()]
    assert sorted(got) == ["a", "b", "c"]


@pytest.mark.parametrize("pages", ["files", "lines"])
@pytest.mark.parametrize("text", ['[{"id":"a"}][{"id":"b"}]', '[{"id":"a"}] tail', '[{"id":"a"}]]', '[{"id":"a"}],[1]', '[{"id":"a"}]\n{}'])
def test_text_after_a_json_array_fails(spark, folder, pages, text):
    path = folder()
    write(path + "/named.json", text)
    with pytest.raises(Exception, match="named.json"):
        read_tickers_json(spark, path, pages).collect()


def test_cells_beyond_the_csv_header_are_kept(spark, folder):
    path = folder()
    write(path + "/a.csv", 'ticker,price\nBTC,1,extra,"more, still"\nETH,2\nXRP\nADA,3,\n')
    found = normalize.normalize_csv(read_csv_feed(spark, path), run_ts=datetime(2024, 1, 1, tzinfo=timezone.utc)).collect()
    payloads = {r.symbol: json.loads(r.payload) for r in found}
    assert payloads["BTC"]["_overflow"] == 'BTC,1,extra,"more, still"' and payloads["BTC"]["price_usd"] == "1"
    assert all("_overflow" not in payloads[s] for s in ("ETH", "XRP", "ADA"))


def test_only_files_with_line_breaks_in_quotes_are_read_whole(spark, folder):
    path = folder()
    write(path + "/a b.csv", 'ticker,price\n"B\nTC",1\n')
    write(path + "/c.csv", "ticker,price\nETH,2\n")
    found = read_csv_feed(spark, path)
    assert sorted((r.ticker, r.price) for r in found.collect()) == [("B\nTC", "1"), ("ETH", "2")]
    plan = found._jdf.queryExecution().toString()
    assert "Union" in plan


def test_long_csv_header(spark, folder):
    path = folder()
    names = ["ticker", "price", *(f"column_{i:05d}_{'x' * 300}" for i in range(4000))]
    write(path + "/a.csv", ",".join(names) + "\nBTC,1," + ",".join(["0"] * 4000) + "\n")
    assert read_csv_feed(spark, path).columns[:-2] == names
