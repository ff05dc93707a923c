"""Parsing of JSON feed rows: fields of odd items, and generated code that the JVM compiles."""

import json
import re
from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quoteloom.operators import merge, normalize
from quoteloom.sources import json_feeds

RUN_TS = datetime(2024, 6, 1, tzinfo=timezone.utc)
JIT_BYTES = 8000  # HotSpot interprets longer methods row by row

ODD = [
    '{"id":"a","quotes":{"USD":{"price":1.50}}}', '{"id":null,"quotes":null}', '{"id":7,"quotes":{"USD":null}}',
    '{"id":"a","id":"b","quotes":{"USD":{"price":1},"USD":{"price":"2"}}}', '{"id":{"x":1},"quotes":[{"USD":1}]}',
    '{"ID":"upper","Quotes":{"usd":{"price":1}}}', '[{"id":"a"}]', '"text"', "5", "null", "{}", '{"id":[],"quotes":{}}',
    '{"quotes":{"USD":{"price":{"deep":[1,null]}}},"id":true}', '{"id":"","quotes":{"USD":"x"}}',
]


def test_fields_of_odd_items_are_those_of_their_paths(spark):
    items = spark.createDataFrame([(text, n) for n, text in enumerate(ODD)], "payload string, arrival int")
    raw = items.withColumn("item", F.try_parse_json("payload"))
    paths = {"id": "$.id", "quotes": "$.quotes", "usd": "$.quotes.USD", "price": "$.quotes.USD.price"}
    got = normalize._fields(raw, id=("id",), quotes=("quotes",), usd=("quotes", "USD"), price=("quotes", "USD", "price"))
    columns = []
    for name, path in paths.items():
        columns.append(F.try_variant_get("item", path, "string").alias(name))
        columns.append(F.schema_of_variant(F.try_variant_get("item", path, "variant")).alias(f"{name}_kind"))
    wanted = raw.select("payload", "arrival", *columns)
    assert got.columns == wanted.columns
    assert got.orderBy("arrival").collect() == wanted.orderBy("arrival").collect()


@pytest.mark.parametrize("feed", ["markets", "tickers"])
def test_code_of_a_json_load_is_short_enough_to_be_compiled(spark, folder, capsys, feed):
    path = folder()
    spark.createDataFrame([(json.dumps([{"id": "a"}]),)], "value string").write.text(path)
    pages = json_feeds.read_markets_json(spark, path, "lines")
    parse = normalize.normalize_markets if feed == "markets" else normalize.normalize_tickers
    parse(pages, feed, F.lit(RUN_TS).cast("timestamp")).explain("codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < JIT_BYTES


@pytest.mark.parametrize("feed", ["markets", "tickers"])
def test_a_json_load_goes_through_each_object_once(spark, folder, feed):
    path = folder()
    spark.createDataFrame([(json.dumps([{"id": "a"}]),)], "value string").write.text(path)
    pages = json_feeds.read_markets_json(spark, path, "lines")
    parse = normalize.normalize_markets if feed == "markets" else normalize.normalize_tickers
    plan = parse(pages, feed, RUN_TS)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"variant_get\(item#", plan)) == 1


def test_last_per_key_leaves_the_arrival_out_of_the_row(spark):
    quotes = spark.createDataFrame(
        [(1, None, 5.0, ("f", 1)), (1, None, None, ("f", 2)), (2, "a", 1.0, ("g", 0)), (2, "a", 2.0, ("f", 9))],
        "coin_id long, source string, price double, arrival struct<file: string, position: long>",
    )
    kept = merge.last_per_key(quotes, ["coin_id", "source"])
    bare = merge.last_per_key(quotes, ["coin_id", "source"], keep_arrival=False)
    assert rows(bare) == rows(kept.drop("arrival")) == [(1, None, None), (2, "a", 1.0)]
    row = re.search(r"max_by\(struct\(([^)]*)\)", bare._jdf.queryExecution().optimizedPlan().toString()).group(1)
    assert "price" in row and "arrival" not in row
