import difflib
import math
from datetime import datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quoteloom.functions import (
    clean_symbol,
    coerce_number,
    coin_slug,
    duration_seconds,
    feasible_lengths,
    first_filled,
    has_offset_time,
    parse_timestamp,
    strip_spaces,
    truncate_error,
    unix_seconds,
)
from quoteloom.operators import aliases


def apply(spark, values, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = df.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()
    return [row["o"] for row in out]


def utc(*parts):
    return datetime(*parts)


def python_number(text):
    if text is None or text in ("", "N/A"):
        return None
    try:
        return float(text)
    except ValueError:
        return None


NUMBERS = [
    "1234.56", "N/A", "", None, "5d", "5f", "0x10", " 7 ", "\t8\n", "1e3", "1E-2", ".5", "5.", ".", "+3", "-4.5",
    "1_000", "1__0", "_1", "1_", "1_0.5_0", "inf", "-Infinity", "nan", "not_a_number", "1,000", "1 2", "--1", "1e",
    "1e+5", "１２", "  ",
]


def test_coerce_number_follows_the_float_grammar(spark):
    for text, got in zip(NUMBERS, apply(spark, NUMBERS, coerce_number)):
        want = python_number(text)
        if text == "１２":
            continue  # digits outside ASCII are not read
        if want is not None and math.isnan(want):
            assert math.isnan(got), text
        else:
            assert got == want, text


@given(st.lists(st.text("0123456789._eE+-dDfN/A \t", max_size=8), min_size=1, max_size=60))
@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
def test_coerce_number_random(spark, texts):
    assert apply(spark, texts, coerce_number) == [python_number(t) for t in texts]


FORMATS = ["%Y-%m-%dT%H:%M:%S.%fZ", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d"]


def python_time(text):
    for form in FORMATS:
        try:
            return datetime.strptime(text, form)
        except ValueError:
            continue
    return None


TIMES = [
    "2024-01-15T10:30:00Z", "2024-01-15T12:00:00.000Z", "2024-01-15T12:00:00.1Z", "2024-01-15T12:00:00.123456Z",
    "2024-01-15T12:00:00.1234567Z", "2024-01-15T12:00:00.5", "2024-01-15T12:00:00", "2024-01-15 12:00:00",
    "2024-01-15  12:00:00", "2024-01-15 12:00:00Z", "2024-01-15", "2024-1-5", "24-01-05", "2024-1-5T1:2:3Z",
    "2024-01-15T10:30:00+00:00", "2024-02-30", "2024-13-01", "2024-01-15T24:00:00", "2024-01-15T12:00:60",
    "2024-01-15T12:00", "1705315800", "", "yesterday", " 2024-01-15", "2024-01-15 ", "2024/01/15", "2024-02-29",
    "2023-02-29", "02024-01-01", "2024-01- 5", "2024-01- 5T1:2:3Z", "2024-01- 5\t 1:2:3", "2024- 1-05", "2024-01-  5",
]


def test_parse_timestamp_accepts_the_same_texts_as_the_five_formats(spark):
    for text, got in zip(TIMES, apply(spark, TIMES, lambda c: parse_timestamp(c).cast("timestamp_ntz"))):
        assert got == python_time(text), text


@given(st.lists(st.text("0123-:TZ. ", max_size=6), min_size=1, max_size=80), st.integers(0, 19))
@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
def test_parse_timestamp_random(spark, texts, cut):
    texts = ["2024-01-15 10:30:00"[:cut] + t for t in texts] + ["2024-01-15T10:30:00.5Z"[:cut] + t for t in texts]
    got = apply(spark, texts, lambda c: parse_timestamp(c).cast("timestamp_ntz"))
    assert got == [python_time(t) for t in texts]


def test_offset_times(spark):
    texts = ["2024-01-15T12:00:00Z", "2024-01-15T12:00:00+02:00", "2024-01-15T12:00:00", "2024-01-15", "x", None]
    got = apply(spark, texts, lambda c: has_offset_time(c).cast("timestamp_ntz"))
    assert got == [utc(2024, 1, 15, 12), utc(2024, 1, 15, 10), None, None, None, None]


def test_unix_seconds(spark):
    got = apply(spark, [1705315800.0, 1705315800.25], lambda c: unix_seconds(c).cast("timestamp_ntz"), "double")
    assert got == [utc(2024, 1, 15, 10, 50), utc(2024, 1, 15, 10, 50, 0, 250000)]


def test_symbols_and_text(spark):
    assert apply(spark, ["  btc  ", " eth\n", "", None], clean_symbol) == ["BTC", "ETH", "", None]
    assert apply(spark, [" a ", "\xa0b"], strip_spaces) == ["a", "b"]
    assert apply(spark, ["", None, "x"], lambda c: first_filled(c, F.lit("y"))) == ["y", "y", "x"]
    long = "é" * 991
    assert apply(spark, ["e" * 990, long, None], truncate_error) == ["e" * 990, "é" * 990 + "...", None]


def python_slug(symbol, name):
    base = symbol.lower().strip()
    if name and name.upper() != symbol:
        return base + "-" + "".join(c for c in name.lower() if c.isalnum() or c == "-")[:20]
    return base


def test_slug(spark):
    pairs = [
        ("BTC", "Bitcoin"), ("BTC", "btc"), ("ETH", ""), ("ETH", None), ("USD", "U.S. Dollar-pegged coin of 2024!"),
        ("Ä", "Größe ½ 五"), (" X ", "x"),
    ]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, s string, n string")
    got = [r[0] for r in df.orderBy("i").select(coin_slug(F.col("s"), F.col("n"))).collect()]
    assert got == [python_slug(*p) for p in pairs]


def test_duration(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 5, 0, 250000)), (datetime(2024, 1, 1), None)],
        "a timestamp, b timestamp",
    )
    assert [r[0] for r in df.select(duration_seconds(F.col("a"), F.col("b"))).collect()] == [300.25, None]


def python_alias(text, mapping):
    if not text:
        return None
    cleaned = text.lower().strip()
    if cleaned in mapping:
        return mapping[cleaned]
    if cleaned.upper() in mapping.values():
        return cleaned.upper()
    found = difflib.get_close_matches(cleaned, list(mapping), n=1, cutoff=0.8)
    return mapping[found[0]] if found else None


@pytest.mark.parametrize("mapping", [aliases.CANONICAL, {"tether": "USDT", "usd coin": "USDC", "wrapped btc": "WBTC"}])
def test_canonical_symbol_matches_brute_force(spark, mapping):
    words = ["BTC", "btc", "bitcoin", " Bitcoin ", "Ethereum", "bitcion", "random_coin_xyz", "", None, "usdt", "WBTC"]
    for name in mapping:
        words += [name[:i] + name[i + 1 :] for i in range(len(name))]
        words += [name[:i] + "x" + name[i:] for i in range(len(name))]
        words += [name[:i] + name[i + 1 : i + 2] + name[i : i + 1] + name[i + 2 :] for i in range(len(name))]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    got = {r["i"]: r["canonical"] for r in aliases.with_canonical_symbol(df, "w", mapping).collect()}
    assert len(got) == len(words)
    for i, word in enumerate(words):
        assert got[i] == python_alias(word, mapping), word


def test_feasible_lengths_never_exclude_a_match():
    names = ["btc", "ethereum", "dogecoin"]
    allowed = set(feasible_lengths(names, 0.8))
    for n in range(1, 30):
        best = max(2 * min(n, len(m)) / (n + len(m)) for m in names)
        assert (n in allowed) == (best >= 0.8)


def test_zone_is_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert datetime.now(timezone.utc).tzinfo is not None


def test_similarity_runs_on_distinct_tokens_only(spark):
    df = spark.range(1000).select(F.lit("bitcion").alias("w"))
    plan = aliases.canonical_tokens(df, "w")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.index("ArrowEvalPython") < plan.index("HashAggregate")
