"""Feed rows to normalized quotes, in one pass, with a reject reason instead of dropped rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    clean_symbol,
    coerce_number,
    first_filled,
    fits_decimal,
    parse_timestamp,
    to_decimal,
)
from ..schemas import AMOUNT, MAX_SYMBOL_LENGTH, OVERFLOW, PRICE

# CSV header names and the internal names they map to.
CSV_COLUMNS = {
    "ticker": "symbol",
    "price": "price_usd",
    "vol": "volume_24h",
    "date": "timestamp",
}

# Columns of a normalized frame. raw_id and raw_symbol are the feed's own identifiers, before
# cleaning; arrival orders the rows. A ``raw`` column of the input is passed through.
NORMALIZED = [
    "source",
    "source_id",
    "name",
    "symbol",
    "price_usd",
    "market_cap",
    "volume_24h",
    "timestamp",
    "raw_id",
    "raw_symbol",
    "payload",
    "arrival",
    "reject_reason",
]


def variant_text(column: str, *keys: str) -> Column:
    """A field of a VARIANT column as text."""
    return F.try_variant_get(F.col(column), "$" + "".join(f".{key}" for key in keys), "string")


def computed_once(df: DataFrame) -> DataFrame:
    """Compute the columns of ``df`` once per row.

    Catalyst would copy their expressions into every filter and expression that uses them; it does
    not do so across a generator.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def _fields(raw: DataFrame, **paths: tuple[str, ...]) -> DataFrame:
    """Text ``<name>`` and JSON type ``<name>_kind`` of each path of the VARIANT column ``item``.

    The type is null for an absent field and VOID for a JSON null. An object is gone through once for all
    of its fields, since a lookup by path compares its keys from the first on; the fields of an object inside
    another need a path to that object too. Unlike a function of the row, the generator is not copied.
    """
    holders = {(): "item", **{keys: name for name, keys in paths.items()}}
    values = raw.select("payload", "arrival", "item")
    for holder in sorted({keys[:-1] for keys in paths.values()}, key=len):
        inside = {name: keys[-1] for name, keys in paths.items() if keys[:-1] == holder}
        kind = T.StructType([T.StructField(key, T.VariantType()) for key in inside.values()]).simpleString()
        found = F.try_variant_get(holders[holder], "$", kind)
        values = values.select("*", F.inline(F.array(found)).alias(*inside))
    columns = []
    for name in paths:
        columns += [variant_text(name).alias(name), F.schema_of_variant(name).alias(f"{name}_kind")]
    return values.select("payload", "arrival", *columns)


def _with_numbers(fields: DataFrame, *names: str) -> DataFrame:
    """Replace the texts of ``names`` by the doubles they stand for."""
    return fields.withColumns({name: _lenient_number(name) for name in names})


def _absent(name: str) -> Column:
    kind = F.col(f"{name}_kind")
    return kind.isNull() | (kind == "VOID")


def _is(name: str, kind: str) -> Column:
    return F.col(f"{name}_kind") == kind


def _is_object(name: str) -> Column:
    return F.col(f"{name}_kind").startswith("OBJECT")


def _is_number(name: str) -> Column:
    return F.col(f"{name}_kind").rlike("^(?:BIGINT|DECIMAL|DOUBLE|FLOAT)")


def _lenient_number(name: str) -> Column:
    """Number, boolean or numeric text to double; everything else is null."""
    return (
        F.when(_is_number(name), F.col(name).try_cast("double"))
        .when(_is(name, "STRING"), coerce_number(F.col(name)))
        .when(_is(name, "BOOLEAN"), F.col(name).try_cast("boolean").cast("double"))
    )


def _strict_number_ok(name: str) -> Column:
    """A strict numeric field accepts null, numbers and numeric text, but no "N/A" or other text."""
    return _absent(name) | F.col(name).isNotNull()


def _optional_text_ok(name: str) -> Column:
    return _absent(name) | _is(name, "STRING")


def _first_reason(*checks: tuple[str, Column]) -> Column:
    """The first reason whose condition is not true; null for a valid row."""
    reasons = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in checks]
    return F.coalesce(*reasons) if reasons else F.lit(None).cast("string")


def _finish(
    fields: DataFrame,
    source: str | Column,
    run_ts: datetime | Column | None,
    time_text: Column,
    time_missing: Column,
    columns: dict[str, Column],
    checks: list[tuple[str, Column]],
) -> DataFrame:
    """Shared tail: default time, decimals, and the checks that hold for every feed.

    ``columns`` has source_id, name, symbol, raw_id, raw_symbol and the doubles price, cap, volume.
    """
    now = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp")
    kept = [c for c in ("payload", "arrival", "raw") if c in fields.columns and c not in columns]
    parsed = computed_once(
        fields.select(
            (source if isinstance(source, Column) else F.lit(source)).alias("source"),
            *[column.alias(name) for name, column in columns.items()],
            F.when(time_missing, now).otherwise(parse_timestamp(time_text)).alias("timestamp"),
            *kept,
            _first_reason(*checks).alias("feed_reason"),
        )
    )
    reason = _first_reason(
        ("bad_timestamp", F.col("timestamp").isNotNull()),
        ("symbol_too_long", F.length("symbol") <= MAX_SYMBOL_LENGTH),
        (
            "number_out_of_range",
            fits_decimal(F.col("price"), PRICE)
            & fits_decimal(F.col("cap"), AMOUNT)
            & fits_decimal(F.col("volume"), AMOUNT),
        ),
    )
    return parsed.select(
        "source",
        "source_id",
        "name",
        "symbol",
        to_decimal(F.col("price"), PRICE).alias("price_usd"),
        to_decimal(F.col("cap"), AMOUNT).alias("market_cap"),
        to_decimal(F.col("volume"), AMOUNT).alias("volume_24h"),
        "timestamp",
        "raw_id",
        "raw_symbol",
        "payload",
        "arrival",
        F.coalesce("feed_reason", reason).alias("reject_reason"),
        *(["raw"] if "raw" in parsed.columns else []),
    )


def renamed_columns(columns: list[str]) -> dict[str, str]:
    """Internal name -> feed column. A mapped header wins over a column that has the internal name."""
    chosen = {name: name for name in columns if name not in CSV_COLUMNS}
    chosen.update({internal: feed for feed, internal in CSV_COLUMNS.items() if feed in columns})
    return chosen


def normalize_csv(raw: DataFrame, source: str | Column = "csv", run_ts: datetime | Column | None = None) -> DataFrame:
    """All-text columns (plus ``arrival``) to normalized quotes.

    A missing symbol column means "UNKNOWN", a missing time column means now; an empty or unreadable
    time rejects the row, an unreadable number becomes null.
    """
    kept = [c for c in ("feed_source", "raw", OVERFLOW) if c in raw.columns]
    chosen = renamed_columns([c for c in raw.columns if c not in ("arrival", *kept)])

    def text(name: str) -> Column:
        return F.col(f"`{chosen[name]}`") if name in chosen else F.lit(None).cast("string")

    raw_symbol = F.coalesce(text("symbol"), F.lit("")) if "symbol" in chosen else F.lit("UNKNOWN")
    cells = [F.col(f"`{feed}`").alias(name) for name, feed in chosen.items()]
    payload = F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})
    if OVERFLOW in raw.columns:  # cells beyond the header show in the payload of their rows only
        longer = F.to_json(F.struct(*cells, F.col(OVERFLOW)), {"ignoreNullFields": "false"})
        payload = F.when(F.col(OVERFLOW).isNotNull(), longer).otherwise(payload)
    columns = {
        "source_id": first_filled(text("id"), raw_symbol),
        "name": first_filled(text("name"), raw_symbol),
        "symbol": clean_symbol(raw_symbol),
        "price": coerce_number(text("price_usd")),
        "cap": coerce_number(text("market_cap")),
        "volume": coerce_number(text("volume_24h")),
        "raw_id": text("symbol"),
        "raw_symbol": text("symbol"),
        "payload": payload,
    }
    no_time = F.lit("timestamp" not in chosen)
    return _finish(raw, source, run_ts, text("timestamp"), no_time, columns, [])


def _json_columns() -> dict[str, Column]:
    return {
        "source_id": F.col("id"),
        "name": F.col("name"),
        "symbol": clean_symbol(F.col("symbol")),
        "price": F.col("price"),
        "cap": F.col("cap"),
        "volume": F.col("volume"),
        "raw_id": F.col("id"),
        "raw_symbol": F.col("symbol"),
    }


def _time_missing() -> Column:
    return F.coalesce(F.col("updated"), F.lit("")) == ""


def normalize_markets(raw: DataFrame, source: str = "coingecko", run_ts: datetime | Column | None = None) -> DataFrame:
    """Markets feed rows to normalized quotes; numbers are strict, so "N/A" rejects the row."""
    fields = _fields(
        raw, id=("id",), symbol=("symbol",), name=("name",), price=("current_price",), cap=("market_cap",),
        volume=("total_volume",), updated=("last_updated",),
    )
    fields = _with_numbers(fields, "price", "cap", "volume")
    checks = [
        ("bad_id", _is("id", "STRING")),
        ("bad_symbol", _is("symbol", "STRING")),
        ("bad_name", _optional_text_ok("name")),
        *[("bad_number", _strict_number_ok(name)) for name in ("price", "cap", "volume")],
        ("bad_timestamp", _optional_text_ok("updated")),
    ]
    return _finish(fields, source, run_ts, F.col("updated"), _time_missing(), _json_columns(), checks)


def normalize_tickers(raw: DataFrame, source: str = "coinpaprika", run_ts: datetime | Column | None = None) -> DataFrame:
    """Tickers feed rows to normalized quotes; prices come from ``quotes.USD`` and may be absent."""
    usd = ("quotes", "USD")
    fields = _fields(
        raw, id=("id",), symbol=("symbol",), name=("name",), rank=("rank",), quotes=("quotes",), usd=usd,
        price=(*usd, "price"), cap=(*usd, "market_cap"), volume=(*usd, "volume_24h"), updated=("last_updated",),
    )
    fields = _with_numbers(fields, "rank", "price", "cap", "volume")
    rank = F.col("rank")
    no_usd = F.col("usd_kind").isNull()
    checks = [
        ("bad_id", _is("id", "STRING")),
        ("bad_name", _is("name", "STRING")),
        ("bad_symbol", _is("symbol", "STRING")),
        ("bad_rank", _absent("rank") | (rank == F.floor(rank))),
        ("bad_quotes", F.col("quotes_kind").isNull() | (_is_object("quotes") & (no_usd | _is_object("usd")))),
        ("bad_timestamp", _optional_text_ok("updated")),
    ]
    return _finish(fields, source, run_ts, F.col("updated"), _time_missing(), _json_columns(), checks)


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.where("reject_reason IS NULL").drop("reject_reason")


def rejected(normalized: DataFrame) -> DataFrame:
    """The quarantine: payload and reason of every invalid row."""
    return normalized.where("reject_reason IS NOT NULL").select("source", "payload", "reject_reason", "arrival")


def reject_counts(normalized: DataFrame) -> DataFrame:
    """Rows per source and reason; valid rows count under "ok"."""
    return normalized.groupBy("source", F.coalesce("reject_reason", F.lit("ok")).alias("reason")).agg(
        F.count("*").alias("n_rows")
    )
