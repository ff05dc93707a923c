"""Read side of the quote table: listings and statistics."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .ids import with_dense_ids

DEFAULT_PAGE, MAX_PAGE = 50, 500
DIRECT_ROWS = 5_000


def filter_quotes(
    quotes: DataFrame,
    symbol: str | None = None,
    source: str | None = None,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    coin_id: int | None = None,
) -> DataFrame:
    """Optional filters, all of which reach the scan; the symbol argument is upper-cased.

    ``start`` and ``end`` are inclusive.
    """
    if symbol:
        quotes = quotes.where(F.col("symbol") == symbol.upper())
    if source:
        quotes = quotes.where(F.col("source") == source)
    if coin_id is not None:
        quotes = quotes.where(F.col("coin_id") == coin_id)
    kind = quotes.schema["timestamp"].dataType
    dated = "event_date" in quotes.columns
    if start is not None:
        quotes = quotes.where(F.col("timestamp") >= F.lit(start).cast(kind))
        quotes = quotes.where(F.col("event_date") >= F.to_date(F.lit(start))) if dated else quotes
    if end is not None:
        quotes = quotes.where(F.col("timestamp") <= F.lit(end).cast(kind))
        quotes = quotes.where(F.col("event_date") <= F.to_date(F.lit(end))) if dated else quotes
    return quotes


def page(quotes: DataFrame, tie_break: list[str], limit: int = DEFAULT_PAGE, offset: int = 0) -> DataFrame:
    """Newest first. Planned as a top-k, so each task keeps at most offset + limit rows.

    A deep offset is first narrowed to the time range that holds the page, by counting rows per day,
    hour, minute and second, so that the top-k stays small however deep the page lies. Where that many
    rows share a second, those of the second are sorted in ranges and numbered instead.
    """
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    for unit in ("day", "hour", "minute", "second"):
        if offset + limit <= DIRECT_ROWS:
            break
        quotes, offset = _narrow(quotes, unit, offset, limit)
    if offset + limit > DIRECT_ROWS:
        return _placed(quotes, tie_break, limit, offset)
    ordered = quotes.orderBy(F.col("timestamp").desc_nulls_first(), *tie_break)
    return ordered.offset(offset).limit(limit) if offset else ordered.limit(limit)


def page_after(
    quotes: DataFrame, tie_break: list[str], after: Mapping[str, object] | Row, limit: int = DEFAULT_PAGE
) -> DataFrame:
    """The page behind the row ``after`` of the same order: the last one of the page before.

    ``after`` has the row's timestamp and ``tie_break`` columns, which must tell rows apart. However deep the
    page lies, it is one top-k of the rows behind that one: nothing is counted or numbered, and no
    task keeps more than ``limit`` rows.
    """
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE}")
    after = after.asDict() if isinstance(after, Row) else after
    time = F.col("timestamp")
    own = F.struct(*[F.lit(after[name]).cast(quotes.schema[name].dataType).alias(name) for name in tie_break])
    behind = F.struct(*tie_break) > own  # field by field, nulls first, as in a sort
    if after["timestamp"] is None:
        quotes = quotes.where((time.isNull() & behind) | time.isNotNull())
    else:
        limit_time = F.lit(after["timestamp"]).cast(quotes.schema["timestamp"].dataType)
        quotes = quotes.where(time <= limit_time).where((time < limit_time) | behind)  # the first reaches the scan
        if "event_date" in quotes.columns:
            quotes = quotes.where(F.col("event_date") <= F.to_date(limit_time))
    return quotes.orderBy(time.desc_nulls_first(), *tie_break).limit(limit)


def _placed(quotes: DataFrame, tie_break: list[str], limit: int, offset: int) -> DataFrame:
    """A page deep among rows of one second: they are sorted over all tasks and numbered."""
    newest_first = quotes.withColumn("_newest", -F.unix_micros(F.col("timestamp").cast("timestamp")))
    placed = with_dense_ids(newest_first, ["_newest", *tie_break], "_place", -1)
    page_rows = placed.where(F.col("_place").between(offset, offset + limit - 1))
    return page_rows.orderBy("_place").drop("_place", "_newest")


def _narrow(quotes: DataFrame, unit: str, offset: int, limit: int) -> tuple[DataFrame, int]:
    """The rows of the time units that hold the page, and the offset within them.

    One count per unit reaches the driver: all days at first, then only the parts of the units found
    one level above.
    """
    start = F.date_trunc(unit, F.col("timestamp"))
    counts = quotes.groupBy(start.alias("unit")).count().orderBy(F.col("unit").desc_nulls_first()).collect()
    skipped, chosen, held = 0, [], 0
    for begin, rows in counts:
        if not chosen and skipped + rows <= offset:
            skipped += rows
            continue
        chosen.append(begin)
        held += rows
        if skipped + held >= offset + limit:
            break
    if not chosen:
        return quotes.limit(0), 0
    kind = quotes.schema["timestamp"].dataType
    times = [begin for begin in chosen if begin is not None]
    wanted = F.col("timestamp").isNull() if None in chosen else F.lit(False)
    if times:
        low = F.lit(min(times)).cast(kind)
        high = F.lit(max(times)).cast(kind) + F.expr(f"INTERVAL 1 {unit}")
        within = (F.col("timestamp") >= low) & (F.col("timestamp") < high)
        if "event_date" in quotes.columns:
            dates = F.col("event_date").between(F.to_date(low), F.to_date(F.lit(max(times)).cast(kind)))
            within = within & dates
        wanted = (wanted | within) if None in chosen else within
    return quotes.where(wanted), offset - skipped


def count_quotes(quotes: DataFrame, **filters) -> DataFrame:
    return filter_quotes(quotes, **filters).agg(F.count("*").alias("total"))


def overview(quotes: DataFrame) -> DataFrame:
    """Rows, distinct symbols and freshness in one scan."""
    per_symbol = quotes.groupBy("symbol").agg(
        F.count("*").alias("n"), F.max("timestamp").alias("newest")
    )
    return per_symbol.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total_records"),
        F.count("symbol").alias("unique_symbols"),
        F.max("newest").alias("data_freshness"),
    )


def _or_zero(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def symbol_stats(quotes: DataFrame) -> DataFrame:
    """Count, mean, highest and lowest price and the sources per symbol; no price reads as 0.0.

    Aggregated per (symbol, source) first: hash aggregation with map-side partials, which a set
    aggregate over the rows would give up. The second step sees one row per pair.
    """
    per_source = quotes.groupBy("symbol", "source").agg(
        F.count("*").alias("n"),
        F.count("price_usd").alias("priced"),
        F.sum("price_usd").alias("total"),
        F.max("price_usd").alias("top"),
        F.min("price_usd").alias("low"),
    )
    return per_source.groupBy("symbol").agg(
        F.sum("n").alias("record_count"),
        _or_zero(F.try_divide(F.sum("total").cast("double"), F.sum("priced"))).alias("avg_price_usd"),
        _or_zero(F.max("top")).alias("max_price_usd"),
        _or_zero(F.min("low")).alias("min_price_usd"),
        F.sort_array(F.collect_list("source")).alias("sources"),
    )


def latest_timestamp(rows: DataFrame) -> DataFrame:
    """The batch checkpoint: newest time over all normalized rows, before duplicates go."""
    return rows.agg(F.max("timestamp").alias("checkpoint"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """One fact from several sources; columns a source lacks are null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
