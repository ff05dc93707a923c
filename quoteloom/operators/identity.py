"""Resolution of source-specific asset ids to canonical coins, as joins and grouped aggregates.

Row-by-row, an unknown (source, source_id) is linked to the coin that has its symbol, and a coin is
created when there is none; later rows then see that coin. The same result follows from two
"first row" aggregates: coins are created only by first rows of unmapped source ids, so the first
such row per symbol decides the coin, and every other unmapped id of that symbol links to it.

The fact rows are aggregated once, to one row per (source, symbol); hot symbols shrink to one row
per task before the shuffle. All later steps work on that small key frame.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import coin_slug, first_filled
from ..workspace import materialize
from .ids import with_dense_ids


def source_id_map(raw: DataFrame) -> DataFrame:
    """(source, symbol) -> source_id, the last feed row wins.

    ``raw`` has source, raw_symbol, raw_id and arrival. The symbol is only upper-cased, as the feed
    wrote it; rows without an id or symbol are left out.
    """
    keyed = raw.select("source", F.upper("raw_symbol").alias("symbol"), "raw_id", "arrival")
    usable = keyed.where("raw_id <> '' AND symbol <> ''")
    # Symbol first: the aggregate sorts, and rows of one batch have one source.
    ids = usable.groupBy("symbol", "source").agg(F.max_by("raw_id", "arrival").alias("source_id"))
    return ids.select("source", "symbol", "source_id")


def attach_source_ids(records: DataFrame, id_map: DataFrame) -> DataFrame:
    """Replace each record's ``source_id`` by the mapped id of its symbol, else by the symbol."""
    return _with_source_ids(records, materialize(id_map, "source_id_map"))


def _with_source_ids(records: DataFrame, id_map: DataFrame) -> DataFrame:
    mapped = id_map.select("source", "symbol", F.col("source_id").alias("_mapped"))
    return records.join(mapped, ["source", "symbol"], "left").select(
        *[c for c in records.columns if c != "source_id"],
        first_filled(F.col("_mapped"), F.col("symbol")).alias("source_id"),
    )


@dataclass
class Resolution:
    """``keys`` maps (source, symbol[, source_id]) to coin_id; the others are rows to append.

    ``links`` is false when every id was mapped already, ``creates`` when no coin is new; the frames
    are empty then.
    """

    all_keys: DataFrame
    new_coins: DataFrame
    new_mappings: DataFrame
    key_columns: tuple[str, ...]
    links: bool
    creates: bool

    @cached_property
    def keys(self) -> DataFrame:
        """Written out on first use, so that its size decides how it is joined."""
        return materialize(self.all_keys, "resolved_keys")

    def attach(self, records: DataFrame) -> DataFrame:
        """Add coin_id to the records. Keys are unique, so the row count stays the same."""
        if "source_id" in self.key_columns:
            records = records.withColumn("_sid", first_filled(F.col("source_id"), F.col("symbol")))
            keys = self.keys.withColumnRenamed("source_id", "_sid")
            return records.join(keys, ["source", "symbol", "_sid"], "left").drop("_sid")
        return records.join(self.keys, ["source", "symbol"], "left")


def _coins_by_symbol(coins: DataFrame) -> DataFrame:
    """_symbol, the smallest id of its coins and their number."""
    return coins.groupBy(F.col("symbol").alias("_symbol")).agg(F.min("coin_id").alias("_id"), F.count("*").alias("_n"))


def _only_id() -> Column:
    """The id of the coin that was found by its symbol; several coins are an error."""
    ambiguous = F.raise_error(F.concat(F.lit("several coins have the symbol "), F.col("_symbol")))
    return F.when(F.col("_n") > 1, ambiguous.cast("long")).otherwise(F.col("_id"))


def _max_id(coins: DataFrame) -> int:
    return coins.agg(F.coalesce(F.max("coin_id"), F.lit(0).cast("long"))).first()[0]


def resolve_entities(
    records: DataFrame,
    coins: DataFrame,
    mappings: DataFrame,
    raw: DataFrame | None = None,
    use_record_source_id: bool = False,
    run_ts: Column | None = None,
) -> Resolution:
    """Resolve every record to a coin.

    ``records`` has source, symbol, source_id, name and a unique, orderable ``arrival``. By default
    the source id comes from ``raw`` by symbol (see ``source_id_map``); with
    ``use_record_source_id`` each record's own id is used, so assets that share a symbol within a
    source keep separate mappings.
    """
    first_row = F.min_by(F.struct("name", "arrival"), "arrival").alias("_first")
    if use_record_source_id:
        sid = first_filled(F.col("source_id"), F.col("symbol"))
        keys = records.groupBy("symbol", sid.alias("sid"), "source").agg(first_row)
        key_columns: tuple[str, ...] = ("source", "symbol", "source_id")
    else:
        keys = records.groupBy("symbol", "source").agg(first_row)  # symbol first, as in source_id_map
        id_map = source_id_map(raw) if raw is not None else None
        if id_map is None:
            keys = keys.withColumn("sid", F.col("symbol"))
        else:
            keys = _with_source_ids(keys.withColumn("source_id", F.lit(None).cast("string")), id_map)
            keys = keys.withColumnRenamed("source_id", "sid")
        key_columns = ("source", "symbol")
    keys = materialize(
        keys.select("source", "symbol", "sid", "_first.name", "_first.arrival"), "entity_keys"
    )

    # One pass: the first row per source id, with its mapped coin, or else the existing coin of its symbol.
    firsts = keys.groupBy("source", "sid").agg(
        F.min_by(F.struct("symbol", "name", "arrival"), "arrival").alias("_row")
    )
    mapped = mappings.select(
        "source", F.col("source_id").alias("sid"), F.col("coin_id").alias("mapped_id")
    )
    # Only coins with the batch's symbols are grouped.
    wanted = keys.select(F.col("symbol").alias("_wanted")).distinct()
    by_symbol = _coins_by_symbol(coins.join(wanted, F.col("symbol") == F.col("_wanted"), "left_semi"))
    looked_up = (
        firsts.select("source", "sid", "_row.*")
        .join(mapped, ["source", "sid"], "left")
        .join(by_symbol, F.col("symbol") == F.col("_symbol"), "left")
    )
    # A shared symbol fails only where it is used, in a row without a mapping.
    symbol_id = F.when(F.col("mapped_id").isNull(), _only_id()).alias("symbol_id")
    looked_up = looked_up.select("source", "sid", "symbol", "name", "arrival", "mapped_id", symbol_id)
    found = Observation("entities")
    unmapped = F.col("mapped_id").isNull()
    looked_up = looked_up.observe(
        found,
        F.count_if(unmapped).alias("unmapped"),
        F.count_if(unmapped & F.col("symbol_id").isNull()).alias("unknown"),
    )
    known = materialize(looked_up, "entity_first_rows")
    links, creates = found.get["unmapped"] > 0, found.get["unknown"] > 0
    missing = known.where("mapped_id IS NULL AND symbol_id IS NULL")
    creators = missing.groupBy("symbol").agg(
        F.min_by(F.struct("source", "sid", "name", "arrival"), "arrival").alias("_row")
    ).select("symbol", "_row.*")
    if creates:
        created = with_dense_ids(creators, ["arrival"], "coin_id", _max_id(coins))
    else:
        created = creators.limit(0).withColumn("coin_id", F.lit(0).cast("long"))
    coin_name = first_filled(F.col("name"), F.col("symbol"))
    created = created.withColumn("name", coin_name)
    now = run_ts if run_ts is not None else F.lit(None).cast("timestamp")
    new_coins = created.select(
        "coin_id",
        "symbol",
        "name",
        coin_slug(F.col("symbol"), F.col("name")).alias("slug"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )

    creator = created.select(
        "symbol",
        F.col("coin_id").alias("created_id"),
        F.col("name").alias("created_name"),
        F.struct("source", "sid").alias("creator"),
    )
    resolved = known.join(creator, "symbol", "left").select(
        "source",
        "sid",
        "symbol",
        "mapped_id",
        F.coalesce("mapped_id", "symbol_id", "created_id").alias("coin_id"),
        F.when(F.col("creator") == F.struct("source", "sid"), F.col("created_name"))
        .otherwise(F.col("name"))
        .alias("name"),
    )
    new_mappings = resolved.where("mapped_id IS NULL").select(
        "coin_id",
        "source",
        F.col("sid").alias("source_id"),
        F.col("symbol").alias("source_symbol"),
        F.col("name").alias("source_name"),
        now.alias("created_at"),
    )
    by_key = keys.select("source", "symbol", "sid").join(
        resolved.select("source", "sid", "coin_id"), ["source", "sid"], "left"
    )
    by_key = by_key.withColumnRenamed("sid", "source_id").select(*key_columns, "coin_id")
    return Resolution(by_key, new_coins, new_mappings, key_columns, links, creates)


def resolve_by_symbol(
    records: DataFrame, coins: DataFrame, mappings: DataFrame, run_ts: Column | None = None
) -> Resolution:
    """Symbol-only resolution for feeds without ids: the symbol is the source id.

    The coin of the symbol wins over an existing mapping of that id, which stays as it is. A created
    coin is named after its symbol; links to an existing coin carry no name.
    """
    nameless = records.select(
        "source", "symbol", F.col("symbol").alias("source_id"), F.lit(None).cast("string").alias("name"), "arrival"
    )
    found = resolve_entities(nameless, coins, mappings.limit(0), use_record_source_id=True, run_ts=run_ts)
    fresh = found.new_mappings.join(
        mappings.select("source", "source_id"), ["source", "source_id"], "left_anti"
    )
    return Resolution(
        found.all_keys,
        found.new_coins,
        fresh.select(*found.new_mappings.columns),
        found.key_columns,
        found.links,
        found.creates,
    )


def lookup_coin_ids(records: DataFrame, coins: DataFrame) -> DataFrame:
    """coin_id per record by upper-cased symbol, null when unknown; creates nothing."""
    # Written out, so that its size decides how it is joined with the records.
    by_symbol = materialize(_coins_by_symbol(coins), "coins_by_symbol")
    joined = records.withColumn("_lookup", F.upper(F.col("symbol"))).join(by_symbol, F.col("_lookup") == F.col("_symbol"), "left")
    return joined.withColumn("coin_id", _only_id()).drop("_lookup", "_symbol", "_id", "_n")
