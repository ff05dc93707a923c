"""Backfill of the master tables from quotes that only carry symbols."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize
from .ids import with_dense_ids


def seed_coins(quotes: DataFrame, coins: DataFrame, after: int | None = None) -> DataFrame:
    """New coins for the symbols of ``quotes`` whose slug the master does not have.

    Ids follow the slug order; ``after`` is the highest id in use (looked up when not given).
    """
    slugs = (
        quotes.where("symbol IS NOT NULL")
        .groupBy(F.lower("symbol").alias("slug"))
        .agg(F.min(F.upper("symbol")).alias("symbol"))
        .join(coins.select("slug"), "slug", "left_anti")
    )
    if after is None:
        after = coins.agg(F.coalesce(F.max("coin_id"), F.lit(0).cast("long"))).first()[0]
    return with_dense_ids(slugs, ["slug"], "coin_id", after).select(
        "coin_id", "symbol", F.col("symbol").alias("name"), "slug"
    )


def _coin_of_symbol(coins: DataFrame) -> DataFrame:
    """One coin per case-folded symbol; the lowest id where several coins share it."""
    return coins.groupBy(F.lower("symbol").alias("_folded")).agg(F.min("coin_id").alias("_coin_id"))


def backfill_mappings(quotes: DataFrame, coins: DataFrame, mappings: DataFrame) -> DataFrame:
    """New mappings (source, upper-cased symbol) for quotes whose symbol a coin has in any case."""
    pairs = quotes.select("source", F.upper("symbol").alias("source_id")).distinct()
    linked = pairs.join(_coin_of_symbol(coins), F.lower("source_id") == F.col("_folded"))
    fresh = linked.join(mappings.select("source", "source_id"), ["source", "source_id"], "left_anti")
    return fresh.select(
        F.col("_coin_id").alias("coin_id"), "source", "source_id", F.col("source_id").alias("source_symbol")
    )


def backfill_coin_id(quotes: DataFrame, coins: DataFrame) -> DataFrame:
    """Fill missing coin_ids by symbol in any case; known ids and unknown symbols stay as they are.

    Only the rows without an id are joined, so linked rows are neither shuffled nor gathered under a
    null key.
    """
    missing = quotes.where("coin_id IS NULL").join(
        materialize(_coin_of_symbol(coins), "coin_of_symbol"), F.lower("symbol") == F.col("_folded"), "left"
    )
    filled = missing.withColumn("coin_id", F.col("_coin_id")).select(*quotes.columns)
    return quotes.where("coin_id IS NOT NULL").unionByName(filled)
