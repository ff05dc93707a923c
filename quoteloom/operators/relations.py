"""Joins between quotes, coins and mappings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quotes_with_entity(quotes: DataFrame, coins: DataFrame) -> DataFrame:
    """Each quote with its coin as a struct (id, symbol, name); null when it has none."""
    coin = coins.select(
        "coin_id",
        F.struct(F.col("coin_id").alias("id"), "symbol", "name").alias("coin"),
    )
    return quotes.join(coin, "coin_id", "left")


def entity_mappings(coins: DataFrame, mappings: DataFrame) -> DataFrame:
    """Each coin with its source mappings, one row per mapping; coins without any keep one row.

    Flat on purpose: a coin may have any number of mappings, an array would gather them in one row.
    """
    return coins.select("coin_id", "symbol", "name").join(
        mappings.select("coin_id", "source", "source_id", "source_symbol", "source_name"), "coin_id", "left"
    )


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose (non-null) key no parent has."""
    keys = parents.select(F.col(parent_key).alias("_parent"))
    return children.where(F.col(child_key).isNotNull()).join(
        keys, F.col(child_key) == F.col("_parent"), "left_anti"
    )


def without_children_of(children: DataFrame, removed: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows that stay when the ``removed`` parents are deleted with a cascade."""
    keys = removed.select(F.col(parent_key).alias("_parent"))
    return children.join(keys, F.col(child_key) == F.col("_parent"), "left_anti")


def delete_coins(
    removed: DataFrame, coins: DataFrame, mappings: DataFrame, quotes: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What remains of coins, mappings and quotes after deleting the ``removed`` coin ids."""
    return tuple(
        without_children_of(table, removed, "coin_id", "coin_id") for table in (coins, mappings, quotes)
    )
