"""Canonical symbols from free text: exact alias, then closest alias."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import feasible_lengths, fuzzy_alias_udf, strip_spaces
from ..workspace import materialize

# The default aliases.
CANONICAL = {
    "bitcoin": "BTC",
    "btc": "BTC",
    "ethereum": "ETH",
    "eth": "ETH",
    "solana": "SOL",
    "sol": "SOL",
    "cardano": "ADA",
    "ada": "ADA",
    "ripple": "XRP",
    "xrp": "XRP",
    "polkadot": "DOT",
    "dot": "DOT",
    "dogecoin": "DOGE",
    "doge": "DOGE",
}
CUTOFF = 0.8


def alias_key(text: Column) -> Column:
    return strip_spaces(F.lower(text))


def exact_symbol(text: Column, aliases: Mapping[str, str] = CANONICAL) -> Column:
    """Symbol of an alias in any case; a canonical symbol maps to itself; else null.

    For a short, fixed alias list: the list becomes a literal map, so there is no join.
    """
    known = {symbol.lower(): symbol for symbol in aliases.values()}
    known.update(aliases)
    pairs = [F.lit(item) for pair in known.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), alias_key(text))


def with_exact_symbol(df: DataFrame, column: str, aliases: DataFrame, out: str = "canonical") -> DataFrame:
    """The same lookup against a table (alias, canonical) of any size."""
    names = aliases.select(F.lower("alias").alias("_key"), F.col("canonical").alias("_symbol"))
    symbols = aliases.select(F.lower("canonical").alias("_key"), F.col("canonical").alias("_symbol"))
    lookup = (
        names.withColumn("_rank", F.lit(0))
        .unionByName(symbols.withColumn("_rank", F.lit(1)))
        .groupBy("_key")
        .agg(F.min_by("_symbol", F.struct("_rank", "_symbol")).alias(out))
    )
    lookup = materialize(lookup, "alias_lookup")
    return df.join(lookup, alias_key(F.col(column)) == F.col("_key"), "left").drop("_key")


def canonical_tokens(
    df: DataFrame, column: str, aliases: Mapping[str, str] = CANONICAL, cutoff: float = CUTOFF
) -> DataFrame:
    """(token, canonical) for the distinct tokens that only the closest-alias rule resolves.

    The Python ratio runs on distinct tokens that no exact rule covers and whose length could reach
    the cutoff at all, never on the fact rows.
    """
    key = alias_key(F.col(column))
    tokens = (
        df.select(key.alias("token"))
        .where(F.length("token").isin(feasible_lengths(aliases, cutoff)))
        .distinct()
        .where(exact_symbol(F.col("token"), aliases).isNull())
    )
    closest = fuzzy_alias_udf(aliases, cutoff)
    return tokens.withColumn("canonical", closest("token")).where("canonical IS NOT NULL")


def with_canonical_symbol(
    df: DataFrame,
    column: str,
    aliases: Mapping[str, str] = CANONICAL,
    cutoff: float = CUTOFF,
    out: str = "canonical",
) -> DataFrame:
    """Exact alias, canonical symbol, then the closest alias with at least the cutoff ratio.

    The fuzzy matches are written out first, so Catalyst knows their size and joins them by
    broadcast while they are small and by a skew-aware shuffle join beyond that.
    """
    fuzzy = materialize(canonical_tokens(df, column, aliases, cutoff), "fuzzy_aliases")
    fuzzy = fuzzy.select(F.col("token").alias("_token"), F.col("canonical").alias("_fuzzy"))
    joined = df.join(fuzzy, alias_key(F.col(column)) == F.col("_token"), "left")
    return joined.withColumn(out, F.coalesce(exact_symbol(F.col(column), aliases), F.col("_fuzzy"))).drop(
        "_token", "_fuzzy"
    )
