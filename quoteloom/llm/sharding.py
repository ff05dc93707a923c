"""Sharding by weighted rendezvous hashing of stable record keys.

Every (key, shard) pair has a hash; the shard with the best weighted score takes the record. Scores of
other shards do not change when a shard is added, so the new one takes rows only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import running_totals, stable_key


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (0 to n - 1) of a record key; a shard gets rows in proportion to its weight.

    A null key hashes like any other value. Ties, which 64 bits make unlikely, go to the lower shard.
    """

    def score(shard: int, weight: float) -> Column:
        drawn = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
        unit = (drawn + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.log(unit) / F.lit(float(weight))).alias("s"), F.lit(shard).alias("n"))

    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = [score(n, w) for n, w in enumerate(weights)]
    return (F.least(*scores) if len(scores) > 1 else scores[0]).getField("n")


def shard(docs: DataFrame, weights: list[float], key: str = "doc_id", grown_weight: float = 1.0) -> DataFrame:
    """``docs`` with size, text_crc32, law, shard, slot and grown_shard.

    ``slot`` numbers a shard's rows without gaps from 0, in hash order of key and text. ``size`` is the
    text's UTF-8 bytes plus 1. Null texts have no bytes; repeated rows get slots of their own; an empty
    table gives an empty result. Other columns are kept; those of the names above are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_doc"),  # out of the way of the names below
        F.col(key).alias("_key"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, grown_weight]).alias("grown_shard"),
        stable_key(key, "text").alias("_order"),
        F.lit(1).cast("long").alias("_one"),
    )
    placed = running_totals(rows, "shard", "_order", "_one", ["_key", "text_crc32", "size"], "slot")
    new = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    return placed.select(*[F.col("_doc")[c].alias(c) for c in docs.columns if c not in new], *new)
