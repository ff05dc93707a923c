"""Consecutive surrogate ids in a given order, without sending the rows through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize

_POSITION_BITS = 33  # layout of monotonically_increasing_id: partition number above row position


def with_dense_ids(df: DataFrame, order_by: list[str], id_column: str, after: int) -> DataFrame:
    """Add ``after + 1, after + 2, ...`` in the order of ``order_by``, which must be unique.

    Rows are range-partitioned and sorted once and written with their partition-local position; the
    driver then adds one offset per written partition. The written copy keeps ids stable when tasks
    are repeated.
    """
    spark = df.sparkSession
    placed = materialize(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "dense_ids",
    )
    partition = F.shiftright("_slot", _POSITION_BITS)
    position = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # At most one row per shuffle partition.
    counts = sorted(placed.groupBy(partition.alias("part")).count().collect())
    offsets, total = [], after
    for part, count in counts:
        offsets.append((part, total))
        total += count
    lookup = spark.createDataFrame(offsets, "_part long, _offset long")
    return (
        placed.withColumn("_part", partition)
        .join(F.broadcast(lookup), "_part")  # size bound: one row per shuffle partition
        .withColumn(id_column, F.col("_offset") + position + 1)
        .drop("_slot", "_part", "_offset")
    )
