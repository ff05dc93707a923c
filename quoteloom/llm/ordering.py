"""Running totals in key order within groups of any size, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import materialize

ROWS_PER_RANGE = 2_000
KEY_BITS = 60


def running_totals(rows: DataFrame, group: str, key: str, value: str, ties: list[str], out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same group that stand earlier.

    Rows of a group are ordered by ``key``, a hash (see ``stable_key``), then by ``ties``;
    rows equal in all of these change places freely. The key space is cut into equal ranges, so many
    that a range of one group holds about ``ROWS_PER_RANGE`` rows at most. Totals of ranges are summed
    up first; each row is then shuffled once, to its group's range, and sorted there. A hot group is
    spread over all ranges. Null groups are a group.
    """
    total = rows.count()
    ranges = max(1, -(-total // ROWS_PER_RANGE))
    place = F.floor(F.col(key) / F.lit(float(1 << KEY_BITS)) * ranges)
    rows = rows.withColumn("_range", F.least(place, F.lit(ranges - 1))).withColumn(
        "_group", F.struct(F.col(group).alias("g"))  # a struct is never null, so null groups join
    )
    sums = rows.groupBy("_group", "_range").agg(F.sum(value).alias("_sum"))
    # One row for each range of a group.
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    sums = materialize(sums, "range_totals")
    inside = (
        Window.partitionBy("_group", "_range")
        .orderBy(key, *ties)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = rows.join(sums, ["_group", "_range"])
    own = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return joined.withColumn(out, F.col("_before") + own).drop("_group", "_range", "_before")


def stable_key(*columns: Column | str) -> Column:
    """A key from 0 to 2 ** KEY_BITS - 1, evenly spread, that depends on the columns' values alone.

    The first bits of their MD5 as text, joined by colons; a null counts as an empty text.
    """
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    digits = F.substring(F.md5(F.concat_ws(":", *texts).cast("binary")), 1, KEY_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")
