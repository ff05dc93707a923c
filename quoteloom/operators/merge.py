"""Duplicate removal, upsert and conflict-free insert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import QUOTE_KEY, QUOTE_UPDATES


def last_per_key(
    df: DataFrame, keys: list[str], arrival: str = "arrival", keep_arrival: bool = True
) -> DataFrame:
    """The last row per key in arrival order, without the ``arrival`` column unless it is kept.

    An aggregate rather than a window: each task keeps one row per key before the shuffle, so a key
    that holds much of the data does not gather in one task. A kept arrival is shuffled twice, as the
    order and in the row.
    """
    columns = [c for c in df.columns if keep_arrival or c != arrival]
    rest = [c for c in columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), arrival).alias("_row"))
    return last.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*columns)


def first_per_key(df: DataFrame, keys: list[str], arrival: str = "arrival") -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), arrival).alias("_row"))
    return first.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def dedup_report(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Rows in, rows kept and rows dropped per ``by``."""
    per_key = df.groupBy(*dict.fromkeys([*by, *keys])).agg(F.count("*").alias("n"))
    return per_key.groupBy(*by).agg(
        F.sum("n").alias("rows_in"),
        F.count("*").alias("rows_kept"),
        (F.sum("n") - F.count("*")).alias("rows_dropped"),
    )


def merge_rows(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str] = QUOTE_KEY,
    updates: list[str] = QUOTE_UPDATES,
) -> DataFrame:
    """Upsert as a full outer join of two frames with unique keys.

    A match takes the batch's ``updates`` (nulls too) and keeps every other target column; a new key
    is inserted whole. Null key values match each other. Both sides have at most one row per key, so no partition is skewed.
    """
    t, b = target.alias("t"), batch.withColumn("_hit", F.lit(True)).alias("b")
    joined = t.join(b, [F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "full_outer")
    hit = F.col("b._hit")

    def column(name: str):
        old, new = F.col(f"t.`{name}`"), F.col(f"b.`{name}`")
        if name in updates:
            return F.when(hit, new).otherwise(old).alias(name)
        return F.coalesce(old, new).alias(name)

    return joined.select(*[column(name) for name in target.columns])


def merge_counts(target: DataFrame, batch: DataFrame, keys: list[str] = QUOTE_KEY) -> DataFrame:
    """One row: keys updated, keys inserted, rows affected."""
    marks = target.select(*keys, F.lit(1).alias("_t"), F.lit(0).alias("_b")).unionByName(
        batch.select(*keys, F.lit(0).alias("_t"), F.lit(1).alias("_b"))
    )
    per_key = marks.groupBy(*keys).agg(F.max("_t").alias("t"), F.max("_b").alias("b"))
    return per_key.agg(
        F.count_if((F.col("t") == 1) & (F.col("b") == 1)).alias("rows_updated"),
        F.count_if((F.col("t") == 0) & (F.col("b") == 1)).alias("rows_inserted"),
        F.count_if(F.col("b") == 1).alias("rows_affected"),
    )


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str], arrival: str | None = None) -> DataFrame:
    """Target plus the rows whose key it does not have.

    When ``rows`` may repeat a key, ``arrival`` says which row is first and stays.
    """
    if arrival is not None:
        rows = first_per_key(rows, keys, arrival)
    fresh = rows.select(*target.columns).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))
