"""Uniqueness checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Keys with a null never conflict."""
    complete = df.dropna(subset=keys)
    return complete.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def assert_insertable(rows: DataFrame, table: DataFrame, keys: list[str], what: str) -> None:
    """Fail when ``rows`` repeat a key or have one that the (unique) ``table`` holds already.

    Only the new rows are grouped; the table is read for its key columns.
    """
    taken = rows.select(*keys).join(table.select(*keys), keys, "left_semi")
    clash = unique_violations(rows, keys).select(*keys).unionByName(taken).take(1)
    if clash:
        raise ValueError(f"duplicate {what}: {clash[0].asDict()}")
