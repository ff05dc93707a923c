"""Incremental filters: keep rows newer than the checkpoint, and rows whose time is unknown."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import has_offset_time, parse_timestamp
from .normalize import renamed_columns, variant_text


def newer_than(df: DataFrame, column: str, checkpoint: datetime | str | None) -> DataFrame:
    """Typed time column; written as a plain comparison so that it reaches the parquet scan."""
    if checkpoint is None:
        return df
    limit = F.lit(checkpoint).cast(df.schema[column].dataType)
    return df.where((F.col(column) > limit) | F.col(column).isNull())


def newer_json(raw: DataFrame, checkpoint: datetime | None) -> DataFrame:
    """JSON feeds compare only complete times with an offset; all other times are kept."""
    if checkpoint is None:
        return raw
    updated = has_offset_time(variant_text("item", "last_updated"))
    return raw.where(F.coalesce(updated > F.lit(checkpoint), F.lit(True)))


def newer_csv(raw: DataFrame, checkpoint: datetime | None) -> DataFrame:
    """CSV times without an offset are UTC."""
    time_column = renamed_columns(raw.columns).get("timestamp")
    if checkpoint is None or time_column is None:
        return raw
    parsed = parse_timestamp(F.col(f"`{time_column}`"))
    return raw.where(F.coalesce(parsed > F.lit(checkpoint), F.lit(True)))
