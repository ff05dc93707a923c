"""Drift checks: schema (column names), null ratios and column types.

Checks return frames of ``schemas.DRIFT`` columns. Of the names that data may hold in any number, the
keys of JSON objects, only the expected ones and one match for each missing one reach the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import best_match, closest_name, feasible_lengths
from ..schemas import DRIFT
from ..workspace import materialize

NULL_THRESHOLD = 0.1
NAME_CUTOFF = 0.8
# Severities, and below the message texts and detail keys of each kind of drift.
INFO, WARNING, CRITICAL = "info", "warning", "critical"


def _rows(spark: SparkSession, rows: list[tuple], run_ts: datetime | None) -> DataFrame:
    # As to_json writes them.
    layout = {"sort_keys": True, "ensure_ascii": False, "separators": (",", ":")}
    stamped = [(kind, severity, confidence, text, json.dumps(details, **layout), run_ts)
               for kind, severity, confidence, text, details in rows]
    return spark.createDataFrame(stamped, DRIFT)


def _renamed(name: str, other: str, ratio: float) -> tuple:
    details = {"expected_column": name, "matched_column": other, "similarity_score": round(ratio, 3)}
    return "schema_rename", WARNING, float(ratio), f"Column '{name}' may have been renamed to '{other}'", details


def check_schema(
    spark: SparkSession,
    expected: Sequence[str],
    actual: Iterable[str],
    run_ts: datetime | None = None,
    cutoff: float = NAME_CUTOFF,
) -> DataFrame:
    """Missing, renamed and extra columns."""
    present = sorted(set(actual))
    rows = []
    for name in sorted(set(expected) - set(present)):
        match = closest_name(name, present, cutoff)
        if match:
            rows.append(_renamed(name, *match))
        else:
            details = {"missing_column": name, "available_columns": present}
            rows.append(("schema_missing", CRITICAL, 1.0, f"Required column '{name}' is missing", details))
    extra = sorted(set(present) - set(expected))
    if extra:
        text = f"New columns detected: {', '.join(extra)}"
        rows.append(("schema_extra", INFO, 1.0, text, {"extra_columns": extra}))
    return _rows(spark, rows, run_ts)


def check_types(
    df: DataFrame, expected: Mapping[str, str] | None, run_ts: datetime | None = None
) -> DataFrame:
    """Columns whose type name does not contain the expected one; absent columns are skipped."""
    rows = []
    actual = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    for name, wanted in (expected or {}).items():
        found = actual.get(name)
        if found is not None and wanted.lower() not in found.lower():
            text = f"Column '{name}' type changed from '{wanted}' to '{found}'"
            details = {"column": name, "expected_type": wanted, "actual_type": found}
            rows.append(("type_change", WARNING, 1.0, text, details))
    return _rows(df.sparkSession, rows, run_ts)


def null_counts(df: DataFrame) -> DataFrame:
    """(column, row_count, null_count) of every column: one aggregate, one scan; NaN counts as null."""

    def empty(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return column.isNull() | F.isnan(column)
        return column.isNull()

    counts = [F.count_if(empty(field)).alias(f"n{i}") for i, field in enumerate(df.schema.fields)]
    pairs = [
        F.struct(F.lit(name).alias("column"), F.col(f"n{i}").alias("null_count"))
        for i, name in enumerate(df.columns)
    ]
    totals = df.agg(F.count("*").alias("row_count"), *counts)
    return totals.select("row_count", F.inline(F.array(*pairs))).select("column", "row_count", "null_count")


def json_null_counts(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """The same per top-level key of JSON objects; a key that an object lacks counts as null there.

    One aggregate per key: no key's rows gather anywhere. A parsed ``item`` is used where there is one.
    """
    spark = payloads.sparkSession
    item = F.col("item") if "item" in payloads.columns else F.try_parse_json(column)
    rows = payloads.select(item.alias("item"))
    keys = rows.lateralJoin(spark.tvf.variant_explode(F.col("item").outer())).select(
        F.col("key").alias("column"), F.is_variant_null("value").alias("is_null")
    )
    filled = keys.where("column IS NOT NULL").groupBy("column").agg(
        F.count_if(~F.col("is_null")).alias("filled")
    )
    total = payloads.agg(F.count("*").alias("n")).select("n").scalar()
    return filled.select(
        "column", total.alias("row_count"), (total - F.col("filled")).alias("null_count")
    )


def null_drift(
    counts: DataFrame, run_ts: Column | None = None, threshold: float = NULL_THRESHOLD
) -> DataFrame:
    """Columns whose null ratio exceeds the threshold; severity by ratio, confidence 1 - ratio."""
    ratio = F.try_divide(F.col("null_count"), F.col("row_count"))
    severity = F.when(ratio > 0.5, CRITICAL).when(ratio > 0.25, WARNING).otherwise(INFO)
    details = F.to_json(
        F.struct(
            "column",
            F.round("ratio", 4).alias("null_ratio"),
            F.lit(threshold).alias("threshold"),
            "row_count",
            "null_count",
        )
    )
    return (
        counts.withColumn("ratio", ratio)
        .where(F.col("ratio") > threshold)
        .select(
            F.lit("quality_nulls").alias("drift_type"),
            severity.alias("severity"),
            (1.0 - F.col("ratio")).alias("confidence"),
            F.format_string("Column '%s' has %.1f%% null values", "column", F.col("ratio") * 100).alias("message"),
            details.alias("details"),
            (run_ts if run_ts is not None else F.lit(None).cast("timestamp")).alias("timestamp"),
            "column",
            "row_count",
            "null_count",
            F.col("ratio").alias("null_ratio"),
        )
    )


def detect(
    df: DataFrame, expected: Sequence[str], run_ts: datetime | None = None, threshold: float = NULL_THRESHOLD
) -> DataFrame:
    """Schema and null checks of a frame's columns."""
    nulls = null_drift(null_counts(df), F.lit(run_ts).cast("timestamp"), threshold)
    schema = check_schema(df.sparkSession, expected, df.columns, run_ts)
    return schema.unionByName(nulls.select(*DRIFT.fieldNames()))


def detect_json(
    payloads: DataFrame, expected: Sequence[str], run_ts: datetime | None = None, threshold: float = NULL_THRESHOLD
) -> DataFrame:
    """The same checks for JSON objects, whose columns are their top-level keys.

    However many keys there are (ids may be used as keys), their statistics stay distributed and the
    tasks look for the match of a missing name among theirs. Lists of all keys are made on the
    executors, one for each row that the report has them in.
    """
    spark = payloads.sparkSession
    counts = materialize(json_null_counts(payloads), "key_counts")
    nulls = null_drift(counts, F.lit(run_ts).cast("timestamp"), threshold).select(*DRIFT.fieldNames())
    present = {row["column"] for row in counts.where(F.col("column").isin(list(expected))).collect()}
    missing = sorted(set(expected) - present)
    near = {row["name"]: row["best"] for row in _closest_keys(counts, missing).collect()} if missing else {}
    renamed = [_renamed(name, near[name]["other"], near[name]["ratio"]) for name in missing if name in near]
    lost = [name for name in missing if name not in near]
    report = _rows(spark, renamed, run_ts)
    if lost:
        report = report.unionByName(_missing_keys(counts, lost, run_ts))
    return report.unionByName(_extra_keys(counts, expected, run_ts)).unionByName(nulls)


def _closest_keys(counts: DataFrame, missing: Sequence[str], cutoff: float = NAME_CUTOFF) -> DataFrame:
    """(name, best): the key closest to each missing name, where one reaches the cutoff."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            best = [(name, *found) for name in missing if (found := best_match(name, frame["column"], cutoff))]
            yield pd.DataFrame(best, columns=["name", "rank", "other", "ratio"])

    keys = counts.where(F.length("column").isin(feasible_lengths(missing, cutoff))).select("column")
    found = keys.mapInPandas(run, "name string, rank double, other string, ratio double")
    return found.groupBy("name").agg(F.max(F.struct("rank", "other", "ratio")).alias("best"))


def _schema_row(kind: str, severity: str, message: Column, details: Column, run_ts: datetime | None) -> list[Column]:
    return [
        F.lit(kind).alias("drift_type"),
        F.lit(severity).alias("severity"),
        F.lit(1.0).alias("confidence"),
        message.alias("message"),
        F.to_json(details).alias("details"),
        F.lit(run_ts).cast("timestamp").alias("timestamp"),
    ]


def _missing_keys(counts: DataFrame, lost: list[str], run_ts: datetime | None) -> DataFrame:
    """A row for each name that no key resembles, with all keys."""
    names = counts.agg(F.array_sort(F.collect_list("column")).alias("available_columns"))
    rows = names.withColumn("missing_column", F.explode(F.lit(lost)))
    message = F.concat(F.lit("Required column '"), F.col("missing_column"), F.lit("' is missing"))
    return rows.select(*_schema_row("schema_missing", CRITICAL, message, F.struct("available_columns", "missing_column"), run_ts))


def _extra_keys(counts: DataFrame, expected: Sequence[str], run_ts: datetime | None) -> DataFrame:
    """One row with all keys beyond the expected ones, if there are any."""
    extra = counts.where(~F.col("column").isin(list(expected))).agg(
        F.array_sort(F.collect_list("column")).alias("extra_columns")
    )
    message = F.concat(F.lit("New columns detected: "), F.array_join("extra_columns", ", "))
    return extra.where(F.size("extra_columns") > 0).select(
        *_schema_row("schema_extra", INFO, message, F.struct("extra_columns"), run_ts)
    )


def has_critical(drift: DataFrame) -> bool:
    return not drift.where(F.col("severity") == CRITICAL).limit(1).isEmpty()


def drift_summary(log: DataFrame) -> DataFrame:
    """Totals over the drift log by severity, by type and overall, in one aggregate."""
    grouped = log.groupingSets([["severity"], ["drift_type"], []], "severity", "drift_type").agg(
        F.grouping("severity").alias("_s"),
        F.grouping("drift_type").alias("_t"),
        F.count("*").alias("issues"),
        F.max("timestamp").alias("latest_drift"),
    )
    level = F.when(F.col("_s") == 0, "severity").when(F.col("_t") == 0, "type").otherwise("total")
    return grouped.select(
        level.alias("level"),
        F.coalesce("severity", "drift_type", F.lit("all")).alias("label"),
        "issues",
        "latest_drift",
    )
