"""Drift checks."""

from pyspark.sql import functions as F

from ..operators import drift
from . import bindings as b
from .registry import query

_EXPECTED = ["event_id", "timestamp", "user_id", "severity_code", "value", "checksum"]
_RENAMED = {"ts": "timestamps"}


def _events(spark, sf_dir):
    """Events with a renamed time column, and a value that is null for errors."""
    rows = b.table(spark, sf_dir, "events").withColumnsRenamed(_RENAMED)
    return rows.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))


_SCHEMA_ROWS = """SELECT * FROM (VALUES
  ('schema_missing', 'critical', 1.0, 'Required column ''checksum'' is missing'),
  ('schema_missing', 'critical', 1.0, 'Required column ''severity_code'' is missing'),
  ('schema_rename', 'warning', 0.947368, 'Column ''timestamp'' may have been renamed to ''timestamps'''),
  ('schema_extra', 'info', 1.0, 'New columns detected: event_type, props, timestamps')
) AS t(drift_type, severity, confidence, message)"""

_NULLS_SQL = """SELECT 'value' AS "column", count(*) AS row_count,
  count(*) FILTER (event_type = 'error') AS null_count,
  CAST(count(*) FILTER (event_type = 'error') AS DOUBLE) / count(*) AS ratio FROM events"""


def _brief(found):
    return found.select("drift_type", "severity", F.round("confidence", 6).alias("confidence"), "message")


@query(
    "drift_nulls",
    f"""SELECT 'quality_nulls' AS drift_type,
       CASE WHEN ratio > 0.5 THEN 'critical' WHEN ratio > 0.25 THEN 'warning' ELSE 'info' END AS severity,
       round(1 - ratio, 6) AS confidence, "column", row_count, null_count, round(ratio, 4) AS null_ratio
FROM ({_NULLS_SQL}) WHERE ratio > 0.1""",
)
def drift_nulls(spark, sf_dir):
    found = drift.null_drift(drift.null_counts(_events(spark, sf_dir)))
    return found.select(
        "drift_type",
        "severity",
        F.round("confidence", 6).alias("confidence"),
        "column",
        "row_count",
        "null_count",
        F.round("null_ratio", 4).alias("null_ratio"),
    )


@query(
    "null_profile",
    """SELECT 'event_id' AS "column", count(*) AS row_count, 0 AS null_count FROM events
UNION ALL SELECT 'timestamps', count(*), 0 FROM events
UNION ALL SELECT 'user_id', count(*), 0 FROM events
UNION ALL SELECT 'event_type', count(*), 0 FROM events
UNION ALL SELECT 'value', count(*), count(*) FILTER (event_type = 'error') FROM events
UNION ALL SELECT 'props', count(*), 0 FROM events""",
)
def null_profile(spark, sf_dir):
    return drift.null_counts(_events(spark, sf_dir))


_REPORT_SQL = f"""SELECT drift_type, severity, CAST(confidence AS DOUBLE) AS confidence, message FROM ({_SCHEMA_ROWS})
UNION ALL
SELECT 'quality_nulls',
       CASE WHEN ratio > 0.5 THEN 'critical' WHEN ratio > 0.25 THEN 'warning' ELSE 'info' END,
       round(1 - ratio, 6), 'Column ''value'' has ' || printf('%.1f', ratio * 100) || '% null values'
FROM ({_NULLS_SQL}) WHERE ratio > 0.1"""


@query("drift_report", _REPORT_SQL)
def drift_report(spark, sf_dir):
    return _brief(drift.detect(_events(spark, sf_dir), _EXPECTED))


@query(
    "drift_all_checks",
    f"""{_REPORT_SQL}
UNION ALL
SELECT 'type_change', 'warning', 1.0, 'Column ''user_id'' type changed from ''string'' to ''bigint'''
FROM (SELECT count(user_id) AS n FROM events) WHERE n > 0""",
)
def drift_all_checks(spark, sf_dir):
    rows = _events(spark, sf_dir)
    wanted = {"user_id": "string", "value": "double", "event_id": "INT", "absent": "string"}
    return _brief(drift.detect(rows, _EXPECTED).unionByName(drift.check_types(rows, wanted)))


def _payloads(spark, sf_dir):
    """JSON objects: value is a JSON null for errors, user_id is absent but for clicks."""
    common = ["event_id", "event_type", "value"]
    plain = F.to_json(F.struct(*common), {"ignoreNullFields": "false"})
    clicks = F.to_json(F.struct(*common, "user_id"), {"ignoreNullFields": "false"})
    rows = _events(spark, sf_dir)
    return rows.select(F.when(F.col("event_type") == "click", clicks).otherwise(plain).alias("payload"))


@query(
    "drift_json_keys",
    """SELECT 'event_id' AS "column", count(*) AS row_count, 0 AS null_count FROM events
UNION ALL SELECT 'event_type', count(*), 0 FROM events
UNION ALL SELECT 'value', count(*), count(*) FILTER (event_type = 'error') FROM events
UNION ALL SELECT 'user_id', count(*), count(*) FILTER (event_type <> 'click') FROM events""",
)
def drift_json_keys(spark, sf_dir):
    return drift.json_null_counts(_payloads(spark, sf_dir))


@query(
    "drift_json_report",
    """WITH n AS (
  SELECT count(*) AS n, count(*) FILTER (event_type = 'error') AS errors,
         count(*) FILTER (event_type <> 'click') AS others FROM events),
r AS (SELECT 'value' AS name, CAST(errors AS DOUBLE) / n AS ratio FROM n
      UNION ALL SELECT 'user_id', CAST(others AS DOUBLE) / n FROM n)
SELECT 'schema_rename' AS drift_type, 'warning' AS severity, CAST(0.933333 AS DOUBLE) AS confidence,
       'Column ''user_ids'' may have been renamed to ''user_id''' AS message
UNION ALL SELECT 'schema_missing', 'critical', 1, 'Required column ''ticker'' is missing'
UNION ALL SELECT 'schema_extra', 'info', 1, 'New columns detected: event_type, user_id, value'
UNION ALL
SELECT 'quality_nulls', CASE WHEN ratio > 0.5 THEN 'critical' WHEN ratio > 0.25 THEN 'warning' ELSE 'info' END,
       round(1 - ratio, 6), 'Column ''' || name || ''' has ' || printf('%.1f', ratio * 100) || '% null values'
FROM r WHERE ratio > 0.1""",
)
def drift_json_report(spark, sf_dir):
    """Columns found in the data: the keys of the JSON objects."""
    return _brief(drift.detect_json(_payloads(spark, sf_dir), ["event_id", "user_ids", "ticker"]))


@query(
    "drift_summary",
    """WITH log AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN 'critical' WHEN 'P' THEN 'warning' ELSE 'info' END AS severity,
         CASE WHEN o_orderpriority < '3' THEN 'quality_nulls' ELSE 'schema_extra' END AS drift_type,
         o_orderdate AS ts FROM orders)
SELECT 'severity' AS level, severity AS label, count(*) AS issues, max(ts) AS latest_drift FROM log GROUP BY severity
UNION ALL SELECT 'type', drift_type, count(*), max(ts) FROM log GROUP BY drift_type
UNION ALL SELECT 'total', 'all', count(*), max(ts) FROM log""",
)
def drift_summary(spark, sf_dir):
    log = b.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "critical")
        .when(F.col("o_orderstatus") == "P", "warning")
        .otherwise("info")
        .alias("severity"),
        F.when(F.col("o_orderpriority") < "3", "quality_nulls").otherwise("schema_extra").alias("drift_type"),
        F.col("o_orderdate").alias("timestamp"),
    )
    return drift.drift_summary(log)
