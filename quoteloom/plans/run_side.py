"""Run ledger queries."""

from pyspark.sql import functions as F

from ..functions import truncate_error
from ..operators import runs as r
from . import bindings as b
from .registry import query

_RUN = """id, source, status, last_processed_timestamp, records_processed, started_at, completed_at,
  error_message"""


@query(
    "job_ledger_latest",
    f"""WITH {b.LEDGER_SQL},
revisions AS (
  SELECT id, source, 'running' AS status, CAST(NULL AS TIMESTAMP) AS last_processed_timestamp,
         0 AS records_processed, started_at, CAST(NULL AS TIMESTAMP) AS completed_at,
         CAST(NULL AS VARCHAR) AS error_message, 0 AS revision FROM ledger
  UNION ALL
  SELECT {_RUN}, 1 FROM ledger WHERE status <> 'running')
SELECT {_RUN} FROM revisions
QUALIFY row_number() OVER (PARTITION BY id ORDER BY revision DESC) = 1""",
)
def job_ledger_latest(spark, sf_dir):
    final = b.ledger(spark, sf_dir)
    opened = final.select(
        "id",
        "source",
        F.lit("running").alias("status"),
        F.lit(None).cast("timestamp").alias("last_processed_timestamp"),
        F.lit(0).cast("long").alias("records_processed"),
        "started_at",
        F.lit(None).cast("timestamp").alias("completed_at"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(0).alias("revision"),
    )
    closed = final.where("status <> 'running'").withColumn("revision", F.lit(1))
    return r.latest_state(opened.unionByName(closed)).drop("revision")


@query(
    "run_durations",
    f"""WITH {b.LEDGER_SQL}
SELECT id, duration AS duration_seconds FROM runs""",
)
def run_durations(spark, sf_dir):
    return r.with_duration(b.ledger(spark, sf_dir)).select("id", "duration_seconds")


@query(
    "run_history",
    f"""WITH {b.LEDGER_SQL}
SELECT {_RUN} FROM ledger WHERE source = '1-URGENT' AND status = 'success'
ORDER BY started_at DESC, id LIMIT 100""",
)
def run_history(spark, sf_dir):
    return r.run_history(b.ledger(spark, sf_dir), 100, source="1-URGENT", status="success")


@query(
    "latest_run",
    f"""WITH {b.LEDGER_SQL}
SELECT {_RUN} FROM ledger ORDER BY started_at DESC, id LIMIT 1""",
)
def latest_run(spark, sf_dir):
    return r.latest_run(b.ledger(spark, sf_dir))


@query(
    "latest_checkpoint",
    f"""WITH {b.LEDGER_SQL}
SELECT source, last_processed_timestamp AS "checkpoint" FROM ledger WHERE status = 'success'
QUALIFY row_number() OVER (PARTITION BY source ORDER BY completed_at DESC NULLS FIRST, id DESC) = 1""",
)
def latest_checkpoint(spark, sf_dir):
    return r.latest_checkpoint(b.ledger(spark, sf_dir))


@query(
    "etl_stats",
    f"""WITH {b.LEDGER_SQL}
SELECT count(*) AS total_jobs, count(*) FILTER (status = 'success') AS successful_jobs,
       count(*) FILTER (status = 'failure') AS failed_jobs,
       CAST(sum(records_processed) AS BIGINT) AS total_records_processed,
       max(completed_at) FILTER (status = 'success') AS last_success_at,
       max(completed_at) FILTER (status = 'failure') AS last_failure_at,
       (SELECT duration FROM runs ORDER BY started_at DESC, id LIMIT 1) AS last_job_duration_seconds
FROM runs""",
)
def etl_stats(spark, sf_dir):
    return r.etl_stats(b.ledger(spark, sf_dir))


@query(
    "run_statistics",
    f"""WITH {b.LEDGER_SQL},
newest AS (SELECT * FROM runs ORDER BY started_at DESC, id LIMIT 100)
SELECT count(*) AS total_runs, count(*) FILTER (status = 'success') AS success_count,
       count(*) FILTER (status = 'failure') AS failure_count,
       round(CAST(count(*) FILTER (status = 'success') AS DOUBLE)
             / count(*) FILTER (status <> 'running'), 6) AS success_rate,
       round(avg(duration), 6) AS avg_duration_seconds,
       round(avg(records_processed), 6) AS avg_records_processed
FROM newest""",
)
def run_statistics(spark, sf_dir):
    stats = r.run_statistics(r.run_history(b.ledger(spark, sf_dir), 100))
    rounded = [F.round(c, 6).alias(c) for c in ("success_rate", "avg_duration_seconds", "avg_records_processed")]
    return stats.select("total_runs", "success_count", "failure_count", *rounded)


def _outlier_sql(value: str, kind: str, low: str) -> str:
    return f"""WITH {b.LEDGER_SQL},
m AS (SELECT avg({value}) AS mean, stddev_samp({value}) AS dev, count({value}) AS n FROM runs)
SELECT id AS job_id, '{kind}' AS type, CAST({value} AS DOUBLE) AS value,
       round({low}, 4) AS expected_low, round(mean + 2 * dev, 4) AS expected_high,
       round(({value} - mean) / dev, 6) AS z_score
FROM runs, m WHERE n >= 3 AND dev > 0 AND abs({value} - mean) > 2 * dev"""


def _rounded(outliers):
    return outliers.select(
        "job_id",
        "type",
        "value",
        F.round("expected_low", 4).alias("expected_low"),
        F.round("expected_high", 4).alias("expected_high"),
        F.round("z_score", 6).alias("z_score"),
    )


@query("duration_outliers", _outlier_sql("duration", "duration_outlier", "mean - 2 * dev"))
def duration_outliers(spark, sf_dir):
    return _rounded(r.duration_outliers(b.ledger(spark, sf_dir)))


@query(
    "record_outliers",
    _outlier_sql("records_processed", "record_count_outlier", "greatest(0, mean - 2 * dev)"),
)
def record_outliers(spark, sf_dir):
    return _rounded(r.record_outliers(b.ledger(spark, sf_dir)))


@query(
    "failure_rate",
    f"""WITH {b.LEDGER_SQL},
rates AS (SELECT source, CAST(count(*) FILTER (status = 'failure') AS DOUBLE)
                 / count(*) FILTER (status <> 'running') AS rate FROM runs GROUP BY source)
SELECT source, round(rate, 6) AS value, 'high_failure_rate' AS type, CAST(0.3 AS DOUBLE) AS threshold,
       printf('%.1f%% of recent jobs failed', rate * 100) AS message
FROM rates WHERE rate > 0.3""",
)
def failure_rate(spark, sf_dir):
    rates = r.failure_rates(b.ledger(spark, sf_dir), by=["source"])
    return rates.withColumn("value", F.round("value", 6))


@query(
    "run_anomalies",
    f"""WITH {b.LEDGER_SQL},
newest AS (SELECT * FROM runs ORDER BY started_at DESC, id LIMIT 100),
d AS (SELECT avg(duration) AS mean, stddev_samp(duration) AS dev, count(duration) AS n FROM newest),
c AS (SELECT avg(records_processed) AS mean, stddev_samp(records_processed) AS dev, count(*) AS n FROM newest),
f AS (SELECT CAST(count(*) FILTER (status = 'failure') AS DOUBLE)
             / count(*) FILTER (status <> 'running') AS rate FROM newest)
SELECT id AS job_id, 'duration_outlier' AS type, round(duration, 6) AS value,
       round((duration - mean) / dev, 6) AS z_score
FROM newest, d WHERE n >= 3 AND dev > 0 AND abs(duration - mean) > 2 * dev
UNION ALL
SELECT id, 'record_count_outlier', round(CAST(records_processed AS DOUBLE), 6),
       round((records_processed - mean) / dev, 6)
FROM newest, c WHERE n >= 3 AND dev > 0 AND abs(records_processed - mean) > 2 * dev
UNION ALL
SELECT NULL, 'high_failure_rate', round(rate, 6), NULL FROM f WHERE rate > 0.3""",
)
def run_anomalies(spark, sf_dir):
    found = r.run_report(b.ledger(spark, sf_dir), 100).anomalies
    return found.select(
        "job_id", "type", F.round("value", 6).alias("value"), F.round("z_score", 6).alias("z_score")
    )


@query(
    "compare_runs",
    f"""WITH {b.LEDGER_SQL}
SELECT x.id AS run_id_1, y.id AS run_id_2,
       y.records_processed - x.records_processed AS records_processed_diff,
       y.duration - x.duration AS duration_delta
FROM runs x, runs y WHERE x.id = 97 AND y.id = 178""",
)
def compare_runs(spark, sf_dir):
    return r.compare_runs(b.ledger(spark, sf_dir), 97, 178)


@query(
    "run_counters",
    f"""WITH {b.LEDGER_SQL}
SELECT source, status, count(*) AS runs FROM ledger GROUP BY source, status""",
)
def run_counters(spark, sf_dir):
    return r.run_counters(b.ledger(spark, sf_dir))


@query(
    "last_durations",
    f"""WITH {b.LEDGER_SQL}
SELECT source, duration AS duration_seconds FROM runs WHERE completed_at IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY source ORDER BY completed_at DESC, id DESC) = 1""",
)
def last_durations(spark, sf_dir):
    return r.last_durations(b.ledger(spark, sf_dir))


@query(
    "run_metrics_lines",
    f"""WITH {b.LEDGER_SQL},
ended AS (SELECT * FROM runs WHERE status <> 'running')
SELECT 'etl_runs_total{{source="' || source || '",status="' || status || '"}} '
       || CAST(count(*) AS VARCHAR) AS line
FROM ended GROUP BY source, status
UNION ALL
SELECT 'etl_last_duration_seconds{{source="' || source || '"}} ' || printf('%.3f', duration)
FROM (SELECT source, duration FROM ended
      QUALIFY row_number() OVER (PARTITION BY source ORDER BY completed_at DESC, id DESC) = 1)""",
)
def run_metrics_lines(spark, sf_dir):
    return r.metrics_lines(b.ledger(spark, sf_dir)).select("line")


@query(
    "health_status",
    f"""WITH {b.LEDGER_SQL}
SELECT CASE WHEN status = 'failure' THEN 'degraded' ELSE 'healthy' END AS status,
       status AS last_run_status, source AS last_run_source, completed_at AS last_run_at,
       records_processed, error_message
FROM ledger ORDER BY started_at DESC, id LIMIT 1""",
)
def health_status(spark, sf_dir):
    return r.health(b.ledger(spark, sf_dir))


@query(
    "truncate_text",
    """SELECT doc_id, CASE WHEN length(text) > 990 THEN substr(text, 1, 990) || '...' ELSE text END AS message
FROM documents""",
)
def truncate_text(spark, sf_dir):
    docs = b.table(spark, sf_dir, "documents")
    return docs.select("doc_id", truncate_error(F.col("text")).alias("message"))
