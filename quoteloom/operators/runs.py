"""The run ledger: state, history, statistics, anomalies, comparison and counters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import duration_seconds
from ..schemas import FAILURE, SUCCESS
from ..workspace import materialize

DEFAULT_RUNS, MAX_RUNS = 10, 100
SIGMAS = 2.0
MIN_SAMPLE = 3
FAILURE_THRESHOLD = 0.3


def duration() -> Column:
    """Run duration in seconds, null while a run is not completed."""
    return duration_seconds(F.col("started_at"), F.col("completed_at"))


def with_duration(runs: DataFrame) -> DataFrame:
    return runs.withColumn("duration_seconds", duration())


def latest_state(ledger: DataFrame, revision: str = "revision") -> DataFrame:
    """The ledger is append-only; a run's state is its row with the highest revision."""
    rest = [c for c in ledger.columns if c != "id"]
    newest = ledger.groupBy("id").agg(F.max_by(F.struct(*rest), revision).alias("_row"))
    return newest.select("id", *[F.col("_row")[c].alias(c) for c in rest]).select(*ledger.columns)


def filter_runs(runs: DataFrame, source: str | None = None, status: str | None = None) -> DataFrame:
    if source:
        runs = runs.where(F.col("source") == source)
    if status:
        runs = runs.where(F.col("status") == status)
    return runs


def run_history(
    runs: DataFrame, limit: int = DEFAULT_RUNS, source: str | None = None, status: str | None = None
) -> DataFrame:
    """The newest runs; the id decides between equal start times."""
    if not 1 <= limit <= MAX_RUNS:
        raise ValueError(f"limit must be between 1 and {MAX_RUNS}")
    return filter_runs(runs, source, status).orderBy(F.desc("started_at"), "id").limit(limit)


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), "id").limit(1)


def latest_checkpoint(runs: DataFrame, source: str | None = None) -> DataFrame:
    """Checkpoint of the last completed successful run per source (or of one source).

    A success without a completion time counts as the latest, as a descending sort with nulls first
    would have it; the id decides between equal times.
    """
    done = filter_runs(runs, source, SUCCESS)
    order = F.struct(F.col("completed_at").isNull(), F.col("completed_at"), F.col("id"))
    picked = F.max_by(F.struct("last_processed_timestamp"), order)["last_processed_timestamp"]
    return done.groupBy("source").agg(picked.alias("checkpoint"))


def carried_checkpoint(runs: DataFrame, source: str) -> DataFrame:
    """Like ``latest_checkpoint`` but ignores successful runs that found no rows.

    Such a run stores no checkpoint; taken literally the next run would reload everything.
    """
    return latest_checkpoint(runs.where("last_processed_timestamp IS NOT NULL"), source)


def etl_stats(runs: DataFrame) -> DataFrame:
    """Totals over the ledger, newest completions, and the duration of the run started last."""
    newest = F.struct(F.col("started_at"), -F.col("id"))
    return runs.agg(
        F.count("*").alias("total_jobs"),
        F.count_if(F.col("status") == SUCCESS).alias("successful_jobs"),
        F.count_if(F.col("status") == FAILURE).alias("failed_jobs"),
        F.coalesce(F.sum("records_processed"), F.lit(0).cast("long")).alias("total_records_processed"),
        F.max(F.when(F.col("status") == SUCCESS, F.col("completed_at"))).alias("last_success_at"),
        F.max(F.when(F.col("status") == FAILURE, F.col("completed_at"))).alias("last_failure_at"),
        F.max_by(F.struct(duration().alias("d")), newest)["d"].alias("last_job_duration_seconds"),
    )


def run_statistics(runs: DataFrame) -> DataFrame:
    """Totals, success rate (running runs do not count, 0 when none ended) and means."""
    success = F.count_if(F.col("status") == SUCCESS)
    failure = F.count_if(F.col("status") == FAILURE)
    return runs.agg(
        F.count("*").alias("total_runs"),
        success.alias("success_count"),
        failure.alias("failure_count"),
        F.coalesce(F.try_divide(success, success + failure), F.lit(0.0)).alias("success_rate"),
        F.avg(duration()).alias("avg_duration_seconds"),
        F.avg("records_processed").alias("avg_records_processed"),
    )


def zscore_outliers(
    runs: DataFrame, value: Column, kind: str, non_negative: bool = False, digits: int = 1
) -> DataFrame:
    """Runs whose value is more than two sample standard deviations from the mean.

    Needs three values and a positive deviation. The moments are one row; they reach the filter as
    a scalar subquery, so the runs are neither shuffled nor joined.
    """
    valued = runs.withColumn("value", value.cast("double"))
    moments = valued.agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("dev")
    )
    marked = valued.withColumn("_m", moments.select(F.struct("n", "mean", "dev")).scalar())
    mean, dev = F.col("_m.mean"), F.col("_m.dev")
    far = (F.col("_m.n") >= MIN_SAMPLE) & (dev > 0) & (F.abs(F.col("value") - mean) > SIGMAS * dev)
    low, high = mean - SIGMAS * dev, mean + SIGMAS * dev
    if non_negative:
        low = F.greatest(F.lit(0.0), low)
    return marked.where(far).select(
        F.col("id").alias("job_id"),
        F.lit(kind).alias("type"),
        "value",
        low.alias("expected_low"),
        high.alias("expected_high"),
        F.format_string(f"%.{digits}f - %.{digits}f", low, high).alias("expected_range"),
        F.try_divide(F.col("value") - mean, dev).alias("z_score"),
    )


def duration_outliers(runs: DataFrame) -> DataFrame:
    return zscore_outliers(runs, duration(), "duration_outlier")


def record_outliers(runs: DataFrame) -> DataFrame:
    return zscore_outliers(
        runs, F.col("records_processed"), "record_count_outlier", non_negative=True, digits=0
    )


def failure_rates(runs: DataFrame, by: list[str] | None = None, threshold: float = FAILURE_THRESHOLD) -> DataFrame:
    """Groups (or the whole ledger) whose share of failures among ended runs exceeds the threshold."""
    success = F.count_if(F.col("status") == SUCCESS)
    failure = F.count_if(F.col("status") == FAILURE)
    rate = F.try_divide(failure, success + failure)
    return (
        runs.groupBy(*(by or []))
        .agg(rate.alias("value"))
        .where(F.col("value") > threshold)
        .withColumn("type", F.lit("high_failure_rate"))
        .withColumn("threshold", F.lit(threshold))
        .withColumn("message", F.format_string("%.1f%% of recent jobs failed", F.col("value") * 100))  # fixed text
    )


def anomalies(runs: DataFrame) -> DataFrame:
    """Duration, record-count and failure-rate anomalies of one window of runs, as one frame."""
    parts = [duration_outliers(runs), record_outliers(runs), failure_rates(runs)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


@dataclass(frozen=True)
class RunReport:
    runs: DataFrame
    anomalies: DataFrame
    statistics: DataFrame


def run_report(
    runs: DataFrame, limit: int = DEFAULT_RUNS, source: str | None = None, status: str | None = None
) -> RunReport:
    """The newest runs with their anomalies and statistics.

    The window (at most ``MAX_RUNS`` rows) is written once, so the ledger is scanned a single time.
    """
    window = materialize(run_history(runs, limit, source, status), "run_window")
    return RunReport(window, anomalies(window), run_statistics(window))


def compare_runs(runs: DataFrame, run_id_1: int, run_id_2: int) -> DataFrame:
    """Second run minus first: records, and seconds when both are completed.

    Two different runs must exist; else the query fails.
    """
    picked = runs.where(F.col("id").isin(run_id_1, run_id_2))

    def of(run_id: int, value: Column) -> Column:
        return F.max(F.when(F.col("id") == run_id, value))

    records = F.col("records_processed")
    return (
        picked.agg(
            F.count_distinct("id").alias("_found"),
            (of(run_id_2, records) - of(run_id_1, records)).alias("records_processed_diff"),
            (of(run_id_2, duration()) - of(run_id_1, duration())).alias("duration_delta"),
        )
        .select(
            F.when(F.col("_found") == 2, F.lit(run_id_1).cast("long"))
            .otherwise(F.raise_error("One or both runs not found").cast("long"))
            .alias("run_id_1"),
            F.lit(run_id_2).cast("long").alias("run_id_2"),
            "records_processed_diff",
            "duration_delta",
        )
    )


def run_counters(runs: DataFrame) -> DataFrame:
    return runs.groupBy("source", "status").agg(F.count("*").alias("runs"))


def last_durations(runs: DataFrame) -> DataFrame:
    """Duration of the run completed last, per source."""
    done = runs.where("completed_at IS NOT NULL")
    newest = F.struct("completed_at", "id")
    return done.groupBy("source").agg(F.max_by(duration(), newest).alias("duration_seconds"))


def metrics_lines(runs: DataFrame) -> DataFrame:
    """Counters and gauges as text lines (``position`` gives their order); ended runs only."""
    ended = runs.where(F.col("status").isin(SUCCESS, FAILURE))
    counters = run_counters(ended).select(
        F.lit(1).alias("section"),
        F.concat_ws(",", "source", "status").alias("key"),
        F.format_string('etl_runs_total{source="%s",status="%s"} %d', "source", "status", "runs").alias("line"),
    )
    gauges = last_durations(ended).select(
        F.lit(2).alias("section"),
        F.col("source").alias("key"),
        F.format_string('etl_last_duration_seconds{source="%s"} %.3f', "source", "duration_seconds").alias("line"),
    )
    return counters.unionByName(gauges)


def write_metrics(runs: DataFrame, path: str) -> None:
    """Write the lines, with help and type headers, as one sorted text file (a few lines per source)."""
    # Metric names, help texts and types.
    headers = runs.sparkSession.createDataFrame(
        [
            (1, " 0", "# HELP etl_runs_total Total number of ETL runs"),
            (1, " 1", "# TYPE etl_runs_total counter"),
            (1, "~", ""),
            (2, " 0", "# HELP etl_last_duration_seconds Duration of last ETL run in seconds"),
            (2, " 1", "# TYPE etl_last_duration_seconds gauge"),
        ],
        "section int, key string, line string",
    )
    lines = headers.unionByName(metrics_lines(runs)).orderBy("section", "key").select("line")
    lines.coalesce(1).write.mode("overwrite").text(path)


def health(runs: DataFrame) -> DataFrame:
    """State of the last run; "degraded" when it failed, "healthy" otherwise and when there is none."""
    last = F.max_by(
        F.struct("status", "source", "completed_at", "records_processed", "error_message"),
        F.struct(F.col("started_at"), -F.col("id")),
    )
    return runs.agg(last.alias("last")).select(
        F.when(F.col("last.status") == FAILURE, "degraded").otherwise("healthy").alias("status"),
        F.col("last.status").alias("last_run_status"),
        F.col("last.source").alias("last_run_source"),
        F.col("last.completed_at").alias("last_run_at"),
        F.col("last.records_processed").alias("records_processed"),
        F.col("last.error_message").alias("error_message"),
    )
