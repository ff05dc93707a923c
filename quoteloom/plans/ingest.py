"""The ingest job: one feed into the tables, as one run of the ledger."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import drift, identity, merge, normalize, quality, runs
from ..schemas import FAILURE, LATE, LEDGER, MAX_ERROR_LENGTH, OVERFLOW, QUOTE_KEY, RUNNING, SUCCESS
from ..session import tune
from ..sources.commits import Batch, Head
from ..sources.landing import list_feed
from ..sources.registry import FeedSpec, get_source
from ..sources.store import Stage, Store, with_event_date
from ..workspace import materialize, remove_path, scratch_scope

log = logging.getLogger(__name__)
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


class RunFailed(RuntimeError):
    """A run that ended in failure; the ledger holds the (shortened) message."""


@dataclass(frozen=True)
class RunResult:
    """``newest`` is the newest time that a row brought with it, ``checkpoint`` that of any row."""

    job_id: int
    source: str
    status: str
    records_processed: int
    rows_read: int
    rows_rejected: int
    duplicates_dropped: int
    checkpoint: datetime | None
    newest: datetime | None = None


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _ledger_row(**fields) -> dict:
    unknown = set(fields) - set(LEDGER.fieldNames())
    if unknown:
        raise TypeError(f"no columns of the ledger: {sorted(unknown)}")
    message = fields.get("error_message")
    if message is not None and len(message) > MAX_ERROR_LENGTH:
        fields["error_message"] = message[:MAX_ERROR_LENGTH] + "..."
    return fields


def start_job(
    store: Store, source: str, run_ts: datetime, batch_id: int | None = None, stream_id: str | None = None
) -> int:
    """Open a run and return its id. Runs of one store are opened one at a time."""
    head = store.log.head()
    job_id = head.last_job + 1
    row = _ledger_row(
        id=job_id, source=source, status=RUNNING, records_processed=0, started_at=run_ts,
        batch_id=batch_id, stream_id=stream_id, revision=0,
    )
    store.log.commit(head, row, last_job=job_id, open_job=job_id)
    return job_id


def _closed(
    job_id: int,
    source: str,
    status: str,
    started_at: datetime,
    completed_at: datetime,
    records: int = 0,
    checkpoint: datetime | None = None,
    error: str | None = None,
    batch_id: int | None = None,
    stream_id: str | None = None,
) -> dict:
    """The ledger row that closes a run."""
    return _ledger_row(
        id=job_id, source=source, status=status, last_processed_timestamp=checkpoint,
        records_processed=records, started_at=started_at, completed_at=completed_at,
        error_message=error, batch_id=batch_id, stream_id=stream_id, revision=1,
    )


def finish_job(store: Store, *args, **fields) -> None:
    """Close a run that leaves nothing to publish; takes the arguments of ``_closed``."""
    store.log.commit(store.log.head(), _closed(*args, **fields), open_job=None)


def recover(store: Store) -> list[int]:
    """Close a run that died as a failure, and return its id.

    Runs of one store are serial, so a run that is still open when another begins has died. Its commit
    does not exist, so no reader has seen anything of it; ``Store.vacuum`` deletes what it wrote.
    """
    head = store.log.head()
    if head.open_job is None:
        return []
    row = store.runs().where(F.col("id") == head.open_job).first()
    closing = _closed(
        row["id"], row["source"], FAILURE, row["started_at"], row["started_at"],
        error="interrupted before its commit", batch_id=row["batch_id"], stream_id=row["stream_id"],
    )
    store.log.commit(head, closing, open_job=None)
    return [head.open_job]


def checkpoint_of(store: Store, source: str, literal: bool = False) -> datetime | None:
    """Checkpoint for the next run; ``literal`` also honours successful runs that found nothing."""
    picked = runs.latest_checkpoint if literal else runs.carried_checkpoint
    row = picked(store.runs(), source).first()
    return row["checkpoint"].replace(tzinfo=timezone.utc) if row and row["checkpoint"] else None


def _drift_rows(spec: FeedSpec, rows: DataFrame, run_ts: datetime) -> DataFrame:
    if spec.columnar:
        return drift.detect(rows.select("raw.*"), spec.expected_columns, run_ts)
    return drift.detect_json(rows, spec.expected_columns, run_ts)


def load_batch(
    store: Store,
    source: str,
    raw: DataFrame | None,
    spec: FeedSpec,
    job_id: int,
    run_ts: datetime,
    use_record_source_id: bool = False,
    completed_at: datetime | None = None,
    files: DataFrame | None = None,
    part: StreamPart | None = None,
) -> RunResult:
    """Normalize, check, resolve and upsert one batch of raw feed rows, and close its run.

    The rows are parsed once, into the run's part of the audit table, of which all later steps read
    only the columns they need. New coins, new mappings, the touched buckets of quotes and the log of the
    ``files`` that were read are written where no reader looks; one commit with the run's ledger row publishes them.
    An error before it leaves the tables as they were. ``raw`` is None where there is nothing to read;
    ``part`` says which batch of which stream it is.
    """
    stage = store.stage(f"run-{job_id}")
    part = part or StreamPart()
    with scratch_scope(store.spark, f"run-{job_id}"):
        if raw is None:
            result = RunResult(job_id, source, SUCCESS, 0, 0, 0, 0, None)
        else:
            result = _load(stage, source, raw, spec, job_id, run_ts, use_record_source_id, part.late_before)
        if files is not None:
            stage.add_rows("loaded_files", files)
    closing = _closed(
        job_id, source, SUCCESS, run_ts, completed_at or _now(), result.records_processed, result.checkpoint,
        batch_id=part.batch_id, stream_id=part.stream_id,
    )
    stage.commit(closing, open_job=None, **part.done(stage.head, result.newest))
    return result


@dataclass(frozen=True)
class StreamPart:
    """One batch of a stream: rows before ``late_before`` are too late for it."""

    stream_id: str | None = None
    batch_id: int | None = None
    late_before: datetime | None = None

    def done(self, head: Head, newest: datetime | None) -> dict:
        """What the commit remembers, so that the batch is loaded once and the next knows what is late."""
        if self.stream_id is None:
            return {}
        before = head.streams.get(self.stream_id)
        times = [t for t in (before.newest if before else None, to_micros(newest)) if t is not None]
        return {"streams": {**head.streams, self.stream_id: Batch(self.batch_id, max(times, default=None))}}


def to_micros(time: datetime | None) -> int | None:
    return None if time is None else round((time - _EPOCH) / timedelta(microseconds=1))


def from_micros(micros: int | None) -> datetime | None:
    return None if micros is None else _EPOCH + timedelta(microseconds=micros)


def _load(
    stage: Stage, source: str, raw: DataFrame, spec: FeedSpec, job_id: int, run_ts: datetime,
    use_record_source_id: bool, late_before: datetime | None,
) -> RunResult:
    store = stage.store
    now: Column = F.lit(run_ts).cast("timestamp")
    if spec.columnar:  # the drift check needs the feed's own columns
        raw = raw.withColumn("raw", F.struct(*[F.col(f"`{c}`") for c in raw.columns if c not in ("arrival", OVERFLOW)]))
    # The audit rows, written once with their parsed columns; they count when the run succeeds.
    audit_path = store.run_path("raw", source, job_id)
    parsed = spec.normalize(raw, source, now).drop("source").withColumn("created_at", now)
    if late_before is not None:
        late = F.col("reject_reason").isNull() & (F.col("timestamp") < F.lit(late_before).cast("timestamp"))
        parsed = parsed.withColumn("reject_reason", F.when(late, LATE).otherwise(F.col("reject_reason")))
    passed = F.col("reject_reason").isNull()
    seen = Observation("rows")
    parsed = parsed.observe(
        seen,
        F.count(F.lit(1)).alias("read"),
        F.count_if(passed).alias("good"),
        F.max(F.when(passed, F.unix_micros("timestamp"))).alias("newest"),
        # Rows without a time of their own stand at the time of the run.
        F.max(F.when(passed & (F.col("timestamp") != now), F.unix_micros("timestamp"))).alias("newest_dated"),
    )
    rows = materialize(parsed, "rows", audit_path).withColumn("source", F.lit(source))
    totals = seen.get
    good = normalize.accepted(rows)
    if totals["good"] == 0:
        if totals["read"] == 0:
            remove_path(store.spark, audit_path)
        return RunResult(job_id, source, SUCCESS, 0, totals["read"], totals["read"], 0, None)

    try:
        found = _drift_rows(spec, rows, run_ts)
        materialize(found, "drift", store.run_path("drift_log", source, job_id))
    except Exception as problem:  # a failed drift check never stops a run
        log.warning("%s: drift check failed: %s", source, problem)

    coins = store.read("coins")
    resolution = identity.resolve_entities(
        good, coins, store.read("mappings"), rows, use_record_source_id, run_ts=now
    )
    if resolution.creates:
        quality.assert_insertable(resolution.new_coins, coins, ["slug"], "coin slug")
        stage.add_rows("coins", resolution.new_coins)
    if resolution.links:
        stage.add_rows("mappings", resolution.new_mappings)

    quotes = resolution.attach(good).select(
        *QUOTE_KEY, "symbol", "price_usd", "market_cap", "volume_24h", "arrival"
    )
    batch = merge.last_per_key(quotes, QUOTE_KEY, keep_arrival=False).withColumn("ingested_at", now)
    affected = stage.upsert_quotes(materialize(with_event_date(batch), "batch"))
    checkpoint = from_micros(totals["newest"])
    return RunResult(
        job_id, source, SUCCESS, affected, totals["read"], totals["read"] - totals["good"],
        totals["good"] - affected, checkpoint, from_micros(totals["newest_dated"]),
    )


def _new_files(store: Store, source: str, spec: FeedSpec, path: str, everything: bool):
    """What a run has to read: the path (None: nothing new), and the files to note as loaded.

    Files that an earlier successful run of the source has read, with the same time and length, are left
    out by a join of two listings; only the names of new ones get to the driver. A first or full run
    reads the path as a whole.
    """
    if not spec.reads_files:
        return path, None
    found = list_feed(store.spark, path, source)
    if found is None:
        return path, None  # nothing there: the reader says what is wrong
    loaded = store.read("loaded_files").where(F.col("source") == source)
    if everything or loaded.isEmpty():
        return path, found
    new = materialize(found.join(loaded, ["source", "path", "modified", "length"], "left_anti"), "new_files")
    names = sorted(row[0] for row in new.select("path").collect())  # as many as there are new files
    return (names, new) if names else (None, None)


def run_source(
    store: Store,
    source: str,
    path: str,
    force_full: bool = False,
    run_ts: datetime | None = None,
    use_record_source_id: bool = False,
    spec: FeedSpec | None = None,
) -> RunResult:
    """Run one source. Raises RunFailed after the failure is in the ledger; all tables are then as before.

    Landing files that an earlier run has loaded are not read again unless ``force_full``. ``spec`` may
    replace the registered one, for example to read another page layout.
    """
    spec = spec or get_source(source)
    tune(store.spark)
    recover(store)
    started = run_ts or _now()
    job_id = start_job(store, source, started)
    try:
        with scratch_scope(store.spark, f"files-{job_id}"):
            checkpoint = None if force_full else checkpoint_of(store, source)
            wanted, files = _new_files(store, source, spec, path, force_full)
            raw = None if wanted is None else spec.newer(spec.read(store.spark, wanted), checkpoint)
            return load_batch(store, source, raw, spec, job_id, started, use_record_source_id, run_ts, files)
    except Exception as problem:
        raise fail_run(store, job_id, source, started, _finished(run_ts), problem) from problem


def fail_run(
    store: Store, job_id: int, source: str, started: datetime, completed: datetime, problem: Exception,
    part: StreamPart | None = None,
) -> RunFailed:
    """Close a run after an error; returns what to raise.

    A commit may have been made although it raised an error: then the run is closed, and a success.
    """
    if store.log.head().open_job == job_id:
        part = part or StreamPart()
        finish_job(
            store, job_id, source, FAILURE, started, completed, error=str(problem),
            batch_id=part.batch_id, stream_id=part.stream_id,
        )
    return RunFailed(f"ETL failed for {source}: {problem}")


def _finished(run_ts: datetime | None) -> datetime:
    """A fixed run time also fixes the completion time, for repeatable results."""
    return run_ts or _now()


def run_all(
    store: Store,
    paths: Mapping[str, str],
    sources: list[str] | None = None,
    force_full: bool = False,
    run_ts: datetime | None = None,
) -> dict[str, RunResult | RunFailed]:
    """Run several sources in turn; one that fails does not stop the others.

    In turn because all of them may create coins in the one master table. Each run by itself uses
    the whole cluster.
    """
    results: dict[str, RunResult | RunFailed] = {}
    for source in sources or list(paths):
        try:
            results[source] = run_source(store, source, paths[source], force_full, run_ts)
        except RunFailed as problem:
            log.error("%s", problem)
            results[source] = problem
    return results
