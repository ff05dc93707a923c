"""Streams from a landing directory into the tables.

The stream checkpoint remembers which files were read. A batch's commit in the store names the stream
and the batch, so one that Spark delivers again, because it failed before it could note the batch as done,
opens no run and changes nothing. A stream whose checkpoint was lost is another stream: it loads the files
again, over the same keys. Late rows are kept unless ``late_after`` (see ``_load``) or ``drop_late`` say otherwise.
One query per store: each batch may add coins.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import merge
from ..plans.ingest import StreamPart, checkpoint_of, fail_run, from_micros, load_batch, recover, start_job
from ..schemas import QUOTE_KEY
from ..sources.csv_feed import read_csv_files
from ..sources.json_feeds import json_items, page_options
from ..sources.registry import get_source
from ..sources.store import Store, with_event_date
from ..workspace import materialize, read_text


def _trigger(writer, interval: str | None):
    """Run until all present files are read, or at an interval."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def _stream_id(store: Store, checkpoint: str) -> str:
    """The id that Spark gives a stream when its checkpoint is made, and that lives as long as it."""
    return json.loads(read_text(store.spark, f"{checkpoint}/metadata").splitlines()[-1])["id"]


def _load(
    store: Store, source: str, checkpoint: str, drop_late: bool, late_after: timedelta | None, run_ts: datetime | None
):
    """The function that loads one batch as one run.

    With ``late_after``, rows older than the newest event time of the stream's earlier batches by more
    than that go to the quarantine as ``late``; the others enter, in whatever order they come. The newest time is
    part of each batch's commit, so the bound moves exactly when a batch is in the tables and survives
    restarts. (Spark's own watermark would let such rows vanish.)
    """
    spec = get_source(source)

    def batch(rows: DataFrame, batch_id: int) -> None:
        stream = _stream_id(store, checkpoint)
        last = store.last_batch(stream)
        if batch_id <= last.number:
            return
        started = run_ts or datetime.now(timezone.utc)
        recover(store)
        job_id = start_job(store, source, started, batch_id, stream)
        bound = from_micros(last.newest) - late_after if late_after is not None and last.newest is not None else None
        part = StreamPart(stream, batch_id, bound)
        try:
            raw = spec.newer(rows, checkpoint_of(store, source)) if drop_late else rows
            load_batch(store, source, raw, spec, job_id, started, completed_at=run_ts, part=part)
        except Exception as problem:
            fail_run(store, job_id, source, started, started, problem, part)
            raise

    return batch


def stream_json(
    store: Store,
    source: str,
    landing: str,
    checkpoint: str,
    pages: str = "files",
    interval: str | None = None,
    drop_late: bool = False,
    late_after: timedelta | None = None,
    files_per_batch: int | None = None,
    run_ts: datetime | None = None,
) -> StreamingQuery:
    """JSON files of one source (one array per file or per line), loaded as they arrive."""
    reader = store.spark.readStream.options(**page_options(pages)).format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    pages_read = reader.load(landing).select("value", "_metadata")
    load = _load(store, source, checkpoint, drop_late, late_after, run_ts)

    def batch(part: DataFrame, batch_id: int) -> None:
        load(json_items(part), batch_id)

    writer = pages_read.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def stream_csv(
    store: Store,
    source: str,
    landing: str,
    checkpoint: str,
    sep: str = "auto",
    multiline: bool | str = "auto",
    interval: str | None = None,
    drop_late: bool = False,
    late_after: timedelta | None = None,
    files_per_batch: int | None = None,
    run_ts: datetime | None = None,
) -> StreamingQuery:
    """CSV files of one source, each read by its own header, as in batch.

    The stream finds the new files; a batch hands their paths (as many as it has files) to the reader.
    """
    reader = store.spark.readStream.format("text").option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    found = reader.load(landing).select("_metadata.file_path")
    load = _load(store, source, checkpoint, drop_late, late_after, run_ts)

    def batch(part: DataFrame, batch_id: int) -> None:
        files = sorted(unquote(row[0]) for row in part.distinct().collect())
        rows = read_csv_files(store.spark, files, sep, multiline) if files else None
        if rows is not None:
            load(rows, batch_id)

    writer = found.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def stream_table(
    store: Store,
    rows: DataFrame,
    checkpoint: str,
    keys: list[str] = QUOTE_KEY,
    interval: str | None = None,
) -> StreamingQuery:
    """Typed quote rows (a streaming frame with coin_id and arrival): last per key, then upsert."""

    def batch(part: DataFrame, batch_id: int) -> None:
        stream = _stream_id(store, checkpoint)
        if batch_id <= store.last_batch(stream).number:
            return
        recover(store)
        last = merge.last_per_key(part, keys, keep_arrival=False)
        stage = store.stage_quotes(materialize(with_event_date(last), "batch"), f"stream-{batch_id}")
        stage.commit(**StreamPart(stream, batch_id).done(stage.head, None))

    writer = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()
