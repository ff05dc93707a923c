"""The tables of one deployment, as parquet below one root path.

Coins, mappings, quotes and the log of loaded files consist of the folders that the newest commit names
(``commits``): writing adds folders, publishing is one commit, and readers never see half of either.
A day of quotes is dealt into buckets by key, the more the larger it is, and an upsert writes only the
buckets anew that it touches. Audit and drift rows lie in a folder for each run and count
once their run is a success.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import merge, runs
from ..workspace import list_names, materialize, path_exists, remove_path
from .commits import Batch, CommitLog, Entry, Head, day_text

SCHEMAS = {
    "coins": schemas.COINS,
    "mappings": schemas.MAPPINGS,
    "quotes": schemas.QUOTES,
    "loaded_files": schemas.LOADED_FILES,
    "raw": schemas.RAW,
    "drift_log": schemas.DRIFT_LOG,
}
#: Tables in a folder for each run, which hold the rows of runs that failed as well.
BY_RUN = ("raw", "drift_log")
#: Rows of quotes in a bucket, about; a day is dealt anew once its buckets hold twice as many.
BUCKET_ROWS = 4_000_000
#: Folders of a small table; the next write after so many makes them one.
MOST_PARTS = 32


def raw_rows(df: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Audit rows: source and the verbatim payload.

    A ``payload`` column is taken as it is; otherwise all columns but the source are packed into one
    JSON object, null fields included.
    """
    if "payload" in df.columns:
        payload = F.col("payload")
    else:
        packed = [F.col(f"`{c}`") for c in df.columns if c not in ("source", "arrival", schemas.OVERFLOW)]
        payload = F.to_json(F.struct(*packed), {"ignoreNullFields": "false"})
    created = created_at if created_at is not None else F.lit(None).cast("timestamp")
    return df.select("source", payload.alias("payload"), created.alias("created_at"))


class Stage:
    """What a commit will change: folders that are written already, but that no reader sees yet."""

    def __init__(self, store: Store, label: str):
        self.store, self.log = store, store.log
        self.head: Head = self.log.head()
        self.entries = list(self.log.entries(self.head))
        self.name = f"{label}-{uuid.uuid4().hex[:12]}"
        self.changed = False

    def add_rows(self, table: str, rows: DataFrame) -> None:
        """Write rows that an unpartitioned table gains."""
        schema = SCHEMAS[table]
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        parts = [e for e in self.entries if e.table == table]
        if len(parts) >= MOST_PARTS:
            typed = self.store.read_entries(table, parts).unionByName(typed).hint("rebalance")
            self.entries = [e for e in self.entries if e.table != table]
        path = f"{self.store.path(table)}/part={self.name}"
        materialize(typed, table, path)
        self.entries.append(Entry(table, path))
        self.changed = True

    def compact(self, table: str) -> None:
        """Write an unpartitioned table (a small folder for each run) anew as one folder."""
        parts = [e for e in self.entries if e.table == table]
        if table == "quotes" or table not in SCHEMAS or table in BY_RUN:
            raise ValueError(f"{table} is partitioned")
        if parts:
            path = f"{self.store.path(table)}/part={self.name}"
            materialize(self.store.read_entries(table, parts).hint("rebalance"), table, path)
            self.entries = [e for e in self.entries if e.table != table] + [Entry(table, path)]
            self.changed = True

    def upsert_quotes(self, batch: DataFrame) -> int:
        """Write the buckets that ``batch`` touches as they will be; returns its number of rows.

        ``batch`` has unique keys and an event_date; rows without a time have a day of their own. Only
        the touched buckets are read and joined. A day that has outgrown its buckets is dealt anew.
        """
        per_day = {row[0]: row[1] for row in batch.groupBy("event_date").count().collect()}  # one row per day
        if not per_day:
            return 0
        live = defaultdict(list)
        for entry in self.entries:
            if entry.table == "quotes":
                live[entry.day].append(entry)
        buckets = {day: self._buckets(live[day_text(day)], rows) for day, rows in per_day.items()}
        dealt = with_bucket(batch, buckets)
        touched = {(day_text(day), 0) for day, number in buckets.items() if number == 1}
        if any(number > 1 for number in buckets.values()):
            found = dealt.where("buckets > 1").select("event_date", "bucket").distinct().collect()  # one row a bucket
            touched |= {(day_text(day), bucket) for day, bucket in found}
        old = [
            e
            for day, number in buckets.items()
            for e in live[day_text(day)]
            if e.buckets != number or (e.day, e.bucket) in touched
        ]
        target = self.store.read_entries("quotes", old)
        merged = with_bucket(merge.merge_rows(target, batch.select(*target.columns)), buckets).drop("buckets")
        path = f"{self.store.path('quotes')}/part={self.name}"
        _by_cell(merged).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            "event_date", "bucket"
        ).parquet(path)
        written = self.store.spark.read.schema(T.StructType([*schemas.QUOTES, T.StructField("bucket", T.IntegerType())])).parquet(path)
        cells = written.groupBy("event_date", "bucket").count().collect()  # from the files' footers
        gone = {e.path for e in old}
        self.entries = [e for e in self.entries if e.path not in gone]
        for day, bucket, rows in cells:
            folder = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
            self.entries.append(
                Entry("quotes", f"{path}/event_date={folder}/bucket={bucket}", rows, day_text(day), bucket, buckets[day])
            )
        self.changed = True
        return sum(per_day.values())

    def _buckets(self, live: list[Entry], added: int) -> int:
        """The number of buckets of a day, a power of two; it grows with the day and never shrinks."""
        number, rows = (live[0].buckets if live else 1), sum(e.rows for e in live) + added
        while rows > 2 * self.store.bucket_rows * number:
            number *= 2
        return number

    def commit(self, ledger: dict | None = None, **changes) -> Head:
        """Publish all of it, with a row of the ledger, at once."""
        if self.changed:
            self.log.write_manifest(self.name, self.entries)
            changes["manifest"] = self.name
        return self.log.commit(self.head, ledger, **changes)


class Store:
    """Reads give an empty frame while a table has no data. A read frame stays as of its commit."""

    def __init__(self, spark: SparkSession, root: str, bucket_rows: int = BUCKET_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_rows = bucket_rows
        self.log = CommitLog(spark, self.root)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        if table == "ledger":
            return self.log.ledger()
        if table in BY_RUN:
            schema = SCHEMAS[table]
            if not path_exists(self.spark, self.path(table)):
                return self.spark.createDataFrame([], schema)
            return self.spark.read.schema(schema).parquet(self.path(table)).select(*schema.fieldNames())
        return self.read_entries(table, [e for e in self.log.entries() if e.table == table])

    def read_entries(self, table: str, entries: list[Entry]) -> DataFrame:
        """The rows of some of a table's folders."""
        schema = SCHEMAS[table]
        if not entries:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        return reader.parquet(*[e.path for e in entries]).select(*schema.fieldNames())

    def stage(self, label: str = "data") -> Stage:
        return Stage(self, label)

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows to a table and publish them; quotes must have new keys or replace those they meet."""
        stage = self.stage("append")
        if table == "quotes":
            stage.upsert_quotes(rows)
        else:
            stage.add_rows(table, rows)
        stage.commit()

    def run_path(self, table: str, source: str, job_id: int) -> str:
        """Folder of one run's rows in a table that is partitioned by source and run."""
        return f"{self.path(table)}/source={source}/job_id={job_id}"

    # Runs

    def runs(self) -> DataFrame:
        """Current state of every run."""
        return runs.latest_state(self.read("ledger"))

    def committed(self, table: str) -> DataFrame:
        """Rows of ``raw`` or ``drift_log`` written by successful runs that loaded something."""
        done = self.runs().where((F.col("status") == schemas.SUCCESS) & (F.col("records_processed") > 0))
        return self._of_runs(self.read(table), done)

    def quarantine(self) -> DataFrame:
        """The rejected rows of successful runs, with the reason."""
        done = self.runs().where(F.col("status") == schemas.SUCCESS)
        return self._of_runs(self.read("raw").where("reject_reason IS NOT NULL"), done)

    def _of_runs(self, rows: DataFrame, done: DataFrame) -> DataFrame:
        ids = materialize(done.select(F.col("id").alias("job_id")), "run_ids")
        return rows.join(ids, "job_id", "left_semi")

    def last_batch(self, stream: str) -> Batch:
        """The last batch of a stream that was committed; number -1 when there is none."""
        return self.log.head().streams.get(stream, Batch(-1))

    # Quotes

    def stage_quotes(self, batch: DataFrame, label: str | int = "quotes") -> Stage:
        """Write what the touched buckets will hold after the upsert; readers see the table as it is."""
        stage = self.stage(str(label))
        stage.upsert_quotes(batch)
        return stage

    def publish_quotes(self, stage: Stage) -> None:
        stage.commit()

    # Upkeep

    def clear_drift_log(self) -> None:
        remove_path(self.spark, self.path("drift_log"))

    def compact(self, table: str) -> None:
        """Rewrite a table of one small folder for each run as one folder, published as any change."""
        stage = self.stage("compact")
        stage.compact(table)
        stage.commit()

    def vacuum(self) -> list[str]:
        """Delete the folders that the newest commit does not name, and return them.

        Readers of earlier commits lose their files, and so does a stage that is still being written:
        to be run while neither is at work.
        """
        live = {e.path for e in self.log.entries()}
        removed = []
        for table in (t for t in SCHEMAS if t not in BY_RUN):
            for part in list_names(self.spark, self.path(table)):
                path = f"{self.path(table)}/{part}"
                held = [e for e in live if e == path or e.startswith(f"{path}/")]
                if not held:
                    removed.append(path)
                elif table == "quotes" and held != [path]:
                    removed += self._dead_cells(path, set(held))
        for path in removed:
            remove_path(self.spark, path)
        return removed

    def _dead_cells(self, part: str, live: set[str]) -> list[str]:
        days = [f"{part}/{day}" for day in list_names(self.spark, part) if day.startswith("event_date=")]
        cells = [f"{day}/{cell}" for day in days for cell in list_names(self.spark, day)]
        return [cell for cell in cells if cell not in live]


def _by_cell(quotes: DataFrame) -> DataFrame:
    """Cluster rows by day and bucket for writing: AQE splits a large one over tasks and merges small ones."""
    return quotes.hint("rebalance", F.col("event_date"), F.col("bucket"))


def with_bucket(quotes: DataFrame, buckets: dict) -> DataFrame:
    """Add ``buckets``, the number of buckets of the row's day, and ``bucket``, which the key decides."""
    several = [(day, number) for day, number in buckets.items() if number > 1]
    if not several:
        return quotes.withColumn("buckets", F.lit(1)).withColumn("bucket", F.lit(0))
    days = quotes.sparkSession.createDataFrame(several, "_day date, buckets int")  # one row per large day
    known = quotes.join(days, quotes["event_date"].eqNullSafe(days["_day"]), "left").drop("_day")
    number = F.coalesce("buckets", F.lit(1))
    key = F.xxhash64(*schemas.QUOTE_KEY)
    return known.withColumn("buckets", number).withColumn("bucket", F.pmod(key, F.col("buckets")).cast("int"))


def with_event_date(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("event_date", F.to_date("timestamp"))
