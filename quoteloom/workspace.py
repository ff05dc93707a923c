"""Scratch tables in the shared folder that the cluster names in ``spark.checkpoint.dir``.

A frame that several later plans read, or whose row ids must not move, is written there once and
read back. That cuts its lineage, survives the loss of executors, and gives Catalyst the true file
size, so a following join is broadcast only when the written table is below
``spark.sql.autoBroadcastJoinThreshold``. Beyond that size AQE can split the hot keys of the other
side, which it cannot do while an aggregate stands between the lookup's shuffle and the join.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_scope: ContextVar[str | None] = ContextVar("scratch_scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quoteloom-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path: in the current scope, else in the application's own folder, which can go once the
    application has ended."""
    base = _scope.get() or f"{shared_folder(spark)}/quoteloom-{spark.sparkContext.applicationId}"
    return f"{base}/{uuid.uuid4().hex}/{label}"


@contextmanager
def scratch_scope(spark: SparkSession, label: str) -> Iterator[str]:
    """Scratch tables written inside are deleted at the end; frames that read them must be done."""
    path = scratch_path(spark, label)
    token = _scope.set(path)
    try:
        yield path
    finally:
        _scope.reset(token)
        remove_path(spark, path)


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet (to a scratch path unless given) and return the written table."""
    path = path or scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    _, target, fs = _file_system(spark, path)
    return fs.exists(target)


@dataclass(frozen=True)
class ContentSize:
    is_folder: bool
    files: int
    length: int


def content_size(spark: SparkSession, path: str) -> ContentSize:
    """Whether ``path`` is a folder, and how many files and bytes lie at or below it."""
    _, target, fs = _file_system(spark, path)
    summary = fs.getContentSummary(target)
    return ContentSize(fs.getFileStatus(target).isDirectory(), summary.getFileCount(), summary.getLength())


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, sorted; empty when the path does not exist."""
    _, target, fs = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Like ``list_children``, in a fixed number of calls, for folders whose names this library gave."""
    jvm, target, fs = _file_system(spark, path)
    if not fs.exists(target):
        return []
    paths = jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(target))
    found = jvm.scala.collection.mutable.ArraySeq.make(paths).mkString("\n")
    return sorted(child.rsplit("/", 1)[1] for child in found.split("\n") if child)


def read_text(spark: SparkSession, path: str) -> str:
    jvm, target, fs = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole or not at all; FileExistsError when there is one already."""
    jvm, target, fs = _file_system(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(draft, target, options)
    except Exception as problem:
        fs.delete(draft, False)
        if fs.exists(target):
            raise FileExistsError(path) from problem
        raise


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that this library wrote."""
    _, target, fs = _file_system(spark, path)
    fs.delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Replace ``target`` by ``source``; the parent folder is made when missing."""
    jvm, start, fs = _file_system(spark, source)
    end = jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(end.getParent())
    fs.delete(end, True)
    if not fs.rename(start, end):
        raise OSError(f"cannot move {source} to {target}")


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the data files of ``source`` into the folder ``target``, beside what is there.

    Spark gives every data file a name of its own, so a move that was interrupted can be repeated.
    """
    jvm, start, fs = _file_system(spark, source)
    if not fs.exists(start):
        return
    end = jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(end)
    for status in fs.listStatus(start):
        name = status.getPath().getName()
        if name.startswith("part-") and not fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(end, name)):
            raise OSError(f"cannot move {source}/{name} to {target}")


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Every data file under ``path`` (a file, a directory or a glob), sorted; hidden files are left out."""
    jvm, target, fs = _file_system(spark, path)
    found = []
    for status in fs.globStatus(target) or []:
        if status.isFile():
            found.append(status.getPath().toString())
            continue
        walker = fs.listFiles(status.getPath(), True)
        while walker.hasNext():
            child = walker.next().getPath()
            if not child.getName().startswith(("_", ".")):
                found.append(child.toString())
    return sorted(found)


def set_file_times(spark: SparkSession, path: str, time: datetime) -> None:
    """Give every file directly below ``path`` one modification time."""
    jvm, target, fs = _file_system(spark, path)
    for status in fs.listStatus(target):
        if status.isFile():
            fs.setTimes(status.getPath(), int(time.timestamp() * 1000), -1)


def read_head(spark: SparkSession, path: str, size: int) -> bytes:
    """The first ``size`` bytes of one file."""
    jvm, target, fs = _file_system(spark, path)
    stream = fs.open(target)
    try:
        length = int(min(size, fs.getFileStatus(target).getLen()))
        limited = jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length)
        return bytes(limited)
    finally:
        stream.close()
