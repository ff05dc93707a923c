"""CSV feed reader.

Only headers pass through the driver. The files are read by Spark, split at line ends, but for those in
which a quoted field holds a line break; they are looked for first because they cannot be split.
"""

from __future__ import annotations

import csv
import io
import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import OVERFLOW
from ..workspace import list_files, read_head

SNIFF_BYTES = 1024
MAX_HEADER_BYTES = 1 << 26
DELIMITERS = ",;\t"
_CORRUPT = "_corrupt"


class FeedError(ValueError):
    """A feed that cannot be read at all; single bad rows are quarantined instead."""


def arrival_column(position: Column, block_start: Column) -> Column:
    """Total order of feed rows: file time, file, place in the file."""
    return F.struct(
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file"),
        block_start.alias("block"),
        position.alias("position"),
    )


def _header(spark: SparkSession, path: str, sep: str) -> tuple[str, str, tuple[str, ...]] | None:
    """Separator, quote character and raw column names of one file; None when it is empty."""
    size = SNIFF_BYTES
    head = read_head(spark, path, size).decode("utf-8", errors="ignore")
    if not head.strip():
        return None
    quote = '"'
    if sep == "auto":
        try:
            dialect = csv.Sniffer().sniff(head, delimiters=DELIMITERS)
        except csv.Error as problem:
            raise FeedError(f"Failed to read CSV file: {path}: {problem}") from problem
        sep, quote = dialect.delimiter, dialect.quotechar or '"'
    while "\n" not in head and len(head) >= size // 4:
        if size >= MAX_HEADER_BYTES:
            raise FeedError(f"CSV header is longer than {MAX_HEADER_BYTES} bytes: {path}")
        size *= 4
        longer = read_head(spark, path, size).decode("utf-8", errors="ignore")
        if longer == head:
            break
        head = longer
    names = next(csv.reader(io.StringIO(head), delimiter=sep, quotechar=quote))
    return sep, quote, tuple(name.strip().lower() for name in names)


def _unique(names: tuple[str, ...]) -> tuple[list[str], list[str]]:
    """Schema names for reading, and for each distinct header name the last column that has it."""
    physical = [f"c{index}" for index in range(len(names))]
    last = dict(zip(names, physical))
    return physical, [last[name] for name in dict.fromkeys(names)]


def _plain(path: str) -> str:
    """One spelling for a file, whether listed or from the metadata column."""
    return unquote(re.sub(r"^file:/+", "/", path))


def _with_breaks(spark: SparkSession, paths: list[str], quote: str) -> set[str]:
    """Files in which some line holds an odd number of quotes, so a field runs over the line end."""
    lines = spark.read.text(paths)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    found = lines.where(quotes % 2 == 1).select("_metadata.file_path").distinct().collect()  # one row a file at most
    return {_plain(row[0]) for row in found}


def read_csv_feed(
    spark: SparkSession, path: str | list[str], sep: str = "auto", multiline: bool | str = "auto"
) -> DataFrame:
    """All-string columns with trimmed, lower-cased names, plus ``arrival`` (row order) and OVERFLOW.

    ``path`` is a file, a directory, a glob or a list of files. Each file may have its own separator and
    columns. ``multiline`` may be fixed when the caller knows whether quoted fields span lines.
    """
    files = list_files(spark, path) if isinstance(path, str) else path
    if not files:
        raise FeedError(f"CSV file not found: {path}")
    rows = read_csv_files(spark, files, sep, multiline)
    if rows is None:
        raise FeedError(f"CSV file is empty: {path}")
    return rows


def read_csv_files(
    spark: SparkSession, files: list[str], sep: str = "auto", multiline: bool | str = "auto"
) -> DataFrame | None:
    """The rows of the given files, each read by its own header; None when all of them are empty."""
    groups: dict[tuple, list[str]] = defaultdict(list)
    with ThreadPoolExecutor(16) as pool:
        for name, header in zip(files, pool.map(lambda f: _header(spark, f, sep), files)):
            if header is not None:
                groups[header].append(name)
    parts = []
    for (delimiter, quote, names), members in groups.items():
        if multiline == "auto":
            broken = _with_breaks(spark, members, quote)
            spans = [(True, [f for f in members if _plain(f) in broken]), (False, [f for f in members if _plain(f) not in broken])]
        else:
            spans = [(bool(multiline), members)]
        parts += [_read_group(spark, own, names, delimiter, quote, whole) for whole, own in spans if own]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def _read_group(
    spark: SparkSession, files: list[str], names: tuple[str, ...], sep: str, quote: str, multiline: bool
) -> DataFrame:
    """Files with one header. ``multiline`` files are read whole, one task each."""
    physical, kept = _unique(names)
    options = {"sep": sep, "quote": quote, "escape": quote}
    rows = (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in [*physical, _CORRUPT]]))
        .options(**options)
        .option("header", "true")
        .option("enforceSchema", "true")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("multiLine", str(multiline).lower())
        .csv(files)
    )
    # Rows with fewer or more cells than names come with their text; one more cell is enough to tell.
    wider = ", ".join(f"{c} string" for c in [*physical, "extra"])
    beyond = F.from_csv(F.col(_CORRUPT), wider, options)
    overflow = F.when(F.col(_CORRUPT).isNotNull() & beyond.getField("extra").isNotNull(), F.col(_CORRUPT))
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return rows.select(
        *[F.col(c).alias(name) for c, name in zip(kept, dict.fromkeys(names))],
        arrival_column(in_partition, F.col("_metadata.file_block_start")).alias("arrival"),
        overflow.alias(OVERFLOW),
    )
