"""Benchmark decontamination by winnowing.

A window is ten consecutive words of a benchmark item, or the whole item when it has fewer. Every
window of ten words holds seven grams of four; winnowing keeps the smallest gram hash of each window
as its fingerprint, so two equal windows always have equal fingerprints, wherever they stand.

1. The benchmark's windows and fingerprints become a table, and a Bloom filter whose size is bounded
   (``MAX_FILTER_BITS``); a larger benchmark makes the filter less selective, never wrong.
2. One pass over the documents keeps their fingerprints that the filter lets through, extends each
   over the windows it stands for, and keeps maximal runs of windows that the filter knows.
3. Equal runs are one row from here on, however many documents share them. Runs are joined with the
   benchmark's windows on (fingerprint, window), which settles what the filter let through by chance,
   and the confirmed stretches go back to the documents.

Windows are compared by 64-bit hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize, scratch_path, scratch_scope
from .words import ALPHANUMERIC, Chunk, chunks, gram_starts, grams, mix, signed

WINDOW = 10
GRAM = 4
MAX_FILTER_BITS = 1 << 26
_BITS_PER_ENTRY = 64


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    """The smallest gram hash of the window that starts at each word, across row borders."""
    own = grams(hashes, GRAM)
    size = len(hashes) - WINDOW + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    least = own[:size].copy()
    for k in range(1, WINDOW - GRAM + 1):
        np.minimum(least, own[k : k + size], out=least)
    return least


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _known(filter_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = len(filter_words) * 64
    found = np.ones(len(hashes), bool)
    for probe in _probes(hashes, bits):
        found &= (filter_words[(probe >> np.uint64(6)).astype(np.intp)] >> (probe & np.uint64(63))) & np.uint64(1) == 1
    return found


def item_windows(items: DataFrame, id_column: str) -> DataFrame:
    """(item, length, window, print) of each window of each item; items without words have none.

    The fingerprint of a window of ten is its smallest gram; a shorter item's is its own hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0), ALPHANUMERIC):
                ids = batch.column(1).slice(chunk.first, chunk.rows)
                hashes = chunk.word_hashes()
                for length in sorted({min(int(n), WINDOW) for n in chunk.counts if n}):
                    starts = gram_starts(chunk, length)
                    if length < WINDOW:
                        starts = starts[chunk.counts[chunk.row[starts]] == length]
                    windows = grams(hashes, length)[starts]
                    prints = fingerprints(hashes)[starts] if length == WINDOW else windows
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(chunk.row[starts])),
                            pa.array(np.full(len(starts), length, np.int32)),
                            pa.array(signed(windows)),
                            pa.array(signed(prints)),
                        ],
                        ["item", "length", "window", "print"],
                    )

    kind = items.schema[id_column].dataType.simpleString()
    return (
        items.select("text", id_column)
        .mapInArrow(run, f"item {kind}, length int, window bigint, print bigint")
        .distinct()
    )


def _filter(windows: DataFrame) -> np.ndarray:
    """A Bloom filter of window hashes and fingerprints, as 64-bit words."""
    entries = windows.select(F.col("window").alias("h")).union(windows.select(F.col("print").alias("h"))).distinct()
    wanted = max(entries.count(), 64) * _BITS_PER_ENTRY
    bits = min(1 << (wanted - 1).bit_length(), MAX_FILTER_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            probe = np.concatenate(_probes(hashes, bits))
            flags = np.uint64(1) << (probe & np.uint64(63))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(probe >> np.uint64(6))), pa.array(signed(flags))], ["place", "flags"]
            )

    # At most bits / 64 rows of two longs.
    rows = entries.mapInArrow(run, "place bigint, flags bigint").groupBy("place").agg(F.bit_or("flags").alias("flags"))
    found = rows.toArrow()
    filter_words = np.zeros(bits // 64, np.uint64)
    places = found.column("place").to_numpy()
    filter_words[places] = found.column("flags").to_numpy().view(np.uint64)
    return filter_words


def _candidate_starts(chunk: Chunk, hashes: np.ndarray, length: int, filter_words: np.ndarray):
    """Starts of windows that the filter knows, their hashes and fingerprints."""
    starts = gram_starts(chunk, length)
    if length == WINDOW:
        prints = fingerprints(hashes)
        # A fingerprint is tested once for the windows in a row that it stands for.
        changes = np.flatnonzero(np.diff(prints, prepend=~prints[:1]))
        known = np.repeat(_known(filter_words, prints[changes]), np.diff(np.append(changes, len(prints))))
        starts = starts[known[starts]]
        windows = _windows_at(hashes, starts)
        prints = prints[starts]
    else:
        windows = prints = grams(hashes, length)[starts]
    known = _known(filter_words, windows)
    return starts[known], windows[known], prints[known]


def _windows_at(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    if len(starts) * 4 > len(hashes):
        return grams(hashes, WINDOW)[starts]
    flat = hashes[starts[:, None] + np.arange(WINDOW)].ravel()
    return grams(flat, WINDOW)[::WINDOW]


def _runs(chunk: Chunk, hashes: np.ndarray, length: int, filter_words: np.ndarray) -> dict[int, list]:
    """For each row of the chunk its runs (length, start, windows, prints)."""
    starts, windows, prints = _candidate_starts(chunk, hashes, length, filter_words)
    found: dict[int, list] = {}
    if not len(starts):
        return found
    row = chunk.row[starts]
    cuts = np.flatnonzero((np.diff(starts) != 1) | (np.diff(row) != 0)) + 1
    for begin, end in zip(np.append(0, cuts), np.append(cuts, len(starts)), strict=True):
        own = int(row[begin])
        key = mix(grams(windows[begin:end], 1) * np.arange(1, 2 * (end - begin), 2, dtype=np.uint64))
        run_id = int(signed(mix(np.array([key.sum(dtype=np.uint64) + np.uint64(length)], np.uint64)))[0])
        found.setdefault(own, []).append(
            {
                "run": run_id,
                "length": length,
                "start": int(starts[begin] - chunk.offsets[own]),
                "windows": signed(windows[begin:end]).tolist(),
                "prints": signed(prints[begin:end]).tolist(),
            }
        )
    return found


_RUN = "struct<run:bigint,length:int,start:bigint,windows:array<bigint>,prints:array<bigint>>"
_RUN_ARROW = pa.list_(
    pa.struct(
        [
            ("run", pa.int64()),
            ("length", pa.int32()),
            ("start", pa.int64()),
            ("windows", pa.list_(pa.int64())),
            ("prints", pa.list_(pa.int64())),
        ]
    )
)


def document_runs(docs: DataFrame, id_column: str, lengths: list[int], filter_words: np.ndarray) -> DataFrame:
    """id, text_key, n_words and candidate runs of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(filter_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0), ALPHANUMERIC):
                hashes = chunk.word_hashes()
                found: dict[int, list] = {}
                for length in lengths:
                    for row, runs in _runs(chunk, hashes, length, shared.value).items():
                        found.setdefault(row, []).extend(runs)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(chunk.first, chunk.rows),
                        batch.column(2).slice(chunk.first, chunk.rows),
                        pa.array(chunk.counts.astype(np.int64)),
                        pa.array([found.get(r, []) for r in range(chunk.rows)], _RUN_ARROW),
                    ],
                    ["id", "text_key", "n_words", "runs"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select("text", F.col(id_column).alias("id"), F.xxhash64("text").alias("text_key")).mapInArrow(
        run, f"id {kind}, text_key bigint, n_words bigint, runs array<{_RUN}>"
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", item_column: str = "item_id"
) -> DataFrame:
    """id, text_key, n_words, n_hit, items (sorted ids as strings) of each row of ``docs`` (id, text).

    ``n_hit`` counts words inside any occurrence of a window. Null and empty texts have no words;
    an item without words has no windows; an item with a null id hits but is not listed. Repeated
    rows get the same values; empty tables are fine; other columns are not read.
    """
    spark = docs.sparkSession
    target = scratch_path(spark, "decontaminated")
    with scratch_scope(spark, "decontaminate_work"):
        windows = materialize(item_windows(benchmark, item_column), "item_windows")
        lengths = sorted(row[0] for row in windows.select("length").distinct().collect())  # ten rows at most
        rows = materialize(document_runs(docs, id_column, lengths, _filter(windows)), "document_runs")
        placed = materialize(
            rows.filter(F.size("runs") > 0)
            .select("id", "text_key", F.explode("runs").alias("r"))
            .select("id", "text_key", "r.*")
            .distinct(),
            "placed_runs",
        )
        confirmed = materialize(_confirmed(placed, windows), "confirmed_runs")
        hits = (
            placed.drop("windows", "prints", "length")
            .join(confirmed, "run")
            .groupBy("id", "text_key")
            .agg(
                F.flatten(
                    F.collect_list(F.transform("spans", lambda s: F.struct(s.low + F.col("start"), s.high + F.col("start"))))
                ).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            )
            .select("id", "text_key", _covered("spans").alias("n_hit"), "items")
        )
        hits = materialize(hits, "hits").withColumnsRenamed({"id": "h_id", "text_key": "h_key"})
        result = rows.join(hits, rows.id.eqNullSafe(hits.h_id) & (rows.text_key == hits.h_key), "left").select(
            "id",
            "text_key",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
        return materialize(result, "decontaminated", target)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", item_column: str = "item_id"
) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, with all their columns."""
    found = decontaminate(docs, benchmark, id_column, item_column).filter("n_hit > 0")
    hit = materialize(found.select(F.col("id").alias("_h_id"), F.col("text_key").alias("_h_key")).distinct(), "hit_rows")
    same = docs[id_column].eqNullSafe(hit["_h_id"]) & (F.xxhash64(docs["text"]) == hit["_h_key"])
    return docs.join(hit, same, "left_anti")


def _confirmed(placed: DataFrame, windows: DataFrame) -> DataFrame:
    """For each distinct run the stretches [low, high) of words that windows cover, and the items."""
    distinct = placed.groupBy("run").agg(
        F.first("length").alias("length"), F.first(F.arrays_zip("windows", "prints")).alias("zipped")
    )
    steps = distinct.select("run", "length", F.posexplode("zipped").alias("place", "w")).select(
        "run", "length", "place", F.col("w.windows").alias("window"), F.col("w.prints").alias("print")
    )
    found = steps.join(windows, ["print", "window", "length"])
    items = F.array_distinct(F.flatten(F.collect_list(F.when(F.col("item").isNotNull(), F.array(F.col("item").cast("string"))).otherwise(F.array().cast("array<string>")))))
    # The places of a run are bounded by its document, its items by the benchmark.
    return found.groupBy("run").agg(
        F.array_sort(F.collect_set(F.struct(F.col("place").cast("long").alias("low"), (F.col("place") + F.col("length")).cast("long").alias("high")))).alias("spans"),
        items.alias("items"),
    )


def _covered(column: str):
    """Words in the union of the spans (low, high) of an array column."""
    start = F.struct(F.lit(-1).cast("long").alias("reach"), F.lit(0).cast("long").alias("total"))

    def step(acc, span):
        low, high = span.getField("col1"), span.getField("col2")
        return F.struct(
            F.greatest(acc.reach, high).alias("reach"),
            (acc.total + F.greatest(high - F.greatest(low, acc.reach), F.lit(0).cast("long"))).alias("total"),
        )

    return F.aggregate(F.array_sort(F.col(column)), start, step, lambda acc: acc.total)
