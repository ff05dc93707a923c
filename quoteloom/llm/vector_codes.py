"""Compression of vectors to product codes, with Orchard's search for the nearest codebook entry.

Components are taken as integers, ``floor(scale * x)``, so that sums and distances are exact and a result
does not depend on how rows are dealt out. A vector is cut into ``parts`` equal consecutive parts, each
with a codebook of its own. Codebooks start as the parts of the vectors with the smallest ids; a round
assigns every part to its nearest entry and replaces each entry by the floor of its parts' mean.

Nearest entries are found by Orchard's search. Every entry has the list of the others by their distance
from it. A search starts at an entry, goes down its list, jumps to the list of any entry that is nearer,
marks what it has visited so that no distance is taken twice, and stops where the list is further than
twice the current distance: by the triangle inequality nothing beyond can be nearer. Distances are
squared integers and the stop is strict, so entries at equal distance are all visited and the lowest
index wins. All searches of a block of rows advance together in numpy.

A round reads the kept vectors once and shuffles one row for each entry and task. The codebooks, at most
``parts * entries`` short rows, are all that the driver sees; they travel back with the next round's tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize

#: Largest integer component whose squared distances, over 2 ** 7 components of a part, stay in 64 bits.
LARGEST = 1 << 27
_BLOCK_VALUES = 1 << 19


@dataclass(frozen=True)
class CodeSpec:
    """Shape of the codes. ``entries`` is at most 256, two hex digits."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


@dataclass(frozen=True)
class Codebooks:
    """``entries[p, k]``: entry ``k`` of part ``p``, with the lists that a search goes along."""

    entries: np.ndarray  # parts x entries x width
    between: np.ndarray  # squared distances of entries, sorted along each list
    lists: np.ndarray  # entries by distance from each entry, itself first

    @staticmethod
    def of(entries: np.ndarray) -> Codebooks:
        apart = entries[:, :, None, :] - entries[:, None, :, :]
        between = (apart * apart).sum(axis=3)
        # The entry itself leads its list, also before others at distance 0.
        key = between * 2 + (~np.eye(entries.shape[1], dtype=bool)).astype(np.int64)
        lists = np.argsort(key, axis=2, kind="stable")
        return Codebooks(entries, np.take_along_axis(between, lists, axis=2), lists)

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry, rows x parts; ``vectors``: rows x parts x width."""
        rows, parts, width = vectors.shape
        count = self.entries.shape[1]
        queries = vectors.reshape(rows * parts, width)
        part = np.tile(np.arange(parts), rows)
        current = np.zeros(len(queries), np.int64)
        distance = _apart(queries, self.entries[part, 0])
        visited = np.zeros((len(queries), count), bool)
        visited[:, 0] = True
        place = np.ones(len(queries), np.int64)  # next on the current entry's list, behind the entry itself
        open_ = np.arange(len(queries)) if count > 1 else np.zeros(0, np.int64)
        while len(open_):
            at = (part[open_], current[open_], place[open_])
            # Squared: further than twice the current distance.
            near = self.between[at] <= 4 * distance[open_]
            open_, other = open_[near], self.lists[at][near]
            place[open_] += 1
            fresh = ~visited[open_, other]
            new, entry = open_[fresh], other[fresh]
            visited[new, entry] = True
            found = _apart(queries[new], self.entries[part[new], entry])
            better = (found < distance[new]) | ((found == distance[new]) & (entry < current[new]))
            jump = new[better]
            current[jump], distance[jump], place[jump] = entry[better], found[better], 1
            open_ = open_[place[open_] < count]
        return current.reshape(rows, parts), distance.reshape(rows, parts)

    def digest(self) -> str:
        """SHA-256 of all integers by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(x) for x in self.entries.ravel().tolist()).encode()).hexdigest()


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = a - b
    return np.einsum("ij,ij->i", apart, apart)


def kept_vectors(vectors: DataFrame, vec_id: Column, embedding: Column, label: Column, scale: int) -> DataFrame:
    """vec_id, label and ``parts``: the integers of each vector without null or non-finite components."""
    values = F.col("_vector")
    whole = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Doubles: floats are exact in them, and so is their product with a power of two.
    integers = F.transform(values, lambda x: F.floor(x.cast("double") * float(scale)).cast("long"))
    rows = vectors.select(vec_id.alias("vec_id"), label.alias("label"), embedding.alias("_vector"))
    return rows.where(F.col("_vector").isNotNull() & whole).select("vec_id", "label", integers.alias("integers"))


def _blocks(column: pa.Array, parts: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row and rows x parts x width of blocks of a bounded size."""
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    rows = max(1, _BLOCK_VALUES // max(1, parts * width))
    for first in range(0, len(column), rows):
        last = min(first + rows, len(column))
        yield first, values[first * parts * width : last * parts * width].reshape(last - first, parts, width)


def _sums(kept: DataFrame, books: Codebooks) -> list:
    """(part, entry, count, sums) over all parts that are assigned to an entry: a few rows, summed up by Spark."""
    parts, count, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(parts * count, np.int64), np.zeros((parts * count, width), np.int64)
        for batch in batches:
            for _, block in _blocks(batch.column(0), parts, width):
                code, _ = books.search(block)
                slot = (code + np.arange(parts) * count).ravel()
                counts += np.bincount(slot, minlength=parts * count)
                order = np.argsort(slot, kind="stable")
                held, first = np.unique(slot[order], return_index=True)
                sums[held] += np.add.reduceat(block.reshape(len(slot), width)[order], first, axis=0)
        slots = np.flatnonzero(counts)
        if len(slots):
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots), pa.array(counts[slots]), pa.array(sums[slots].tolist(), pa.list_(pa.int64()))],
                ["slot", "n", "sums"],
            )

    partial = kept.select("integers").mapInArrow(run, "slot bigint, n bigint, sums array<bigint>")
    # Decimals: the sum over all tasks may leave 64 bits.
    totals = partial.select("slot", "n", F.posexplode("sums").alias("place", "value")).groupBy("slot", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("total")
    )
    return totals.select("slot", "place", "n", F.col("total").cast("string").alias("total")).collect()


def _first_entries(kept: DataFrame, spec: CodeSpec) -> np.ndarray:
    """The parts of the vectors with the smallest ids, ties by content; null ids come last."""
    least = kept.orderBy(F.col("vec_id").asc_nulls_last(), "integers").limit(spec.entries).select("integers").collect()
    width = len(least[0][0]) // spec.parts
    return np.array([r[0] for r in least], np.int64).reshape(len(least), spec.parts, width).transpose(1, 0, 2).copy()


def train_codebooks(kept: DataFrame, spec: CodeSpec = CodeSpec()) -> Codebooks:
    """The codebooks after all rounds; ``kept`` holds vectors of one length, one at least. Unused entries stay."""
    entries = _first_entries(kept, spec)
    for _ in range(spec.rounds):
        new = entries.copy()
        for row in _sums(kept, Codebooks.of(entries)):
            part, entry = divmod(row["slot"], entries.shape[1])
            new[part, entry, row["place"]] = int(row["total"]) // row["n"]
        if (new == entries).all():
            break  # further rounds would assign and average the same
        entries = new
    return Codebooks.of(entries)


def encode(kept: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code and error of each vector."""
    parts, _, width = books.entries.shape
    columns = [f for f in kept.schema if f.name in ("vec_id", "label")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, block in _blocks(batch.column(2), parts, width):
                code, distance = books.search(block)
                own = [c.slice(first, len(block)) for c in batch.columns[:2]]
                text = [row.tobytes().hex() for row in code.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(text), pa.array(distance.sum(axis=1))], ["vec_id", "label", "code", "error"]
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
    return kept.select("vec_id", "label", "integers").mapInArrow(run, f"{kinds}, code string, error bigint")


def compress(
    vectors: DataFrame,
    spec: CodeSpec = CodeSpec(),
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of each kept row of ``vectors``.

    Rows whose vector is null or holds null or non-finite components are dropped, and so are vectors whose
    length differs from that of the kept vector with the smallest id. That length must be a multiple of
    ``spec.parts``; components are bounded by ``LARGEST / spec.scale`` so that distances stay in 64 bits;
    both raise ValueError otherwise. Null ids are kept and count as the largest. Rows with equal ids are
    ordered by their components, and repeated rows are rows of their own. Null labels are one label. An
    empty table, or one without a kept vector, gives an empty result; other columns are not read.
    """
    kept = kept_vectors(vectors, F.col(vec_id), F.col(embedding), F.col(label), spec.scale)
    kept = materialize(kept, "vectors")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "integers").select(F.size("integers")).first()
    if first is None:
        blank = [F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")]
        return kept.select("vec_id", "label", *blank, F.lit("").alias("codebooks_sha256"))
    if first[0] % spec.parts:
        raise ValueError(f"vectors of {first[0]} components cannot be cut into {spec.parts} equal parts")
    width = first[0] // spec.parts
    large = F.exists("integers", lambda x: F.abs(x) > F.lit(LARGEST)) if width <= 128 else F.lit(True)
    kept = kept.where(F.size("integers") == first[0])
    if not kept.where(large).isEmpty():
        raise ValueError(f"components beyond {LARGEST // spec.scale}, or parts of more than 128 components")
    books = train_codebooks(kept, spec)
    coded = materialize(encode(kept, books), "codes")
    # A struct is never null, so null labels meet. Written: AQE then broadcasts the sums or splits hot labels.
    named = F.struct(F.col("label").alias("l")).alias("_label")
    sums = materialize(coded.groupBy(named).agg(F.sum("error").alias("label_error")), "label_errors")
    return (
        coded.withColumn("_label", F.struct(F.col("label").alias("l")))
        .join(sums, "_label")
        .select("vec_id", "label", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
    )
