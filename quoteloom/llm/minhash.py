"""Near-duplicate groups of documents by fast similarity sketching, banding and exact verification.

A document's set holds its distinct shingles of five words; a shorter text is one shingle, a text
without words has an empty set and is linked with nothing. Two sets are linked when 100 times their
intersection is at least 75 times their union. Shingles are compared by 64-bit hashes.

1. One pass over the texts (Arrow, numpy) gives each document its set's size, two fingerprints of the
   set and its sketch. The sketch is Fast Similarity Sketching: round after round each element is
   hashed into one of ``t`` bins, a bin keeps the smallest (round, hash) it has met, and rounds end
   when every bin is filled; from round ``t`` on, round ``t + i`` puts every element into bin ``i``,
   so ``2 t`` rounds always fill all. Coordinates agree with the sets' similarity as probability.
2. Documents whose sets agree in both fingerprints are one class; a class costs as much as a single
   document from here on. Bands of coordinates are bucket keys.
3. Each class meets the leader of its buckets only: the class that shares most buckets, which is the text
   that the others were made from if there is one. Pairs pass a size bound and a bit sketch (seven
   standard deviations below the limit), then their full sets are intersected. Only such links count.
4. Components of the links by alternating star contractions. A bucket whose classes are all in one
   component is settled. In the others only pairs across components are left, as no other link matters.
5. In buckets of a few classes (``bucket``) these pairs are taken directly. In larger ones an exact prefix
   filter finds them (``_prefix_pairs``): it goes through the shingles in one order for all sets, those that
   are rare outside the main components first, and two sets whose link is possible must share one of the first few. Copies
   with more private shingles than a link allows meet nobody, however large their group is.
6. These pairs are verified like the first, and the components of all links are the groups.

At a similarity of 0.75 a pair shares no band with a probability of 0.000005; all that share one are
decided exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize, scratch_path, scratch_scope
from .words import SPACED, Chunk, chunks, gram_starts, grams, mix, signed

SHINGLE = 5
PERCENT = 75
#: (bands, coordinates in a band).
SHAPE = (32, 4)
BUCKET = 8
#: Slots of the filter that keeps texts nobody asks for out of a join; a long each, at most.
FILTER_SLOTS = 1 << 21
_BIT_WORDS = 2
_ROUND_SHIFT = np.uint64(53)


@dataclass(frozen=True)
class Sketcher:
    """Sketches of ``bands * width`` coordinates, a power of two up to 1024."""

    bands: int
    width: int

    def coordinates(self, elements: np.ndarray) -> np.ndarray:
        """One coordinate for each bin; ``elements`` are distinct hashes, at least one."""
        t = self.bands * self.width
        filled = np.full(t, np.iinfo(np.uint64).max, np.uint64)
        block = max(1, math.ceil(1.5 * t * math.log(t) / len(elements)))
        done = 0
        while done < 2 * t:
            rounds = np.arange(done, min(done + block, 2 * t), dtype=np.uint64)
            seeds = mix((rounds + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(t))
            hashed = mix(elements[None, :] ^ seeds[:, None])
            bins = (hashed & np.uint64(t - 1)).astype(np.intp)
            late = rounds >= t
            if late.any():
                bins[late] = (rounds[late] - np.uint64(t)).astype(np.intp)[:, None]
            values = (rounds[:, None] << _ROUND_SHIFT) | (hashed >> np.uint64(11))
            np.minimum.at(filled, bins.ravel(), values.ravel())
            done += block
            if filled.max() != np.iinfo(np.uint64).max:
                break
        return filled

    def keys(self, coordinates: np.ndarray) -> np.ndarray:
        """A bucket key for each band."""
        steps = mix(np.arange(1, self.width + 1, dtype=np.uint64)) | np.uint64(1)
        bands = (mix(coordinates).reshape(self.bands, self.width) * steps).sum(axis=1, dtype=np.uint64)
        return mix(bands + mix(np.arange(self.bands, dtype=np.uint64)))


def bit_sketch(coordinates: np.ndarray) -> np.ndarray:
    """One bit of each of the first 64 * _BIT_WORDS coordinates."""
    bits = (mix(coordinates[: 64 * _BIT_WORDS] ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits).view(np.uint64)


def shingle_sets(chunk: Chunk) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row of a chunk."""
    hashes = chunk.word_hashes()
    long_rows = grams(hashes, SHINGLE)
    short_rows = {n: grams(hashes, n) for n in set(chunk.counts.tolist()) if 0 < n < SHINGLE}
    sets = []
    for row in range(chunk.rows):
        begin, n = chunk.offsets[row], int(chunk.counts[row])
        if n >= SHINGLE:
            own = np.sort(long_rows[begin : begin + n - SHINGLE + 1])
            keep = np.ones(len(own), bool)
            keep[1:] = own[1:] != own[:-1]
            sets.append(own[keep])
        elif n:
            sets.append(short_rows[n][begin : begin + 1])
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def fingerprints(elements: np.ndarray) -> np.ndarray:
    """Two 64-bit fingerprints of a set; its size is part of them."""
    size = np.uint64(len(elements))
    totals = [mix(elements).sum(dtype=np.uint64), mix(elements ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)]
    return signed(mix(np.array(totals, np.uint64) ^ size))


def _longs(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(values)))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[Chunk, pa.RecordBatch]]:
    """Chunks of column 0 with the other columns of the same rows."""
    for chunk in chunks(batch.column(0), SPACED):
        yield chunk, batch.slice(chunk.first, chunk.rows)


def with_sketches(docs: DataFrame, id_column: str, sketcher: Sketcher) -> DataFrame:
    """id, text_key, class_id, check, n_shingles, bits_0, bits_1, keys of each row; null class_id: no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, rows in _slices(batch):
                sets = shingle_sets(chunk)
                sketches = [sketcher.coordinates(s) if len(s) else None for s in sets]
                names = [fingerprints(s).tolist() if len(s) else (None, None) for s in sets]
                bits = [bit_sketch(c) if c is not None else np.zeros(_BIT_WORDS, np.uint64) for c in sketches]
                low, high = (pa.array(signed(np.array([b[k] for b in bits]))) for k in range(_BIT_WORDS))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(1),
                        rows.column(2),
                        pa.array([name[0] for name in names], pa.int64()),
                        pa.array([name[1] for name in names], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        low,
                        high,
                        _longs([sketcher.keys(c) if c is not None else np.zeros(0, np.uint64) for c in sketches]),
                    ],
                    ["id", "text_key", "class_id", "check", "n_shingles", "bits_0", "bits_1", "keys"],
                )

    schema = (
        "id bigint, text_key bigint, class_id bigint, check bigint, n_shingles bigint, "
        "bits_0 bigint, bits_1 bigint, keys array<bigint>"
    )
    return _texts(docs, id_column).mapInArrow(run, schema)


def _texts(docs: DataFrame, id_column: str) -> DataFrame:
    return docs.select(F.col("text"), F.col(id_column).cast("long").alias("id"), F.xxhash64("text").alias("text_key"))


def _named_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with another class_id where different sets have the same first fingerprint."""
    found = rows.groupBy("class_id").agg(F.min("check").alias("low"), F.max("check").alias("high"))
    shared = materialize(found.where("low <> high").select("class_id", "low"), "shared_names")
    other = F.xxhash64("class_id", "check")
    joined = rows.join(shared, "class_id", "left")
    return joined.withColumn("class_id", F.when(F.col("check") > F.col("low"), other).otherwise(F.col("class_id"))).drop("low")


def _sets(docs: DataFrame, id_column: str, wanted: DataFrame) -> DataFrame:
    """class_id, shingles: the full set of each class of ``wanted`` (class_id, member), read from one of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, rows in _slices(batch):
                yield pa.RecordBatch.from_arrays([rows.column(1), _longs(shingle_sets(chunk))], ["class_id", "shingles"])

    wanted = wanted.select("class_id", F.col("member.id").alias("w_id"), F.col("member.text_key").alias("w_key"))
    # The slots of the wanted keys: at most FILTER_SLOTS longs, so they may be broadcast at any size. Few other
    # texts are left for the join behind them; with millions of wanted ones most pass, and it decides alone.
    slots = wanted.select(F.pmod("w_key", F.lit(FILTER_SLOTS)).alias("slot")).distinct()
    texts = _texts(docs, id_column).withColumn("slot", F.pmod("text_key", F.lit(FILTER_SLOTS)))
    texts = texts.join(F.broadcast(slots), "slot", "left_semi")
    chosen = texts.join(wanted, texts.id.eqNullSafe(F.col("w_id")) & (texts.text_key == F.col("w_key")))
    return chosen.select("text", "class_id").mapInArrow(run, "class_id bigint, shingles array<bigint>").dropDuplicates(["class_id"])


def _linked(small: Column, large: Column) -> Column:
    return small * 100 >= large * PERCENT


def _similar_bits() -> Column:
    """Bit sketches agree as they do at the limit, give or take seven standard deviations."""
    size = 64 * _BIT_WORDS
    agree = (1 + PERCENT / 100) / 2
    least = math.floor(size * agree - 7 * math.sqrt(size * agree * (1 - agree)))
    differ = F.bit_count(F.col("a.bits_0").bitwiseXOR(F.col("b.bits_0"))) + F.bit_count(
        F.col("a.bits_1").bitwiseXOR(F.col("b.bits_1"))
    )
    return differ <= size - least


def _possible() -> Column:
    small = F.least("a.n_shingles", "b.n_shingles")
    return _linked(small, F.greatest("a.n_shingles", "b.n_shingles")) & _similar_bits()


def _shared_buckets(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(class_id, bucket, size) of each class in buckets that hold more than one, and (bucket, leader).

    A bucket's leader is the class whose own buckets hold most classes in total.
    """
    banded = classes.select("class_id", F.explode("keys").alias("bucket"))  # a key is a hash of band and values
    # Written first: its join with the rows can then be broadcast or split by AQE.
    sizes = materialize(banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "bucket_sizes")
    shared = materialize(banded.join(sizes, "bucket"), "shared")
    centres = materialize(shared.groupBy("class_id").agg(F.sum("size").alias("centre")), "centres")
    # Of equals, the class with the smallest id.
    place = F.struct("centre", F.bitwise_not("class_id").alias("other"))
    leaders = shared.join(centres, "class_id").groupBy("bucket").agg(F.max(place)["other"].alias("other"))
    return shared, materialize(leaders.select("bucket", F.bitwise_not("other").alias("leader")), "leaders")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _possible_pairs(pairs: DataFrame, traits: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) that the size bound and the bit sketches leave; ``traits``: class_id, n_shingles, bits."""
    found = pairs.join(traits.alias("a"), F.col("a") == F.col("a.class_id")).join(
        traits.alias("b"), F.col("b") == F.col("b.class_id")
    )
    return found.where(_possible()).select("a", "b")


def _verified(docs: DataFrame, id_column: str, classes: DataFrame, pairs: DataFrame, label: str) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    target = scratch_path(docs.sparkSession, label)
    with scratch_scope(docs.sparkSession, f"{label}_work"):
        sets = _written_sets(docs, id_column, classes, pairs.select("a").union(pairs.select("b")))
        left = sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("set_a"))
        right = sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("set_b"))
        common = F.size(F.array_intersect("set_a", "set_b"))
        compared = pairs.join(left, "a").join(right, "b").withColumn("common", common)
        linked = _linked(F.col("common"), F.size("set_a") + F.size("set_b") - F.col("common"))
        return materialize(compared.filter(linked).select("a", "b"), label, target)


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for each node of ``links`` (a, b); the root is its component's smallest node.

    Alternating star contractions: every node hands its larger neighbours, then its smaller ones, to
    the smallest node it knows, until all edges point at a root.
    """
    spark = links.sparkSession
    target = scratch_path(spark, f"{label}_roots")
    with scratch_scope(spark, label):
        edges, step = materialize(links.select("a", "b").filter("a <> b").distinct(), f"{label}_0"), 0
        while not edges.isEmpty():
            both = edges.union(edges.select(F.col("b"), F.col("a")))
            least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{label}_large")
            large = both.join(least, "a").filter("b > a and b <> m").select(F.col("m").alias("a"), "b").distinct()
            large = materialize(large, f"{label}_larged")
            least = materialize(large.groupBy("b").agg(F.min("a").alias("m")), f"{label}_small")
            tied = large.join(least, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
            step += 1
            edges = materialize(tied.union(least.select(F.col("m").alias("a"), "b")).distinct(), f"{label}_{step}")
            # Done when the edges are stars: each node below one other, which is below none.
            uppers, lowers = edges.select("a"), edges.groupBy(F.col("b").alias("a")).count()
            if lowers.filter("count > 1").isEmpty() and uppers.join(lowers, "a", "left_semi").isEmpty():
                break
        roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        tops = edges.select(F.col("a").alias("node"), F.col("a").alias("root"))
        return materialize(roots.union(tops).distinct(), f"{label}_roots", target)


def _open_buckets(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """class_id, bucket, size, root, main of buckets whose classes lie in several components.

    ``main`` is the component with most classes in the bucket.
    """
    placed = shared.join(roots, shared.class_id == roots.node, "left").withColumn("root", F.coalesce("root", "class_id"))
    placed = placed.select("class_id", "bucket", "size", "root")
    shares = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    mains = shares.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("parts"))
    mains = materialize(mains.filter("parts > 1").select("bucket", F.col("top.root").alias("main")), "mains")
    return placed.join(mains, "bucket")


def _bucket_pairs(rows: DataFrame, traits: DataFrame) -> DataFrame:
    """Pairs across components within small buckets that the bounds leave."""
    rows = rows.join(traits, "class_id")
    across = (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.root") < F.col("b.root")) & _possible()
    return rows.alias("a").join(rows.alias("b"), across).select(*_ordered("a.class_id", "b.class_id"))


def _prefix_pairs(
    docs: DataFrame, id_column: str, classes: DataFrame, opened: DataFrame, traits: DataFrame
) -> DataFrame:
    """Pairs across components of classes in large open buckets that an exact prefix filter leaves.

    ``opened``: class_id, root, odd; a class is odd if it is outside the main component of one of its open
    buckets. Any other pair lies within a main component, so one end is odd. All shingles are put in one
    order: those of no odd class first, then by the number of odd classes that have them. For sets of
    m and n shingles a link needs o = ceil(75 (m + n) / 175) common ones; the first of them in this order is at a
    place up to m - o in the one and n - o in the other, counted from 0. So only places up to n - ceil(0.75 n) count,
    and where private shingles fill them, a class meets nobody.
    """
    target = scratch_path(docs.sparkSession, "prefixes")
    with scratch_scope(docs.sparkSession, "prefixes_work"):
        sets = _written_sets(docs, id_column, classes, opened.select("class_id"))
        first = materialize(_prefixes(sets, opened, traits), "prefixes", target)
    placed = first.select(
        *traits.columns, "root", "odd", (F.col("before") + F.col("place")).alias("place"), "shingle"
    )
    both = F.col("a.n_shingles") + F.col("b.n_shingles")
    least = F.ceil(both * PERCENT / (100 + PERCENT))
    near = (F.col("a.place") <= F.col("a.n_shingles") - least) & (F.col("b.place") <= F.col("b.n_shingles") - least)
    across = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.root") != F.col("b.root")) & near & _possible()
    return placed.where("odd").alias("a").join(placed.alias("b"), across).select(*_ordered("a.class_id", "b.class_id"))


def _prefixes(sets: DataFrame, opened: DataFrame, traits: DataFrame) -> DataFrame:
    """Traits, root, odd, before, place and shingle of the first shingles of each set, in the order of all."""
    odd = opened.where("odd").select("class_id")
    words = sets.join(odd, "class_id", "left_semi").select(F.explode("shingles").alias("shingle"))
    vocabulary = materialize(words.groupBy("shingle").agg(F.count("*").alias("f")), "odd_shingles")
    held = sets.join(opened, "class_id").select("class_id", F.explode("shingles").alias("shingle")).join(vocabulary, "shingle")
    ranked = held.groupBy("class_id").agg(F.array_sort(F.collect_list(F.struct("f", "shingle"))).alias("hits"))
    size = F.col("n_shingles")
    needed = F.ceil(size * PERCENT / 100)
    before = (size - F.size("hits")).cast("long")  # shingles of no odd class
    number = F.greatest(size - needed + 1 - before, F.lit(0)).cast("int")
    first = (
        ranked.join(traits, "class_id")
        .join(opened, "class_id")
        .select(*traits.columns, "root", "odd", before.alias("before"), F.slice("hits", F.lit(1), number).alias("hits"))
    )
    hits = F.posexplode("hits").alias("place", "hit")
    return first.select(*traits.columns, "root", "odd", "before", hits).withColumn("shingle", F.col("hit.shingle")).drop("hit")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", shape: tuple[int, int] = SHAPE, bucket: int = BUCKET
) -> DataFrame:
    """id, text_key, n_shingles, component_id and root of each row of ``docs`` (id, text).

    ``root`` names the row's component, null for rows without words. ``component_id`` is the smallest id that links reach, the row's own included; null ids count only
    where there is no other. ``text_key`` (xxhash64 of the text) tells rows of one id with different
    texts apart. Rows without words keep their own id. Repeated rows get the same values; an empty
    table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    target = scratch_path(spark, "near_duplicates")
    with scratch_scope(spark, "near_duplicates_work"):
        rows = materialize(with_sketches(docs, id_column, Sketcher(*shape)), "sketches")
        named = _named_apart(rows.filter("class_id is not null"))
        classes = named.groupBy("class_id").agg(
            F.min("id").alias("low_id"),
            F.min(F.struct("id", "text_key")).alias("member"),
            F.max("n_shingles").alias("n_shingles"),
            F.first("bits_0").alias("bits_0"),
            F.first("bits_1").alias("bits_1"),
            F.first("keys").alias("keys"),
        )
        classes = materialize(classes, "classes")
        links = _links(docs, id_column, classes, bucket)
        return materialize(_placed(rows, named, classes, components(links)), "near_duplicates", target)


def _links(docs: DataFrame, id_column: str, classes: DataFrame, bucket: int) -> DataFrame:
    """Links (a, b) that join all classes which belong together."""
    spark = docs.sparkSession
    target = scratch_path(spark, "links")
    with scratch_scope(spark, "links_work"):
        traits = classes.select("class_id", "n_shingles", "bits_0", "bits_1")
        shared, leaders = _shared_buckets(classes)
        met = shared.join(leaders, "bucket").where("class_id <> leader")
        met = met.select(F.col("class_id").alias("a"), F.col("leader").alias("b")).distinct()
        met = materialize(_possible_pairs(met, traits), "leader_pairs")
        found = _verified(docs, id_column, classes, met, "leader_links")
        opened = materialize(_open_buckets(shared, components(found)), "open")
        small = materialize(_bucket_pairs(opened.where(F.col("size") <= bucket), traits).distinct(), "bucket_pairs")
        large = opened.where(F.col("size") > bucket).groupBy("class_id", "root").agg(
            F.max(F.col("root") != F.col("main")).alias("odd")
        )
        pairs = small.union(_prefix_pairs(docs, id_column, classes, materialize(large, "large"), traits)).distinct()
        # Pairs of a class with its leader are decided.
        pairs = pairs.join(met.select(*_ordered("a", "b")), ["a", "b"], "left_anti")
        more = _verified(docs, id_column, classes, materialize(pairs, "open_pairs"), "open_links")
        return materialize(found.union(more), "links", target)


def _written_sets(docs: DataFrame, id_column: str, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """class_id, shingles of the classes ``ids`` (one column)."""
    ids = ids.toDF("class_id").distinct()
    wanted = materialize(classes.select("class_id", "member").join(ids, "class_id", "left_semi"), "wanted")
    return materialize(_sets(docs, id_column, wanted), "sets")


def _placed(rows: DataFrame, named: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """The columns of ``near_duplicates`` for every row."""
    low = roots.join(classes, roots.node == classes.class_id).groupBy("root").agg(F.min("low_id").alias("component_id"))
    placed = materialize(
        roots.join(materialize(low, "component_ids"), "root").select(F.col("node").alias("class_id"), "root", "component_id"),
        "placed",
    )
    whole = classes.select("class_id", "low_id").join(placed, "class_id", "left")
    whole = materialize(
        whole.select("class_id", F.coalesce("root", "class_id").alias("root"), F.coalesce("component_id", "low_id").alias("component_id")),
        "class_components",
    )
    columns = ["id", "text_key", "n_shingles", "component_id", "root"]
    alone = rows.filter("class_id is null").withColumn("component_id", F.col("id")).withColumn("root", F.col("class_id"))
    return named.join(whole, "class_id").select(*columns).union(alone.select(*columns))


def one_per_group(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of near duplicates, that of the smallest id (then text hash).

    Rows without words belong to no group and all stay.
    """
    found = near_duplicates(docs, id_column).filter("root is not null")
    place = F.struct(F.col("id").isNull().alias("n"), "id", "text_key")
    keepers = materialize(found.groupBy("root").agg(F.min(place).alias("keeper")), "keepers")
    rejected = found.join(keepers, "root").filter(place != F.col("keeper")).select("id", "text_key").distinct()
    left = _without(docs, id_column, materialize(rejected, "rejected_copies"))
    repeated = found.groupBy("id", "text_key").count().filter("count > 1").select("id", "text_key")
    repeated = materialize(repeated, "repeated_rows")
    if repeated.isEmpty():
        return left
    again = left.join(repeated, _same_row(left, id_column, repeated), "left_semi")
    return _without(left, id_column, repeated).unionByName(again.dropDuplicates([id_column, "text"]))


def _same_row(docs: DataFrame, id_column: str, rows: DataFrame) -> Column:
    return docs[id_column].eqNullSafe(rows["id"]) & (F.xxhash64(docs["text"]) == rows["text_key"])


def _without(docs: DataFrame, id_column: str, rows: DataFrame) -> DataFrame:
    """``docs`` but for the rows (id, text_key)."""
    return docs.join(rows, _same_row(docs, id_column, rows), "left_anti")
