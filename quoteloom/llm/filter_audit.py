"""How filters interact: what each removes in every order, by incremental retraction over a stream.

Five filters judge a text: A, fewer than 200 words; B, less than half of the words distinct; C, more than
3 in 100 characters are A-Z; D, one of ``#$%&*|`` occurs; E, a document with a smaller id has the same text.
A to D need the text alone. E needs all others, so it is kept up to date instead of computed at the end:

1. All files are processed as micro-batches of an available-now stream. A row becomes narrow at once: a
   digest of its text, id, part, a mask of the filters A to D that it fails, and its label marks.
2. A batch is aggregated to one row for each text, part, mask and marks: the smallest id, the number of rows that
   have it and of all rows. A text that a third of all rows share is a few rows then, before any of its rows meet.
3. The state is a table keyed by text: the smallest id of each text so far, and what stands at it. Rows
   above the smallest id fail E. When a smaller one arrives, the counts that were given out without E for
   the earlier are retracted and given with E.
4. Each batch writes what it adds to the state and its changes of the counters (part, mask, marks) into
   folders of its own, and reads those of earlier batches only. A batch that is repeated after a failure therefore
   overwrites what it left and changes nothing else. The counters are the sum of all changes.

From the counters, at most 32 masks for each part, every order and step follows by arithmetic. All of it are
built-in functions. A batch reads the whole state, some 60 bytes for each distinct text, so the
number of micro-batches is a parameter and not a number of files.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..workspace import content_size, list_children, materialize, remove_path, scratch_path

FILTERS = "ABCDE"
_E = 1 << FILTERS.index("E")
MICRO_BATCHES = 8

_CHANGES = "part string, mask int, marks int, n bigint"
_STATE = "text_key binary, doc_id bigint, part string, mask int, marks int, n bigint"


def failure_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = F.transform(
        F.array(words),  # one element: the words are split once
        lambda w: F.when(F.size(w) < 200, 1).otherwise(0)
        + F.when(100 * F.size(F.array_distinct(w)) < 50 * F.size(w), 2).otherwise(0),
    )[0]
    return (
        fails
        + F.when(100 * capitals.cast("long") > 3 * F.length(text).cast("long"), 4).otherwise(0)
        + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)
    )


def _narrow(docs: DataFrame) -> DataFrame:
    """text_key, doc_id, part and mask of each row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.unhex(F.sha2(text, 256)).alias("text_key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        failure_mask(text).cast("int").alias("mask"),
    )


def label_marks(labels: DataFrame) -> DataFrame:
    """doc_id and marks, one row an id: any label of the id with quality 1 counts 1, with toxic 1 counts 2."""
    quality, toxic = (F.max(F.when(F.col(c) == 1, 1).otherwise(0)) for c in ("quality", "toxic"))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return known.agg((quality + 2 * toxic).cast("int").alias("marks")).where("marks > 0")


def _with_marks(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """``rows`` with the marks of their ids, 0 where there are none.

    Rows without an id have none and are dealt out by their text in the join. Equal rows become one, with
    their number ``n``, so that no id gathers many rows either.
    """
    counted = rows.groupBy("text_key", "doc_id", "part", "mask").agg(F.count("*").alias("n"))
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("text_key")).otherwise(F.lit(0).cast("long"))
    counted = counted.withColumn("_id", F.coalesce("doc_id", F.lit(0).cast("long"))).withColumn("_salt", salt)
    known = marks.select(F.col("doc_id").alias("_id"), F.lit(0).cast("long").alias("_salt"), "marks")
    found = F.when(F.col("doc_id").isNotNull(), F.col("marks"))
    joined = counted.join(known, ["_id", "_salt"], "left").withColumn("marks", F.coalesce(found, F.lit(0)))
    return joined.drop("_id", "_salt")


def decide(batch: DataFrame, state: DataFrame) -> DataFrame:
    """Rows of the texts in ``batch`` (text_key, doc_id, part, mask, marks, n), those of the state among them.

    ``n`` rows stand at ``doc_id`` of ``total`` rows, ``arrived`` tells a batch's row from one of the state,
    ``before`` and ``now`` are the smallest ids of the text without and with the batch. ``state`` has one
    row or more for each smallest id that a text has had. Rows without an id have no part in it.
    """
    given = batch.withColumn("known", F.col("doc_id").isNotNull())
    low = F.min(F.struct("doc_id", "n"))
    arrived = (
        # Rows of one id may lie in the batch with several parts; within one they are one row already.
        given.groupBy("text_key", "part", "mask", "marks", "known")
        .agg(low.alias("low"), F.sum("n").alias("total"))
        .select("text_key", "low.doc_id", "part", "mask", "marks", "low.n", "total", F.lit(True).alias("arrived"))
    )
    earlier = state.select("text_key", "doc_id", "part", "mask", "marks", "n", F.col("n").alias("total"), F.lit(False).alias("arrived"))
    text = Window.partitionBy("text_key")
    return (
        arrived.unionByName(earlier)
        .withColumn("before", F.min(F.when(~F.col("arrived"), F.col("doc_id"))).over(text))
        .withColumn("now", F.min("doc_id").over(text))
        .withColumn("touched", F.max("arrived").over(text))
        .where("touched")
        .drop("touched")
    )


def state_rows(decided: DataFrame) -> DataFrame:
    """What a batch adds to the state: its rows at their text's smallest id."""
    return decided.where("arrived AND doc_id = now").select("text_key", "doc_id", "part", "mask", "marks", "n")


def counter_changes(decided: DataFrame) -> DataFrame:
    """Changes of the counters (part, mask, marks) that a batch makes; ``mask`` has all five filters."""
    copies = F.col("mask").bitwiseOR(F.lit(_E)).alias("mask")
    rows = decided.select("part", "mask", "marks", "n", "total", "doc_id", "before", "now", "arrived")
    fresh = rows.where("arrived")
    first = F.col("doc_id").isNull() | (F.col("doc_id") == F.col("now"))
    plain = fresh.where(first).select("part", "mask", "marks", "n")
    above = fresh.select("part", copies, "marks", (F.col("total") - F.when(first, F.col("n")).otherwise(0)).alias("n"))
    # What stood at the smallest id fails E once a smaller one is there.
    passed = rows.where("NOT arrived AND doc_id = before AND now < before")
    taken = passed.select("part", "mask", "marks", (-F.col("n")).alias("n"))
    again = passed.select("part", copies, "marks", "n")
    changes = plain.union(above).union(taken).union(again)
    return changes.groupBy("part", "mask", "marks").agg(F.sum("n").alias("n")).where("n <> 0")


def _earlier(spark: SparkSession, folder: str, schema: str, batch_id: int | None = None) -> DataFrame:
    """What batches before ``batch_id``, or all of them, have written below ``folder``."""
    numbers = sorted(int(name.partition("=")[2]) for name in list_children(spark, folder))
    paths = [f"{folder}/batch={k}" for k in numbers if batch_id is None or k < batch_id]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def counters(docs: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """part, mask, marks and n over a stream of documents (doc_id, text, lang) that ends.

    ``folder`` takes the stream's checkpoint, the state and the changes of the counters. A stream that
    was interrupted goes on when it is started again with the same folder.
    """
    spark = docs.sparkSession
    marks = materialize(label_marks(labels), "marks")

    def keep(batch: DataFrame, batch_id: int) -> None:
        state = _earlier(spark, f"{folder}/state", _STATE, batch_id)
        decided = decide(_with_marks(batch, marks), state)
        decided = materialize(decided, "decided", f"{folder}/decided/batch={batch_id}")
        materialize(state_rows(decided), "state", f"{folder}/state/batch={batch_id}")
        materialize(counter_changes(decided), "changes", f"{folder}/changes/batch={batch_id}")
        remove_path(spark, f"{folder}/decided/batch={batch_id}")

    running = (
        _narrow(docs)
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    changes = _earlier(spark, f"{folder}/changes", _CHANGES)
    return changes.groupBy("part", "mask", "marks").agg(F.sum("n").alias("n")).where("n <> 0")


def interactions(counts: DataFrame) -> DataFrame:
    """One row for each part, filter_order and step of ``counts`` (part, mask, marks, n)."""
    bits = {f: 1 << k for k, f in enumerate(FILTERS)}
    orders = []
    for order in itertools.permutations(FILTERS):
        earlier = 0
        for step, name in enumerate(order, 1):
            orders.append(("".join(order), step, bits[name], earlier))
            earlier |= bits[name]
    steps = F.from_json(
        F.lit("[" + ",".join(f'{{"o":"{o}","s":{s},"b":{b},"e":{e}}}' for o, s, b, e in orders) + "]"),
        "array<struct<o:string,s:int,b:int,e:int>>",
    )
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "marks", "n")).alias("c"))  # 128 at most
    rows = parts.select("part", "c", F.explode(steps).alias("x"))

    def total(test, weight=lambda c: c["n"]) -> Column:
        found = F.transform(F.filter("c", test), weight)
        return F.aggregate(found, F.lit(0).cast("long"), lambda a, n: a + n)

    own = lambda c: c["mask"].bitwiseAND(F.col("x.b")) != 0
    before = lambda c: c["mask"].bitwiseAND(F.col("x.e")) != 0
    marked = lambda bit: lambda c: own(c) & ~before(c) & (c["marks"].bitwiseAND(F.lit(bit)) != 0)
    everything = len(orders) // len(FILTERS)
    return rows.select(
        "part",
        F.col("x.o").alias("filter_order"),
        F.col("x.s").alias("step"),
        total(lambda c: ~own(c) & ~before(c)).alias("kept"),
        total(lambda c: own(c) & ~before(c)).alias("removed"),
        total(lambda c: own(c) & before(c)).alias("redundant"),
        total(lambda c: c["mask"] == F.col("x.b")).alias("unique_fails"),
        total(marked(1)).alias("good_lost"),
        total(marked(2)).alias("toxic_lost"),
        # Of the filters that a document fails, each comes first in an equal share of the orders.
        total(own, lambda c: (c["n"] * everything / F.bit_count(c["mask"])).cast("long")).alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """The interactions of the filters over all documents below ``path``, a parquet file or a folder of them.

    ``micro_batches`` is the number of batches that the files are dealt into, as far as there are so many.
    Null texts are empty ones, null langs an empty part. A null id is neither smaller nor larger than
    another: such a row never fails E and makes no other fail it. Rows with equal ids and texts are not
    copies of each other. Several labels of an id count together. Repeated labels, labels without a
    document and other columns change nothing; an empty table gives an empty result.
    """
    size = content_size(spark, path)
    folder, pattern = (path, "*") if size.is_folder else path.rstrip("/").rsplit("/", 1)
    schema = spark.read.parquet(path).schema
    docs = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max(1, -(-size.files // micro_batches)))
        .parquet(folder)
        .select("doc_id", "text", "lang")
    )
    return interactions(counters(docs, labels, scratch_path(spark, "filter_audit")))
