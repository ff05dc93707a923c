"""Mixing sources to target weights by hash order and prefix sums.

Each document gets a hash-random key; within its source documents are sorted by it, ranges of keys
at a time, and running word counts say where the source's budget ends. A budget above the source's
size repeats it: whole epochs first, then documents in key order, the last of them up to the exact
word. Everything follows from the rows' values, so reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ids import with_dense_ids
from ..workspace import materialize
from .ordering import running_totals, stable_key

WORD = r"[^\x20\x09-\x0D]+"
_WORD_END = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"


@dataclass(frozen=True)
class MixSpec:
    """Weights repeat over the sources by code point, null last; no source gives more than ``epochs``
    times its size; the mix is ``share`` of all sizes."""

    weights: tuple[int, ...] = (1, 2, 3)
    epochs: int = 3
    share: float = 1.0


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, spec: MixSpec) -> DataFrame:
    """(m_source, source_size, target) of each source of ``sized`` (source, size).

    A level ``x`` gives a source ``x`` times its weight, at most ``epochs`` times its size; what caps
    leave over raises the level for the others. Only sums over the table of sources reach the driver.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_dense_ids(
        materialize(sums.withColumn("_last", F.col("source").isNull().cast("int")), "source_sizes"),
        ["_last", "source"],
        "_rank",
        -1,
    )
    weights = F.array(*[F.lit(w) for w in spec.weights])
    table = materialize(
        ranked.select(
            "source",
            "source_size",
            F.element_at(weights, (F.col("_rank") % len(spec.weights) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * spec.epochs).alias("cap"),
        ),
        "source_weights",
    )
    wanted = float(table.agg(F.sum("source_size")).first()[0] or 0) * spec.share
    level, capped = 0.0, -1
    while True:
        over = F.col("cap") < F.col("weight") * F.lit(level)
        taken, count, open_weight = table.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(over.cast("int")), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
        ).first()
        if count == capped or not open_weight:
            break
        level, capped = (wanted - taken) / open_weight, count
    return table.select(
        F.col("source").alias("m_source"),
        "source_size",
        F.when(F.col("cap") < F.col("weight") * F.lit(level), F.col("cap").cast("double"))
        .otherwise(F.col("weight") * F.lit(level))
        .alias("target"),
    )


def with_taken(rows: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """Add source_size, target and taken (words that the mix takes) to rows (doc_id, source, size, mix_key).

    Every other column is carried along. A source without words has target 0 and gives nothing. Null
    sources are one source; an empty table gives an empty result; repeated rows count as often as they
    stand, and which of them is cut does not show.
    """
    targets = materialize(source_targets(rows.select("source", "size"), spec), "source_targets")
    placed = running_totals(rows, "source", "mix_key", "size", ["doc_id", "size"], "_earlier")
    joined = placed.join(targets, placed.source.eqNullSafe(targets.m_source)).drop("m_source")
    budget = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - whole * F.col("source_size")
    last = F.least(F.greatest(rest - F.col("_earlier"), F.lit(0)), F.col("size"))
    return (
        joined.withColumn("_whole", whole.cast("long"))
        .withColumn("_cut", last.cast("long"))
        .withColumn("taken", F.col("_whole") * F.col("size") + F.col("_cut"))
        .drop("_earlier")
    )


def mix(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: each as often as the mix takes it.

    The document at which a source's budget ends is cut after its last word taken (``n_chars``, where
    there is one, follows). Documents without words are taken as often as their source's whole epochs.
    """
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_doc"),  # out of the way of the names below
        "doc_id",
        "source",
        word_count().alias("size"),
        stable_key("doc_id", "text").alias("mix_key"),
    )
    taken = with_taken(rows, spec)
    copies = F.col("_whole") + (F.col("_cut") > 0).cast("long")
    copied = taken.filter(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    partial = (F.col("_copy") > F.col("_whole")) & (F.col("_cut") < F.col("size"))
    pieces = F.split(F.col("_doc.text"), _WORD_END)
    start = F.when(partial, F.array_join(F.slice(pieces, 1, F.col("_cut").cast("int")), ""))
    copied = copied.withColumn("_start", start)
    cut = {"text": F.col("_start"), "n_chars": F.length("_start")}
    return copied.select(
        *[
            F.when(F.col("_start").isNotNull(), cut[f.name].cast(f.dataType)).otherwise(F.col("_doc")[f.name]).alias(f.name)
            if f.name in cut
            else F.col("_doc")[f.name].alias(f.name)
            for f in docs.schema.fields
        ]
    )
