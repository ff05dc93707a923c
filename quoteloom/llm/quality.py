"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source.

Fixed base rules come first. The documents that pass them feed one KLL sketch per (lang, source) and
metric; sketches merge into those of the language and of all documents, which stand in for groups too
small to judge by. A document is kept when each metric lies within its group's fences, the quartiles
widened by a multiple of their distance. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class QualitySpec:
    """Fences stand ``reach`` quartile distances beyond the quartiles; a distance counts as its
    metric's floor at least. Groups under ``least_group`` documents use the next wider sketch."""

    reach: float = 3.0
    least_group: int = 100
    sketch_k: int = 1024
    least_words: int = 10
    repeat_percent: int = 20


#: metric: (expression, smallest quartile distance)
METRICS = {
    "mean_word": ("word_chars / n_words", 0.8),
    "symbol_rate": ("n_symbols / n_words", 0.05),
    "dup_line_rate": ("n_dup_lines / n_words", 0.02),
    "repeat_rate": ("n_repeat_words / n_words", 0.02),
}


def _words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda variable, not a copied expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _window_hashes(words: Column) -> Column:
    """Hashes of all windows of five words (at least five words given)."""
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )


def _repeated_words(hashes: Column) -> Column:
    """Words in windows found more than once, by sorting (hash, place) and comparing neighbours."""

    def starts(ranked: Column) -> Column:
        alike = F.filter(
            ranked,
            lambda x, i: (x.getField("h") == F.get(ranked, i - 1).getField("h"))
            | (x.getField("h") == F.get(ranked, i + 1).getField("h")),
        )
        return F.array_sort(F.transform(alike, lambda x: x.getField("p")))

    def add(acc: Column, place: Column) -> Column:
        return F.struct(
            place.alias("last"),
            (acc.getField("n") + F.least(F.lit(WINDOW), place - acc.getField("last"))).alias("n"),
        )

    ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return F.aggregate(
        _bound(ranked, starts),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        add,
        lambda acc: acc.getField("n"),
    )


def text_counts(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words, computed in one row."""
    plain = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(plain, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    repeats = _bound(
        _words(text),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.when(
                F.size(words) > WINDOW,
                _bound(
                    _window_hashes(words),
                    lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _repeated_words(h)).otherwise(0),
                ),
            )
            .otherwise(0)
            .cast("long")
            .alias("n_repeat_words"),
        ),
    )
    return F.struct(
        repeats.alias("words"),
        F.length(F.translate(plain, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(plain) - F.length(F.translate(plain, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )


def count_texts(docs: DataFrame, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """doc_id, lang, source, the counts and base_failed of each row."""
    counted = docs.select("doc_id", "lang", "source", text_counts(F.col("text")).alias("c"))
    flat = counted.select(
        "doc_id",
        "lang",
        "source",
        F.col("c.words.n_words"),
        F.col("c.word_chars"),
        F.col("c.n_symbols"),
        F.col("c.n_dup_lines"),
        F.col("c.words.n_repeat_words"),
    )
    failed = (F.col("n_words") < spec.least_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * spec.repeat_percent
    )
    return flat.withColumn("base_failed", failed)


def fences(counted: DataFrame, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """One row per (lang, source) of ``counted`` with a struct low, high for each metric."""
    passed = counted.filter("not base_failed")
    own = passed.groupBy("lang", "source").agg(
        F.count("*").alias("n"),
        *[F.kll_sketch_agg_double(F.expr(e).cast("double"), spec.sketch_k).alias(m) for m, (e, _) in METRICS.items()],
    )
    own = materialize(own, "group_sketches")
    merged = [F.kll_merge_agg_double(m).alias(f"wide_{m}") for m in METRICS]
    lang = own.groupBy(F.col("lang").alias("w_lang")).agg(F.sum("n").alias("wide_n"), *merged)
    lang = materialize(lang, "language_sketches")
    # One row: the sketches of all documents.
    every = materialize(
        lang.agg(F.sum("wide_n").alias("all_n"), *[F.kll_merge_agg_double(f"wide_{m}").alias(f"all_{m}") for m in METRICS]),
        "all_sketches",
    ).first()
    groups = counted.select("lang", "source").distinct()
    joined = groups.join(
        own, groups.lang.eqNullSafe(own.lang) & groups.source.eqNullSafe(own.source), "left"
    ).select(groups.lang, groups.source, "n", *METRICS)
    joined = joined.join(lang, joined.lang.eqNullSafe(F.col("w_lang")), "left")

    def fence(metric: str) -> Column:
        whole = F.lit(bytes(every[f"all_{metric}"])) if every["all_n"] else F.lit(None).cast("binary")
        chosen = (
            F.when(F.col("n") >= spec.least_group, F.col(metric))
            .when(F.col("wide_n") >= spec.least_group, F.col(f"wide_{metric}"))
            .otherwise(whole)
        )
        at = [F.kll_sketch_get_quantile_double(chosen, F.lit(q)) for q in (0.25, 0.75)]
        spread = F.greatest(at[1] - at[0], F.lit(METRICS[metric][1]))
        return F.struct(
            (at[0] - spread * spec.reach).alias("low"), (at[1] + spread * spec.reach).alias("high")
        ).alias(metric)

    return joined.select(F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), *[fence(m) for m in METRICS])


def judge(docs: DataFrame, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed and kept of each row of ``docs``.

    Null texts have no words and fail the base rules; null languages and sources are groups; where no
    document passes the base rules there are no fences, and nothing is kept. Repeated rows are judged
    alike; an empty table gives an empty result; other columns are not read.
    """
    counted = materialize(count_texts(docs, spec), "text_counts")
    limits = materialize(fences(counted, spec), "fences")
    inside = F.lit(True)
    for metric, (expression, _) in METRICS.items():
        value = F.expr(expression).cast("double")
        inside = inside & F.coalesce(value.between(F.col(f"{metric}.low"), F.col(f"{metric}.high")), F.lit(True))
    same = counted.lang.eqNullSafe(F.col("f_lang")) & counted.source.eqNullSafe(F.col("f_source"))
    return (
        counted.join(limits, same)
        .withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(inside))
        .drop("f_lang", "f_source", *METRICS)
    )
