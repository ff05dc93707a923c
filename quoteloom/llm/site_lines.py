"""Boilerplate lines by their frequency within a site.

A line's frequency is the share of its host's pages that contain it. Lines above a ratio go, on hosts
with enough pages. A host's boilerplate lines number at most its mean of distinct lines per page
divided by the ratio, so they travel as one array per host. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize

SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class SiteRule:
    """Drop lines on more than ``ratio`` of a host's pages, and on ``least_pages`` pages at least."""

    ratio: float = 0.2
    least_pages: int = 3


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z folded; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def html_lines(html: Column) -> Column:
    """The text lines of a page: comments, scripts and styles go, block tags end a line, others vanish."""
    text = F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")
    text = F.regexp_replace(text, r"(?i)</?(p|div|li|ul|ol|nav|article|h[1-6]|br|tr|td|table|title|head|body|html|section|header|footer)\b[^>]*>", "\n")
    return plain_lines(F.regexp_replace(text, r"<[^>]*>", ""))


def plain_lines(text: Column) -> Column:
    """Lines of a text without outer white space; blank ones go, null has none."""
    trimmed = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(SPACES)))
    return F.filter(trimmed, lambda x: x != "")


def drop_site_boilerplate(
    pages: DataFrame, site: Column, lines: Column, rule: SiteRule = SiteRule()
) -> DataFrame:
    """``pages`` with site, n_lines, n_dropped and kept_text (kept lines joined by line breaks).

    A line counts once per page however often it stands there; all its places go. Pages without a
    site form a site of their own (null). Null and empty pages have no lines; repeated rows count as
    pages of their own; an empty table gives an empty result. Columns named like the new ones are
    replaced.
    """
    narrow = pages.select(F.struct(site.alias("g")).alias("_site"), F.transform(lines, lambda x: F.xxhash64(x)).alias("_lines"))
    seen = narrow.select("_site", F.explode(F.array_distinct("_lines")).alias("_line"))
    shared = seen.groupBy("_site", "_line").agg(F.count("*").alias("_pages")).filter(F.col("_pages") >= rule.least_pages)
    # Written first: the sites' totals are then joined with a table of known size.
    shared = materialize(shared, "shared_lines")
    totals = materialize(narrow.groupBy("_site").agg(F.count("*").alias("_total")), "site_totals")
    boilerplate = (
        shared.join(totals, "_site")
        .filter(F.col("_pages") > rule.ratio * F.col("_total"))
        .groupBy("_site")
        .agg(F.collect_set("_line").alias("_drop"))
    )
    boilerplate = materialize(boilerplate, "site_boilerplate")
    none = F.array().cast("array<bigint>")
    whole = (
        pages.select(
            F.struct(*[pages[c] for c in pages.columns]).alias("_page"),  # out of the way of the names below
            F.struct(site.alias("g")).alias("_site"),
            lines.alias("_all"),
        )
        .join(boilerplate, "_site", "left")
        .withColumn("_drop", F.coalesce("_drop", none))
    )
    clean = F.filter("_all", lambda x: ~F.array_contains(F.col("_drop"), F.xxhash64(x)))
    new = ["site", "n_lines", "n_dropped", "kept_text"]
    return whole.withColumn("_kept", clean).select(
        *[F.col("_page")[c].alias(c) for c in pages.columns if c not in new],
        F.col("_site.g").alias("site"),
        F.size("_all").cast("long").alias("n_lines"),
        (F.size("_all") - F.size("_kept")).cast("long").alias("n_dropped"),
        F.array_join("_kept", "\n").alias("kept_text"),
    )
