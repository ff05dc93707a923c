"""URL verdicts from host rules, else from the words of host and path.

Host labels are split into words by a unigram Viterbi search: the words are pieces of labels with hyphens,
path words and the seed terms, counted over the whole table. A label without a hyphen is what is to be
split; counted as a word, it would always be cheaper whole. Multinomial
naive Bayes then scores host words and path tokens. It is trained on the table itself: a host with a
seed term among its words teaches "block", the others "allow", so that words which keep company with
the seeds count as well. Both tables of counts are whole and stay distributed: words meet the substrings
of distinct hosts, tokens the distinct hosts and paths, in joins; totals alone reach the driver.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize
from .site_lines import url_host

#: Words of unwanted sites, the weak labels.
SEEDS = (
    "adult", "porn", "sex", "xxx", "escort", "casino", "poker", "slots", "gambling", "bet", "bets", "betting", "jackpot",
    "pills", "viagra", "cialis", "pharmacy", "meds", "spam", "malware", "warez", "torrent", "crack", "hack", "ads",
    "adserver", "track", "tracker", "clickbait", "payday", "loan", "loans", "replica", "giveaway",
)
#: Words that often stand beside others in host names.
COMMON = (
    "www", "blog", "news", "shop", "store", "online", "the", "my", "free", "cheap", "best", "win", "live", "cam", "cams",
    "top", "farm", "web", "site", "home", "forum", "wiki", "media", "mobile", "mail", "world", "daily", "tech", "cash",
    "money", "buy", "now", "fast", "easy", "hot", "girls", "games", "game", "play", "club", "zone", "deal", "deals",
)


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and the start of a path."""

    pattern: str  # like "example.com/en/"
    allow: bool

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


@dataclass(frozen=True)
class UrlSpec:
    seeds: tuple[str, ...] = SEEDS
    longest_word: int = 24
    smoothing: float = 0.5
    prior: float = 0.2  # of "block"


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The pattern of the longest rule that fits, else null; of equally long ones the first by code point."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern))[::-1]:
        own = (host == rule.host) | host.endswith("." + rule.host)
        found = F.when(own & path.startswith(rule.path), F.lit(rule.pattern)).otherwise(found)
    return found


def path_tokens(path: str) -> list[str]:
    """Letter runs of a path; digit runs become one token."""
    return ["#" if t[0].isdigit() else t for t in re.findall(r"[^\W\d_]+|\d+", path.lower())]


def host_parts(host: str) -> list[str]:
    """Runs of digits and of other characters in all labels but the last, the top-level domain; a host
    without dots is one label."""
    named = host.rpartition(".")[0] if "." in host else host
    labels = [x for x in re.split(r"[^a-z0-9\x80-\U0010ffff]+", named) if x]
    return [part for x in labels for part in re.findall(r"\d+|\D+", x)]


class Segmenter:
    """Unigram Viterbi splits of host labels.

    ``counts`` may hold no more than the words that occur in the hosts to split; ``total`` then is the sum
    over all words.
    """

    def __init__(self, counts: dict[str, int], longest: int = 24, total: int | None = None):
        self.total = (sum(counts.values()) if total is None else total) + 1
        self.costs = {w: -math.log(c / self.total) for w, c in counts.items() if len(w) <= longest}
        self.longest = longest
        self.split = lru_cache(100_000)(self._split)

    def _unknown(self, size: int) -> float:
        return math.log(self.total) + 2.3 * size + 2.0

    def _split(self, label: str) -> tuple[str, ...]:
        """The cheapest words; a run of letters that no words cover is one word.

        An unknown word's cost grows evenly with its size, so the best place for one to begin is the same
        for all ends behind it, and only known words are searched for.
        """
        best = [(0.0, 0)]
        open_cost, opened = math.inf, 0
        for end in range(1, len(label) + 1):
            if (own := best[end - 1][0] - self._unknown(end - 1)) < open_cost:
                open_cost, opened = own, end - 1
            found = (best[opened][0] + self._unknown(end - opened), opened)
            for begin in range(max(0, end - self.longest), end):
                known = self.costs.get(label[begin:end])
                if known is not None and best[begin][0] + known < found[0]:
                    found = (best[begin][0] + known, begin)
            best.append(found)
        words, end = [], len(label)
        while end:
            begin = best[end][1]
            words.append(label[begin:end])
            end = begin
        return tuple(reversed(words))

    def words(self, host: str) -> list[str]:
        return [w for part in host_parts(host) for w in self.split(part)]


def word_counts(parts: DataFrame, spec: UrlSpec) -> DataFrame:
    """(word, n) of all separated words, over all distinct hosts and all paths of ``parts`` (host, path)."""
    label = F.explode(F.split(F.regexp_replace("host", r"\.[^.]*$", ""), r"\."))
    pieces = parts.select("host").distinct().select(label.alias("label")).filter(F.col("label").contains("-"))
    hyphened = pieces.select(F.explode(F.split("label", r"[^a-z]+")).alias("word"))
    in_paths = parts.select(F.explode(F.split(F.lower("path"), r"[^a-z]+")).alias("word"))
    counted = hyphened.union(in_paths).filter(F.length("word").between(2, spec.longest_word))
    counted = materialize(counted.groupBy("word").agg(F.count("*").alias("n")), "separated_words")
    floor = max(1, (counted.agg(F.sum("n")).first()[0] or 0) // 10_000)
    given = parts.sparkSession.createDataFrame([(w, floor) for w in (*COMMON, *spec.seeds)], "word string, n long")
    return materialize(counted.union(given).groupBy("word").agg(F.sum("n").alias("n")), "words")


def host_words(parts: DataFrame, counts: DataFrame, spec: UrlSpec) -> DataFrame:
    """host, host_no, pages (its rows), words and block of each distinct host.

    The substrings of a host meet the counts in a join, so a task knows the words in its own hosts only.
    """
    hosts = parts.groupBy("host").agg(F.count("*").alias("pages"))
    hosts = materialize(hosts.withColumn("host_no", F.monotonically_increasing_id()), "hosts")
    total = counts.agg(F.sum("n")).first()[0]
    longest, seeds = spec.longest_word, frozenset(spec.seeds)
    shortest = min(2, *map(len, spec.seeds)) if spec.seeds else 2

    def substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(numbers: list, found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(found, pa.string())], ["host_no", "word"])

        for batch in batches:
            numbers, found = [], []
            for number, host in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {
                    part[i : i + k]
                    for part in host_parts(host)
                    for i in range(len(part))
                    for k in range(shortest, min(longest, len(part) - i) + 1)
                }
                numbers += [number] * len(own)
                found += own
                if len(found) >= 100_000:
                    yield batch_of(numbers, found)
                    numbers, found = [], []
            yield batch_of(numbers, found)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "host_no", "pages", "words", "block"]
        for batch in batches:
            known = {w["word"]: w["n"] for own in batch.column(3).to_pylist() for w in own or ()}
            segmenter = Segmenter(known, longest, total)
            found = [segmenter.words(h) for h in batch.column(0).to_pylist()]
            block = [not seeds.isdisjoint(w) for w in found]
            columns = [*batch.columns[:3], pa.array(found, pa.list_(pa.string())), pa.array(block, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names)

    pairs = hosts.select("host_no", "host").mapInArrow(substrings, "host_no long, word string")
    known = pairs.join(counts, "word").groupBy("host_no").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    joined = hosts.join(known, "host_no", "left").select("host", "host_no", "pages", "known")
    done = joined.mapInArrow(split, "host string, host_no long, pages long, words array<string>, block boolean")
    return materialize(done, "host_words")


def path_counts(rows: DataFrame, key: str) -> DataFrame:
    """(key, token, n) of the path tokens of ``rows`` (key, path), summed up within batches only."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for own, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.update((own, t) for t in path_tokens(path))
            columns = [[k for k, _ in seen], [t for _, t in seen], list(seen.values())]
            types = [batch.column(0).type, pa.string(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [key, "token", "n"])

    return rows.select(key, "path").mapInArrow(run, f"{key} {kind}, token string, n long")


def token_ratios(parts: DataFrame, hosts: DataFrame, spec: UrlSpec) -> DataFrame:
    """(token, ratio) of all tokens: naive Bayes' log ratio of block to allow, over all rows."""
    in_hosts = hosts.select("block", F.explode("words").alias("token"), F.col("pages").alias("n"))
    in_paths = path_counts(parts.join(hosts.select("host", "block"), "host"), "block")
    seeds = parts.sparkSession.createDataFrame([(True, s, 1) for s in spec.seeds], "block boolean, token string, n long")
    block, allow = (F.sum(F.when(F.col("block") == b, F.col("n")).otherwise(0)) for b in (True, False))
    counted = in_hosts.union(in_paths).union(seeds).groupBy("token").agg(block.alias("block"), allow.alias("allow"))
    counted = materialize(counted, "tokens")
    size, *totals = counted.agg(F.count("*"), F.sum("block"), F.sum("allow")).first()
    logs = [
        F.log((F.col(name) + spec.smoothing) / ((total or 0) + spec.smoothing * size))
        for name, total in zip(("block", "allow"), totals, strict=True)
    ]
    return counted.select("token", (logs[0] - logs[1]).alias("ratio"))


def total_ratios(tokens: DataFrame, ratios: DataFrame, key: str) -> DataFrame:
    """(key, total) of ``tokens`` (key, token, n): the sum of their ratios, in order, so that reruns agree."""
    each = tokens.join(ratios, "token").groupBy(key).agg(F.array_sort(F.collect_list(F.col("n") * F.col("ratio"))).alias("_each"))
    return each.select(key, F.aggregate("_each", F.lit(0.0), lambda total, x: total + x).alias("total"))


def judge_urls(pages: DataFrame, rules: list[Rule], spec: UrlSpec = UrlSpec(), id_column: str = "page_id") -> DataFrame:
    """id, host, path, rule, score, words and verdict of each row of ``pages`` (id, url).

    ``verdict`` is the rule's, else block when the words' score is above 0. Null urls and those without
    ``://`` have an empty host and path, no words, and are allowed. Repeated rows are judged alike; an
    empty table gives an empty result; other columns are not read.
    """
    parts = materialize(
        pages.select(F.col(id_column), url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")), "urls"
    )
    hosts = host_words(parts, word_counts(parts, spec), spec)
    ratios = token_ratios(parts, hosts, spec)
    paths = parts.select("path").distinct().withColumn("path_no", F.monotonically_increasing_id())
    paths = materialize(paths, "paths")
    said = hosts.select("host_no", F.explode("words").alias("token"), F.lit(1).alias("n"))
    # Written first, so that AQE splits the rows of a hot host or path.
    by_host = materialize(
        hosts.join(total_ratios(said, ratios, "host_no"), "host_no", "left").select(
            "host", F.array_join("words", " ").alias("words"), F.coalesce("total", F.lit(0.0)).alias("_host_total")
        ),
        "host_totals",
    )
    by_path = materialize(
        paths.join(total_ratios(path_counts(paths, "path_no"), ratios, "path_no"), "path_no", "left").select(
            "path", F.coalesce("total", F.lit(0.0)).alias("_path_total")
        ),
        "path_totals",
    )
    prior = math.log(spec.prior / (1 - spec.prior))
    scored = parts.join(by_host, "host").join(by_path, "path").select(
        id_column, "host", "path", (F.lit(prior) + F.col("_host_total") + F.col("_path_total")).alias("score"), "words"
    )
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    allowed = F.lit(None).cast("boolean")
    for r in rules:
        allowed = F.when(F.col("rule") == r.pattern, F.lit(r.allow)).otherwise(allowed)
    verdict = F.coalesce(allowed, F.col("score") <= 0)
    return scored.withColumn("rule", rule).withColumn("verdict", F.when(verdict, F.lit("allow")).otherwise(F.lit("block")))
