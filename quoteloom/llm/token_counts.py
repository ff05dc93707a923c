"""Token counts of whole texts by a map-side lookup in two tiers; no pre-token is ever shuffled.

A pre-token is a run of spaces with the characters up to the next space or line break, or a line break
with the characters up to there. The vocabulary is checked once (``check_cuts``): no piece holds a space
behind another character, and none of several characters holds a line break. Byte-pair merges then never cross
from one pre-token into the next, and the tokens of a text are the sum over its pre-tokens.

1. The driver fits a compact hash table, pre-token to number of tokens, on a bounded sample: about
   ``TableSpec.texts`` texts chosen by hash, ``TableSpec.characters`` of each. It is a cache: what it
   holds decides the speed, never a count.
2. The table and the vocabulary are broadcast; both have a fixed largest size. Tasks look pre-tokens up
   in the table, then in a bounded cache that the worker keeps from task to task, and encode the rest.

Texts are cut in blocks, so a very long one needs no list of all its pre-tokens. A run without a space
or line break is encoded whole, whatever its length, and kept in no cache beyond ``CACHED_LENGTH``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What the tokenizer writes for a space; in a text the two are the same to it.
SPACE = "▁"
LIMIT = 4096
BLOCK = 1 << 16  # characters that are cut at once
CACHE_SIZE = 1 << 17  # pre-tokens that a worker remembers
CACHED_LENGTH = 64  # characters of the longest pre-token that a table or cache holds
_PRE_TOKEN = re.compile(r" +[^ \n]*|\n[^ \n]*")
_BOUNDARY = re.compile(r"(?<=[^ ]) |\n")


@dataclass(frozen=True)
class TableSpec:
    """Bounds of the sample that fits the first tier, and of the table."""

    texts: int = 2_000
    characters: int = 4_000
    entries: int = 1 << 16


def load_processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_cuts(processor) -> None:
    """Raise unless tokens of a text are the sum over its pre-tokens."""
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    if any(a != SPACE and b == SPACE for piece in pieces for a, b in zip(piece, piece[1:])):
        raise ValueError("a piece of the vocabulary reaches over a space")
    if any("\n" in piece for piece in pieces if len(piece) > 1):
        raise ValueError("a piece of the vocabulary reaches over a line break")
    probe = "  a  ﬁ\t\nＡ "
    if processor.normalize(probe) != SPACE + probe.replace(" ", SPACE):
        raise ValueError("the tokenizer rewrites texts")


def pre_tokens(text: str, block: int = BLOCK) -> Iterator[list[str]]:
    """The pre-tokens of a text, with the space that the tokenizer puts before it, in blocks."""
    if not text:
        return
    text = " " + text.replace(SPACE, " ")
    begin = 0
    while begin < len(text):
        cut = _BOUNDARY.search(text, begin + max(1, block))
        end = cut.start() if cut else len(text)
        yield _PRE_TOKEN.findall(text, begin, end)
        begin = end


def encoded_lengths(processor, tokens: list[str]) -> list[int]:
    """Number of tokens of each pre-token inside a text.

    The tokenizer puts a space first: a run of spaces loses one, and before a line break it is a token of its own.
    """
    rows = processor.encode([t[1:] if t[0] == " " else t for t in tokens], num_threads=1)
    # A lone space: the tokenizer gives nothing for the empty text, but one token inside a text.
    return [1 if t == " " else len(r) - (t[0] == "\n") for t, r in zip(tokens, rows, strict=True)]


def fit_table(docs: DataFrame, processor, spec: TableSpec = TableSpec()) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a sample of texts, chosen by their hash.

    The share of all rows that makes ``spec.texts`` of them is chosen, each text once however often it
    stands in the table: about as many rows reach the driver at any size, never more than twice as many.
    """
    share = min(1.0, spec.texts / max(1, docs.count()))
    chosen = F.shiftrightunsigned(F.xxhash64("text"), 11) < int(share * (1 << 53))
    part = F.substring("text", 1, spec.characters).alias("part")
    counts: Counter[str] = Counter()
    for row in docs.where(chosen).select(part).where("part <> ''").distinct().limit(2 * spec.texts).collect():
        for block in pre_tokens(row["part"]):
            counts.update(t for t in block if len(t) <= CACHED_LENGTH)
    common = sorted(counts, key=lambda t: (-counts[t], t))[: spec.entries]
    return dict(zip(common, encoded_lengths(processor, common), strict=True))


class Lookup:
    """Counts tokens by the table, then by the worker's cache; misses of a batch are encoded at once.

    ``shared`` is the broadcast value: the worker keeps it, and with it the tokenizer and the cache.
    """

    def __init__(self, shared: dict):
        if "processor" not in shared:
            shared["processor"], shared["cache"] = load_processor(shared["model"]), {}
        self.processor, self.table, self.cache = shared["processor"], shared["table"], shared["cache"]

    def count(self, text: str) -> int:
        total = 0
        for block in pre_tokens(text):
            lengths = list(map(self.table.get, block))
            if None in lengths:
                total += sum(n for n in lengths if n is not None)
                total += self._missed([t for t, n in zip(block, lengths) if n is None])
            else:
                total += sum(lengths)
        return total

    def _missed(self, tokens: list[str]) -> int:
        cache = self.cache
        new = list({t for t in tokens if t not in cache})
        fresh = dict(zip(new, encoded_lengths(self.processor, new))) if new else {}
        total = sum(fresh[t] if t in fresh else cache[t] for t in tokens)
        if len(cache) + len(fresh) > CACHE_SIZE:
            cache.clear()
        if len(fresh) <= CACHE_SIZE:
            cache.update((t, n) for t, n in fresh.items() if len(t) <= CACHED_LENGTH)
        return total


def read_model(path: str) -> bytes:
    """The vocabulary file, which only the driver reads."""
    with open(path, "rb") as file:
        return file.read()


def with_token_counts(
    docs: DataFrame, model: bytes, carry: list[str | Column], out: str = "n_tokens", spec: TableSpec = TableSpec()
) -> DataFrame:
    """The columns ``carry`` of each row of ``docs`` and ``out``, the number of tokens of its whole ``text``.

    Begin, end and added special tokens are not counted, and the strings of special tokens inside a text
    are ordinary text. Null and empty texts have none. Repeated rows get equal counts, ties need no order,
    an empty table gives an empty result, and other columns are read only if carried.
    """
    processor = load_processor(model)
    check_cuts(processor)
    # Plain values: a broadcast is read by name, and executors need not have this package.
    shared = docs.sparkSession.sparkContext.broadcast({"model": model, "table": fit_table(docs, processor, spec)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value)
        for batch in batches:
            # One text at a time becomes a Python string.
            counts = [lookup.count(text.as_py() or "") for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(counts, pa.int64())], names)

    given = docs.select(F.col("text").alias("_counted"), *carry)
    kept = given.drop("_counted")
    names = [*kept.columns, out]
    return given.mapInArrow(run, T.StructType([*kept.schema, T.StructField(out, T.LongType())]))


def count_tokens(docs: DataFrame, model: bytes, limit: int = LIMIT, id_column: str = "doc_id", spec: TableSpec = TableSpec()) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of each row of ``docs``."""
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    counted = with_token_counts(docs, model, [F.col(id_column).alias("doc_id"), n_bytes], spec=spec)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
