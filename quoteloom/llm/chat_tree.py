"""Conversations as a prefix tree: shared turns once, depth first, with positions and attention.

A node is a turn together with all turns before it, named by a chain hash. Conversations are ranked by
their paths of chain hashes; the lowest rank on a node emits it, so that nodes ordered by (rank, depth)
are a depth-first walk. What one rank emits is a segment: its tokens stand in a row, and the ranges of
the stream that a token may attend to are its segment's ancestors and what precedes it in the segment.
Positions count along the conversation. Only hashes are gathered per conversation (eight bytes a turn),
texts never; a first turn that many conversations share is one row after a partial aggregate.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts, a backslash is put before
the bar of ``<|`` (one more where some stand already) and is taken away on reading; a line break in a
role is written as a backslash and n, a backslash there as two.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ids import with_dense_ids
from ..workspace import materialize

START, END = "<|im_start|>", "<|im_end|>"
#: Vocabulary of a public tokenizer; the driver reads it and broadcasts the ranks.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how that tokenizer splits text before merging bytes.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LOSS_ROLE = "assistant"
_PIECE = 2_000  # characters that are tokenized at once
_RANKS = 20_000  # conversations whose totals are summed up together


def escape(text: str) -> str:
    """No control string is left: every ``<``, backslashes, ``|`` gets one backslash more."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def render(role: str, text: str) -> tuple[str, str, str]:
    """The three parts of a turn: header, body (under the loss for the loss role), end."""
    return f"{START}{escape_role(role)}\n", escape(text), f"{END}\n"


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of one rendered turn."""
    head, _, rest = formatted[len(START) :].partition("\n")
    return unescape_role(head), unescape(rest[: -len(END) - 1])


class Tokens:
    """Byte-pair tokens with two control tokens behind the vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        size = max(ranks.values()) + 1
        self.control = {START: size, END: size + 1}
        self.named = {v: k.encode() for k, v in self.control.items()}
        self.encoding = tiktoken.Encoding("chat", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        found: list[int] = []
        for begin in range(0, len(text), _PIECE):
            found += self.encoding.encode_ordinary(text[begin : begin + _PIECE])
        return found

    def decode(self, tokens: list[int]) -> str:
        out, plain = b"", []
        for token in tokens:
            if token in self.named:
                out, plain = out + self.encoding.decode_bytes(plain) + self.named[token], []
            else:
                plain.append(token)
        return (out + self.encoding.decode_bytes(plain)).decode()

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Tokens of a rendered turn, and where its body begins and ends among them."""
        head, body, _ = render(role, text)
        first = [self.control[START], *self.encode(head[len(START) :])]
        inner = self.encode(body)
        return [*first, *inner, self.control[END], *self.encode("\n")], len(first), len(first) + len(inner)


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in (x.split() for x in lines if x.strip())}


def _chained(turns: DataFrame) -> DataFrame:
    """conv (a struct of conv_id, never null), depth, node, role, text; turns in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, depth, chain = None, 0, b""
        for batch in batches:
            ids, roles, texts = (batch.column(k).to_pylist() for k in range(3))
            depths, nodes = [], []
            for conv, role, text in zip(ids, roles, texts, strict=True):
                if current != (conv,):
                    current, depth, chain = (conv,), 0, b""
                turn = hashlib.blake2b(role.encode() + b"\n" + text.encode(), digest_size=16).digest()
                chain = hashlib.blake2b(chain + len(role).to_bytes(8, "big") + turn, digest_size=8).digest()
                depths.append(depth)
                nodes.append(int.from_bytes(chain, "big", signed=True))
                depth += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(depths, pa.int64()), pa.array(nodes, pa.int64()), *batch.columns[1:3]],
                ["conv_id", "depth", "node", "role", "text"],
            )

    kind = turns.schema["conv_id"].dataType.simpleString()
    plain = turns.select(
        "conv_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "turn"
    )
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    chained = ordered.select("conv_id", "role", "text").mapInArrow(
        run, f"conv_id {kind}, depth bigint, node bigint, role string, text string"
    )
    return chained.select(F.struct("conv_id").alias("conv"), "depth", "node", "role", "text")


def prefix_tree(turns: DataFrame, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths) of ``turns`` (conv_id, turn, role, text).

    nodes: segment, depth, node, start, position, ancestors (ranges of the stream), tokens, loss_low,
    loss_high (tokens of the body that are learnt; equal for other roles). ``start`` is the place of the
    first token in the one stream of all trees; a segment's nodes follow each other. paths: conv, depth,
    node. Null roles and texts are empty; rows of one turn number are ordered by role and text; null
    turns come first; a null conv_id is a conversation of its own; repeated rows are turns of their own;
    an empty table gives empty results; other columns are not read.
    """
    spark = turns.sparkSession
    chained = materialize(_chained(turns), "chained_turns")
    # Eight bytes a turn for each conversation.
    paths = chained.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("steps"))
    paths = paths.select("conv", F.transform("steps", lambda s: s.getField("node")).alias("path"))
    ranked = with_dense_ids(materialize(paths, "paths"), ["path", "conv"], "rank", -1)
    steps = materialize(ranked.select("conv", "rank", F.posexplode("path").alias("depth", "node")), "steps")
    firsts = materialize(steps.groupBy("node").agg(F.min("rank").alias("segment")), "emitters")
    placed = materialize(steps.join(firsts, "node"), "placed_steps")

    emitted = placed.filter("rank = segment").select("conv", F.col("depth").cast("long"), "segment")
    own = chained.join(emitted, ["conv", "depth"]).select("segment", "depth", "node", "role", "text")
    ranks = spark.sparkContext.broadcast(load_ranks(vocabulary))  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Tokens(ranks.value)
        for batch in batches:
            turns = [coder.turn(r, t) for r, t in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            learnt = [r == LOSS_ROLE for r in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([t for t, _, _ in turns], pa.list_(pa.int32())),
                    pa.array([low for _, low, _ in turns], pa.int32()),
                    pa.array([high if k else low for (_, low, high), k in zip(turns, learnt, strict=True)], pa.int32()),
                ],
                ["segment", "depth", "node", "tokens", "loss_low", "loss_high"],
            )

    coded = own.mapInArrow(
        run, "segment bigint, depth bigint, node bigint, tokens array<int>, loss_low int, loss_high int"
    )
    coded = materialize(coded, "coded_nodes")
    sizes = coded.select("segment", "depth", "node", F.size("tokens").cast("long").alias("n"))
    located = materialize(_located(sizes), "located_nodes")

    # A segment's ancestors: for each segment on its path, the range from there to the turning-off.
    heads = located.groupBy("segment").agg(F.min("depth").alias("head"))
    above = placed.join(heads.withColumnRenamed("segment", "rank"), "rank").filter("depth < head")
    above = above.select("rank", "node", F.col("segment").alias("other"))
    ranges = (
        above.join(located.select("node", "start", "n"), "node")
        .groupBy("rank", "other")
        .agg(F.min("start").alias("low"), F.max(F.col("start") + F.col("n")).alias("high"))
        .groupBy("rank")
        .agg(
            F.sum(F.col("high") - F.col("low")).alias("base"),
            F.array_sort(F.collect_list(F.struct("low", "high"))).alias("above"),
        )
    )
    ranges = materialize(ranges, "ancestors").withColumnRenamed("rank", "segment")
    none = F.array().cast("array<struct<low:bigint,high:bigint>>")
    nodes = (
        coded.join(located.select("node", "start", "inside"), "node")
        .join(ranges, "segment", "left")
        .select(
            "segment",
            "depth",
            "node",
            "start",
            (F.coalesce("base", F.lit(0)) + F.col("inside")).alias("position"),
            F.concat(
                F.coalesce("above", none),
                F.when(
                    F.col("inside") > 0,
                    F.array(F.struct((F.col("start") - F.col("inside")).alias("low"), F.col("start").alias("high"))),
                ).otherwise(none),
            ).alias("ancestors"),
            "tokens",
            "loss_low",
            "loss_high",
        )
    )
    return materialize(nodes, "tree_nodes"), placed.select("conv", "depth", "node")


def _located(sizes: DataFrame) -> DataFrame:
    """Add ``inside`` (tokens before the node in its segment) and ``start`` (in the stream)."""
    totals = sizes.groupBy("segment").agg(F.sum("n").alias("total"))
    totals = materialize(totals.withColumn("block", F.floor(F.col("segment") / _RANKS)), "segment_totals")
    # One row for each _RANKS conversations.
    blocks = totals.groupBy("block").agg(F.sum("total").alias("sum"))
    blocks = blocks.withColumn(
        "before", F.coalesce(F.sum("sum").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    earlier = Window.partitionBy("block").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.join(materialize(blocks.select("block", "before"), "blocks"), "block").select(
        "segment", (F.col("before") + F.coalesce(F.sum("total").over(earlier), F.lit(0))).alias("segment_start")
    )
    along = Window.partitionBy("segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    inner = sizes.withColumn("inside", F.coalesce(F.sum("n").over(along), F.lit(0)))
    return inner.join(materialize(starts, "segment_starts"), "segment").select(
        "segment", "depth", "node", "n", "inside", (F.col("segment_start") + F.col("inside")).alias("start")
    )


def read_back(nodes: DataFrame, paths: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Digests of each conversation, from the tokens along its path.

    conv_id, n_turns, turns_sha256 (role, line break, text, line break of each turn), loss_chars,
    loss_sha256 (all text under the loss mask), formatted_chars, n_tokens.
    """
    ranks = nodes.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Tokens(ranks.value)
        for batch in batches:
            every = batch.column(1).to_pylist()
            low, high = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([coder.decode(t) for t in every], pa.string()),
                    pa.array([coder.decode(t[a:b]) for t, a, b in zip(every, low, high, strict=True)], pa.string()),
                    pa.array([len(t) for t in every], pa.int64()),
                ],
                ["node", "formatted", "learnt", "n"],
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
        current = None

        def row():
            conv, count, turns, learnt, loss, size, n = current
            return conv[0], count, turns.hexdigest(), learnt, loss.hexdigest(), size, n

        for batch in batches:
            done = []
            for conv, formatted, learnt, n in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if current is None or current[0] != (conv,):
                    if current is not None:
                        done.append(row())
                    current = [(conv,), 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                role, text = parse(formatted)
                under = unescape(learnt)
                current[1] += 1
                current[2].update(f"{role}\n{text}\n".encode())
                current[3] += len(under)
                current[4].update(under.encode())
                current[5] += len(formatted)
                current[6] += n
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, d, strict=True)) for d in done], schema)
        if current is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, row(), strict=True))], schema)

    kind = paths.schema["conv"].dataType["conv_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema(
        [
            ("conv_id", to_arrow_type(kind)),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
            ("n_tokens", pa.int64()),
        ]
    )
    texts = materialize(
        nodes.select("node", "tokens", "loss_low", "loss_high").mapInArrow(
            decoded, "node bigint, formatted string, learnt string, n bigint"
        ),
        "node_texts",
    )
    along = (
        paths.join(texts, "node")
        .select(F.col("conv.conv_id").alias("conv_id"), "depth", "formatted", "learnt", "n")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "depth")
        .select("conv_id", "formatted", "learnt", "n")
    )
    return along.mapInArrow(
        digest,
        f"conv_id {kind.simpleString()}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint, n_tokens bigint",
    )
