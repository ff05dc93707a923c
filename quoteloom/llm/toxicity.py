"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (``<`` and ``>`` mark its ends) and itself, hashed into
buckets; its vector is their mean, so an unseen misspelling shares most of its n-grams with the word
it stands for. The vectors of eight words in a row are averaged into a linear softmax, and a text is
as toxic as its worst stretch, so that a few words in a long text are not averaged away. Embeddings and
softmax are trained together with numpy, on the driver, over a bounded sample of labelled rows
(``TrainSpec.rows`` of each class, by hash order, and hash-chosen pieces of long texts); calibration sees
the sample's texts whole; every whole text is scored on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workspace import materialize
from .words import SPACED, Chunk, chunks, mix

STRETCH = 8
NGRAMS = (3, 4, 5)
THRESHOLD = 0.7
_CODES = np.random.default_rng(771).integers(1, 1 << 63, (max(NGRAMS), 256), dtype=np.uint64)


@dataclass(frozen=True)
class TrainSpec:
    """The sample holds at most ``rows`` documents of each label, of any length. Training sees up to ``longest``
    characters of each, in all 16 million: a longer text's pieces of ``piece`` characters, one at a hash-chosen
    place in each equal part of it. Training takes some 200 MB of the driver's memory then."""

    rows: int = 1000
    longest: int = 8_000
    piece: int = 500
    buckets: int = 1 << 17
    dim: int = 8
    warm_epochs: int = 300
    epochs: int = 30
    rate: float = 0.4
    decay: float = 2e-4
    misspelt: float = 0.15
    seed: int = 5


@dataclass
class Model:
    """A score for each bucket, and the calibration of a text's largest mean."""

    buckets: np.ndarray
    scale: float
    shift: float

    def probability(self, means: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.scale * means + self.shift, -30, 30)))


def subwords(letters: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of each n-gram and whole of the words that stand at ``starts`` in ``letters``."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    framed = lengths + 2
    begin = np.cumsum(framed) - framed
    total = int(framed.sum())
    owner = np.repeat(np.arange(len(starts)), framed)
    place = np.arange(total) - begin[owner]
    source = np.clip(starts[owner] + place - 1, 0, len(letters) - 1)
    text = letters[source]
    text[begin] = ord("<")
    text[begin + framed - 1] = ord(">")
    room = framed[owner] - place
    words, found = [], []
    rolling = np.zeros(total, np.uint64)
    for n in range(max(NGRAMS)):
        rolling[: total - n] += _CODES[n][text[n:]]
        if n + 1 in NGRAMS:
            valid = np.flatnonzero(room >= n + 1)
            words.append(owner[valid])
            found.append(mix(rolling[valid] + np.uint64(n)) % np.uint64(size))
    powers = mix(place.astype(np.uint64)) | np.uint64(1)
    whole = np.add.reduceat(_CODES[0][text] * powers, begin)
    words.append(np.arange(len(starts)))
    found.append(mix(whole + np.uint64(99)) % np.uint64(size))
    return np.concatenate(words), np.concatenate(found).astype(np.int64)


def _distinct_words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Places of one occurrence of each distinct word, and each word's number among them."""
    _, first, number = np.unique(chunk.word_hashes(), return_index=True, return_inverse=True)
    return first, number


def _stretch_means(scores: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, mean) of each stretch; a shorter text is one stretch."""
    size = len(scores) - STRETCH + 1
    if size > 0:
        inside = np.flatnonzero(row[:size] == row[STRETCH - 1 :])
        total = np.zeros(size)
        for k in range(STRETCH):
            total += scores[k : k + size]
        rows, starts, means = row[inside], inside, total[inside] / STRETCH
    else:
        rows, starts, means = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    short_rows, first, count = np.unique(row, return_index=True, return_counts=True)
    few = count < STRETCH
    sums = np.bincount(row, weights=scores, minlength=int(row.max()) + 1 if len(row) else 0)
    rows = np.concatenate((rows, short_rows[few]))
    starts = np.concatenate((starts, first[few]))
    means = np.concatenate((means, sums[short_rows[few]] / count[few]))
    return rows, starts, means


def _largest(rows: np.ndarray, starts: np.ndarray, means: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's largest mean and where it first starts."""
    size = int(rows.max()) + 1 if len(rows) else 0
    top = np.full(size, -np.inf)
    np.maximum.at(top, rows, means)
    hits = np.flatnonzero(means == top[rows])
    own, at = np.unique(rows[hits], return_index=True)
    return own, starts[hits][at], top[own]


def _misspell(letters: bytes, rng: np.random.Generator) -> bytes:
    """One edit inside a word: a letter dropped, doubled, swapped with the next, or replaced."""
    if len(letters) < 4:
        return letters
    at = int(rng.integers(1, len(letters) - 1))
    kind = int(rng.integers(0, 4))
    if kind == 0:
        return letters[:at] + letters[at + 1 :]
    if kind == 1:
        return letters[:at] + letters[at : at + 1] + letters[at:]
    if kind == 2:
        return letters[:at] + letters[at + 1 : at + 2] + letters[at : at + 1] + letters[at + 2 :]
    return letters[:at] + bytes([int(rng.choice(list(b"0134*@$!xe")))]) + letters[at + 1 :]


class _Bags:
    """Subword bags of a list of words, as one sorted list of buckets."""

    def __init__(self, words: list[bytes], size: int):
        buckets, counts = [], []
        for first in range(0, len(words), 20_000):
            part = words[first : first + 20_000]
            lengths = np.array([len(w) for w in part], np.int64)
            letters = np.frombuffer(b"".join(part), np.uint8)
            owner, bucket = subwords(letters, np.cumsum(lengths) - lengths, lengths, size)
            buckets.append(bucket[np.argsort(owner, kind="stable")].astype(np.int32))
            counts.append(np.bincount(owner, minlength=len(part)))
        self.bucket, self.count = np.concatenate(buckets), np.concatenate(counts)
        self.begin = np.cumsum(self.count) - self.count

    def gather(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``words``, bucket) of each subword of the given words."""
        count = self.count[words]
        owner = np.repeat(np.arange(len(words), dtype=np.int32), count)
        shift = (self.begin[words] - (np.cumsum(count) - count)).astype(np.int32)
        return owner, self.bucket[np.arange(len(owner), dtype=np.int32) + shift[owner]]


def train(texts: list[str], labels: list[int], spec: TrainSpec = TrainSpec()) -> Model:
    """Embeddings and softmax fitted together, not calibrated; without both labels every text scores 0.

    Words over 64 bytes are learnt in overlapping pieces, so that no n-gram of theirs is left out.

    Warm-up epochs take random stretches with their text's label. Then a text's worst stretch carries
    its label, and a few random ones of clean texts; a loss that is flat where the model strongly
    disagrees keeps wrong labels from being learnt by heart.
    """
    target = np.asarray(labels, np.float64)
    if not len(target) or target.min() == target.max():
        return Model(np.zeros(spec.buckets, np.float32), 0.0, -30.0)
    rng = np.random.default_rng(spec.seed)
    vocabulary: dict[bytes, int] = {}
    numbers, rows = [], []
    for chunk in chunks(pa.array(texts, pa.string()), SPACED):
        first, number = _distinct_words(chunk)
        raw = chunk.folded.tobytes()
        whole = [raw[chunk.starts[i] : chunk.ends[i]] for i in first]
        cut = [[w[k : k + 64] for k in range(0, max(1, len(w) - max(NGRAMS) + 1), 65 - max(NGRAMS))] for w in whole]
        known = np.array([vocabulary.setdefault(w, len(vocabulary)) for own in cut for w in own], np.int64)
        pieces = np.array([len(own) for own in cut], np.int64)
        each = pieces[number]
        begin = (np.cumsum(pieces) - pieces)[number] - (np.cumsum(each) - each)
        numbers.append(known[np.arange(each.sum()) + np.repeat(begin, each)].astype(np.int32))
        rows.append(np.repeat(chunk.row + chunk.first, each).astype(np.int32))
    number, row = np.concatenate(numbers), np.concatenate(rows)
    if not len(number):
        return Model(np.zeros(spec.buckets, np.float32), 0.0, -30.0)
    plain = list(vocabulary)
    bags = _Bags(plain + [_misspell(w, rng) for w in plain], spec.buckets)
    embedded = np.zeros((spec.buckets, spec.dim))
    softmax = rng.normal(0, 1, spec.dim)
    bias = 0.0
    grown_e, grown_s = np.full((spec.buckets, 1), 1e-8), np.full(spec.dim, 1e-8)
    share = np.where(target == 1, 0.5 / max(target.mean(), 1e-9), 0.5 / max(1 - target.mean(), 1e-9))
    held = rng.random(len(target)) < 0.2  # for the calibration only, see ``fit``
    spans = np.flatnonzero(np.append(True, np.diff(row) != 0))

    def word_scores() -> np.ndarray:
        each = embedded @ softmax
        own = each.astype(np.float32)[bags.bucket[: bags.begin[len(plain)]]]
        return np.add.reduceat(own, bags.begin[: len(plain)]) / bags.count[: len(plain)]

    def step(starts: np.ndarray, owner_row: np.ndarray, robust: bool) -> None:
        nonlocal bias, softmax
        at = starts[:, None] + np.arange(STRETCH)
        inside = (at < len(row)) & (row[np.minimum(at, len(row) - 1)] == owner_row[:, None])
        stretch, column = np.nonzero(inside)
        words = number[at[stretch, column]]
        words = np.where(rng.random(len(words)) < spec.misspelt, words + len(plain), words)
        owner, bucket = bags.gather(words)
        weight = (1.0 / inside.sum(1))[stretch][owner] / bags.count[words][owner]
        group = stretch[owner]
        # The mean vectors enter through their product with the softmax only, and the loss's slope at a
        # bucket is a multiple of the softmax, so sums of one number per subword are enough.
        each = embedded @ softmax
        logit = np.bincount(group, weights=weight * each[bucket], minlength=len(starts)) + bias
        p = 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))
        goal = target[owner_row]
        error = (p - goal) * share[owner_row]
        if robust:
            error *= np.where(goal == 1, p, 1.0) ** 0.7
        error /= len(starts)
        pull = np.bincount(bucket, weights=error[group] * weight, minlength=spec.buckets)
        touched = np.flatnonzero(pull)
        gradient = pull[touched, None] * softmax + spec.decay * embedded[touched] / len(target)
        own = pull @ embedded
        grown_e[touched, 0] += (gradient**2).mean(1)
        embedded[touched] -= spec.rate * gradient / np.sqrt(grown_e[touched])
        grown_s[:] += own**2
        softmax = softmax - 0.1 * spec.rate * own / np.sqrt(grown_s)
        bias -= 0.5 * float(error.sum())

    counts = np.diff(np.append(spans, len(row)))
    present = row[spans]
    learn = ~held[present]
    for _ in range(spec.warm_epochs):
        chosen = np.repeat(np.flatnonzero(learn), 6)
        starts = spans[chosen] + (rng.random(len(chosen)) * np.maximum(counts[chosen] - STRETCH + 1, 1)).astype(np.int64)
        step(starts, present[chosen], False)
    for _ in range(spec.epochs):
        rows_at, starts, means = _stretch_means(word_scores()[number], row)
        own, worst, _ = _largest(rows_at, starts, means)
        keep = ~held[own]
        clean = np.repeat(np.flatnonzero(learn & (target[present] == 0)), 2)
        extra = spans[clean] + (rng.random(len(clean)) * np.maximum(counts[clean] - STRETCH + 1, 1)).astype(np.int64)
        step(np.concatenate((worst[keep], extra)), np.concatenate((own[keep], present[clean])), True)
    return Model((embedded @ softmax).astype(np.float32), 1.0, 0.0)


def _calibrate(values: np.ndarray, goal: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """A logistic curve of one variable by Newton steps."""
    spread = values.std() or 1.0
    x = np.stack([values / spread, np.ones(len(values))], 1)
    fit = np.zeros(2)
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ fit, -30, 30)))
        slope = x.T @ (weight * (goal - p)) - 1e-3 * fit
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        fit = fit + np.linalg.solve(curve, slope)
    return float(fit[0] / spread), float(fit[1])


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learnt from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, spec: TrainSpec = TrainSpec()) -> DataFrame:
    """(doc_id, text, toxic): at most ``spec.rows`` whole texts of each label, by hash order, none held out."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    found = []
    for mark in (0, 1):
        ids = usable.filter(F.col("toxic") == mark).select(F.col("doc_id").alias("l_id")).distinct()
        # Ids without a text go before the limit, so that they take no text's place.
        ids = ids.join(texts.select("doc_id"), F.col("doc_id") == F.col("l_id"), "left_semi")
        ids = ids.withColumn("_order", F.xxhash64("l_id", F.lit("toxic"))).orderBy("_order").limit(spec.rows)
        ids = F.broadcast(materialize(ids.select("l_id"), "label_sample"))
        own = texts.join(ids, F.col("doc_id") == F.col("l_id"), "left_semi")
        own = own.orderBy(F.xxhash64("doc_id", F.lit("toxic")), "text").limit(spec.rows)
        found.append(own.withColumn("toxic", F.lit(mark)))
    return materialize(found[0].union(found[1]), "labelled_texts")


def text_pieces(doc_id: Column, text: Column, spec: TrainSpec) -> Column:
    """The text, or of one longer than ``spec.longest`` its hash-chosen pieces, joined by line breaks."""
    count = max(1, spec.longest // (spec.piece + 1))
    part = F.floor(F.length(text) / count)
    places = [
        (part * k + F.pmod(F.xxhash64(doc_id, F.lit(k)), F.greatest(part - spec.piece + 1, F.lit(1))) + 1).cast("int")
        for k in range(count)
    ]
    pieces = F.concat_ws("\n", *[F.substring(text, place, F.lit(spec.piece)) for place in places])
    return F.when(F.length(text) <= spec.longest, text).otherwise(pieces)


def fit(docs: DataFrame, labels: DataFrame, spec: TrainSpec = TrainSpec()) -> Model:
    """A model trained on the sample's pieces and calibrated on its whole texts, which executors score."""
    sample = labelled_sample(docs, labels, spec)
    order = F.xxhash64("doc_id", F.lit("toxic"))
    rows = (
        sample.select("toxic", order.alias("_order"), text_pieces(F.col("doc_id"), F.col("text"), spec).alias("_pieces"))
        .orderBy("toxic", "_order", "_pieces")
        .collect()
    )
    model = train([r["_pieces"] for r in rows], [r["toxic"] for r in rows], spec)
    if not model.scale:
        return model
    found = score(sample, model, ["toxic"], "mean", raw=True).filter(~F.isnan("mean")).orderBy("toxic", "mean").collect()
    means, goal = np.array([r["mean"] for r in found]), np.array([r["toxic"] for r in found], np.float64)
    share = np.where(goal == 1, 0.5 / max(goal.mean(), 1e-9), 0.5 / max(1 - goal.mean(), 1e-9))
    return Model(model.buckets, *_calibrate(means, goal, share))


def score(docs: DataFrame, model: Model, carry: list[str], out: str = "score", raw: bool = False) -> DataFrame:
    """The columns ``carry`` of each row and ``out``, its score; a text without words scores 0.

    ``raw`` gives the largest mean of a stretch instead, NaN for a text without words.
    """
    # Plain values: a broadcast is read by name, and executors need not have this package.
    shared = docs.sparkSession.sparkContext.broadcast((model.buckets, model.scale, model.shift))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            for chunk in chunks(batch.column(0), SPACED):
                result = np.full(chunk.rows, np.nan) if raw else np.zeros(chunk.rows)
                if len(chunk.starts):
                    first, number = _distinct_words(chunk)
                    lengths = (chunk.ends - chunk.starts)[first]
                    owner, bucket = subwords(chunk.folded, chunk.starts[first], lengths, len(model.buckets))
                    sums = np.bincount(owner, weights=model.buckets[bucket], minlength=len(first))
                    each = sums / np.bincount(owner, minlength=len(first))
                    rows, _, means = _stretch_means(each[number], chunk.row)
                    worst = np.full(chunk.rows, -np.inf)
                    np.maximum.at(worst, rows, means)
                    seen = chunk.counts > 0
                    result[seen] = worst[seen] if raw else model.probability(worst[seen])
                own = [c.slice(chunk.first, chunk.rows) for c in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*own, pa.array(result)], [*carry, out])

    fields = T.StructType([*(docs.schema[c] for c in carry), T.StructField(out, T.DoubleType())])
    return docs.select(F.col("text").alias("_scored"), *carry).mapInArrow(run, fields)


def detect(docs: DataFrame, labels: DataFrame, spec: TrainSpec = TrainSpec()) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``.

    The model is trained when this is called. Null and empty texts score 0; a null id is never learnt
    from and not held out; repeated rows score alike; without labels of both kinds every score is 0;
    an empty table gives an empty result. Only doc_id and text of ``docs`` and doc_id and toxic of
    ``labels`` are read.
    """
    model = fit(docs, labels, spec)
    return (
        score(docs, model, ["doc_id"])
        .withColumn("held_out", held_out(F.col("doc_id")))
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, spec: TrainSpec = TrainSpec()) -> DataFrame:
    """The rows of ``docs`` below the threshold, with all their columns, in one pass."""
    model = fit(docs, labels, spec)
    name = "toxicity"
    while name in docs.columns:
        name = f"_{name}"
    return score(docs, model, docs.columns, name).filter(F.col(name) < THRESHOLD).drop(name)
