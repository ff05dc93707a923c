"""Filter audit, vector codes and token counts against plain versions."""

import hashlib
import itertools
import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import SPACED
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quoteloom.llm import filter_audit, token_counts, vector_codes

DOCS = "doc_id long, text string, lang string, source string, mask int, now string"


# Filter audit


def plain_audit(docs, labels):
    """All columns of every (part, order, step), document by document."""
    low, marks = {}, defaultdict(set)
    for doc_id, text, _ in docs:
        if doc_id is not None:
            low[text or ""] = min(low.get(text or "", doc_id), doc_id)
    for doc_id, quality, toxic in labels:
        marks[doc_id] |= {k for k, v in (("good", quality), ("toxic", toxic)) if v == 1}
    parts = defaultdict(list)
    for doc_id, text, lang in docs:
        text = text or ""
        words = SPACED.findall(text)
        fails = ""
        if len(words) < 200:
            fails += "A"
        if 100 * len(set(words)) < 50 * len(words):
            fails += "B"
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            fails += "C"
        if re.search(r"[#$%&*|]", text):
            fails += "D"
        if doc_id is not None and doc_id > low[text]:
            fails += "E"
        parts[lang or ""].append((fails, marks[doc_id] if doc_id is not None else set()))
    out = []
    for part, rows in parts.items():
        removed_by = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = [False] * len(rows)
            for step, name in enumerate(order, 1):
                hit = [name in fails for fails, _ in rows]
                now = [h and not g for h, g in zip(hit, gone)]
                redundant = sum(h and g for h, g in zip(hit, gone))
                gone = [g or h for h, g in zip(hit, gone)]
                removed_by[name] += sum(now)
                out.append([
                    part, order, step, gone.count(False), sum(now), redundant, sum(f == name for f, _ in rows),
                    sum(n and "good" in m for n, (_, m) in zip(now, rows)),
                    sum(n and "toxic" in m for n, (_, m) in zip(now, rows)),
                ])
        for row in out:
            if row[0] == part:
                row.append(removed_by[row[1][row[2] - 1]])
    return sorted(map(tuple, out))


def texts(rng):
    long = " ".join(f"w{k}" for k in range(300))
    return [
        None, "", " ", "short", "SHOUT", "a#b", "a " * 300, long, long + " $", long.upper(), "x\x0by\x1fz " * 90, "é😀 " * 250,
        long + " Q" * 20, " ".join(f"w{k} w{k}" for k in range(150)), "w " * 199 + "v", long * 40, "tab\tA\nB",
    ]


def write_files(spark, path, docs, files, rng):
    """Several files with times in random order, so that batches meet the ids in any order."""
    os.makedirs(path)
    for k in range(files):
        own = [(*d, "s", 9, "x") for i, d in enumerate(docs) if i % files == k]
        spark.createDataFrame(own, DOCS).coalesce(1).write.parquet(f"{path}-{k}")
        (name,) = [f for f in os.listdir(f"{path}-{k}") if f.endswith(".parquet")]
        os.rename(f"{path}-{k}/{name}", f"{path}/{name}")
        when = 1_700_000_000 + rng.randrange(1000)
        os.utime(f"{path}/{name}", (when, when))
    return path


def audit_rows(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("seed,files,batches", [(1, 5, 5), (2, 7, 3), (3, 1, 8)])
def test_audit_equals_a_plain_one(spark, folder, seed, files, batches):
    rng = random.Random(seed)
    docs = [
        (rng.choice([None, *range(-5, 60)]), rng.choice(texts(rng)), rng.choice(["en", "de", None, ""])) for _ in range(150)
    ]
    docs += docs[:20]  # repeated rows are no copies of themselves
    labels = [(rng.randrange(-5, 70), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    labels += [(None, 1, 1)]
    known = spark.createDataFrame([(*x, "extra") for x in labels], "doc_id long, quality int, toxic int, text string")
    path = write_files(spark, folder("docs"), docs, files, rng)
    found = filter_audit.audit(spark, path, known, batches)
    assert audit_rows(found) == plain_audit(docs, labels)
    assert found.columns[:3] == ["part", "filter_order", "step"]


def test_audit_of_nothing(spark, folder):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = folder("docs")
    spark.createDataFrame([], DOCS).write.parquet(path)
    assert filter_audit.audit(spark, path, labels).collect() == []


def test_audit_of_one_file_beside_others(spark, folder):
    top = folder("tables")
    path = write_files(spark, top, [(1, "a", "x"), (2, "a", "x")], 1, random.Random(1))
    (name,) = [f for f in os.listdir(path) if f.endswith(".parquet")]
    os.rename(f"{path}/{name}", f"{path}/documents.parquet")
    spark.range(3).write.parquet(f"{path}/other.parquet")
    labels = spark.createDataFrame([(2, 0, 1)], "doc_id long, quality int, toxic int")
    found = filter_audit.audit(spark, f"{path}/documents.parquet", labels)
    assert audit_rows(found) == plain_audit([(1, "a", "x"), (2, "a", "x")], [(2, 0, 1)])


def test_a_repeated_batch_changes_nothing(spark, folder):
    rng = random.Random(5)
    docs = [(rng.randrange(40), rng.choice(texts(rng)), "p") for _ in range(80)]
    path = write_files(spark, folder("docs"), docs, 4, rng)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    work = folder("work")

    def run():
        stream = spark.readStream.schema(DOCS).option("maxFilesPerTrigger", 1).parquet(path)
        counts = filter_audit.counters(stream.select("doc_id", "text", "lang"), labels, work)
        return sorted(tuple(r) for r in counts.collect())

    first = run()
    assert len(os.listdir(f"{work}/state")) == 4
    os.rename(f"{work}/checkpoint/commits", f"{work}/lost")  # ended before it was noted as done
    assert run() == first
    assert audit_rows(filter_audit.interactions(spark.createDataFrame(first, "part string, mask int, marks int, n long"))) == plain_audit(docs, [])


def test_a_smaller_id_retracts_what_the_earlier_one_got(spark):
    state = spark.createDataFrame([(b"k", 7, "p", 1, 2, 3)], "text_key binary, doc_id long, part string, mask int, marks int, n long")
    batch = spark.createDataFrame(
        [(b"k", 5, "q", 1, 0, 1), (b"k", 9, "q", 1, 0, 2), (b"k", None, "q", 1, 0, 4), (b"z", 1, "p", 0, 0, 1)], state.schema
    )
    decided = filter_audit.decide(batch, state)
    changes = {tuple(r) for r in filter_audit.counter_changes(decided).collect()}
    assert changes == {("p", 1, 2, -3), ("p", 17, 2, 3), ("q", 1, 0, 5), ("q", 17, 0, 2), ("p", 0, 0, 1)}
    left = {(bytes(r[0]), *r[1:]) for r in filter_audit.state_rows(decided).collect()}
    assert left == {(b"k", 5, "q", 1, 0, 1), (b"z", 1, "p", 0, 0, 1)}


# Vector codes


def plain_codes(vectors, parts=8, entries=16, rounds=6, scale=4096):
    """(vec_id, label, code, error) of every kept vector in order, and all final entries."""
    kept = [
        (i, [math.floor(scale * x) for x in v], label)
        for i, v, label in vectors
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return [], []
    width = len(kept[0][1]) // parts
    cut = [[z[p * width : (p + 1) * width] for p in range(parts)] for _, z, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [
                [sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])
            ]
    rows = []
    for (i, _, label), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        rows.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return rows, books


VECTORS = "vec_id long, embedding array<float>, label int, code string, label_error int"


@pytest.mark.parametrize("count,width,entries", [(200, 2, 16), (300, 3, 5), (7, 1, 16), (40, 0, 16), (1, 4, 16)])
def test_codes_equal_plain_ones(spark, count, width, entries):
    rng = random.Random(count)
    steps = [x / 4096 for x in range(-3, 4)]
    vectors = [
        (rng.choice([None, *range(count)]), [np.float32(rng.choice(steps) + rng.choice([0, 0.00007])).item() for _ in range(8 * width)],
         rng.choice([None, 0, 1, 2]))
        for _ in range(count)
    ]
    vectors += vectors[:3]
    spoilt = [None] if not width else [None, [None] * 8 * width, [float("nan")] * 8 * width, [0.0] * (8 * width - 1) + [float("-inf")], [1.0] * 8]
    vectors += [(10_000 + k, v, 1) for k, v in enumerate(spoilt)]
    frame = spark.createDataFrame([(*v, "c", 5) for v in vectors], VECTORS).repartition(5)
    found = vector_codes.compress(frame, vector_codes.CodeSpec(entries=entries))
    rows, books = plain_codes(vectors, entries=entries)
    totals = Counter()
    for _, label, _, error in rows:
        totals[label] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    wanted = [(i, label, code, error, totals[label], digest) for i, label, code, error in rows]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, wanted))


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1, "c", 1)]):
        found = vector_codes.compress(spark.createDataFrame(rows, VECTORS))
        assert found.collect() == []
        assert found.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]


def test_vectors_that_cannot_be_coded(spark):
    with pytest.raises(ValueError, match="cannot be cut"):
        vector_codes.compress(spark.createDataFrame([(1, [0.5] * 9, 1, "c", 1)], VECTORS))
    with pytest.raises(ValueError, match="beyond 32768"):
        vector_codes.compress(spark.createDataFrame([(1, [40_000.0] * 8, 1, "c", 1)], VECTORS))
    edge = vector_codes.compress(spark.createDataFrame([(1, [32_768.0] * 8, 1, "c", 1), (2, [-32_768.0] * 8, 1, "c", 1)], VECTORS))
    assert {r["error"] for r in edge.collect()} == {0}


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 20), st.integers(1, 4), st.integers(0, 4), st.integers(0, 30))
def test_search_finds_the_nearest_entry(seed, entries, parts, width, rows):
    rng = np.random.default_rng(seed)
    books = rng.integers(-3, 4, (parts, entries, width))
    vectors = rng.integers(-3, 4, (rows, parts, width))
    code, distance = vector_codes.Codebooks.of(books).search(vectors)
    every = ((vectors[:, :, None, :] - books[None]) ** 2).sum(axis=3)
    assert (code == every.argmin(axis=2)).all() and (distance == every.min(axis=2)).all()


# Token counts


@pytest.fixture(scope="module")
def model():
    tokenizers = pytest.importorskip("public_tokenizers")
    return token_counts.read_model(tokenizers.path("piece_bpe_32k.model"))


SOUP = [
    " ", "  ", "\n", "\n\n", "\t", "a", "the", " the", "é", "漢字", "😀", "\x00", "▁", "▁▁", "<s>", "</s>", "<unk>", "<0x0A>", "#",
    "    ", "http://", "ing", "\r", "123", " " * 20, " ", "　", "é", "ﬁ",
]


@settings(max_examples=200, deadline=None)
@given(parts=st.lists(st.sampled_from(SOUP), max_size=20), block=st.integers(1, 12))
def test_pre_tokens_add_up(model, parts, block):
    text = "".join(parts)
    processor = token_counts.load_processor(model)
    found = [t for tokens in token_counts.pre_tokens(text, block) for t in tokens]
    assert "".join(found) == (" " + text.replace("▁", " ") if text else "")
    assert sum(token_counts.encoded_lengths(processor, found)) == len(processor.encode(text))


def test_counts_equal_the_tokenizer(spark, model, monkeypatch):
    rng = random.Random(3)
    given = ["".join(rng.choice(SOUP) for _ in range(rng.randrange(60))) for _ in range(200)]
    given += [None, "", "x" * 300_000, "word " * 100_000, "\n" * 5000, " " * 5000, "ab\n" * 2000, given[0], given[0]]
    rows = [(k if k % 7 else None, t, 3, 4) for k, t in enumerate(given)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, n_bytes int")
    processor = token_counts.load_processor(model)
    wanted = sorted(
        (str(i), len((t or "").encode()), len(processor.encode(t or "")), len(processor.encode(t or "")) > 4096) for i, t, *_ in rows
    )
    for spec in (token_counts.TableSpec(), token_counts.TableSpec(texts=2, characters=5, entries=3)):
        found = token_counts.count_tokens(docs, model, spec=spec)
        assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == wanted
    assert token_counts.count_tokens(docs.limit(0), model).collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # no pre-token and no text is shuffled


def test_the_cache_stays_bounded(model, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_SIZE", 50)
    processor, shared = token_counts.load_processor(model), {"model": model, "table": {" w1": 2}}
    for k in range(30):
        text = " ".join(f"w{k * j}" for j in range(40)) + " " + "long" * 40
        assert token_counts.Lookup(shared).count(text) == len(processor.encode(text))
        assert len(shared["cache"]) <= 50 and all(len(t) <= token_counts.CACHED_LENGTH for t in shared["cache"])


def test_a_vocabulary_that_joins_words_is_refused(model):
    class Joining:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, k):
            return "of▁the"

    with pytest.raises(ValueError, match="reaches over a space"):
        token_counts.check_cuts(Joining())
