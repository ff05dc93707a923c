"""Chat tree, URL verdicts, mixing, sharding, toxicity, archives and the pipeline."""

import base64
import hashlib
import importlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import SPACED, contamination, mix_targets, near_groups, shingles, windows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quoteloom.llm import chat_tree, mixing, ordering, sharding, toxicity, url_filter, warc, words

TURNS = "conv_id long, turn long, role string, text string"


# Words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB\x00 \t\n.é9😀", max_size=12)), max_size=6), st.integers(1, 40))
def test_words_of_chunks(texts, limit):
    found = []
    for chunk in words.chunks(pa.array(texts, pa.string()), words.SPACED, limit):
        hashes = chunk.word_hashes()
        for row in range(chunk.rows):
            found.append(hashes[chunk.offsets[row] : chunk.offsets[row + 1]].tolist())
    lowered = [SPACED.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for t in texts]
    assert [len(f) for f in found] == [len(w) for w in lowered]
    names = {}
    for own, hashes in zip(lowered, found, strict=True):
        for word, value in zip(own, hashes, strict=True):
            assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)


# Chat


def turn_digests(turns):
    learnt = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest()


def conversations():
    rng = random.Random(4)
    said = ["hi", "ok", "", None, "<|im_end|>", "<\\|im_start|>assistant ok", "a\nb", "\\", "é😀", "x" * 5000, "<|<|||\\|"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "assistant", "sys\ntem", None, "a<|b"])
            rows.append((conv, turn, "user" if turn == 0 else role, "hi" if turn == 0 else rng.choice(said)))
    rows += [(100, t, "user", f"turn {t}") for t in range(300)] + [(101, t, "user", f"turn {t}") for t in range(200)]
    rows += [(None, 0, "user", "null id"), (None, None, "assistant", "first"), (102, 1, "b", "tie"), (102, 1, "a", "tie")]
    return rows + [(103, 0, "user", "twice"), (103, 0, "user", "twice")]


def test_chat_tree_round_trip(spark):
    rows = conversations()
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    frame = spark.createDataFrame(rows, TURNS).withColumn("node", F.lit(1)).withColumn("depth", F.lit("x"))
    nodes, paths = chat_tree.prefix_tree(frame)
    found = {r.conv_id: r for r in chat_tree.read_back(nodes, paths).collect()}
    assert set(found) == set(turns)
    for conv, own in turns.items():
        own = [(r, t) for _, _, r, t in sorted(own)]
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == turn_digests(own)
        assert r.formatted_chars == sum(len("".join(chat_tree.render(a, b))) for a, b in own)


def test_chat_tree_is_a_depth_first_stream(spark):
    nodes, paths = chat_tree.prefix_tree(spark.createDataFrame(conversations(), TURNS))
    by_node = {r.node: r for r in nodes.collect()}
    assert len(by_node) == nodes.count()  # shared turns once
    spans = sorted((r.start, r.start + len(r.tokens)) for r in by_node.values())
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    steps = defaultdict(list)
    for r in paths.collect():
        steps[r.conv].append((r.depth, r.node))
    parent = {}
    for path in steps.values():
        ordered = [n for _, n in sorted(path)]
        before = 0
        for k, node in enumerate(ordered):
            r = by_node[node]
            parent[node] = ordered[k - 1] if k else None
            assert r.position == before
            attended = sorted(p for a in r.ancestors for p in range(a.low, a.high))
            own = sorted(p for n in ordered[:k] for p in range(by_node[n].start, by_node[n].start + len(by_node[n].tokens)))
            assert attended == own
            before += len(r.tokens)
    stack = []  # a walk in stream order enters a node only below its parent
    for r in sorted(by_node.values(), key=lambda r: r.start):
        while stack and stack[-1] != parent[r.node]:
            stack.pop()
        assert stack or parent[r.node] is None
        stack.append(r.node)


@settings(max_examples=200, deadline=None)
@given(st.text("<|\\n\nim_endstart>a", max_size=30), st.text("<|\\n\nim>a", max_size=10))
def test_template_is_reversible(text, role):
    head, body, end = chat_tree.render(role, text)
    assert "<|" not in body and chat_tree.parse(head + body + end) == (role, text)


def test_empty_chat(spark):
    assert chat_tree.read_back(*chat_tree.prefix_tree(spark.createDataFrame([], TURNS))).collect() == []


# URLs

RULES = [
    url_filter.Rule("com/", True), url_filter.Rule("example.com/en/", False), url_filter.Rule("www.example.com/en/", True),
    url_filter.Rule("net/es/", False), url_filter.Rule("net/fr/", False),
]


def test_url_rules_and_words(spark):
    urls = [
        ("https://a.EXAMPLE.com/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
        ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("http://a.com", "a.com", "", None, "allow"),
        ("http://a.com?x/y", "a.com", "", None, "allow"),
        ("ftp://x.net/fr/://b", "x.net", "/fr/://b", "net/fr/", "block"),
        ("http://x.net/fr", "x.net", "/fr", None, "allow"),
        ("a/b.com/en/", "", "", None, "allow"),
        ("http://cheappills.org/a", "cheappills.org", "/a", None, "block"),
        ("http://news-blog.org/a", "news-blog.org", "/a", None, "allow"),
        (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("://", "", "", None, "allow"),
        ("http://" + "long" * 5000 + ".org/" + "é" * 5000, "long" * 5000 + ".org", "/" + "é" * 5000, None, "allow"),
    ]
    urls += [(f"http://cheap-pills{i}.example.org/x", f"cheap-pills{i}.example.org", "/x", None, "block") for i in range(20)]
    urls += [(f"http://fine{i}.example.org/x", f"fine{i}.example.org", "/x", None, "allow") for i in range(60)]
    rows = [(i, u[0], "clash") for i, u in enumerate(urls)] + [(0, urls[0][0], "clash"), (None, None, "clash")]
    table = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(table, RULES).collect()}
    assert {i: u[1:] for i, u in enumerate(urls)} | {None: ("", "", None, "allow")} == found
    assert url_filter.judge_urls(table.limit(0), RULES).collect() == []


def test_viterbi_equals_all_splits():
    counts = {"a": 5, "ab": 9, "abc": 2, "bc": 7, "c": 1, "cab": 3}
    segmenter = url_filter.Segmenter(counts)

    def cost(parts):
        return sum(segmenter.costs.get(p, segmenter._unknown(len(p))) for p in parts)

    def splits(text):
        if not text:
            yield ()
        for k in range(1, len(text) + 1):
            for rest in splits(text[k:]):
                yield (text[:k], *rest)

    for text in ("abcab", "cabbc", "zzabc", "aaabbbccc", "q"):
        assert cost(segmenter.split(text)) == pytest.approx(min(map(cost, splits(text))))


def plain_scores(urls, spec):
    """Words and score of each (host, path), with all counts in dictionaries."""
    counts = Counter()
    for host in {h for h, _ in urls}:
        for label in host.rpartition(".")[0].split("."):
            if "-" in label:
                counts.update(re.split("[^a-z]+", label))
    for _, path in urls:
        counts.update(re.split("[^a-z]+", path.lower()))
    counts = Counter({w: n for w, n in counts.items() if 2 <= len(w) <= spec.longest_word})
    floor = max(1, counts.total() // 10_000)
    for word in (*url_filter.COMMON, *spec.seeds):
        counts[word] += floor
    segmenter = url_filter.Segmenter(counts, spec.longest_word)
    tables = {True: Counter(spec.seeds), False: Counter()}
    rows = []
    for host, path in urls:
        own = segmenter.words(host)
        tokens = [*own, *url_filter.path_tokens(path)]
        tables[not set(spec.seeds).isdisjoint(own)].update(tokens)
        rows.append((" ".join(own), tokens))
    size = len({*tables[True], *tables[False]})
    totals = {b: tables[b].total() + spec.smoothing * size for b in tables}

    def ratio(token):
        block, allow = ((tables[b][token] + spec.smoothing) / totals[b] for b in (True, False))
        return math.log(block) - math.log(allow)

    prior = math.log(spec.prior / (1 - spec.prior))
    return [(own, prior + sum(map(ratio, tokens))) for own, tokens in rows]


def test_url_counts_are_whole(spark):
    # More words than 50,000 and more (block, token) rows than 100,000; rare ones stand last in any order.
    def word(i):
        return "".join("abcdefghij"[int(d)] for d in str(i))

    urls = [(f"site{i % 7}.example.org", "/" + "/".join(word(k) for k in range(i, i + 200)) * 2) for i in range(200_000, 320_000, 200)]
    urls += [(f"poker-zzyzx-{word(i)}.org", "/") for i in range(3)] + [("zzyzxpoker.org", "/yyx/yyw"), ("yyxyyw.org", "/" + "yyw/" * 3)]
    urls += [("zzyzx.org", "/zzyzx"), ("", ""), ("a.b", "")]
    table = spark.createDataFrame([(i, f"http://{h}{p}" if h else None) for i, (h, p) in enumerate(urls)], "page_id long, url string")
    found = {r.page_id: (r.words, r.score, r.verdict) for r in url_filter.judge_urls(table, []).collect()}
    assert len(found) == len(urls)
    for i, (own, score) in enumerate(plain_scores(urls, url_filter.UrlSpec())):
        assert found[i] == (own, pytest.approx(score), "block" if score > 0 else "allow")
    last = {h: found[i][0] for i, (h, _) in enumerate(urls)}
    assert last["zzyzxpoker.org"] == "zzyzx poker" and last["yyxyyw.org"] == "yyx yyw"
    assert found[urls.index(("zzyzx.org", "/zzyzx"))][2] == "block"


def test_labels_of_any_length_and_hosts_without_dots(spark):
    segmenter = url_filter.Segmenter({"cheap": 5, "pills": 4, "ills": 1})
    assert segmenter.words("q" * 70 + "cheappills" + "z" * 3000 + ".org") == ["q" * 70, "cheap", "pills", "z" * 3000]
    assert segmenter.words("cheappills") == ["cheap", "pills"]
    assert segmenter.words("") == segmenter.words(".org") == segmenter.words("org.")[1:] == []
    urls = ["http://cheappills/x", "http://" + "free" * 20 + "casino.example.org/x", *(f"http://fine{i}.org/x" for i in range(20))]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: r.words for r in url_filter.judge_urls(table, []).collect()}
    assert found[0] == "cheap pills" and found[1] == "free " * 20 + "casino example"


# Mixing and sharding


def sized(rows):
    return [(i, t, "en", s, len(t or "")) for i, t, s in rows]


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def mixed_rows():
    rng = random.Random(6)
    rows = []
    for k, source in enumerate(["b", "a", None, "Z", "é", "tiny"]):
        for i in range(2 if source == "tiny" else 40):
            rows.append((k * 100 + i, " ".join(["w"] * rng.randrange(0, 30)), source))
    rows += [(1, None, "a"), (1, None, "a"), (None, "x y z", "b"), (None, "x y z", "b"), (7, "q\t " * 9000, "Z"), (8, "", "empty")]
    return rows


def test_running_totals(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_RANGE", 7)
    rows = [(i, ["a", "b", None][i % 3], i % 5) for i in range(200)]
    table = spark.createDataFrame(rows, "id long, g string, v long").withColumn("k", ordering.stable_key("id"))
    found = ordering.running_totals(table, "g", "k", "v", ["id"], "before").collect()
    for group in ("a", "b", None):
        total = 0
        for r in sorted((r for r in found if r.g == group), key=lambda r: (r.k, r.id)):
            assert r.before == total
            total += r.v


def test_mixing_meets_its_targets(spark):
    rows = mixed_rows()
    docs = spark.createDataFrame(sized(rows), DOCS).withColumn("taken", F.lit("clash")).withColumn("weight", F.lit("clash"))
    plan = docs.select(
        "doc_id", "source", mixing.word_count().alias("size"), ordering.stable_key("doc_id", "text").alias("mix_key")
    )
    found = mixing.with_taken(plan).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(SPACED.findall(text or ""))
    targets = mix_targets(sizes)
    taken = Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert len(found) == len(rows)
    assert all(abs(taken[s] - targets[s]) <= 0.5 for s in sizes)
    again = mixing.with_taken(plan.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))

    docs = docs.withColumn("size", F.lit("clash")).withColumn("_doc", F.lit("clash"))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.select("size", "_doc", "taken", "weight").distinct().collect() == [("clash",) * 4]
    words_out = Counter()
    whole = {t for _, t, _ in rows}
    for r in mixed.collect():
        words_out[r.source] += len(SPACED.findall(r.text or ""))
        if r.text not in whole:
            assert any(t and t.startswith(r.text) for t in whole) and r.n_chars == len(r.text)
    assert {s: words_out[s] for s in sizes} == {s: taken[s] for s in sizes}
    assert mixing.mix(docs.limit(0)).collect() == []


def test_mix_follows_its_spec(spark):
    rows = [(i, " ".join([f"w{i}"] * 10), "ab"[i % 2]) for i in range(20)]
    docs = spark.createDataFrame(sized(rows), DOCS)
    for spec, want in (
        (mixing.MixSpec((3, 1), 1, 0.5), {"a": 75, "b": 25}),
        (mixing.MixSpec((3, 1), 2, 2.0), {"a": 200, "b": 200}),
        (mixing.MixSpec((1, 4), 3, 1.0), {"a": 40, "b": 160}),
    ):
        out = Counter()
        for r in mixing.mix(docs, spec).collect():
            out[r.source] += len(SPACED.findall(r.text))
        assert out == want


def test_shards(spark):
    rows = mixed_rows() + [(i, "same", "s") for i in range(1000, 1400)]
    docs = spark.createDataFrame(sized(rows), DOCS).withColumn("slot", F.lit("clash"))
    found = sharding.shard(docs, [1.0] * 8).collect()
    assert len(found) == len(rows)
    slots = defaultdict(list)
    homes = {}
    for r in found:
        data = (r.text or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 8) and homes.setdefault(r.doc_id, r.shard) == r.shard
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
    moved = sum(r.grown_shard == 8 for r in found) / len(found)
    assert 0.05 < moved < 0.18
    heavy = Counter(r.shard for r in sharding.shard(docs, [3.0, 1.0]).collect())
    assert 0.65 < heavy[0] / len(found) < 0.85
    assert sharding.shard(docs.limit(0), [1.0]).collect() == []
    odd = docs.withColumn("_order", F.lit("clash")).withColumn("_key", F.lit("clash"))
    assert sharding.shard(odd, [1.0]).select("_order", "_key").distinct().collect() == [("clash", "clash")]
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("doc_id"), [1.0, 0.0])


# Toxicity

BAD = ["wretchful", "grumpox", "snarlik", "blightor"]


def labelled(rng, n, bad_share=0.3):
    rows = []
    for i in range(n):
        own = ["".join(rng.choice(["ka", "lo", "mi", "re", "tu", "son", "del"]) for _ in range(rng.randrange(1, 4))) for _ in range(80)]
        toxic = rng.random() < bad_share
        if toxic:
            for _ in range(4):
                own[rng.randrange(80)] = rng.choice(BAD)
        rows.append((i, " ".join(own), int(toxic)))
    return rows


def test_toxicity_learns_words_and_misspellings(spark):
    rows = labelled(random.Random(2), 500)
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows], "doc_id long, toxic int, quality int")
    spec = toxicity.TrainSpec(warm_epochs=120, epochs=20)
    clean = "ka lo mi re tu son del kalo mire tuson delka " * 400
    extra = [(1000, None), (1001, ""), (1002, clean + "wretchful grumpox snarlik " + clean), (1003, clean)]
    extra += [(1004, "kalo mire wretchfull grumpoxx snarlikk tuson"), (None, BAD[0]), (5, rows[5][1]), (5, rows[5][1])]
    more = docs.union(spark.createDataFrame([(i, t, "x") for i, t in extra], docs.schema))
    found = toxicity.detect(more, labels, spec).collect()
    assert len(found) == len(rows) + len(extra)
    truth = {i: y for i, _, y in rows}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    score = {r.doc_id: r.score for r in found}
    assert score[1000] == score[1001] == 0 and score[1002] > 0.7 > score[1003] and score[1004] > 0.5
    assert toxicity.detect(docs.limit(0), labels, spec).collect() == []
    kept = toxicity.drop_toxic(more, labels, spec)
    assert kept.columns == more.columns and kept.count() == sum(r.predicted == 0 for r in found)
    none = toxicity.detect(more, labels.limit(0), spec).collect()
    assert {r.predicted for r in none} == {0}


def test_toxicity_learns_from_long_texts(spark):
    # One label's texts are all longer than what training sees of a text.
    spec = toxicity.TrainSpec(warm_epochs=120, epochs=20, longest=300, piece=60)
    rows = [(i, " ".join([t] * 4) if y else t[:250], y) for i, t, y in labelled(random.Random(5), 400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels, spec)
    cut = sample.select("toxic", toxicity.text_pieces(F.col("doc_id"), F.col("text"), spec).alias("p")).collect()
    assert {r.toxic for r in cut} == {0, 1} and max(len(r.p) for r in cut) <= 300
    whole = {t for _, t, _ in rows}
    assert all(any(p in t for t in whole) for r in cut[:20] + cut[-20:] for p in r.p.split("\n"))
    found = toxicity.detect(docs, labels, spec).filter("held_out").collect()
    truth = {i: y for i, _, y in rows}
    assert sum(r.predicted == truth[r.doc_id] for r in found) / len(found) > 0.9

    # Text without spaces: the n-grams that tell stand 150 letters into the only word.
    rng = random.Random(8)
    rows = []
    for i in range(300):
        own = ["".join(rng.choice("klmrtsaeiou") for _ in range(10)) for _ in range(20)]
        rows.append((i, "".join([*own[:15], *(["zqxwvj"] * 10 if i % 2 else own[:6]), *own[15:]]), i % 2))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    found = toxicity.detect(docs, labels, toxicity.TrainSpec(warm_epochs=120, epochs=20)).filter("held_out").collect()
    assert sum(r.predicted == r.doc_id % 2 for r in found) / len(found) > 0.9


def test_subwords_are_the_words_ngrams():
    letters = np.frombuffer(b"abcdefab", np.uint8)
    owner, bucket = toxicity.subwords(letters, np.array([0, 6]), np.array([6, 2]), 1 << 30)
    assert Counter(owner.tolist()) == {0: 6 + 5 + 4 + 1, 1: 2 + 1 + 1}
    same, again = toxicity.subwords(np.frombuffer(b"ab", np.uint8), np.array([0]), np.array([2]), 1 << 30)
    assert set(again.tolist()) == set(bucket[owner == 1].tolist())


# Archives


def test_archives_round_trip(spark, folder):
    rng = random.Random(3)
    bodies = ["<p>" + " ".join(rng.choice(["a", "bé", "\r\n\r\n", "WARC/1.1"]) for _ in range(rng.randrange(400))) for _ in range(40)]
    pages = [(i, f"http://h/{i}\r\nX: y", rng.choice(bodies)) for i in range(150)]
    pages += [(200, None, None), (201, "u", ""), (202, "u", "z" * 3_000_000), (None, "n", bodies[0]), (150, "r", "own"), (150, "r", "own")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    spec = warc.WarcSpec(archive_bytes=20_000, sample_bytes=5_000)
    archives = warc.write_archives(table, folder("warc"), spec)
    assert archives.count() > 2
    found = warc.read_archives(archives).collect()
    largest = {}
    for page, _, html in pages:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", page))
    assert len(found) == len(pages)
    want = Counter()
    for page, _, html in pages:
        data = (html or "").encode()
        winner = largest.get(html or "", page)
        revisit = page != winner
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[page, len(data), digest, "revisit" if revisit else "response", winner if revisit else None, None if revisit else data] += 1
    got = Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))
        for r in found
    )
    assert got == want
    assert warc.read_archives(warc.write_archives(table.limit(0), folder("none"))).collect() == []


def test_archive_starts_with_its_dictionary(spark, folder):
    rows = [(i, "u", f"<p>page {i} of the same site with the same frame</p>" * 9) for i in range(300)]
    archives = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), folder("d"))
    path = archives.first()["path"].removeprefix("file:")
    data = open(path, "rb").read()
    magic, size = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
    assert magic == 0x184D2A5D and data[8 + size : 12 + size] == b"\x28\xb5\x2f\xfd"  # then the first frame


# Pipeline and queries


def test_pipeline_equals_its_stages_in_plain_python(spark, folder):
    pipeline = importlib.import_module("corpus_pipeline")
    rng = random.Random(12)
    rows = labelled(rng, 240)
    docs = [(i, t, "en", rng.choice(["a", "b", None]), len(t)) for i, t, _ in rows]
    docs += [(300 + i, docs[i][1] + " tail", "en", "c", 0) for i in range(30)]
    item = " ".join(f"q{i}" for i in range(30))
    docs += [(400 + i, f"start {i} " + item + f" end {i} " + " ".join(f"z{i}{k}" for k in range(100)), "en", "d", 0) for i in range(5)]
    docs += [(500, None, None, None, None), (501, "", "en", "a", 0), (501, "", "en", "a", 0)]
    place = folder("tables")
    spark.createDataFrame(docs, DOCS).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    frame = spark.read.parquet(f"{place}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES][-1] == "sharding"

    left = pipeline.drop_toxic(spark, frame, place)
    toxic = {r.doc_id for r in toxicity.detect(frame, spark.read.parquet(f"{place}/labels.parquet")).collect() if r.predicted}
    first = [d for d in docs if d[0] not in toxic]
    assert sorted(map(str, map(tuple, left.collect()))) == sorted(map(str, first))
    left = spark.createDataFrame(first, DOCS)
    sets = {k: (d[0], shingles(d[1])) for k, d in enumerate(first)}
    groups = near_groups(sets)
    second = [d for k, d in enumerate(first) if not sets[k][1] or groups[k] == d[0]]
    got = pipeline.drop_near_duplicates(spark, left, place)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, second))
    known = windows([(1, item)])
    third = [d for d in second if not contamination(d[1], known)[1]]
    got = pipeline.drop_contaminated(spark, spark.createDataFrame(second, DOCS), place)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, third))

    final = pipeline.run(spark, place)
    sizes = Counter()
    for d in third:
        sizes[d[3]] += len(SPACED.findall(d[1] or ""))
    out = Counter()
    for r in final.collect():
        out[r.source] += len(SPACED.findall(r.text or ""))
    targets = mix_targets(sizes)
    assert all(abs(out[s] - targets[s]) <= 0.5 for s in sizes)


def test_every_query_runs_over_its_whole_table(spark, sf_dir):
    entry = importlib.import_module("__spark_entry__")
    found = entry.queries()
    tables = {1: "conversations", 2: "pages", 3: "pages", 8: "pages"}
    for name, query in found.items():
        if name.startswith("op"):
            number = int(name[2:].split("_")[0])
            table = spark.read.parquet(f"{sf_dir}/{tables.get(number, 'documents')}.parquet")
            rows = table.count() if number != 1 else table.select("conv_id").distinct().count() + 1
            assert query(spark, sf_dir).count() == rows, name
    assert "pipeline" in found
