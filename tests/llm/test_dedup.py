"""Near duplicates and decontamination against plain versions; quality counts, line dedup."""

import random

import pytest
from brute import contamination, linked, near_groups, shingles, text_counts, windows
from pyspark.sql import functions as F

from quoteloom.llm import decontaminate, minhash, quality, site_lines

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, extra=""):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n, words=400):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def near_texts(seed=3):
    """Chains and groups around the limit, shared passages, copies, odd texts."""
    rng = random.Random(seed)
    texts, passage = [], prose(rng, 60)
    for _ in range(12):
        base = prose(rng, rng.choice([3, 6, 40, 120]))
        texts.append(" ".join(base))
        for _ in range(rng.randrange(5)):
            copy = list(base)
            for _ in range(max(1, len(base) // 60)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
            texts.append((" " if rng.random() < 0.5 else "\n").join(copy))
        texts.append(" ".join(base).upper())
    for _ in range(60):
        texts.append(" ".join(passage + prose(rng, rng.randrange(5, 60))))
    texts += [None, "", " \t\n", "one", "ONE", "one two", "a b c d", "a  b\tc d", "a b c", "\x00 b c d e f", "x" * 50_000]
    chain = prose(rng, 100, 10**9)
    for k in range(12):
        chain = [*chain[4:], *prose(rng, 4, 10**9)]
        texts.append(" ".join(chain))
    return list(enumerate(texts))


def check_groups(found, texts):
    sets = {k: (i, shingles(t)) for k, (i, t) in enumerate(texts)}
    expected = near_groups(sets)
    want = sorted(
        (i is None, i or 0, len(sets[k][1]), str(expected[k] if sets[k][1] else i)) for k, (i, t) in enumerate(texts)
    )
    got = sorted((r.id is None, r.id or 0, r.n_shingles, str(r.component_id)) for r in found)
    assert got == want


def test_near_duplicates_equal_all_pairs(spark):
    texts = near_texts()
    check_groups(minhash.near_duplicates(frame(spark, texts)).collect(), texts)


def copies(rng, base, number, changes):
    """Texts with some words of ``base`` replaced by words that no other text has."""
    texts = []
    for k in range(number):
        copy = list(base)
        for at in rng.sample(range(len(base)), rng.choice(changes)):
            copy[at] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(copy[: rng.choice([len(copy), len(copy), len(copy) - 3])]))
    return texts


@pytest.mark.parametrize("seed,changes,hub", [(5, [1, 2], False), (6, [1, 2, 3], True), (7, [2, 3], True), (8, [3, 4], False), (9, [0, 1, 5], False)])
def test_large_buckets_are_decided_exactly(spark, seed, changes, hub):
    """Groups of copies around the limit, with the text they come from or without it."""
    rng = random.Random(seed)
    texts = []
    for length in (60, 90):
        base = prose(rng, length, 10**9)
        texts += copies(rng, base, 25, changes) + [" ".join(base)] * hub
        half = [*base[: length // 2], *prose(rng, length // 2, 10**9)]  # a second group that shares a passage
        texts += copies(rng, half, 10, [0, 1, 2])
    texts = list(enumerate(texts))
    rng.shuffle(texts)
    check_groups(minhash.near_duplicates(frame(spark, texts), bucket=3).collect(), texts)


def test_the_prefix_filter_finds_every_link_across_components(spark):
    rng = random.Random(11)
    base = prose(rng, 70, 10**9)
    texts = [t for t in copies(rng, base, 60, [0, 1, 2, 3, 4])]
    rows = minhash.with_sketches(frame(spark, list(enumerate(texts))), "doc_id", minhash.Sketcher(*minhash.SHAPE)).collect()
    classes = {r.class_id: (r, shingles(texts[r.id])) for r in rows}
    member = "class_id long, member struct<id: long, text_key: long>, n_shingles long, bits_0 long, bits_1 long"
    table = spark.createDataFrame([(c, (r.id, r.text_key), r.n_shingles, r.bits_0, r.bits_1) for c, (r, _) in classes.items()], member)
    # Three components; the classes of the two smaller ones are odd.
    roots = {c: k % 3 if k < 20 else 0 for k, c in enumerate(sorted(classes))}
    opened = spark.createDataFrame([(c, r, r != 0) for c, r in roots.items()], "class_id long, root long, odd boolean")
    traits = table.select("class_id", "n_shingles", "bits_0", "bits_1")
    docs = frame(spark, list(enumerate(texts)))
    found = {(r.a, r.b) for r in minhash._prefix_pairs(docs, "doc_id", table, opened, traits).distinct().collect()}
    across = {(a, b) for a in classes for b in classes if a < b and roots[a] != roots[b]}
    links = {(a, b) for a, b in across if linked(classes[a][1], classes[b][1])}
    assert links and links <= found <= across and len(found) < len(across)


def test_private_shingles_keep_pairs_away(spark):
    """Copies too far from each other for any link meet nobody, however many there are."""
    rng = random.Random(12)
    base = prose(rng, 100, 10**9)
    texts = list(enumerate(copies(rng, base, 80, [6])))
    docs = frame(spark, texts)
    rows = minhash.with_sketches(docs, "doc_id", minhash.Sketcher(*minhash.SHAPE))
    table = rows.selectExpr("class_id", "struct(id, text_key) as member", "n_shingles", "bits_0", "bits_1")
    opened = table.selectExpr("class_id", "class_id as root", "true as odd")
    traits = table.select("class_id", "n_shingles", "bits_0", "bits_1")
    assert minhash._prefix_pairs(docs, "doc_id", table, opened, traits).count() == 0
    check_groups(minhash.near_duplicates(docs, bucket=3).collect(), texts)


def test_sets_with_one_fingerprint_are_told_apart(spark, monkeypatch):
    texts = [(1, "a b c d e f"), (2, "p q r s t u"), (3, "a b c d e f"), (4, "k l m n o"), (5, "p q r s t u v")]
    real = minhash.fingerprints

    def clash(elements):
        found = real(elements)
        found[0] = 7
        return found

    monkeypatch.setattr(minhash, "fingerprints", clash)
    found = {r.id: r.component_id for r in minhash.near_duplicates(frame(spark, texts)).collect()}
    assert (found[1], found[3]) == (1, 1) and len({found[1], found[2], found[4]}) == 3


def test_near_duplicates_of_repeated_rows_and_null_ids(spark):
    texts = [(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "other words stand here now"), (None, "a b c d e f g")]
    texts += [(None, "p q r s t u"), (None, "p q r s t u"), (2, None), (2, None), (7, "P q R s t u v")]
    check_groups(minhash.near_duplicates(frame(spark, texts)).collect(), texts)


def test_empty_tables_and_clashing_columns(spark):
    docs = frame(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert minhash.near_duplicates(docs).collect() == []
    assert decontaminate.decontaminate(docs, bench).collect() == []
    assert quality.judge(docs).collect() == []
    odd = frame(spark, [(1, "a b c d e f"), (2, "a b c d e f")])
    for name in ("id", "text_key", "root", "class_id", "keys", "item", "window", "n", "kept", "_r_id", "_key", "size"):
        odd = odd.withColumn(name, F.lit("x"))
    assert [r.doc_id for r in minhash.one_per_group(odd).select("doc_id").collect()] == [1]
    assert minhash.one_per_group(odd).columns == odd.columns
    assert decontaminate.drop_contaminated(odd, bench).count() == 2
    assert quality.judge(odd).count() == 2


def test_one_row_of_each_group_stays(spark):
    texts = near_texts(9) + [(0, near_texts(9)[0][1]), (3, None), (3, None)]
    kept = [(r.doc_id, r.text) for r in minhash.one_per_group(frame(spark, texts)).collect()]
    sets = {k: (i, shingles(t)) for k, (i, t) in enumerate(texts)}
    groups = near_groups(sets)
    full = [k for k in sets if sets[k][1]]
    assert len([1 for _, t in kept if shingles(t)]) == len({groups[k] for k in full})
    assert len([1 for _, t in kept if not shingles(t)]) == len(sets) - len(full)


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 102), (102, 101), (7, 7), (100, 102)]
    table = spark.createDataFrame(links, "a long, b long")
    found = dict(minhash.components(table).select("node", "root").collect())
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
    assert minhash.components(table.limit(0)).collect() == []


def test_sketch_agreement_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    sketcher = minhash.Sketcher(128, 8)
    for share in (0.2, 0.5, 0.9):
        a = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
        b = np.concatenate((a[: int(2000 * share)], rng.integers(0, 1 << 63, int(2000 * (1 - share)), dtype=np.uint64)))
        similar = share * 2000 / (4000 - share * 2000)
        agree = (sketcher.coordinates(a) == sketcher.coordinates(b)).mean()
        assert abs(agree - similar) < 0.06
    one = minhash.Sketcher(32, 4).coordinates(np.array([5], np.uint64))
    assert len(one) == 128 and one.max() < np.iinfo(np.uint64).max


def test_limit_is_inclusive():
    a = {(i,) for i in range(75)}
    assert linked(a, a | {(i + 1000,) for i in range(25)}) and not linked(a, a | {(i + 1000,) for i in range(26)})


def test_contamination_equals_plain_search(spark):
    rng = random.Random(8)
    items = [(i, " ".join(prose(rng, rng.choice([12, 25, 60])))) for i in range(20)]
    items += [(20, "Short item"), (21, "three word item"), (22, "the"), (23, ""), (24, None), (None, "null id item here")]
    items += [(5, items[4][1]), (30, items[3][1]), (31, "a b c d e f g h i j")]
    texts = []
    for i in range(60):
        words = prose(rng, rng.randrange(0, 200))
        for _ in range(rng.randrange(3)):
            own = (rng.choice(items)[1] or "").split()
            size = rng.choice([5, 9, 10, 11, 40])
            begin = rng.randrange(max(1, len(own) - size))
            at = rng.randrange(len(words) + 1)
            words[at:at] = own[begin : begin + size]
        texts.append((i, rng.choice([" ", ", ", "--\n"]).join(words).upper()))
    texts += [(60, None), (61, ""), (62, "THE"), (63, "A-b.c!d e f g h i j"), (64, "short\x00ITEM"), (1, texts[2][1]), (1, texts[2][1])]
    texts += [(None, "x three word item y"), (70, "q " * 30_000 + items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("length", F.lit(1))
    found = decontaminate.decontaminate(frame(spark, texts), bench).collect()
    known = windows(items)
    want = sorted((str(i), str(contamination(t, known))) for i, t in texts)
    assert sorted((str(r.id), str((r.n_words, r.n_hit, r["items"]))) for r in found) == want
    clean = decontaminate.drop_contaminated(frame(spark, texts), bench)
    assert clean.count() == sum(contamination(t, known)[1] == 0 for _, t in texts)


def test_winnowing_keeps_equal_windows_together():
    import numpy as np

    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    b = np.concatenate((rng.integers(0, 1 << 63, 37, dtype=np.uint64), a[100:140], rng.integers(0, 1 << 63, 9, dtype=np.uint64)))
    left, right = decontaminate.fingerprints(a), decontaminate.fingerprints(b)
    assert (left[100:131] == right[37:68]).all()


@pytest.mark.parametrize("text", [None, "", "a", "a b c d e " * 30, "x y\nx y\n\n \nx y", "p q r s t u v p q r s t", "#a $b <c> |"])
def test_quality_counts(spark, text):
    row = quality.count_texts(frame(spark, [(1, text)])).first()
    got = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)
    assert got == text_counts(text)


def test_quality_fences_follow_their_group(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        words = prose(rng, 60)
        lang = ["en", "de", None][i % 3]
        own = [w + ("#" if lang == "de" else "") for w in words]
        rows.append((i, " ".join(own), lang, "s", 0))
    rows += [(900, " ".join(w + "###" for w in prose(rng, 60)), "en", "s", 0)]
    rows += [(901, " ".join(w + "#" for w in prose(rng, 60)), "de", "tiny", 0), (902, None, "fr", None, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    kept = {r.doc_id: r.kept for r in quality.judge(docs.union(docs)).collect()}
    assert not kept[900] and kept[901] and not kept[902]
    assert all(kept[i] for i in range(300))


def test_site_lines(spark):
    pages = [(i, f"https://a.org/{i}", f"<p>menu</p><p>own {i}</p><p>menu</p><li>x{i % 2}</li>") for i in range(10)]
    pages += [(20, "HTTP://B.org?x", "<p>menu</p>"), (21, None, "<div>menu</div>"), (22, "http://b.org", None), (23, "x", "")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("site", F.lit("clash"))
    found = site_lines.drop_site_boilerplate(
        table, site_lines.url_host(F.col("url")), site_lines.html_lines(F.col("html")), site_lines.SiteRule(0.6)
    )
    rows = {r.page_id: (r.site, r.n_lines, r.n_dropped, r.kept_text) for r in found.collect()}
    assert rows[3] == ("a.org", 4, 2, "own 3\nx1")
    assert rows[20] == ("b.org", 1, 0, "menu") and rows[21] == ("", 1, 0, "menu")
    assert rows[22] == ("b.org", 0, 0, "") and rows[23] == ("", 0, 0, "")
    assert site_lines.drop_site_boilerplate(table.limit(0), F.col("url"), F.array(F.lit("a"))).collect() == []


def test_native_operators_use_no_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    lines = site_lines.html_lines(F.col("html"))
    for df in (quality.count_texts(docs), site_lines.drop_site_boilerplate(pages, site_lines.url_host(F.col("url")), lines)):
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
