"""One query for each operator, over its whole table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_tree,
    decontaminate,
    filter_audit,
    minhash,
    mixing,
    ordering,
    quality,
    sharding,
    site_lines,
    token_counts,
    toxicity,
    url_filter,
    vector_codes,
    warc,
)

URL_RULES = [
    url_filter.Rule("com/", True),
    url_filter.Rule("example.com/en/", False),
    url_filter.Rule("www.example.com/en/", True),
    url_filter.Rule("net/es/", False),
    url_filter.Rule("net/fr/", False),
]
SHARDS = [1.0] * 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_tree.read_back(*chat_tree.prefix_tree(turns)).drop("n_tokens")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "words")


def op3_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    host, lines = site_lines.url_host(F.col("url")), site_lines.html_lines(F.col("html"))
    return site_lines.drop_site_boilerplate(pages, host, lines).select(
        "page_id", F.col("site").alias("host"), "n_lines", "n_dropped", "kept_text"
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id", "source", mixing.word_count().alias("size"), ordering.stable_key("doc_id", "text").alias("mix_key")
    )
    return mixing.with_taken(rows).select("doc_id", "size", "source_size", "target", "taken")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.detect(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(_table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", _table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compress(_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = token_counts.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), model)


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_tree, op2_url_filter, op3_site_lines, op4_mixing, op5_sharding, op6_toxicity, op7_quality, op8_warc,
        op9_minhash, op10_decontaminate, op11_filter_audit, op12_vector_codes, op13_token_counts,
    )
}

_WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_TAGS = "p|div|li|ul|ol|nav|article|h[1-6]|br|tr|td|table|title|head|body|html|section|header|footer"



def _codes_sql(rounds: int = 6) -> str:
    """The rounds one after the other: assign every part, then average what each entry got."""

    def assigned(k: int) -> str:
        return f"""a{k} AS (SELECT q.vec_id, q.label, q.p, q.v, arg_min(k, (e, k)) AS k, min(e) AS e FROM (
  SELECT v.*, b.k, CAST(list_sum(list_transform(range(1, len(v.v) + 1), lambda i: (v.v[i] - b.v[i]) * (v.v[i] - b.v[i]))) AS BIGINT) AS e
  FROM v JOIN b{k} b ON v.p = b.p) q GROUP BY q.vec_id, q.label, q.p, q.v)"""

    steps = []
    for k in range(rounds):
        steps += [
            assigned(k),
            f"""m{k} AS (SELECT p, k, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS x FROM a{k}, range(1, 9) r(i) GROUP BY p, k, i)""",
            f"""b{k + 1} AS (SELECT b.p, b.k, coalesce(n.v, b.v) AS v FROM b{k} b
  LEFT JOIN (SELECT p, k, list(x ORDER BY i) AS v FROM m{k} GROUP BY p, k) n ON n.p = b.p AND n.k = b.k)""",
        ]
    steps.append(assigned(rounds))
    return f"""WITH g AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS z FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, label, p, z[1 + 8 * p : 8 + 8 * p] AS v FROM g, range(0, 8) r(p)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM g QUALIFY k < 16),
b0 AS (SELECT p, k, v FROM v JOIN f USING (vec_id)),
{", ".join(steps)},
r AS (SELECT vec_id, label, string_agg(format('{{:02x}}', k), '' ORDER BY p) AS code, CAST(sum(e) AS BIGINT) AS error
      FROM a{rounds} GROUP BY vec_id, label),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM r, h"""


# op2, op5, op6, op7 and op13 have no SQL: a trained model, CRC-32, quantile sketches and a tokenizer; tests
# hold them against plain versions. So is the pipeline.
ORACLES = {
    "op1_chat_tree": r"""WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS body,
             regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g') AS head FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(head) + length(body) + 24) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op3_site_lines": rf"""WITH p AS (
  SELECT page_id, {_FOLD.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
         regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
           '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'),
           '(?i)</?({_TAGS})\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g') AS body FROM pages),
l AS (SELECT page_id, host,
             list_filter(list_transform(string_split(body, chr(10)), lambda x: trim(x, {_BLANK})), lambda x: x <> '') AS lines FROM p),
n AS (SELECT host, count(*) AS total FROM l GROUP BY host),
u AS (SELECT host, unnest(list_distinct(lines)) AS line FROM l),
c AS (SELECT host, line FROM u JOIN n USING (host) GROUP BY host, line, total
      HAVING count(*) >= 3 AND count(*) > 0.2 * total),
b AS (SELECT host, list(line) AS gone FROM c GROUP BY host),
k AS (SELECT page_id, host, lines,
             CASE WHEN gone IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(gone, x)) END AS kept
      FROM l LEFT JOIN b USING (host))
SELECT page_id, host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_dropped,
       coalesce(array_to_string(kept, chr(10)), '') AS kept_text FROM k""",
    "op4_mixing": rf"""WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS.format("text")}) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS mix_key
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS cap FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS capped,
             sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
      FROM w WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
x AS (SELECT *, CAST((SELECT sum(source_size) FROM s) - capped AS DOUBLE) / CAST(open_weight AS DOUBLE) AS level FROM o),
v AS (SELECT level FROM x WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN cap < weight * level THEN CAST(cap AS DOUBLE) ELSE weight * level END AS target
      FROM w, v),
r AS (SELECT d.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY mix_key, doc_id, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS whole FROM r)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + least(greatest(budget - whole * source_size - earlier, 0), size) AS BIGINT) AS taken FROM f""",
    "op8_warc": r"""WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex,
             max(page_id) OVER (PARTITION BY body) AS winner FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
         1 + ((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> winner THEN winner END AS refers_to FROM h""",
    "op9_minhash": rf"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_FOLD.format("text"))} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
u AS (SELECT doc_id, unnest(s) AS x FROM s),
h AS (SELECT doc_id, n, hash(x) AS x FROM u JOIN n USING (doc_id)),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS n, count(*) AS c
      FROM h a JOIN h b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * a.n >= 75 * b.n AND 100 * b.n >= 75 * a.n GROUP BY ALL),
l AS (SELECT a, b FROM c WHERE 100 * c >= 75 * (n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN m ON doc_id = a""",
    "op10_decontaminate": rf"""WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(coalesce({_FOLD.format("text")}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM t),
b AS (SELECT id, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i, w FROM w WHERE kind = 'b' AND len(w) > 0),
k AS (SELECT DISTINCT id AS item, size, array_to_string(w[i:i + size - 1], ' ') AS x FROM b),
z AS (SELECT DISTINCT size FROM k),
d AS (SELECT id, size, unnest(range(1, len(w) - size + 2)) AS i, w FROM w, z WHERE kind = 'd' AND len(w) >= size),
f AS (SELECT d.id, d.i, d.size, k.item FROM d JOIN k ON k.size = d.size AND array_to_string(d.w[d.i:d.i + d.size - 1], ' ') = k.x),
g AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + size)) AS p FROM f) GROUP BY id),
q AS (SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT CAST(item AS VARCHAR), ',' ORDER BY CAST(item AS VARCHAR)) AS items FROM f GROUP BY id)
SELECT w.id AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN g ON g.id = w.id LEFT JOIN q ON q.id = w.id WHERE kind = 'd'""",
    "op11_filter_audit": rf"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {_WORDS.format("text")} AS w, min(doc_id) OVER (PARTITION BY text) AS low FROM d),
m AS (SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
             regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > low, false)] AS f FROM w),
l AS (SELECT doc_id, max(quality = 1) AS q, max(toxic = 1) AS t FROM labels GROUP BY doc_id),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (q) AS good, count(*) FILTER (t) AS toxic
      FROM m LEFT JOIN l USING (doc_id) GROUP BY part, f),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT filter_order, step, ascii(filter_order[step]) - 64 AS own,
             list_transform(range(1, step), lambda i: ascii(filter_order[i]) - 64) AS earlier
      FROM o, range(1, 6) r(step)),
y AS (SELECT part, filter_order, step, own, n, good, toxic, f[own] AS fails,
             len(list_filter(earlier, lambda i: f[i])) > 0 AS gone, len(list_filter(f, lambda i: i)) AS failures FROM c, s),
z AS (SELECT part, filter_order, step, own, sum(n) FILTER (NOT fails AND NOT gone) AS kept,
             sum(n) FILTER (fails AND NOT gone) AS removed, sum(n) FILTER (fails AND gone) AS redundant,
             sum(n) FILTER (fails AND failures = 1) AS unique_fails, sum(good) FILTER (fails AND NOT gone) AS good_lost,
             sum(toxic) FILTER (fails AND NOT gone) AS toxic_lost FROM y GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley FROM z""",
    "op12_vector_codes": _codes_sql(),
}
