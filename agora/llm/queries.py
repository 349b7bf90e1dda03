"""The registered queries of the subpackage, each over its whole table, and their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agora.llm import (
    bpe,
    dac,
    hard_negatives,
    html_text,
    language,
    licenses,
    merkle,
    near_dup,
    packing,
    quality,
    rules,
    token_counts,
    token_ids,
    topk,
)
from agora.llm.shared import held_out, prepare, table
from agora.llm.vocabularies import default_path

TOKEN_LIMIT = 1024
PACK_END = 2
FILE_END = 1


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    out = quality.classify(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return out.select("doc_id", "held_out", "score", "predicted")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", bpe.encode(F.col("text")).alias("ids"))
    coded = docs.withColumn("decoded", bpe.decode(F.col("ids")))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents")
    out = docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), token_counts.count_tokens(F.col("text")).alias("n_tokens")
    )
    return out.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    ids = token_ids.token_ids(F.col("text"), default_path("byte_bpe_50k.json"), PACK_END)
    return packing.pack_ids(table(spark, sf_dir, "documents"), ids)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    network = language.fit(docs)
    out = docs.select("doc_id", held_out().alias("held_out"), language.identify(spark, network, F.col("text")).alias("_found"))
    return out.select("doc_id", "held_out", "_found.lang_pred", "_found.score")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = dac.new_path(spark)
    dac.write_ids(table(spark, sf_dir, "documents"), path, default_path("word_bpe_49k.json"), FILE_END)
    return dac.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return rules.host_quality(table(spark, sf_dir, "documents")).drop("host")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("id") % 100 == 0)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return licenses.scan(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return merkle.tampered_manifest(docs)


OP10_SQL = r"""
WITH split AS (
    SELECT doc_id, source AS host, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
),
windows AS (
    SELECT doc_id, host, body, words, lines, len(words) AS n,
           list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) AS w
    FROM split
),
counted AS (
    SELECT *, CASE WHEN len(w) = 0 THEN NULL ELSE list_histogram(w) END AS seen FROM windows
),
measured AS (
    SELECT doc_id, host, n AS n_words,
           length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           CASE WHEN seen IS NULL THEN 0 ELSE len(list_distinct(flatten(list_transform(
               list_filter(range(1, n - 1), lambda i: seen[w[i]] > 1), lambda i: [i, i + 1, i + 2])))) END AS n_repeat_words
    FROM counted
),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
),
hosts AS (
    SELECT host, count(*) AS texts, sum(base_failed::INT) AS failed FROM judged WHERE host IS NOT NULL GROUP BY host
),
prior AS (
    SELECT sum(failed) / sum(texts) AS mean,
           var_pop(failed / texts) - sum(failed) / sum(texts) * (1 - sum(failed) / sum(texts)) * avg(1 / texts) AS spread
    FROM hosts
),
weights AS (
    SELECT mean, CASE WHEN spread > 0 THEN greatest(0, least(1000, mean * (1 - mean) / spread - 1)) ELSE 1000 END AS weight FROM prior
),
refused AS (
    SELECT host FROM hosts, weights WHERE (failed + mean * weight) / (texts + weight) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (host IS NULL OR host NOT IN (SELECT host FROM refused)) AS kept
FROM judged
"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_byte_bpe,
        op3_token_counts,
        op4_main_text,
        op5_top_k,
        op6_near_duplicates,
        op7_packing,
        op8_language,
        op9_token_files,
        op10_host_rules,
        op11_hard_negatives,
        op12_license_scan,
        op13_merkle_manifest,
    )
}
OP11_SQL = """
WITH usable AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM usable a, usable b WHERE a.id % 100 = 0 AND a.id <> b.id
),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
 AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def _license_sql() -> str:
    """Every block against every template, by the definition; no filters."""
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    templates = ", ".join(f"('{label}', {quoted(ws)})" for label, ws in licenses.template_words())
    phrases = ", ".join(f"('{label}', {quoted(phrase.split())})" for phrase, label in licenses.PHRASES.items())
    return rf"""
WITH templates(label, tokens) AS (VALUES {templates}),
phrases(label, tokens) AS (VALUES {phrases}),
docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
),
places AS (
    SELECT row, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1 : i + len(tokens)] = tokens)) AS start FROM docs, phrases
),
based AS (
    SELECT row, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM places GROUP BY row
),
blocks AS (
    SELECT row, list_distinct(w[b * {licenses.STEP} + 1 : b * {licenses.STEP} + {licenses.WIDTH}]) AS tokens
    FROM (SELECT row, w, unnest(range(greatest(1, ceil((len(w) - {licenses.WIDTH}) / {licenses.STEP})::BIGINT + 1))) AS b FROM docs)
),
met AS (
    SELECT row, label, len(t.tokens) AS size, len(list_intersect(b.tokens, t.tokens)) AS n_common FROM blocks b, templates t
),
held AS (SELECT row, label, n_common / size AS share FROM met WHERE 100 * n_common >= {licenses.PERCENT} * size),
best AS (SELECT row, max(share) AS share FROM held GROUP BY row),
labelled AS (
    SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT row, label FROM held UNION SELECT row, label FROM places) GROUP BY row
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0) END AS score
FROM docs LEFT JOIN based USING (row) LEFT JOIN best USING (row) LEFT JOIN labelled USING (row)
"""


OP13_SQL = """
WITH RECURSIVE docs AS (
    SELECT *, 4294967295 - list_reduce(
               list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, byte: list_reduce(
                   [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
    FROM documents
),
coded AS (
    SELECT doc_id, source,
           crc % 5 = 0 AND text IS NOT NULL AS tampered,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
           coalesce(strlen(text) || ':' || text, '-') AS original,
           coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS lowered
    FROM docs
),
hashed AS (
    SELECT doc_id, source, sha256(head || original) AS leaf,
           sha256(head || CASE WHEN tampered THEN lowered ELSE original END) AS replaced
    FROM coded
),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
           count(*) OVER (PARTITION BY source) AS n
    FROM hashed
),
lower_nodes AS (
    SELECT tree, 0 AS level, pos, n, leaf AS digest FROM leaves
    UNION ALL
    SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
    FROM lower_nodes WHERE n > 1 GROUP BY tree, level, pos // 16, n
),
subroots AS (SELECT tree, level AS height, digest AS subroot FROM lower_nodes WHERE n = 1),
upper_nodes AS (
    SELECT 0 AS level, tree AS pos, count(*) OVER () AS n, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
    FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 16, n
),
steps AS (
    SELECT l.tree, l.pos AS leaf_pos, s.level, s.pos, s.digest, s.pos = l.pos // power(16, s.level)::BIGINT AS own
    FROM leaves l JOIN lower_nodes s ON s.tree = l.tree AND s.n > 1 AND s.pos // 16 = l.pos // power(16, s.level + 1)::BIGINT
    UNION ALL
    SELECT l.tree, l.pos, height + u.level, u.pos, u.digest, u.pos = l.tree // power(16, u.level)::BIGINT
    FROM leaves l JOIN subroots USING (tree)
    JOIN upper_nodes u ON u.n > 1 AND u.pos // 16 = l.tree // power(16, u.level + 1)::BIGINT
),
proofs AS (
    SELECT tree, leaf_pos, sha256(coalesce(string_agg(digest, '' ORDER BY level, pos) FILTER (NOT own), '')) AS proof
    FROM steps GROUP BY tree, leaf_pos
),
folding AS (
    SELECT tree, pos AS leaf_pos, 0 AS level, replaced AS digest FROM leaves
    UNION ALL
    SELECT s.tree, s.leaf_pos, s.level + 1, sha256(string_agg(CASE WHEN own THEN f.digest ELSE s.digest END, '' ORDER BY s.pos))
    FROM folding f JOIN steps s ON s.tree = f.tree AND s.leaf_pos = f.leaf_pos AND s.level = f.level
    GROUP BY s.tree, s.leaf_pos, s.level
),
folded AS (SELECT tree, leaf_pos, arg_max(digest, level) AS folded_root FROM folding GROUP BY tree, leaf_pos)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN subroots USING (tree)
JOIN folded f ON f.tree = l.tree AND f.leaf_pos = l.pos
LEFT JOIN proofs p ON p.tree = l.tree AND p.leaf_pos = l.pos,
(SELECT digest AS root FROM upper_nodes WHERE n = 1)
"""

SQL = {
    "op10_host_rules": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_license_scan": _license_sql(),
    "op13_merkle_manifest": OP13_SQL,
}
