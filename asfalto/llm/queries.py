"""Registered queries of this subpackage, with production parameters, and their SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asfalto.llm import (
    direct_codes, itq, kmeans_tree, kneser_ney, line_rules, prefix_bpe, quality_pu, secret_cnn, span_links,
    swap_packing, tag_paths, weighted_minhash, zone_blocks,
)
from asfalto.llm.batches import bound_batches
from asfalto.session import new_folder

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
ALIGNED_VOCABULARIES = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    direct_codes.write_token_files(
        _table(spark, sf_dir, "documents"), path, _vocabulary(WORD_VOCABULARY), end_id=2
    )
    return direct_codes.read_token_files(spark, path)


def op2_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = kneser_ney.train(docs.where(~kneser_ney.held_out(F.col("doc_id"))))
    scored = kneser_ney.score(docs, model)
    return scored.withColumn("held_out", kneser_ney.held_out(F.col("doc_id")))


def op4_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract(_table(spark, sf_dir, "pages"))


def op5_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return swap_packing.pack_documents(
        _table(spark, sf_dir, "documents"), _vocabulary(WORD_VOCABULARY), end_id=0
    )


def op7_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_minhash.classes(_table(spark, sf_dir, "documents"))


def op8_secret_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secret_cnn.scan(docs, secret_cnn.train(docs))


def op9_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_pu.train(docs, _table(spark, sf_dir, "labels"))
    return quality_pu.score_documents(docs, model)


def op10_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return prefix_bpe.encode_digests(
        _table(spark, sf_dir, "documents"), _vocabulary(BYTE_VOCABULARY), public_tokenizers.PATTERN
    )


def op11_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judged(_table(spark, sf_dir, "documents")).drop("lost_chars")


def op12_zone_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return zone_blocks.mine(_table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, moved)


def op13_span_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_links.aligned(_table(spark, sf_dir, "documents"), *map(_vocabulary, ALIGNED_VOCABULARIES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_files, op2_kmeans_tree, op3_kneser_ney, op4_tag_paths, op5_itq, op6_swap_packing,
        op7_weighted_minhash, op8_secret_cnn, op9_quality_pu, op10_prefix_bpe, op11_line_rules, op12_zone_blocks,
        op13_span_links,
    )
}

ORACLES: dict[str, str] = {
    "op5_itq": """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reached AS (
    SELECT a AS vec_id, b AS other FROM links
    UNION
    SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
), counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
least AS (SELECT vec_id, min(other) AS m FROM reached GROUP BY vec_id)
SELECT e.vec_id, coalesce(n, 0) AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(m, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counted USING (vec_id) LEFT JOIN least USING (vec_id)
""",
    "op7_weighted_minhash": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(
        regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
    FROM documents
), runs AS (
    SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), tf AS (SELECT doc_id, g, count(*) AS n FROM runs GROUP BY doc_id, g),
df AS (SELECT g, count(*) AS n FROM tf GROUP BY g),
total AS (SELECT greatest(2, count(*)) AS n FROM documents),
weighted AS (
    SELECT doc_id, tf.g, tf.n * (1 + 0.1 * ln(total.n / df.n) / ln(total.n)) AS x, df.n AS df
    FROM tf JOIN df USING (g), total
), whole AS (SELECT doc_id, sum(x) AS x FROM weighted GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.x, b.x)) AS x
    FROM weighted a JOIN weighted b ON a.g = b.g AND a.doc_id <> b.doc_id
    WHERE a.df > 1
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM common JOIN whole p ON p.doc_id = a JOIN whole q ON q.doc_id = b
    WHERE common.x >= 0.8 * (p.x + q.x - common.x)
), reached AS (
    SELECT a AS doc_id, b AS other FROM links
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
), least AS (SELECT doc_id, min(other) AS m FROM reached GROUP BY doc_id)
SELECT d.doc_id, least(d.doc_id, coalesce(m, d.doc_id)) AS class_id, d.doc_id <= coalesce(m, d.doc_id) AS kept
FROM documents d LEFT JOIN least USING (doc_id)
""",
    "op11_line_rules": rf"""
WITH t AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT n, regexp_extract_all(text, '{line_rules.WORD}') AS w FROM t),
windows AS (
    SELECT n, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT n, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) > 2)
), again AS (SELECT n, i, count(*) OVER (PARTITION BY n, a, b, c) AS k FROM windows),
repeated AS (
    SELECT n, count(DISTINCT place) AS repeated
    FROM (SELECT n, unnest([i, i + 1, i + 2]) AS place FROM again WHERE k > 1) GROUP BY n
), lines AS (
    SELECT n, line, len(regexp_extract_all(line, '{line_rules.WORD}')) AS k,
           length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
    FROM (SELECT n, unnest(string_split(text, chr(10))) AS line FROM t)
), rules AS (
    SELECT n, line, k, chars,
           len(regexp_extract_all(line, '{line_rules.SEPARATORS}')) * 8 >= k
           OR len(regexp_extract_all(line, '{line_rules.MARKS}')) * 5 > k
           OR len(regexp_extract_all(line, '{line_rules.CRIES}')) * 5 > k
           OR (k < {line_rules.PHRASE_LINE} AND regexp_matches(lower(line), '{line_rules.PHRASES}'))
           OR (k < {line_rules.SHORT_LINE} AND NOT contains('{line_rules.ENDS}',
               regexp_extract(line, '(.)[\x20\x09-\x0D"''”’»)\]]*\z', 1, 's'))) AS fails
    FROM lines WHERE k > 0
), sums AS (
    SELECT n, sum(k) AS n_words, sum(chars) AS word_chars, count(*) - count(DISTINCT line) AS n_dup_lines,
           sum(CASE WHEN fails THEN 0 ELSE k END) AS left_words,
           sum(CASE WHEN fails THEN 0 ELSE chars END) AS left_chars
    FROM rules GROUP BY n
), whole AS (
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(repeated, 0) AS n_repeat_words, coalesce(left_words, 0) AS left_words,
           coalesce(left_chars, 0) AS left_chars
    FROM t LEFT JOIN sums USING (n) LEFT JOIN repeated USING (n)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND left_words >= 50
       AND word_chars - left_chars <= CAST({line_rules.MOST_LOST} AS DOUBLE) * word_chars AS kept
FROM whole
""",
    "op12_zone_blocks": """
WITH v AS (
    SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.n, a.vec_id AS anchor_id, b.n AS m, b.vec_id, a.label = b.label AS alike,
           CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
    FROM v a JOIN v b ON a.n <> b.n WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT * FROM pairs WHERE alike QUALIFY row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id, m) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.n, p.m ORDER BY q.score DESC, q.vec_id, q.m) AS INTEGER) AS rank,
       q.vec_id AS negative_id, p.score AS positive_score, q.score AS negative_score
FROM positives p JOIN pairs q ON p.n = q.n AND NOT q.alike AND 30 * p.score <= 100 * q.score AND 100 * q.score <= 90 * p.score
QUALIFY rank <= 10
""",
}
