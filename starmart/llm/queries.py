"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starmart.llm import (
    exact_dedup, fingerprints, hard_negatives, language_id, line_dedup, ngram_join, packing, piece_codec, resampling, secret_scan,
    sharding, token_counts, toxicity,
)
from starmart.llm.common import documents


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(documents(spark, sf_dir)).drop("class_size", "text_key", "first_key")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(documents(spark, sf_dir)).drop("first_rows")


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_codec.digests(piece_codec.encode_decode(documents(spark, sf_dir), model))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.find_secrets(documents(spark, sf_dir)))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digests(fingerprints.compare_with_next(documents(spark, sf_dir)))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(documents(spark, sf_dir)).drop("spans")


def op11_weighted_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), sharding.even_tree(8))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampling.resample(documents(spark, sf_dir), target).drop("n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_token_counts": op3_token_counts,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_piece_codec": op5_piece_codec,
    "op6_toxicity": op6_toxicity,
    "op7_secret_scan": op7_secret_scan,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_line_dedup": op9_line_dedup,
    "op10_language_id": op10_language_id,
    "op11_weighted_shards": op11_weighted_shards,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_importance_resampling": op13_importance_resampling,
}

def _crc_step(byte: int) -> int:
    """The reflected CRC-32 polynomial applied to one byte."""
    for _ in range(8):
        byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
    return byte


def _crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes."""
    table = [_crc_step(b) for b in range(256)]
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h : CAST('0x' || h AS BIGINT))"
    step = f"lambda c, b : xor(c >> 8, ({table}::BIGINT[])[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({octets}, {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _shard_sql(tree: sharding.Tree, out: str) -> str:
    """CTEs that let every document of ``d`` descend the tree, level by level: ``out`` has doc_id, path, shard."""
    leaves = ", ".join(f"('{r}', '{k}', '{s}', {w}::DOUBLE)" for r, k, s, w in tree)
    levels, parent, path = [f"{out}_leaf(l0, l1, l2, w) AS (VALUES {leaves})"], "(SELECT doc_id, key, '' AS path FROM d)", "''"
    for depth in range(3):
        path = " || '/' || ".join(f"l{k}" for k in range(depth)) or "''"
        child = " || '/' || ".join(f"l{k}" for k in range(depth + 1))
        levels.append(f"""{out}_{depth} AS (
            SELECT doc_id, key, min_by(child, -ln((('0x' || left(md5(key || '/' || child), 12))::BIGINT::DOUBLE + 0.5)
                                                 / 281474976710656.0) / w) AS path
            FROM {parent} p JOIN (SELECT {path} AS parent, {child} AS child, sum(w) AS w FROM {out}_leaf GROUP BY ALL) c
              ON p.path = c.parent
            GROUP BY doc_id, key)""")
        parent = f"{out}_{depth}"
    return ", ".join(levels)


ORACLES: dict[str, str] = {
    "op11_weighted_shards": f"""
        WITH d AS (
            SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, octet_length(encode(coalesce(text, ''))) + 1 AS size,
                   {_crc32("coalesce(text, '')")} AS text_crc32
            FROM documents
        ), {_shard_sql(sharding.even_tree(8), "old")}, {_shard_sql(sharding.grown(sharding.even_tree(8)), "grown")}
        SELECT doc_id, d.size, d.text_crc32, 'key' AS law, split_part(o.path, '/', 3)::INTEGER AS shard,
               row_number() OVER (PARTITION BY split_part(o.path, '/', 3) ORDER BY doc_id) - 1 AS slot,
               split_part(g.path, '/', 3)::INTEGER AS grown_shard, split_part(o.path, '/', 1) AS region,
               split_part(o.path, '/', 2) AS rack
        FROM d JOIN old_2 o USING (doc_id) JOIN grown_2 g USING (doc_id)""",
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x : floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.id AS anchor_id, b.id, a.label = b.label AS alike,
                   CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id
        ), positives AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        )
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
               id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5""",
    "op13_importance_resampling": f"""
        WITH texts AS (
            SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark
        ), listed AS (
            SELECT side, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM texts
        ), word AS (SELECT side, doc_id, unnest(words) AS w FROM listed
        ), bucket AS (SELECT w, {_crc32("w")} % 10000 AS b FROM (SELECT DISTINCT w FROM word)
        ), counted AS (
            SELECT b, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
            FROM word JOIN bucket USING (w) GROUP BY b
        ), gain AS (
            SELECT b, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
                                      / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
            FROM counted
        ), weighed AS (
            SELECT doc_id, sum(gain)::BIGINT AS weight FROM word JOIN bucket USING (w) JOIN gain USING (b) WHERE side = 'd' GROUP BY doc_id
        ), scored AS (
            SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT::DOUBLE + 0.5)
                                                             / 4294967296.0)))::BIGINT AS score
            FROM listed LEFT JOIN weighed USING (doc_id) WHERE side = 'd'
        ), ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
            FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)""",
    "op4_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
}
