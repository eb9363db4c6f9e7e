"""Queries that apply the corpus operators to the sample tables, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import (
    codes, decontam, neardup, ngram_lm, packing, pieces, pii, repeats, token_files, topk, toxicity,
    turns, warc)
from riskloom.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents", "doc_id", "text"),
                                    table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.text_scores(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                                  table(spark, sf_dir, "benchmark", "item_id", "text"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op11_piece_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digest(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.vector_codes(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.damaged_and_repaired(
        table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def _codes_sql(parts: int = 16, size: int = 64, rounds: int = 2) -> str:
    """Codebooks and codes by all distances, one pair of tables for each round."""
    steps = [f"""
        kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS rn, vec_id, label, v
            FROM (SELECT vec_id, label, list_transform(embedding,
                         lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                  FROM embeddings
                  WHERE embedding IS NOT NULL AND len(list_filter(
                      embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
        ), pieces AS MATERIALIZED (
            SELECT rn, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts}))
                   AS x
            FROM kept, range({parts}) t(p)
        ), book0 AS MATERIALIZED (
            SELECT p, rn - 1 AS e, x AS c FROM pieces WHERE rn <= {size}
        )"""]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
            SELECT rn, p, any_value(x) AS x, min(ROW(gap, e)) AS best
            FROM (SELECT s.rn, s.p, s.x, b.e, list_sum(list_transform(list_zip(s.x, b.c),
                         lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS gap
                  FROM pieces s JOIN book{r} b ON b.p = s.p)
            GROUP BY rn, p
        )""")
        if r < rounds:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
            SELECT b.p, b.e, coalesce(m.c, b.c) AS c
            FROM book{r} b LEFT JOIN (
                SELECT p, e, list((total - ((total % n) + n) % n) // n ORDER BY place) AS c
                FROM (SELECT p, best[2] AS e, place, sum(x[place]) AS total, count(*) AS n
                      FROM near{r}, (SELECT unnest(range(1, len(any_value(x)) + 1)) AS place
                                     FROM pieces) GROUP BY ALL)
                GROUP BY p, e) m ON m.p = b.p AND m.e = b.e
        )""")
    return f"""
        WITH {", ".join(steps)}, coded AS (
            SELECT rn, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code,
                   CAST(sum(best[1]) AS BIGINT) AS error
            FROM near{rounds} GROUP BY rn
        ), digest AS (
            SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS books
            FROM book{rounds}
        )
        SELECT vec_id, code, error,
               CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               books AS codebooks_sha256
        FROM kept JOIN coded USING (rn), digest"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_personal_data": op2_personal_data,
    "op3_repeats": op3_repeats,
    "op4_warc": op4_warc,
    "op5_super_minhash": op5_super_minhash,
    "op6_backoff_lm": op6_backoff_lm,
    "op7_spaced_seeds": op7_spaced_seeds,
    "op8_token_files": op8_token_files,
    "op9_packing": op9_packing,
    "op10_ball_tree": op10_ball_tree,
    "op11_piece_rounds": op11_piece_rounds,
    "op12_ball_codes": op12_ball_codes,
    "op13_turn_repair": op13_turn_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op4_warc": """
        WITH payloads AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), described AS (
            SELECT page_id, octet_length(payload) AS payload_bytes,
                   sha256(payload) AS payload_digest
            FROM payloads
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM described
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id
                         AND first_id IS NOT NULL
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id
                    THEN first_id END AS refers_to
        FROM firsts""",
    "op10_ball_tree": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding,
                                          lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0 AND len(q.v) = len(c.v)
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (
                       PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op12_ball_codes": _codes_sql(),
}
