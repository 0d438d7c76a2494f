"""The registered query of each operator of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import decontaminate, hardneg, jaccard, packing, pages, quality, repeats, secrets, tokens, toxicity, vptree, warc, whiten


VOCABULARY = 49_408  # ids of word_bpe_49k.json


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed vocabulary file; executors have the same installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.report(table(spark, sf, "documents"))


def op2_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return pages.main_text(table(spark, sf, "pages"))


def op3_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(tokens.token_counts(table(spark, sf, "documents"), tokenizer(), by_word=True))


def op4_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return vptree.search_all(table(spark, sf, "embeddings"))


def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf, "documents"), tokenizer(), VOCABULARY, by_word=True)


def op8_repeated_bytes(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf, "documents"))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten.whitened(table(spark, sf, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    return hardneg.mine(hardneg.usable(table(spark, sf, "embeddings")))


def op13_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_main_text, op3_best_fit_packing, op4_quality_classifier, op5_jaccard_join, op6_nearest_neighbours,
        op7_token_files, op8_repeated_bytes, op9_toxicity, op10_decontamination, op11_whitening, op12_hard_negatives, op13_warc,
    )
}
# Exact search: every inner product in double precision. Vectors that take no part are left out on both sides.
ORACLE = {
    "op6_nearest_neighbours": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), scores AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scores
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    # All scores as whole numbers; an anchor's own row is told by its place in the table.
    "op12_hard_negatives": """
        WITH numbered AS (SELECT *, row_number() OVER () AS nr FROM embeddings),
        v AS (
            SELECT nr, vec_id AS id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS e
            FROM numbered
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT a.nr AS anchor, a.id AS anchor_id, a.label = c.label AS same, c.id AS id,
                   CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v a JOIN v c ON a.id % 50 = 0 AND a.nr <> c.nr AND len(a.e) = len(c.e)
        ), positives AS (
            SELECT anchor, anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS nth
            FROM scores WHERE same QUALIFY nth <= 5
        )
        SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.nth ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
               n.id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
        QUALIFY rank <= 3
    """,
    # Base 32 from the hexadecimal digest: each five hexadecimal digits hold four digits of base 32.
    "op13_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
        g AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS leader FROM p)
        SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda i:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '') AS payload_digest,
               CASE WHEN leader IS NULL OR leader = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN leader <> page_id OR page_id IS NULL THEN leader END AS refers_to
        FROM g
    """,
}
