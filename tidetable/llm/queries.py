"""Registered queries of the operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidetable.llm import (
    byte_bpe,
    chat,
    exact_dedup,
    hard_negatives,
    lm_scoring,
    ngram_join,
    packing,
    page_text,
    quality,
    secret_scan,
    spelling,
    suffix_dedup,
    topk_search,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(_table(spark, sf_dir, "documents"))


def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extracted(_table(spark, sf_dir, "pages"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.without_repeats(_table(spark, sf_dir, "documents")))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    records = chat.canonical(chat.records_of(rows), paths="paths", rows="rows")
    return chat.digests(chat.formatted(records))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(_table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(_table(spark, sf_dir, "documents"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_page_text": op2_page_text,
    "op3_packing": op3_packing,
    "op4_topk_search": op4_topk_search,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_ngram_join": op7_ngram_join,
    "op8_secret_scan": op8_secret_scan,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling": op12_spelling,
    "op13_lm_scoring": op13_lm_scoring,
}

ORACLES = {
    "op4_topk_search": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        WHERE rank <= 10
    """,
    # what the template adds to a turn: marks of 8 and 7 characters, two line ends, and one per escaped character
    "op6_chat_formatting": """
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), ''))
                   AS loss_sha256,
               CAST(sum(17 + length(role) + length(text)
                        + length(regexp_replace(text, '[^\\\\<\\[]', '', 'g'))) AS BIGINT) AS formatted_chars
        FROM rows GROUP BY conv_id
    """,
    "op7_ngram_join": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE
                WHEN len(words) >= 5 THEN list_distinct(list_transform(
                    range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))
                WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS held
            FROM worded
        ), shingles AS (
            SELECT doc_id, len(held) AS n, unnest(held) AS shingle FROM sets
        ), linked AS (
            SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
        ), edges AS (
            SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked
        ), reached AS (
            SELECT doc_id, doc_id AS root FROM sets
            UNION SELECT edges.y, reached.root FROM reached JOIN edges ON edges.x = reached.doc_id
        )
        SELECT doc_id, CAST(len(held) AS BIGINT) AS n_shingles, min(root) AS component_id
        FROM reached JOIN sets USING (doc_id) GROUP BY doc_id, held
    """,
    "op10_exact_dedup": """
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        best AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM texts JOIN best USING (body)
    """,
    "op11_hard_negatives": """
        WITH whole AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS own,
                   CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole a JOIN whole c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
        ), chosen AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE own
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ), inside AS (
            SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                   row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
            FROM chosen JOIN scored s USING (anchor_id)
            WHERE NOT s.own AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
        )
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM inside WHERE rank <= 5
    """,
}
