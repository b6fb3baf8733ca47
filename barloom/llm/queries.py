"""Queries of the text operators over the driver's tables, and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import chat, licenses
from barloom.llm.decontam import leaks
from barloom.llm.exact_dedup import exact_dedup
from barloom.llm.jaccard_join import jaccard_components
from barloom.llm.language import languages
from barloom.llm.lm_score import lm_scores
from barloom.llm.packing import pack
from barloom.llm.quality import quality_scores
from barloom.llm.toxicity import toxicity_scores


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(rows.unionByName(extra)))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"), steady=True)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_packing": op3_packing,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_language_id": op6_language_id,
    "op7_decontamination": op7_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_jaccard_join": op10_jaccard_join,
}

def _escaped(text: str) -> str:
    """The template's escaping as a DuckDB expression."""
    for first in ("<", "["):
        rest = "|".join(re.escape(c[1:]) for c in chat.CONTROLS if c[0] == first)
        text = rf"regexp_replace({text}, '({re.escape(first)})(\\*(?:{rest}))', '\1\\\2', 'g')"
    return text


SQL: dict[str, str] = {
    "op1_license_scan": licenses.duckdb_sql(),
    "op4_chat_formatting": rf"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(length({_escaped('role')}) + length({_escaped('text')}) + {len('<|turn|><|text|><|end|>')})::BIGINT AS formatted_chars
        FROM r GROUP BY conv_id
    """,
    "op5_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d
    """,
    "op9_lm_scoring": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
            FROM documents
        ), p AS (
            SELECT r, unnest(list_zip([NULL] || words[:-2], words)) AS pair FROM d
        ), t AS (
            SELECT r, pair[1] AS v, pair[2] AS w FROM p
        ), one AS (
            SELECT w, count(*) AS n FROM t GROUP BY w
        ), two AS (
            SELECT v, w, count(*) AS n FROM t WHERE v IS NOT NULL GROUP BY v, w
        ), total AS (
            SELECT count(*) AS n FROM t
        ), s AS (
            SELECT t.r, sum(CASE WHEN t.v IS NULL THEN ln(w1.n / total.n) WHEN two.n >= 2 THEN ln(two.n / v1.n) ELSE ln(0.4 * w1.n / total.n) END) AS score
            FROM t CROSS JOIN total JOIN one w1 ON w1.w = t.w LEFT JOIN one v1 ON v1.w = t.v LEFT JOIN two ON two.v = t.v AND two.w = t.w
            GROUP BY t.r
        )
        SELECT doc_id, len(words) AS n_tokens, round(coalesce(score, 0), 6) AS score, round(score / nullif(len(words), 0), 6) AS mean_score
        FROM d LEFT JOIN s USING (r)
    """,
    "op10_jaccard_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), s AS MATERIALIZED (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
            FROM d
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), pair AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
        ), link AS MATERIALIZED (
            SELECT u, v FROM pair JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)
        ), reach AS (
            SELECT doc_id AS node, doc_id AS root FROM d
            UNION
            SELECT link.v, reach.root FROM reach JOIN link ON link.u = reach.node WHERE reach.root < link.v
        )
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.root) AS component_id
        FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON reach.node = d.doc_id GROUP BY d.doc_id
    """,
}
