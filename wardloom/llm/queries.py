"""The queries of this package on the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.llm import (
    alignment,
    byte_bpe,
    embedding_dedup,
    exact_dedup,
    fingerprint,
    language_id,
    line_dedup,
    minhash,
    packing,
    quality,
    spelling,
    toxicity,
    url_filter,
)
from wardloom.llm.common import table


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return language_id.predict(documents, language_id.fit(documents))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.line_report(table(spark, folder, "documents"))
    return found.select("doc_id", "line_no", "kept", F.col("kept_key").alias("kept_doc_id"), F.col("kept_line").alias("kept_line_no"))


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    made = byte_bpe.round_trip(table(spark, folder, "documents"))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return quality.score(documents, quality.fit(documents, table(spark, folder, "labels")))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, folder, "labels")))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages")).drop("pattern")


def op8_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, folder, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.edited_likeness(table(spark, folder, "documents"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"))


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_packing": op2_packing,
    "op3_line_dedup": op3_line_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_minhash": op9_minhash,
    "op10_fingerprint": op10_fingerprint,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_alignment": op12_alignment,
    "op13_exact_dedup": op13_exact_dedup,
}

_SITE = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in _SITE)

ORACLE_SQL: dict[str, str] = {
    "op7_url_filter": f"""
        WITH cut AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut
        ), rules(rule_host, rule_path, verdict) AS (VALUES {_RULES}),
        best AS (
            SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   arg_max(verdict, length(rule_host || rule_path)) AS verdict
            FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY page_id
        )
        SELECT parts.page_id, host, path, rule,
               coalesce(best.verdict, CASE WHEN regexp_matches(host || path,
                   '^([^/]*\\.)?((cheap|free|best|online)-(pill|bet|loan|casino|replica)s?|(casino|poker|slots)-(win|bonus|live)|(ads|banner|click)-(track|server|count)|(spam|link|seo)-(farm|list|exchange)|(adult|porn|xxx)-(x|cam|video))\\.')
                   OR regexp_matches(host || path, '^[^/]*/(buy|sell|exchange)-(links|backlinks)/') THEN 'block' ELSE 'allow' END) AS verdict
        FROM parts LEFT JOIN best USING (page_id)
    """,
    "op13_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
