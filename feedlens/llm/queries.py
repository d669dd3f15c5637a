"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedlens.llm import (bpe, chat, common, exact_dedup, html_extract, language, license_scan, lz_fingerprint,
                          orc_tokens, packing, periodic, quality, simhash, spelling)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(common.documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(common.documents(spark, sf_dir)).drop("text_hash")


def op3_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.work_dir(spark, "tokens-orc")
    orc_tokens.write_tokens(common.documents(spark, sf_dir), path)
    return orc_tokens.token_digests(orc_tokens.read_tokens(spark, path))


def op4_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.documents(spark, sf_dir))


def op5_consensus_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.compare_edits(common.documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(common.documents(spark, sf_dir))


def op8_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.documents(spark, sf_dir))


def op9_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(common.documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(common.documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_planted_runs(common.documents(spark, sf_dir))
    return periodic.run_digests(periodic.periodic_runs(docs)).drop("n_words")


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = chat.with_control_conversation(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return chat.chat_digests(chat.format_conversations(messages))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_license_scan, op2_exact_dedup, op3_orc_tokens, op4_bin_slack_packing, op5_consensus_extraction,
    op6_lz_fingerprint, op7_language_id, op8_golay_simhash, op9_quality_score, op10_speculative_bpe,
    op11_spelling_variants, op12_periodic_runs, op13_chat_format)}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n_chars FROM documents
), norm AS (
  SELECT doc_id, n_chars, regexp_replace(t, '[\x20\x09-\x0D]', '', 'g') AS body FROM d
), ranked AS (
  SELECT doc_id, n_chars, sha256(body) AS text_sha256,
    first_value(doc_id) OVER w AS keep_id,
    row_number() OVER w AS place,
    count(*) OVER (PARTITION BY body) AS group_size
  FROM norm WINDOW w AS (PARTITION BY body ORDER BY n_chars DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256, n_chars FROM ranked
""",
    "op13_chat_format": r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marks AS (
  -- a backslash behind the first character of each control string and before each backslash
  SELECT *, length(regexp_replace(regexp_replace(text, '\\', '\\\\', 'g'),
    '(<)(<SYS>>|</SYS>>)|(<)(/?s>|image>|audio>|document>)|(\[)(/?INST\]|/?ROLE\]|/TURN\])',
    '\1\3\5\\\2\4\6', 'g')) AS n_escaped,
    CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 20 + length(role) END AS n_marks
  FROM m
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(n_escaped + n_marks)::BIGINT AS formatted_chars
FROM marks GROUP BY conv_id
""",
}
