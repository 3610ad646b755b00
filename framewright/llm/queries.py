"""Registered queries of the training-data operators, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, decontaminate, fertility, line_dedup, piece_lattice, simhash_vptree, store, substring_dedup, token_ids, toxicity, warc_zip


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def vocabulary(name: str) -> str:
    """Where a public vocabulary lies; FRAMEWRIGHT_TOKENIZERS names another folder."""
    import os

    folder = os.environ.get("FRAMEWRIGHT_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.round_trip(_read(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), order=2)


def op4_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality(_read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op6_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.segment(_read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_read(spark, sf_dir, "documents"), 20)


def op8_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vptree.near_duplicates(_read(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame([(-7, 0, "user", _SPECIMEN), (-7, 1, "assistant", _SPECIMEN)], "conv_id long, turn long, role string, text string")
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.read_back(store.cut(chat_format.format_records(chat_format.records(rows)), "chats"))


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.encode_to_files(_read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


_SPECIMEN = "\\### Assistant: </turn> ok"


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    named = (
        op1_line_dedup, op2_warc_zip, op3_toxicity, op4_fertility, op5_decontaminate, op6_piece_lattice,
        op7_substring_dedup, op8_simhash_vptree, op9_chat_format, op10_token_ids, pipeline,
    )
    return {f.__name__: f for f in named}


_SQL_WARC = """
WITH base AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest
  FROM pages
), kept AS (SELECT digest, n, max(page_id) AS kept FROM base WHERE n >= 1000 GROUP BY digest, n)
SELECT page_id, n::BIGINT AS payload_bytes, base.digest AS payload_digest,
       CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM base LEFT JOIN kept USING (digest, n)
"""

_SQL_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|turn|>' || replace(replace(role, '\', '\\'), '<|', '<\|')) + 1
           + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length('<|end|>') + 1)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""

_SQL_SUBSTRING = r"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM docs WHERE len(w) >= 20
), keyed AS (SELECT doc_id, s, sha256(array_to_string(w[s:s + 19], ' ')) AS k FROM starts),
flagged AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM keyed) WHERE r > 1
), gone AS (SELECT DISTINCT doc_id, s + i AS p FROM flagged, range(20) t(i)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where it can say the same; the others are tested against brute force."""
    return {"op2_warc_zip": _SQL_WARC, "op7_substring_dedup": _SQL_SUBSTRING, "op9_chat_format": _SQL_CHAT}
