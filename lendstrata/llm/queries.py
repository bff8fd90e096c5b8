"""The registered queries of this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendstrata.llm import bpe, chat, clusters, divergence, exact, lines, mixing, neighbours, quality, simhash, substrings, tokenfiles, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.group_documents(table(spark, sf_dir, "documents"))


ORACLES["op9_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_documents(table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of one host with equal text count once."""
    return lines.page_lines(table(spark, sf_dir, "pages"), distinct=True)


ORACLES["op4_line_dedup"] = lines.ORACLE


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_ids(table(spark, sf_dir, "documents"))


ORACLES["op6_mixing"] = mixing.ORACLE


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest_repeats(table(spark, sf_dir, "documents"))


ORACLES["op2_substring_dedup"] = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
each AS (SELECT doc_id, words, generate_subscripts(words, 1) AS pos FROM w),
windows AS (SELECT doc_id, pos, array_to_string(words[pos : pos + {substrings.WINDOW - 1}], ' ') AS run FROM each
  WHERE pos + {substrings.WINDOW - 1} <= len(words)),
again AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY run) AS n FROM windows) WHERE n > 1),
marked AS (SELECT doc_id, e.pos, words[e.pos] AS word, max(a.pos) OVER (PARTITION BY doc_id ORDER BY e.pos) > e.pos - {substrings.WINDOW} AS gone
  FROM each e LEFT JOIN again a USING (doc_id, pos)),
kept AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone IS DISTINCT FROM true) AS text
  FROM marked GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"))


@query
def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search_hundredths(table(spark, sf_dir, "embeddings"))


@query
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_with_probe(table(spark, sf_dir, "conversations"))


ORACLES["op7_chat"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>' || role || '.' || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>.')) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""


@query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op11_divergence"] = divergence.ORACLE


@query
def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.assigned(table(spark, sf_dir, "embeddings"))


ORACLES["op12_clusters"] = clusters.ORACLE


@query
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(table(spark, sf_dir, "documents"))
