"""Registry of the operators' queries; ``__spark_entry__`` adds it if this package is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.llm import (chat_tools, chunk_bpe, crf_quality, curve_pack, exact_topk, hard_negatives, host_rules, license_rules,
                            pca_near, simhash_cover, suffix_dedup, token_files, whitening)
from layerforge.llm.common import new_path, read_table, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.encode_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                      chunk_bpe.digests)


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_report(read_table(spark, sf_dir, "documents"))


@query
def op3_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_pack.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, tokenizer = new_path(spark, "token-files"), tokenizer_path("byte_bpe_50k.json")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path, tokenizer)
    return token_files.read_token_files(spark, path, tokenizer)


@query
def op7_simhash_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_cover.simhash_groups(read_table(spark, sf_dir, "documents"))


@query
def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.exact_topk(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE["op4_exact_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""


@query
def op5_pca_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pca_near.near_embeddings(read_table(spark, sf_dir, "embeddings"))


@query
def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat_tools.calls_of_turns(read_table(spark, sf_dir, "conversations"))
    return chat_tools.link_tool_calls(calls, results, chat_tools.CHAT_SCHEMAS).unionByName(
        chat_tools.duplicates(calls, results, chat_tools.CHAT_SCHEMAS))


ORACLE["op8_tool_calls"] = chat_tools.ORACLE


@query
def op9_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return crf_quality.score_documents(docs, crf_quality.train(docs, read_table(spark, sf_dir, "labels")))


@query
def op10_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan_licences(read_table(spark, sf_dir, "documents"))


ORACLE["op10_license_rules"] = license_rules.oracle_sql()


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; the label of every seventh vector is moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLE["op11_hard_negatives"] = hard_negatives.ORACLE


@query
def op12_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of all documents; the source is the host."""
    return host_rules.judge_documents(read_table(spark, sf_dir, "documents"))


ORACLE["op12_host_rules"] = host_rules.oracle_sql()


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 16 whitened coordinates of every usable vector."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))
