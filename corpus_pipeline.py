"""Corpus pipeline: quality classifier, SimHash near-dedup, suffix-array dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerforge.llm import crf_quality, curve_pack, simhash_cover, suffix_dedup
from layerforge.llm.common import read_table, stage, tokenizer_path
from layerforge.session import ship_package


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field accepts; it is fitted on the labelled ones outside fold 0."""
    ship_package(spark)
    return crf_quality.keep_good(docs, crf_quality.train(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    ship_package(spark)
    return simhash_cover.keep_one(docs)


#: Bytes of a passage that the suffix stage removes: some fifty words, where op2's contract says 400.
PASSAGE = 256


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages (strings of PASSAGE bytes) that start elsewhere too."""
    ship_package(spark)
    return suffix_dedup.remove_repeats(docs, PASSAGE)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    ship_package(spark)
    return curve_pack.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_removal),
    ("packing", packing),
]

#: A fitted classifier, suffix sorting and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
