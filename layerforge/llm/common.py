"""Helpers that the operators share: reading tables, staging, stable row order."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back; cuts the lineage."""
    path = path or new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame, carry: list[str] | tuple = ()) -> DataFrame:
    """(doc_id, text) and the columns of ``carry``: null texts are empty, all else is left out."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       *carry)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The given names, with underscores before those that ``df`` already has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that a task makes Python objects of a few rows at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def row_base() -> int:
    """First of this task's row numbers; unique over all tasks of a stage."""
    return TaskContext.get().partitionId() << 40


def tokenizer_path(name: str) -> str:
    """Default place of a public vocabulary file; every operator takes another path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)
