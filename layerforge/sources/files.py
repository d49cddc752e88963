"""File sources and layer sinks.

Readers
-------
read_bronze_csv   typed CSV load (header row, comma, no quoting), bad rows kept aside
read_csv_infer    exploratory load with schema inference; a missing file gives None
file_inventory    presence, size, modification time and columns of files, rows never read

Writers
-------
publish / read_current  full refresh as a new version folder plus a numbered commit, so a
                        failed load leaves the previous version readable
append_load             append one batch to a table folder
replace_partitions      idempotent append by dynamic partition overwrite
write_counted           write and return the row count (observed during the write)
export_json             metric rows as JSON lines
write_partitioned       layout by a derived month column for partition pruning
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.sources import versions as V
from layerforge.sources.versions import exists

CORRUPT = "_corrupt_record"
# No quoting: a NUL quote character never occurs in the data.
_NO_QUOTE = "\u0000"
_CSV_OPTS = {
    "header": "true", "sep": ",", "quote": _NO_QUOTE, "escape": _NO_QUOTE,
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "nullValue": "", "emptyValue": "",
}


def read_bronze_csv(spark: SparkSession, path: str, schema: T.StructType,
                    keep_corrupt: bool = False) -> DataFrame:
    """Typed, positional CSV load; a row that does not fit the schema keeps its text in ``_corrupt_record``."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    df = (spark.read.schema(full).options(**_CSV_OPTS)
          .option("columnPruning", "false")  # a line is judged by all of its fields, whatever is read of it
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return df if keep_corrupt else df.drop(CORRUPT)


def write_bronze_csv(df: DataFrame, path: str) -> None:
    """CSV in the raw feed format (header, comma, no quoting)."""
    df.write.mode("errorifexists").options(**_CSV_OPTS).csv(path)


def read_csv_infer(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame | None:
    """Inferred schema; None for a missing file (any other fault is raised)."""
    if not exists(spark, path):
        return None
    return (spark.read.option("header", "true").option("inferSchema", "true")
            .option("encoding", encoding).csv(path))


def file_inventory(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """(file, found, size_bytes, size_mb, modified, column_count, columns) of each named file or folder.

    Sizes and times come from the listing and columns from the footers or headers; no rows are read.
    """
    rows = []
    for name, path in paths.items():
        if not exists(spark, path):
            rows.append((name, False, None, None, None, None))
            continue
        listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                  .agg(F.sum("length"), F.max("modificationTime")).head())
        columns = spark.read.format(fmt).option("header", "true").load(path).columns
        rows.append((name, True, *listed, len(columns), columns))
    out = spark.createDataFrame(rows, "file string, found boolean, size_bytes long, modified timestamp, column_count int, columns array<string>")
    return out.select("file", "found", "size_bytes", F.round(F.col("size_bytes") / F.lit(1024 * 1024), 2).alias("size_mb"),
                      "modified", "column_count", "columns")


def stored_mb(df: DataFrame) -> float:
    """Size in MB of the files that ``df`` reads, from their listing."""
    files = df.inputFiles()
    if not files:
        return 0.0
    total = df.sparkSession.read.format("binaryFile").load(files).agg(F.sum("length")).head()[0]
    return round((total or 0) / (1024 * 1024), 3)


# ---------------------------------------------------------------------------
# Layer writes
# ---------------------------------------------------------------------------

def has_version(spark: SparkSession, base: str) -> bool:
    return V.newest(spark, base) is not None


def publish(df: DataFrame, base: str, parent: int | None = None) -> str:
    """Full refresh: write a new version folder, then commit it as the next version (``versions``).

    Nothing is overwritten, so a load that fails at any point leaves the version before it.  Two refreshes at
    once are both committed, one after the other.  For a load that depends on what it read, ``parent`` is the
    number it read (0: none): a later commit raises ``CommitConflict`` and the new folder is dropped.
    Returns the version path.
    """
    spark = df.sparkSession
    folder = f"v-{uuid.uuid4().hex}"
    target = f"{base.rstrip('/')}/{folder}"
    df.write.mode("errorifexists").parquet(target)
    try:
        V.commit(spark, base, {"paths": [folder]}, parent)
    except V.CommitConflict:
        V.delete(spark, target)
        raise
    return target


def read_version(spark: SparkSession, base: str, version: V.Version) -> DataFrame:
    return spark.read.parquet(*[f"{base.rstrip('/')}/{p}" for p in version.paths])


def read_current(spark: SparkSession, base: str) -> DataFrame:
    newest = V.newest(spark, base)
    if newest is None:
        raise FileNotFoundError(f"no version at {base}")
    return read_version(spark, base, newest)


def write_counted(df: DataFrame, path: str, mode: str = "append") -> int:
    """Write ``df`` and return the number of rows written (the DML row count).

    The count is an ``Observation`` gathered during the write itself, so the
    data is not scanned a second time.
    """
    obs = Observation(f"write-{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return int(obs.get["rows"])


def export_json(metrics: DataFrame, path: str) -> None:
    """Metric rows as JSON lines: name, value, timestamp (when exported) and type (of the value)."""
    kind = metrics.schema["value"].dataType.simpleString()
    (metrics.select("name", "value", F.current_timestamp().alias("timestamp"), F.lit(kind).alias("type"))
     .write.mode("errorifexists").json(path))


def replace_partitions(df: DataFrame, path: str, partition_col: str) -> None:
    """Idempotent append: rewrite only the ``partition_col`` values present in ``df``.

    Dynamic partition overwrite replaces exactly those partitions, so running
    the same batch (e.g. a retried pipeline run) twice leaves one copy.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def append_load(df: DataFrame, path: str) -> None:
    """Append one batch; never reads and overwrites the same folder."""
    df.write.mode("append").parquet(path)


def write_partitioned(df: DataFrame, path: str, date_col: str) -> None:
    """Lay the table out by (year, month) of ``date_col`` for partition pruning on read."""
    (df.withColumn("order_year", F.year(date_col)).withColumn("order_month", F.month(date_col))
     # Rebalanced, not hashed to one task a month: a large month (or the undated one) is split at runtime.
     .hint("rebalance", "order_year", "order_month")
     .write.mode("errorifexists").partitionBy("order_year", "order_month").parquet(path))


# ---------------------------------------------------------------------------
# Layer schemas in the session catalog
# ---------------------------------------------------------------------------

LAYERS = ("bronze", "silver", "gold")


def create_layer_schemas(spark: SparkSession, root: str) -> None:
    """``bronze``, ``silver`` and ``gold`` namespaces located under ``root``; existing ones are kept."""
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root.rstrip('/')}/{layer}'")


def publish_table(df: DataFrame, layer: str, name: str, base: str) -> str:
    """Full refresh of ``layer.name``: new version folder, then the table is pointed at it.

    The catalog switch is a metadata change, so readers see either the old
    or the new version, never a half-written one.
    """
    spark = df.sparkSession
    target = publish(df, base)
    table = f"{layer}.{name}"
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{target}'")
    return target


def publish_bucketed(df: DataFrame, layer: str, name: str, key: str, buckets: int, base: str) -> str:
    """Full refresh of ``layer.name`` as a table bucketed and sorted by ``key``.

    Tables bucketed by the same key into the same number of buckets join and
    aggregate on that key without any shuffle (the fact with its customer
    dimension at a size where neither side can be broadcast).  Each refresh
    writes a new versioned table; the view ``layer.name`` is then pointed at
    it, a metadata switch, so readers never see a half-written version.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex[:12]
    versioned = f"{layer}.{name}__v{version}"
    # Dealt out by the key first: one file a bucket, not one from every task.
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", f"{base.rstrip('/')}/v-{version}").saveAsTable(versioned))
    spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS SELECT * FROM {versioned}")
    return versioned


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """(schema_name, table_name) of the layer tables, ordered; optionally one layer only."""
    rows = [(db, t.name) for db in (LAYERS if schema is None else (schema,))
            if spark.catalog.databaseExists(db) for t in spark.catalog.listTables(db) if not t.isTemporary]
    return spark.createDataFrame(rows, "schema_name string, table_name string").orderBy("schema_name", "table_name")


def list_schemas(spark: SparkSession) -> list[str]:
    """User namespaces (the built-in ``default`` left out)."""
    return sorted(d.name for d in spark.catalog.listDatabases() if d.name != "default")
