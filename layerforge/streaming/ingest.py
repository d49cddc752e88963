"""Incremental file ingest into bronze with Structured Streaming.

New CSV files in a landing folder are picked up by a file stream with the
declared bronze schema; each micro-batch is appended to the bronze table through the Parquet file
sink.
``trigger(availableNow=True)`` processes what is there and stops, so the same
job serves scheduled batch runs; the checkpoint (under the shared checkpoint
folder) records which files were done, so a rerun never loads a file twice and
a lost executor only repeats its micro-batch.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.operators.windows import dedup_latest
from layerforge.sources import merge_table as MT
from layerforge.sources.files import _CSV_OPTS


def ingest_csv_folder(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                      checkpoint: str, max_files_per_trigger: int | None = None) -> None:
    """Load every new file under ``landing`` into the Parquet table at ``target``."""
    reader = spark.readStream.schema(schema).options(**_CSV_OPTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.csv(landing)

    # The file sink logs committed files under ``target/_spark_metadata``:
    # a replayed micro-batch is not appended twice (exactly-once output).
    query = (stream.writeStream.format("parquet")
             .option("path", target)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()


def keep_latest(stream: DataFrame, table: MT.MergeTable, checkpoint: str) -> None:
    """Keep the newest row per key of a stream in a merge-on-read table; runs until what is available is taken.

    The table is the state: durable, keyed and shared with its readers, so no row is too late for a watermark and
    no state store has to hold all keys.  A micro-batch is one change file.  Taking the newest row per key again
    changes nothing, so a batch that is replayed after a failure leaves the same rows: exactly once in effect.
    """
    def put(batch: DataFrame, _: int) -> None:
        MT.load(batch.sparkSession, table, batch)

    (stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class StateRun(NamedTuple):
    """Of one run's last hundred micro-batches: groups of rows that came too late; states held at the end."""

    too_late: int
    held: int


def keep_latest_by_state(stream: DataFrame, table: MT.MergeTable, checkpoint: str, late: str = "3 days", span: str = "1 day") -> StateRun:
    """``keep_latest`` with the newest row per key and ``span`` of time in a state store.

    A row reaches the table only when it is the newest of its key and span so far, so repeated and outdated
    deliveries within ``late`` cost no change rows, and a hot key is one row per task and micro-batch.  The watermark
    trails the newest time seen by ``late``; spans wholly behind it leave the store, which therefore holds the keys of
    recent spans, not of all time.  Rows of such spans are not taken any more; they are counted as too late, so a caller
    can raise ``late`` and load them again.  Rows without a time are never too late and go straight to the table.

    State, watermark and taken files are in the checkpoint.  A batch replayed after a failure starts from the state before
    it and gives the table the same rows again, which changes nothing: exactly once in effect.
    """
    at, of = "_event_time", "_span"
    time = F.col(table.order)
    dated = stream.where(time.isNotNull()).withColumn(at, time.cast("timestamp")).withWatermark(at, late)
    newest = dedup_latest(dated.withColumn(of, F.window(at, span)), [of, *table.keys], table.order, drop_null_keys=False)
    out = newest.select(*stream.columns).unionByName(stream.where(time.isNull()))

    def put(batch: DataFrame, _: int) -> None:
        MT.load(batch.sparkSession, table, batch)

    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKSDB)
    try:
        query = (out.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    return StateRun(sum(s["numRowsDroppedByWatermark"] for s in states), states[-1]["numRowsTotal"] if states else 0)
