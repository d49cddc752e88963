"""Loads that put rejected rows aside in the same pass, and replay them once they are mended.

A load writes every row once: rows without a reason to ``_rejected=0``, the others, with their reasons, the run's id and
an id of their own, to ``_rejected=1`` of the same folder, which one commit makes visible as a whole.  A replay takes
mended rows with the ids of their rejects, judges them by the same rules, and commits them together with the ids, which
are a column of the rows it writes, so that a reject is replayed once at most, also when two replays run at the same
time; what fails again is a new reject.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.sources import versions as V

REASON, RUN, REJECT, SIDE, REPLAYED = "_reject_reason", "_run_id", "_reject_id", "_rejected", "_replayed"
_MARKS = [T.StructField(c, T.StringType()) for c in (REASON, RUN, REJECT)]


def _write(spark: SparkSession, base: str, rows: DataFrame, reason: Column, run_id: str) -> str:
    """Judge and write rows in one pass; the folder."""
    folder = f"load-{uuid.uuid4().hex}"
    bad = F.coalesce(F.col(REASON) != "", F.lit(False))
    judged = rows.withColumn(REASON, reason).withColumn(RUN, F.lit(run_id)).withColumn(
        REJECT, F.when(bad, F.concat_ws("/", F.lit(folder), F.monotonically_increasing_id()))).withColumn(SIDE, bad.cast("int"))
    judged.write.mode("errorifexists").partitionBy(SIDE).parquet(f"{base.rstrip('/')}/{folder}/rows")
    return folder


def _committed(v: V.Version | None) -> tuple[list[str], list[str]]:
    return (v.entry["loads"], v.entry["replays"]) if v else ([], [])


def _commit(spark: SparkSession, base: str, schema: T.StructType, folder: str, parent: V.Version | None, replay: bool) -> V.Version:
    loads, replays = _committed(parent)
    loads, replays = [*loads, folder], [*replays, folder] if replay else replays
    return V.commit(spark, base, {"paths": loads, "loads": loads, "replays": replays, "schema": schema.json()}, parent.n if parent else 0)


def split_load(spark: SparkSession, base: str, rows: DataFrame, reason: Column, run_id: str) -> V.Version:
    """Load rows; those with a ``reason`` (text, empty or NULL: none) go aside."""
    folder = _write(spark, base, rows, reason, run_id)
    while True:
        try:
            return _commit(spark, base, rows.schema, folder, V.newest(spark, base), False)
        except V.CommitConflict:
            continue


def _side(spark: SparkSession, base: str, v: V.Version, side: int) -> DataFrame:
    """Rows of one side; the other side's files are not looked at."""
    schema = T.StructType(T.StructType.fromJson(json.loads(v.entry["schema"])).fields + _MARKS)
    paths = [f"{base.rstrip('/')}/{p}/rows/{SIDE}={side}" for p in v.entry["loads"]]
    paths = [p for p in paths if V.exists(spark, p)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def good_rows(spark: SparkSession, base: str) -> DataFrame:
    return _side(spark, base, V.newest(spark, base), 0).drop(REASON, RUN, REJECT)


def rejects(spark: SparkSession, base: str, at: V.Version | None = None) -> DataFrame:
    """Rejected rows that wait for their replay: all columns, reason, run and reject id."""
    v = at or V.newest(spark, base)
    waiting = _side(spark, base, v, 1)
    if not v.entry["replays"]:
        return waiting
    folders = [f"{base.rstrip('/')}/{p}" for p in v.entry["replays"]]
    apart = [f"{p}/{REPLAYED}" for p in folders if V.exists(spark, f"{p}/{REPLAYED}")]  # replays of before had files of ids
    within = [f"{p}/rows/{SIDE}={side}" for p in folders if f"{p}/{REPLAYED}" not in apart for side in (0, 1)]
    parts = [spark.read.schema(f"{c} string").parquet(*paths).select(F.col(c).alias(REJECT))
             for c, paths in ((REJECT, apart), (REPLAYED, [p for p in within if V.exists(spark, p)])) if paths]
    if not parts:
        return waiting
    done = reduce(DataFrame.unionByName, parts)
    return waiting.join(done.distinct(), REJECT, "left_anti").select(*waiting.columns)


def replay(spark: SparkSession, base: str, mended: DataFrame, reason: Column, run_id: str) -> V.Version:
    """Load mended rejects (``mended`` has their reject ids); ids that do not wait, or wait no more, are left out.

    Of several rows under one id one is loaded.  A replay that meets another commit looks again at what waits.
    """
    while True:
        last = V.newest(spark, base)
        schema = T.StructType.fromJson(json.loads(last.entry["schema"]))
        waiting = rejects(spark, base, last).select(REJECT)
        rows = mended.select(*schema.names, REJECT).dropDuplicates([REJECT]).join(waiting, REJECT, "left_semi")
        # One write of rows and ids: both come from the same choice among rows of one id.
        folder = _write(spark, base, rows.withColumnRenamed(REJECT, REPLAYED), reason, run_id)
        try:
            return _commit(spark, base, schema, folder, last, True)
        except V.CommitConflict:
            V.delete(spark, f"{base.rstrip('/')}/{folder}")
