"""Session settings and the shared scratch / checkpoint location.

On a cluster the operator supplies ``spark.checkpoint.dir`` (a shared, durable
folder such as an object-store prefix).  Everything that must outlive a lost
executor -- reliable checkpoints, staged layer writes -- goes below it.  A
machine-local folder is only chosen when the session runs in local mode and
the setting is absent (tests, the bench, the smoke check).
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "layerforge",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings every layer build relies on.

    AQE stays on: it coalesces small shuffle partitions, turns a sort-merge
    join into a broadcast join only when the runtime size of a side is below
    ``autoBroadcastJoinThreshold`` (the size check for dimension joins), and
    splits skewed partitions of a join at runtime.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset and
    the master is local is a fresh folder under the system temp dir made.
    On a cluster an unset value is an error: a machine-local folder would not
    survive the loss of the executor that wrote it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="layerforge-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="layerforge-package-"), "layerforge")
    sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
    _SHIPPED.add(sc.applicationId)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint location for staged writes."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def write_through(df, name: str):
    """Write ``df`` as Parquet to a fresh folder below the checkpoint dir and read it back.

    Cuts the lineage like a checkpoint (the folder is shared and durable on a
    cluster) and gives later plans real file statistics.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("errorifexists").parquet(path)
    # The schema is known: reading it back needs no footer-inference job.
    return spark.read.schema(df.schema).parquet(path)
