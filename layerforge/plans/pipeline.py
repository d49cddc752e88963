"""The full load: bronze -> silver -> gold -> checks -> run history.

Each table is written once as a new version (``publish``); row counts are
taken by an ``Observation`` during that same write, so no table is scanned a
second time for its count.  Layer durations come from the driver clock around
the writes.  The run's check results and table counts are appended to the
history tables.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from layerforge import schemas as SCH
from layerforge.operators import quality as Q
from layerforge.operators.history import store_alerts, threshold_alerts
from layerforge.plans.gold import build_gold, fact_sales
from layerforge.plans.silver import build_silver, stamp
from layerforge.plans.validation import TEXT_RULES, all_checks
from layerforge.plans.warehouse import Layers, run_parallel
from layerforge.sources.feeds import load_feeds, read_text
from layerforge.sources.files import (
    create_layer_schemas, exists, publish, publish_bucketed, read_current, replace_partitions,
)
from layerforge.sources.standins import bronze_tables


@dataclass
class RunResult:
    run_id: int
    layers: Layers | None
    table_rows: dict[tuple[str, str], int] = field(default_factory=dict)
    table_seconds: dict[tuple[str, str], float] = field(default_factory=dict)
    layer_seconds: dict[str, float] = field(default_factory=dict)
    checks: DataFrame | None = None
    started: datetime | None = None


class TableRows(dict):
    """Row counts by (layer, table), with the seconds that each table's write took."""

    def __init__(self):
        super().__init__()
        self.seconds: dict[tuple[str, str], float] = {}


def _write_layer(spark: SparkSession, frames: dict[str, DataFrame], root: str, layer: str,
                 rows: dict[tuple[str, str], int]) -> dict[str, DataFrame]:
    """Publish every table of a layer (concurrently); row counts observed during the writes."""
    def write(name: str, df: DataFrame):
        began = time.time()
        obs = Observation(f"{layer}.{name}")
        publish(df.observe(obs, F.count(F.lit(1)).alias("rows")), f"{root}/{layer}/{name}")
        return int(obs.get["rows"]), time.time() - began, read_current(spark, f"{root}/{layer}/{name}")

    done = run_parallel({name: (lambda n=name, d=df: write(n, d)) for name, df in frames.items()})
    out = {}
    for name, (n, seconds, df) in done.items():
        rows[(layer, name)] = n
        if isinstance(rows, TableRows):
            rows.seconds[(layer, name)] = seconds
        out[name] = df
    return out


def load_bronze(spark: SparkSession, source: str | Mapping[str, str], root: str, rows: dict) -> dict[str, DataFrame]:
    """Full refresh of the six bronze tables.

    ``source``: the paths of the CSV feeds by table name (see ``feeds.feed_paths``), whose headers are
    checked and whose bad lines go to ``bronze/rejected_lines``; or a folder of the driver's tables,
    from which stand-ins are derived.
    """
    if isinstance(source, str):
        return _write_layer(spark, bronze_tables(spark, source), root, "bronze", rows)
    loaded = load_feeds(spark, source)
    out = _write_layer(spark, {name: f.rows for name, f in loaded.items()}, root, "bronze", rows)
    rejected = Q.union_all([f.rejected for f in loaded.values()])
    out["rejected_lines"] = _write_layer(spark, {"rejected_lines": rejected}, root, "bronze", rows)["rejected_lines"]
    return out


def load_silver(spark: SparkSession, bronze: dict[str, DataFrame], root: str, rows: dict,
                as_of: str | None = None, run_ts: str | None = None) -> dict[str, DataFrame]:
    """Full refresh of the six silver tables from stored bronze."""
    frames = {k: stamp(v, run_ts) for k, v in build_silver(bronze, as_of).items()}
    return _write_layer(spark, frames, root, "silver", rows)


def load_gold(spark: SparkSession, silver: dict[str, DataFrame], root: str, rows: dict,
              buckets: int | None = None) -> dict[str, DataFrame]:
    """Dimensions (with surrogate keys) and fact from stored silver.

    With ``buckets`` the fact and the customer dimension are stored as catalog
    tables bucketed by ``customer_key`` (the product dimension by
    ``product_key``), so the customer joins and per-customer aggregates of the
    business queries run without shuffling the fact.
    """
    clean = {k: v.drop("dwh_create_date") if "dwh_create_date" in v.columns else v for k, v in silver.items()}
    if not buckets:
        return _write_layer(spark, build_gold(clean), root, "gold", rows)
    create_layer_schemas(spark, root)
    gold = build_gold(clean)
    keys = {"dim_customers": "customer_key", "fact_sales": "customer_key", "dim_products": "product_key"}
    out = {}
    for name in ("dim_customers", "dim_products", "fact_sales"):
        obs = Observation(f"gold.{name}")
        src = gold[name] if name != "fact_sales" else fact_sales(
            clean["crm_sales_details"], out["dim_products"], out["dim_customers"])
        publish_bucketed(src.observe(obs, F.count(F.lit(1)).alias("rows")), "gold", name, keys[name], buckets,
                         f"{root}/gold/{name}")
        rows[("gold", name)] = int(obs.get["rows"])
        out[name] = spark.table(f"gold.{name}")
    return out


# Layer loads callable by name, like the stored procedures of the source system.
LOADS = {"bronze.load_bronze": load_bronze, "silver.load_silver": load_silver, "gold.load_gold": load_gold}


def run_load(name: str, *args, **kwargs) -> dict[str, DataFrame]:
    """Run one layer load by its name (``bronze.load_bronze``, ``silver.load_silver``, ...)."""
    if name not in LOADS:
        raise KeyError(f"unknown load {name!r}; known: {sorted(LOADS)}")
    return LOADS[name](*args, **kwargs)


def run_pipeline(spark: SparkSession, source: str | Mapping[str, str], root: str, run_id: int,
                 as_of: str | None = None, run_ts: str | None = None,
                 buckets: int | None = None) -> RunResult:
    """Load all layers under ``root`` (a shared folder) and record the run, also when it fails."""
    rows = TableRows()
    result = RunResult(run_id, None, rows, rows.seconds)
    result.started = datetime.now(timezone.utc).replace(tzinfo=None)

    def timed(layer: str, load, *args):
        began = time.time()
        try:
            return load(*args)
        finally:
            result.layer_seconds[layer] = time.time() - began

    try:
        bronze = timed("bronze", run_load, "bronze.load_bronze", spark, source, root, rows)
        silver = timed("silver", run_load, "silver.load_silver", spark, bronze, root, rows, as_of, run_ts)
        gold = timed("gold", run_load, "gold.load_gold", spark, silver, root, rows, buckets)
        clean = {k: v.drop("dwh_create_date") for k, v in silver.items()}
        bronze = {k: v for k, v in bronze.items() if k in clean}
        result.layers = Layers(bronze, clean, gold)
        feeds = {} if isinstance(source, str) else {t: read_text(spark, t, source[t]) for t in TEXT_RULES if t in source}
        result.checks = all_checks(result.layers, as_of, feeds)
        record_run(spark, result, f"{root}/history")
    except Exception as e:
        record_run(spark, result, f"{root}/history", failure=e)
        raise
    return result


def validate_only(layers: Layers, as_of: str | None = None) -> int:
    """Exit code of a validation-only run: 1 when any check failed, else 0."""
    failed = all_checks(layers, as_of).where(~F.col("passed")).limit(1).count()
    return 1 if failed else 0


def layer_metrics(spark: SparkSession, result: RunResult) -> DataFrame:
    """(layer, table_name, row_count, table_seconds, layer_seconds) of one run."""
    data = [(layer, name, n, float(result.table_seconds.get((layer, name), 0.0)), float(result.layer_seconds[layer]))
            for (layer, name), n in result.table_rows.items()]
    return spark.createDataFrame(
        data, "layer string, table_name string, row_count long, table_seconds double, layer_seconds double")


def _run_metrics(spark: SparkSession, result: RunResult, history_root: str, total: int, error_rate: float | None) -> DataFrame:
    """(run_id, metric_name, value) that have a threshold: duration, share of failed checks, change of volume against the run before."""
    values = {"pipeline_duration": float(sum(result.layer_seconds.values())), "error_rate": error_rate}
    if exists(spark, f"{history_root}/pipeline_runs"):
        before = read_history(spark, history_root)["pipeline_runs"].where(
            (F.col("id") != result.run_id) & (F.col("status") == "COMPLETED")).orderBy(F.col("created_at").desc()).head()
        if before is not None and before["total_records"] and total:
            values["data_volume_change"] = abs(total - before["total_records"]) / before["total_records"]
    return spark.createDataFrame([(result.run_id, name, float(v)) for name, v in values.items() if v is not None],
                                 "run_id long, metric_name string, value double")


def record_run(spark: SparkSession, result: RunResult, history_root: str, failure: Exception | None = None) -> None:
    """Add the run, its check results, its table counts and the alerts it raises to the history tables.

    The checks run once: their rows are stored first and the run's score is read from the stored
    rows.  A run that failed has status FAILED and one error.  Tables are partitioned by run, so a
    retried run replaces its own rows; columns as in ``schemas``.
    """
    own = F.lit(result.run_id).cast("long")
    numbered = lambda *by: own * 10_000 + F.row_number().over(Window.orderBy(*by))  # noqa: E731  (a few rows)
    score, errors, n_checks = None, 0, 0
    if failure is None and result.checks is not None:
        checks = result.checks.select(
            numbered("check_name").alias("id"), own.alias("run_id"), "check_name", F.col("category").alias("check_category"),
            "passed", "score", "details", F.localtimestamp().alias("created_at"))
        path = f"{history_root}/data_quality_checks"
        replace_partitions(_typed(checks, SCH.DATA_QUALITY_CHECKS), path, "run_id")
        stored = spark.read.schema(SCH.DATA_QUALITY_CHECKS).parquet(path).where(F.col("run_id") == result.run_id)
        score, errors, n_checks = stored.agg(F.avg("score"), F.count_if(~F.col("passed")), F.count(F.lit(1))).head()
    total = sum(result.table_rows.values())
    store_alerts(threshold_alerts(_run_metrics(spark, result, history_root, total, errors / n_checks if n_checks else None)),
                 history_root, result.run_id)
    run = spark.createDataFrame(
        [(result.run_id, result.started, "COMPLETED" if failure is None else "FAILED",
          float(sum(result.layer_seconds.values())), total, score, int(errors) if failure is None else 1)],
        "id long, run_timestamp timestamp_ntz, status string, duration_seconds double, total_records long, "
        "data_quality_score double, error_count long").withColumn("created_at", F.localtimestamp())
    replace_partitions(_typed(run, SCH.PIPELINE_RUNS).withColumn("run_id", F.col("id")), f"{history_root}/pipeline_runs", "run_id")
    if result.table_rows:
        metrics = spark.createDataFrame(
            [(result.run_id, layer, name, int(n)) for (layer, name), n in result.table_rows.items()],
            "run_id long, schema_name string, table_name string, row_count long").select(
            numbered("schema_name", "table_name").alias("id"), "*", F.localtimestamp().alias("created_at"))
        replace_partitions(_typed(metrics, SCH.TABLE_METRICS), f"{history_root}/table_metrics", "run_id")


def _typed(df: DataFrame, schema) -> DataFrame:
    """The declared columns in their order and types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_history(spark: SparkSession, history_root: str) -> dict[str, DataFrame]:
    """The three history tables with their declared columns, as the readers in ``operators.history`` take them."""
    return {name: spark.read.schema(schema).parquet(f"{history_root}/{name}").select(schema.names)
            for name, schema in (("pipeline_runs", SCH.PIPELINE_RUNS), ("data_quality_checks", SCH.DATA_QUALITY_CHECKS),
                                 ("table_metrics", SCH.TABLE_METRICS))}
