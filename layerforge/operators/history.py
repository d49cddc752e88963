"""Run history, metrics, alerts and health as table operators.

The three history tables (pipeline_runs, data_quality_checks, table_metrics)
are append-only.  Readers take the latest slices with top-k sorts
(TakeOrderedAndProject: a bounded heap per task, no global sort) and summaries
with single-pass aggregates.  ``runs_from_events`` derives a history from the
event stream of the driver data: a run = one user's events of one day.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerforge.operators.sequence import lead_in_group
from layerforge.sources.files import replace_partitions

# Monitoring thresholds and health rules.
THRESHOLDS = {"pipeline_duration": 600.0, "error_rate": 0.05, "data_volume_change": 0.2}
CRITICAL_FACTOR = 1.2
HEALTHY_QUALITY = 0.95
SUMMARY_DAYS = 30
EVENT_TABLES = {"view": "bronze", "click": "silver"}
EVENT_TABLE_CODES = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}


def _run_id(user: Column, ts: Column) -> Column:
    return user.cast("long") * F.lit(100000) + F.unix_date(F.to_date(ts)).cast("long")


def runs_from_events(events: DataFrame) -> DataFrame:
    """pipeline_runs: one row per (user, day); status FAILED when the day has an error event."""
    err = F.col("event_type") == "error"
    return events.groupBy(_run_id(F.col("user_id"), F.col("ts")).alias("id")).agg(
        F.min("ts").alias("run_timestamp"),
        F.when(F.count_if(err) > 0, F.lit("FAILED")).otherwise(F.lit("COMPLETED")).alias("status"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("duration_seconds"),
        F.count(F.lit(1)).cast("long").alias("total_records"),
        (F.count_if(~err).cast("double") / F.count(F.lit(1)).cast("double")).alias("data_quality_score"),
        F.count_if(err).cast("long").alias("error_count"),
        F.max("ts").alias("created_at"),
    )


def checks_from_events(events: DataFrame) -> DataFrame:
    """data_quality_checks: one row per event of a run."""
    name = F.concat(F.col("event_type"), F.lit(" - events"))
    return events.select(
        F.col("event_id").alias("id"),
        _run_id(F.col("user_id"), F.col("ts")).alias("run_id"),
        name.alias("check_name"),
        F.split_part(name, F.lit(" - "), F.lit(1)).alias("check_category"),
        (F.col("event_type") != "error").alias("passed"),
        (F.col("value").cast("double") / F.lit(100.0)).alias("score"),
        F.col("props").alias("details"),
        F.col("ts").alias("created_at"),
    )


def table_metrics_from_events(events: DataFrame) -> DataFrame:
    """table_metrics: row count per (run, event type), the type standing for a table."""
    rid = _run_id(F.col("user_id"), F.col("ts"))
    return events.groupBy(rid.alias("run_id"), "event_type").agg(
        F.count(F.lit(1)).cast("long").alias("row_count"), F.max("ts").alias("created_at"),
    ).select(
        (F.col("run_id") * 10 + _code(F.col("event_type"))).alias("id"),
        "run_id",
        _schema(F.col("event_type")).alias("schema_name"),
        F.col("event_type").alias("table_name"),
        "row_count",
        "created_at",
    )


def _schema(et: Column) -> Column:
    out = F.lit("gold")
    for t, layer in EVENT_TABLES.items():
        out = F.when(et == t, F.lit(layer)).otherwise(out)
    return out


def _code(et: Column) -> Column:
    out = F.lit(0)
    for t, c in EVENT_TABLE_CODES.items():
        out = F.when(et == t, F.lit(c)).otherwise(out)
    return out.cast("long")


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """Latest ``n`` runs by creation time (ties: higher id first)."""
    return runs.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(n)


def quality_trend(runs: DataFrame, n: int = 30) -> DataFrame:
    return (runs.where(F.col("data_quality_score").isNotNull())
            .orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(n)
            .select("id", "run_timestamp", "data_quality_score", "status"))


def table_trends(metrics: DataFrame, runs: DataFrame, n: int = 100) -> DataFrame:
    """Latest ``n`` table counts with their run time."""
    j = metrics.join(runs.select(F.col("id").alias("run_id"), "run_timestamp",
                                 F.col("created_at").alias("run_created")), "run_id")
    return (j.orderBy(F.col("run_created").desc(), F.col("run_id").desc(), "schema_name", "table_name")
            .limit(n).select("run_id", "schema_name", "table_name", "row_count", "run_timestamp"))


def latest_run_checks(checks: DataFrame, runs: DataFrame) -> DataFrame:
    """Checks of the run with the highest id: the id and its time come from one aggregate (one row)."""
    last = runs.agg(F.max(F.struct(F.col("id").alias("run_id"), "run_timestamp")).alias("l")).select("l.*")
    return checks.join(F.broadcast(last), "run_id")


def history_summary(runs: DataFrame, as_of: str, days: int = SUMMARY_DAYS) -> DataFrame:
    """Total runs, success % and mean quality % of the last ``days`` days, latest status."""
    recent = F.col("created_at") >= (F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS"))
    ok = F.col("status") == "COMPLETED"
    q = F.col("data_quality_score")
    return runs.agg(
        F.count(F.lit(1)).cast("long").alias("total_runs"),
        F.count_if(recent).alias("_n"),
        F.count_if(recent & ok).alias("_ok"),
        F.sum(F.when(recent & q.isNotNull(), q.cast("decimal(20,12)"))).alias("_qs"),
        F.count_if(recent & q.isNotNull()).alias("_qn"),
        F.max_by(F.struct("status", "run_timestamp"), F.struct("created_at", "id")).alias("_last"),
    ).select(
        "total_runs",
        F.when(F.col("_n") > 0, F.round((F.col("_ok") * 100).cast("double") / F.col("_n").cast("double"), 1))
        .otherwise(F.lit(0.0)).alias("success_rate"),
        F.when(F.col("_qn") > 0, F.round(F.col("_qs").cast("double") * 100 / F.col("_qn").cast("double"), 1))
        .otherwise(F.lit(0.0)).alias("avg_quality_score"),
        F.coalesce(F.col("_last.status"), F.lit("UNKNOWN")).alias("latest_status"),
        F.col("_last.run_timestamp").alias("latest_timestamp"),
    )


def latest_table_counts(metrics: DataFrame, runs: DataFrame) -> DataFrame:
    """Table counts of the run(s) with the latest run timestamp."""
    times = runs.select(F.col("id").alias("run_id"), "run_timestamp")
    last = times.join(metrics.select("run_id"), "run_id", "left_semi").agg(F.max("run_timestamp").alias("run_timestamp"))
    # Few runs are left before the metrics are joined, once.
    return metrics.join(times.join(F.broadcast(last), "run_timestamp"), "run_id").select(
        "run_id", "schema_name", "table_name", "row_count", "run_timestamp")


def volume_change_alerts(runs: DataFrame, pipeline: Column, threshold: float = THRESHOLDS["data_volume_change"]
                         ) -> DataFrame:
    """Runs whose record count moved more than ``threshold`` against the previous run of the pipeline.

    The previous run is the next one backwards in time; a pipeline with many runs is cut over many partitions.
    """
    counts = runs.select("id", "created_at", "total_records", pipeline.alias("pipeline"))
    r = lead_in_group(counts, ["pipeline"], [F.col(c).desc_nulls_last() for c in ("created_at", "id")],
                      "total_records", "previous_records")
    change = F.try_divide((F.col("total_records") - F.col("previous_records")).cast("double"),
                          F.col("previous_records").cast("double"))
    return (r.withColumn("change", change)
            .where(F.abs(F.col("change")) > threshold)
            .select("id", "pipeline", "previous_records", "total_records", F.round("change", 9).alias("change")))


# ---------------------------------------------------------------------------
# Metrics
# ---------------------------------------------------------------------------

def metrics_from_runs(runs: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Long metric rows (run_id, metric_name, value) of every run; ``names`` makes only those."""
    total, errors = F.col("total_records").cast("double"), F.col("error_count").cast("double")
    values = {
        "pipeline_duration": F.col("duration_seconds"),
        "bronze_rows_loaded": total,
        "silver_rows_processed": (F.col("total_records") - F.col("error_count")).cast("double"),
        "data_quality_score": F.col("data_quality_score"),
        "load_errors": errors,
        "error_rate": errors / total,
    }
    wanted = list(values) if names is None else [n for n in values if n in set(names)]
    m = F.explode(F.array(*[F.struct(F.lit(n).alias("metric_name"), values[n].alias("value")) for n in wanted]))
    return runs.select(F.col("id").alias("run_id"), m.alias("_m")).select("run_id", "_m.metric_name", "_m.value")


def throughput(runs: DataFrame) -> DataFrame:
    """Rows per second per run; 0 when the duration is 0 or unknown."""
    rate = F.coalesce(F.try_divide(F.col("total_records").cast("double"), F.col("duration_seconds")), F.lit(0.0))
    return runs.select(F.col("id").alias("run_id"), "total_records", "duration_seconds",
                       F.round(rate, 9).alias("rows_per_second"))


def error_counts(events: DataFrame) -> DataFrame:
    """Error events summed by type per run; the type is read from the event payload."""
    err = events.where(F.col("event_type") == "error")
    etype = F.when(F.get_json_object("props", "$.k").cast("int") < 50, F.lit("validation")).otherwise(F.lit("load"))
    return err.groupBy(_run_id(F.col("user_id"), F.col("ts")).alias("run_id"), etype.alias("error_type")).agg(
        F.count(F.lit(1)).cast("long").alias("error_count"))


def threshold_alerts(metrics: DataFrame, thresholds: Mapping[str, float] = THRESHOLDS,
                     severity: str | None = None) -> DataFrame:
    """Metrics above their threshold; WARNING below 1.2 x threshold, else CRITICAL.

    The configured thresholds are a literal map: no join, no scan of metrics without one.
    """
    limits = F.create_map(*[F.lit(x) for k, v in thresholds.items() for x in (k, float(v))])
    over = (metrics.where(F.col("metric_name").isin(list(thresholds)))
            .withColumn("threshold", F.try_element_at(limits, F.col("metric_name"))).where(F.col("value") > F.col("threshold")))
    sev = F.when(F.col("value") < F.col("threshold") * CRITICAL_FACTOR, F.lit("WARNING")).otherwise(F.lit("CRITICAL"))
    out = over.select("run_id", "metric_name", "value", "threshold", sev.alias("severity"))
    return out.where(F.col("severity") == severity) if severity else out


def store_alerts(alerts: DataFrame, history_root: str, run_id: int) -> None:
    """Keep a run's alerts beside its other history; a retried run replaces its own."""
    own = alerts.where(F.col("run_id") == run_id).withColumn("created_at", F.localtimestamp())
    replace_partitions(own, f"{history_root}/alerts", "run_id")


def pipeline_health(runs: DataFrame) -> DataFrame:
    """HEALTHY / WARNING / UNHEALTHY per run from completion, quality and errors.

    Rule order as in the monitor: errors make a run UNHEALTHY; otherwise a
    known, non-zero quality below 0.95 gives WARNING; otherwise a run with no
    recorded duration is UNHEALTHY.
    """
    d, q, e = F.col("duration_seconds"), F.col("data_quality_score"), F.col("error_count")
    completed = d.isNotNull() & (d != 0)
    q_checked = q.isNotNull() & (q != 0)
    status = (F.when(e > 0, F.lit("UNHEALTHY"))
              .when(q_checked & (q < HEALTHY_QUALITY), F.lit("WARNING"))
              .when(~completed, F.lit("UNHEALTHY"))
              .otherwise(F.lit("HEALTHY")))
    return runs.select(
        F.col("id").alias("run_id"),
        F.when(completed, "PASS").otherwise("FAIL").alias("completion_check"),
        F.when(~q_checked, F.lit(None).cast("string")).when(q >= HEALTHY_QUALITY, "PASS").otherwise("WARNING")
        .alias("quality_check"),
        F.when(e == 0, "PASS").otherwise("FAIL").alias("error_check"),
        status.alias("status"),
    )


def metric_categories(metrics: DataFrame) -> DataFrame:
    """(category, metric_name, n, least, most) of metric values, grouped by words in the name.

    A name may fall in several groups.  Values are aggregated per name before the groups are made.
    """
    n = F.lower(F.col("metric_name"))
    has = lambda s: n.contains(s)
    cats = F.array(
        F.when(has("duration"), F.lit("Duration")),
        F.when(has("rows") & ~has("per_second"), F.lit("Row Counts")),
        F.when(has("per_second") | has("throughput"), F.lit("Throughput")),
        F.when(has("quality") | has("score"), F.lit("Quality")),
        F.when(has("error"), F.lit("Errors")),
        F.when(~(has("duration") | has("rows") | has("per_second") | has("throughput") | has("quality")
                 | has("score") | has("error")), F.lit("Other")),
    )
    per = metrics.groupBy("metric_name").agg(F.count("value").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
    return per.select(F.explode(F.array_compact(cats)).alias("category"), "metric_name", "n", "least", "most")
