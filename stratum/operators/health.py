"""Pipeline-health mart over the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pipeline_health(run_log: DataFrame) -> DataFrame:
    """Per (dag_id, run_id): day of the run, rows processed and quarantined
    over its tasks, wall time from first start to last end, and freshness
    lag = run end - newest observation, in minutes."""
    runs = run_log.groupBy("dag_id", "run_id").agg(
        F.min("started_at").alias("started"),
        F.max("ended_at").alias("ended"),
        F.sum("rows_processed").alias("rows_processed"),
        F.sum("rows_quarantined").alias("rows_quarantined"),
        F.max("max_observation_ts").alias("newest"),
    )
    return runs.select(
        "dag_id",
        "run_id",
        F.to_date("started").alias("run_date"),
        F.col("rows_processed").cast("bigint").alias("rows_processed"),
        F.col("rows_quarantined").cast("bigint").alias("rows_quarantined"),
        F.timestamp_diff("SECOND", F.col("started"), F.col("ended")).cast("double").alias("run_duration_sec"),
        (F.timestamp_diff("SECOND", F.col("newest"), F.col("ended")).cast("double") / F.lit(60.0)).alias(
            "freshness_lag_minutes"
        ),
    )
