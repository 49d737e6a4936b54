"""Pipeline-health mart run and the date dimension load."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators.dims import date_dimension_between
from stratum.operators.health import pipeline_health


def run_pipeline_health(lake, since=None) -> int:
    """Rebuild health rows of the runs in which anything started since ``since``
    (a date; all when None) from all their log rows, so that a run over two days
    is rolled up whole, and upsert them on (dag_id, run_id)."""
    log = lake.table("ops.run_log")
    if since is not None:
        recent = log.where(F.to_date("started_at") >= F.lit(since)).select("dag_id", "run_id").distinct()
        log = log.join(recent, ["dag_id", "run_id"], "left_semi")
    touched = lake.upsert(pipeline_health(log), "gold.mart_pipeline_health")
    return len(touched)


def run_dim_date(lake, start: str, end: str) -> int:
    """(Re)build gold.dim_date for [start, end]; one row per calendar day."""
    bounds = lake.spark.createDataFrame([(start, end)], "start string, end string").selectExpr(
        "to_date(start) AS start", "to_date(end) AS end"
    )
    lake.replace(date_dimension_between(bounds), "gold.dim_date")
    return lake.table("gold.dim_date").count()
