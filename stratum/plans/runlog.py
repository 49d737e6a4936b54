"""Run bookkeeping: which landing runs a task has processed, and what it did.

The log makes reruns idempotent (a landing run is processed once per task)
and feeds the pipeline-health mart.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.keys import max_key
from stratum.operators.quality import MASK
from stratum.sources.tables import Lakehouse

DONE_STATUSES = ("ok", "gate_failed")


def unseen(table: str, lake: Lakehouse, task_id: str) -> DataFrame:
    """Rows of the landing runs of a bronze ``table`` that ``task_id`` has not
    processed yet.

    Which runs these are comes from the register of landings, not from bronze. The
    scan of bronze joins their (day, run) pairs, one row a landing, and is pruned
    to their days at run time (dynamic partition pruning); nothing passes through
    the driver."""
    done = (
        lake.table("ops.run_log")
        .filter((F.col("task_id") == task_id) & F.col("status").isin(*DONE_STATUSES))
        .select("run_id")
    )
    pending = (
        lake.table("ops.landing_log").where(F.col("source_table") == table).select("run_id", "ingest_date").distinct()
        .join(done, "run_id", "left_anti")
        .select(F.col("ingest_date").alias("_ingest_date"), F.col("run_id").alias("_ingestion_run_id"))
    )
    bronze = lake.table(table)
    return bronze.join(F.broadcast(pending), ["_ingest_date", "_ingestion_run_id"]).select(*bronze.columns)  # a row a landing


def register(lake: Lakehouse, table: str) -> int:
    """Enter the runs of a bronze table that was filled before there was a register."""
    runs = lake.table(table).groupBy(F.col("_ingestion_run_id").alias("run_id"), F.col("_ingest_date").alias("ingest_date")).agg(
        F.count(F.lit(1)).alias("row_count"))
    known = lake.table("ops.landing_log").where(F.col("source_table") == table).select("run_id", "ingest_date")
    new = runs.where("run_id IS NOT NULL").join(known, ["run_id", "ingest_date"], "left_anti")
    return lake.append(new.select(F.lit(table).alias("source_table"), "run_id", "ingest_date", "row_count", F.current_timestamp().alias("landed_at")),
                       "ops.landing_log")


def run_counts(flagged: DataFrame, ts_col: str) -> DataFrame:
    """Checked / quarantined rows and newest observation per landing run: one small
    aggregate (one row per run in the batch), combined map-side."""
    return flagged.groupBy("_ingestion_run_id").agg(
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(F.col(MASK) != 0).alias("rows_quarantined"),
        F.max(ts_col).alias("max_observation_ts"),
        F.min("_ingested_at").alias("first_ingested_at"),
    )


def per_run_counts(flagged: DataFrame, ts_col: str) -> list[dict]:
    """:func:`run_counts` for the log."""
    times = {c: F.col(c).cast("timestamp") for c in ("max_observation_ts", "first_ingested_at")}
    return [r.asDict() for r in run_counts(flagged, ts_col).withColumns(times).collect()]


def record(lake: Lakehouse, dag_id: str, task_id: str, started: dt.datetime, ended: dt.datetime,
           runs: list[dict], status: str) -> None:
    """Append one log row per processed landing run."""
    if not runs:
        return
    data = [
        (
            dag_id,
            r["_ingestion_run_id"],
            task_id,
            (r.get("first_ingested_at") or started).date(),
            started,
            ended,
            int(r["rows_processed"] or 0),
            int(r["rows_quarantined"] or 0),
            r["max_observation_ts"],
            status,
        )
        for r in runs
    ]
    schema = (
        "dag_id string, run_id string, task_id string, run_date date, started_at timestamp, "
        "ended_at timestamp, rows_processed bigint, rows_quarantined bigint, "
        "max_observation_ts timestamp, status string"
    )
    lake.append(lake.spark.createDataFrame(data, schema), "ops.run_log")


def owe(lake: Lakehouse, consumers: Sequence[str], days: Sequence[dt.date]) -> None:
    """Note that the consumers have to process these days (again)."""
    _day_events(lake, [(c, d, "owed") for c in consumers for d in days], dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))


def acknowledge(lake: Lakehouse, consumer: str, days: Sequence[dt.date], since: dt.datetime) -> None:
    """Note that ``consumer`` processed the days as they were at ``since``, when
    it began to read: what came in meanwhile stays owed."""
    _day_events(lake, [(consumer, d, "done") for d in days], since)


def owed_days(lake: Lakehouse, consumer: str) -> list[dt.date]:
    """Days that were owed after they were last done, whatever failed in between:
    a gate, a crash, a skipped run. One row a day."""
    at = {e: F.max(F.when(F.col("event") == e, F.col("logged_at"))) for e in ("owed", "done")}
    days = lake.table("ops.day_log").where(F.col("consumer") == consumer).groupBy("obs_date").agg(*[c.alias(e) for e, c in at.items()])
    return sorted(r["obs_date"] for r in days.where("owed IS NOT NULL AND (done IS NULL OR owed >= done)").collect())


def high_key(lake: Lakehouse, table: str, sk_col: str) -> int:
    """The highest surrogate key given out for a fact: kept, and looked up in the
    fact itself only before the first mark."""
    kept = lake.table("ops.key_mark").where(F.col("table_name") == table).agg(F.max("high").alias("h")).first()["h"]
    return int(kept) if kept is not None else max_key(lake.table(table), sk_col)


def mark_key(lake: Lakehouse, table: str, high: int) -> None:
    lake.append(lake.spark.createDataFrame([(table, high, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))],
                                           "table_name string, high bigint, marked_at timestamp").coalesce(1), "ops.key_mark")


def _day_events(lake: Lakehouse, rows: list[tuple], at: dt.datetime) -> None:
    if rows:
        schema = "consumer string, obs_date date, event string, logged_at timestamp"
        lake.append(lake.spark.createDataFrame([(*r, at) for r in rows], schema).coalesce(1), "ops.day_log")
