"""The bronze -> silver run that all silver tables share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.quality import Gate, GateClosed, RuleSet, quarantine_records
from stratum.plans import runlog
from stratum.schemas import TABLES


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _days(parts: Sequence[tuple]) -> list[dt.date]:
    return sorted({p[-1] for p in parts if isinstance(p[-1], dt.date)})


def promote(
    lake,
    *,
    task: str,
    dag_id: str,
    table: str,
    candidates: DataFrame,
    rules: RuleSet,
    silver: Callable[[DataFrame], DataFrame],
    ts_col: str,
    started: dt.datetime,
    gate: Gate,
    scratch: Sequence[str] = (),
    follow: Callable[[list[dt.date]], Callable[[DataFrame, list], None]] | None = None,
    followed: str = "",
) -> dict:
    """Check ``candidates`` (which carry ``_ingestion_run_id`` and
    ``_ingested_at``), merge what passes, quarantine what does not, log, gate.

    The marked batch is kept once and feeds counts, merge and quarantine. The
    merge keeps the newest ingest time of a key across runs, so a late older
    landing is harmless. ``follow`` makes what keeps the table ``followed`` from the
    merge's change feed, given the days it was owed before. Order of writes: the
    days that are now owed, silver, the followed table, quarantine, log. A crash before the log lets the next run take the same
    landings again; silver and the owed days then come out the same, and
    quarantine skips landings it already has rows of. The gate comes last:
    a bad batch fails the run without hiding the rows that passed, and gold
    catches up on their days with the next run that succeeds.
    """
    from stratum.plans import derived

    keys = list(TABLES[table].keys)
    marked = rules.mark(candidates).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        runs = runlog.per_run_counts(marked, ts_col)
        before = runlog.owed_days(lake, followed) if follow else []
        touched = lake.upsert(silver(rules.passed(marked).drop(*scratch)), table, newest_by="_ingested_at",
                              before_write=lambda parts: derived.owe(lake, table, _days(parts)),
                              on_changes=follow(before) if follow else None)
        days = _days(touched)
        if follow:
            derived.owe(lake, followed, days)
        if any(r["rows_quarantined"] for r in runs):
            rows = quarantine_records(rules.failed(marked).drop(*scratch), table, keys, quarantined_at=F.lit(started).cast("timestamp"))
            there = lake.table("silver.dq_quarantine").where(F.col("source_table") == table).select(F.col("_ingestion_run_id").alias("run")).distinct()
            lake.append(rows.join(there, F.col("_ingestion_run_id").eqNullSafe(F.col("run")), "left_anti"), "silver.dq_quarantine")
    finally:
        marked.unpersist()
    checked = sum(int(r["rows_processed"]) for r in runs)
    bad = sum(int(r["rows_quarantined"]) for r in runs)
    result = {
        "checked_rows": checked, "quarantined_rows": bad, "merged_rows": touched.rows, "touched_partitions": touched,
        "touched_days": days, "runs": [r["_ingestion_run_id"] for r in runs],
    }
    try:
        gate.admit(checked, bad, table)
    except GateClosed:
        runlog.record(lake, dag_id, task, started, now(), runs, "gate_failed")
        raise
    runlog.record(lake, dag_id, task, started, now(), runs, "ok")
    return result
