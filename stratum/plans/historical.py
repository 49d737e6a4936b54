"""Station daily history: bronze -> silver builders and the silver run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.dedup import latest_ingested
from stratum.operators.quality import Gate, RuleSet
from stratum.operators.shaping import shape_station_daily

# Merge key, gate threshold, rules.
STATION_KEYS = ["station_id", "obs_date", "element"]
STATION_GATE_THRESHOLD = 0.02
# Buckets of stations in a year of silver; a table filled with one number keeps it.
STATION_BUCKETS = 16
STATION_RULES = RuleSet([
    ("not_null_station_id", "station_id IS NOT NULL"),
    ("not_null_obs_date", "obs_date IS NOT NULL"),
    ("not_null_value", "value IS NOT NULL"),
    ("temp_in_range", "element NOT IN ('TMAX', 'TMIN') OR value BETWEEN -90 AND 60"),
    ("precip_non_negative", "element != 'PRCP' OR value >= 0"),
])


def with_station_bucket(rows: DataFrame) -> DataFrame:
    """``station_bucket``: a part of the year's rows that is a function of the key, so
    an upsert of some stations rewrites their buckets and not whole years."""
    return rows.withColumn("station_bucket", F.pmod(F.xxhash64("station_id"), F.lit(STATION_BUCKETS)).cast("int"))


def split_station_daily(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    return STATION_RULES.split(shape_station_daily(bronze))


def silver_station_daily(valid: DataFrame, merged_at: Column) -> DataFrame:
    """Each re-landing of a station's history repeats keys: the newest wins,
    then the greater run id (if carried) and remaining columns."""
    rest = [c for c in valid.columns if c not in (*STATION_KEYS, "_ingested_at", "_ingestion_run_id")]
    ties = [c for c in ("_ingestion_run_id",) if c in valid.columns] + rest
    return latest_ingested(valid, STATION_KEYS, tie_breaks=ties).drop("_ingestion_run_id").withColumn("_merged_at", merged_at)


def run_silver_historical(lake, run_ts: dt.datetime | None = None, only_unseen: bool = True,
                          threshold: float = STATION_GATE_THRESHOLD, dag_id: str = "station_backfill") -> dict:
    """bronze.ghcn_daily_raw -> silver.historical_daily_weather (+ quarantine).

    All stations of the unseen landing runs in one job (no per-station
    concurrent merges); a second backfill of the same history leaves silver
    unchanged.
    """
    from stratum.plans import runlog
    from stratum.plans.promote import now, promote

    started = run_ts or now()
    task = "silver_historical"
    bronze = runlog.unseen("bronze.ghcn_daily_raw", lake, task) if only_unseen else lake.table("bronze.ghcn_daily_raw")
    return promote(
        lake, task=task, dag_id=dag_id, table="silver.historical_daily_weather",
        candidates=shape_station_daily(bronze, carry=["_ingestion_run_id"]), rules=STATION_RULES,
        silver=lambda valid: with_station_bucket(silver_station_daily(valid, F.lit(started).cast("timestamp"))),
        ts_col="obs_date", started=started, gate=Gate(threshold),
    )


def run_station_backfill(lake, path: str, first_day: str | None = None, last_day: str | None = None,
                         stations: list[str] | None = None, run_id: str | None = None,
                         run_ts: dt.datetime | None = None) -> dict:
    """Land station files, scoped to days and stations, and promote them. Stations
    that the files do not hold are refused before anything is written. Cells that
    cannot be used are counted by status in the result and the log."""
    from stratum.plans import runlog
    from stratum.plans.promote import now
    from stratum.sources.scope import check_stations, scope_dates, scope_stations
    from stratum.sources.station_dly import land_station_daily, unpack_station_cells

    started = run_ts or now()
    run = run_id or f"station-{started:%Y%m%d%H%M%S}"
    lines = lake.spark.read.text(path).select("value", F.col("_metadata.file_name").alias("_file"))
    # parsed once, as a table that the check, the counts and the landing read
    with lake.staged(scope_stations(unpack_station_cells(lines), stations)) as cells:
        if stations:
            check_stations(lake.spark, stations, cells)
        by_status = {r["cell_status"]: r["n"] for r in cells.groupBy("cell_status").agg(F.count("*").alias("n")).collect()}
        usable = cells.where("cell_status = 'ok'").drop("cell_status")
        if first_day or last_day:
            usable = scope_dates(usable, first_day, last_day)
        lake.append(land_station_daily(usable, run_id=F.lit(run), ingested_at=F.lit(started).cast("timestamp"),
                                       source_file=F.col("_file")), "bronze.ghcn_daily_raw")
    rejected = by_status.get("bad_value", 0) + by_status.get("bad_date", 0)
    runlog.record(lake, "station_backfill", "land_stations", started, now(), [{
        "_ingestion_run_id": run, "rows_processed": sum(by_status.values()), "rows_quarantined": rejected,
        "max_observation_ts": None}], "ok")
    return {**run_silver_historical(lake, started), "landed_cells": by_status}
