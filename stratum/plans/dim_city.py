"""City dimension (SCD2) from landed city snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.dedup import latest_run, one_per_key
from stratum.operators.keys import max_key
from stratum.operators.scd2 import scd2_history
from stratum.operators.shaping import CITY_RENAMES, conform, shape_city_attributes
from stratum.plans import runlog
from stratum.plans.promote import now

# Natural key, tracked attributes, surrogate key column.
CITY_KEY = "city_id"
CITY_TRACKED = ["population", "elevation_m", "timezone"]
CITY_SK = "city_sk"


def city_snapshot(bronze: DataFrame) -> DataFrame:
    """Newest landed snapshot -> one attribute row per city (deterministic
    survivor when a snapshot repeats a city)."""
    return one_per_key(shape_city_attributes(latest_run(bronze)), [CITY_KEY])


def city_snapshots(bronze: DataFrame) -> DataFrame:
    """Every landed snapshot's attribute rows with the time it was landed."""
    shaped = shape_city_attributes(bronze)  # one row a bronze row that has a key
    timed = conform(bronze.where("geonameid IS NOT NULL"), [*shaped.columns, "_ingested_at"], CITY_RENAMES,
                    {"elevation_m": F.coalesce("dem", "elevation")})
    return one_per_key(timed, [CITY_KEY, "_ingested_at"])


def run_dim_city(lake, run_ts: dt.datetime | None = None) -> dict:
    """Apply every snapshot landed since the last run to silver.dim_city, each at
    the time it was landed, late ones in their place.

    The dimension is rewritten only when it changes. Without new landings, or with
    an empty bronze, this is a no-op. Only the new landings are read of bronze.
    """
    started = run_ts or now()
    task = "dim_city"
    bronze = runlog.unseen("bronze.city_reference_raw", lake, task).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        runs = bronze.groupBy("_ingestion_run_id").agg(F.count(F.lit(1)).alias("rows_processed"), F.min("_ingested_at").alias("first_ingested_at")).collect()
        if not runs:  # a row a landing
            return {"changed_or_new_cities": 0}
        dim = lake.table("silver.dim_city")
        after = scd2_history(dim, city_snapshots(bronze), CITY_KEY, CITY_TRACKED, "_ingested_at", CITY_SK, runlog.high_key(lake, "silver.dim_city", CITY_SK))
        # the staged copy stays if the overwrite fails: the dimension can be restored from it
        with lake.staged(after) as staged:
            high = max_key(dim, CITY_SK)
            opened = staged.where(F.col(CITY_SK) > high).count()
            same = opened == 0 and staged.exceptAll(dim).isEmpty()
            if not same:
                runlog.mark_key(lake, "silver.dim_city", max(high, max_key(staged, CITY_SK)))
                lake.overwrite_partitions(staged, "silver.dim_city")
        runlog.record(lake, "city_dimension", task, started, now(), [
            {**r.asDict(), "rows_quarantined": 0, "max_observation_ts": None} for r in runs], "ok")
    finally:
        bronze.unpersist()
    return {"changed_or_new_cities": opened}


def run_city_reference(lake, path: str, run_id: str | None = None, run_ts: dt.datetime | None = None) -> dict:
    """Land a city snapshot and apply it to the dimension."""
    from stratum.sources.city_tsv import read_city_tsv

    started = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    landed = read_city_tsv(lake.spark, path, run_id=F.lit(run_id or f"city-{started:%Y%m%d%H%M%S}"),
                           ingested_at=F.lit(started).cast("timestamp"))
    rows = lake.append(landed, "bronze.city_reference_raw")
    return {**run_dim_city(lake, started), "landed_rows": rows}
