"""Air quality: readings -> nearest city -> silver, fact, AQI, marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.dedup import latest_ingested
from stratum.operators.nearest import nearest, refresh
from stratum.operators.quality import Gate, RuleSet

# Silver key and fact columns.
AQ_KEYS = ["location_id", "parameter_name", "observation_timestamp", "_source"]
AQ_SILVER_COLUMNS = [
    "location_id", "city_id", "parameter_name", "parameter_units", "value",
    "observation_timestamp", "_source", "_ingested_at", "_merged_at",
]
AQ_GATE_THRESHOLD = 0.02
#: Readings without a usable key or with an impossible value are quarantined, so
#: none of them collapses into another one's key.
AQ_RULES = RuleSet([
    ("not_null_location_id", "location_id IS NOT NULL"),
    ("not_null_parameter_name", "parameter_name IS NOT NULL"),
    ("not_null_observation_timestamp", "observation_timestamp IS NOT NULL"),
    ("not_null_value", "value IS NOT NULL"),
    ("value_non_negative", "value >= 0"),
])


def aq_candidates(bronze_aq: DataFrame) -> DataFrame:
    """Bronze readings with their observation time: the start of the period."""
    return bronze_aq.withColumn("observation_timestamp", F.col("period_datetime_from"))


def locate(bronze_aq: DataFrame, cities: DataFrame) -> DataFrame:
    """Attach the nearest city to each reading: the search runs once per
    distinct location, then joins back on the location and its coordinates."""
    locs = bronze_aq.select("location_id", "location_latitude", "location_longitude").distinct()
    near = nearest(
        locs, cities,
        point_cols=("location_id", "location_latitude", "location_longitude"),
        ref_cols=("city_id", "latitude", "longitude"),
    )
    near = near.select("location_id", "location_latitude", "location_longitude", "city_id")
    return bronze_aq.join(
        near, on=["location_id", "location_latitude", "location_longitude"], how="left"
    )


def _latest_located(readings: DataFrame, merged_at: Column) -> DataFrame:
    rest = [c for c in ("value", "parameter_units", "city_id") if c in readings.columns]
    return (
        latest_ingested(readings, AQ_KEYS, tie_breaks=["_ingestion_run_id", *rest])
        .withColumn("_merged_at", merged_at)
        .select(*AQ_SILVER_COLUMNS)
    )


def silver_air_quality(bronze_aq: DataFrame, cities: DataFrame, merged_at: Column) -> DataFrame:
    """Observation time = period start; latest ingest wins per
    (location, parameter, time, source)."""
    return _latest_located(locate(aq_candidates(bronze_aq), cities), merged_at)


PLACE = ["location_id", "location_latitude", "location_longitude"]


def refresh_locations(lake, places: DataFrame) -> None:
    """Bring the kept index of locations to ``places`` (added to those it has) and
    the current cities: only new places, and places that a changed city matters
    to, are searched. Nothing is written when neither has changed."""
    cities = lake.table("gold.dim_city_current").select("city_id", "latitude", "longitude")
    index, indexed = lake.table("silver.location_city"), lake.table("ops.indexed_city")
    known = index.select(*PLACE)
    new = places.select(*PLACE).where("location_latitude IS NOT NULL AND location_longitude IS NOT NULL").distinct().join(known, PLACE, "left_anti")
    changed = cities.exceptAll(indexed).unionByName(indexed.exceptAll(cities))
    cities_changed = not changed.isEmpty()
    if not cities_changed and new.isEmpty():
        return
    after = refresh(index, known.unionByName(new), indexed, cities, point_cols=tuple(PLACE), ref_cols=("city_id", "latitude", "longitude"))
    lake.replace(after, "silver.location_city")
    if cities_changed:  # last: a run that breaks off before searches again
        lake.replace(cities, "ops.indexed_city")


def run_silver_air_quality(lake, run_ts=None, only_unseen: bool = True, threshold: float = AQ_GATE_THRESHOLD) -> dict:
    """bronze.air_quality_raw -> silver.air_quality_readings (+ quarantine).

    Unseen landing runs only; cities come from the kept index of locations.
    """
    from stratum.plans import runlog
    from stratum.plans.promote import now, promote

    started = run_ts or now()
    task = "silver_air_quality"
    bronze = runlog.unseen("bronze.air_quality_raw", lake, task) if only_unseen else lake.table("bronze.air_quality_raw")
    refresh_locations(lake, bronze)
    index = lake.table("silver.location_city").select(*PLACE, "city_id")
    result = promote(
        lake, task=task, dag_id="air_quality_hourly", table="silver.air_quality_readings", candidates=aq_candidates(bronze),
        rules=AQ_RULES, silver=lambda valid: _latest_located(valid.join(index, PLACE, "left"), F.lit(started).cast("timestamp")).withColumn(
            "obs_date", F.to_date("observation_timestamp")),
        ts_col="observation_timestamp", started=started, gate=Gate(threshold),
    )
    return {**result, "rows": result["checked_rows"]}


def run_air_quality_marts(lake, days=None, breakpoint_table: DataFrame | None = None) -> int:
    """Weather x air-quality mart for ``days``, and the daily summary with its
    dominant AQI category (both upserted on (city_id, obs_date))."""
    from stratum.plans.gold import run_daily_mart, run_weather_aq_mart

    run_daily_mart(lake, days, breakpoint_table)
    return run_weather_aq_mart(lake, days, breakpoint_table)


def run_air_quality_hourly(lake, landing_path: str | None = None, run_id: str | None = None, run_ts: dt.datetime | None = None,
                           threshold: float = AQ_GATE_THRESHOLD) -> dict:
    """The air-quality chain: land documents (when a path is given) -> silver ->
    every derived table that is owed days -> health, also after a closed gate."""
    from stratum.plans.derived import catch_up
    from stratum.plans.health import run_pipeline_health
    from stratum.plans.promote import now
    from stratum.sources.air_quality_json import read_air_quality_json

    started = run_ts or now()
    landed = 0
    if landing_path:
        landed = lake.append(read_air_quality_json(lake.spark, landing_path, run_id=F.lit(run_id or f"air-quality-{started:%Y%m%d%H%M%S}"),
                                                   ingested_at=F.lit(started)), "bronze.air_quality_raw")
    try:
        silver = run_silver_air_quality(lake, started, threshold=threshold)
    except BaseException:
        run_pipeline_health(lake, since=started.date())
        raise
    return {**silver, **catch_up(lake), "landed_rows": landed, "health_partitions": run_pipeline_health(lake, since=started.date())}
