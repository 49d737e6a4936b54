"""The hourly weather chain: land new documents -> silver -> gold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stratum.plans.derived import catch_up
from stratum.plans.health import run_pipeline_health
from stratum.plans.weather import run_silver_weather
from stratum.sources.weather_json import read_weather_json


def run_weather_hourly(lake, landing_path: str | None = None, run_id: str | None = None,
                       run_ts: dt.datetime | None = None, as_of: str | None = None) -> dict:
    """Land ``landing_path`` (when given) as one bronze run, promote unseen
    runs to silver, then bring the daily mart and the fact up to date for every
    day that is owed, also from earlier runs that the gate or a crash stopped.
    The health mart is refreshed either way, so a failed run shows in it."""
    now = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    landed = 0
    if landing_path:
        rid = run_id or f"weather-{now:%Y%m%d%H%M%S}"
        landed = lake.append(read_weather_json(lake.spark, landing_path, run_id=F.lit(rid), ingested_at=F.lit(now)),
                             "bronze.weather_raw")
    try:
        silver = run_silver_weather(lake, now, as_of=as_of)
    except BaseException:
        run_pipeline_health(lake, since=now.date())
        raise
    gold = catch_up(lake)
    return {**silver, **gold, "landed_rows": landed, "health_partitions": run_pipeline_health(lake, since=now.date())}
