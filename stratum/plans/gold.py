"""Gold runs: states, marts and facts of the days a silver run touched."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.facts import AIR_QUALITY_FACT, WEATHER_FACT, FactSpec, build_fact, upsert_fact_dense
from stratum.operators.keys import max_key
from stratum.operators.marts import DAILY_WEATHER, daily_air_quality, daily_summary_of_states, dominant_category, weather_air_quality_of_states
from stratum.operators.states import advanced, states_of
from stratum.plans import runlog
from stratum.plans.promote import now
from stratum.sources.tables import partition_filter


def on_days(df: DataFrame, days: Sequence[dt.date] | None) -> DataFrame:
    """Rows of the days (partition-pruned); None: all of history, []: nothing."""
    return df if days is None else df.where(F.col("obs_date").isin(list(days)))


def touched_days(touched_partitions: Sequence[tuple]) -> list:
    """obs_date values from silver's (_source, obs_date) partitions."""
    return sorted({p[1] for p in touched_partitions if p[1] is not None})


def rated_readings(lake, days: Sequence[dt.date] | None, breakpoint_table: DataFrame | None = None) -> DataFrame:
    """Air-quality readings of the days with index and category."""
    from stratum.operators.aqi import breakpoints, with_aqi

    table = breakpoint_table if breakpoint_table is not None else breakpoints(lake.spark)
    return with_aqi(on_days(lake.table("silver.air_quality_readings"), days), table)


def rebuild_states(lake, days: Sequence[dt.date] | None = None) -> int:
    """Aggregate the days' states anew from silver."""
    began = now()
    fresh = states_of(on_days(lake.table("silver.weather_observations"), days), DAILY_WEATHER)
    with lake.staged(fresh) as staged:
        lake.overwrite_partitions(staged, "gold.daily_weather_state")
    runlog.acknowledge(lake, "daily_state", list(days or []), began)
    return len(days or [])


def follow_weather(lake, owed_before: Sequence[dt.date]) -> Callable[[DataFrame, list], None]:
    """Keeps the states of the days that an upsert of silver touches from its feed.
    Days that were owed before (a run broke off) are aggregated anew."""

    def apply(feed: DataFrame, touched: list) -> None:
        days = touched_days(touched)
        broken = sorted(set(days) & set(owed_before))
        whole = sorted(set(days) - set(broken))
        if broken:
            rebuild_states(lake, broken)
        if whole:
            states, silver = (on_days(lake.table(t), whole) for t in ("gold.daily_weather_state", "silver.weather_observations"))
            after = advanced(states, feed.where(F.to_date("observation_timestamp").isin(whole)), silver, DAILY_WEATHER)
            with lake.staged(after) as staged:
                lake.overwrite_partitions(staged, "gold.daily_weather_state")
            runlog.acknowledge(lake, "daily_state", whole, now())

    return apply


def run_daily_mart(lake, days: Sequence[dt.date] | None = None, breakpoint_table: DataFrame | None = None) -> int:
    """Bring ``days`` of the mart up to date from the kept states (None: all of
    history, aggregated anew from silver first). The dominant AQI category comes
    from the same days' readings in the same run, so whichever run comes last
    writes whole rows."""
    began = now()
    if days is None:
        rebuild_states(lake)
    states = on_days(lake.table("gold.daily_weather_state"), days)
    lookup = lake.table("gold.dim_city_current").select("city_id", "city_name")
    dominant = dominant_category(rated_readings(lake, days, breakpoint_table))
    touched = lake.upsert(daily_summary_of_states(states, lookup, dominant), "gold.mart_daily_city_climate_summary")
    runlog.acknowledge(lake, "daily_mart", [p[0] for p in touched] if days is None else list(days), began)
    return len(touched)


def run_weather_aq_mart(lake, days: Sequence[dt.date] | None = None, breakpoint_table: DataFrame | None = None) -> int:
    """Weather x air-quality mart of ``days``, weather from the kept states."""
    began = now()
    rated = rated_readings(lake, days, breakpoint_table)
    lookup = lake.table("gold.dim_city_current").select("city_id", "city_name")
    mart = weather_air_quality_of_states(on_days(lake.table("gold.daily_weather_state"), days), daily_air_quality(rated), lookup)
    touched = lake.upsert(mart, "gold.mart_weather_air_quality_correlation")
    runlog.acknowledge(lake, "weather_aq_mart", [p[0] for p in touched] if days is None else list(days), began)
    return len(touched)


def run_fact(lake, spec: FactSpec, silver_table: str, consumer: str, days: Sequence[dt.date] | None = None) -> int:
    """Facts of ``days``: existing rows keep their surrogate key."""
    began = now()
    silver = on_days(lake.table(silver_table), days)
    source = build_fact(spec, silver, lake.table("gold.dim_city_current")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fact = lake.table(spec.table)
        date_sks = [(r[0],) for r in source.select("date_sk").distinct().collect()]  # one row per day
        if date_sks:
            target = fact.where(partition_filter(["date_sk"], date_sks))
            high = runlog.high_key(lake, spec.table, spec.sk)
            with lake.staged(upsert_fact_dense(target, source, spec.keys, spec.sk, high)) as staged:
                # marked before the write: a run that breaks off leaves a gap, never a key twice
                runlog.mark_key(lake, spec.table, max(high, max_key(staged, spec.sk)))
                lake.overwrite_partitions(staged, spec.table)
    finally:
        source.unpersist()
    runlog.acknowledge(lake, consumer, list(days or []), began)
    return len(date_sks)


def run_weather_fact(lake, days: Sequence[dt.date] | None = None) -> int:
    return run_fact(lake, WEATHER_FACT, "silver.weather_observations", "weather_fact", days)


def run_air_quality_fact(lake, days: Sequence[dt.date] | None = None) -> int:
    return run_fact(lake, AIR_QUALITY_FACT, "silver.air_quality_readings", "air_quality_fact", days)
