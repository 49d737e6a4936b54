"""Gold marts: daily city climate summary, daily air quality, dominant
category, weather x air-quality by city/day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.columns import exact_avg, exact_sum
from stratum.operators.shaping import contract_columns
from stratum.operators.states import StateSpec, mean, total

DAILY_SUMMARY_COLUMNS = contract_columns("gold.mart_daily_city_climate_summary")
WEATHER_AQ_COLUMNS = contract_columns("gold.mart_weather_air_quality_correlation")

#: What the daily marts need of weather, as mergeable states.
DAILY_WEATHER = StateSpec(
    keys=(("city_id", "city_id"), ("obs_date", "to_date(observation_timestamp)")),
    sums=("temperature_c", "precipitation_mm", "wind_speed_10m_kmh", "relative_humidity_pct"),
    extremes=("temperature_c",),
)


def daily_summary_of_states(states: DataFrame, city_lookup: DataFrame, dominant_category: DataFrame | None = None) -> DataFrame:
    """The daily summary read from states; same columns as :func:`daily_city_summary`."""
    daily = states.select(
        "city_id", "obs_date", "row_count", mean("temperature_c").alias("avg_temp_c"), F.col("min_temperature_c").alias("min_temp_c"),
        F.col("max_temperature_c").alias("max_temp_c"), total("precipitation_mm").alias("total_precip_mm"),
        mean("wind_speed_10m_kmh").alias("avg_wind_speed_kmh"))
    if dominant_category is None:
        daily = daily.withColumn("dominant_aqi_category", F.lit(None).cast("string"))
    else:
        daily = daily.join(dominant_category.select("city_id", "obs_date", "dominant_aqi_category"), ["city_id", "obs_date"], "left")
    return daily.join(city_lookup.select("city_id", "city_name"), "city_id", "left").select(*DAILY_SUMMARY_COLUMNS)


def weather_air_quality_of_states(states: DataFrame, aq_daily: DataFrame, city_lookup: DataFrame) -> DataFrame:
    """Weather from states beside air quality, where both exist."""
    weather = states.select("city_id", "obs_date", mean("temperature_c").alias("avg_temp_c"), mean("relative_humidity_pct").alias("avg_humidity_pct"))
    return weather.join(aq_daily, ["city_id", "obs_date"]).join(city_lookup.select("city_id", "city_name"), "city_id", "left").select(*WEATHER_AQ_COLUMNS)


def daily_city_summary(
    silver: DataFrame,
    city_lookup: DataFrame,
    dominant_category: DataFrame | None = None,
    sum_scale: int | None = None,
) -> DataFrame:
    """One row per (city_id, UTC day): mean/min/max temperature, summed
    precipitation over every poll of the day, mean wind, row count.

    Aggregation happens before the name lookup (the aggregate is far smaller
    than silver), and is partial + final so a hot city is combined map-side.
    ``dominant_category`` (city_id, obs_date, dominant_aqi_category) fills the
    AQI column when air quality is available; otherwise it stays NULL.
    """
    daily = (
        silver.withColumn("obs_date", F.to_date("observation_timestamp"))
        .groupBy("city_id", "obs_date")
        .agg(
            exact_avg("temperature_c", sum_scale).alias("avg_temp_c"),
            F.min("temperature_c").alias("min_temp_c"),
            F.max("temperature_c").alias("max_temp_c"),
            exact_sum("precipitation_mm", sum_scale).alias("total_precip_mm"),
            exact_avg("wind_speed_10m_kmh", sum_scale).alias("avg_wind_speed_kmh"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )
    if dominant_category is None:
        daily = daily.withColumn("dominant_aqi_category", F.lit(None).cast("string"))
    else:
        daily = daily.join(
            dominant_category.select("city_id", "obs_date", "dominant_aqi_category"),
            on=["city_id", "obs_date"],
            how="left",
        )
    return daily.join(city_lookup.select("city_id", "city_name"), on="city_id", how="left").select(
        *DAILY_SUMMARY_COLUMNS
    )


def daily_air_quality(readings: DataFrame, sum_scale: int | None = None) -> DataFrame:
    """Per (city_id, UTC day): mean PM2.5 and mean AQI over the day's readings."""
    pm25 = F.when(F.col("parameter_name") == "pm25", F.col("value"))
    return (
        readings.withColumn("obs_date", F.to_date("observation_timestamp"))
        .groupBy("city_id", "obs_date")
        .agg(
            exact_avg(pm25, sum_scale).alias("avg_pm25"),
            exact_avg(F.col("aqi").cast("double"), sum_scale).alias("avg_aqi"),
        )
    )


def dominant_category(readings: DataFrame) -> DataFrame:
    """Most frequent AQI category per (city_id, UTC day); ties go to the most
    severe category. Two map-side-combined aggregations, no sorting of
    whole groups."""
    counts = (
        readings.filter(F.col("aqi_category").isNotNull())
        .withColumn("obs_date", F.to_date("observation_timestamp"))
        .groupBy("city_id", "obs_date", "aqi_category", "aqi_severity")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("city_id", "obs_date").agg(
        F.max(F.struct("n", "aqi_severity", "aqi_category")).alias("m")
    ).select("city_id", "obs_date", F.col("m.aqi_category").alias("dominant_aqi_category"))


def weather_air_quality(
    silver_weather: DataFrame, aq_daily: DataFrame, city_lookup: DataFrame, sum_scale: int | None = None
) -> DataFrame:
    """Weather (mean temperature, humidity) and air quality (mean PM2.5,
    AQI) side by side per city and day where both exist."""
    weather = (
        silver_weather.withColumn("obs_date", F.to_date("observation_timestamp"))
        .groupBy("city_id", "obs_date")
        .agg(
            exact_avg("temperature_c", sum_scale).alias("avg_temp_c"),
            exact_avg("relative_humidity_pct", sum_scale).alias("avg_humidity_pct"),
        )
    )
    return (
        weather.join(aq_daily, on=["city_id", "obs_date"], how="inner")
        .join(city_lookup.select("city_id", "city_name"), on="city_id", how="left")
        .select("city_id", "city_name", "obs_date", "avg_temp_c", "avg_humidity_pct", "avg_pm25", "avg_aqi")
    )
