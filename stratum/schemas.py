"""Table contracts: columns, types and partitioning of every layer.

Differences from a row-level-DML store, by design: without MERGE the unit
of rewrite is a partition, so tables whose upserts would otherwise rewrite
everything get a date partition derived from their key (silver weather and
air quality gain ``obs_date``, the station history a hash bucket of the
station beside its year). ``ops.run_log`` records each run and feeds
the pipeline-health mart; ``ops.day_log`` records which days gold owes;
``ops.landing_log`` is the register of landings; ``ops.key_mark`` keeps the
highest surrogate key of each fact. ``gold.daily_weather_state`` holds mergeable
states of the daily marts; ``silver.location_city`` is the kept index of
locations, ``ops.indexed_city`` the cities that it was made of.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: str  # DDL column list
    partition_by: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()


_AUDIT = "_source STRING, _ingested_at TIMESTAMP, _ingestion_run_id STRING, _ingest_date DATE"

# The tables' columns, partitions and keys.
TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in [
        TableSpec(
            "bronze.weather_raw",
            f"""{_AUDIT}, city_id BIGINT, raw_json STRING, latitude DOUBLE, longitude DOUBLE,
            elevation DOUBLE, observation_time TIMESTAMP, temperature_2m DOUBLE,
            apparent_temperature DOUBLE, relative_humidity_2m DOUBLE, precipitation DOUBLE,
            rain DOUBLE, showers DOUBLE, snowfall DOUBLE, weather_code INT, cloud_cover DOUBLE,
            pressure_msl DOUBLE, surface_pressure DOUBLE, wind_speed_10m DOUBLE,
            wind_direction_10m DOUBLE, wind_gusts_10m DOUBLE, is_day BOOLEAN""",
            ("_ingest_date",),
        ),
        TableSpec(
            "bronze.city_reference_raw",
            f"""{_AUDIT}, geonameid BIGINT, name STRING, asciiname STRING, alternatenames STRING,
            latitude DOUBLE, longitude DOUBLE, feature_class STRING, feature_code STRING,
            country_code STRING, cc2 STRING, admin1_code STRING, admin2_code STRING,
            admin3_code STRING, admin4_code STRING, population BIGINT, elevation INT, dem INT,
            timezone STRING, source_modified_date DATE""",
            ("_ingest_date",),
        ),
        TableSpec(
            "bronze.air_quality_raw",
            f"""{_AUDIT}, location_id BIGINT, sensor_id BIGINT, raw_json STRING,
            parameter_name STRING, parameter_units STRING, value DOUBLE,
            period_datetime_from TIMESTAMP, period_datetime_to TIMESTAMP,
            location_latitude DOUBLE, location_longitude DOUBLE""",
            ("_ingest_date",),
        ),
        TableSpec(
            "bronze.ghcn_daily_raw",
            """_source STRING, _ingested_at TIMESTAMP, _ingestion_run_id STRING,
            _source_file STRING, _ingest_date DATE, station_id STRING, obs_date DATE,
            element STRING, data_value INT, mflag STRING, qflag STRING, sflag STRING,
            obs_time STRING""",
            ("_ingest_date",),
        ),
        TableSpec(
            "silver.weather_observations",
            """city_id BIGINT, observation_timestamp TIMESTAMP, temperature_c DOUBLE,
            apparent_temperature_c DOUBLE, relative_humidity_pct DOUBLE,
            precipitation_mm DOUBLE, rain_mm DOUBLE, showers_mm DOUBLE, snowfall_cm DOUBLE,
            weather_code INT, cloud_cover_pct DOUBLE, pressure_msl_hpa DOUBLE,
            surface_pressure_hpa DOUBLE, wind_speed_10m_kmh DOUBLE,
            wind_direction_10m_deg DOUBLE, wind_gusts_10m_kmh DOUBLE, is_day BOOLEAN,
            _source STRING, _ingested_at TIMESTAMP, _merged_at TIMESTAMP, obs_date DATE""",
            ("_source", "obs_date"),
            ("city_id", "observation_timestamp", "_source"),
        ),
        TableSpec(
            "silver.air_quality_readings",
            """location_id BIGINT, city_id BIGINT, parameter_name STRING,
            parameter_units STRING, value DOUBLE, observation_timestamp TIMESTAMP,
            _source STRING, _ingested_at TIMESTAMP, _merged_at TIMESTAMP, obs_date DATE""",
            ("_source", "obs_date"),
            ("location_id", "parameter_name", "observation_timestamp", "_source"),
        ),
        TableSpec(
            "silver.historical_daily_weather",
            """station_id STRING, obs_date DATE, obs_year INT, element STRING, value DOUBLE,
            mflag STRING, qflag STRING, sflag STRING, _source STRING, _ingested_at TIMESTAMP,
            _merged_at TIMESTAMP, station_bucket INT""",
            ("obs_year", "station_bucket"),
            ("station_id", "obs_date", "element"),
        ),
        TableSpec(
            "silver.dim_city",
            """city_sk BIGINT, city_id BIGINT, city_name STRING, asciiname STRING,
            country_code STRING, admin1_code STRING, latitude DOUBLE, longitude DOUBLE,
            population BIGINT, elevation_m INT, timezone STRING,
            effective_start_ts TIMESTAMP, effective_end_ts TIMESTAMP, is_current BOOLEAN""",
        ),
        TableSpec(
            "silver.dq_quarantine",
            """source_table STRING, natural_key STRING, failure_reason STRING,
            raw_record STRING, _ingestion_run_id STRING, quarantined_at TIMESTAMP""",
            ("source_table",),
        ),
        TableSpec(
            "gold.dim_date",
            """date_sk INT, full_date DATE, year INT, quarter INT, month INT,
            month_name STRING, day INT, day_of_week INT, day_name STRING, is_weekend BOOLEAN""",
            (),
            ("date_sk",),
        ),
        TableSpec(
            "gold.fact_weather_observation",
            """weather_observation_sk BIGINT, city_id BIGINT, date_sk INT,
            observation_timestamp TIMESTAMP, temperature_c DOUBLE, apparent_temperature_c DOUBLE,
            relative_humidity_pct DOUBLE, precipitation_mm DOUBLE, wind_speed_10m_kmh DOUBLE,
            weather_code INT, _source STRING""",
            ("date_sk",),
            ("city_id", "observation_timestamp", "_source"),
        ),
        TableSpec(
            "gold.fact_air_quality_reading",
            """air_quality_reading_sk BIGINT, city_id BIGINT, location_id BIGINT, date_sk INT,
            observation_timestamp TIMESTAMP, parameter_name STRING, parameter_units STRING,
            value DOUBLE, _source STRING""",
            ("date_sk",),
            ("location_id", "parameter_name", "observation_timestamp", "_source"),
        ),
        TableSpec(
            "gold.mart_daily_city_climate_summary",
            """city_id BIGINT, city_name STRING, obs_date DATE, avg_temp_c DOUBLE,
            min_temp_c DOUBLE, max_temp_c DOUBLE, total_precip_mm DOUBLE,
            avg_wind_speed_kmh DOUBLE, dominant_aqi_category STRING, row_count BIGINT""",
            ("obs_date",),
            ("city_id", "obs_date"),
        ),
        TableSpec(
            "gold.mart_weather_air_quality_correlation",
            """city_id BIGINT, city_name STRING, obs_date DATE, avg_temp_c DOUBLE,
            avg_humidity_pct DOUBLE, avg_pm25 DOUBLE, avg_aqi DOUBLE""",
            ("obs_date",),
            ("city_id", "obs_date"),
        ),
        TableSpec(
            "gold.mart_pipeline_health",
            """dag_id STRING, run_id STRING, run_date DATE, rows_processed BIGINT,
            rows_quarantined BIGINT, run_duration_sec DOUBLE, freshness_lag_minutes DOUBLE""",
            ("run_date",),
            ("dag_id", "run_id"),
        ),
        TableSpec(
            "ops.run_log",
            """dag_id STRING, run_id STRING, task_id STRING, run_date DATE,
            started_at TIMESTAMP, ended_at TIMESTAMP, rows_processed BIGINT,
            rows_quarantined BIGINT, max_observation_ts TIMESTAMP, status STRING""",
            ("run_date",),
        ),
        TableSpec(
            "gold.daily_weather_state",
            """city_id BIGINT, obs_date DATE, row_count BIGINT, n_temperature_c BIGINT,
            sum_temperature_c DECIMAL(38,10), n_precipitation_mm BIGINT,
            sum_precipitation_mm DECIMAL(38,10), n_wind_speed_10m_kmh BIGINT,
            sum_wind_speed_10m_kmh DECIMAL(38,10), n_relative_humidity_pct BIGINT,
            sum_relative_humidity_pct DECIMAL(38,10), min_temperature_c DOUBLE,
            max_temperature_c DOUBLE""",
            ("obs_date",),
            ("city_id", "obs_date"),
        ),
        TableSpec(
            "ops.landing_log",
            "run_id STRING, ingest_date DATE, row_count BIGINT, landed_at TIMESTAMP, source_table STRING",
            ("source_table",),
        ),
        TableSpec("ops.key_mark", "table_name STRING, high BIGINT, marked_at TIMESTAMP"),
        TableSpec(
            "silver.location_city",
            """location_id BIGINT, location_latitude DOUBLE, location_longitude DOUBLE,
            city_id BIGINT, distance_km DOUBLE""",
        ),
        TableSpec("ops.indexed_city", "city_id BIGINT, latitude DOUBLE, longitude DOUBLE"),
        TableSpec("ops.day_log", "consumer STRING, obs_date DATE, event STRING, logged_at TIMESTAMP"),
    ]
}

# The current-rows view over the SCD2 dimension.
DIM_CITY_CURRENT_VIEW = "gold.dim_city_current"
DIM_CITY_CURRENT_COLUMNS = [
    "city_sk", "city_id", "city_name", "asciiname", "country_code", "admin1_code",
    "latitude", "longitude", "population", "elevation_m", "timezone",
]
