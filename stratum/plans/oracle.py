"""DuckDB SQL equivalents of the registered queries (same column names).

Each statement re-derives the stand-in inputs from the driver's views with
the same expressions as :mod:`stratum.standins`, then computes the operator
in plain SQL (window, join, group by). Float aggregates use the same
DECIMAL(28,4) sums as the Spark side so both engines agree bit for bit.
"""

from __future__ import annotations

# ---------------------------------------------------------------- weather


def bronze_weather_sql(src: str = "events", bump: str = "0") -> str:
    v = f"(value + {bump})"
    return f"""
  SELECT event_type AS _source,
         ts AS _ingested_at,
         'run-' || strftime(ts, '%Y%m%d%H') AS _ingestion_run_id,
         CAST(ts AS DATE) AS _ingest_date,
         user_id AS city_id,
         props AS raw_json,
         CAST(((user_id * 53) % 181) - 90 AS DOUBLE) AS latitude,
         CAST(((user_id * 17) % 361) - 180 AS DOUBLE) AS longitude,
         CAST(user_id % 500 AS DOUBLE) AS elevation,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS observation_time,
         {v} / 4 - 20 AS temperature_2m,
         {v} / 4 - 22 AS apparent_temperature,
         CAST(event_id % 101 AS DOUBLE) AS relative_humidity_2m,
         {v} / 100 AS precipitation,
         {v} / 200 AS rain,
         0.0::DOUBLE AS showers,
         0.0::DOUBLE AS snowfall,
         CAST(event_id % 100 AS INTEGER) AS weather_code,
         CAST(event_id % 101 AS DOUBLE) AS cloud_cover,
         {v} / 100 + 1000 AS pressure_msl,
         1000.0::DOUBLE AS surface_pressure,
         {v} / 10 AS wind_speed_10m,
         CAST(event_id % 360 AS DOUBLE) AS wind_direction_10m,
         {v} / 5 AS wind_gusts_10m,
         hour(ts) BETWEEN 6 AND 17 AS is_day
  FROM {src}
"""


BRONZE_WEATHER = bronze_weather_sql()

DIM_CITY_V1 = """
  SELECT c_custkey AS city_id,
         CASE WHEN c_nationkey = 5 THEN '"' || c_name ELSE c_name END AS city_name
  FROM customer WHERE c_acctbal >= -900
"""

WEATHER_COLS = """city_id, observation_timestamp, temperature_c, apparent_temperature_c,
  relative_humidity_pct, precipitation_mm, rain_mm, showers_mm, snowfall_cm, weather_code,
  cloud_cover_pct, pressure_msl_hpa, surface_pressure_hpa, wind_speed_10m_kmh,
  wind_direction_10m_deg, wind_gusts_10m_kmh, is_day, _source, _ingested_at"""


def weather_chain(p: str, events_src: str = "events", bump: str = "0",
                  merged_at: str = "2024-02-01 00:00:00") -> str:
    """CTEs {p}_bronze, {p}_shaped, {p}_flagged, {p}_valid, {p}_invalid,
    {p}_silver (needs a ``dim_v1`` CTE). A check fails only when its
    condition is FALSE (NULL passes)."""
    return f"""
{p}_bronze AS ({bronze_weather_sql(events_src, bump)}),
{p}_shaped AS (
  SELECT city_id, observation_time AS observation_timestamp,
         temperature_2m AS temperature_c, apparent_temperature AS apparent_temperature_c,
         relative_humidity_2m AS relative_humidity_pct, precipitation AS precipitation_mm,
         rain AS rain_mm, showers AS showers_mm, snowfall AS snowfall_cm, weather_code,
         cloud_cover AS cloud_cover_pct, pressure_msl AS pressure_msl_hpa,
         surface_pressure AS surface_pressure_hpa, wind_speed_10m AS wind_speed_10m_kmh,
         wind_direction_10m AS wind_direction_10m_deg, wind_gusts_10m AS wind_gusts_10m_kmh,
         is_day, _source, _ingested_at, _ingestion_run_id
  FROM {p}_bronze),
{p}_flagged AS (
  SELECT s.*,
    CONCAT_WS('; ',
      CASE WHEN (s.city_id IS NOT NULL) IS FALSE THEN 'not_null_city_id' END,
      CASE WHEN (s.observation_timestamp IS NOT NULL) IS FALSE THEN 'not_null_observation_timestamp' END,
      CASE WHEN (s.temperature_c IS NULL OR s.temperature_c BETWEEN -90 AND 60) IS FALSE THEN 'temperature_in_range' END,
      CASE WHEN (s.observation_timestamp IS NULL OR s.observation_timestamp >= s._ingested_at - INTERVAL 48 HOURS) IS FALSE THEN 'freshness_48h' END,
      CASE WHEN (d.city_id IS NOT NULL) IS FALSE THEN 'city_exists_in_dim_city' END
    ) AS failure_reason
  FROM {p}_shaped s LEFT JOIN (SELECT DISTINCT city_id FROM dim_v1) d ON s.city_id = d.city_id),
{p}_valid AS (SELECT * EXCLUDE (failure_reason) FROM {p}_flagged WHERE failure_reason = ''),
{p}_invalid AS (SELECT * FROM {p}_flagged WHERE failure_reason <> ''),
{p}_silver AS (
  SELECT {WEATHER_COLS}, TIMESTAMP '{merged_at}' AS _merged_at
  FROM (SELECT *, row_number() OVER (
          PARTITION BY city_id, observation_timestamp, _source
          ORDER BY _ingested_at DESC NULLS LAST, _ingestion_run_id DESC NULLS LAST) AS rn
        FROM {p}_valid)
  WHERE rn = 1)"""


WEATHER_CTES = f"WITH dim_v1 AS ({DIM_CITY_V1}),{weather_chain('w')}\n"

UPSERT_CTES = f"""WITH dim_v1 AS ({DIM_CITY_V1}),
{weather_chain('t', "(SELECT * FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20')", '0', '2024-01-21 00:00:00')},
{weather_chain('s', "(SELECT * FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-15')", '1.0', '2024-02-01 00:00:00')}
"""


def _avg(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(28,4))) AS DOUBLE) / COUNT({col})"


def _sum(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(28,4))) AS DOUBLE)"


DAILY_SUMMARY = f"""{WEATHER_CTES},
daily AS (
  SELECT city_id, CAST(observation_timestamp AS DATE) AS obs_date,
         {_avg('temperature_c')} AS avg_temp_c,
         MIN(temperature_c) AS min_temp_c, MAX(temperature_c) AS max_temp_c,
         {_sum('precipitation_mm')} AS total_precip_mm,
         {_avg('wind_speed_10m_kmh')} AS avg_wind_speed_kmh,
         COUNT(*) AS row_count
  FROM w_silver GROUP BY 1, 2)
SELECT d.city_id, c.city_name, d.obs_date, d.avg_temp_c, d.min_temp_c, d.max_temp_c,
       d.total_precip_mm, d.avg_wind_speed_kmh, CAST(NULL AS VARCHAR) AS dominant_aqi_category,
       d.row_count
FROM daily d LEFT JOIN dim_v1 c ON d.city_id = c.city_id
"""

FACT_COLS = """city_id, CAST(year(observation_timestamp) * 10000 + month(observation_timestamp) * 100
  + day(observation_timestamp) AS INTEGER) AS date_sk, observation_timestamp, temperature_c,
  apparent_temperature_c, relative_humidity_pct, precipitation_mm, wind_speed_10m_kmh, weather_code, _source"""

# ---------------------------------------------------------------- stations

ELEMENT_CASE = """CASE event_type WHEN 'click' THEN 'TMAX' WHEN 'view' THEN 'TMIN'
  WHEN 'purchase' THEN 'PRCP' WHEN 'signup' THEN 'SNOW' WHEN 'error' THEN 'SNWD' END"""

STATION_ID = "'ST' || lpad(CAST(user_id AS VARCHAR), 9, '0')"

BRONZE_STATION = f"""
  SELECT 'noaa-ghcn' AS _source, ts AS _ingested_at,
         'run-' || strftime(ts, '%Y%m%d%H') AS _ingestion_run_id,
         {STATION_ID} || '.dly' AS _source_file,
         CAST(ts AS DATE) AS _ingest_date,
         {STATION_ID} AS station_id,
         CAST(ts AS DATE) AS obs_date,
         {ELEMENT_CASE} AS element,
         CAST(CASE WHEN event_type IN ('click', 'view') THEN floor(value * 4) - 300
                   WHEN event_type = 'purchase' THEN floor(value * 10) - 5
                   ELSE floor(value * 10) END AS INTEGER) AS data_value,
         CAST(NULL AS VARCHAR) AS mflag,
         CASE WHEN value > 300 THEN 'X' END AS qflag,
         'S' AS sflag,
         CAST(NULL AS VARCHAR) AS obs_time
  FROM events
"""

SHAPED_STATION = f"""
  SELECT station_id, obs_date, CAST(year(obs_date) AS INTEGER) AS obs_year, element,
         CASE WHEN element IN ('TMAX', 'TMIN', 'PRCP') THEN data_value / 10.0
              ELSE CAST(data_value AS DOUBLE) END AS value,
         mflag, qflag, sflag, _source, _ingested_at
  FROM ({BRONZE_STATION})
"""

UNPACKED_STATION = f"""
  SELECT 'noaa-ghcn' AS _source, TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at,
         'dly-run-1' AS _ingestion_run_id, station_id || '.dly' AS _source_file,
         DATE '2024-02-01' AS _ingest_date, station_id, obs_date, element, data_value,
         CAST(NULL AS VARCHAR) AS mflag, CAST(NULL AS VARCHAR) AS qflag, 'S' AS sflag,
         CAST(NULL AS VARCHAR) AS obs_time
  FROM (SELECT {STATION_ID} AS station_id, CAST(ts AS DATE) AS obs_date, {ELEMENT_CASE} AS element,
               CAST(floor(max(value) * 10) AS INTEGER) AS data_value
        FROM events GROUP BY ALL)
"""

# ---------------------------------------------------------------- cities

CITY_TYPED_COLS = [
    "geonameid", "name", "asciiname", "alternatenames", "latitude", "longitude",
    "feature_class", "feature_code", "country_code", "cc2", "admin1_code",
    "admin2_code", "admin3_code", "admin4_code", "population", "elevation",
    "dem", "timezone", "source_modified_date",
]


def city_typed_sql(version: int, whole: bool = False) -> str:
    """A landed (typed) city snapshot built straight from ``customer``."""
    name = "CASE WHEN c_nationkey = 5 THEN '\"' || c_name ELSE c_name END"
    pop = "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_custkey * 100 + c_nationkey END"
    dem = "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_nationkey * 10 + 3 END"
    tz = "'Zone/' || c_mktsegment"
    keep = "c_acctbal >= -900"
    if version == 2:
        name = f"CASE WHEN c_nationkey = 13 THEN upper({name}) ELSE {name} END"
        pop = f"CASE WHEN c_nationkey = 7 AND c_acctbal >= 0 THEN c_custkey * 100 + c_nationkey + 1 ELSE {pop} END"
        tz = f"CASE WHEN c_nationkey = 11 THEN '' ELSE {tz} END"
        dem = f"CASE WHEN c_nationkey = 17 AND c_mktsegment = 'MACHINERY' THEN c_nationkey * 10 + 4 ELSE {dem} END"
        keep = "c_acctbal >= -950 AND c_acctbal <= 9900"
    if version == 3:
        pop = f"CASE WHEN c_nationkey = 3 AND c_acctbal >= 0 THEN c_custkey * 100 + c_nationkey + 7 ELSE {pop} END"
        tz = f"CASE WHEN c_nationkey = 11 THEN '' ELSE {tz} END"
        keep = "c_acctbal >= -920 AND c_custkey % 5 <> 0"
    run, at = {1: ("city-run-1", "2024-01-01 00:00:00"), 2: ("city-run-2", "2024-01-15 00:00:00"),
               3: ("city-run-3", "2024-01-08 00:00:00")}[version]
    return f"""
  SELECT 'geonames' AS _source, TIMESTAMP '{at}' AS _ingested_at, '{run}' AS _ingestion_run_id,
         CAST(TIMESTAMP '{at}' AS DATE) AS _ingest_date,
         c_custkey AS geonameid, {name} AS name, lower(c_name) AS asciiname, '' AS alternatenames,
         CAST(((c_custkey * 53) % 181) - 90 AS DOUBLE) AS latitude,
         CAST(((c_custkey * 17) % 361) - 180 AS DOUBLE) AS longitude,
         'P' AS feature_class, 'PPL' AS feature_code,
         'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country_code, '' AS cc2,
         c_mktsegment AS admin1_code, '' AS admin2_code, '' AS admin3_code, '' AS admin4_code,
         CAST({pop} AS BIGINT) AS population, CAST(c_nationkey * 10 AS INTEGER) AS elevation,
         CAST({dem} AS INTEGER) AS dem, {tz} AS timezone,
         CAST('2023-12-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS DATE) AS source_modified_date
  FROM customer WHERE {"true" if whole else keep}
"""


CITY_ATTRS = ["city_id", "city_name", "asciiname", "country_code", "admin1_code",
              "latitude", "longitude", "population", "elevation_m", "timezone"]
TRACKED = ["population", "elevation_m", "timezone"]


def city_shaped_sql(version: int) -> str:
    return f"""
  SELECT geonameid AS city_id, name AS city_name, asciiname, country_code, admin1_code,
         latitude, longitude, population, COALESCE(dem, elevation) AS elevation_m, timezone
  FROM ({city_typed_sql(version)}) WHERE geonameid IS NOT NULL
"""


def _changed(s: str, c: str) -> str:
    return " OR ".join(f"NOT ({s}.{a} IS NOT DISTINCT FROM {c}.{a})" for a in TRACKED)


SCD2_CTES = f"""WITH v1 AS ({city_shaped_sql(1)}), v2 AS ({city_shaped_sql(2)}),
j AS (
  SELECT {', '.join(f'c.{a} AS c_{a}' for a in CITY_ATTRS)},
         {', '.join(f's.{a} AS s_{a}' for a in CITY_ATTRS)},
         c.city_id IS NOT NULL AS has_c, s.city_id IS NOT NULL AS has_s,
         ({_changed('s', 'c')}) AS changed
  FROM v1 c FULL OUTER JOIN v2 s ON c.city_id = s.city_id),
dim AS (
  SELECT {', '.join(f'c_{a} AS {a}' for a in CITY_ATTRS)},
         TIMESTAMP '2024-01-01 00:00:00' AS effective_start_ts,
         CASE WHEN has_s AND changed THEN TIMESTAMP '2024-01-15 00:00:00' END AS effective_end_ts,
         NOT (has_s AND changed) AS is_current
  FROM j WHERE has_c
  UNION ALL
  SELECT {', '.join(f's_{a} AS {a}' for a in CITY_ATTRS)},
         TIMESTAMP '2024-01-15 00:00:00' AS effective_start_ts,
         CAST(NULL AS TIMESTAMP) AS effective_end_ts, TRUE AS is_current
  FROM j WHERE has_s AND (NOT has_c OR changed))
"""

# ---------------------------------------------------------------- json

LANDED_JSON = """
  SELECT event_type AS _source, ts AS _ingested_at, 'json-run-1' AS _ingestion_run_id,
         CAST(ts AS DATE) AS _ingest_date, user_id AS city_id,
         CAST(((user_id * 53) % 181) - 90 AS DOUBLE) AS latitude,
         CAST(((user_id * 17) % 361) - 180 AS DOUBLE) AS longitude,
         CAST(user_id % 500 AS DOUBLE) AS elevation,
         date_trunc('minute', ts) AS observation_time,
         value / 4 - 20 AS temperature_2m, value / 4 - 22 AS apparent_temperature,
         CAST(event_id % 101 AS DOUBLE) AS relative_humidity_2m,
         value / 100 AS precipitation, value / 200 AS rain,
         0.0::DOUBLE AS showers, 0.0::DOUBLE AS snowfall,
         CAST(event_id % 100 AS INTEGER) AS weather_code,
         CAST(event_id % 101 AS DOUBLE) AS cloud_cover,
         value / 100 + 1000 AS pressure_msl, 1000.0::DOUBLE AS surface_pressure,
         value / 10 AS wind_speed_10m, CAST(event_id % 360 AS DOUBLE) AS wind_direction_10m,
         value / 5 AS wind_gusts_10m, hour(ts) BETWEEN 6 AND 17 AS is_day
  FROM events
"""

ORACLE: dict[str, str] = {
    "land_weather_json": LANDED_JSON,
    "land_city_tsv": city_typed_sql(1, whole=True),
    "unpack_station_month": UNPACKED_STATION,
    "scope_date_range": f"SELECT * FROM ({BRONZE_STATION}) WHERE obs_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
    "shape_units": SHAPED_STATION,
    "dq_split_valid": f"{WEATHER_CTES} SELECT * FROM w_valid",
    "dq_split_invalid": f"{WEATHER_CTES} SELECT * FROM w_invalid",
    "quarantine_records": f"""{WEATHER_CTES}
      SELECT 'silver.weather_observations' AS source_table,
             CONCAT_WS('|', CAST(city_id AS VARCHAR), CAST(observation_timestamp AS VARCHAR), _source) AS natural_key,
             failure_reason, _ingestion_run_id,
             TIMESTAMP '2024-02-01 00:05:00' AS quarantined_at
      FROM w_invalid""",
    "dq_gate_rate": f"""{WEATHER_CTES}
      SELECT COUNT(*) AS checked_rows,
             COUNT(*) FILTER (WHERE failure_reason <> '') AS quarantined_rows,
             CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) FILTER (WHERE failure_reason <> '') AS DOUBLE) / COUNT(*) ELSE 0.0 END AS quarantine_rate,
             (CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) FILTER (WHERE failure_reason <> '') AS DOUBLE) / COUNT(*) ELSE 0.0 END) <= 0.02 AS gate_passed
      FROM w_flagged""",
    "dedup_latest": f"{WEATHER_CTES} SELECT * FROM w_silver",
    "daily_summary": DAILY_SUMMARY,
    "upsert_silver": f"""{UPSERT_CTES}
      SELECT * FROM t_silver t WHERE NOT EXISTS (
        SELECT 1 FROM s_silver s WHERE s.city_id = t.city_id
          AND s.observation_timestamp = t.observation_timestamp AND s._source = t._source)
      UNION ALL SELECT * FROM s_silver""",
    "fact_build": f"""{WEATHER_CTES}
      SELECT {FACT_COLS} FROM w_silver WHERE city_id IN (SELECT city_id FROM dim_v1)""",
    "fact_upsert": f"""{UPSERT_CTES},
      tf AS (SELECT {FACT_COLS} FROM t_silver WHERE city_id IN (SELECT city_id FROM dim_v1)),
      sf AS (SELECT {FACT_COLS} FROM s_silver WHERE city_id IN (SELECT city_id FROM dim_v1))
      SELECT *, true AS kept_key FROM tf WHERE NOT EXISTS (
        SELECT 1 FROM sf WHERE sf.city_id = tf.city_id
          AND sf.observation_timestamp = tf.observation_timestamp AND sf._source = tf._source)
      UNION ALL SELECT *, EXISTS (
        SELECT 1 FROM tf WHERE sf.city_id = tf.city_id
          AND sf.observation_timestamp = tf.observation_timestamp AND sf._source = tf._source) FROM sf""",
    "latest_snapshot": city_typed_sql(2),
    "scd2_changes": f"""WITH v1 AS ({city_shaped_sql(1)}), v2 AS ({city_shaped_sql(2)})
      SELECT s.* FROM v2 s LEFT JOIN v1 c ON s.city_id = c.city_id
      WHERE c.city_id IS NULL OR ({_changed('s', 'c')})""",
    "scd2_apply": f"{SCD2_CTES} SELECT * FROM dim",
    "dim_city_current": f"{SCD2_CTES} SELECT {', '.join(CITY_ATTRS)} FROM dim WHERE is_current",
    "newest_k": f"""SELECT _ingested_at, city_id, _source, temperature_2m
      FROM ({BRONZE_WEATHER}) ORDER BY _ingested_at DESC LIMIT 10""",
    "history_first_k": f"{SCD2_CTES} SELECT * FROM dim ORDER BY city_id, effective_start_ts LIMIT 20",
    "mart_sorted": DAILY_SUMMARY,
}

# ---------------------------------------------------------------- stations (silver)

STATION_FLAGGED = f"""
  SELECT *, CONCAT_WS('; ',
      CASE WHEN (station_id IS NOT NULL) IS FALSE THEN 'not_null_station_id' END,
      CASE WHEN (obs_date IS NOT NULL) IS FALSE THEN 'not_null_obs_date' END,
      CASE WHEN (value IS NOT NULL) IS FALSE THEN 'not_null_value' END,
      CASE WHEN (element NOT IN ('TMAX', 'TMIN') OR value BETWEEN -90 AND 60) IS FALSE THEN 'temp_in_range' END,
      CASE WHEN (element != 'PRCP' OR value >= 0) IS FALSE THEN 'precip_non_negative' END
    ) AS failure_reason
  FROM ({SHAPED_STATION})
"""

STATION_DEDUP = f"""
  SELECT * EXCLUDE (rn, failure_reason), TIMESTAMP '2024-02-01 00:00:00' AS _merged_at
  FROM (SELECT *, row_number() OVER (PARTITION BY station_id, obs_date, element
                                     ORDER BY _ingested_at DESC NULLS LAST) AS rn
        FROM ({STATION_FLAGGED}) WHERE failure_reason = '')
  WHERE rn = 1
"""

DIM_DATE = """
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_sk, d AS full_date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
         dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
  FROM (SELECT CAST(gs AS DATE) AS d
        FROM (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events) b,
             generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) t(gs))
"""

# ---------------------------------------------------------------- air quality


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371.0 * asin(least(1.0, sqrt(power(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * power(sin((radians({lon2}) - radians({lon1})) / 2), 2))))"
    )


CITIES_XY = """
  SELECT c_custkey AS city_id, CAST(((c_custkey * 53) % 181) - 90 AS DOUBLE) AS latitude,
         CAST(((c_custkey * 17) % 361) - 180 AS DOUBLE) AS longitude
  FROM customer
"""


CITIES_XY_V2 = """
  SELECT c_custkey AS city_id, CAST(((k * 53) % 181) - 90 AS DOUBLE) AS latitude, CAST(((k * 17) % 361) - 180 AS DOUBLE) AS longitude
  FROM (SELECT *, CASE WHEN c_nationkey = 7 THEN c_custkey + 31 ELSE c_custkey END AS k FROM customer
        WHERE c_acctbal >= -950 AND c_acctbal <= 9900)
"""


def nearest_sql(locs: str, cities: str = CITIES_XY) -> str:
    """Brute force over all (location, city) pairs: rank by rounded distance, id."""
    return f"""
  SELECT location_id, latitude, longitude, city_id FROM (
    SELECT l.location_id, l.latitude, l.longitude, c.city_id,
           row_number() OVER (PARTITION BY l.location_id, l.latitude, l.longitude
                              ORDER BY round({_hav('l.latitude', 'l.longitude', 'c.latitude', 'c.longitude')}, 6),
                                       c.city_id) AS rn
    FROM ({locs}) l CROSS JOIN ({cities}) c)
  WHERE rn = 1
"""


SUPPLIER_LOCS = """
  SELECT s_suppkey AS location_id, CAST(((s_suppkey * 37) % 181) - 90 AS DOUBLE) AS latitude,
         CAST(((s_suppkey * 91) % 361) - 180 AS DOUBLE) AS longitude
  FROM supplier
"""

PARAM_CASE = """CASE event_type WHEN 'click' THEN 'pm25' WHEN 'view' THEN 'pm10'
  WHEN 'purchase' THEN 'o3' WHEN 'signup' THEN 'no2' WHEN 'error' THEN 'so2' END"""
UNITS_CASE = """CASE event_type WHEN 'click' THEN 'µg/m³' WHEN 'view' THEN 'µg/m³'
  WHEN 'purchase' THEN 'ppm' WHEN 'signup' THEN 'ppb' WHEN 'error' THEN 'ppb' END"""
SENSOR_CASE = """CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2
  WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END"""

BRONZE_AQ = f"""
  SELECT 'openaq' AS _source, ts AS _ingested_at, 'aq-' || strftime(ts, '%Y%m%d%H') AS _ingestion_run_id,
         CAST(ts AS DATE) AS _ingest_date, user_id AS location_id,
         user_id * 10 + {SENSOR_CASE} AS sensor_id,
         {PARAM_CASE} AS parameter_name, {UNITS_CASE} AS parameter_units,
         CASE WHEN event_type = 'purchase' THEN value / 1000 ELSE value END AS value,
         date_trunc('hour', ts) AS period_datetime_from,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS period_datetime_to,
         CAST(((user_id * 37) % 181) - 90 AS DOUBLE) AS location_latitude,
         CAST(((user_id * 91) % 361) - 180 AS DOUBLE) AS location_longitude
  FROM events
"""

AQ_CTES = f"""WITH dim_v1 AS ({DIM_CITY_V1}),
aq_bronze AS ({BRONZE_AQ}),
aq_near AS ({nearest_sql("SELECT DISTINCT location_id, location_latitude AS latitude, location_longitude AS longitude FROM aq_bronze")}),
aq_silver AS (
  SELECT location_id, city_id, parameter_name, parameter_units, value, observation_timestamp,
         _source, _ingested_at, TIMESTAMP '2024-02-01 00:00:00' AS _merged_at
  FROM (SELECT b.*, n.city_id, b.period_datetime_from AS observation_timestamp,
               row_number() OVER (PARTITION BY b.location_id, b.parameter_name, b.period_datetime_from, b._source
                                  ORDER BY b._ingested_at DESC NULLS LAST, b._ingestion_run_id DESC NULLS LAST) AS rn
        FROM aq_bronze b LEFT JOIN aq_near n
          ON b.location_id = n.location_id AND b.location_latitude = n.latitude
         AND b.location_longitude = n.longitude)
  WHERE rn = 1),
bp AS (SELECT * FROM (VALUES {{BREAKPOINT_VALUES}})
       t(parameter_name, decimals, c_low, c_high, i_low, i_high, category, severity)),
bl AS (SELECT *, c_low = max(c_low) OVER (PARTITION BY parameter_name) AS is_last FROM bp),
aq_aqi AS (
  SELECT s.*, CAST(round((bp.i_high - bp.i_low) / (bp.c_high - bp.c_low)
                * (least(floor(s.value * power(10.0, bp.decimals)) / power(10.0, bp.decimals), bp.c_high) - bp.c_low)
                + bp.i_low) AS INTEGER) AS aqi,
         bp.category AS aqi_category, bp.severity AS aqi_severity
  FROM aq_silver s LEFT JOIN bl bp ON s.parameter_name = bp.parameter_name
   AND floor(s.value * power(10.0, bp.decimals)) / power(10.0, bp.decimals) >= bp.c_low
   AND (floor(s.value * power(10.0, bp.decimals)) / power(10.0, bp.decimals) <= bp.c_high OR bp.is_last)),
aq_dominant AS (
  SELECT city_id, obs_date, aqi_category AS dominant_aqi_category FROM (
    SELECT *, row_number() OVER (PARTITION BY city_id, obs_date
                                 ORDER BY n DESC, aqi_severity DESC, aqi_category DESC) AS rn
    FROM (SELECT city_id, CAST(observation_timestamp AS DATE) AS obs_date, aqi_category, aqi_severity,
                 COUNT(*) AS n
          FROM aq_aqi WHERE aqi_category IS NOT NULL GROUP BY ALL))
  WHERE rn = 1)
"""


def _breakpoint_values() -> str:
    from stratum.operators.aqi import EPA_BREAKPOINTS

    return ", ".join(
        f"('{p}', {d}, CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE), {il}, {ih}, '{c}', {s})"
        for p, d, lo, hi, il, ih, c, s in EPA_BREAKPOINTS
    )


AQ_CTES = AQ_CTES.replace("{BREAKPOINT_VALUES}", _breakpoint_values())

RUN_LOG = """
  SELECT o_orderpriority AS dag_id, o_orderstatus || '-' || strftime(o_orderdate, '%Y%m') AS run_id,
         o_orderdate + to_seconds(o_orderkey % 86400) AS started_at,
         o_orderdate + to_seconds(o_orderkey % 86400) + to_seconds(o_custkey % 3600) AS ended_at,
         CAST(floor(o_totalprice) AS BIGINT) AS rows_processed,
         CAST(CASE WHEN o_orderstatus = 'F' THEN o_custkey % 7 ELSE 0 END AS BIGINT) AS rows_quarantined,
         o_orderdate AS max_observation_ts
  FROM orders
"""

ORACLE.update({
    "station_dq_invalid": f"SELECT * FROM ({STATION_FLAGGED}) WHERE failure_reason <> ''",
    "station_dedup_latest": STATION_DEDUP,
    "station_history_upsert": STATION_DEDUP,
    "dim_date": DIM_DATE,
    "nearest_city_kept": f"SELECT location_id, city_id FROM ({nearest_sql(SUPPLIER_LOCS, CITIES_XY_V2)})",
    "nearest_city": f"SELECT location_id, city_id FROM ({nearest_sql(SUPPLIER_LOCS)})",
    "land_air_quality_json": BRONZE_AQ,
    "air_quality_silver": f"{AQ_CTES} SELECT * FROM aq_silver",
    "air_quality_fact": f"""{AQ_CTES}
      SELECT city_id, location_id,
             CAST(year(observation_timestamp) * 10000 + month(observation_timestamp) * 100
                  + day(observation_timestamp) AS INTEGER) AS date_sk,
             observation_timestamp, parameter_name, parameter_units, value, _source
      FROM aq_silver WHERE city_id IN (SELECT city_id FROM dim_v1)""",
    "aqi_readings": f"""{AQ_CTES}
      SELECT location_id, city_id, parameter_name, observation_timestamp, value, aqi, aqi_category
      FROM aq_aqi""",
    "aqi_category_daily": f"{AQ_CTES} SELECT * FROM aq_dominant",
    "weather_aq_mart": f"""{AQ_CTES}, {weather_chain('w')},
      wd AS (SELECT city_id, CAST(observation_timestamp AS DATE) AS obs_date,
                    {_avg('temperature_c')} AS avg_temp_c,
                    {_avg('relative_humidity_pct')} AS avg_humidity_pct
             FROM w_silver GROUP BY 1, 2),
      ad AS (SELECT city_id, CAST(observation_timestamp AS DATE) AS obs_date,
                    {_avg("CASE WHEN parameter_name = 'pm25' THEN value END")} AS avg_pm25,
                    {_avg('CAST(aqi AS DOUBLE)')} AS avg_aqi
             FROM aq_aqi GROUP BY 1, 2)
      SELECT wd.city_id, c.city_name, wd.obs_date, wd.avg_temp_c, wd.avg_humidity_pct, ad.avg_pm25, ad.avg_aqi
      FROM wd JOIN ad ON wd.city_id = ad.city_id AND wd.obs_date = ad.obs_date
      LEFT JOIN dim_v1 c ON wd.city_id = c.city_id""",
    "daily_summary_aqi": f"""{AQ_CTES}, {weather_chain('w')},
      daily AS (
        SELECT city_id, CAST(observation_timestamp AS DATE) AS obs_date,
               {_avg('temperature_c')} AS avg_temp_c,
               MIN(temperature_c) AS min_temp_c, MAX(temperature_c) AS max_temp_c,
               {_sum('precipitation_mm')} AS total_precip_mm,
               {_avg('wind_speed_10m_kmh')} AS avg_wind_speed_kmh,
               COUNT(*) AS row_count
        FROM w_silver GROUP BY 1, 2)
      SELECT d.city_id, c.city_name, d.obs_date, d.avg_temp_c, d.min_temp_c, d.max_temp_c,
             d.total_precip_mm, d.avg_wind_speed_kmh, x.dominant_aqi_category, d.row_count
      FROM daily d LEFT JOIN aq_dominant x ON d.city_id = x.city_id AND d.obs_date = x.obs_date
      LEFT JOIN dim_v1 c ON d.city_id = c.city_id""",
    "run_health": f"""
      SELECT dag_id, run_id, CAST(min(started_at) AS DATE) AS run_date,
             CAST(sum(rows_processed) AS BIGINT) AS rows_processed,
             CAST(sum(rows_quarantined) AS BIGINT) AS rows_quarantined,
             CAST(date_diff('second', min(started_at), max(ended_at)) AS DOUBLE) AS run_duration_sec,
             CAST(date_diff('second', max(max_observation_ts), max(ended_at)) AS DOUBLE) / 60.0 AS freshness_lag_minutes
      FROM ({RUN_LOG}) GROUP BY dag_id, run_id""",
})

# ---------------------------------------------------------------- semantics of the runs

ORACLE.update({
    "upsert_late_run": f"""{WEATHER_CTES},
      late AS (SELECT * REPLACE (temperature_c + 1 AS temperature_c,
                 CASE WHEN city_id % 2 = 0 THEN _ingested_at - INTERVAL 1 HOUR ELSE _ingested_at + INTERVAL 1 HOUR END AS _ingested_at)
               FROM w_silver WHERE city_id % 3 <> 0
               UNION ALL
               SELECT * REPLACE (observation_timestamp + INTERVAL 400 DAY AS observation_timestamp)
               FROM w_silver WHERE city_id % 3 = 0)
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY city_id, observation_timestamp, _source ORDER BY _ingested_at DESC) AS rn
        FROM (SELECT * FROM w_silver UNION ALL SELECT * FROM late)) WHERE rn = 1""",
    "dq_every_reason": f"""WITH dim_v1 AS ({DIM_CITY_V1}),
      odd AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS city_id,
                CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS observation_timestamp,
                value / 4 - 20 AS temperature_c FROM events),
      f AS (SELECT o.*, CONCAT_WS('; ',
        CASE WHEN o.city_id IS NULL THEN 'not_null_city_id' END,
        CASE WHEN observation_timestamp IS NULL THEN 'not_null_observation_timestamp' END,
        CASE WHEN temperature_c NOT BETWEEN -90 AND 60 THEN 'temperature_in_range' END,
        CASE WHEN observation_timestamp < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 48 HOURS THEN 'freshness_48h' END,
        CASE WHEN d.city_id IS NULL THEN 'city_exists_in_dim_city' END) AS failure_reason
        FROM odd o LEFT JOIN dim_v1 d ON o.city_id = d.city_id)
      SELECT failure_reason, COUNT(*) AS n, MIN(city_id) AS least_city, MAX(temperature_c) AS warmest FROM f GROUP BY 1""",
    "aq_quarantine": f"""
      SELECT 'silver.air_quality_readings' AS source_table, _ingestion_run_id, failure_reason, COUNT(*) AS n FROM (
        SELECT _ingestion_run_id, CONCAT_WS('; ',
          CASE WHEN location_id IS NULL THEN 'not_null_location_id' END,
          CASE WHEN parameter_name IS NULL THEN 'not_null_parameter_name' END,
          CASE WHEN t IS NULL THEN 'not_null_observation_timestamp' END,
          CASE WHEN v IS NULL THEN 'not_null_value' END,
          CASE WHEN v < 0 THEN 'value_non_negative' END) AS failure_reason
        FROM (SELECT b.*, CASE WHEN value < 0.5 THEN NULL ELSE value - 2 END AS v,
                     CASE WHEN location_id % 13 = 0 THEN NULL ELSE period_datetime_from END AS t FROM ({BRONZE_AQ}) b))
      WHERE failure_reason <> '' GROUP BY ALL""",
})

# ---------------------------------------------------------------- feeds, states, keys


def _summary_of(silver: str) -> str:
    return f"""
SELECT d.city_id, c.city_name, d.obs_date, d.avg_temp_c, d.min_temp_c, d.max_temp_c, d.total_precip_mm, d.avg_wind_speed_kmh,
       CAST(NULL AS VARCHAR) AS dominant_aqi_category, d.row_count
FROM (SELECT city_id, CAST(observation_timestamp AS DATE) AS obs_date, {_avg('temperature_c')} AS avg_temp_c,
             MIN(temperature_c) AS min_temp_c, MAX(temperature_c) AS max_temp_c, {_sum('precipitation_mm')} AS total_precip_mm,
             {_avg('wind_speed_10m_kmh')} AS avg_wind_speed_kmh, COUNT(*) AS row_count
      FROM ({silver}) GROUP BY 1, 2) d
LEFT JOIN ({DIM_CITY_V1}) c ON d.city_id = c.city_id"""


_GAPPED_STATION = f"""
  SELECT *, CONCAT_WS('; ',
      CASE WHEN (station_id IS NOT NULL) IS FALSE THEN 'not_null_station_id' END,
      CASE WHEN (obs_date IS NOT NULL) IS FALSE THEN 'not_null_obs_date' END,
      CASE WHEN (value IS NOT NULL) IS FALSE THEN 'not_null_value' END,
      CASE WHEN (element NOT IN ('TMAX', 'TMIN') OR value BETWEEN -90 AND 60) IS FALSE THEN 'temp_in_range' END,
      CASE WHEN (element != 'PRCP' OR value >= 0) IS FALSE THEN 'precip_non_negative' END) AS failure_reason
  FROM (SELECT element, CASE WHEN abs(data_value) % 10 <> 1 THEN station_id END AS station_id,
               CASE WHEN abs(data_value) % 10 <> 2 THEN obs_date END AS obs_date,
               CASE WHEN abs(data_value) % 100 <> 33 THEN
                 CASE WHEN element IN ('TMAX', 'TMIN', 'PRCP') THEN data_value / 10.0 ELSE CAST(data_value AS DOUBLE) END END AS value
        FROM ({BRONZE_STATION}))
"""

_SAME_KEY = "t.city_id = s.city_id AND t.observation_timestamp = s.observation_timestamp AND t._source = s._source"
_FEED = [f"{a}.{c} AS {n}_{c}" for a, n in (("t", "before"), ("s", "after"))
         for c in ("temperature_c", "precipitation_mm", "_ingested_at", "_merged_at")]
_FACT_ORDER = "date_sk, city_id % 256, city_id, observation_timestamp, _source"

ORACLE.update({
    "upsert_changes": f"""{UPSERT_CTES}
      SELECT s.city_id, s.observation_timestamp, s._source, CASE WHEN t.city_id IS NULL THEN 'insert' ELSE 'update' END AS change,
             {', '.join(_FEED)}
      FROM s_silver s LEFT JOIN t_silver t ON {_SAME_KEY}""",
    "upsert_applied": ORACLE["upsert_silver"],
    "mart_from_states": _summary_of(ORACLE["upsert_silver"]),
    "mart_from_states_late": _summary_of(ORACLE["upsert_late_run"]),
    "fact_dense_keys": f"""{UPSERT_CTES},
      tf AS (SELECT {FACT_COLS} FROM t_silver WHERE city_id IN (SELECT city_id FROM dim_v1)),
      sf AS (SELECT {FACT_COLS} FROM s_silver WHERE city_id IN (SELECT city_id FROM dim_v1)),
      tk AS (SELECT *, row_number() OVER (ORDER BY {_FACT_ORDER}) AS sk FROM tf),
      nk AS (SELECT s.*, (SELECT count(*) FROM tk) + row_number() OVER (ORDER BY {_FACT_ORDER.replace('city_id', 's.city_id').replace('date_sk', 's.date_sk').replace('observation_timestamp', 's.observation_timestamp').replace('_source', 's._source')}) AS sk
             FROM sf s WHERE NOT EXISTS (SELECT 1 FROM tk t WHERE {_SAME_KEY}))
      SELECT sk AS weather_observation_sk, city_id, observation_timestamp, _source, date_sk, temperature_c FROM nk
      UNION ALL
      SELECT t.sk, t.city_id, t.observation_timestamp, t._source, t.date_sk, coalesce(s.temperature_c, t.temperature_c)
      FROM tk t LEFT JOIN sf s ON {_SAME_KEY}""",
    "scd2_snapshots": f"""WITH e AS (
        SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS seen FROM ({city_shaped_sql(1)}) UNION ALL
        SELECT *, TIMESTAMP '2024-01-08 00:00:00' AS seen FROM ({city_shaped_sql(3)}) UNION ALL
        SELECT *, TIMESTAMP '2024-01-15 00:00:00' AS seen FROM ({city_shaped_sql(2)})),
      m AS (SELECT *, lag(seen) OVER w IS NULL OR {' OR '.join(f'lag({a}) OVER w IS DISTINCT FROM {a}' for a in TRACKED)} AS opens
            FROM e WINDOW w AS (PARTITION BY city_id ORDER BY seen))
      SELECT {', '.join(CITY_ATTRS)}, seen AS effective_start_ts, lead(seen) OVER (PARTITION BY city_id ORDER BY seen) AS effective_end_ts,
             lead(seen) OVER (PARTITION BY city_id ORDER BY seen) IS NULL AS is_current
      FROM m WHERE opens""",
    "run_counts": f"""{WEATHER_CTES}
      SELECT _ingestion_run_id, COUNT(*) AS rows_processed, COUNT(*) FILTER (WHERE failure_reason <> '') AS rows_quarantined,
             MAX(observation_timestamp) AS max_observation_ts, MIN(_ingested_at) AS first_ingested_at
      FROM w_flagged GROUP BY 1""",
    "quarantine_replay": f"{WEATHER_CTES} SELECT * FROM w_invalid",
    "quarantine_repromoted": f"""{WEATHER_CTES},
      again AS (SELECT * FROM w_invalid WHERE failure_reason = 'city_exists_in_dim_city' AND city_id IN (SELECT c_custkey FROM customer))
      SELECT {WEATHER_COLS}, TIMESTAMP '2024-02-01 00:00:00' AS _merged_at
      FROM (SELECT *, row_number() OVER (PARTITION BY city_id, observation_timestamp, _source
                                         ORDER BY _ingested_at DESC NULLS LAST, _ingestion_run_id DESC NULLS LAST) AS rn FROM again)
      WHERE rn = 1""",
    "dq_gate_closed": f"""SELECT COUNT(*) AS checked_rows, COUNT(*) FILTER (WHERE failure_reason <> '') AS quarantined_rows,
        CAST(COUNT(*) FILTER (WHERE failure_reason <> '') AS DOUBLE) / COUNT(*) AS quarantine_rate,
        CAST(COUNT(*) FILTER (WHERE failure_reason <> '') AS DOUBLE) / COUNT(*) <= 0.02 AS gate_passed FROM ({_GAPPED_STATION})""",
    "station_dq_every_reason": f"""SELECT failure_reason, COUNT(*) AS n, MAX(value) AS highest
      FROM ({_GAPPED_STATION}) GROUP BY 1""",
    "scope_stations": f"""SELECT * FROM ({BRONZE_STATION}) WHERE obs_date >= DATE '2024-01-05'
      AND station_id IN ('ST000000000', 'ST000000003', 'ST000000007', 'ST000000011', 'ST000000014')""",
})
