"""Domain-shaped inputs derived from the driver's test tables.

The test tables carry no weather columns, so each reference role is played
by a table with the same shape (see SURVEY §7.3):

* observation  <- ``events``  (user_id = city, ts = ingest time, value -> readings)
* city         <- ``customer`` (c_custkey = city id, c_name = name, ...)
* station-day  <- ``events``  (user_id = station, event_type = element)
* run log      <- ``orders``
* location     <- ``supplier``

Every derivation is a plain column expression over the whole table, so the
work grows with the tables. The same expressions appear in the DuckDB
oracle SQL of ``__spark_entry__``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import pin_session

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Event type -> station element (one element per event type).
ELEMENT_OF_EVENT = {
    "click": "TMAX",
    "view": "TMIN",
    "purchase": "PRCP",
    "signup": "SNOW",
    "error": "SNWD",
}

# Event type -> air-quality parameter and unit.
PARAMETER_OF_EVENT = {
    "click": ("pm25", "µg/m³"),
    "view": ("pm10", "µg/m³"),
    "purchase": ("o3", "ppm"),
    "signup": ("no2", "ppb"),
    "error": ("so2", "ppb"),
}

# Landing times of the city snapshots.
CITY_RUNS = {
    1: ("city-run-1", "2024-01-01 00:00:00"),
    2: ("city-run-2", "2024-01-15 00:00:00"),
    3: ("city-run-3", "2024-01-08 00:00:00"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_session(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map_col(mapping: dict[str, str], c: Column) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr


def station_id(user_id: Column) -> Column:
    """11-character station id for a user."""
    return F.concat(F.lit("ST"), F.lpad(user_id.cast("string"), 9, "0"))


# ---------------------------------------------------------------- weather

def bronze_weather(events: DataFrame, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """events -> bronze.weather_raw rows (daily observation grain, several
    polls per city/day/source so latest-wins dedup has work to do)."""
    v = F.col("value")
    eid = F.col("event_id")
    return events.select(
        *keep,
        F.col("event_type").alias("_source"),
        F.col("ts").alias("_ingested_at"),
        F.concat(F.lit("run-"), F.date_format("ts", "yyyyMMddHH")).alias("_ingestion_run_id"),
        F.to_date("ts").alias("_ingest_date"),
        F.col("user_id").alias("city_id"),
        F.col("props").alias("raw_json"),
        (((F.col("user_id") * 53) % 181) - 90).cast("double").alias("latitude"),
        (((F.col("user_id") * 17) % 361) - 180).cast("double").alias("longitude"),
        (F.col("user_id") % 500).cast("double").alias("elevation"),
        F.to_date("ts").cast("timestamp_ntz").alias("observation_time"),
        (v / 4 - 20).alias("temperature_2m"),
        (v / 4 - 22).alias("apparent_temperature"),
        (eid % 101).cast("double").alias("relative_humidity_2m"),
        (v / 100).alias("precipitation"),
        (v / 200).alias("rain"),
        F.lit(0.0).alias("showers"),
        F.lit(0.0).alias("snowfall"),
        (eid % 100).cast("int").alias("weather_code"),
        (eid % 101).cast("double").alias("cloud_cover"),
        (v / 100 + 1000).alias("pressure_msl"),
        F.lit(1000.0).alias("surface_pressure"),
        (v / 10).alias("wind_speed_10m"),
        (eid % 360).cast("double").alias("wind_direction_10m"),
        (v / 5).alias("wind_gusts_10m"),
        F.hour("ts").between(6, 17).alias("is_day"),
    )


def weather_json_lines(events: DataFrame) -> DataFrame:
    """events -> one weather API document per line (``value`` column, as
    ``spark.read.text`` yields). Integer-valued fields are written as JSON
    integers; ``is_day`` is 0/1."""
    v = F.col("value")
    eid = F.col("event_id")
    current = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
        (v / 4 - 20).alias("temperature_2m"),
        (eid % 101).alias("relative_humidity_2m"),
        (v / 4 - 22).alias("apparent_temperature"),
        (v / 100).alias("precipitation"),
        (v / 200).alias("rain"),
        F.lit(0).alias("showers"),
        F.lit(0).alias("snowfall"),
        (eid % 100).alias("weather_code"),
        (eid % 101).alias("cloud_cover"),
        (v / 100 + 1000).alias("pressure_msl"),
        F.lit(1000).alias("surface_pressure"),
        (v / 10).alias("wind_speed_10m"),
        (eid % 360).alias("wind_direction_10m"),
        (v / 5).alias("wind_gusts_10m"),
        F.when(F.hour("ts").between(6, 17), F.lit(1)).otherwise(F.lit(0)).alias("is_day"),
    )
    doc = F.struct(
        F.col("user_id").alias("_city_id"),
        (((F.col("user_id") * 53) % 181) - 90).alias("latitude"),
        (((F.col("user_id") * 17) % 361) - 180).alias("longitude"),
        (F.col("user_id") % 500).alias("elevation"),
        current.alias("current"),
    )
    return events.select(
        F.to_json(doc).alias("value"),
        F.col("event_type").alias("_source"),
        F.col("ts").alias("_ingested_at"),
    )


# ---------------------------------------------------------------- cities

def _city_columns(customer: DataFrame, version: int, whole: bool = False) -> DataFrame:
    """19 GeoNames-style string columns of a city snapshot.

    Version 2 differs from version 1 the way weekly snapshots do: a few more
    cities, a few fewer, population revised (nation 7), timezone withdrawn
    (nation 11), dem corrected (nation 17, MACHINERY), and a name change that
    is not a tracked attribute (nation 13). Version 3 lies in time between the
    two: it misses every fifth city and revises population (nation 3) and timezone
    (nation 11).
    """
    k, n, b, s = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    name = F.when(n == 5, F.concat(F.lit('"'), F.col("c_name"))).otherwise(F.col("c_name"))
    population = F.when(b < 0, F.lit("")).otherwise((k * 100 + n).cast("string"))
    dem = F.when(s == "BUILDING", F.lit("")).otherwise((n * 10 + 3).cast("string"))
    timezone = F.concat(F.lit("Zone/"), s)
    if version == 2:
        name = F.when(n == 13, F.upper(name)).otherwise(name)
        population = F.when((n == 7) & (b >= 0), (k * 100 + n + 1).cast("string")).otherwise(population)
        timezone = F.when(n == 11, F.lit("")).otherwise(timezone)
        dem = F.when((n == 17) & (s == "MACHINERY"), (n * 10 + 4).cast("string")).otherwise(dem)
        keep = (b >= -950) & (b <= 9900)
    elif version == 3:
        population = F.when((n == 3) & (b >= 0), (k * 100 + n + 7).cast("string")).otherwise(population)
        timezone = F.when(n == 11, F.lit("")).otherwise(timezone)
        keep = (b >= -920) & (k % 5 != 0)
    else:
        keep = b >= -900
    return (customer if whole else customer.filter(keep)).select(
        k.cast("string").alias("geonameid"),
        name.alias("name"),
        F.lower(F.col("c_name")).alias("asciiname"),
        F.lit("").alias("alternatenames"),
        (((k * 53) % 181) - 90).cast("string").alias("latitude"),
        (((k * 17) % 361) - 180).cast("string").alias("longitude"),
        F.lit("P").alias("feature_class"),
        F.lit("PPL").alias("feature_code"),
        F.concat(F.lit("N"), F.lpad(n.cast("string"), 2, "0")).alias("country_code"),
        F.lit("").alias("cc2"),
        s.alias("admin1_code"),
        F.lit("").alias("admin2_code"),
        F.lit("").alias("admin3_code"),
        F.lit("").alias("admin4_code"),
        population.alias("population"),
        (n * 10).cast("string").alias("elevation"),
        dem.alias("dem"),
        timezone.alias("timezone"),
        F.concat(F.lit("2023-12-"), F.lpad((n + 1).cast("string"), 2, "0")).alias("source_modified_date"),
    )


def city_tsv_lines(customer: DataFrame, version: int = 1, whole: bool = False) -> DataFrame:
    """A city snapshot as tab-separated lines (``value``), no header; ``whole``:
    of all customers, else of those the version has."""
    cols = _city_columns(customer, version, whole)
    return cols.select(F.concat_ws("\t", *[F.col(c) for c in cols.columns]).alias("value"))


def bronze_city_snapshot(customer: DataFrame, version: int) -> DataFrame:
    """A landed city snapshot (bronze.city_reference_raw rows)."""
    from stratum.sources.city_tsv import parse_city_lines, land_city_reference

    run_id, ingested_at = CITY_RUNS[version]
    return land_city_reference(
        parse_city_lines(city_tsv_lines(customer, version)),
        run_id=F.lit(run_id),
        ingested_at=F.lit(ingested_at).cast("timestamp_ntz"),
        source=F.lit("geonames"),
    )


def bronze_city_all(customer: DataFrame) -> DataFrame:
    """Both snapshots appended, as bronze holds them."""
    return bronze_city_snapshot(customer, 1).unionByName(bronze_city_snapshot(customer, 2))


def dim_city_ids_v1(customer: DataFrame) -> DataFrame:
    """dim_city_current after the first snapshot: id and name."""
    return customer.filter(F.col("c_acctbal") >= -900).select(
        F.col("c_custkey").alias("city_id"),
        F.when(F.col("c_nationkey") == 5, F.concat(F.lit('"'), F.col("c_name")))
        .otherwise(F.col("c_name"))
        .alias("city_name"),
    )


# ---------------------------------------------------------------- stations

def _station_value(event_type: Column, value: Column) -> Column:
    """Raw station value in tenths: temperatures span about -30..+60 degC,
    precipitation is occasionally negative (a sensor fault to quarantine)."""
    temp = event_type.isin("click", "view")
    return (
        F.when(temp, F.floor(value * 4) - 300)
        .when(event_type == "purchase", F.floor(value * 10) - 5)
        .otherwise(F.floor(value * 10))
        .cast("int")
    )


def bronze_station_daily(events: DataFrame) -> DataFrame:
    """events -> bronze.ghcn_daily_raw rows; each event re-lands a value for
    (station, day, element), so the same key arrives several times."""
    return events.select(
        F.lit("noaa-ghcn").alias("_source"),
        F.col("ts").alias("_ingested_at"),
        F.concat(F.lit("run-"), F.date_format("ts", "yyyyMMddHH")).alias("_ingestion_run_id"),
        F.concat(station_id(F.col("user_id")), F.lit(".dly")).alias("_source_file"),
        F.to_date("ts").alias("_ingest_date"),
        station_id(F.col("user_id")).alias("station_id"),
        F.to_date("ts").alias("obs_date"),
        _map_col(ELEMENT_OF_EVENT, F.col("event_type")).alias("element"),
        _station_value(F.col("event_type"), F.col("value")).alias("data_value"),
        F.lit(None).cast("string").alias("mflag"),
        F.when(F.col("value") > 300, F.lit("X")).alias("qflag"),
        F.lit("S").alias("sflag"),
        F.lit(None).cast("string").alias("obs_time"),
    )


def station_month_lines(events: DataFrame) -> DataFrame:
    """Pack events into station-month fixed-width lines: per (station, day,
    element) the tenths of the day's maximum value, 31 day cells per line,
    -9999 for days without data, flags blank / blank / 'S'. A line holds at
    most 31 cells, so the per-group list is bounded by the calendar."""
    daily = events.groupBy(
        station_id(F.col("user_id")).alias("station_id"),
        F.to_date("ts").alias("d"),
        _map_col(ELEMENT_OF_EVENT, F.col("event_type")).alias("element"),
    ).agg(F.floor(F.max("value") * 10).cast("int").alias("v"))
    monthly = daily.groupBy(
        "station_id", F.year("d").alias("y"), F.month("d").alias("m"), "element"
    ).agg(F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("d"), F.col("v")))).alias("days"))

    def cell(day: Column) -> Column:
        value = F.coalesce(F.try_element_at(F.col("days"), day).cast("string"), F.lit("-9999"))
        return F.concat(F.lpad(value, 5, " "), F.lit("  S"))

    line = F.concat(
        F.rpad("station_id", 11, " "),
        F.lpad(F.col("y").cast("string"), 4, "0"),
        F.lpad(F.col("m").cast("string"), 2, "0"),
        F.rpad("element", 4, " "),
        F.array_join(F.transform(F.sequence(F.lit(1), F.lit(31)), cell), ""),
    )
    return monthly.select(line.alias("value"))


# ---------------------------------------------------------------- air quality

# Sensor number of each event type's parameter.
SENSOR_OF_EVENT = {"click": 1, "view": 2, "purchase": 3, "signup": 4, "error": 5}


def location_lat(k: Column) -> Column:
    return (((k * 37) % 181) - 90).cast("double")


def location_lon(k: Column) -> Column:
    return (((k * 91) % 361) - 180).cast("double")


def city_lat(k: Column) -> Column:
    return (((k * 53) % 181) - 90).cast("double")


def city_lon(k: Column) -> Column:
    return (((k * 17) % 361) - 180).cast("double")


def air_quality_lines(events: DataFrame) -> DataFrame:
    """events -> one measurement document per line (location = user, one
    hourly result per event; ozone in ppm)."""
    et = F.col("event_type")
    name = _map_col({k: v[0] for k, v in PARAMETER_OF_EVENT.items()}, et)
    units = _map_col({k: v[1] for k, v in PARAMETER_OF_EVENT.items()}, et)
    sensor = F.col("user_id") * 10 + _map_col({k: str(v) for k, v in SENSOR_OF_EVENT.items()}, et).cast("bigint")
    value = F.when(et == "purchase", F.col("value") / 1000).otherwise(F.col("value"))
    hour = F.date_trunc("HOUR", F.col("ts").cast("timestamp"))
    utc = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    result = F.struct(
        sensor.alias("sensor_id"),
        F.struct(name.alias("name"), units.alias("units")).alias("parameter"),
        value.alias("value"),
        F.struct(
            F.struct(F.date_format(hour, utc).alias("utc")).alias("datetimeFrom"),
            F.struct(F.date_format(hour + F.expr("INTERVAL 1 HOUR"), utc).alias("utc")).alias("datetimeTo"),
        ).alias("period"),
    )
    doc = F.struct(
        F.col("user_id").alias("location_id"),
        F.struct(location_lat(F.col("user_id")).alias("latitude"),
                 location_lon(F.col("user_id")).alias("longitude")).alias("coordinates"),
        F.array(result).alias("results"),
    )
    return events.select(
        F.to_json(doc).alias("value"),
        F.concat(F.lit("aq-"), F.date_format("ts", "yyyyMMddHH")).alias("_ingestion_run_id"),
        F.col("ts").alias("_ingested_at"),
    )


def cities_with_coordinates(customer: DataFrame) -> DataFrame:
    """All cities with their coordinates."""
    k = F.col("c_custkey")
    return customer.select(
        k.alias("city_id"), city_lat(k).alias("latitude"), city_lon(k).alias("longitude")
    )


def cities_of_version(customer: DataFrame, version: int) -> DataFrame:
    """Cities with coordinates of two snapshots: in the second some are new, some
    are gone, and those of nation 7 have moved."""
    k = F.col("c_custkey")
    if version == 1:
        return cities_with_coordinates(customer.where("c_acctbal >= -900"))
    moved = F.when(F.col("c_nationkey") == 7, k + 31).otherwise(k)
    return customer.where("c_acctbal >= -950 AND c_acctbal <= 9900").select(
        k.alias("city_id"), city_lat(moved).alias("latitude"), city_lon(moved).alias("longitude"))


def supplier_locations(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return supplier.select(k.alias("location_id"), location_lat(k).alias("latitude"),
                           location_lon(k).alias("longitude"))


def run_log_from_orders(orders: DataFrame) -> DataFrame:
    """orders -> task run records: priority = pipeline, status + month = run."""
    started = F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate"))
    return orders.select(
        F.col("o_orderpriority").alias("dag_id"),
        F.concat(F.col("o_orderstatus"), F.lit("-"), F.date_format("o_orderdate", "yyyyMM")).alias("run_id"),
        F.lit("task").alias("task_id"),
        started.alias("started_at"),
        F.timestamp_add("SECOND", F.col("o_custkey") % 3600, started).alias("ended_at"),
        F.floor("o_totalprice").cast("bigint").alias("rows_processed"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey") % 7).otherwise(F.lit(0)).cast("bigint")
        .alias("rows_quarantined"),
        F.col("o_orderdate").alias("max_observation_ts"),
    )


def bronze_air_quality(events: DataFrame) -> DataFrame:
    """events -> bronze.air_quality_raw rows directly (the same values
    :func:`air_quality_lines` carries through JSON text), for the queries
    downstream of landing."""
    et = F.col("event_type")
    hour = F.date_trunc("HOUR", F.col("ts").cast("timestamp"))
    return events.select(
        F.lit("openaq").alias("_source"),
        F.col("ts").alias("_ingested_at"),
        F.concat(F.lit("aq-"), F.date_format("ts", "yyyyMMddHH")).alias("_ingestion_run_id"),
        F.to_date("ts").alias("_ingest_date"),
        F.col("user_id").alias("location_id"),
        (F.col("user_id") * 10 + _map_col({k: str(v) for k, v in SENSOR_OF_EVENT.items()}, et).cast("bigint"))
        .alias("sensor_id"),
        F.col("props").alias("raw_json"),
        _map_col({k: v[0] for k, v in PARAMETER_OF_EVENT.items()}, et).alias("parameter_name"),
        _map_col({k: v[1] for k, v in PARAMETER_OF_EVENT.items()}, et).alias("parameter_units"),
        F.when(et == "purchase", F.col("value") / 1000).otherwise(F.col("value")).alias("value"),
        hour.alias("period_datetime_from"),
        (hour + F.expr("INTERVAL 1 HOUR")).alias("period_datetime_to"),
        location_lat(F.col("user_id")).alias("location_latitude"),
        location_lon(F.col("user_id")).alias("location_longitude"),
    )
