"""Weather API documents (one JSON object per line) -> bronze.weather_raw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from stratum.sources.audit import with_audit

# Numeric readings under ``current``.
CURRENT_READINGS = [
    "temperature_2m", "apparent_temperature", "relative_humidity_2m", "precipitation",
    "rain", "showers", "snowfall", "cloud_cover", "pressure_msl", "surface_pressure",
    "wind_speed_10m", "wind_direction_10m", "wind_gusts_10m",
]

# Integers in the JSON parse fine into DOUBLE; is_day is read as INT because
# a JSON 1 does not parse into BOOLEAN.
PAYLOAD_SCHEMA = StructType(
    [
        StructField("_city_id", LongType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("elevation", DoubleType()),
        StructField(
            "current",
            StructType(
                [StructField("time", StringType())]
                + [StructField(c, DoubleType()) for c in CURRENT_READINGS]
                + [StructField("weather_code", IntegerType()), StructField("is_day", IntegerType())]
            ),
        ),
    ]
)

# Bronze.weather_raw column order.
BRONZE_WEATHER_COLUMNS = [
    "_source", "_ingested_at", "_ingestion_run_id", "_ingest_date", "city_id", "raw_json",
    "latitude", "longitude", "elevation", "observation_time",
    "temperature_2m", "apparent_temperature", "relative_humidity_2m",
    "precipitation", "rain", "showers", "snowfall", "weather_code",
    "cloud_cover", "pressure_msl", "surface_pressure",
    "wind_speed_10m", "wind_direction_10m", "wind_gusts_10m", "is_day",
]


def parse_weather_lines(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Flatten each document: missing keys (or a missing / null ``current``)
    give NULLs, malformed JSON gives an all-NULL row that keeps its raw text,
    ``is_day`` 0/1 becomes boolean, the minute timestamp is parsed leniently."""
    passthrough = [c for c in lines.columns if c != text_col]
    # the struct is a column of its own below the projection, so a document is parsed once
    parsed = lines.select(*passthrough, F.col(text_col).alias("raw_json"), F.from_json(F.col(text_col), PAYLOAD_SCHEMA).alias("_doc"))
    p = F.col("_doc")
    return parsed.select(
        *passthrough,
        "raw_json",
        p["_city_id"].alias("city_id"),
        p["latitude"].alias("latitude"),
        p["longitude"].alias("longitude"),
        p["elevation"].alias("elevation"),
        F.try_to_timestamp(p["current"]["time"]).alias("observation_time"),
        *[p["current"][c].alias(c) for c in CURRENT_READINGS],
        p["current"]["weather_code"].alias("weather_code"),
        (p["current"]["is_day"] != 0).alias("is_day"),
    )


def land_weather(
    parsed: DataFrame,
    source: Column | None = None,
    run_id: Column | None = None,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Parsed documents + audit columns, in bronze.weather_raw order."""
    return with_audit(parsed, source, run_id, ingested_at, default_source="open-meteo").select(
        *BRONZE_WEATHER_COLUMNS
    )


def read_weather_json(spark: SparkSession, path: str, **audit) -> DataFrame:
    """Read landed documents (any number of files, split by Spark) and land them."""
    return land_weather(parse_weather_lines(spark.read.text(path)), **audit)
