"""Air-quality measurement documents -> bronze.air_quality_raw rows.

One JSON document per line: a location with coordinates and a list of
sensor results, each with parameter, value and an averaging period::

    {"location_id": 1, "coordinates": {"latitude": .., "longitude": ..},
     "results": [{"sensor_id": 10, "parameter": {"name": "pm25", "units": "µg/m³"},
                  "value": 12.5, "period": {"datetimeFrom": {"utc": "..."},
                                            "datetimeTo": {"utc": "..."}}}]}
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.sources.audit import with_audit

PAYLOAD_DDL = (
    "location_id BIGINT, coordinates STRUCT<latitude: DOUBLE, longitude: DOUBLE>, "
    "results ARRAY<STRUCT<sensor_id: BIGINT, parameter: STRUCT<name: STRING, units: STRING>, "
    "value: DOUBLE, period: STRUCT<datetimeFrom: STRUCT<utc: STRING>, datetimeTo: STRUCT<utc: STRING>>>>"
)

BRONZE_AQ_COLUMNS = [
    "_source", "_ingested_at", "_ingestion_run_id", "_ingest_date", "location_id", "sensor_id",
    "raw_json", "parameter_name", "parameter_units", "value", "period_datetime_from",
    "period_datetime_to", "location_latitude", "location_longitude",
]


def parse_air_quality_lines(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """One row per sensor result; a document without results keeps one row
    (NULL measurement) so nothing landed is lost."""
    doc = F.from_json(F.col(text_col), PAYLOAD_DDL)
    passthrough = [c for c in lines.columns if c != text_col]
    flat = lines.select(*passthrough, F.col(text_col).alias("raw_json"), doc.alias("d")).select(
        *passthrough, "raw_json",
        F.col("d.location_id").alias("location_id"),
        F.col("d.coordinates.latitude").alias("location_latitude"),
        F.col("d.coordinates.longitude").alias("location_longitude"),
        F.explode_outer("d.results").alias("m"),
    )
    return flat.select(
        *passthrough, "raw_json", "location_id", "location_latitude", "location_longitude",
        F.col("m.sensor_id").alias("sensor_id"),
        F.col("m.parameter.name").alias("parameter_name"),
        F.col("m.parameter.units").alias("parameter_units"),
        F.col("m.value").alias("value"),
        F.try_to_timestamp(F.col("m.period.datetimeFrom.utc")).alias("period_datetime_from"),
        F.try_to_timestamp(F.col("m.period.datetimeTo.utc")).alias("period_datetime_to"),
    )


def land_air_quality(parsed: DataFrame, source: Column | None = None, run_id: Column | None = None,
                     ingested_at: Column | None = None) -> DataFrame:
    return with_audit(parsed, source, run_id, ingested_at, default_source="openaq").select(*BRONZE_AQ_COLUMNS)


def read_air_quality_json(spark: SparkSession, path: str, **audit) -> DataFrame:
    return land_air_quality(parse_air_quality_lines(spark.read.text(path)), **audit)
