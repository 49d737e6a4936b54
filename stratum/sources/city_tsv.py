"""City reference snapshot (tab-separated, no header) -> bronze rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.sources.audit import with_audit

# The 19 columns of a city snapshot line, in order.
CITY_COLUMNS = [
    "geonameid", "name", "asciiname", "alternatenames", "latitude", "longitude",
    "feature_class", "feature_code", "country_code", "cc2", "admin1_code",
    "admin2_code", "admin3_code", "admin4_code", "population", "elevation",
    "dem", "timezone", "source_modified_date",
]

# Typed columns; blank or bad text becomes NULL, not a failure.
CITY_CASTS = {
    "geonameid": "BIGINT",
    "latitude": "DOUBLE",
    "longitude": "DOUBLE",
    "population": "BIGINT",
    "elevation": "INT",
    "dem": "INT",
    "source_modified_date": "DATE",
}

BRONZE_CITY_COLUMNS = ["_source", "_ingested_at", "_ingestion_run_id", "_ingest_date", *CITY_COLUMNS]


def parse_city_lines(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Split on tabs only: quote characters are literal text (the format has
    no quoting). Short lines give NULL for the missing fields."""
    parts = F.split(F.col(text_col), "\t", -1)
    passthrough = [c for c in lines.columns if c != text_col]
    return lines.select(*passthrough, *[F.get(parts, i).alias(c) for i, c in enumerate(CITY_COLUMNS)])


def land_city_reference(
    parsed: DataFrame,
    source: Column | None = None,
    run_id: Column | None = None,
    ingested_at: Column | None = None,
) -> DataFrame:
    typed = parsed.selectExpr(
        *[f"try_cast({c} AS {CITY_CASTS[c]}) AS {c}" if c in CITY_CASTS else f"`{c}`" for c in parsed.columns]
    )
    return with_audit(typed, source, run_id, ingested_at, default_source="geonames").select(
        *BRONZE_CITY_COLUMNS
    )


def read_city_tsv(spark: SparkSession, path: str, **audit) -> DataFrame:
    return land_city_reference(parse_city_lines(spark.read.text(path)), **audit)
