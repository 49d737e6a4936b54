"""Station-month fixed-width lines (.dly) -> one row per station/day/element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.sources.audit import with_audit

# Line layout (1-based positions for ``substring``).
LINE_WIDTH = 269
DAYS_PER_LINE = 31
STATION_POS, STATION_LEN = 1, 11
YEAR_POS, YEAR_LEN = 12, 4
MONTH_POS, MONTH_LEN = 16, 2
ELEMENT_POS, ELEMENT_LEN = 18, 4
FIRST_DAY_POS = 22  # value of day d starts at FIRST_DAY_POS + 8 * (d - 1)
DAY_STRIDE = 8
VALUE_LEN = 5
MISSING_VALUE = -9999

BRONZE_STATION_COLUMNS = [
    "_source", "_ingested_at", "_ingestion_run_id", "_source_file", "_ingest_date",
    "station_id", "obs_date", "element", "data_value", "mflag", "qflag", "sflag", "obs_time",
]


def _flag(line: Column, pos: Column) -> Column:
    return F.nullif(F.trim(F.substring(line, pos, F.lit(1))), F.lit(""))


def unpack_station_cells(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Every day cell of every full-width line, with a ``cell_status``:
    ``ok``, ``blank``, ``missing`` (-9999), ``bad_value`` (not an integer) or
    ``bad_date`` (e.g. day 31 of a 30-day month). Short lines are skipped."""
    line = F.col(text_col)
    passthrough = [c for c in lines.columns if c != text_col]
    full = lines.filter(F.length(line) >= LINE_WIDTH)
    cells = F.transform(
        F.sequence(F.lit(1), F.lit(DAYS_PER_LINE)),
        lambda d: F.struct(
            d.alias("day"),
            F.trim(F.substring(line, F.lit(FIRST_DAY_POS) + (d - 1) * DAY_STRIDE, F.lit(VALUE_LEN))).alias("raw"),
            _flag(line, F.lit(FIRST_DAY_POS + VALUE_LEN) + (d - 1) * DAY_STRIDE).alias("mflag"),
            _flag(line, F.lit(FIRST_DAY_POS + VALUE_LEN + 1) + (d - 1) * DAY_STRIDE).alias("qflag"),
            _flag(line, F.lit(FIRST_DAY_POS + VALUE_LEN + 2) + (d - 1) * DAY_STRIDE).alias("sflag"),
        ),
    )
    exploded = full.select(
        *passthrough,
        F.substring(line, STATION_POS, STATION_LEN).alias("station_id"),
        F.substring(line, YEAR_POS, YEAR_LEN).alias("_year"),
        F.substring(line, MONTH_POS, MONTH_LEN).alias("_month"),
        F.substring(line, ELEMENT_POS, ELEMENT_LEN).alias("element"),
        F.inline(cells),
    )
    value = F.expr("try_cast(raw AS INT)")
    obs_date = F.expr(
        "try_cast(concat(_year, '-', _month, '-', lpad(cast(day AS STRING), 2, '0')) AS DATE)"
    )
    status = (
        F.when(F.col("raw") == "", F.lit("blank"))
        .when(value.isNull(), F.lit("bad_value"))
        .when(value == MISSING_VALUE, F.lit("missing"))
        .when(obs_date.isNull(), F.lit("bad_date"))
        .otherwise(F.lit("ok"))
    )
    return exploded.select(
        *passthrough,
        "station_id",
        obs_date.alias("obs_date"),
        "element",
        value.alias("data_value"),
        "mflag", "qflag", "sflag",
        status.alias("cell_status"),
    )


def unpack_station_lines(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Only the usable cells: blank, missing, non-numeric and impossible days
    are skipped (count them with :func:`unpack_station_cells`)."""
    return unpack_station_cells(lines, text_col).filter(F.col("cell_status") == "ok").drop("cell_status")


def land_station_daily(
    unpacked: DataFrame,
    source: Column | None = None,
    run_id: Column | None = None,
    ingested_at: Column | None = None,
    source_file: Column | None = None,
) -> DataFrame:
    """Audit columns; ``_source_file`` is the file the line came from, or
    ``<station>.dly`` when lines were not read from files."""
    src_file = source_file if source_file is not None else F.concat(F.col("station_id"), F.lit(".dly"))
    staged = unpacked.withColumn("_source_file", src_file).withColumn("obs_time", F.lit(None).cast("string"))
    return with_audit(staged, source, run_id, ingested_at, default_source="noaa-ghcn").select(
        *BRONZE_STATION_COLUMNS
    )


def read_station_dly(spark: SparkSession, path: str, **audit) -> DataFrame:
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("_file"))
    return land_station_daily(unpack_station_lines(lines), source_file=F.col("_file"), **audit)
