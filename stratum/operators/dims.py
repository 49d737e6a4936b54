"""Conformed date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.columns import date_sk

DATE_DIM_COLUMNS = [
    "date_sk", "full_date", "year", "quarter", "month", "month_name", "day",
    "day_of_week", "day_name", "is_weekend",
]


def date_rows(full_date: Column) -> list[Column]:
    """Attributes of a date; weeks are ISO (Monday = 1 ... Sunday = 7)."""
    dow = (F.weekday(full_date) + 1).cast("int")
    return [
        date_sk(full_date).alias("date_sk"),
        full_date.alias("full_date"),
        F.year(full_date).alias("year"),
        F.quarter(full_date).alias("quarter"),
        F.month(full_date).alias("month"),
        F.date_format(full_date, "MMMM").alias("month_name"),
        F.dayofmonth(full_date).alias("day"),
        dow.alias("day_of_week"),
        F.date_format(full_date, "EEEE").alias("day_name"),
        (dow >= 6).alias("is_weekend"),
    ]


def date_dimension_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One row per day from ``start`` to ``end`` (inclusive) for each bounds
    row. The row count is the calendar span, not the data volume."""
    d = F.explode(F.sequence(F.col(start_col), F.col(end_col), F.expr("INTERVAL 1 DAY"))).alias("d")
    return bounds.select(d).select(*date_rows(F.col("d")))


def date_dimension_for(df: DataFrame, ts_col: str) -> DataFrame:
    """Date dimension covering every day between the first and last value of
    ``ts_col`` (a global min/max aggregate, combined map-side)."""
    bounds = df.agg(F.min(F.to_date(ts_col)).alias("start"), F.max(F.to_date(ts_col)).alias("end"))
    return date_dimension_between(bounds.filter(F.col("start").isNotNull()))
