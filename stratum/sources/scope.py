"""Date-range and station scoping of landed station rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class UnknownStation(ValueError):
    pass


def scope_dates(df: DataFrame, start: str | None = None, end: str | None = None, date_col: str = "obs_date") -> DataFrame:
    """Inclusive bounds, each optional (``None`` / blank = unbounded). The
    predicate is on a DATE column, so it reaches the parquet scan."""
    out = df
    if start and start.strip():
        out = out.filter(F.col(date_col) >= F.to_date(F.lit(start.strip())))
    if end and end.strip():
        out = out.filter(F.col(date_col) <= F.to_date(F.lit(end.strip())))
    return out


def check_stations(spark: SparkSession, requested: Sequence[str], known: DataFrame, id_col: str = "station_id") -> None:
    """Raise when a requested id is not in ``known`` (a stations table). The
    request list is a user parameter; the lookup runs as a semi-join."""
    if not requested:
        return
    req = spark.createDataFrame([(s,) for s in requested], f"{id_col} string")
    missing = req.join(known.select(id_col).distinct(), on=id_col, how="left_anti").collect()  # part of the request
    if missing:
        raise UnknownStation(f"Unknown station_id: {', '.join(r[id_col] for r in missing)}")


def scope_stations(df: DataFrame, stations: Sequence[str] | None, id_col: str = "station_id") -> DataFrame:
    """Blank / empty selection = all stations."""
    chosen = [s.strip() for s in (stations or []) if s and s.strip()]
    return df.filter(F.col(id_col).isin(chosen)) if chosen else df
