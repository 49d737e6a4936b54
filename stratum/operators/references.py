"""Does a row's key exist elsewhere? As a flag (for rules) or as a filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_reference_flag(df: DataFrame, column: str, known: DataFrame, flag: str) -> DataFrame:
    """Add a boolean that says whether ``column`` occurs in ``known`` (which has
    a column of that name). Keys are made unique first, so no row doubles; a
    NULL key is in no table. Spark decides from its size whether ``known`` is
    broadcast."""
    keys = known.groupBy(column).agg(F.lit(True).alias(flag))
    return df.join(keys, column, "left").select(*df.columns, F.coalesce(flag, F.lit(False)).alias(flag))


def only_referenced(df: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """Rows whose ``column`` occurs in ``known``."""
    return df.join(known.select(column), column, "left_semi")
