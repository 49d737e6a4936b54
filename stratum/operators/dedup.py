"""Latest-wins deduplication and one-row-per-key selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_rn"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (e.g. newest ingest).

    ``row_number() ... = 1`` lets Catalyst plan a partial ``WindowGroupLimit``
    on the map side: each input partition forwards at most one row per key
    into the shuffle, so a key holding a third of all rows costs one row per
    map task, not a third of the data in one reducer. Pass tie-break columns
    after the primary order so the survivor is deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_ingested(df: DataFrame, keys: Sequence[str], tie_breaks: Sequence[str] = ()) -> DataFrame:
    """Newest ``_ingested_at`` per key, ties broken by ``tie_breaks`` desc."""
    order = [F.col("_ingested_at").desc_nulls_last()] + [
        F.col(c).desc_nulls_last() for c in tie_breaks
    ]
    return latest_per_key(df, keys, order)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deterministic keyed distinct: the row whose remaining columns sort
    first (ascending, NULLs first) survives."""
    rest = [c for c in df.columns if c not in keys]
    return latest_per_key(df, keys, [F.col(c).asc_nulls_first() for c in rest])


def latest_run(df: DataFrame, run_col: str = "_ingestion_run_id", ts_col: str = "_ingested_at") -> DataFrame:
    """Rows of the run with the newest ``ts_col`` (ties: greatest run id).

    The run is found with a global aggregate (one row) and applied with a
    broadcast semi-join of that single row, so no value travels through the
    driver. An empty input yields an empty output.
    """
    newest = df.agg(F.max(F.struct(F.col(ts_col), F.col(run_col))).alias("_m")).select(
        F.col(f"_m.{run_col}").alias(run_col)
    )
    return df.join(F.broadcast(newest), on=run_col, how="left_semi")
