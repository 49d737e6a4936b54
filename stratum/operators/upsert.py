"""Keyed upsert (MERGE ... UPDATE SET * / INSERT *) as DataFrame algebra, and the
change feed that falls out of it.

``upsert(target, source, keys)`` = target rows whose key is not in source,
plus every source row. Key equality never matches NULL, as in MERGE, so
NULL-keyed target rows stay and NULL-keyed source rows are inserted.

``merge`` is the same in one full outer join that also tells, for each row, what
it was before and what it is after; ``merged_rows`` and ``changes`` read the new
table and the feed from that one result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateSourceKeys(Exception):
    """Several source rows carry the same (non-NULL) key; MERGE would fail."""


def assert_unique_keys(source: DataFrame, keys: Sequence[str], context: str = "upsert") -> int:
    """Fail on duplicate matchable keys; return the number of source keys
    (both from one aggregation over the keys)."""
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    per_key = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(not_null).alias("matchable")
    )
    row = per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.max(F.when(F.col("matchable") & (F.col("n") > 1), F.struct(*keys))).alias("dup"),
    ).first()
    if row["dup"] is not None:
        raise DuplicateSourceKeys(f"{context}: several source rows match key {row['dup'].asDict()}")
    return int(row["keys"])


def _stamp(target: DataFrame, newest_by: str, side: str = "") -> Column:
    """The time that decides, NULL before any other."""
    floor = F.to_timestamp(F.lit("0001-01-01 00:00:00")).cast(target.schema[newest_by].dataType)
    return F.coalesce(F.col(f"{side}{newest_by}"), floor)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], newest_by: str | None = None) -> DataFrame:
    """Matched target rows are replaced by their source row, unmatched source
    rows inserted, untouched target rows kept.

    With ``newest_by`` (e.g. the ingest time) the newer of the two rows of a key
    survives, whichever side it is on; equal times go to the source. So a late
    run of an older landing changes nothing that a newer one has set. NULL times
    are older than any. The joins ship key columns only; whether they broadcast
    is Spark's decision by size."""
    keys = list(keys)
    if newest_by is None:
        kept = target.join(source.select(*keys), on=keys, how="left_anti")
        return kept.unionByName(source.select(*target.columns), allowMissingColumns=False)
    stamp = _stamp(target, newest_by)
    given = source.select(*keys, stamp.alias("_given"))
    held = target.select(*keys, stamp.alias("_held"))
    kept = target.join(given, on=keys, how="left").where(F.col("_given").isNull() | (F.col("_given") < stamp))
    taken = source.join(held, on=keys, how="left").where(F.col("_held").isNull() | (F.col("_held") <= stamp))
    return kept.select(*target.columns).unionByName(taken.select(*target.columns), allowMissingColumns=False)


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], newest_by: str | None = None) -> DataFrame:
    """(before, after) of every row of the upserted table: equal structs where
    nothing changed, no ``before`` for an insert. A row of the source that loses
    by ``newest_by`` leaves no trace."""
    whole = F.struct(*[F.col(c) for c in target.columns])
    old = target.select(*[F.col(k).alias(f"t_{k}") for k in keys], whole.alias("before"))
    new = source.select(*[F.col(k).alias(f"s_{k}") for k in keys], whole.alias("given"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"t_{k}") == F.col(f"s_{k}"))
    wins = F.col("given").isNotNull()
    if newest_by is not None:
        wins = wins & (F.col("before").isNull() | (_stamp(target, newest_by, "before.") <= _stamp(target, newest_by, "given.")))
    return old.join(new, same, "full_outer").select("before", F.when(wins, F.col("given")).otherwise(F.col("before")).alias("after"))


def merged_rows(merged: DataFrame) -> DataFrame:
    return merged.select("after.*")


def changes(merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The feed: (keys, before, after) of the rows that are not what they were."""
    changed = merged.where(~F.col("before").eqNullSafe(F.col("after")))
    return changed.select(*[F.col(f"after.{k}").alias(k) for k in keys], "before", "after")


def apply_changes(table: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A table brought forward by the feed of a merge into it."""
    replaced = feed.where("before IS NOT NULL").select(*keys)
    return table.join(replaced, list(keys), "left_anti").unionByName(feed.select("after.*"))
