"""Surrogate keys: unique, stable on update, and dense where rows are numbered by :func:`number_rows`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def max_key(df: DataFrame, sk_col: str) -> int:
    """Largest surrogate key in use (0 for an empty table): one scalar from a
    map-side-combined global aggregate."""
    row = df.agg(F.max(sk_col).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


def assign_new_keys(df: DataFrame, sk_col: str, offset: int) -> DataFrame:
    """Fill NULL ``sk_col`` values with ``offset + 1 + monotonically_increasing_id()``.

    Ids embed the partition index, so they are unique across the cluster
    without a single-partition window. They depend on the row layout and
    must be materialised (written or checkpointed) before being reused.
    """
    fresh = F.lit(offset + 1) + F.monotonically_increasing_id()
    return df.withColumn(sk_col, F.coalesce(F.col(sk_col), fresh))


def carry_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], sk_col: str) -> DataFrame:
    """Source rows with the surrogate key of their matching target row (NULL
    when new). Only keys + sk are read from the target.

    First an inner join finds the target keys that the batch names: either side
    may be built, so a batch that Spark's own size threshold calls small is
    broadcast and the target is only streamed past it. The result is no larger
    than the batch and joins back to it."""
    batch = source.select(*keys)
    matched = target.select(*keys, sk_col).join(batch, on=list(keys), how="inner")
    return source.join(matched, on=list(keys), how="left")


def number_rows(df: DataFrame, sk_col: str, offset: int, buckets: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``sk_col`` = offset + 1, offset + 2, ... in the order of
    ``buckets`` (SQL expressions), then ``order``; without gaps, the same in every run.

    A distributed prefix sum: rows are counted by bucket, the few bucket counts
    are added up in order, and each bucket numbers its own rows from its start. So
    only a bucket's rows meet in one task; choose buckets that stay small."""
    names = [f"_b{i}" for i in range(len(buckets))]
    dealt = df.drop(sk_col).select("*", *[F.expr(b).alias(n) for b, n in zip(buckets, names, strict=True)])
    counts = dealt.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    starts = counts.select(*[F.col(n).alias(f"{n}s") for n in names], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"{n}s"))
    nth = F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    numbered = dealt.withColumn("_nth", nth).join(starts, same)
    return numbered.withColumn(sk_col, (F.lit(offset) + F.col("_before") + F.col("_nth")).cast("bigint")).select(*df.columns)
