"""Mergeable partial states of aggregates, kept from a change feed.

A state row holds, for one group, what its means, sums, extremes and counts are
made of: the number of rows, for each summed column its count and exact decimal
sum, for each extreme column least and greatest value, and for each counted
column one row a value in a table of its own. A feed's old rows are taken off and
its new rows added, so a mart reads states and never the rows behind them.

Sums and counts can be taken back exactly. An extreme cannot: when the row that
held it goes and no new row is at least as extreme, the group is stale, and only
stale groups are aggregated anew from the table as it is now.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StateSpec:
    """Group keys (name -> SQL expression), columns to sum, columns with extremes.
    Values are summed as DECIMAL(28, scale)."""

    keys: tuple[tuple[str, str], ...]
    sums: tuple[str, ...] = ()
    extremes: tuple[str, ...] = ()
    scale: int = 10

    @property
    def key_names(self) -> list[str]:
        return [name for name, _ in self.keys]

    @property
    def columns(self) -> list[str]:
        per_sum = [f"{p}_{c}" for c in self.sums for p in ("n", "sum")]
        return [*self.key_names, "row_count", *per_sum, *[f"{p}_{c}" for c in self.extremes for p in ("min", "max")]]

    def exact(self, column: str) -> Column:
        return F.col(column).cast(f"decimal(28,{self.scale})")


def _keyed(rows: DataFrame, spec: StateSpec, *more: str) -> DataFrame:
    wanted = dict.fromkeys([*spec.sums, *spec.extremes, *more])
    return rows.select(*[F.expr(e).alias(n) for n, e in spec.keys], *[F.col(c).alias(f"v_{c}") for c in wanted])


def states_of(rows: DataFrame, spec: StateSpec) -> DataFrame:
    """The states of a whole table: one aggregation, combined map-side."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for c in spec.sums:
        aggs += [F.count(f"v_{c}").alias(f"n_{c}"), F.sum(spec.exact(f"v_{c}")).cast(f"decimal(38,{spec.scale})").alias(f"sum_{c}")]
    for c in spec.extremes:
        aggs += [F.min(f"v_{c}").alias(f"min_{c}"), F.max(f"v_{c}").alias(f"max_{c}")]
    return _keyed(rows, spec).groupBy(*spec.key_names).agg(*aggs)


def _signed(feed: DataFrame) -> DataFrame:
    """The feed's new rows (sign 1) and old rows (sign -1)."""
    both = F.array(F.struct(F.lit(1).alias("sign"), F.col("after").alias("row")), F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")))
    return feed.select(F.inline(both)).where("row IS NOT NULL").select("sign", "row.*")


def deltas(feed: DataFrame, spec: StateSpec) -> DataFrame:
    """What the feed adds to each touched group: signed counts and sums, extremes
    of the new rows (``add_``) and of the old ones (``off_``)."""
    rows = _signed(feed)
    keyed = rows.select("sign", *[F.expr(e).alias(n) for n, e in spec.keys], *[F.col(c).alias(f"v_{c}") for c in dict.fromkeys([*spec.sums, *spec.extremes])])
    aggs = [F.sum("sign").alias("d_row_count")]
    for c in spec.sums:
        aggs += [F.sum(F.when(F.col(f"v_{c}").isNotNull(), F.col("sign")).otherwise(0)).alias(f"d_n_{c}"),
                 # a product with the sign would cost a decimal place
                 F.coalesce(F.sum(F.when(F.col("sign") > 0, spec.exact(f"v_{c}")).otherwise(-spec.exact(f"v_{c}"))), F.lit(0)).cast(f"decimal(38,{spec.scale})").alias(f"d_sum_{c}")]
    for c in spec.extremes:
        for name, sign in (("add", 1), ("off", -1)):
            aggs += [F.min(F.when(F.col("sign") == sign, F.col(f"v_{c}"))).alias(f"{name}_min_{c}"),
                     F.max(F.when(F.col("sign") == sign, F.col(f"v_{c}"))).alias(f"{name}_max_{c}")]
    return keyed.groupBy(*spec.key_names).agg(*aggs)


def advance(states: DataFrame, feed: DataFrame, rows_now: DataFrame, spec: StateSpec) -> DataFrame:
    """The new states of the groups that ``feed`` touches, with ``row_count`` 0
    where a group has lost all rows. ``rows_now``: the table after the feed, read
    for stale groups only (prune it to their partitions)."""
    keys = spec.key_names
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}"))
    both = deltas(feed, spec).alias("d").join(states.alias("s"), same, "left")
    out = [F.col(f"d.{k}").alias(k) for k in keys] + [(F.coalesce("s.row_count", F.lit(0)) + F.col("d_row_count")).alias("row_count")]
    for c in spec.sums:
        out += [(F.coalesce(f"s.n_{c}", F.lit(0)) + F.col(f"d_n_{c}")).alias(f"n_{c}")]
        whole = f"decimal(38,{spec.scale})"
        # the sum of two such decimals would lose a place as well
        total = F.coalesce(F.expr(f"try_cast(s.sum_{c} AS decimal(37,{spec.scale}))"), F.lit(0).cast(f"decimal(37,{spec.scale})")) + F.col(
            f"d_sum_{c}").cast(f"decimal(37,{spec.scale})")
        total = total.cast(whole)
        out += [F.when(F.coalesce(f"s.n_{c}", F.lit(0)) + F.col(f"d_n_{c}") > 0, total).alias(f"sum_{c}")]
    stale = F.lit(False)
    for c in spec.extremes:
        for p, best, beaten in (("min", F.least, F.col(f"off_min_{c}") <= F.col(f"s.min_{c}")), ("max", F.greatest, F.col(f"off_max_{c}") >= F.col(f"s.max_{c}"))):
            held, added = F.col(f"s.{p}_{c}"), F.col(f"add_{p}_{c}")
            enough = added <= held if p == "min" else added >= held
            out.append(best(held, added).alias(f"{p}_{c}"))  # NULLs are skipped
            stale = stale | (F.coalesce(beaten, F.lit(False)) & ~F.coalesce(enough, F.lit(False)))
    moved = both.select(*out, stale.alias("_stale"))
    again = moved.where("_stale AND row_count > 0").select(*keys)
    fresh = rows_now.select(*[F.expr(e).alias(f"_{n}") for n, e in spec.keys], *dict.fromkeys([*spec.sums, *spec.extremes]))
    for k in keys:
        again = again.withColumnRenamed(k, f"k_{k}")
    hit = F.lit(True)
    for k in keys:
        hit = hit & F.col(f"_{k}").eqNullSafe(F.col(f"k_{k}"))
    anew = states_of(fresh.join(again, hit, "left_semi"), StateSpec(tuple((k, f"_{k}") for k in keys), spec.sums, spec.extremes, spec.scale))
    return moved.where("NOT _stale OR row_count <= 0").select(*spec.columns).unionByName(anew.select(*spec.columns))


def advanced(states: DataFrame, feed: DataFrame, rows_now: DataFrame, spec: StateSpec) -> DataFrame:
    """All states after the feed."""
    keys = spec.key_names
    touched = advance(states, feed, rows_now, spec)
    marked = touched.select(*[F.col(k).alias(f"k_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"k_{k}"))
    return states.select(*spec.columns).join(marked, same, "left_anti").unionByName(touched.where("row_count > 0"))


def counts_of(rows: DataFrame, spec: StateSpec, by: Sequence[str]) -> DataFrame:
    """(keys, by, n): counts of each value, NULL values left out."""
    return _keyed(rows, spec, *by).groupBy(*spec.key_names, *[F.col(f"v_{b}").alias(b) for b in by]).agg(F.count(F.lit(1)).alias("n")).where(
        f"{by[0]} IS NOT NULL")


def counts_advanced(counts: DataFrame, feed: DataFrame, spec: StateSpec, by: Sequence[str]) -> DataFrame:
    """Counts after the feed: signed sums, values that nobody has any more go."""
    rows = _signed(feed)
    moved = rows.select(F.col("sign").cast("long").alias("n"), *[F.expr(e).alias(n) for n, e in spec.keys], *by).where(f"{by[0]} IS NOT NULL")
    names = [*spec.key_names, *by]
    both = counts.select(*names, "n").unionByName(moved.select(*names, "n"))
    return both.groupBy(*names).agg(F.sum("n").alias("n")).where("n <> 0")


def mean(column: str) -> Column:
    """The mean that a state holds, as a double."""
    return F.try_divide(F.col(f"sum_{column}").cast("double"), F.col(f"n_{column}").cast("double"))


def total(column: str) -> Column:
    return F.col(f"sum_{column}").cast("double")
