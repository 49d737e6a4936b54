"""Slowly changing dimension, type 2.

A snapshot is compared with the current rows of the dimension on tracked
attributes (NULL-safe). New keys open a version; changed keys close the
current version and open a new one at the same timestamp; unchanged keys and
keys missing from the snapshot are left as they are. Closed history is
carried through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.keys import max_key

START, END, CURRENT = "effective_start_ts", "effective_end_ts", "is_current"


def _changed(tracked: Sequence[str], s: str = "s", c: str = "c") -> Column:
    cond = F.lit(False)
    for a in tracked:
        cond = cond | ~F.col(f"{s}.{a}").eqNullSafe(F.col(f"{c}.{a}"))
    return cond


def scd2_changes(
    current: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str]
) -> DataFrame:
    """Snapshot rows that are new or differ from the current row on a
    tracked attribute (``NOT (s.a <=> c.a)``)."""
    cur = current.select(key, *tracked).withColumn("_has_current", F.lit(True))
    joined = snapshot.alias("s").join(cur.alias("c"), on=key, how="left")
    return joined.where(F.col("_has_current").isNull() | _changed(tracked)).select(
        *[F.col(key) if c == key else F.col(f"s.{c}").alias(c) for c in snapshot.columns]
    )


def scd2_apply(
    dim: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    ts: Column,
    sk_col: str | None = None,
    sk_offset: int | None = None,
) -> DataFrame:
    """The whole dimension after applying ``snapshot`` at time ``ts``.

    One full outer join of current rows and the snapshot; each joined row
    emits its current version (closed if changed, else as is) and, when new
    or changed, the opened version — both from the same row via ``inline``,
    so the join is computed once. History rows bypass the join.
    """
    attrs = [c for c in snapshot.columns if c != key]
    dim_cols = dim.columns
    history = dim.filter(~F.col(CURRENT))
    current = dim.filter(F.col(CURRENT))

    cur = current.select(*[F.col(c).alias(f"c_{c}") for c in dim_cols]).withColumn("_c", F.lit(True))
    snap = snapshot.select(*[F.col(c).alias(f"s_{c}") for c in snapshot.columns]).withColumn("_s", F.lit(True))
    j = cur.join(snap, F.col(f"c_{key}") == F.col(f"s_{key}"), "full_outer")

    changed = F.lit(False)
    for a in tracked:
        changed = changed | ~F.col(f"s_{a}").eqNullSafe(F.col(f"c_{a}"))
    has_c, has_s = F.col("_c").isNotNull(), F.col("_s").isNotNull()
    close = has_c & has_s & changed
    opened = has_s & (~has_c | changed)

    def cur_field(c: str) -> Column:
        if c == END:
            return F.when(close, ts).otherwise(F.col(f"c_{END}"))
        if c == CURRENT:
            return F.when(close, F.lit(False)).otherwise(F.col(f"c_{CURRENT}"))
        return F.col(f"c_{c}")

    def new_field(c: str) -> Column:
        if c == key:
            return F.col(f"s_{key}")
        if c in attrs:
            return F.col(f"s_{c}")
        if c == START:
            return ts
        if c == END:
            return F.lit(None)
        if c == CURRENT:
            return F.lit(True)
        return F.lit(None)  # surrogate key, filled below

    types = dict(dim.dtypes)
    cur_row = F.struct(*[cur_field(c).cast(types[c]).alias(c) for c in dim_cols])
    new_row = F.struct(*[new_field(c).cast(types[c]).alias(c) for c in dim_cols])
    rows = F.array_compact(
        F.array(F.when(has_c, cur_row), F.when(opened, new_row))
    )
    versions = j.select(F.inline(rows))
    if sk_col:
        offset = max_key(dim, sk_col) if sk_offset is None else sk_offset
        fresh = F.lit(offset + 1) + F.monotonically_increasing_id()
        versions = versions.withColumn(sk_col, F.coalesce(F.col(sk_col), fresh))
    return history.unionByName(versions.select(*dim_cols))


def scd2_history(dim: DataFrame, snapshots: DataFrame, key: str, tracked: Sequence[str], snapshot_ts: str, sk_col: str | None = None,
                 sk_offset: int = 0) -> DataFrame:
    """The whole dimension after any number of snapshots at once, in the order of
    their time ``snapshot_ts``, late ones among them.

    Versions and snapshot rows of a key are events in time. An event opens a
    version when it differs from the event before it on a tracked attribute
    (gaps and islands); a version ends where the next one opens, so the versions
    of a key abut. A snapshot between two versions splits the one it falls into;
    a version that then only repeats the spliced one becomes part of it. A version
    keeps its surrogate key (the first of an island that has one); new ones are
    numbered from ``sk_offset`` + 1 without gaps.

    Keys that a snapshot misses stay as they are. Where a snapshot has the time of
    a version, the version stands. Of rows that repeat a key and a time the one
    that sorts first counts. Snapshots without time, and rows without key, take no
    part. A key's events meet in one task: they are as many as its versions and the
    snapshots given.
    """
    from stratum.operators.dedup import one_per_key
    from stratum.operators.keys import number_rows

    attrs = [c for c in dim.columns if c not in (START, END, CURRENT, sk_col, key)]
    keep = [key, *attrs]
    start_type = dict(dim.dtypes)[START]
    held = dim.select(*keep, F.col(START).alias("_at"), (F.col(sk_col) if sk_col else F.lit(None).cast("bigint")).alias("_sk"), F.lit(0).alias("_new"))
    known = F.col(snapshot_ts).isNotNull() & F.col(key).isNotNull()
    given = one_per_key(snapshots.where(known).select(*keep, F.col(snapshot_ts).cast(start_type).alias("_at")), [key, "_at"])
    events = held.unionByName(given.withColumns({"_sk": F.lit(None).cast("bigint"), "_new": F.lit(1)}))
    in_time = Window.partitionBy(key).orderBy("_at", "_new")
    state = F.struct(*tracked)
    last = F.lag(F.struct(state.alias("state"), F.col("_at").alias("at"))).over(in_time)
    same_time = (F.col("_new") == 1) & (F.col("_last.at") == F.col("_at"))
    marked = events.withColumn("_last", last).where(~F.coalesce(same_time, F.lit(False)))
    opens = F.col("_last").isNull() | ~state.eqNullSafe(F.col("_last.state"))
    islands = marked.withColumn("_opens", opens).withColumn("_island", F.sum(F.col("_opens").cast("int")).over(in_time))
    whole = Window.partitionBy(key, "_island").orderBy("_at", "_new").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    versions = islands.withColumn("_sk", F.first("_sk", ignorenulls=True).over(whole)).where("_opens")
    end = F.lead("_at").over(Window.partitionBy(key).orderBy("_at"))
    dated = versions.withColumn("_end", end).select(
        F.col("_sk"), *keep, F.col("_at").alias(START), F.col("_end").alias(END), F.col("_end").isNull().alias(CURRENT))
    if sk_col is None:
        return dated.select(*dim.columns)
    dated = dated.withColumnRenamed("_sk", sk_col).select(*dim.columns)
    fresh = number_rows(dated.where(F.col(sk_col).isNull()), sk_col, sk_offset, [f"pmod(xxhash64({key}), 256)"], [key, START])
    return dated.where(F.col(sk_col).isNotNull()).unionByName(fresh)


def empty_dim_like(snapshot: DataFrame, key: str, sk_col: str | None, ts_type: str = "timestamp") -> DataFrame:
    """An empty dimension with the snapshot's attributes plus SCD2 columns."""
    cols = []
    if sk_col:
        cols.append(F.lit(None).cast("bigint").alias(sk_col))
    cols += [F.col(c) for c in snapshot.columns]
    cols += [
        F.lit(None).cast(ts_type).alias(START),
        F.lit(None).cast(ts_type).alias(END),
        F.lit(None).cast("boolean").alias(CURRENT),
    ]
    return snapshot.select(*cols).limit(0)


def current_rows(dim: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The current-version view (``is_current = true``), optionally projected."""
    cur = dim.filter(F.col(CURRENT))
    return cur.select(*columns) if columns else cur.drop(START, END, CURRENT)
