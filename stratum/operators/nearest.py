"""Exact nearest reference point (great-circle) per point, and a kept index of it.

Points and references stand on the unit sphere in a cube that is halved along
each axis level by level, so there are neither poles nor a date line to care
for, and the chord between two points grows with their great-circle distance.
The cell tree is as deep as the references are dense: a cell is split as long as
it holds more than ``CAPACITY`` of them. The search is made of equi-joins on cell
keys:

1. a point meets the cells on its own way down the tree; the nearest of their
   representatives bounds the distance from above;
2. the ball of that radius lies in at most eight cells of the level whose side is
   at least its diameter; the representatives of the cells below these tighten
   the bound;
3. the references in the cells that the tighter ball touches hold the nearest.

No step pairs a point with all references, none runs a job while the plan is
built, and nothing is persisted.

:func:`refresh` keeps a table of points with their nearest reference. References
that came or moved can only matter to points whose stored distance they beat:
these are found by the same ball join, from the changed references alone. Points
that are new, or whose reference went or moved, are searched anew; all others keep
their row.

Ties: smallest distance rounded to 1e-6 km, then smallest reference id.
References sharing a coordinate are first reduced to the smallest id. Points and
references without coordinates (null or NaN) take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.geo import EARTH_RADIUS_KM, haversine_km

CAPACITY = 16  # references in a cell that is not split
DEPTH = 12  # levels of halving: cells of some 3 km
BELOW = 2  # levels by which the cells of a ball are refined
_BITS = 16  # of a cell's number on an axis
_POINT = ["p_id", "p_lat", "p_lon"]
_SLACK_KM = 1e-5  # more than what rounding of distances can hide


def _on_sphere(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """``df`` with x, y, z and the numbers of the finest cell on the three axes."""
    out = df.selectExpr("*", f"cos(radians({lat})) AS r").selectExpr(
        "*", f"r * cos(radians({lon})) AS x", f"r * sin(radians({lon})) AS y", f"sin(radians({lat})) AS z").drop("r")
    return out.selectExpr("*", *[f"{_number(a)} AS c{a}" for a in "xyz"])


def _number(axis: str) -> str:
    """Number of the finest cell on an axis; the cube is [-1, 1]. A coarser cell's
    number is this one without its last bits."""
    return f"least(greatest(bigint(floor(({axis} + 1D) * {1 << (DEPTH - 1)}D)), 0L), {(1 << DEPTH) - 1}L)"


def _key(level: str, x: str = "cx", y: str = "cy", z: str = "cz") -> str:
    return f"shiftleft(bigint({level}), {3 * _BITS}) + shiftleft({x}, {2 * _BITS}) + shiftleft({y}, {_BITS}) + {z}"


def _key_at(level: str) -> str:
    return _key(level, *(f"shiftright(c{a}, {DEPTH} - ({level}))" for a in "xyz"))


def _chord(km: str) -> str:
    """Chord of a distance, a little longer than rounding could make it."""
    return f"(2D * sin(least(({km} + {_SLACK_KM}D) / {2 * EARTH_RADIUS_KM}D, pi() / 2)) + 1e-12D)"


def _ball(df: DataFrame, km: str, below: int = 0) -> DataFrame:
    """Each point once for each of the at most eight cells (``key``) that the ball of
    radius ``km`` around it lies in, of the finest level that has such cells and
    ``below`` further ones."""
    chord = _chord(km)
    sized = df.selectExpr(*df.columns, f"{chord} AS chord").selectExpr("*", f"int(least(greatest(floor(-log2(chord)), 0), {DEPTH - below})) AS level")
    ends = [f"shiftright({_number(f'({a} {sign} chord)')}, {DEPTH} - level) AS {side}{a}" for a in "xyz" for sign, side in ("-l", "+h")]
    cells = sized.selectExpr(*_POINT, "km", "level", *ends)
    for a in "xyz":
        cells = cells.selectExpr("*", f"explode(sequence(l{a}, h{a})) AS n{a}")
    return cells.selectExpr(*_POINT, "km", f"{_key('level', 'nx', 'ny', 'nz')} AS key")


def _levels(df: DataFrame) -> DataFrame:
    """Each row once for each level, with its cell there."""
    return df.selectExpr("*", f"explode(sequence(0, {DEPTH})) AS level").selectExpr("*", f"{_key_at('level')} AS key")


def _prepared(refs: DataFrame, ref_cols: Sequence[str]) -> DataFrame:
    rid, lat, lon = ref_cols
    return _on_sphere(refs.select(F.col(rid).alias("r_id"), F.col(lat).cast("double").alias("r_lat"), F.col(lon).cast("double").alias("r_lon"))
                      .where("r_id IS NOT NULL AND NOT isnan(coalesce(r_lat, double('NaN'))) AND NOT isnan(coalesce(r_lon, double('NaN')))")
                      .groupBy("r_lat", "r_lon").agg(F.min("r_id").alias("r_id")), "r_lat", "r_lon")


def cell_tree(refs: DataFrame) -> DataFrame:
    """(key, above, above_2, n, rep) of the cells whose parent holds more than
    ``CAPACITY`` references (and the first one); ``rep`` is one of its references."""
    cells = _levels(refs).groupBy("key", "level").agg(F.count("*").alias("n"), F.min(F.struct("r_id", "r_lat", "r_lon", "cx", "cy", "cz")).alias("rep"))
    placed = cells.selectExpr("key", "level", "n", "rep", "rep.cx AS cx", "rep.cy AS cy", "rep.cz AS cz").selectExpr(
        "key", "level", "n", "rep", f"{_key_at('greatest(level - 1, 0)')} AS above", f"{_key_at(f'greatest(level - {BELOW}, 0)')} AS above_2")
    whole = Window.partitionBy("above", "level")  # at most the eight children of a cell
    return placed.withColumn("in_parent", F.sum("n").over(whole)).where(f"level = 0 OR in_parent > {CAPACITY}").drop("in_parent")


def _km(ref: str = "") -> Column:
    return haversine_km(F.col("p_lat"), F.col("p_lon"), F.col(f"{ref}r_lat"), F.col(f"{ref}r_lon"))


def _bounded(candidates: DataFrame) -> DataFrame:
    """The least distance to the representatives met, by point."""
    return _on_sphere(candidates.groupBy(*_POINT).agg(F.min("km").alias("km")), "p_lat", "p_lon")


def _best(pairs: DataFrame) -> DataFrame:
    km = _km()
    best = F.min(F.struct(F.round(km, 6).alias("k"), F.col("r_id"), km.alias("km"))).alias("b")
    return pairs.groupBy(*_POINT).agg(best).selectExpr(*_POINT, "b.r_id", "b.km")


def _search(points: DataFrame, refs: DataFrame) -> DataFrame:
    tree = cell_tree(refs)
    way = _levels(_on_sphere(points, "p_lat", "p_lon")).select(*_POINT, "key")
    first = _bounded(way.join(tree.select("key", "rep"), "key").withColumn("km", _km("rep.")))
    finer = tree.where(f"level >= {BELOW}").select(F.col("above_2").alias("key"), "rep")
    met = _ball(first, "km", BELOW).join(finer, "key").withColumn("km", F.least("km", _km("rep.")))
    second = _bounded(met.select(*_POINT, "km").unionByName(first.select(*_POINT, "km")))
    return _best(_ball(second, "km").select(*_POINT, "key").join(_levels(refs).select("key", "r_id", "r_lat", "r_lon"), "key"))


def _points(points: DataFrame, point_cols: Sequence[str]) -> DataFrame:
    pid, lat, lon = point_cols
    return points.select(F.col(pid).alias("p_id"), F.col(lat).cast("double").alias("p_lat"), F.col(lon).cast("double").alias("p_lon")).where(
        "NOT isnan(coalesce(p_lat, double('NaN'))) AND NOT isnan(coalesce(p_lon, double('NaN')))").distinct()


def _named(found: DataFrame, point_cols: Sequence[str], rid: str) -> DataFrame:
    pid, lat, lon = point_cols
    return found.select(F.col("p_id").alias(pid), F.col("p_lat").alias(lat), F.col("p_lon").alias(lon), F.col("r_id").alias(rid),
                        F.col("km").alias("distance_km"))


def nearest(points: DataFrame, refs: DataFrame, point_cols: Sequence[str] = ("point_id", "lat", "lon"),
            ref_cols: Sequence[str] = ("ref_id", "lat", "lon")) -> DataFrame:
    """(point_id, lat, lon, ref_id, distance_km) for every point with coordinates
    (named as in ``point_cols`` / ``ref_cols``); no rows without references."""
    return _named(_search(_points(points, point_cols), _prepared(refs, ref_cols)), point_cols, ref_cols[0])


def refresh(index: DataFrame, points: DataFrame, refs_before: DataFrame, refs_after: DataFrame,
            point_cols: Sequence[str] = ("point_id", "lat", "lon"), ref_cols: Sequence[str] = ("ref_id", "lat", "lon")) -> DataFrame:
    """``index`` (a result of :func:`nearest` for ``refs_before``) brought to
    ``points`` and ``refs_after``: equal to a full search, at the cost of the
    changes. Points that ``points`` no longer has go; pass the index's own points to
    keep them."""
    pid, lat, lon = point_cols
    rid = ref_cols[0]
    now = _points(points, point_cols)
    held = index.select(F.col(pid).alias("p_id"), F.col(lat).alias("p_lat"), F.col(lon).alias("p_lon"), F.col(rid).alias("r_id"),
                        F.col("distance_km").alias("km"))
    before, after = _prepared(refs_before, ref_cols), _prepared(refs_after, ref_cols)
    same = ["r_id", "r_lat", "r_lon"]
    came = after.join(before.select(*same), same, "left_anti")
    gone = before.join(after.select(*same), same, "left_anti").select("r_id")
    kept = now.join(held, _POINT).join(gone, "r_id", "left_anti").select(*_POINT, "r_id", "km")
    # a reference that came matters where it beats the stored distance
    rivals = _ball(_on_sphere(kept, "p_lat", "p_lon"), "km").select(*_POINT, "key").join(_levels(came).select("key", "r_id", "r_lat", "r_lon"), "key")
    stored = F.struct(F.round("km", 6).alias("k"), F.col("r_id"), F.col("km"))
    better = _best(rivals.select(*_POINT, "r_id", "r_lat", "r_lon"))
    settled = kept.unionByName(better).groupBy(*_POINT).agg(F.min(stored).alias("b")).selectExpr(*_POINT, "b.r_id", "b.km")
    anew = _search(now.join(kept.select(*_POINT), _POINT, "left_anti"), after)
    return _named(settled.unionByName(anew), point_cols, rid)
