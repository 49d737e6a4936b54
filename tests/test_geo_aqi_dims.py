import datetime as dt
import math
import random

from pyspark.sql import functions as F

from stratum.functions.geo import EARTH_RADIUS_KM
from stratum.operators import aqi, dims, marts
from stratum.operators.nearest import nearest


def _hav(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(d) - math.radians(b)) / 2) ** 2
    return 2 * EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(x)))


def test_nearest_matches_brute_force(spark):
    rnd = random.Random(7)
    refs = [(i, rnd.uniform(-60, 60), rnd.uniform(-180, 180)) for i in range(300)]
    refs += [(1000, 89.9, 10.0), (1001, -89.5, -170.0), (1002, 10.0, 179.99), (1003, 10.0, 179.99)]
    pts = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(400)]
    pts += [(900, 89.99, -170.0), (901, 10.0, -179.99), (902, -90.0, 0.0), (903, 0.0, 180.0)]
    got = {
        r.point_id: r.ref_id
        for r in nearest(
            spark.createDataFrame(pts, "point_id int, lat double, lon double"),
            spark.createDataFrame(refs, "ref_id int, lat double, lon double"),
        ).collect()
    }
    for pid, la, lo in pts:
        best = min(refs, key=lambda r: (round(_hav(la, lo, r[1], r[2]), 6), r[0]))
        assert got[pid] == best[0], pid


def test_aqi_bands(spark):
    readings = spark.createDataFrame(
        [("pm25", 9.05), ("pm25", 35.4), ("pm25", 400.0), ("o3", 0.0555), ("no2", 100.0), ("xx", 1.0)],
        "parameter_name string, value double",
    )
    out = {(r.parameter_name, r.value): (r.aqi, r.aqi_category)
           for r in aqi.with_aqi(readings, aqi.breakpoints(spark)).collect()}
    assert out[("pm25", 9.05)] == (50, "Good")
    assert out[("pm25", 35.4)] == (100, "Moderate")
    assert out[("pm25", 400.0)] == (500, "Hazardous") and out[("xx", 1.0)] == (None, None)
    assert out[("o3", 0.0555)] == (51, "Moderate")
    assert out[("no2", 100.0)][1] == "Moderate"


def test_dominant_category_tie_goes_to_worse(spark):
    ts = dt.datetime(2024, 1, 1, 5)
    r = spark.createDataFrame(
        [(1, ts, "Good", 1), (1, ts, "Moderate", 2), (2, ts, "Good", 1), (2, ts, "Good", 1), (2, ts, "Unhealthy", 4)],
        "city_id bigint, observation_timestamp timestamp, aqi_category string, aqi_severity int",
    )
    out = {x.city_id: x.dominant_aqi_category for x in marts.dominant_category(r).collect()}
    assert out == {1: "Moderate", 2: "Good"}


def test_date_dimension_iso_weeks(spark):
    bounds = spark.createDataFrame([(dt.date(2024, 2, 26), dt.date(2024, 3, 4))], "start date, end date")
    rows = {r.full_date: r for r in dims.date_dimension_between(bounds).collect()}
    assert len(rows) == 8
    assert rows[dt.date(2024, 2, 26)].day_of_week == 1 and rows[dt.date(2024, 2, 26)].day_name == "Monday"
    assert rows[dt.date(2024, 3, 3)].is_weekend and rows[dt.date(2024, 2, 29)].date_sk == 20240229
    assert rows[dt.date(2024, 3, 1)].quarter == 1 and rows[dt.date(2024, 3, 1)].month_name == "March"


def test_daily_summary_edges(spark):
    rows = [
        (1, dt.datetime(2024, 1, 1, 23, 59), 10.0, 1.0, 5.0),
        (1, dt.datetime(2024, 1, 2, 0, 0), None, 2.0, 5.0),
        (7, dt.datetime(2024, 1, 2, 0, 1), 3.0, None, None),
    ]
    silver = spark.createDataFrame(
        rows, "city_id bigint, observation_timestamp timestamp, temperature_c double, precipitation_mm double, "
              "wind_speed_10m_kmh double")
    lookup = spark.createDataFrame([(1, "One")], "city_id bigint, city_name string")
    out = {(r.city_id, r.obs_date): r for r in marts.daily_city_summary(silver, lookup).collect()}
    assert len(out) == 3
    assert out[(1, dt.date(2024, 1, 2))].avg_temp_c is None and out[(1, dt.date(2024, 1, 2))].row_count == 1
    assert out[(7, dt.date(2024, 1, 2))].city_name is None
    assert out[(1, dt.date(2024, 1, 1))].total_precip_mm == 1.0


def test_nearest_sparse_refs_reach_band_and_globe_levels(spark):
    rnd = random.Random(3)
    refs = [(1, 0.0, 0.0), (2, 80.0, 100.0), (3, -85.0, -60.0)]
    pts = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(60)] + [(99, 90.0, 0.0)]
    got = {
        r.point_id: r.ref_id
        for r in nearest(
            spark.createDataFrame(pts, "point_id int, lat double, lon double"),
            spark.createDataFrame(refs, "ref_id int, lat double, lon double"),
        ).collect()
    }
    assert len(got) == len(pts)
    for pid, la, lo in pts:
        assert got[pid] == min(refs, key=lambda r: (round(_hav(la, lo, r[1], r[2]), 6), r[0]))[0]


def test_nearest_branch_and_bound_is_exact(spark):
    rnd = random.Random(11)
    # clustered references (one region) and points all over the sphere
    refs = [(i, rnd.uniform(40, 60), rnd.uniform(-10, 30)) for i in range(200)]
    refs += [(500 + i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(20)]
    pts = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(150)] + [(998, -90.0, 10.0), (999, 0.0, 180.0)]
    got = {
        r.point_id: r.ref_id
        for r in nearest(
            spark.createDataFrame(pts, "point_id int, lat double, lon double"),
            spark.createDataFrame(refs, "ref_id int, lat double, lon double"),
        ).collect()
    }
    assert len(got) == len(pts)
    for pid, la, lo in pts:
        assert got[pid] == min(refs, key=lambda r: (round(_hav(la, lo, r[1], r[2]), 6), r[0]))[0], pid


def test_aqi_units_and_open_top(spark):
    rows = [("o3", "ppm", 0.3), ("o3", "ppb", 300.0), ("o3", "ppm", 0.7), ("o3", "furlong", 0.01), ("co", "ppm", 60.0), ("pm25", "µg/m³", -1.0),
            ("no2", "ppm", 0.1), ("pm10", None, 10.0)]
    df = spark.createDataFrame(rows, "parameter_name string, parameter_units string, value double")
    out = [(r.aqi, r.aqi_category) for r in aqi.with_aqi(df, aqi.breakpoints(spark)).collect()]
    got = {(r.parameter_name, r.parameter_units): (r.aqi, r.aqi_category) for r in aqi.with_aqi(df.where("value <> 0.7"), aqi.breakpoints(spark)).collect()}
    assert got["o3", "ppm"] == got["o3", "ppb"] == (300, "Very Unhealthy")
    assert (500, "Hazardous") in out and got["co", "ppm"] == (500, "Hazardous") and got["no2", "ppm"] == (100, "Moderate")
    assert got["o3", "furlong"] == got["pm25", "µg/m³"] == got["pm10", None] == (None, None)


def test_nearest_runs_no_job_while_built_and_persists_nothing(spark):
    from stratum.operators.nearest import refresh

    rnd = random.Random(2)
    places = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(40)]
    df = spark.createDataFrame(places, "ref_id int, lat double, lon double")
    points = df.withColumnRenamed("ref_id", "point_id")
    spark.sparkContext.setJobGroup("building", "no job may run here")
    found = nearest(points, df)
    refresh(found, points, df, df)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("building") == []
    spark.sparkContext.setJobGroup("other", "")
    assert {r.point_id: r.ref_id for r in found.collect()} == {i: i for i, _, _ in places}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_refresh_equals_a_full_search(spark):
    from stratum.operators.nearest import refresh

    rnd = random.Random(9)
    place = lambda: (rnd.uniform(-90, 90), rnd.uniform(-180, 180))
    dense = lambda: (50 + rnd.random() / 50, 10 + rnd.random() / 50)
    before = [(i, *(dense() if i % 3 else place())) for i in range(400)]
    after = [(i, *(place() if i % 11 == 0 else (la, lo))) for i, la, lo in before if i % 7] + [(500 + i, *place()) for i in range(30)]
    after += [(900, *before[1][1:]), (-5, *before[2][1:]), (901, None, 1.0), (902, float("nan"), 1.0)]  # equal places, no places
    points = [(i, *(dense() if i % 2 else place())) for i in range(250)] + [(600, *before[2][1:]), (601, 90.0, 0.0), (602, -90.0, 5.0), (603, None, None)]
    moved = [(i, *(place() if i % 13 == 0 else (la, lo))) for i, la, lo in points if i % 17] + [(700 + i, *place()) for i in range(20)]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} int, lat double, lon double")
    one, two = frame(before, "ref_id"), frame(after, "ref_id")
    kept = refresh(nearest(frame(points, "point_id"), one), frame(moved, "point_id"), one, two)
    usable = [r for r in after if r[1] is not None and not math.isnan(r[1])]
    want = {i: min(usable, key=lambda r: (round(_hav(la, lo, r[1], r[2]), 6), r[0]))[0] for i, la, lo in moved if la is not None}
    assert {r.point_id: r.ref_id for r in kept.collect()} == want
    assert nearest(frame(points, "point_id"), two.where("ref_id > 9999")).collect() == []
