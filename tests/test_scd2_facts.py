import datetime as dt

from pyspark.sql import functions as F

from stratum.operators import facts, scd2

TRACKED = ["pop", "tz"]
T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (1, 8, 15))


def snap(spark, rows):
    return spark.createDataFrame(rows, "city_id bigint, name string, pop bigint, tz string")


def apply(dim, s, ts):
    return scd2.scd2_apply(dim, s, "city_id", TRACKED, F.lit(ts).cast("timestamp"), sk_col="sk")


def test_scd2_lifecycle(spark):
    s1 = snap(spark, [(1, "A", 10, "z1"), (2, "B", None, "z2"), (3, "C", 30, "z3")])
    dim = apply(scd2.empty_dim_like(s1, "city_id", "sk"), s1, T1).cache()
    assert dim.count() == 3 and dim.filter("is_current").count() == 3
    # 1 unchanged but renamed (untracked), 2 NULL -> value (tracked), 3 missing, 4 new
    s2 = snap(spark, [(1, "A2", 10, "z1"), (2, "B", 20, "z2"), (4, "D", 40, "z4")])
    dim2 = apply(dim, s2, T2).cache()
    rows = {(r.city_id, r.is_current): r for r in dim2.collect()}
    assert len(rows) == 5
    assert rows[(1, True)].name == "A" and rows[(1, True)].effective_start_ts == T1
    assert rows[(2, False)].effective_end_ts == T2 and rows[(2, True)].effective_start_ts == T2
    assert rows[(2, True)].pop == 20
    assert rows[(3, True)].effective_end_ts is None
    assert rows[(4, True)].effective_start_ts == T2
    # at most one current row per key; closed intervals abut the next version
    cur = dim2.filter("is_current").groupBy("city_id").count()
    assert cur.filter("count > 1").count() == 0
    assert rows[(2, False)].effective_end_ts == rows[(2, True)].effective_start_ts
    # surrogate keys unique and kept for untouched rows
    sks = [r.sk for r in dim2.collect()]
    assert len(set(sks)) == len(sks)
    before = {r.city_id: r.sk for r in dim.collect()}
    assert rows[(1, True)].sk == before[1] and rows[(2, False)].sk == before[2]
    # rerun with the same snapshot: no change
    dim3 = apply(dim2, s2, T3)
    assert dim3.count() == dim2.count()
    changes = scd2.scd2_changes(scd2.current_rows(dim2), s2, "city_id", TRACKED)
    assert changes.count() == 0


def test_scd2_changes_tracks_null_safely(spark):
    s1 = snap(spark, [(1, "A", None, "z1")])
    cur = s1
    s2 = snap(spark, [(1, "A", None, "z1"), (2, "B", 1, None)])
    assert [r.city_id for r in scd2.scd2_changes(cur, s2, "city_id", TRACKED).collect()] == [2]
    s3 = snap(spark, [(1, "A", 5, "z1")])
    assert scd2.scd2_changes(cur, s3, "city_id", TRACKED).count() == 1


def test_fact_orphan_dropped_and_update_keeps_key(spark):
    ts = dt.datetime(2024, 1, 1, 23, 30)
    silver = spark.createDataFrame(
        [(1, ts, 1.0, 1.0, 50.0, 0.1, 3.0, 1, "s"), (9, ts, 2.0, 2.0, 50.0, 0.2, 3.0, 1, "s")],
        "city_id bigint, observation_timestamp timestamp, temperature_c double, apparent_temperature_c double, "
        "relative_humidity_pct double, precipitation_mm double, wind_speed_10m_kmh double, weather_code int, "
        "_source string",
    )
    dim = spark.createDataFrame([(1,)], "city_id bigint")
    built = facts.build_fact(facts.WEATHER_FACT, silver, dim)
    assert [r.city_id for r in built.collect()] == [1]
    assert built.first().date_sk == 20240101
    target = facts.with_new_keys(built, facts.WEATHER_FACT.sk).cache()
    sk = target.first()[facts.WEATHER_FACT.sk]
    newer = facts.build_fact(facts.WEATHER_FACT, silver.withColumn("temperature_c", F.lit(5.0)), dim)
    extra = facts.build_fact(
        facts.WEATHER_FACT, silver.withColumn("observation_timestamp", F.lit(ts + dt.timedelta(hours=1))), dim
    )
    merged = facts.upsert_fact(target, newer.unionByName(extra), facts.WEATHER_FACT.keys, facts.WEATHER_FACT.sk)
    rows = {r.observation_timestamp: r for r in merged.collect()}
    assert rows[ts].temperature_c == 5.0 and rows[ts][facts.WEATHER_FACT.sk] == sk
    new_sk = rows[ts + dt.timedelta(hours=1)][facts.WEATHER_FACT.sk]
    assert new_sk > sk


def _versions(df):
    return sorted(((r.k, r.a, r.note, r.effective_start_ts, r.effective_end_ts, r.is_current) for r in df.collect()), key=repr)


def test_snapshots_at_once_equal_single_runs_and_late_ones_are_spliced(spark):
    import random

    from stratum.operators.scd2 import empty_dim_like, scd2_history

    rnd = random.Random(1)
    at = [dt.datetime(2024, 1, d) for d in (1, 5, 9, 13)]
    snaps = [spark.createDataFrame([(k, rnd.choice([1, 2, None]), f"n{d}", t) for k in range(30) if rnd.random() < 0.8], "k int, a int, note string, at timestamp")
             for d, t in enumerate(at)]
    empty = empty_dim_like(snaps[0].drop("at"), "k", "sk")
    every = snaps[0].unionByName(snaps[1]).unionByName(snaps[2])
    at_once = scd2_history(empty, every, "k", ["a"], "at", "sk")
    dim = empty
    for n, s in enumerate(snaps[:3]):
        dim = scd2_history(dim, s, "k", ["a"], "at", "sk", sk_offset=1000 * n)
    assert _versions(at_once) == _versions(dim)
    apply = scd2.scd2_apply
    by_run = apply(apply(apply(empty, snaps[0].drop("at"), "k", ["a"], F.lit(at[0]), "sk", 0), snaps[1].drop("at"), "k", ["a"], F.lit(at[1]), "sk", 100),
                        snaps[2].drop("at"), "k", ["a"], F.lit(at[2]), "sk", 200)
    assert _versions(by_run) == _versions(at_once)
    # a late one between: versions still abut, keys of versions that stay are kept
    late = spark.createDataFrame([(k, 7, "late", dt.datetime(2024, 1, 7)) for k in range(0, 40, 2)] + [(1, 2, "no time", None), (None, 2, "no key", at[1])],
                                 "k int, a int, note string, at timestamp")
    spliced = scd2_history(dim, late, "k", ["a"], "at", "sk", sk_offset=9000).collect()
    keys = {(r.k, r.effective_start_ts): r.sk for r in dim.collect()}
    assert all(r.sk == keys.get((r.k, r.effective_start_ts), r.sk) for r in spliced) and len({r.sk for r in spliced}) == len(spliced)
    for k in range(40):
        own = sorted((r for r in spliced if r.k == k), key=lambda r: r.effective_start_ts)
        assert [r.effective_end_ts for r in own] == [r.effective_start_ts for r in own[1:]] + ([None] if own else [])
        assert [r.is_current for r in own] == [False] * (len(own) - 1) + ([True] if own else [])
        assert all(a.a != b.a for a, b in zip(own, own[1:], strict=False))
        if k % 2 == 0:
            assert [r.a for r in own if r.effective_start_ts <= dt.datetime(2024, 1, 7) and (r.effective_end_ts is None or r.effective_end_ts > dt.datetime(2024, 1, 7))] == [7]
    again = scd2_history(spark.createDataFrame(spliced, dim.schema), late, "k", ["a"], "at", "sk", sk_offset=99000)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, spliced), key=repr)
