import datetime as dt

import pytest

from stratum.operators import dedup, upsert

T0 = dt.datetime(2024, 1, 1)


def test_latest_wins_three_versions_and_tie_break(spark):
    df = spark.createDataFrame(
        [
            (1, "a", T0, "r1"),
            (1, "b", T0 + dt.timedelta(hours=2), "r2"),
            (1, "c", T0 + dt.timedelta(hours=1), "r3"),
            (2, "x", T0, "r1"),
            (2, "y", T0, "r9"),
        ],
        "k bigint, v string, _ingested_at timestamp, run string",
    )
    out = {r.k: r.v for r in dedup.latest_ingested(df, ["k"], tie_breaks=["run"]).collect()}
    assert out == {1: "b", 2: "y"}


def test_latest_run_and_empty(spark):
    df = spark.createDataFrame(
        [("r1", T0, 1), ("r2", T0 + dt.timedelta(days=7), 2), ("r2", T0 + dt.timedelta(days=7), 3)],
        "_ingestion_run_id string, _ingested_at timestamp, x int",
    )
    assert sorted(r.x for r in dedup.latest_run(df).collect()) == [2, 3]
    assert dedup.latest_run(df.limit(0)).count() == 0


def test_one_per_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None)], "k int, v string")
    assert dedup.one_per_key(df, ["k"]).first().v is None
    assert dedup.one_per_key(df.filter("v IS NOT NULL"), ["k"]).first().v == "a"


def _t(spark):
    return spark.createDataFrame([(1, "old"), (2, "keep"), (None, "nullkey")], "k bigint, v string")


def test_upsert_semantics(spark):
    src = spark.createDataFrame([(1, "new"), (3, "ins"), (None, "nullsrc")], "k bigint, v string")
    out = sorted((r.k if r.k is not None else -1, r.v) for r in upsert.upsert(_t(spark), src, ["k"]).collect())
    assert out == [(-1, "nullkey"), (-1, "nullsrc"), (1, "new"), (2, "keep"), (3, "ins")]


def test_upsert_twice_equals_once(spark):
    src = spark.createDataFrame([(1, "new"), (3, "ins")], "k bigint, v string")
    once = upsert.upsert(_t(spark), src, ["k"])
    twice = upsert.upsert(once, src, ["k"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_duplicate_source_keys_fail(spark):
    src = spark.createDataFrame([(1, "a"), (1, "b"), (None, "x"), (None, "y")], "k bigint, v string")
    with pytest.raises(upsert.DuplicateSourceKeys):
        upsert.assert_unique_keys(src, ["k"])
    upsert.assert_unique_keys(src.filter("k IS NULL"), ["k"])  # NULL keys never match: allowed
