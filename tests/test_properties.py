"""Property tests: operators against plain-Python brute force on random input."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.operators import dedup, quality, scd2, upsert

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(
    st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 5), st.integers(0, 99)),
    min_size=0, max_size=25,
)


@SETTINGS
@given(rows_st)
def test_latest_per_key_matches_brute_force(spark, rows):
    data = [(k, T0 + dt.timedelta(hours=h), f"r{r}", v) for k, h, r, v in rows]
    df = spark.createDataFrame(data, "k int, _ingested_at timestamp, run string, v int")
    got = sorted(tuple(r) for r in dedup.latest_ingested(df, ["k"], tie_breaks=["run", "v"]).collect())
    best = {}
    for row in data:
        key = (row[1], row[2], row[3])
        if row[0] not in best or key > (best[row[0]][1], best[row[0]][2], best[row[0]][3]):
            best[row[0]] = row
    assert got == sorted(best.values())


keyed_st = st.dictionaries(st.integers(0, 12), st.integers(0, 50), max_size=10)


@SETTINGS
@given(keyed_st, keyed_st)
def test_upsert_matches_dict_merge(spark, target, source):
    t = spark.createDataFrame(sorted(target.items()), "k int, v int")
    s = spark.createDataFrame(sorted(source.items()), "k int, v int")
    got = dict(tuple(r) for r in upsert.upsert(t, s, ["k"]).collect())
    assert got == {**target, **source}
    assert upsert.assert_unique_keys(s, ["k"]) == len(source)


snap_st = st.dictionaries(st.integers(0, 8), st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.integers(0, 2)),
                          max_size=8)


@SETTINGS
@given(st.lists(snap_st, min_size=1, max_size=3))
def test_scd2_invariants(spark, snapshots):
    schema = "city_id int, pop int, name int"
    first = spark.createDataFrame([(k, *v) for k, v in sorted(snapshots[0].items())], schema)
    dim = scd2.empty_dim_like(first, "city_id", "sk")
    state = {}  # key -> current tracked value
    opened = 0
    for n, snap in enumerate(snapshots):
        s = spark.createDataFrame([(k, *v) for k, v in sorted(snap.items())], schema)
        ts = F.lit(T0 + dt.timedelta(days=n)).cast("timestamp")
        dim = scd2.scd2_apply(dim, s, "city_id", ["pop"], ts, sk_col="sk").cache()
        for k, (pop, _) in snap.items():
            if k not in state or state[k] != pop:
                opened += 1
            state[k] = pop
    rows = dim.collect()
    assert len(rows) == opened
    current = {r.city_id: r for r in rows if r.is_current}
    assert {k: r.pop for k, r in current.items()} == state
    for k in state:
        versions = sorted((r for r in rows if r.city_id == k), key=lambda r: r.effective_start_ts)
        for a, b in zip(versions, versions[1:]):
            assert a.effective_end_ts == b.effective_start_ts and not a.is_current
    assert len({r.sk for r in rows}) == len(rows)


vals_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), st.integers(-5, 5))),
                   max_size=20)


@SETTINGS
@given(vals_st)
def test_dq_split_partitions_input(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int")
    rules = quality.RuleSet([("a_pos", "a > 0"), ("b_pos", "b > 0"), ("a_pos", "a > 1")])
    valid, invalid = rules.split(df)
    got_invalid = sorted((r.a if r.a is not None else -99, r.b if r.b is not None else -99, r.failure_reason)
                         for r in invalid.collect())
    expected = []
    n_valid = 0
    for a, b in rows:
        names = []
        if a is not None and not a > 0:
            names.append("a_pos")
        if b is not None and not b > 0:
            names.append("b_pos")
        if a is not None and not a > 1 and "a_pos" not in names:
            names.append("a_pos")
        if names:
            expected.append((a if a is not None else -99, b if b is not None else -99, "; ".join(names)))
        else:
            n_valid += 1
    assert got_invalid == sorted(expected)
    assert valid.count() == n_valid
