import datetime as dt
import random

from pyspark.sql import functions as F

from stratum.operators.states import StateSpec, advanced, counts_advanced, counts_of, states_of
from stratum.operators.upsert import apply_changes, changes, merge, merged_rows

SPEC = StateSpec(keys=(("city", "city"), ("day", "to_date(ts)")), sums=("t", "p"), extremes=("t",))
COLUMNS = "id int, city int, ts timestamp, t double, p double, kind string, _ingested_at timestamp"
AT = dt.datetime(2024, 1, 1)


def _rows(rnd, n, hour):
    return [(i, rnd.choice([1, 2, None]), AT + dt.timedelta(hours=rnd.randint(0, 40)), rnd.choice([None, rnd.randint(-50, 50) / 10]), rnd.randint(0, 9) / 7,
             rnd.choice(["a", "b", None]), AT + dt.timedelta(hours=hour + rnd.randint(-3, 3))) for i in rnd.sample(range(40), n)]


def _set(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_states_and_counts_follow_the_feeds(spark, tmp_root):
    """Late, replaced and repeated batches: states equal a new aggregation, the feed
    rebuilds the table."""
    rnd = random.Random(8)
    table = spark.createDataFrame(_rows(rnd, 30, 0), COLUMNS)
    states, counts = states_of(table, SPEC), counts_of(table, SPEC, ["kind"])
    batches = [_rows(rnd, 15, h) for h in (2, -2)]
    for n, batch in enumerate([*batches, batches[-1]]):
        source = spark.createDataFrame(batch, COLUMNS)
        merge(table, source, ["id"], newest_by="_ingested_at").write.parquet(f"{tmp_root}/merged{n}")
        merged = spark.read.parquet(f"{tmp_root}/merged{n}")
        feed = changes(merged, ["id"])
        assert _set(apply_changes(table, feed, ["id"])) == _set(merged_rows(merged))
        table_now = merged_rows(merged)
        states, counts = advanced(states, feed, table_now, SPEC), counts_advanced(counts, feed, SPEC, ["kind"])
        states.write.parquet(f"{tmp_root}/states{n}")
        counts.write.parquet(f"{tmp_root}/counts{n}")
        states, counts, table = spark.read.parquet(f"{tmp_root}/states{n}"), spark.read.parquet(f"{tmp_root}/counts{n}"), table_now
        assert _set(states) == _set(states_of(table, SPEC).select(*SPEC.columns))
        assert _set(counts.select("city", "day", "kind", "n")) == _set(counts_of(table, SPEC, ["kind"]).select("city", "day", "kind", "n"))
    assert changes(merge(table, spark.createDataFrame(batches[-1], COLUMNS), ["id"], newest_by="_ingested_at"), ["id"]).count() == 0


def test_merge_with_null_keys_and_a_losing_source(spark):
    old = spark.createDataFrame([(1, 5, AT), (None, 6, AT), (2, 7, None)], "id int, v int, at timestamp")
    new = spark.createDataFrame([(1, 8, AT - dt.timedelta(hours=1)), (None, 9, AT), (2, 7, None), (3, 1, AT)], "id int, v int, at timestamp")
    merged = merge(old, new, ["id"], newest_by="at")
    assert sorted((r.id or 0, r.v) for r in merged_rows(merged).collect()) == [(0, 6), (0, 9), (1, 5), (2, 7), (3, 1)]
    assert sorted((r.before is None, r.after.v) for r in changes(merged, ["id"]).collect()) == [(True, 1), (True, 9)]


def test_numbers_have_no_gaps_and_are_stable(spark):
    from stratum.operators.keys import number_rows

    rows = spark.range(500).selectExpr("id % 7 AS d", "id AS k", "cast(NULL AS bigint) AS sk")
    one = {r.k: r.sk for r in number_rows(rows, "sk", 100, ["d", "pmod(k, 3)"], ["k"]).collect()}
    two = {r.k: r.sk for r in number_rows(rows.repartition(5), "sk", 100, ["d", "pmod(k, 3)"], ["k"]).collect()}
    assert one == two and sorted(one.values()) == list(range(101, 601))
    assert [k for k, _ in sorted(one.items(), key=lambda x: x[1])] == sorted(range(500), key=lambda k: (k % 7, k % 3, k))


def test_restored_records_equal_the_rejected_rows(spark):
    from stratum.operators.quality import RuleSet, quarantine_records, restore_records

    rows = [(1, 0.1 + 0.2, AT.replace(microsecond=123456), dt.date(2024, 2, 29), True, 'a"b\n'), (2, float("nan"), None, None, None, None),
            (3, -1e-300, AT, None, False, ""), (None, float("inf"), AT, None, None, "x|y")]
    df = spark.createDataFrame(rows, "id bigint, v double, ts timestamp, d date, b boolean, s string").withColumn("n", F.col("ts").cast("timestamp_ntz"))
    failed = RuleSet([("never", "false")]).split(df)[1]
    columns = ", ".join(f"{n} {t}" for n, t in df.dtypes)
    back = restore_records(quarantine_records(failed, "t", ["id"], F.current_timestamp()), columns)
    assert _set(back) == _set(failed)
    broken = spark.createDataFrame([("no json", "r")], "raw_record string, failure_reason string")
    assert restore_records(broken, columns).first().asDict() == {**dict.fromkeys(df.columns), "failure_reason": "r"}
