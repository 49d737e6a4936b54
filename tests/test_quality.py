import json

import pytest
from pyspark.sql import functions as F

from stratum.operators import quality as q


def _df(spark):
    return spark.createDataFrame(
        [(1, 10.0, "a"), (2, None, "b"), (3, 99.0, None), (None, -200.0, "d")],
        "id bigint, temp double, tag string",
    )


RULES = q.RuleSet([
    ("id_not_null", "id IS NOT NULL"),
    ("temp_range", "temp BETWEEN -90 AND 60"),
    ("tag_not_null", "tag IS NOT NULL"),
])


def test_null_condition_passes_and_all_reasons_in_order(spark):
    valid, invalid = RULES.split(_df(spark))
    # id 2 has NULL temp: the range rule is NULL, so it passes.
    assert sorted(r.id for r in valid.collect()) == [1, 2]
    reasons = {r.id: r.failure_reason for r in invalid.collect()}
    assert reasons == {3: "temp_range; tag_not_null", None: "id_not_null; temp_range"}


def test_duplicate_names_collapse_and_empty_set(spark):
    _, invalid = q.RuleSet([("x", "temp < 50"), ("x", "temp < 0")]).split(_df(spark))
    assert {r.failure_reason for r in invalid.collect()} == {"x"}
    valid, invalid = q.RuleSet().split(_df(spark))
    assert valid.count() == 4 and invalid.count() == 0
    with pytest.raises(ValueError):
        q.RuleSet([("x", "true")] * 64)


def test_valid_plus_invalid_is_input(spark):
    df = _df(spark)
    valid, invalid = RULES.split(df)
    assert valid.count() + invalid.count() == df.count()


@pytest.mark.parametrize(
    "total,bad,raises",
    [(0, 0, False), (100, 2, False), (1000, 21, True), (50, 1, False), (49, 1, True)],
)
def test_gate_boundary(total, bad, raises):
    gate = q.Gate(0.02)
    if raises:
        with pytest.raises(q.GateClosed):
            gate.admit(total, bad, "t")
    else:
        assert gate.admit(total, bad, "t") == (bad / total if total else 0.0)


def test_gate_report_matches_python(spark):
    row = q.Gate(0.02).report(RULES.mark(_df(spark))).first()
    assert (row.checked_rows, row.quarantined_rows) == (4, 2)
    assert row.quarantine_rate == 0.5 and row.gate_passed is False
    empty = q.Gate(0.02).report(RULES.mark(_df(spark).limit(0))).first()
    assert empty.quarantine_rate == 0.0 and empty.gate_passed is True


def test_observed_counts_single_pass(spark):
    marked, seen = RULES.observed(RULES.mark(_df(spark)), "dq")
    assert RULES.passed(marked).count() == 2
    assert seen.get == {"checked_rows": 4, "quarantined_rows": 2, "0_id_not_null": 1, "1_temp_range": 2, "2_tag_not_null": 1}


def test_quarantine_record_key_and_json(spark):
    _, invalid = RULES.split(_df(spark))
    rec = q.quarantine_records(invalid, "t", ["id", "tag"], F.lit(None).cast("timestamp"), run_id_col=None)
    rows = {r.natural_key: r for r in rec.collect()}
    # NULL key parts are skipped; NULL fields are left out of the JSON.
    assert set(rows) == {"3", "d"}
    assert json.loads(rows["3"].raw_record) == {"id": 3, "temp": 99.0}
    assert rows["d"]._ingestion_run_id is None
