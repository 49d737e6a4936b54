import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import hard_negatives as h


def _brute(rows, anchors, n_pos=5, n_neg=3):
    """Of (id, label, whole vector) rows."""
    out = []
    for a, label, v in rows:
        if a not in anchors:
            continue
        every = sorted(((-int(np.dot(v, x)), i, m) for i, m, x in rows if i != a and len(x) == len(v)))
        for p, positive, _ in [e for e in every if e[2] == label][:n_pos]:
            window = [e for e in every if e[2] != label and 50 * -p <= 100 * -e[0] <= 95 * -p]
            out += [(a, positive, rank + 1, i, -p, -s) for rank, (s, i, _) in enumerate(window[:n_neg])]
    return sorted(out)


def _index(rows):
    ids, labels = (np.array([r[i] for r in rows], np.int64) for i in range(2))
    return h.Index(h.indexed(len(rows[0][2]), ids, labels, np.array([r[2] for r in rows], float)))


@pytest.mark.parametrize("dim", [1, 5, 16])
def test_walk_visits_by_bounds_that_hold(dim):
    rng = np.random.default_rng(dim)
    rows = [(i, 0, rng.integers(-50, 50, dim)) for i in range(3000)]
    index, query = _index(rows), rng.integers(-50, 50, dim).astype(float)
    one, two = index.bounds(query[None])
    seen, last = [], np.inf
    for bound, places, scores in index.walk(query, one[0], two[0]):
        assert (scores <= last).all() and bound <= last
        seen += places.tolist()
        last = bound
    assert sorted(seen) == list(range(3000)) and len(index.ends) > 2


def test_the_walk_stops_early_on_grouped_vectors():
    rng = np.random.default_rng(3)
    centres = rng.integers(-100, 100, (5, 16))
    rows = [(i, i % 2, centres[i % 5] + rng.integers(-2, 2, 16)) for i in range(6000)]
    index, query = _index(rows), rows[7][2].astype(float)
    one, two = index.bounds(query[None])
    walked = []
    walk = index.walk
    index.walk = lambda *x: (walked.append(len(step[1])) or step for step in walk(*x))
    ids, scores = h.positives(index, query, 7, 1, 5, -np.inf, (one[0], two[0]))
    every = sorted(((-int(np.dot(query, v)), i) for i, m, v in rows if m == 1 and i != 7))[:5]
    assert [(-int(s), int(i)) for i, s in zip(ids, scores, strict=True)] == every and sum(walked) < 3000


def test_mine_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(h, "FRAGMENT", 70)
    monkeypatch.setattr(h, "WAVE", 8)
    rng = np.random.default_rng(5)
    centres = rng.integers(-40, 40, (6, 8))
    rows = [(i, int(rng.integers(0, 4)), (centres[i % 6] + rng.integers(-9, 9, 8)).tolist()) for i in range(400)]
    rows += [(1000 + i, i % 3, [20] * 8) for i in range(100)] + [(2000 + i, i % 2, [7, 3 - i]) for i in range(30)] + [(3000, 1, [5])]
    df = spark.createDataFrame([(i, m, [float(x) for x in v]) for i, m, v in rows], "id long, label long, v array<double>").repartition(5)
    anchors = {i for i, _, _ in rows if i % 13 == 0} | {3000}
    got = sorted(tuple(r) for r in h.mine(df, df.where(F.col("id").isin(list(anchors)))).collect())
    assert got == _brute(rows, anchors) and got


def test_odd_rows_and_empty_table(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (50, None, [1.0, 0.5]), (100, 1, None), (150, 1, [nan, 1.0]), (200, 1, [None, 1.0]), (250, 1, [inf, 1.0]), (300, 1, []),
            (None, 1, [1.0, 1.0]), (1, 1, [1.0, 0.5]), (2, 2, [0.5, 0.5]), (3, 2, [0.9, 0.4]), (3, 0, [0.8, 0.5]), (3, 0, [0.7, 0.6]), (4, 2, [1e30, 0.0]),
            (350, 9, [0.0, 0.0]), (5, 9, [0.0, 1.0]), (400, 3, [-1.0, -1.0]), (6, 3, [1.0, 1.0]), (7, 5, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, m, v, 1) for i, m, v in rows], "vec_id long, label int, embedding array<double>, rank int")
    whole = h.whole_rows(df)
    kept = {r.id: (r.label, r.v) for r in whole.collect()}
    assert kept[3] == (0, [179.0, 153.0]) and kept[4] == (2, [2.0**25, 0.0])
    assert sorted(kept) == [0, 1, 2, 3, 4, 5, 6, 7, 350, 400]
    rows = [(i, *kept[i]) for i in kept]
    got = sorted(tuple(r) for r in h.mine(whole, whole.where("id % 50 = 0")).collect())
    assert got == _brute(rows, {i for i in kept if i % 50 == 0}) and {r[0] for r in got} == {0, 350}
    assert h.mine(whole.where("id < 0"), whole.where("id < 0")).collect() == []
    assert h.mine(whole, whole.where("id < 0")).collect() == []


def test_windows_are_whole_scores():
    lows, highs = h.windows(np.array([100.0, 101.0, 0.0, -100.0, 1.0]))
    assert lows.tolist() == [50, 51, 0, -50, 1] and highs.tolist() == [95, 95, 0, -95, 0]
