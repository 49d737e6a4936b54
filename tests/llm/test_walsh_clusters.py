import hashlib
import random

import numpy as np
import pytest

from stratum.llm import walsh_clusters as w


def test_transform_is_exact_and_keeps_distances():
    rng = np.random.default_rng(0)
    a, b = rng.integers(-w.REACH // 64, w.REACH // 64, (2, 50, 64))
    signs = np.array([[(-1) ** bin(i & j).count("1") for j in range(64)] for i in range(64)], np.int64)
    assert (w.transform(a) == (a @ signs.T)[:, w._coarse_first(64)]).all()
    assert (((w.transform(a) - w.transform(b)) ** 2).sum(1) == 64 * ((a - b) ** 2).sum(1)).all()
    steps = np.repeat([[3, -2, 7, 1]], 16, axis=1).reshape(1, 16, 4).transpose(0, 2, 1).reshape(1, 64)
    assert w.transform(np.sort(steps))[0, 4:].any() == 0  # four stretches: four coefficients


@pytest.mark.parametrize("spread", [2, 5, 1000])
def test_nearest_equals_all_distances(spread):
    rng = np.random.default_rng(spread)
    v, m = rng.integers(-spread, spread, (400, 64)), rng.integers(-spread, spread, (40, 64))
    m[7], m[30], v[5] = m[3], m[3], m[3]  # ties
    number, distance, looked = w.nearest(w.transform(v), w.transform(m))
    every = ((v[:, None] - m[None]) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_most_centroids_are_left_early():
    rng = np.random.default_rng(1)
    m = np.repeat(rng.integers(-500, 500, (40, 8)), 8, axis=1)
    v = m[rng.integers(0, 40, 300)] + rng.integers(-5, 5, (300, 64))
    assert w.nearest(w.transform(v), w.transform(m))[2] < 0.2 * 300 * 40 * 64


def _brute(rows, k, rounds, seed):
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows]
    mark = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept)
    m = [v for _, v in mark[:k]]
    v = np.array([x for _, x in kept], object)
    for turn in range(rounds + 1):
        d = np.array([[int(((x - np.array(y, object)) ** 2).sum()) for y in m] for x in v], object)
        own = [min(range(len(m)), key=lambda c: (r[c], c)) for r in d]
        if turn < rounds:
            for c in range(len(m)):
                mine = [x for x, o in zip(v, own, strict=True) if o == c]
                if mine:
                    m[c] = [int(s) // len(mine) for s in np.sum(mine, axis=0)]
    best = [d[i][o] for i, o in enumerate(own)]
    sums = {c: sum(b for b, o in zip(best, own, strict=True) if o == c) for c in set(own)}
    return sorted((i, o, b, sums[o], sum(best), hashlib.sha256(",".join(map(str, m[o])).encode()).hexdigest())
                  for (i, _), o, b in zip(kept, own, best, strict=True))


def test_clusters_equal_brute_force_and_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(64)]) for i in range(90)]
    rows += [(200 + i, [0.25] * 64) for i in range(30)] + [(5, [0.1] * 64), (5, [-0.1] * 64), (-3, [1.0] + [0.0] * 63)]
    odd = [(300, None), (301, [1.0] * 63), (302, [None] + [1.0] * 63), (303, [float("nan")] * 64), (304, [float("inf")] * 64), (305, []), (None, [1.0] * 64)]
    df = spark.createDataFrame([(i, v, 9, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, cluster int, distance string").repartition(4)
    got = sorted(tuple(r) for r in w.clusters(df, k=12, rounds=3, seed=2).collect())
    assert got == _brute(rows, 12, 3, 2)


def test_few_huge_and_no_vectors(spark):
    few = spark.createDataFrame([(1, [1.0] * 64), (2, [1e30] * 64), (3, [-1e30] * 64)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in w.clusters(few, k=40, rounds=2, seed=2).collect()}
    assert len(got) == 3 and all(r.distance == 0 for r in got.values())
    assert w.clusters(few.where("vec_id > 9"), k=40, rounds=5, seed=2).collect() == []
    with pytest.raises(ValueError):
        w.clusters(few, k=2, rounds=1, seed=2, dim=48)
