"""Exact top-k and NN-descent: brute force, recall, odd vectors."""

import numpy as np

from stratum.llm import exact_topk as X
from stratum.llm import nn_descent as N

SCHEMA = "vec_id bigint, embedding array<float>, score string, rank string"
NAN, INF = float("nan"), float("inf")


def vectors(n=600, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(6, dim))[rng.integers(0, 6, n)] + rng.normal(size=(n, dim))).astype(np.float32)


ODD = [(1000, None), (1100, []), (1200, [1.0, None] + [0.0] * 10), (1300, [NAN] * 12), (1400, [INF] * 12), (None, [1.0] * 12), (1500, [1.0, 2.0]), (1600, [2.0, 1.0]), (1650, [-1.0, 2.0])]


def exact(rows, k, every):
    v = {}
    for i, e in rows:
        if i is not None and e and all(x is not None and np.isfinite(x) for x in e):
            e = [int(np.floor(1024 * np.float64(np.float32(x)))) for x in e]
            v[i] = min(v.get(i, e), e)
    out = set()
    for q in v:
        if q % every == 0:
            dot = lambda c: max(min(sum(a * b for a, b in zip(v[q], v[c])), (1 << 63) - 1), -(1 << 63))
            scores = sorted((-dot(c), c) for c in v if c != q and len(v[c]) == len(v[q]))
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:k])}
    return out


def test_topk_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(X, "FRAGMENT", 64)
    monkeypatch.setattr(X, "QUERIES", 4)
    rows = [(i, e.tolist()) for i, e in enumerate(vectors())] + ODD
    rows += [(2000 + i, rows[0][1]) for i in range(300)] + [(5, rows[5][1])]  # a very common vector, a repeated row
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    v = X.whole_numbers(df)
    got = {tuple(r) for r in X.top_k(v, v.where("id % 50 = 0"), 10).collect()}
    assert got == exact(rows, 10, 50)


def test_topk_of_huge_numbers_and_of_none(spark):
    rows = [(0, [3e30, 1.0]), (100, [2e30, -1.0]), (1, [-1e30, 5.0]), (2, [1.0, 1.0]), (3, [1e15, 1e15])]
    v = X.whole_numbers(spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA))
    assert {tuple(r) for r in X.top_k(v, v.where("id % 100 = 0"), 3).collect()} == exact(rows, 3, 100)
    assert X.top_k(v.limit(0), v.limit(0), 3).count() == 0


def cosines(rows):
    v = {i: np.float64(np.float32(e)) for i, e in rows if i is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)}
    return v, lambda a, b: v[a] @ v[b] / np.sqrt((v[a] @ v[a]) * (v[b] @ v[b]))


def test_nn_descent_recall_and_ties(spark):
    rows = [(i, e.tolist()) for i, e in enumerate(vectors(1500, 16, 1))]
    rows += [(3000, None), (3050, [0.0] * 16), (3100, [NAN] * 16), (None, [1.0] * 16), (3150, [1.0, 2.0]), (3151, [2.0, 1.0])]
    rows += [(4000 + i, rows[50][1]) for i in range(400)] + [(7, rows[7][1])]  # one vector under 401 ids
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    vectors_ = N.vectors_of(df)
    graph = N.build(vectors_, 5)
    got = {}
    for r in N.search(graph, vectors_.where("id % 50 = 0").withColumnRenamed("id", "query_id"), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    v, cos = cosines(rows)
    hits = total = 0
    for q in (i for i in v if i % 50 == 0):
        found = [x[1:] for x in sorted(got[q])]
        others = [c for c in v if c != q and len(v[c]) == len(v[q])]
        best = sorted(others, key=lambda c: (-round(cos(q, c), 12), c))[:5]
        assert len(found) == len(best) and q not in [c for c, _ in found]
        assert all(abs(s - cos(q, c)) < 1e-12 for c, s in found)
        hits += len({c for c, _ in found} & set(best))
        total += len(best)
        if q == 50 or q >= 4000:  # copies: score 1, least ids first
            assert [c for c, _ in found] == sorted({50, *range(4000, 4010)} - {q})[:5]
    assert hits / total >= 0.95
    assert {c for _, c, _ in got[3150]} == {3151} and 3050 not in got


def test_nn_descent_recall_in_a_group_of_near_copies(spark):
    rng = np.random.default_rng(8)
    center = rng.normal(size=16)
    e = np.concatenate([center * (1 + 0.001 * rng.normal(size=(3000, 16))), rng.normal(size=(500, 16))]).astype(np.float32)
    v = N.vectors_of(spark.createDataFrame([(i, x.tolist(), "a", "b") for i, x in enumerate(e)], SCHEMA))
    got = {}
    for r in N.search(N.build(v, 5), v.where("id % 50 = 0").withColumnRenamed("id", "query_id"), 5).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    u = e.astype(np.float64)
    u /= np.sqrt(np.square(u).sum(1))[:, None]
    hits = 0
    for q in range(0, 3000, 50):
        far = np.square(u - u[q]).sum(1)
        far[q] = 9
        hits += len(got[q] & set(np.argsort(far)[:5].tolist()))
    assert hits >= 0.95 * 300


def test_search_for_vectors_that_are_no_rows(spark):
    rows = [(i, e.tolist()) for i, e in enumerate(vectors(1000, 16, 4))]
    v = N.vectors_of(spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA))
    asked = spark.createDataFrame([(-1 - i, [float(x) for x in e]) for i, e in enumerate(vectors(20, 16, 4) * np.float32(1.01) + np.float32(0.05))], "query_id bigint, e array<double>")
    known, cos = cosines(rows)
    hits = 0
    got = N.search(N.build(v, 5), asked, 5).collect()
    for q in asked.collect():
        x = np.array(q.e)
        best = sorted(known, key=lambda c: -(known[c] @ x) / np.sqrt(known[c] @ known[c]))[:5]
        hits += len(set(best) & {r.vec_id for r in got if r.query_id == q.query_id})
    assert len(got) == 100 and hits >= 90


def test_nn_descent_of_few_or_no_vectors(spark):
    one = spark.createDataFrame([(0, [1.0, 0.0], "a", "b")], SCHEMA)
    two = spark.createDataFrame([(0, [1.0, 0.0], "a", "b"), (1, [1.0, 1.0], "a", "b")], SCHEMA)
    for df, n in ((one.limit(0), 0), (one, 0), (two, 1)):
        v = N.vectors_of(df)
        assert N.search(N.build(v, 5), v.where("id % 50 = 0").withColumnRenamed("id", "query_id"), 5).count() == n


def test_a_walk_writes_what_it_meets_once(spark, monkeypatch):
    rng = np.random.default_rng(5)
    n = 400
    vectors = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(n)], "id long, e array<double>")
    graph = N.build(vectors, k=5)
    rows, whole = {}, N.written

    def counted(df, tag, *args, **more):
        out = whole(df, tag, *args, **more)
        rows.setdefault(tag, []).append(out.count())
        return out

    monkeypatch.setattr(N, "written", counted)
    monkeypatch.setattr(N, "BEAM", 20)
    queries = vectors.where("id % 50 = 0").withColumnRenamed("id", "query_id")
    assert N.search(graph, queries, k=5).count() == 5 * 8
    assert len(rows["nn-seen"]) > 2 and sum(rows["nn-seen"]) <= n * 8
    assert max(rows["nn-beam"]) <= 20 * 8
