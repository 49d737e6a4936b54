"""Packing: capacities, offsets, best fit, joint choice of sizes, odd rows."""

import numpy as np
import pytest

from stratum.llm import packing as P

SIZES = (512, 1024, 2048, 4096)


def checked(lengths, sizes=SIZES):
    bins, capacity, tokens, offset = P.pack(np.asarray(lengths, np.int64), sizes)
    for b in range(bins.max(initial=-1) + 1):
        own = np.flatnonzero(bins == b)
        total = sum(lengths[i] for i in own)
        assert set(tokens[own]) == {total} and set(capacity[own]) == {min(s for s in sizes if s >= total)}  # downsized
        spans = sorted((offset[i], offset[i] + lengths[i]) for i in own)
        assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    return bins, capacity


@pytest.mark.parametrize("n", [0, 1, 7, 400, 5000])
def test_valid_and_dense(n):
    rng = np.random.default_rng(n)
    lengths = np.minimum(rng.lognormal(5.5, 1.2, n).astype(int) + 1, 4096).tolist()
    bins, capacity = checked(lengths)
    if n >= 400:
        opened = {b: c for b, c in zip(bins.tolist(), capacity.tolist())}
        assert sum(lengths) / sum(opened.values()) > 0.98


def test_joint_sizes_cost_no_more_than_the_largest_alone():
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(300, 600, 200), rng.integers(1000, 1100, 60), np.full(9, 2049), rng.integers(1, 4097, 300)):
        def cost(sizes):
            bins, capacity = checked(lengths.tolist(), sizes)
            return sum({b: c + P.OVERHEAD for b, c in zip(bins.tolist(), capacity.tolist())}.values())
        assert cost(SIZES) <= cost((4096,))


def test_best_fit_takes_the_tightest_open_bin():
    bins, _ = checked([4000, 3900, 196, 96], (4096,))
    assert bins[2] == bins[1] and bins[3] == bins[0]


def test_greedy_fill_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(200):
        lengths = rng.integers(1, 30, rng.integers(0, 12))
        left, room = P._Left(lengths, 40), int(rng.integers(0, 41))
        put, rest = 0, sorted(lengths.tolist(), reverse=True)
        for n in rest:
            if n <= room - put:
                put += n
        assert left.fill(room) == put


def test_rows(spark):
    rows = [(1, 10, "x"), (1, 10, "x"), (None, 5, "x"), (2, 0, "x"), (3, None, "x"), (4, -3, "x"), (5, 10_000, "x"), (6, 4096, "x"), (7, 4097, "x")]
    out = P.best_fit(spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, bin_id string"), block_rows=4).toPandas()
    by = out.groupby(out["doc_id"].fillna(-1))["n_tokens"].sum().to_dict()
    assert by == {-1: 5, 1: 20, 5: 10_000, 6: 4096, 7: 4097}
    assert sorted(out[out["doc_id"] == 5]["start"]) == [0, 4096, 8192] and (out["n_tokens"] <= 4096).all()
    total = out.groupby("bin_id").agg(t=("n_tokens", "sum"), u=("bin_tokens", "first"), c=("bin_capacity", "first"))
    assert (total["t"] == total["u"]).all() and (total["u"] <= total["c"]).all()
    assert P.best_fit(spark.createDataFrame([], "doc_id bigint, n_tokens bigint")).count() == 0


def test_word_count(spark):
    texts = [None, "", "  ", "a", " a  b\tc\nd ", "é x y", "w " * 50_000]
    got = [r.n for r in spark.createDataFrame([(t,) for t in texts], "text string").select(P.word_count().alias("n")).collect()]
    assert got == [0, 0, 0, 1, 4, 2, 50_000]


def plainly_packed(lengths, sizes, overhead=P.OVERHEAD):
    """(capacity, lengths) of the bins, by going through all bins and all pieces each time."""
    rest, bins = sorted(lengths, reverse=True), []
    while rest:
        n = rest.pop(0)
        open_bins = [b for b in bins if b[0] - sum(b[1]) >= n]
        if open_bins:
            min(open_bins, key=lambda b: b[0] - sum(b[1]))[1].append(n)
            continue
        costs = []
        for c in (c for c in sizes if c >= n):
            room = c - n
            for m in rest:
                room -= m if m <= room else 0
            costs.append(((overhead + c) / (c - room), c))
        bins.append((min(costs)[1], [n]))
    return sorted((min(s for s in sizes if s >= sum(own)), sorted(own)) for _, own in bins)


def contents(bins, capacity, lengths):
    own = {}
    for b, c, n in zip(bins, capacity, lengths, strict=True):
        own.setdefault((b, c), []).append(n)
    return sorted((c, sorted(ns)) for (_, c), ns in own.items())


@pytest.mark.parametrize("sizes", [SIZES, (4096,), (700, 1900)])
def test_equals_a_plain_packer(sizes):
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 30, 250):
        for lengths in (rng.integers(1, max(sizes) + 1, n), np.minimum(rng.lognormal(5, 1.5, n).astype(int) + 1, max(sizes)), rng.integers(1, 4, n) * 100):
            bins, capacity, _, _ = P.pack(lengths.astype(np.int64), sizes)
            assert contents(bins.tolist(), capacity.tolist(), lengths.tolist()) == plainly_packed(lengths.tolist(), sizes)


def test_registered_query_equals_a_plain_packer(spark):
    sf_dir = "/root/testdata/sf0.001"
    out = P.op1_best_fit_packing(spark, sf_dir).toPandas()
    pieces = []
    for (text,) in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect():
        words = len([w for w in (text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w])
        pieces += [min(max(SIZES), words - at) for at in range(0, words, max(SIZES))]
    assert contents(out["bin_id"], out["bin_capacity"], out["n_tokens"]) == plainly_packed(pieces, SIZES)
