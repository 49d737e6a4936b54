"""Quality classifier: held-out accuracy, defined scores of odd texts."""

import zlib

import numpy as np
import pyarrow as pa

from stratum.llm import quality_classifier as Q

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = Q.op3_quality_classifier(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = rows.join(labels, "doc_id").where("held_out").toPandas()
    assert len(held) > 500 and all(zlib.crc32(str(d).encode()) % 5 == 0 for d in held["doc_id"])
    assert (held["predicted"] == held["quality"]).mean() > 0.98
    assert held.loc[held["quality"] == 1, "predicted"].mean() > 0.99  # clean documents stay
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_parts_of_long_texts_score_like_the_whole():
    rng = np.random.default_rng(0)
    model = Q.Model(12, rng.normal(size=1 << 12), 0.1)
    text = " ".join("".join(rng.choice(list("abcé"), rng.integers(1, 9))) for _ in range(4000))
    model.table[0] = model.table[Q._REPEAT] = 0.0  # no feature, and the one feature that a cut may lose, with its count
    whole = Q.scores(pa.array([text, "x", text]), model)
    old = Q.blocks.__defaults__
    try:
        Q.blocks.__defaults__ = (1000,)
        cut = Q.scores(pa.array([text, "x", text]), model)
    finally:
        Q.blocks.__defaults__ = old
    assert np.allclose(whole, cut, atol=1e-3) and np.isclose(whole[0], whole[2], atol=1e-12)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "good words here", 5.0), (2, "BAD!! BAD!!", 6.0), (3, None, 7.0), (4, "", 8.0), (None, " \n ", 9.0), (1, "good words here", 5.0)],
                                 "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (77, 0), (1, 1)], "doc_id bigint, quality int")
    model = Q.fit(docs, labels)
    out = {(r.doc_id, r.text): r.score for r in Q.score(docs, model).collect()}
    assert out[3, None] == out[4, ""] == out[None, " \n "] and all(0 <= s <= 1 for s in out.values())
    assert out[1, "good words here"] > out[2, "BAD!! BAD!!"]
    none = Q.fit(docs, labels.limit(0))
    assert {r.score for r in Q.score(docs, none).collect()} == {0.5}
    one = Q.fit(docs, labels.where("quality = 1"))
    assert all(r.score > 0.99 for r in Q.score(docs, one).collect())
    assert Q.score(docs.limit(0), model).count() == 0


def plainly_trained(rows, quality, prior, bits, dim=8, epochs=5, rate=200.0, layer_rate=0.4, batch=16, seed=7):
    """Softmax over averaged vectors, trained text by text in double precision;
    gives the probability of label 1 for a text's buckets and shares."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0 / dim, 1.0 / dim, (1 << bits, dim)).astype(np.float32).astype(float)
    layer, bias = rng.normal(0, 0.5, (dim, 2)).astype(np.float32).astype(float), np.zeros(2)

    def average(row):
        return sum((share * vectors[bucket] for bucket, share in zip(*row, strict=True)), np.zeros(dim))

    def softmax(z):
        return np.exp(z) / np.exp(z).sum()

    order = rng.permutation(len(quality))
    groups = [order[i : i + batch] for i in range(0, len(order), batch)]
    step = 0
    for _ in range(epochs):
        for g in rng.permutation(len(groups)):
            falling = 1 - step / (epochs * len(groups))
            step += 1
            errors = [(i, average(rows[i]), (softmax(average(rows[i]) @ layer + bias) - np.eye(2)[quality[i]]) / len(groups[g])) for i in groups[g]]
            old = layer.copy()
            for i, hidden, error in errors:
                layer -= layer_rate * falling * np.outer(hidden, error)
                bias -= layer_rate * falling * error
                for bucket, share in zip(*rows[i], strict=True):
                    vectors[bucket] -= rate * falling * share * (old @ error)
    share = np.mean(quality)

    def scored(row):
        zero, one = softmax(average(row) @ layer + bias)
        odds = one / zero * (prior / (1 - prior)) / (share / (1 - share))
        return odds / (1 + odds)

    return scored


def test_scores_equal_a_plain_model():
    rng = np.random.default_rng(5)
    good, bad = ["river", "history", "paper", "light", "é"], ["click", "buy", "!!!", "free", "river"]
    texts = [" ".join(rng.choice(good if i % 3 else bad, rng.integers(1, 30))) for i in range(60)]
    quality = [int(i % 3 > 0) for i in range(60)]
    model = Q.train(texts, quality, 0.8, bits=10)
    asked = texts + ["river", "", "buy buy paper", "unseen words only"]
    plain = plainly_trained(Q._rows_of(texts, 10), quality, 0.8, 10)
    want = np.array([plain(row) for row in Q._rows_of(asked, 10)])
    got = Q.scores(pa.array(asked), model)
    assert np.allclose(got, want, atol=2e-3) and want.std() > 0.2
