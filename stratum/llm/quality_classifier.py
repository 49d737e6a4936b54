"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors, one for each hashed feature it holds:
its white-space-bounded words, the character n-grams of 3 and 4 UTF-8 bytes that
lie in a word (one edge space may belong to it), and one feature for each word
that repeats its predecessor. A softmax layer turns the average into class
probabilities. Vectors and layer are trained by numpy stochastic gradient
descent with a linearly falling rate.

Since the layer is linear, a fitted model gives every feature one number, its
vector times the difference of the two class weights. Scoring a text therefore
is a sum of table lookups, and the table (``2**bits`` doubles) is all that
executors need.

Defined cases: null and empty texts, and texts of white space only, get the
score of the bias alone. Rows of ``labels`` with a null id or quality take no
part; an id that ``documents`` lacks takes no part; several labels of an id all
count. Without labels of both classes the score is the share of label 1, or 0.5
without any. An existing column named like the output is replaced. Long texts
are read whole, in parts cut at white space (words and n-grams never cross a
part's edge, so parts change nothing but the repeat feature at the cut).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import _BASE, _BYTE, _ODD, _U, _WHITE, Block, blocks, mix

GRAMS = (3, 4)
_REPEAT = 1  # bucket of the repeat feature; 0 stands for no feature


@dataclass
class Model:
    """``table``: a number for each feature bucket; score = sigmoid(mean + bias)."""

    bits: int
    table: np.ndarray
    bias: float


def _features(block: Block, bits: int) -> Iterator[np.ndarray]:
    """Arrays of feature buckets, one entry for each byte that a feature starts
    at (0: none)."""
    shift = _U(64 - bits)
    data = block.data
    white = _WHITE[data]
    spaced = np.where(white, np.uint8(32), data)
    byte = _BYTE[spaced]
    start, _, part = block.words()
    hashes, _ = block.word_hashes()
    words = np.zeros(len(data), np.int32)
    words[start] = np.maximum((hashes * _ODD >> shift).astype(np.int32), 2)
    same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (part[1:] == part[:-1])) + 1
    words[start[same] - 1] = _REPEAT  # on the space before the repeated word
    yield words
    # n-grams: inside bytes are of one word, the first and last may be its edges
    rolling = byte[:-1] + byte[1:] * _BASE
    inside = ~white
    free = np.ones(len(data) - 1, bool)  # no white space strictly between first and last
    for n in range(3, max(GRAMS) + 1):
        if len(data) < n:
            break
        m = len(data) - n + 1
        rolling = rolling[:m] + byte[n - 1 :] * _U(pow(int(_BASE), n - 1, 1 << 64))
        free = free[:m] & inside[n - 2 : n - 2 + m]
        if n in GRAMS:
            grams = np.zeros(len(data), np.int32)
            buckets = (((rolling ^ (rolling >> _U(29))) + _U(n)) * _ODD >> shift).astype(np.int32)
            grams[:m] = np.where(free, np.maximum(buckets, 2), 0)
            yield grams


def _tally(block: Block, table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each part: the sum over its features, and their number."""
    total, count = np.zeros(len(block.rows)), np.zeros(len(block.rows))
    # a feature belongs to the part in which its last-but-one byte lies at the latest:
    # the space before a part counts as the part's own
    edges = block.lo - 1
    for feature in _features(block, bits):
        total += np.add.reduceat(table[feature], edges)
        count += np.add.reduceat(feature > 0, edges, dtype=np.int64)
    return total, count


def scores(texts: pa.Array, model: Model) -> np.ndarray:
    """Score of each text of an Arrow array."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for block in blocks(texts):
        t, c = _tally(block, model.table, model.bits)
        np.add.at(total, block.rows, t)
        np.add.at(count, block.rows, c)
    return 1.0 / (1.0 + np.exp(-(total / np.maximum(count, 1.0) + model.bias)))


def _rows_of(texts: list[str], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their shares of each text."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for block in blocks(pa.array(texts, pa.large_string())):
        edges = [*(block.lo - 1).tolist(), len(block.data)]
        for feature in _features(block, bits):
            for i, row in enumerate(block.rows.tolist()):
                f = feature[edges[i] : edges[i + 1]]
                out[row].append(f[f > 0])
    rows = []
    for parts in out:
        ids, n = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)
        rows.append((ids, (n / max(n.sum(), 1)).astype(np.float32)))
    return rows


def train(texts: list[str], quality: list[int], prior: float, bits: int = 16, **how) -> Model:
    """:func:`train_on` on the texts' features."""
    return train_on(_rows_of(texts, bits), quality, prior, bits, **how)


def train_on(rows: list[tuple[np.ndarray, np.ndarray]], quality: list[int], prior: float, bits: int = 16, dim: int = 8,
             epochs: int = 5, rate: float = 200.0, layer_rate: float = 0.4, batch: int = 16, seed: int = 7) -> Model:
    """Softmax regression on averaged feature vectors by mini-batch gradient
    descent. ``rows``: distinct buckets and their shares of each text; ``prior``:
    share of label 1 among all labelled rows, which the sample of training rows
    need not have."""
    y = np.asarray(quality)
    if not len(y) or y.min() == y.max():
        prior = min(max(prior, 1e-6), 1 - 1e-6)
        return Model(bits, np.zeros(1 << bits), float(np.log(prior / (1 - prior))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1.0 / dim, 1.0 / dim, (1 << bits, dim)).astype(np.float32)
    weights = rng.normal(0, 0.5, (dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    order = rng.permutation(len(y))
    groups = [order[i : i + batch] for i in range(0, len(order), batch)]
    steps, step = epochs * len(groups), 0
    for _ in range(epochs):
        for g in rng.permutation(len(groups)):
            members = groups[g]
            falling = 1 - step / steps
            step += 1
            ids = np.concatenate([rows[i][0] for i in members])
            used, at = np.unique(ids, return_inverse=True)
            x = np.zeros((len(members), len(used)), np.float32)
            x[np.repeat(np.arange(len(members)), [len(rows[i][0]) for i in members]), at] = np.concatenate([rows[i][1] for i in members])
            v = vectors[used]
            hidden = x @ v
            z = hidden @ weights + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(members)), y[members]] -= 1
            p /= len(members)
            back = p @ weights.T
            weights -= layer_rate * falling * (hidden.T @ p)
            bias -= layer_rate * falling * p.sum(0)
            vectors[used] = v - rate * falling * (x.T @ back)
    way = (weights[:, 1] - weights[:, 0]).astype(np.float64)
    table = vectors.astype(np.float64) @ way
    table[0] = 0.0
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    shift = np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return Model(bits, table, float(bias[1] - bias[0] + shift))


def _features_of(docs: DataFrame, bits: int) -> DataFrame:
    """(doc_id, buckets, shares) of each text, at most ``2**bits`` entries each."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("buckets", T.BinaryType()), T.StructField("shares", T.BinaryType())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):  # one text at a time, whatever its length
                (ids, shares), = _rows_of(batch.column(1).slice(at, 1).to_pylist(), bits)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1), pa.array([ids.astype("<i4").tobytes()], pa.binary()),
                                                  pa.array([shares.astype("<f4").tobytes()], pa.binary())], ["doc_id", "buckets", "shares"])

    return docs.select("doc_id", "text").mapInArrow(found, schema)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = 2000, bits: int = 16, **how) -> Model:
    """Fit on at most ``train_rows`` labelled documents, half of each class
    where there are so many: those with the smallest hash of the id. The texts
    become features in tasks; the driver gets at most ``train_rows`` rows of at most
    ``2**bits`` entries, however long the texts are and however often an id occurs
    (of rows that repeat an id the one with the least MD5 of its text counts)."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality"))
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    prior = counts.get(1, 0) / max(sum(counts.values()), 1) if counts else 0.5
    by = F.xxhash64("doc_id")
    sample = known.where("quality = 0").orderBy(by, "doc_id").limit(train_rows // 2).unionAll(
        known.where("quality = 1").orderBy(by, "doc_id").limit(train_rows // 2))
    # train_rows rows of (id, label) at most: a proven bound
    whole = F.coalesce("text", F.lit(""))
    texts = (docs.select("doc_id", whole.alias("text")).join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
             .groupBy("doc_id").agg(F.min(F.struct(F.md5("text").alias("print"), "text")).alias("least"))
             .select("doc_id", F.col("least.text").alias("text")))
    rows = _features_of(texts, bits).join(F.broadcast(sample), "doc_id").toArrow().to_pydict()
    order = sorted(range(len(rows["doc_id"])), key=lambda i: (rows["doc_id"][i], rows["quality"][i]))
    features = [(np.frombuffer(rows["buckets"][i], "<i4"), np.frombuffer(rows["shares"][i], "<f4")) for i in order]
    return train_on(features, [rows["quality"][i] for i in order], prior, bits, **how)


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in column ``out``."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits doubles

    @F.arrow_udf("double")
    def rated(texts: pa.Array) -> pa.Array:
        return pa.array(scores(texts, held.value))

    return docs.withColumn(out, rated(F.col("text")))


#: Labels of these ids (a null id counts as empty text) are kept for the accuracy.
HELD_OUT = "crc32(coalesce(cast(doc_id AS string), '')) % 5 = 0"


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by a model fitted on the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels.where(f"NOT ({HELD_OUT})"))
    return (score(docs.select("doc_id", "text"), model)
            .select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")))
