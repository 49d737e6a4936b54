"""Hard-negative mining with an inverted multi-index.

Rows are cut into fragments. A fragment is one row of a table and an index of its
own: two codebooks, one for each half of the dimensions, fitted on ``SAMPLE`` of
its vectors at most; every vector belongs to the cell of its two nearest
codewords, and vectors are stored cell by cell. A codeword's radius is the largest
distance of a member's half to it. So no member of a cell can score above the sum
of two bounds: half of the query times codeword plus length of the half times
radius.

Queries come in waves of ``WAVE`` (some megabytes whatever the corpus), which are
broadcast one after the other; the fragments stay where they are. For each query
a heap walks the cells of a fragment in the order of the summed bounds
(multi-sequence: a cell opens its neighbour in the one list, and at the list's
head also the one in the other). The walk stops when no cell left can change the
answer: for positives when the next bound is below the k-th best, for negatives
when for each window the next bound is below the window or below the last of its
rows while it is full. Scores are exact whole numbers, so the answer is that of
all rows. A fragment's bests meet in a window over the query.

Defined cases: rows with a null id or label or vector, with an empty vector, or
with null or non-finite components take no part. Vectors of other lengths do not
meet. Whole numbers beyond 2**((52 - log2 of the dimensions) / 2) (2**23 at 64)
count as that, so sums of products are exact. Rows that repeat an id count once
(the least label, then vector). Ties go to the smaller id. Anchors without
positives, and positives without negatives in their window, give no rows. A
positive of a negative score has an empty window; one of score 0 takes scores of
0. Other columns are ignored, whatever their names; an empty table gives an empty
one.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import discard, new_path, written
from stratum.llm.exact_topk import valid

FRAGMENT = 16384  # vectors
SAMPLE = 2048  # vectors that a codebook is fitted on
WAVE = 4096  # queries
STEP = 512  # vectors scored at once
FITS = 4  # rounds of a codebook's fit
_FRAGMENT = "dim int, ids binary, labels binary, vectors binary, words binary, cells binary, radii binary"
_WAVE = "dim int, ids binary, labels binary, vectors binary, extra binary"


# ------------------------------------------------------------ index


def codebook(half: np.ndarray, k: int) -> np.ndarray:
    """``k`` codewords of rows of half vectors, fitted on a sample of them."""
    sample = half[:: -(-len(half) // SAMPLE)] if len(half) > SAMPLE else half
    chosen, far = [0], np.full(len(sample), np.inf)  # each codeword starts far from the ones before
    for _ in range(min(k, len(sample)) - 1):
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(far.argmax()))
    words = sample[chosen].copy()
    for _ in range(FITS):
        own = _own(sample, words)
        for w in range(len(words)):
            if (own == w).any():
                words[w] = sample[own == w].mean(0)
    return words


def _own(half: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((words * words).sum(1) - 2 * (half @ words.T)).argmin(1)


def indexed(dim: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> dict:
    """A fragment's row: vectors by cell, codewords and radii of both halves, cells' ends."""
    cut = dim // 2
    k = int(np.clip(np.sqrt(len(ids)) / 8, 1, 32))
    books = [codebook(vectors[:, :cut], k), codebook(vectors[:, cut:], k)]
    owns = [_own(half, book) for half, book in zip((vectors[:, :cut], vectors[:, cut:]), books, strict=True)]
    radii = np.zeros((2, k))
    for side, (half, book, own) in enumerate(zip((vectors[:, :cut], vectors[:, cut:]), books, owns, strict=True)):
        np.maximum.at(radii[side], own, np.sqrt(((half - book[own]) ** 2).sum(1)))
    cell = owns[0] * k + owns[1]
    order = np.lexsort((ids, cell))
    words = np.zeros((k, dim))
    words[: len(books[0]), :cut], words[: len(books[1]), cut:] = books
    return {"dim": dim, "ids": ids[order].tobytes(), "labels": labels[order].tobytes(), "vectors": vectors[order].tobytes(), "words": words.tobytes(),
            "cells": np.searchsorted(cell[order], np.arange(k * k + 1)).tobytes(), "radii": radii.tobytes()}


class Index:
    """A fragment to search in."""

    def __init__(self, row: dict):
        self.dim = row["dim"]
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        self.vectors = np.frombuffer(row["vectors"]).reshape(-1, self.dim)
        self.words = np.frombuffer(row["words"]).reshape(-1, self.dim)
        self.ends = np.frombuffer(row["cells"], "<i8").tolist()
        self.radii = np.frombuffer(row["radii"]).reshape(2, -1)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each query can score at most in each codeword's half."""
        cut = self.dim // 2
        slack = 1 + 1e-9
        return tuple(q @ w.T + (np.sqrt((q * q).sum(1)) * slack)[:, None] * r + 1e-6 for q, w, r in (  # type: ignore[return-value]
            (queries[:, :cut], self.words[:, :cut], self.radii[0]), (queries[:, cut:], self.words[:, cut:], self.radii[1])))

    def walk(self, query: np.ndarray, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """(bound, rows, scores): cells by falling bound, some at a time; no row
        that comes later scores above ``bound``."""
        a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
        one, two = first.tolist(), second.tolist()
        k = len(a)
        heap = [(-(one[a[0]] + two[b[0]]), 0, 0)]
        held: list[np.ndarray] = []
        size = 0
        while heap:
            _, i, j = heapq.heappop(heap)
            if j + 1 < k:
                heapq.heappush(heap, (-(one[a[i]] + two[b[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < k:
                heapq.heappush(heap, (-(one[a[i + 1]] + two[b[0]]), i + 1, 0))
            cell = a[i] * k + b[j]
            lo, hi = self.ends[cell], self.ends[cell + 1]
            if hi > lo:
                held.append(np.arange(lo, hi))
                size += hi - lo
            if size >= STEP or not heap:
                rows = np.concatenate(held) if held else np.zeros(0, np.int64)
                yield (-heap[0][0] if heap else -np.inf), rows, self.vectors[rows] @ query
                held, size = [], 0


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(ids) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def positives(index: Index, query: np.ndarray, own: int, label: int, k: int, floor: float, bounds: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best rows of the label that reach ``floor``."""
    ids, scores = np.zeros(0, np.int64), np.zeros(0)
    for bound, rows, new in index.walk(query, *bounds):
        good = (index.labels[rows] == label) & (new >= floor) & (index.ids[rows] != own)
        if good.any():
            ids, scores = np.concatenate([ids, index.ids[rows[good]]]), np.concatenate([scores, new[good]])
            top = _first(ids, scores, k)
            ids, scores = ids[top], scores[top]
            if len(ids) == k:
                floor = max(floor, scores[-1])
        if bound < floor:
            break
    return ids, scores


def negatives(index: Index, query: np.ndarray, label: int, lows: np.ndarray, highs: np.ndarray, k: int,
              bounds: tuple) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each window [low, high] of scores: (ids, scores) of its k best rows of other labels."""
    best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in lows]
    needed = np.where(lows <= highs, lows, np.inf)  # a window that is full asks for its last score
    for bound, rows, scores in index.walk(query, *bounds):
        good = (index.labels[rows] != label) & (scores >= needed.min()) & (scores <= highs.max())
        if good.any():
            ids, scores = index.ids[rows[good]], scores[good]
            for w in np.flatnonzero(needed < np.inf).tolist():
                inside = (scores >= needed[w]) & (scores <= highs[w])
                if inside.any():
                    i, s = np.concatenate([best[w][0], ids[inside]]), np.concatenate([best[w][1], scores[inside]])
                    top = _first(i, s, k)
                    best[w] = i[top], s[top]
                    if len(top) == k:
                        needed[w] = max(needed[w], s[top[-1]])
        if bound < needed.min():
            break
    return best


def windows(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores n with 50 p <= 100 n <= 95 p."""
    p = scores.astype(np.int64)
    return (-((-p) // 2)).astype(np.float64), (95 * p // 100).astype(np.float64)


# ------------------------------------------------------------ tables


def whole_rows(rows: DataFrame, scale: int = 256, vector: str = "embedding", row_id: str = "vec_id", label: str = "label") -> DataFrame:
    """(id, label, v array<double>) of the usable rows, each id once."""
    usable = rows.where(f"{row_id} IS NOT NULL AND {label} IS NOT NULL AND {valid(vector)}").select(
        F.col(row_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("e"))
    one = usable.groupBy("id").agg(F.min(F.struct("label", "e")).alias("r")).select("id", "r.label", "r.e")
    part = f"{scale} * double(x)"
    limit = "pow(2D, floor((52 - ceil(log2(size(e)))) / 2))"
    return one.select("id", "label", F.expr(f"transform(e, x -> double(floor(greatest(least({part}, {limit}), -{limit}))))").alias("v"))


def _dealt(rows: DataFrame, size: int, schema: str, made: Callable[[int, np.ndarray, np.ndarray, np.ndarray, list], dict]) -> DataFrame:
    """Rows (id, label, v, ...) as rows of up to ``size`` vectors of one length."""
    names = [field.split()[0] for field in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}

        def row(dim: int, lot: list[tuple]) -> pa.RecordBatch:
            ids, labels, vectors, extra = (np.concatenate([x[i] for x in lot]) for i in range(4))
            out = made(dim, ids, labels, vectors, extra.tolist())
            return pa.RecordBatch.from_arrays([pa.array([out[n]], pa.int32() if n == "dim" else pa.binary()) for n in names], names)

        for batch in batches:
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            values, dims = batch.column(2).flatten().to_numpy(zero_copy_only=False), batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            extra = np.empty(len(ids), object)
            if batch.num_columns > 3:
                extra[:] = batch.column(3).to_pylist()
            ends = np.cumsum(dims)
            for dim in np.unique(dims).tolist():
                of = np.flatnonzero(dims == dim)
                for lo in range(0, len(of), size):
                    own = of[lo : lo + size]
                    lot = held.setdefault(dim, [])
                    lot.append((ids[own], labels[own], values[(ends[own] - dim)[:, None] + np.arange(dim)], extra[own]))
                    if sum(len(x[0]) for x in lot) >= size:
                        yield row(dim, held.pop(dim))
        for dim in list(held):
            yield row(dim, held.pop(dim))

    return rows.mapInArrow(cut, schema)


def fragments(rows: DataFrame) -> DataFrame:
    return _dealt(rows, FRAGMENT, _FRAGMENT, lambda dim, ids, labels, vectors, _: indexed(dim, ids, labels, vectors))


def _wave(dim: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, extra: list) -> dict:
    """Queries as a row; ``extra``: five scores each, NaN where there are fewer."""
    own = np.full((len(ids), max([1, *[len(x or ()) for x in extra]])), np.nan)
    for i, x in enumerate(extra):
        own[i, : len(x or ())] = x or ()
    return {"dim": dim, "ids": ids.tobytes(), "labels": labels.tobytes(), "vectors": vectors.tobytes(), "extra": own.tobytes()}


def _searched(table: DataFrame, queries: DataFrame, schema: str, tag: str,
              search: Callable[[Index, dict, dict], Iterator[tuple]]) -> DataFrame:
    """What ``search`` finds for all waves of ``queries`` in all fragments. A wave
    is at most ``WAVE`` queries, so it may be broadcast; one job a wave."""
    waves = written(_dealt(queries.repartition(max(1, -(-queries.count() // WAVE))), WAVE, _WAVE, _wave)
                    .withColumn("wave", F.monotonically_increasing_id()), f"{tag}-waves")
    path = new_path(table.sparkSession, tag)
    columns = [f.split() for f in schema.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}  # what a query has found in this task, by wave
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(i)[at].as_py() for i, n in enumerate(batch.schema.names)}
                query = {n[2:]: v for n, v in row.items() if n.startswith("q_")} | {"dim": row["dim"]}
                found = list(search(Index(row), query, memory))
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(len(columns))], [c for c, _ in columns])

    for r in waves.select("wave").collect():  # one number a wave
        one = waves.where(F.col("wave") == r["wave"]).select("dim", *[F.col(c).alias(f"q_{c}") for c in ("wave", "ids", "labels", "vectors", "extra")])
        table.join(F.broadcast(one), "dim").mapInArrow(each, schema).write.mode("append").parquet(path)
    discard(waves)
    empty = table.sparkSession.createDataFrame([], schema)
    return table.sparkSession.read.schema(empty.schema).parquet(path) if _written(table.sparkSession, path) else empty


def _written(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _queries(query: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(query["ids"], "<i8")
    return (ids, np.frombuffer(query["labels"], "<i8"), np.frombuffer(query["vectors"]).reshape(len(ids), -1),
            np.frombuffer(query["extra"]).reshape(len(ids), -1))


def mine(rows: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 3) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    for ``anchors`` against all ``rows``, both (id, label, v)."""
    table = written(fragments(rows), "multi-index")

    def find_positives(index: Index, query: dict, memory: dict) -> Iterator[tuple]:
        ids, labels, vectors, _ = _queries(query)
        floors = memory.setdefault(query["wave"], np.full(len(ids), -np.inf))
        first, second = index.bounds(vectors)
        for q in range(len(ids)):
            got, scores = positives(index, vectors[q], ids[q], labels[q], n_positives, floors[q], (first[q], second[q]))
            if len(got) == n_positives:
                floors[q] = max(floors[q], scores[-1])
            yield from ((int(ids[q]), int(i), int(s)) for i, s in zip(got, scores, strict=True))

    found = _searched(table, anchors, "anchor_id long, positive_id long, positive_score long", "positives", find_positives)
    nth = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    near = written(found.withColumn("nth", nth).where(F.col("nth") <= n_positives), "positive-pairs")
    scores = near.groupBy("anchor_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "positive_score"))),
                                                       lambda x: x["positive_score"].cast("double")).alias("scores"))  # n_positives at most

    def find_negatives(index: Index, query: dict, memory: dict) -> Iterator[tuple]:
        ids, labels, vectors, given = _queries(query)
        first, second = index.bounds(vectors)
        for q in range(len(ids)):
            p = given[q][~np.isnan(given[q])]
            for w, (got, score) in enumerate(negatives(index, vectors[q], labels[q], *windows(p), n_negatives, (first[q], second[q]))):
                yield from ((int(ids[q]), w + 1, int(i), int(s)) for i, s in zip(got, score, strict=True))

    asked = anchors.join(scores, anchors["id"] == scores["anchor_id"]).select("id", "label", "v", "scores")
    hard = _searched(table, asked, "anchor_id long, nth long, negative_id long, negative_score long", "negatives", find_negatives)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "nth").orderBy(F.desc("negative_score"), "negative_id"))
    return hard.withColumn("rank", rank).where(F.col("rank") <= n_negatives).join(
        near.withColumn("nth", F.col("nth").cast("long")), ["anchor_id", "nth"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, among all vectors."""
    rows = whole_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = written(rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))), "mined-rows")
    return mine(rows, rows.where("id % 50 = 0"))


OP13_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, c) <= 5)
SELECT p.a AS anchor_id, p.c AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.c AS negative_id,
  p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.a, p.c ORDER BY n.score DESC, n.c) QUALIFY row_number() OVER w <= 3
"""
