"""Exact top-k by inner product: columnar branch and bound.

Candidates and queries are cut into fragments; a fragment is one row that holds
its vectors in vertical layout (a run of numbers for each dimension). Fragments
of queries meet fragments of candidates of the same number of dimensions in an
equi-join on fragment ids, so that a task has some megabytes at a time, however
many queries or rows there are. For a pair of fragments, inner products are
accumulated for all candidates a block of dimensions at a time. What the other
dimensions can still add is at most the product of the two vectors' remaining
norms (Cauchy-Schwarz); candidates whose sum and remaining mass stay below the
query's k-th best so far are dropped and the rest is compacted before the next
block. The k-th best of a query is carried on to the next fragments of a task.
Every fragment gives its k best of each query; a window takes the k best of all.

Vectors hold whole numbers as doubles. Sums are exact as long as the product of
the norms is below 2**52, which each pair of fragments checks; beyond that whole
Python numbers are used, and scores saturate at the limits of a long.

Defined cases: null ids and vectors that are null, empty or hold null or
non-finite components take no part. Vectors of different lengths do not meet.
Rows that repeat an id count once (the least vector); a query's own id is no
candidate. Ties go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import written

FRAGMENT = 4096  # candidates
QUERIES = 1024
STEP = 8  # dimensions between two bounds
EXACT = 2.0**52
_FRAGMENT = "dim int, n int, ids binary, data binary"


def valid(vector: str) -> str:
    """SQL for: the vector takes part."""
    return (f"{vector} IS NOT NULL AND size({vector}) > 0 AND "
            f"forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")


def fragments(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` (id, v array<double> of whole numbers) as fragments of up to
    ``size`` vectors of the same length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}

        def made(dim: int) -> pa.RecordBatch:
            ids, vectors = (np.concatenate(x) for x in held.pop(dim))
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "n": pa.array([len(ids)], pa.int32()),
                "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                "data": pa.array([np.ascontiguousarray(vectors.T).astype("<f8").tobytes()], pa.binary())})

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            column = batch.column(1)
            values = column.flatten().to_numpy(zero_copy_only=False)
            dims = column.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(dims)
            for dim in np.unique(dims).tolist():
                of = np.flatnonzero(dims == dim)
                vectors = values[(ends[of] - dim)[:, None] + np.arange(dim)]
                for lo in range(0, len(of), size):
                    known = held.setdefault(dim, ([], []))
                    known[0].append(ids[of[lo : lo + size]])
                    known[1].append(vectors[lo : lo + size])
                    if sum(map(len, known[0])) >= size:
                        yield made(dim)
        for dim in list(held):
            yield made(dim)

    return rows.select("id", "v").mapInArrow(cut, _FRAGMENT).withColumn("fragment", F.monotonically_increasing_id())


def best(queries: np.ndarray, query_ids: np.ndarray, columns: np.ndarray, ids: np.ndarray, k: int,
         floor: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's place, ids, scores) of the up to k best candidates of each query
    that reach its ``floor``, which rises to the k-th best found."""
    dim, n = columns.shape
    left_c = np.sqrt(np.concatenate([np.cumsum((columns**2)[::-1], 0)[::-1], np.zeros((1, n))]))
    left_q = np.sqrt(np.concatenate([np.cumsum((queries**2)[:, ::-1], 1)[:, ::-1], np.zeros((len(queries), 1))], 1))
    exact = left_c[0].max(initial=0) * left_q[:, 0].max(initial=0) < EXACT
    if not exact:
        whole_c = np.array([[int(x) for x in r] for r in columns], object)
    for q in range(len(queries)):
        if exact:
            alive, total = np.arange(n), np.zeros(n)
            for d in range(0, dim, STEP):
                e = min(d + STEP, dim)
                part = columns[d:e] if len(alive) == n else columns[d:e, alive]
                total = total + queries[q, d:e] @ part
                if d == 0 and len(alive) > 4 * k and floor[q] == -np.inf:  # a first floor: the most promising in full
                    top = alive[np.argpartition(-total, 2 * k)[: 2 * k]]
                    top = top[ids[top] != query_ids[q]]
                    if len(top) >= k:
                        floor[q] = np.partition(queries[q] @ columns[:, top], -k)[-k]
                reach = total + left_q[q, e] * left_c[e, alive] * (1 + 1e-9) + 1e-6 >= floor[q]
                if not reach.all():
                    alive, total = alive[reach], total[reach]
                if not len(alive):
                    break
            scores = total
        else:
            alive = np.arange(n)
            sums = [sum(int(a) * b for a, b in zip(queries[q], whole_c[:, i], strict=True)) for i in range(n)]
            scores = np.array([max(min(s, (1 << 63) - 1), -(1 << 63)) for s in sums], object)
        other = ids[alive] != query_ids[q]
        alive, scores = alive[other], scores[other]
        if exact and len(alive) > 4 * k:
            cut = np.partition(scores, -k)[-k]
            alive, scores = alive[scores >= cut], scores[scores >= cut]
        order = sorted(range(len(alive)), key=lambda i: (-scores[i], ids[alive[i]]))[:k]
        if exact and len(order) == k:
            floor[q] = max(floor[q], scores[order[-1]])
        yield q, ids[alive[order]], scores[order]


def top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest inner products of each row
    of ``queries`` with the other rows of ``rows``, both (id, v array<double>)."""
    spark = rows.sparkSession
    candidates = written(fragments(rows, FRAGMENT), "topk-rows")
    asked = written(fragments(queries, QUERIES), "topk-queries")
    cells = candidates.select("fragment", "dim").join(asked.select(F.col("fragment").alias("asked"), "dim"), "dim").drop("dim")
    found = (cells.join(asked.select(F.col("fragment").alias("asked"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data")), "asked")
             .join(candidates.select("fragment", "dim", "ids", "data"), "fragment"))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                ids, q_ids = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["q_ids"], "<i8")
                columns = np.frombuffer(r["data"], "<f8").reshape(r["dim"], -1)
                vectors = np.frombuffer(r["q_data"], "<f8").reshape(r["dim"], -1).T.copy()
                if len(floors) > 64:
                    floors.clear()
                floor = floors.setdefault(r["asked"], np.full(len(q_ids), -np.inf))
                got = list(best(vectors, q_ids, columns, ids, k, floor))
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(np.repeat(q_ids[[q for q, _, _ in got]], [len(i) for _, i, _ in got]), pa.int64()),
                    "vec_id": pa.array(np.concatenate([i for _, i, _ in got]), pa.int64()),
                    "score": pa.array([int(s) for _, _, x in got for s in x], pa.int64())})

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("query_id", "vec_id", "score")])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.mapInArrow(searched, schema).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def whole_numbers(embeddings: DataFrame, scale: int = 1024) -> DataFrame:
    """(id, v) with floor(scale * x) of each component."""
    one = embeddings.where(f"vec_id IS NOT NULL AND {valid('embedding')}").groupBy("vec_id").agg(F.min("embedding").alias("e"))
    # floor() of doubles would be a long; beyond its range the product has no fraction anyway
    part = f"{scale} * double(x)"
    return one.select(F.col("vec_id").cast("long").alias("id"), F.expr(
        f"transform(e, x -> CASE WHEN abs({part}) < 1e15D THEN double(floor({part})) ELSE {part} END)").alias("v"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 largest integer inner products of every hundredth vector."""
    rows = whole_numbers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(rows, rows.where("id % 100 = 0"), 10)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""
