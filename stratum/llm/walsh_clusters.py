"""Centroid clustering of whole-number vectors by Walsh-Hadamard progressive search.

The transform of a vector holds its sums over patterns of signs; it needs only
additions of whole numbers, so it is exact, and squared distances of transforms
are the number of dimensions times those of the vectors. In the order used here
the first 2**l coefficients tell the averages over 2**l stretches of the vector:
coarse to fine. For a block of vectors the squared differences to all centroids
are accumulated a level of coefficients at a time. What is accumulated never
falls, so a centroid whose sum is already above the full distance of another one
is strictly worse and goes; equal ones stay. A vector's bound is the full distance
of the centroid that is nearest on the coarse levels. The survivors are finished
over all coefficients, ties go to the smaller number.

A round reads the vectors once, in tasks; a task gives a sum for each centroid
and dimension and a count, so however large a cluster is, a task sends one row a
centroid and dimension. The driver holds the centroids only (``k`` times the
dimensions, both parameters).

Defined cases: vectors that are null, of another length, or that hold null or
non-finite components take no part, nor do rows of a null id. Whole numbers beyond
2**30 / dimensions (2**24 at 64) count as that, so every distance is exact in a long. Rows that
repeat an id are vectors of their own. Equal starting hashes (repeated ids) go in
the order of the vectors. With fewer vectors than centroids there are as many
centroids as vectors; an empty table gives an empty one. A centroid that nothing
is nearest to stays. Sums of distances stop at the largest long. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import discard, written

REACH = 1 << 30
LONGEST = (1 << 63) - 1
BLOCK = 4096  # vectors looked at together


def whole_vectors(rows: DataFrame, scale: int, dim: int, vector: str, row_id: str) -> DataFrame:
    """(id, v array<int>) with floor(scale * x) of each component."""
    usable = (f"{row_id} IS NOT NULL AND size({vector}) = {dim} AND "
              f"forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    part, limit = f"{scale} * double(x)", REACH // dim
    return rows.where(usable).select(F.col(row_id).alias("id"), F.expr(
        f"transform({vector}, x -> int(floor(greatest(least({part}, double({limit})), double({-limit})))))").alias("v"))


def transform(vectors: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of rows of a power of two of whole numbers, by
    butterflies; coefficients from coarse to fine."""
    n, dim = vectors.shape
    out, half = vectors.astype(np.int64), dim // 2
    while half:
        pairs = out.reshape(n, dim // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, dim)
        half //= 2
    return out[:, _coarse_first(dim)]


def _coarse_first(dim: int) -> np.ndarray:
    """Places of the coefficients whose signs change over the longest stretches
    first: numbers with their bits in reverse."""
    place = np.zeros(dim, np.int64)
    bits = dim.bit_length() - 1
    for b in range(bits):
        place |= (np.arange(dim) >> b & 1) << (bits - 1 - b)
    return place


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance) of each transformed vector's nearest transformed
    centroid, and how many coefficients were looked at."""
    n, dim = vectors.shape
    k = len(centroids)
    level = min(8, dim)  # coarse levels, for all pairs
    total = np.zeros((n, k), np.int64)
    for c in range(level):
        gap = vectors[:, c, None] - centroids[None, :, c]
        total += gap * gap
    looked = n * k * level
    guess = total.argmin(1)
    rest = vectors[:, level:] - centroids[guess, level:]
    bound = total[np.arange(n), guess] + (rest * rest).sum(1)
    row, number = np.nonzero(total <= bound[:, None])
    so_far = total[row, number]
    while level < dim:
        finer = min(2 * level, dim)
        gap = vectors[row, level:finer] - centroids[number, level:finer]
        looked += gap.size
        so_far = so_far + (gap * gap).sum(1)
        left = so_far <= bound[row]
        row, number, so_far, level = row[left], number[left], so_far[left], finer
    # rows come in order, numbers in order within them
    first = np.searchsorted(row, np.arange(n))
    least = np.minimum.reduceat(so_far, first)
    hit = np.flatnonzero(so_far == least[row])
    return number[hit[np.searchsorted(row[hit], np.arange(n))]], least // dim, looked


def _batches(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            part = batch.slice(lo, BLOCK)
            yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and sum of the vectors nearest to each centroid; one row a centroid
    and dimension comes back."""
    dim, turned = centroids.shape[1], transform(centroids)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(turned), np.int64), np.zeros(centroids.shape, np.int64)
        for _, v in _batches(batches, dim):
            number, _, _ = nearest(transform(v), turned)
            order = np.argsort(number, kind="stable")
            held, first = np.unique(number[order], return_index=True)
            count[held] += np.diff(np.append(first, len(order)))
            total[held] += np.add.reduceat(v[order].astype(np.int64), first, axis=0)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({
            "number": pa.array(np.repeat(held, dim), pa.int32()), "d": pa.array(np.tile(np.arange(dim), len(held)), pa.int32()),
            "n": pa.array(np.repeat(count[held], dim), pa.int64()), "total": pa.array(total[held].reshape(-1), pa.int64())})

    out: dict[int, tuple[int, list[int]]] = {}
    rows = vectors.mapInArrow(added, "number int, d int, n long, total long").groupBy("number", "d").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    for r in sorted(rows.collect()):
        out.setdefault(r["number"], (r["n"], []))[1].append(r["total"])
    return out


def start(vectors: DataFrame, k: int, seed: int, dim: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of seed and id."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(-1, dim)


def fit(vectors: DataFrame, k: int, rounds: int, seed: int, dim: int) -> np.ndarray:
    """Centroids after ``rounds`` of assignment and exact floored means."""
    centroids = start(vectors, k, seed, dim)
    for _ in range(rounds if len(centroids) else 0):
        for number, (n, total) in _sums(vectors, centroids).items():
            centroids[number] = [t // n for t in total]
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    dim, turned = centroids.shape[1], transform(centroids)
    kind = vectors.schema["id"].dataType.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, v in _batches(batches, dim):
            number, distance, _ = nearest(transform(v), turned)
            yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(distance, pa.int64())], ["id", "cluster", "distance"])

    return vectors.mapInArrow(found, f"id {kind}, cluster int, distance long")


def clusters(rows: DataFrame, k: int, rounds: int, seed: int, scale: int = 256, dim: int = 64, vector: str = "embedding",
             row_id: str = "vec_id") -> DataFrame:
    """Every vector with its cluster, distance, the sums of distances over its
    cluster and over all, and a hash of its centroid."""
    if dim & (dim - 1):
        raise ValueError("the transform takes a power of two of dimensions")
    vectors = written(whole_vectors(rows, scale, dim, vector, row_id), "walsh-vectors")
    centroids = fit(vectors, k, rounds, seed, dim)
    found = written(assign(vectors, centroids), "walsh-assigned")
    discard(vectors)
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    each = found.groupBy("cluster").agg(whole.alias("inertia")).collect()  # one row a centroid
    longest = lambda x: min(int(x), LONGEST)
    names = [(r["cluster"], longest(r["inertia"]), longest(sum(x["inertia"] for x in each)),
              hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest()) for r in each]
    named = rows.sparkSession.createDataFrame(names, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.withColumnRenamed("id", row_id).join(F.broadcast(named), "cluster").select(  # at most k rows
        row_id, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_walsh_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 clusters of all vectors of 64 dimensions after five rounds."""
    return clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=40, rounds=5, seed=2)


def _rounds_sql(rounds: int) -> str:
    """The same rounds as chained common tables; components as rows."""
    parts = ["""v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             """c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS INTEGER) AS c, v AS m FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id), v) <= 40)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT r, min({{'d': d, 'c': c}}) AS b FROM (
  SELECT r, c, CAST(list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v CROSS JOIN c{i}) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""s{i} AS (SELECT c, k, sum(x) AS total, count(*) AS n FROM (
  SELECT a{i}.b.c AS c, unnest(v) AS x, unnest(range(64)) AS k FROM a{i} JOIN v USING (r)) GROUP BY c, k)""")
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(n.m, c{i}.m) AS m FROM c{i} LEFT JOIN (
  SELECT c, list(CAST((total - (total % n + n) % n) // n AS BIGINT) ORDER BY k) AS m FROM s{i} GROUP BY c) n ON n.c = c{i}.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT v.vec_id, a.b.c AS cluster, a.b.d AS distance, CAST(sum(a.b.d) OVER (PARTITION BY a.b.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.b.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} f ON f.c = a.b.c
"""


OP11_SQL = _rounds_sql(5)
