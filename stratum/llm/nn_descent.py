"""Approximate nearest neighbours: NN-descent graph and greedy graph search.

Nearness is the cosine. Equal vectors are one node (its least id), so a vector
that a third of all rows share is one node too; a node keeps its ``k + 1`` least
ids, all that k neighbours can need.

The graph starts from runs of nodes that follow each other when they are sorted
by the signs of random projections, several times with other projections; within
a run (bounded) every node takes its nearest. Then NN-descent: every node gathers
its neighbours and up to ``REVERSE`` nodes that name it as theirs, their vectors
are joined to them, and each gathered node that the pair is new to is offered its
nearest among the others, if that beats the neighbours it has. Rounds end when
few neighbours change.

Queries walk the graph: a query's beam starts at its own node, if it is a row of
the graph, else at a fixed few; in each round the
nodes among its ``BEAM`` nearest that were not expanded yet are expanded, all
queries at once in joins, until no query has any left. Between two rounds a query
keeps its beam, and the ids of the nodes it has met in a table that only grows. The
beam is then ranked by the exact cosine of the original vectors, in double precision.

Graph and walk use unit vectors in single precision and compare them by their
distance, summed in double: ``sim`` is the cosine less 1, so that it keeps its
digits among near copies, whose cosines differ by less than 1e-6.

Defined cases: null ids, and vectors that are null, empty, zero or hold null or
non-finite components, take no part. Vectors of different lengths are not
compared. Rows that repeat an id count once (the least vector). Ties go to the
smaller id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import discard, written
from stratum.llm.exact_topk import valid

NEIGHBOURS = 32
REVERSE = 20
OFFERS = 6  # to a gathered node by one that gathered it
STARTS = 3
RUN = 256
ROUNDS = 12
LITTLE = 0.05  # share of changed neighbours that ends the descent
BEAM = 160
ENTRIES = 128
NONE = -3  # below any sim
_EDGE = "node long, nbr long, sim float"


@dataclass
class Graph:
    """``nodes``: node, dim, ids, u (unit vector, single precision), e (original);
    ``edges``: node, nbr, sim."""

    nodes: DataFrame
    edges: DataFrame


@F.arrow_udf(T.BinaryType())
def _unit(vectors: pa.Array) -> pa.Array:
    out = []
    for v in vectors:
        x = np.array(v.values.to_numpy(zero_copy_only=False), np.float64)
        x = x / np.abs(x).max()
        out.append((x / np.sqrt(x @ x)).astype(np.float32).tobytes())
    return pa.array(out, pa.binary())


def _signs(seed: int):
    @F.arrow_udf(T.LongType())
    def code(units: pa.Array) -> pa.Array:
        """Signs of 30 random projections as one number."""
        out = np.zeros(len(units), np.int64)
        rows = [np.frombuffer(u.as_buffer(), np.float32) for u in units]
        sizes = np.array([len(r) for r in rows])
        for dim in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == dim)
            planes = np.random.default_rng([seed, dim]).normal(size=(dim, 30)).astype(np.float32)
            out[at] = (np.stack([rows[i] for i in at]) @ planes > 0) @ (1 << np.arange(30))
        return pa.array(out)

    return code


def _sims(u: np.ndarray) -> np.ndarray:
    """Cosine less 1 (half the squared distance, negated) of all pairs of rows."""
    u = u.astype(np.float64)
    dot = u @ u.T
    half = dot.diagonal() / 2
    return (dot - half[:, None] - half).astype(np.float32)


def _top(sims: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of each row."""
    if sims.shape[1] <= k:
        return np.broadcast_to(np.arange(sims.shape[1]), sims.shape)
    return np.argpartition(-sims, k - 1, 1)[:, :k]


def _edges(a: list, b: list, s: list) -> pa.RecordBatch:
    cat = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
    return pa.RecordBatch.from_pydict({"node": pa.array(cat(a, np.int64)), "nbr": pa.array(cat(b, np.int64)), "sim": pa.array(cat(s, np.float32))})


def _in_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node's nearest within runs of RUN rows of the same length of vector."""
    nodes, units = [], []

    def near() -> pa.RecordBatch:
        ids = np.array(nodes)
        sims = _sims(np.stack([np.frombuffer(x, np.float32) for x in units]))
        np.fill_diagonal(sims, NONE)
        top = _top(sims, NEIGHBOURS)
        rows = np.repeat(np.arange(len(ids)), top.shape[1])
        s = sims[rows, top.reshape(-1)]
        real = s > NONE
        return _edges([ids[rows][real]], [ids[top.reshape(-1)][real]], [s[real]])

    for batch in batches:
        for node, unit in zip(batch.column("node").to_pylist(), batch.column("u").to_pylist(), strict=True):
            if nodes and (len(nodes) == RUN or len(unit) != len(units[0])):
                yield near()
                nodes, units = [], []
            nodes.append(node)
            units.append(unit)
    if nodes:
        yield near()


def _local_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (owner, member, new, worst, u), sorted by owner: what each member is
    offered of the owner's other members."""

    def offers(rows: pa.Table) -> pa.RecordBatch:
        owner = rows.column("owner").to_numpy()
        member, new = rows.column("member").to_numpy(), rows.column("new").to_numpy(zero_copy_only=False)
        worst, units = rows.column("worst").to_numpy(), rows.column("u").to_pylist()
        edge = np.flatnonzero(np.diff(owner, prepend=owner[0] - 1, append=owner[-1] + 1))
        a, b, s = [], [], []
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            if hi - lo < 2:
                continue
            sims = _sims(np.frombuffer(b"".join(units[lo:hi]), np.float32).reshape(hi - lo, -1))
            sims[~(new[lo:hi, None] | new[None, lo:hi])] = NONE
            np.fill_diagonal(sims, NONE)
            sims[sims <= worst[lo:hi, None]] = NONE
            top = _top(sims, OFFERS)
            r = np.repeat(np.arange(hi - lo), top.shape[1])
            c = top.reshape(-1)
            good = sims[r, c] > NONE
            a.append(member[lo:hi][r[good]])
            b.append(member[lo:hi][c[good]])
            s.append(sims[r, c][good])
        return _edges(a, b, s)

    rest = None
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]).combine_chunks() if rest is not None else rows
        owner = rows.column("owner").to_numpy()
        cut = int(np.searchsorted(owner, owner[-1]))  # the last owner may go on
        if cut:
            yield offers(rows.slice(0, cut))
        rest = rows.slice(cut)
    if rest is not None and len(rest):
        yield offers(rest)


def _nearest_k(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each node, each neighbour once; one exchange for both."""
    dealt = edges.repartition("node").groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "nbr"))
    return dealt.withColumn("r", rank).where(F.col("r") <= k).drop("r")


def build(vectors: DataFrame, k: int) -> Graph:
    """Graph over (id, e array<double>); k: as many neighbours as queries will ask for."""
    first = F.row_number().over(Window.partitionBy("e").orderBy("id"))
    kept = vectors.withColumn("r", first).where(F.col("r") <= k + 1)  # at most k + 1 rows of each vector
    nodes = written(kept.groupBy("e").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                    .select(F.col("ids")[0].alias("node"), "ids", F.size("e").alias("dim"), _unit("e").alias("u"), "e"), "nn-nodes")
    slim = nodes.select("node", "u")
    # runs end at the borders of partitions, so these are some runs long
    parts = max(1, min(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), nodes.count() // (8 * RUN)))
    edges = None
    for seed in range(STARTS):
        coded = nodes.select("node", "dim", "u", _signs(seed)("u").alias("code"))
        runs = coded.repartitionByRange(parts, "dim", "code", "node").sortWithinPartitions("dim", "code", "node")
        found = runs.select("node", "u").mapInArrow(_in_runs, _EDGE)
        edges = found if edges is None else edges.unionAll(found)
    graph = written(_nearest_k(edges.withColumn("new", F.lit(True)), NEIGHBOURS), "nn-edges", few=True)
    size = graph.count()
    for _ in range(ROUNDS):
        worst = graph.groupBy("node").agg(F.when(F.count("*") >= NEIGHBOURS, F.min("sim")).otherwise(F.lit(float(NONE))).cast("float").alias("worst"))
        some = F.row_number().over(Window.partitionBy("nbr").orderBy(F.desc("new"), F.xxhash64("node")))
        back = graph.withColumn("r", some).where(F.col("r") <= REVERSE).select(F.col("nbr").alias("owner"), F.col("node").alias("member"), "new")
        gathered = (graph.select(F.col("node").alias("owner"), F.col("nbr").alias("member"), "new").unionAll(back)
                    .groupBy("owner", "member").agg(F.max("new").alias("new")))
        with_vector = (gathered.join(slim.withColumnRenamed("node", "member"), "member")
                       .join(worst.withColumnRenamed("node", "member"), "member", "left")
                       .select("owner", "member", "new", F.coalesce("worst", F.lit(float(NONE)).cast("float")).alias("worst"), "u"))
        offered = with_vector.repartition("owner").sortWithinPartitions("owner").mapInArrow(_local_join, _EDGE)
        more = offered.withColumn("new", F.lit(True)).unionByName(graph.withColumn("new", F.lit(False)))
        better = written(_nearest_k(more, NEIGHBOURS), "nn-edges", few=True)
        discard(graph)
        graph = better
        if graph.where("new").count() <= LITTLE * size:
            break
    return Graph(nodes, graph.select("node", "nbr", "sim"))


@F.arrow_udf(T.FloatType())
def _sim_of_units(a: pa.Array, b: pa.Array) -> pa.Array:
    x, y = a.to_pylist(), b.to_pylist()
    out = np.zeros(len(x), np.float32)
    sizes = np.array([len(v) for v in x])
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        p, q = (np.frombuffer(b"".join([z[i] for i in at]), np.float32).reshape(len(at), -1).astype(np.float64) for z in (x, y))
        out[at] = -np.square(p - q).sum(1) / 2
    return pa.array(out)


@F.arrow_udf(T.DoubleType())
def _cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    """Of original vectors, in double precision."""
    out = np.zeros(len(a))
    for i, (v, w) in enumerate(zip(a, b, strict=True)):
        x = np.array(v.values.to_numpy(zero_copy_only=False), np.float64)
        y = np.array(w.values.to_numpy(zero_copy_only=False), np.float64)
        m, n = np.abs(x).max(), np.abs(y).max()
        if not (1e-100 < m < 1e100 and 1e-100 < n < 1e100):  # squares would leave the range
            x, y = x / m, y / n
        out[i] = (x @ y) / (np.sqrt(x @ x) * np.sqrt(y @ y))
    return pa.array(out)


def _beam(rows: DataFrame) -> DataFrame:
    """The ``BEAM`` nearest nodes of each walker."""
    rank = F.row_number().over(Window.partitionBy("own").orderBy(F.desc("sim"), "node"))
    return rows.withColumn("r", rank).where(F.col("r") <= BEAM).drop("r")


def search(graph: Graph, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each of the
    queries (query_id, e array<double>), the query's own id excepted. Queries
    that are no row of the graph start from ``ENTRIES`` nodes."""
    nodes = graph.nodes
    asked = written(queries.where(f"query_id IS NOT NULL AND {valid('e')} AND exists(e, x -> x <> 0)").groupBy("query_id").agg(F.min("e").alias("e")), "nn-queries", few=True)
    # copies of a vector walk the graph once
    walker = written(asked.groupBy("e").agg(F.min("query_id").alias("own")).join(nodes.select("node", "e"), "e", "left")
                     .select("own", "e", "node", _unit("e").alias("q"), F.size("e").alias("dim")), "nn-walkers", few=True)
    asked = asked.join(walker.select("own", "e"), "e").select("query_id", "own", F.col("e").alias("qe"))
    first = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("node")))
    entries = nodes.select("dim", "node", "u").withColumn("r", first).where(F.col("r") <= ENTRIES).drop("r")
    strangers = walker.where("node IS NULL").select("own", "q", "dim").join(entries, "dim")
    some = F.row_number().over(Window.partitionBy("nbr").orderBy(F.desc("sim"), "node"))
    near = graph.edges.select("node", "nbr").unionAll(
        graph.edges.withColumn("r", some).where(F.col("r") <= REVERSE).select(F.col("nbr").alias("node"), F.col("node").alias("nbr"))).distinct()
    near, slim = written(near, "nn-near", few=True), nodes.select("node", "u")
    start = walker.where("node IS NOT NULL").select("own", "node", F.lit(0.0).cast("float").alias("sim")).unionByName(
        strangers.select("own", "node", _sim_of_units("q", "u").alias("sim")))
    scored = written(start, "nn-seen", few=True)
    beam = written(_beam(scored.withColumn("done", F.lit(False))), "nn-beam", few=True)
    seen = scored.select("own", "node")  # a table a round: each pair is written once
    walker = walker.select("own", "q")
    while True:
        front = beam.where(~F.col("done")).select("own", "node")
        if front.isEmpty():
            break
        reached = front.join(near, "node").select("own", F.col("nbr").alias("node")).distinct().join(seen, ["own", "node"], "left_anti")
        scored = written(reached.join(slim, "node").join(walker, "own").select("own", "node", _sim_of_units("q", "u").alias("sim")), "nn-seen", few=True)
        seen = seen.unionAll(scored.select("own", "node"))
        # all of the beam is expanded now, and what has left it is no nearer than what is in it
        now = written(_beam(beam.withColumn("done", F.lit(True)).unionByName(scored.withColumn("done", F.lit(False)))), "nn-beam", few=True)
        discard(beam)
        beam = now
    scored = (asked.join(beam, "own").join(nodes.select("node", "ids", "e"), "node")
              .select("query_id", "ids", _cosine("qe", "e").alias("score")))
    found = scored.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def vectors_of(embeddings: DataFrame) -> DataFrame:
    """(id, e) of the rows that take part."""
    return (embeddings.where(f"vec_id IS NOT NULL AND {valid('embedding')} AND exists(embedding, x -> x <> 0)")
            .groupBy(F.col("vec_id").cast("long").alias("id")).agg(F.min("embedding").alias("e")).select("id", F.col("e").cast("array<double>").alias("e")))


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest found, by cosine, of every fiftieth vector."""
    vectors = vectors_of(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    graph = build(vectors, k=5)
    return search(graph, vectors.where("id % 50 = 0").withColumnRenamed("id", "query_id"), k=5)
