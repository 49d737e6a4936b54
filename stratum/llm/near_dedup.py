"""MinHash near-dedup by BagMinHash.

A document is the multiset of its five-word shingles (white-space-bounded words,
ASCII case ignored; a text of fewer words is one shingle). Its signature holds,
for each of ``SIZE`` components, the first arrival of Poisson processes that
belong to the shingles: weights are discretised to integers and cut into strata
[0,1), [1,2), [2,4), [4,8), ..., each with a process of its own whose rate is the
stratum's width and whose points carry a position in it. A shingle of weight w
takes the points below w of the strata that begin below w. Processes of equal
shingles agree in all texts, so two components are equal with the probability of
the weighted Jaccard similarity, whatever the weights. Points come in the order
of time and end when they pass the largest component, so a signature costs about
``SIZE * ln SIZE`` points besides one for each shingle.

Signatures are cut into ``BANDS`` bands of ``ROWS`` components. Texts that share
a band are candidates. Copies (equal word sequences) are one text from the start.
Within a shared band no pairs are spelled out: a text is compared with the most
central one of all its bands, and those outside a band's largest component then
found once more with the most central of themselves. What is left are bands that still hold
several components. There the members outside the largest one meet all others in
cells of bounded bytes, with their whole multisets: a prefix filter without loss
leaves few pairs, pairs that are joined already are passed over, the rest is
compared exactly, and a cell gives a spanning forest of its links. A comparison
with a star's centre first looks at the signatures and, unless these are far apart
(``LEAST``, four standard errors below the threshold), computes the exact multiset
overlap of the whole texts; a pair that this misses meets again in the cells.

Defined cases: null and empty texts, and texts without words, are classes of
their own. A class is a connected component of the links; its id is its least
doc_id (null ids do not count; a class of null ids only has a null id). Rows that
repeat an id and a text are copies. Texts of any length are read in blocks; other
columns are ignored, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import _ODD, _U, discard, mix, row_words, uniform, written
from stratum.llm.components import components

WORDS = 5
BANDS, ROWS = 24, 5
SIZE = BANDS * ROWS
LEAST = 0.65
ASKING, ASKED = 1 << 16, 1 << 17  # words of the members in a cell: about 1 and 2 MB
GROUPS = 1024  # of shingles, for a bound on what two texts share
RUN = 128  # texts whose signatures are computed side by side
_PLACES = mix(np.arange(1, WORDS + 1, dtype=_U) * _ODD) | _U(1)


def shingles(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, row, count) of the rows' multisets, sorted in each row."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    all_rows = np.repeat(np.arange(n), sizes)
    each, rows = [], []
    if len(words) >= WORDS:
        sums = words[: len(words) - WORDS + 1] * _PLACES[0]
        for k in range(1, WORDS):
            sums = sums + words[k : len(words) - WORDS + 1 + k] * _PLACES[k]
        whole = all_rows[: len(sums)] == all_rows[WORDS - 1 :]
        each.append(mix(sums[whole]))
        rows.append(all_rows[: len(sums)][whole])
    short = np.flatnonzero((sizes > 0) & (sizes < WORDS))
    if len(short):
        each.append(np.array([mix((words[offsets[i] : offsets[i + 1]] * _PLACES[: sizes[i]]).sum(keepdims=True) + _U(sizes[i]))[0] for i in short.tolist()], _U))
        rows.append(short)
    if not each:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, row = np.concatenate(each), np.concatenate(rows)
    if len(short):
        order = np.argsort(row, kind="stable")
        key, row = key[order], row[order]
    edges = np.searchsorted(row, np.arange(n + 1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        key[a:b].sort()
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return key[first], row[first], np.diff(np.append(first, len(key)))


def signatures(key: np.ndarray, row: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """BagMinHash values (n, SIZE) of n multisets, zeros for empty ones. A value
    names the point that came first; the times themselves may differ in their
    last bits with the texts beside them."""
    sig = np.full((n, SIZE), np.inf)
    named = np.zeros((n, SIZE), _U)
    # the strata that begin below the weight
    keys, rows, weights, low, width = [key], [row], [count], [np.zeros(len(key))], [np.ones(len(key))]
    k, more = 1, count > 1
    strata = [np.zeros(len(key), _U)]
    while more.any():
        begin = 1 << (k - 1)
        more = count > begin
        keys.append(key[more])
        rows.append(row[more])
        weights.append(count[more])
        low.append(np.full(more.sum(), float(begin)))
        width.append(np.full(more.sum(), float(begin)))
        strata.append(np.full(more.sum(), k, _U))
        k += 1
    key, row, weight = np.concatenate(keys), np.concatenate(rows), np.concatenate(weights)
    low, width = np.concatenate(low), np.concatenate(width)
    seed = mix(key + np.concatenate(strata) * _ODD)
    mass = np.bincount(row, width, n)
    time, step = np.zeros(len(seed)), np.zeros(len(seed), np.int64)
    goal = 1.1 * SIZE * (np.log(SIZE) + 1.5)  # points that mostly fill a signature
    while len(seed):
        # so many points at once that the row as a whole has about `goal`
        points = np.maximum(1, np.ceil(goal * width / np.maximum(mass[row], 1))).astype(np.int64)
        points = np.minimum(points, 4096)
        at = np.repeat(np.arange(len(seed)), points)
        last = np.cumsum(points)
        nth = np.arange(len(at)) - (last - points)[at]
        h = mix(seed[at] + (step[at] + nth + 1).astype(_U) * _ODD)
        gap = -np.log(uniform(h)) / width[at]
        run = np.cumsum(gap)
        run -= np.concatenate([[0.0], run[last[:-1] - 1]])[at]
        when = run + time[at]
        h = mix(h ^ _U(0xA0761D6478BD642F))
        index = ((h >> _U(32)) * _U(SIZE) >> _U(32)).astype(np.int64)
        position = low[at] + (h & _U(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * width[at]
        good = position < weight[at]
        cell, soon, point = (row[at] * SIZE + index)[good], when[good], h[good]
        np.minimum.at(sig.reshape(-1), cell, soon)
        won = soon == sig.reshape(-1)[cell]
        named.reshape(-1)[cell[won]] = point[won]
        time, step = when[last - 1], step + points
        goal = SIZE / 4
        on = time <= sig.max(1)[row]
        seed, row, weight, low, width, time, step = (x[on] for x in (seed, row, weight, low, width, time, step))
        mass = np.bincount(row, width, n)
    return named


_PRINT = T.StructType([
    T.StructField("fp", T.BinaryType()), T.StructField("n", T.LongType()),
    T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sig", T.BinaryType())])


def fingerprints(words: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """128 bits of each row's word sequence."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    nth = (np.arange(len(words)) - offsets[:-1][row] + 1).astype(_U)
    fp = np.zeros((len(offsets) - 1, 2), _U)
    np.add.at(fp[:, 0], row, mix(words + nth * _ODD))
    np.add.at(fp[:, 1], row, mix(words ^ (nth * _U(0xE7037ED1A0B428DB))))
    return [x.tobytes() for x in fp]


@F.arrow_udf(T.BinaryType())
def _fp(texts: pa.Array) -> pa.Array:
    return pa.array([x for _, words, offsets in row_words(texts) for x in fingerprints(words, offsets)], pa.binary())


@F.arrow_udf(_PRINT)
def _prints(texts: pa.Array) -> pa.Array:
    """Of each text: fingerprint of its word sequence, number of words, keys of
    its bands, and a byte of each component."""
    fps, ns, bands, sigs, held = [], [], [], [], []
    for _, words, offsets in row_words(texts):
        n = len(offsets) - 1
        sizes = np.diff(offsets)
        fps += fingerprints(words, offsets)
        ns.append(sizes)
        bits = np.zeros((n, SIZE), _U)
        for lo in range(0, n, RUN):  # a text takes some thousand points, however short it is
            own = offsets[lo : lo + RUN + 1]
            bits[lo : lo + RUN] = mix(signatures(*shingles(words[own[0] : own[-1]], own - own[0]), len(own) - 1))
        key = np.zeros((n, BANDS), _U)
        for k in range(ROWS):
            key = mix(key * _ODD + bits[:, k::ROWS])
        bands.append(mix(key + np.arange(BANDS, dtype=_U) * _ODD)[sizes > 0])
        sigs.append((bits & _U(255)).astype(np.uint8))
        held.append(np.where(sizes > 0, BANDS, 0))
    sig = np.concatenate(sigs) if sigs else np.zeros((0, SIZE), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(held) if held else [])]).astype(np.int32)
    return pa.StructArray.from_arrays([
        pa.array(fps, pa.binary()),
        pa.array(np.concatenate(ns) if ns else np.zeros(0, np.int64), pa.int64()),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array((np.concatenate(bands) if bands else np.zeros((0, BANDS), _U)).reshape(-1).view(np.int64))),
        pa.array([x.tobytes() for x in sig], pa.binary()),
    ], ["fp", "n", "bands", "sig"])


@F.arrow_udf(T.DoubleType())
def _alike(a: pa.Array, b: pa.Array) -> pa.Array:
    """Share of equal components."""
    x = np.frombuffer(b"".join(a.to_pylist()), np.uint8).reshape(-1, SIZE)
    y = np.frombuffer(b"".join(b.to_pylist()), np.uint8).reshape(-1, SIZE)
    return pa.array((x == y).mean(1) if len(x) else np.zeros(0))


@F.arrow_udf(T.DoubleType())
def _overlap(a: pa.Array, b: pa.Array) -> pa.Array:
    """Exact weighted Jaccard similarity of two columns of texts."""
    out = np.zeros(len(a))
    for lo in range(0, len(a), 256):  # few pairs at a time: bounded memory
        x, y = a.slice(lo, 256), b.slice(lo, 256)
        sets: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]
        for side, texts in enumerate((x, y)):
            for _, words, offsets in row_words(texts):
                key, row, count = shingles(words, offsets)
                edge = np.searchsorted(row, np.arange(len(offsets)))
                sets[side] += [(key[i:j], count[i:j]) for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
        for i, ((k, m), (q, r)) in enumerate(zip(*sets, strict=True)):
            _, at, to = np.intersect1d(k, q, assume_unique=True, return_indices=True)
            both = np.minimum(m[at], r[to]).sum()
            total = m.sum() + r.sum() - both
            out[lo + i] = both / total if total else 0.0
    return pa.array(out)


def _candidates(texts: DataFrame) -> DataFrame:
    """(key, fp, central) of the bands that several texts share."""
    rows = texts.select("fp", "n", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(shared, "key")


def _compared(pairs: DataFrame, texts: DataFrame, whole: DataFrame) -> DataFrame:
    """(a, b, sim) of the pairs whose signatures are not far apart."""
    sig = texts.select("fp", "sig")
    near = (pairs.join(sig.select(F.col("fp").alias("a"), F.col("sig").alias("x")), "a")
            .join(sig.select(F.col("fp").alias("b"), F.col("sig").alias("y")), "b")
            .where(_alike("x", "y") >= LEAST).select("a", "b"))
    near = written(near, "near", few=True)
    return written(near.join(whole.select(F.col("fp").alias("a"), F.col("text").alias("x")), "a")
                   .join(whole.select(F.col("fp").alias("b"), F.col("text").alias("y")), "b")
                   .select("a", "b", _overlap("x", "y").alias("sim")), "pairs", few=True, texts=True)


def _starred(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of each text with the most central text of all its bands."""
    lead = rows.groupBy("key").agg(F.max(F.struct("central", "fp")).alias("top"))
    best = rows.join(lead, "key").groupBy("fp").agg(F.max("top").alias("top")).select("fp", F.col("top.fp").alias("lead"))
    return best.where("fp <> lead").select(F.least("fp", "lead").alias("a"), F.greatest("fp", "lead").alias("b")).distinct()


def _mixed(shared: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """Members of the bands that hold several components of the links so far,
    with their component, and whether it is another than the band's largest."""
    comp = components(found.where(F.col("sim") >= threshold))
    rows = written(shared.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp")), "members", few=True)
    groups = rows.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("n").alias("words"))
    bands = written(groups.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("words").alias("words"), F.max(F.struct("n", "comp", "words")).alias("most"),
                                              F.count("*").alias("comps"))
                    .where("comps > 1").select("key", F.col("top.comp").alias("main"), "words", (F.col("words") - F.col("most.words")).alias("minor")), "mixed", few=True)
    return rows.join(bands, "key").withColumn("is_minor", F.col("comp") != F.col("main"))


_LINK = "a binary, b binary, sim double"


@F.arrow_udf(T.BinaryType())
def _multiset(texts: pa.Array) -> pa.Array:
    """The shingles of each text, then their counts, eight bytes each."""
    out: list[bytes] = []
    for _, words, offsets in row_words(texts):
        key, row, count = shingles(words, offsets)
        edge = np.searchsorted(row, np.arange(len(offsets)))
        out += [key[i:j].tobytes() + count[i:j].astype(np.int64).tobytes() for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
    return pa.array(out, pa.binary())


def forest(members: list[tuple[bytes, bytes, bytes]], asking: list[int], threshold: float) -> tuple[list[tuple[int, int, float]], int]:
    """Links (place, place, similarity) that join what the pairs of ``asking``
    members with all ``members`` (fingerprint, component, multiset) join, and the
    number of pairs that were compared.

    Whoever reaches the threshold with another shares a shingle with it among its
    rarest ones: those without which too little weight would be left (prefix
    filter). Weights by groups of shingles bound what two can share at most. Both
    lose no pair. Members that are joined already are not compared, so a group of
    copies costs about one comparison a member; texts that are alike by common
    passages but below the threshold cost a look at their groups."""
    names: dict[bytes, int] = {}
    joined = np.array([names.setdefault(comp, i) for i, (_, comp, _) in enumerate(members)])
    sets = [np.frombuffer(m, _U) for _, _, m in members]
    keys, counts = [x[: len(x) // 2] for x in sets], [x[len(x) // 2 :].view(np.int64) for x in sets]
    own = np.repeat(np.arange(len(members)), [len(k) for k in keys])
    _, token, often = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    weight = np.concatenate(counts)
    size = np.bincount(own, weight, len(members))
    order = np.lexsort((token, often[token], own))  # rarest first
    upto = np.cumsum(weight[order])
    begin = np.searchsorted(own[order], np.arange(len(members)))
    before = upto - weight[order] - (upto[begin] - weight[order][begin])[own[order]]  # weight in front, in its member
    probe = size[own[order]] - before >= threshold * size[own[order]]
    p_own, p_token = own[order][probe], token[order][probe]
    by_token = np.argsort(p_token, kind="stable")
    edge = np.searchsorted(p_token[by_token], np.arange(len(often) + 1))
    holders = p_own[by_token]
    p_begin = np.searchsorted(p_own, np.arange(len(members) + 1))
    edges = np.searchsorted(own, np.arange(len(members) + 1))
    # weights by group of shingles: what two members differ in there they cannot share
    group = own * GROUPS + (np.concatenate(keys) & _U(GROUPS - 1)).astype(np.int64)
    groups = np.zeros((len(members), GROUPS), np.int16)
    for lo in range(0, len(members), 1024):  # short texts are many members: some at a time
        hi = min(lo + 1024, len(members))
        part = slice(edges[lo], edges[hi])
        groups[lo:hi] = np.minimum(np.bincount(group[part] - lo * GROUPS, weight[part], (hi - lo) * GROUPS), 30_000).reshape(-1, GROUPS)
    held = np.zeros(len(often), np.int64)  # the asking member's counts
    out: list[tuple[int, int, float]] = []
    compared = 0
    for i in asking:
        lists = [holders[edge[t] : edge[t + 1]] for t in p_token[p_begin[i] : p_begin[i + 1]].tolist()]
        near = np.unique(np.concatenate(lists)) if lists else np.zeros(0, np.int64)
        fits = (joined[near] != joined[i]) & (np.minimum(size[near], size[i]) >= threshold * np.maximum(size[near], size[i]))
        near = near[fits]
        apart = np.concatenate([np.abs(groups[near[lo : lo + 256]] - groups[i]).sum(1, dtype=np.int64) for lo in range(0, len(near), 256)]) if len(near) else near
        total = size[near] + size[i]
        most = (total - apart) / 2
        able = most >= threshold * (total - most) - 1e-6
        near = near[able][np.argsort(apart[able], kind="stable")]
        held[token[edges[i] : edges[i + 1]]] = weight[edges[i] : edges[i + 1]]
        while len(near):
            j, near = int(near[0]), near[1:]
            compared += 1
            part = slice(edges[j], edges[j + 1])
            both = int(np.minimum(held[token[part]], weight[part]).sum())
            sim = both / (size[i] + size[j] - both)
            if sim >= threshold:
                out.append((i, j, float(sim)))
                joined[joined == joined[j]] = joined[i]
                near = near[joined[near] != joined[i]]
        held[token[edges[i] : edges[i + 1]]] = 0
    return out, compared


def _across(mixed: DataFrame, whole: DataFrame, threshold: float) -> DataFrame:
    """(a, b, sim): links between components that share a band. A band is cut into
    cells of some megabytes, whatever the length of its members, and a cell gives
    fewer links than it has members."""
    rows = mixed.join(whole.select("fp", _multiset("text").alias("bag")), "fp")
    slot = F.abs(F.xxhash64("fp"))
    i, j = F.ceil(F.col("minor") / ASKING), F.ceil(F.col("words") / ASKED)
    asking = rows.where("is_minor").select("key", "fp", "comp", "bag", (slot % i).alias("i"), F.explode(F.sequence(F.lit(0), j - 1)).alias("j"), F.lit(True).alias("asks"))
    asked = rows.select("key", "fp", "comp", "bag", F.explode(F.sequence(F.lit(0), i - 1)).alias("i"), (slot % j).alias("j"), F.lit(False).alias("asks"))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        members: dict[bytes, tuple[bytes, bytes, bytes]] = {}
        asks: set[bytes] = set()

        def linked() -> pa.RecordBatch:
            rows = [members[fp] for fp in sorted(members)]
            found = forest(rows, [n for n, r in enumerate(rows) if r[0] in asks], threshold)[0] if asks and len(rows) > 1 else []
            return pa.RecordBatch.from_pydict({
                "a": pa.array([rows[min(x, y)][0] for x, y, _ in found], pa.binary()), "b": pa.array([rows[max(x, y)][0] for x, y, _ in found], pa.binary()),
                "sim": pa.array([z for _, _, z in found], pa.float64())})

        for r in (r for batch in batches for lo in range(0, batch.num_rows, 256) for r in batch.slice(lo, 256).to_pylist()):
            if (r["key"], r["i"], r["j"]) != at:
                if members:
                    yield linked()
                at, members, asks = (r["key"], r["i"], r["j"]), {}, set()
            members[r["fp"]] = (r["fp"], r["comp"], r["bag"])
            if r["asks"]:
                asks.add(r["fp"])
        if members:
            yield linked()

    dealt = asking.unionByName(asked).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(cells, _LINK)


def links(docs: DataFrame, prints: DataFrame, threshold: float = 0.8, text: str = "text") -> DataFrame:
    """(a, b, sim): links between fingerprints that join all pairs of candidates
    whose similarity reaches the threshold, directly or over others."""
    texts = written(prints.where("n > 0").groupBy("fp").agg(F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.first("n").alias("n")), "texts")
    candidates = written(_candidates(texts), "bands")
    central = candidates.groupBy("fp").agg(F.sum("size").alias("central"))
    shared = written(candidates.join(central, "fp").select("key", "fp", "central", "n"), "shared")
    discard(candidates)
    # the whole texts of all candidates: one for each fingerprint before anything is joined
    whole = written(docs.select(F.col(text).alias("text"), _fp(F.col(text)).alias("fp")).groupBy("fp").agg(F.first("text").alias("text"))
                    .join(shared.select("fp").distinct(), "fp", "left_semi"), "whole", texts=True)
    found = _compared(_starred(shared), texts, whole)
    mixed = written(_mixed(shared, found, threshold), "mixed", few=True)
    found = found.unionByName(_compared(_starred(mixed.where("is_minor")), texts, whole)).where(F.col("sim") >= threshold)
    mixed = written(_mixed(shared, found, threshold), "mixed", few=True)
    found = found.unionByName(written(_across(mixed, whole, threshold), "across", texts=True))
    discard(whole)
    return found


def _classed(docs: DataFrame, threshold: float, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp, n, class_id, is_kept) of every row. Kept are the rows of one id
    and one fingerprint of each component: the least id (nulls last), then the
    least fingerprint of that id. Rows without words are kept."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), _prints(F.col(text)).alias("p"))
    prints = written(rows.select("doc_id", "p.fp", "p.n", "p.bands", "p.sig"), "prints", texts=True)
    found = links(docs, prints, threshold, text)
    comp = components(found)
    least = prints.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).join(
        comp.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", "rows", F.coalesce("comp", "fp").alias("comp"))
    least = written(least, "least")
    top = least.groupBy("comp").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("top"))
    named = written(least.join(top, "comp").select("fp", "rows", F.col("top.least").alias("class_id"), (F.col("fp") == F.col("top.fp")).alias("is_top")), "named")
    # fingerprints with more than a thousandth of the rows, a thousand at most, do not go through one task
    often = prints.count() // 1000
    own = prints.select("doc_id", "fp", "n")
    hot = own.join(F.broadcast(named.where(F.col("rows") > often)), "fp")
    cold = own.join(F.broadcast(named.where(F.col("rows") > often).select("fp")), "fp", "left_anti").join(named.where(F.col("rows") <= often), "fp", "left")
    words = F.col("n") > 0
    return hot.unionByName(cold).select(
        "doc_id", "fp", "n", F.when(words, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(words, F.col("is_top") & F.col("doc_id").eqNullSafe(F.col("class_id"))).otherwise(True).alias("is_kept"))


def classes(docs: DataFrame, threshold: float = 0.8, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, class_id) of every row."""
    return _classed(docs, threshold, text, doc_id).select("doc_id", "class_id")


def drop_near_copies(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row of each component: of the least doc_id (nulls last), then of the
    least fingerprint; ids may repeat with other texts. Rows without words stay,
    once for each id and text; those of null ids all stay."""
    kept = written(_classed(docs, threshold).where("is_kept AND n > 0").groupBy(F.col("doc_id").alias("__id"), F.col("fp").alias("__fp"))
                   .agg(F.count("*").alias("__n")), "kept")
    docs = docs.drop("__id", "__fp", "__n", "__print")
    rows = docs.withColumn("__print", _fp("text")).join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__print") == F.col("__fp")))
    once = rows.where("__n = 1")
    more = rows.where("__n > 1").dropDuplicates(["doc_id", "__print"])
    bare = docs.where("text IS NULL OR NOT text RLIKE '[^\\\\x09-\\\\x0d ]'")
    bare = bare.where("doc_id IS NULL").unionByName(bare.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]))
    return once.unionByName(more).drop("__id", "__fp", "__n", "__print").unionByName(bare)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near copies (five words, similarity 0.8), and
    whether it is the one kept of its component."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return _classed(docs, 0.8).select("doc_id", "class_id", "is_kept")
