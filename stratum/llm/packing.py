"""Best-fit packing with several permitted sequence lengths.

Each document is cut into pieces of at most the largest capacity, and pieces are
packed into bins in falling order of length. A piece goes to the open bin that it
leaves with the least room. If it fits none, a bin is opened: of every permitted
capacity that holds the piece, the cost (``overhead`` plus the capacity) is set
against the tokens that a greedy fill with the pieces still to come would put in,
and the capacity with the least cost a token is opened. At the end every bin is
downsized to the least capacity that holds its contents.

The pieces, ids and lengths only, are dealt evenly over blocks of about
``block_rows``, each packed by one task; the loss against one packing of all is a
bin or so a block. Round-robin dealing is by position, so no key can be hot.

Defined cases: null and empty texts have length 0 and no piece: they do not
appear. Null ids are packed like others, repeated rows are packed each. Lengths
that are null, zero or negative have no piece.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import written

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 16


class _Left:
    """How many pieces of each length are still to come."""

    def __init__(self, lengths: np.ndarray, most: int):
        self.count = np.bincount(lengths, minlength=most + 1).tolist()
        self.lower = list(range(most + 1))  # path to the next length that may have pieces

    def at_most(self, length: int) -> int:
        """The largest length up to this that has pieces; 0: none."""
        root = length
        while root and not self.count[root]:
            if self.lower[root] == root:
                self.lower[root] = root - 1
            root = self.lower[root]
        while length > root:  # shorten the path
            self.lower[length], length = root, self.lower[length] if self.lower[length] < length else root
        return root

    def fill(self, room: int) -> int:
        """Tokens that a greedy fill puts into the room."""
        put, bound = 0, room
        while bound > 0 and (size := self.at_most(min(bound, room - put))):
            put += size * min(self.count[size], (room - put) // size)
            bound = size - 1
        return put


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, overhead: float = OVERHEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bin, its capacity, tokens in it, offset in it) of each length; lengths lie
    between 1 and the largest capacity."""
    sizes = sorted(capacities)
    order = np.argsort(-lengths, kind="stable")
    left = _Left(lengths, sizes[-1])
    bins = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    used: list[int] = []
    rooms: list[tuple[int, int]] = []  # (room, bin) of the open bins, sorted
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        left.count[n] -= 1
        at = bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            _, room = min(((overhead + c) / (n + left.fill(c - n)), c) for c in sizes if c >= n)
            b = len(used)
            used.append(0)
        bins[i], offset[i] = b, used[b]
        used[b] += n
        if room > n:
            insort(rooms, (room - n, b))
    held = np.asarray(used, np.int64)
    fitted = np.asarray(sizes)[np.searchsorted(sizes, held)] if len(held) else held
    return bins, fitted[bins], held[bins], offset


def word_count(text: str = "text") -> Column:
    """Length of a text in white-space-bounded words."""
    white = "concat(' ', char(9), char(10), char(11), char(12), char(13))"
    return F.expr(f"coalesce(size(filter(split(translate(`{text}`, {white}, '      '), ' +'), w -> w <> '')), 0)")


def best_fit(lengths: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: float = OVERHEAD,
             block_rows: int = 50_000) -> DataFrame:
    """Pack (doc_id, n_tokens). Returns a row for each piece: doc_id, piece (from
    0), start and n_tokens in the document, bin_id, bin_offset, bin_capacity,
    bin_tokens."""
    most = max(capacities)
    pieces = written(
        lengths.where("n_tokens > 0").select("doc_id", F.col("n_tokens").cast("long").alias("n_tokens"))
        .select("doc_id", "n_tokens", F.explode(F.expr(f"sequence(0L, (n_tokens - 1) div {most})")).alias("piece"))
        .select("doc_id", "piece", (F.col("piece") * most).alias("start"),
                F.least(F.lit(most), F.col("n_tokens") - F.col("piece") * most).cast("long").alias("n_tokens")), "pieces")
    blocks = max(1, -(-pieces.count() // block_rows))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        rows = list(batches)  # about block_rows rows of four numbers
        if not rows:
            return
        block = pd.concat(rows, ignore_index=True)
        bins, capacity, tokens, offset = pack(block["n_tokens"].to_numpy(np.int64), capacities, overhead)
        yield block.assign(bin_id=bins + (TaskContext.get().partitionId() << 32), bin_offset=offset, bin_capacity=capacity, bin_tokens=tokens)

    return pieces.repartition(blocks).mapInPandas(
        packed, f"doc_id {dict(lengths.dtypes)['doc_id']}, piece long, start long, n_tokens long, "
        "bin_id long, bin_offset long, bin_capacity long, bin_tokens long")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by their number of words, in bins of 512 to 4,096."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return best_fit(docs.select("doc_id", word_count().alias("n_tokens")))
