"""Shared helpers: tables in the cluster's shared folder, blocks of text as bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stratum.session import shared_dir

#: Texts are hashed in parts of at most about so many bytes, so that a task's memory
#: does not follow the longest text.
BLOCK_BYTES = 1 << 20
#: Texts that are looked at together have about so many bytes: what is computed of a
#: byte takes some ten times its size, in every Python worker.
TOGETHER = 1 << 18
#: Rows of texts in an Arrow batch: the batch is in the executor's memory outside its
#: heap and in the worker's, with what the worker gives back.
TEXT_ROWS = 1000

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``."""
    return shared_dir(spark, f"llm/{tag}-{uuid.uuid4().hex}")


@contextmanager
def _batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows, for what is run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = int(spark.conf.get(name))
    spark.conf.set(name, rows if old <= 0 else min(rows, old))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def written(df: DataFrame, tag: str, path: str | None = None, few: bool = False, texts: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder, read again: cuts lineage and
    survives the executors that made it. ``few``: in no more files than twice the
    cluster's cores, for the many small tables of iterations. ``texts``: Python gets
    whole texts, some at a time."""
    path = path or new_path(df.sparkSession, tag)
    if few:
        df = df.coalesce(max(1, 2 * df.sparkSession.sparkContext.defaultParallelism))
    with _batches(df.sparkSession, TEXT_ROWS) if texts else nullcontext():
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53


_BYTE = mix(np.arange(256, dtype=_U) * _ODD + _U(1)) | _U(1)
_BYTE_WORD = _BYTE.copy()
_BYTE_WORD[65:91] = _BYTE[97:123]  # words are compared without ASCII case
_BASE = _U(0xD6E8FEB86659FD93)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_powers = np.ones(0, _U), np.ones(0, _U)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, TOGETHER + (1 << 16))
        up = np.full(size, _BASE)
        down = np.full(size, _INVERSE)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


class Block:
    """Texts, or white-space-bounded parts of long ones, as one byte buffer in
    which a space stands before, between and behind them.

    ``rows[i]`` is the text's row in the batch, ``lo[i]:hi[i]`` its bytes."""

    __slots__ = ("data", "rows", "lo", "hi")

    def __init__(self, raw: np.ndarray, cuts: np.ndarray, rows: np.ndarray):
        sizes = np.diff(cuts)
        self.rows = rows
        self.lo = np.cumsum(np.concatenate([[1], sizes[:-1] + 1])).astype(np.int64)
        self.hi = self.lo + sizes
        self.data = np.full(len(raw) + len(rows) + 1, 32, np.uint8)
        if len(raw) > 100 * len(rows):
            for to, a, b in zip(self.lo.tolist(), (cuts[:-1] - cuts[0]).tolist(), (cuts[1:] - cuts[0]).tolist(), strict=True):
                self.data[to : to + b - a] = raw[a:b]
        else:
            self.data[np.arange(len(raw)) + np.repeat(self.lo - (cuts[:-1] - cuts[0]), sizes)] = raw

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and part of each white-space-bounded word."""
        solid = ~_WHITE[self.data]
        edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        start, end = edge[0::2], edge[1::2]
        return start, end, np.searchsorted(self.lo, start, "right") - 1

    def word_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hash (ASCII case ignored) and part of each word."""
        start, end, part = self.words()
        up, down = _power_tables(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, _U)
        np.cumsum(_BYTE_WORD[self.data] * up[: len(self.data)], out=total[1:])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U)), part


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of an Arrow batch in blocks (null: empty), ``TOGETHER`` bytes or a
    text each. A text longer than ``limit`` is cut at white space into parts that
    carry the same row."""
    together = min(limit, TOGETHER)
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    cuts, rows = [int(offsets[0])], []
    for row, end in enumerate(offsets[1:].tolist()):
        while True:
            at = cuts[-1]
            if end - at > limit:  # a long text: the next part ends at white space
                back = np.flatnonzero(_WHITE[data[at : at + limit]])
                if len(back):
                    end_here = at + int(back[-1]) + 1
                else:
                    ahead = np.flatnonzero(_WHITE[data[at + limit : end]])
                    end_here = at + limit + int(ahead[0]) + 1 if len(ahead) else end
            else:
                end_here = end
            if rows and end_here - cuts[0] > together:
                yield Block(data[cuts[0] : cuts[-1]], np.array(cuts), np.array(rows))
                cuts, rows = [cuts[-1]], []
            cuts.append(end_here)
            rows.append(row)
            if end_here == end:
                break
    yield Block(data[cuts[0] : cuts[-1]], np.array(cuts), np.array(rows))


def row_words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, offsets) of runs of whole rows; ``offsets`` has
    one entry more than rows."""
    held: list[np.ndarray] = []  # of the row whose last part has not come yet
    at, done = 0, 0
    pending: list[tuple[np.ndarray, np.ndarray]] = []
    for block in blocks(texts):
        hashes, part = block.word_hashes()
        pending.append((hashes, block.rows[part]))
        last = int(block.rows[-1])
        # every row before the last is complete
        h = np.concatenate([x for x, _ in pending])
        r = np.concatenate([x for _, x in pending])
        cut = np.searchsorted(r, last)
        if last > done:
            yield done, h[:cut], np.searchsorted(r[:cut], np.arange(done, last + 1))
            done = last
            pending = [(h[cut:], r[cut:])]
    n = len(texts)
    if n > done:
        h = np.concatenate([x for x, _ in pending]) if pending else np.zeros(0, _U)
        r = np.concatenate([x for _, x in pending]) if pending else np.zeros(0, np.int64)
        yield done, h, np.searchsorted(r, np.arange(done, n + 1))
