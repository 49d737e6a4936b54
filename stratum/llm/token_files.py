"""Token files: ids under one canonical length-limited Huffman code.

Writing takes two passes over the token ids. The first encodes the texts in
ascending doc_id order, keeps the ids in blocks of whole documents and counts
every id; the counts of all tasks, summed by id, give the code lengths
(package-merge, at most ``MAX_BITS``), and these alone give the canonical code.
The second packs every block by itself. A block holds its documents, their
numbers of ids, the bit stream and, for every ``STEP``-th id, the bit offset at
which it begins, so that readers start at any block and any checkpoint and
decode all runs of a block side by side, each step one look into a table of
``2**MAX_BITS`` entries.

Files: ``<path>/code`` (one row: ``lengths``, a byte for each id) and
``<path>/blocks`` (Parquet, a row for each block: ``start`` = ids of all documents
before it, ``doc_ids``, ``doc_tokens``, ``n_ids``, ``checkpoints``, ``bits``).
Spark's writers commit them, so a lost executor costs its tasks only.

Texts are encoded by the tokenizers library, word by word: between ASCII white
space its result for a text is the results of the words, one after another, and
a worker keeps the ids of the last ``CACHE`` words or so, and of as many before them (a
few documents are encoded between two looks at that bound). Words are lower-cased (ASCII)
first, as the tokenizer does itself, unless the text might hold a special token.
This holds for tokenizers that lower-case and split at white space, as the test
against whole texts shows for the one that the query uses.

Defined cases: null and empty texts have the end id only. Rows with a null id
come first; rows that repeat an id come in the order of their texts' hash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import discard, new_path, written

MAX_BITS = 18
STEP = 256
BLOCK_IDS = 1 << 16
CACHE = 500_000
#: A word of Latin letters, and marks behind it: the tokenizer splits between them.
_PLAIN = re.compile("([a-zÀ-ÖØ-Þß-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 stands for itself, the other bytes are numbered from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + n) for n, b in enumerate(rest)}}


class WordEncoder:
    """Ids of texts as bytes, through a cache of words.

    A word of Latin letters goes straight to the tokenizer's merges, for there is
    nothing to normalise in it but its case and nothing to split; marks behind it
    are a word of their own. Other words take the whole way."""

    def __init__(self, file: str, width: type):
        from tokenizers import Tokenizer

        self.tokenizer, self.width, self.cache = Tokenizer.from_file(file), width, _Words(self.learn)
        self.merges = self.tokenizer.model.tokenize
        self.packed = [width(i).tobytes() for i in range(self.tokenizer.get_vocab_size())]
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})

    def _merged(self, letters: str) -> bytes:
        return b"".join([self.packed[t.id] for t in self.merges(letters)])

    def learn(self, word: bytes) -> bytes:
        """The ids of one word."""
        if word.isalpha():  # ASCII letters only
            return self._merged(word.lower().decode())
        text = word.decode()
        plain = _PLAIN.fullmatch(text)
        if not plain:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes()
        stem, end = plain.groups()
        if end and (known := self.cache.get(stem.encode())):  # as a word without marks
            return known + self.cache[end.encode()]
        letters = stem.lower()
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(self.letters)
        return self._merged(letters) + (self.cache[end.encode()] if end else b"")

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if len(self.cache) > CACHE:
            self.cache.older = {}
            self.cache = _Words(self.learn, self.cache)
        ids = self.cache.__getitem__
        return [b"".join(map(ids, (t if b"<|" in t else t.lower()).split())) for t in texts]


class _Words(dict):
    """Ids by word; a word that is not there yet is taken from those ``older``, or
    learned."""

    def __init__(self, learn: Callable[[bytes], bytes], older: dict[bytes, bytes] | None = None):
        self.learn, self.older = learn, older or {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.learn(word)
        self[word] = ids
        return ids


_encoders: dict = {}  # of a worker, kept from task to task


def _encoder(file: str, width: type) -> WordEncoder:
    if (file, width) not in _encoders:
        _encoders[file, width] = WordEncoder(file, width)
    return _encoders[file, width]


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal code of at most ``most`` bits (0: id without count)."""
    ids = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(ids) > 1 << most:
        raise ValueError(f"{len(ids)} ids need codes of more than {most} bits")
    if len(ids) <= 1:
        lengths[ids] = 1
        return lengths
    ids = ids[np.argsort(counts[ids], kind="stable")]
    weight = counts[ids].astype(np.float64)
    packages, levels = np.zeros(0), []
    for _ in range(most):
        merged = np.concatenate([weight, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order < len(weight))  # which of the level's items are ids
        merged = merged[order]
        packages = merged[0 : len(merged) // 2 * 2 : 2] + merged[1::2]
    take, out = 2 * len(ids) - 2, np.zeros(len(ids), np.int64)
    for level in reversed(levels):
        n = int(level[:take].sum())
        out[:n] += 1
        take = 2 * (take - n)
    lengths[ids] = out
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes of the lengths, in the order of length and id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    step = np.uint64(1) << (np.uint64(64) - lengths[order].astype(np.uint64))
    first = np.concatenate([[np.uint64(0)], np.cumsum(step)[:-1]]) if len(order) else np.zeros(0, np.uint64)
    codes = np.zeros(len(lengths), np.uint64)
    codes[order] = first >> (np.uint64(64) - lengths[order].astype(np.uint64))
    return codes


def encode_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit stream of a block, and the bit offset of every STEP-th id."""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    at = end - size
    words = np.zeros((int(end[-1]) >> 5) + 2 if len(ids) else 1, np.uint64)
    if len(ids):
        placed = codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] += np.add.reduceat(placed >> np.uint64(32), first)
        words[word[first] + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").tobytes(), at[::STEP].astype(np.uint32)


class Decoder:
    """Looks MAX_BITS bits up at once."""

    def __init__(self, lengths: np.ndarray):
        self.bits = max(int(lengths.max(initial=1)), 1)
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        spans = 1 << (self.bits - lengths[order].astype(np.int64))
        self.ids = np.zeros(1 << self.bits, np.uint32)
        self.size = np.ones(1 << self.bits, np.int64)
        self.ids[: spans.sum()] = np.repeat(order, spans)
        self.size[: spans.sum()] = np.repeat(lengths[order], spans)

    def __call__(self, blocks: list[tuple[bytes, np.ndarray, int]]) -> list[np.ndarray]:
        """Ids of (bits, checkpoints, number of ids), all runs side by side."""
        streams = [np.frombuffer(b, ">u4").astype(np.uint64) for b, _, _ in blocks]
        base = np.cumsum([0] + [len(s) for s in streams])
        words = np.concatenate([*streams, np.zeros(1, np.uint64)])
        wide = (words[:-1] << np.uint64(32)) | words[1:]
        at = np.concatenate([c.astype(np.int64) + 32 * b for (_, c, _), b in zip(blocks, base[:-1].tolist(), strict=True)])
        steps = min(STEP, max((n for _, _, n in blocks), default=0))
        out = np.zeros((steps, len(at)), np.uint32)
        low, last = np.uint64((1 << self.bits) - 1), len(wide) - 1
        for k in range(steps):
            seen = wide[np.minimum(at >> 5, last)] >> (64 - self.bits - (at & 31)).astype(np.uint64) & low
            out[k] = self.ids[seen]
            at = at + self.size[seen]
        runs, found, lane = out.T, [], 0
        for _, c, n in blocks:
            own = runs[lane : lane + len(c)]
            lane += len(c)
            found.append(np.ascontiguousarray(own).reshape(-1)[:n] if steps == STEP else own[:, :n].reshape(-1)[:n])
        return found


def _id_type(docs: DataFrame, doc_id: str) -> T.DataType:
    return docs.schema[doc_id].dataType


def encode_documents(docs: DataFrame, file: str, end_id: int, vocabulary: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Table of blocks of ids in ascending doc_id order, and of each task's counts."""
    width = np.uint16 if vocabulary <= 1 << 16 else np.uint32
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(_id_type(docs, doc_id))), T.StructField("doc_tokens", T.ArrayType(T.LongType())),
        T.StructField("ids", T.BinaryType()), T.StructField("counts", T.BinaryType())])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        part, at = TaskContext.get().partitionId(), 0
        encoder, end = _encoder(file, width), np.array([end_id], width).tobytes()
        counts = np.zeros(vocabulary, np.int64)
        names: list = []
        found: list[bytes] = []
        held = 0  # bytes of found

        def row(n: int, sizes: list, ids: bytes | None, total: bytes | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"part": part, "at": at, "n_ids": n, "doc_ids": names if ids else None,
                                               "doc_tokens": sizes, "ids": ids, "counts": total}], arrow)

        def full() -> pa.RecordBatch:
            ids = b"".join(found)
            counts[:] += np.bincount(np.frombuffer(ids, width), minlength=vocabulary)
            return row(len(ids) // width(0).nbytes, [len(x) // width(0).nbytes for x in found], ids, None)

        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).cast(pa.large_binary())
            lo = 0
            while lo < len(batch):
                hi, size = lo, 0
                while hi < len(batch) and size < 1 << 19:  # some documents at a time
                    size += len(texts[hi].as_buffer() or b"") if texts[hi].is_valid else 0
                    hi += 1
                got = encoder([t or b"" for t in texts.slice(lo, hi - lo).to_pylist()])
                for key, ids in zip(keys.slice(lo, hi - lo).to_pylist(), got, strict=True):
                    names.append(key)
                    found.append(ids + end)
                    held += len(found[-1])
                    if held >= BLOCK_IDS * width(0).nbytes:
                        yield full()
                        at += held // width(0).nbytes
                        names, found, held = [], [], 0
                lo = hi
        if found:
            yield full()
            at += held // width(0).nbytes
        if at:
            yield row(at, [], None, counts.tobytes())

    ordered = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = (ordered.repartitionByRange(parts, F.col("doc_id"), F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text")))
    return ordered.mapInArrow(encoded, schema)


def _summed(rows: DataFrame, vocabulary: int, together: int = 16) -> np.ndarray:
    """Sum of the tasks' counts: so many rows at a time, each as long as the
    vocabulary, until few enough are left for the driver."""

    def added(key, pdf):
        import pandas as pd

        total = np.zeros(vocabulary, np.int64)
        for c in pdf["counts"]:
            total += np.frombuffer(c, np.int64)
        return pd.DataFrame({"part": [key[0]], "counts": [total.tobytes()]})

    n = rows.count()
    while n > together:
        n = -(-n // together)
        rows = written(rows.groupBy(F.pmod("part", F.lit(n)).alias("part"))
                       .applyInPandas(added, "part int, counts binary"), "token-counts")
    return sum((np.frombuffer(r["counts"], np.int64) for r in rows.collect()), np.zeros(vocabulary, np.int64))


def write_tokens(docs: DataFrame, path: str, file: str, end_id: int, vocabulary: int, max_bits: int = MAX_BITS,
                 text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode the texts, append ``end_id`` to each document, write the files."""
    spark = docs.sparkSession
    table = written(encode_documents(docs, file, end_id, vocabulary, text, doc_id), "token-ids")
    sums = table.where("counts IS NOT NULL")
    counts = _summed(sums.select("part", "counts"), vocabulary)
    lengths = code_lengths(counts, max_bits)
    tasks = sorted((r["part"], r["n_ids"]) for r in sums.select("part", "n_ids").collect())  # a row for each task
    first = np.cumsum([0] + [n for _, n in tasks]).tolist()
    starts = F.broadcast(spark.createDataFrame([(p, b) for (p, _), b in zip(tasks, first, strict=False)], "part int, base long"))
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/code")
    width = np.uint16 if vocabulary <= 1 << 16 else np.uint32
    code = spark.sparkContext.broadcast((lengths, canonical(lengths)))
    packed_type = T.StructType([T.StructField("checkpoints", T.BinaryType()), T.StructField("bits", T.BinaryType())])

    @F.arrow_udf(packed_type)
    def packed(ids: pa.Array) -> pa.Array:
        made = [encode_bits(np.frombuffer(x.as_buffer(), width), *code.value) for x in ids]
        return pa.StructArray.from_arrays([pa.array([c.tobytes() for _, c in made], pa.binary()), pa.array([b for b, _ in made], pa.binary())],
                                          ["checkpoints", "bits"])

    blocks = table.where("ids IS NOT NULL").join(starts, "part").select(
        (F.col("base") + F.col("at")).alias("start"), "doc_ids", "doc_tokens", "n_ids", packed("ids").alias("p"))
    blocks.select("start", "doc_ids", "doc_tokens", "n_ids", "p.checkpoints", "p.bits").write.option(
        "compression", "uncompressed").parquet(f"{path}/blocks")
    discard(table)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the files; ``ids`` are little-endian
    unsigned 32-bit integers."""
    lengths = np.frombuffer(spark.read.parquet(f"{path}/code").head()["lengths"], np.uint8)
    blocks = spark.read.parquet(f"{path}/blocks")
    key = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", key), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    held = spark.sparkContext.broadcast(lengths)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        decoder, arrow = Decoder(held.value), to_arrow_schema(schema)
        for batch in batches:
            for lo in range(0, len(batch), 8):
                rows = batch.slice(lo, 8).to_pylist()
                found = decoder([(r["bits"], np.frombuffer(r["checkpoints"], np.uint32), r["n_ids"]) for r in rows])
                for r, ids in zip(rows, found, strict=True):
                    ends = np.cumsum(r["doc_tokens"])
                    begins = ends - r["doc_tokens"]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(r["doc_ids"], arrow.field("doc_id").type), pa.array(begins + r["start"], pa.int64()),
                        pa.array(r["doc_tokens"], pa.int64()),
                        pa.array([ids[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], pa.binary())], schema=arrow)

    return blocks.select("start", "doc_ids", "doc_tokens", "n_ids", "checkpoints", "bits").mapInArrow(decoded, schema)


def op8_token_files(spark: SparkSession, sf_dir: str, file: str | None = None) -> DataFrame:
    """Every document's ids, written and read back."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = new_path(spark, "token-files")
    write_tokens(docs, path, file or public_tokenizers.path("word_bpe_49k.json"), end_id=2, vocabulary=49408)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
