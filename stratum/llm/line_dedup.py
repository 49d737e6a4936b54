"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

A :class:`LineIndex` counts for every line key the documents that hold it. The
counts are a table in the shared folder, dealt over shards by the key's hash;
beside each shard stands a cuckoo filter over the keys it counts. A batch of
documents is reduced to one row per key first (so a line that a third of all
documents share is one row). The shard's filter then tells which keys cannot be
in the table; those are appended without a look at it, and only the others meet
the table in an exact join. Deleting documents subtracts their keys; a key whose
count reaches zero leaves table and filter, so that insert followed by delete
gives the earlier index back. A filter that runs full is built anew, twice as
large, from the keys it held and the new ones.

A line's key is the line with ``[\\x20\\x09-\\x0D]`` stripped at both ends and
A-Z lower-cased; keys are held as their MD5 (128 bits). A document is a row: rows
that repeat an id or a text count each. Keys shorter than ``min_chars`` code
points are never dropped.

Defined cases: a null or empty text is one empty line (kept); lines are never
dropped for a null id; other columns of the documents go through unchanged, and
columns named like the outputs are replaced. Lookups are by text, not by id, so
repeated or null ids do no harm. An empty table gives an empty one and leaves the
index as it is. A text of any length is split whole, in one row; its distinct
keys are rows of 16 bytes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import discard, new_path, written

_WHITE = "concat(' ', char(9), char(10), char(11), char(12), char(13))"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLOTS = 4  # of a filter's bucket
_COUNTS = "shard int, key binary, n_docs bigint"
_FILTERS = "shard int, slots binary, is_full boolean"


def lines(text: str = "text") -> Column:
    """The lines of a text (null or empty: one empty line)."""
    return F.expr(f"split(coalesce(`{text}`, ''), '\\n', -1)")


def _normal(line: str) -> str:
    bare = f"trim(BOTH {_WHITE} FROM {line})"
    return (f"CASE WHEN octet_length({line}) = char_length({line}) THEN lower({bare}) "
            f"ELSE translate({bare}, '{_UPPER}', '{_LOWER}') END")


def keys_sql(array: str, min_chars: int = 1) -> str:
    """SQL for the MD5 of the keys of an array of lines, null where too short."""
    return (f"transform(transform({array}, l -> {_normal('l')}), "
            f"k -> CASE WHEN char_length(k) >= {int(min_chars)} THEN unhex(md5(k)) END)")


def _distinct_keys(array: str, min_chars: int) -> Column:
    return F.explode(F.array_distinct(F.array_compact(F.expr(keys_sql(array, min_chars)))))


def _fingerprints(keys: pd.Series) -> np.ndarray:
    """Two 64-bit words of each MD5."""
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a fingerprint lies in one of two
    buckets, each found from the other, so it can be moved and deleted."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots  # (buckets, SLOTS), 0: free
        self.mask = len(slots) - 1

    @classmethod
    def of_size(cls, keys: int) -> "CuckooFilter":
        buckets = 1 << max(4, int(np.ceil(np.log2(max(keys, 1) / SLOTS / 0.8))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = (hashes[:, 1] % np.uint64(65535)).astype(np.int64) + 1
        first = (hashes[:, 0] & np.uint64(self.mask)).astype(np.int64)
        return mark, first, first ^ (mark * 0x5BD1E995 & self.mask)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        mark, a, b = self._places(hashes)
        return ((self.slots[a] == mark[:, None]) | (self.slots[b] == mark[:, None])).any(1)

    def insert(self, hashes: np.ndarray) -> bool:
        """False if not all found room (the filter is then to be built anew)."""
        mark, a, b = self._places(hashes)
        left = np.arange(len(mark))
        for place in (a, b, a, b):  # in bulk: the first of each bucket takes its first free slot
            for _ in range(SLOTS):
                _, lead = np.unique(place[left], return_index=True)
                lead = left[lead]
                room = (self.slots[place[lead]] == 0).any(1)
                lead = lead[room]
                if not len(lead):
                    break
                self.slots[place[lead], (self.slots[place[lead]] == 0).argmax(1)] = mark[lead]
                left = np.setdiff1d(left, lead, assume_unique=True)
        rng = np.random.default_rng(len(mark))
        for i in left.tolist():  # the rest push others on
            at, m = int(b[i]), int(mark[i])
            for _ in range(500):
                free = np.flatnonzero(self.slots[at] == 0)
                if len(free):
                    self.slots[at, free[0]] = m
                    break
                s = int(rng.integers(SLOTS))
                m, self.slots[at, s] = int(self.slots[at, s]), m
                at ^= m * 0x5BD1E995 & self.mask
            else:
                return False
        return True

    def delete(self, hashes: np.ndarray) -> None:
        """Take out one fingerprint for each of the keys, which it must hold."""
        mark, a, b = self._places(hashes)
        for m, x, y in zip(mark.tolist(), a.tolist(), b.tolist(), strict=True):
            at = x if (self.slots[x] == m).any() else y
            s = np.flatnonzero(self.slots[at] == m)
            if len(s):
                self.slots[at, s[0]] = 0


def _build(keys: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter of just these keys."""
    hashes, room = _fingerprints(keys["key"]), len(keys)
    filter_ = CuckooFilter.of_size(room)
    while not filter_.insert(hashes):
        room *= 2
        filter_ = CuckooFilter.of_size(room)
    return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "slots": [filter_.slots.tobytes()], "is_full": [False]})


def _held(filters: pd.DataFrame) -> CuckooFilter:
    return CuckooFilter(np.frombuffer(filters["slots"].iloc[0], np.uint16).reshape(-1, SLOTS).copy())


def _grown(filters: pd.DataFrame, fresh: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter with the fresh keys; marked if they found no room."""
    if not len(filters):
        return _build(fresh)
    if not len(fresh):
        return filters
    filter_ = _held(filters)
    fits = filter_.insert(_fingerprints(fresh["key"]))
    return filters.assign(slots=[filter_.slots.tobytes()], is_full=[not fits])


def _shrunk(filters: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
    if not len(filters) or not len(gone):
        return filters
    filter_ = _held(filters)
    filter_.delete(_fingerprints(gone["key"]))
    return filters.assign(slots=[filter_.slots.tobytes()])


def _looked_up(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """The batch's keys, and of each whether the table may hold it."""
    if not len(batch):
        return pd.DataFrame({"shard": [], "key": [], "n_docs": [], "maybe": []})
    maybe = _held(filters).holds(_fingerprints(batch["key"])) if len(filters) else np.zeros(len(batch), bool)
    return batch.assign(maybe=maybe)


class LineIndex:
    """Reference counts and filters of the documents inserted so far.

    ``shards`` is how finely keys are dealt. Unset, the first batch sets it, so
    that a shard gets about ``KEYS_PER_SHARD`` of its keys. When a batch leaves
    more than twice as many in a shard on average, the keys are dealt anew over
    as many shards as they need then. ``save`` and ``open`` carry an index from one
    session to the next.

    ``asked`` and ``spared``: keys of later batches that the filters were asked for,
    and how many of these never met the table.
    """

    KEYS_PER_SHARD = 50_000

    def __init__(self, spark: SparkSession, shards: int | None = None, min_chars: int = 1):
        self.spark, self.shards, self.min_chars = spark, shards, min_chars
        self.counts: DataFrame | None = None  # shard, key, n_docs
        self.filters: DataFrame | None = None  # shard, slots, is_full
        self.asked = self.spared = 0

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "LineIndex":
        """The index that :meth:`save` wrote to ``path``. Its files stay as they are:
        what is inserted or deleted from here on is in the index opened, until it is
        saved to another path."""
        about = spark.read.schema("shards int, min_chars int, is_empty boolean").parquet(f"{path}/about").head()
        index = cls(spark, about["shards"], about["min_chars"])
        if not about["is_empty"]:
            index.counts = spark.read.schema(_COUNTS).parquet(f"{path}/counts")
            index.filters = spark.read.schema(_FILTERS).parquet(f"{path}/filters")
            index._kept = True
        return index

    def save(self, path: str) -> None:
        """Write counts and filters to a new folder ``path`` of the shared storage."""
        if self.counts is not None:
            written(self.counts, "", f"{path}/counts")
            written(self.filters, "", f"{path}/filters")
        about = [(self.shards, self.min_chars, self.counts is None)]  # last: without it there is nothing to open
        written(self.spark.createDataFrame(about, "shards int, min_chars int, is_empty boolean").coalesce(1), "", f"{path}/about")

    _kept = False  # counts and filters are files of a saved index, not scratch

    def _drop(self, *tables: DataFrame, scratch: tuple[DataFrame, ...] = ()) -> None:
        """Delete superseded ``tables``, unless they belong to a saved index, and ``scratch``."""
        for table in (*(() if self._kept else tables), *scratch):
            discard(table)
        self._kept = False

    def _deal(self) -> None:
        """Deal the keys anew if shards have outgrown their share."""
        keys = self.counts.count()
        if keys <= 2 * self.KEYS_PER_SHARD * self.shards:
            return
        self.shards = -(-keys // self.KEYS_PER_SHARD)
        old = self.counts, self.filters
        self.counts = written(self.counts.select(self._shard(), "key", "n_docs"), "line-counts")
        self.filters = written(self.counts.groupBy("shard").applyInPandas(_build, _FILTERS), "line-filters")
        self._drop(*old)

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int").alias("shard")

    def _batch(self, docs: DataFrame, text: str) -> DataFrame:
        """(shard, key, n_docs) of a batch, one row for each key."""
        keys = docs.select(lines(text).alias("lines")).select(_distinct_keys("lines", self.min_chars).alias("key"))
        batch = written(keys.groupBy("key").agg(F.count("*").alias("n_docs")), "line-batch")
        if self.shards is None:
            self.shards = max(16, -(-batch.count() // self.KEYS_PER_SHARD))
        return batch.select(self._shard(), "key", "n_docs")

    def insert(self, docs: DataFrame, text: str = "text") -> None:
        """Count the documents in."""
        batch = self._batch(docs, text)
        if self.counts is None:
            self.counts = batch
            self.filters = written(batch.groupBy("shard").applyInPandas(_build, _FILTERS), "line-filters")
            return
        old, tally = (self.counts, self.filters), Observation()
        looked_up = (batch.groupBy("shard").cogroup(self.filters.groupBy("shard"))
                     .applyInPandas(_looked_up, f"{_COUNTS}, maybe boolean"))
        seen = written(looked_up.observe(tally, F.count("*").alias("asked"), F.count_if(~F.col("maybe")).alias("spared")), "line-seen")
        self.asked += tally.get["asked"]
        self.spared += tally.get["spared"]
        new = seen.where("NOT maybe").select("shard", "key", "n_docs")  # surely not in the table
        more = seen.where("maybe").select("shard", "key", F.col("n_docs").alias("more"))
        met = self.counts.withColumn("old", F.lit(True)).join(more, ["shard", "key"], "full_outer").select(
            "shard", "key", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs"),
            F.col("old").isNull().alias("fresh"))
        joined = written(met.unionByName(new.withColumn("fresh", F.lit(True))), "line-counts")
        self.counts = joined.select("shard", "key", "n_docs")
        grown = written(self.filters.groupBy("shard").cogroup(joined.where("fresh").groupBy("shard"))
                        .applyInPandas(_grown, _FILTERS), "line-filters")
        full = grown.where("is_full").select("shard")  # one row a shard at most
        again = self.counts.join(full, "shard", "left_semi").groupBy("shard").applyInPandas(_build, _FILTERS)
        self.filters = written(grown.where("NOT is_full").unionByName(again), "line-filters")
        self._drop(*old, scratch=(batch, seen, grown))
        self._deal()

    def delete(self, docs: DataFrame, text: str = "text") -> None:
        """Take documents that were inserted out again."""
        if self.counts is None:
            return
        old = self.counts, self.filters
        batch = self._batch(docs, text)
        left = written(self.counts.join(batch.withColumnRenamed("n_docs", "less"), ["shard", "key"], "left").select(
            "shard", "key", (F.col("n_docs") - F.coalesce("less", F.lit(0))).alias("n_docs")), "line-left")
        self.counts = written(left.where("n_docs > 0"), "line-counts")
        self.filters = written(self.filters.groupBy("shard").cogroup(left.where("n_docs <= 0").groupBy("shard"))
                               .applyInPandas(_shrunk, _FILTERS), "line-filters")
        self._drop(*old, scratch=(batch, left))

    def frequent(self, min_docs: int) -> DataFrame:
        """Keys that at least ``min_docs`` of the documents inserted until now hold: a
        table of its own, which later batches leave alone."""
        if self.counts is None:
            return self.spark.createDataFrame([], "key binary")
        return written(self.counts.where(F.col("n_docs") >= min_docs).select("key"), "line-frequent")

    def apply(self, docs: DataFrame, min_docs: int = 10, text: str = "text") -> DataFrame:
        """``docs`` without the lines that at least ``min_docs`` inserted documents
        hold, with ``n_lines`` (before) and ``n_dropped``."""
        whole = F.coalesce(text, F.lit(""))
        docs = docs.drop("n_lines", "n_dropped")
        own = "__" * (1 + max((len(c) for c in docs.columns), default=0))  # longer than any name there
        print_, split_, kept_, drop_ = (own + x for x in ("print", "lines", "kept", "drop"))
        docs = docs.withColumn(print_, F.struct(F.xxhash64(whole), F.unhex(F.md5(whole))))
        held = docs.select(lines(text).alias("lines"), print_).select(print_, _distinct_keys("lines", self.min_chars).alias("key"))
        # the frequent keys of a text, no more than its lines; copies of a text share a row
        drops = held.join(self.frequent(min_docs), "key", "left_semi").groupBy(print_).agg(F.collect_set("key").alias(drop_))
        # as a table, so that the join below deals out both sides itself and Spark can split a hot text
        drops = written(drops, "line-drops")
        split = docs.join(drops, print_, "left").drop(print_).withColumn(split_, lines(text))
        kept = split.withColumn(kept_, F.when(F.col(drop_).isNull(), F.col(split_)).otherwise(F.expr(
            f"transform(filter(arrays_zip({split_}, {keys_sql(split_, self.min_chars)}), "
            f"z -> z['1'] IS NULL OR NOT array_contains({drop_}, z['1'])), z -> z['{split_}'])")))
        return kept.withColumns({
            text: F.array_join(kept_, "\n"), "n_lines": F.size(split_).cast("long"),
            "n_dropped": (F.size(split_) - F.size(kept_)).cast("long")}).drop(split_, kept_, drop_)


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text", batches: int = 2,
                      index: LineIndex | None = None) -> DataFrame:
    """Index the documents and take their common lines out. They are inserted in
    ``batches`` by the hash of the text, every document in one of them, so that
    from the second batch on the filters decide which keys meet the table."""
    index = index or LineIndex(docs.sparkSession, min_chars=min_chars)
    dealt = F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(batches))
    for batch in range(batches):
        index.insert(docs.where(dealt == batch), text)
    return index.apply(docs, min_docs, text)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose key at least 10 documents hold leave all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_common_lines(docs, min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP6_SQL = f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (
  SELECT r, doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k FROM line),
common AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (c.k IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (c.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.k = c.k GROUP BY r, doc_id
"""
