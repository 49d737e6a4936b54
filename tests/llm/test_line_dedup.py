"""Line dedup: keys, thresholds, reversibility, filters."""

import numpy as np

from stratum.llm import line_dedup as L
from stratum.llm.line_dedup import CuckooFilter, LineIndex, drop_common_lines

SCHEMA = "doc_id bigint, text string, n_lines string, other string"


def expected(rows, min_docs, min_chars=1):
    lower = str.maketrans(L._UPPER, L._LOWER)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    counts = {}
    for _, t, *_ in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            counts[k] = counts.get(k, 0) + 1
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and counts[key(x)] >= min_docs)]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


ROWS = [(i, f"  Common Line\t\nown {i}\n\nÉtoile\nétoile", "clash", "x") for i in range(5)]
ROWS += [(7, None, None, "x"), (8, "", None, "x"), (9, "\n\n", None, "x"), (None, "common line\nzzz", None, "x"), (None, "COMMON LINE", None, "x"),
         (3, "common line\nagain own 3", None, "x"), (11, "x" * 200_000 + "\ncommon line ", None, "x"), (12, "own 0\r\n\x0bown 0", None, "x"),
         (13, "Étoile\n" * 50, None, "x"), (13, "Étoile\n" * 50, None, "x")]


def got(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def test_against_brute_force(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for min_docs, min_chars in ((3, 1), (2, 1), (6, 1), (3, 8)):
        out = drop_common_lines(df, min_docs, min_chars)
        assert got(out) == expected(ROWS, min_docs, min_chars)
        assert "other" in out.columns and out.columns.count("n_lines") == 1


def test_empty_table(spark):
    assert got(drop_common_lines(spark.createDataFrame([], SCHEMA))) == []


def test_insert_in_batches_and_delete_again(spark, monkeypatch):
    monkeypatch.setattr(LineIndex, "KEYS_PER_SHARD", 4)
    df = spark.createDataFrame(ROWS, SCHEMA)
    extra = [(100 + i, f"extra {i % 3}\ncommon line\nown {i}", None, "x") for i in range(9)]
    index = LineIndex(spark, shards=4)
    index.insert(df)
    before = {(bytes(r.key), r.n_docs) for r in index.counts.collect()}
    more = spark.createDataFrame(extra, SCHEMA)
    index.insert(more)
    whole = expected(ROWS + extra, 3)
    assert got(index.apply(df.unionAll(more), 3)) == whole
    # every counted key is in its shard's filter
    filters = {r.shard: np.frombuffer(r.slots, np.uint16).reshape(-1, L.SLOTS) for r in index.filters.collect()}
    for r in index.counts.collect():
        words = np.frombuffer(bytes(r.key), "<u8").reshape(1, 2)
        assert CuckooFilter(filters[r.shard]).holds(words)[0]
    index.delete(more)
    assert {(bytes(r.key), r.n_docs) for r in index.counts.collect()} == before
    assert got(index.apply(df, 3)) == expected(ROWS, 3)


def test_the_query_goes_through_the_filters(spark):
    """Of the second batch only keys that the first one may hold meet the table."""
    df = spark.createDataFrame(ROWS + [(200 + i, f"only here {i}\ncommon line", None, "x") for i in range(300)], SCHEMA)
    index = LineIndex(spark)
    drop_common_lines(df, 3, index=index).count()
    assert index.asked > 100 and index.asked - 10 <= index.spared < index.asked


def test_shards_grow_and_an_index_is_opened_again(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(LineIndex, "KEYS_PER_SHARD", 4)
    first = spark.createDataFrame([(1, "a\nb", None, "x")], SCHEMA)
    index = LineIndex(spark)
    index.insert(first)
    index.save(f"{tmp_root}/one")
    before = {(bytes(r.key), r.n_docs) for r in index.counts.collect()}
    more = spark.createDataFrame([(10 + i, f"line {i}\na\nb {i % 7}", None, "x") for i in range(300)], SCHEMA)
    again = LineIndex.open(spark, f"{tmp_root}/one")
    shards = again.shards
    frequent = again.frequent(1)
    again.insert(more)
    assert again.shards > shards and frequent.count() == 2
    assert {r.shard for r in again.counts.select("shard").distinct().collect()} > set(range(shards))
    again.save(f"{tmp_root}/two")
    third = LineIndex.open(spark, f"{tmp_root}/two")
    third.delete(more)
    assert {(bytes(r.key), r.n_docs) for r in third.counts.collect()} == before
    assert {(bytes(r.key), r.n_docs) for r in LineIndex.open(spark, f"{tmp_root}/one").counts.collect()} == before


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, "same\nown", "mine", "too") for i in range(3)], "doc_id int, text string, __print string, __lines string")
    out = drop_common_lines(df, 3)
    assert {tuple(r) for r in out.select("text", "__print", "__lines").collect()} == {("", "mine", "too")}


def test_cuckoo_filter_holds_what_was_put_in():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 63, (20_000, 2)).astype(np.uint64)
    f = CuckooFilter.of_size(20_000)
    assert f.insert(hashes) and f.holds(hashes).all()
    other = rng.integers(0, 1 << 63, (20_000, 2)).astype(np.uint64)
    assert f.holds(other).mean() < 0.001
    f.delete(hashes[:10_000])
    assert f.holds(hashes[10_000:]).all() and f.holds(hashes[:10_000]).mean() < 0.01
    assert not CuckooFilter.of_size(100).insert(hashes)
