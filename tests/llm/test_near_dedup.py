"""Near-dedup: unbiased signatures, classes against brute force, odd rows."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from stratum.llm import near_dedup as N
from stratum.llm.common import row_words
from stratum.llm.components import components


def multiset(text):
    words = re.findall(r"[^ \t\n\x0b\x0c\r]+", (text or "").encode().lower().decode())
    if not words:
        return None
    n = max(len(words) - 4, 1)
    return collections.Counter(tuple(words[i : i + 5]) for i in range(n))


def similarity(x, y):
    both = sum((x & y).values())
    return both / (sum(x.values()) + sum(y.values()) - both)


def brute(texts, threshold=0.8):
    sets = [multiset(t) for t in texts]
    comp = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and similarity(sets[i], sets[j]) >= threshold:
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    return comp


def texts_with_copies(rng, n=30):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    texts = []
    for _ in range(n):
        base = [word() for _ in range(rng.randint(1, 150))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 8)):
            changed = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                changed[rng.randrange(len(changed))] = word()
            texts.append("  ".join(changed).upper() if rng.random() < 0.3 else " ".join(changed))
    return texts


def test_signatures_are_unbiased_for_weighted_jaccard():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(40):
        key = rng.integers(1, 1 << 62, 60).astype(np.uint64)
        a, b = rng.integers(0, 12, 60), rng.integers(0, 12, 60)
        b = np.where(rng.random(60) < 0.5, a, b)
        sig = [N.signatures(key[w > 0], np.zeros((w > 0).sum(), np.int64), w[w > 0], 1)[0] for w in (a, b)]
        errors.append((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_signature_does_not_depend_on_its_neighbours():
    texts = ["a b c d e f g", "x " * 300, "one", "q w e r t y u i o p " * 40]
    alone = [N._prints.func(pa.array([t])).to_pylist()[0] for t in texts]
    assert N._prints.func(pa.array(texts)).to_pylist() == alone


def test_classes_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "ASKING", 200)  # so that mixed bands are cut into many cells
    monkeypatch.setattr(N, "ASKED", 300)
    rng = random.Random(5)
    texts = texts_with_copies(rng)
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in zip(ids, texts)], "doc_id bigint, text string, fp string, n int")
    got = {r.doc_id: r.class_id for r in N.classes(docs).collect()}
    comp = brute(texts)
    least = {}
    for i, c in zip(ids, comp):
        least[c] = min(i, least.get(c, i))
    assert got == {i: least[c] for i, c in zip(ids, comp)}
    kept = [r.doc_id for r in N.drop_near_copies(docs).collect()]
    assert sorted(kept) == sorted(least.values())


def test_links_are_found_when_a_bands_main_component_changes(spark):
    # In band K, m1 and m2 name n1, which is far. Then x finds q elsewhere, the label of its component drops,
    # and n1 and n2 are the ones that ask: n2's nearest is m1, the only link between the components.
    changed = {"m1": [], "m2": [9, 10], "n1": [1, 2, 3, 4, 5, 6], "n2": [1, 2], "h": [1, 2, 3, 4], "x": [1, 2, 3, 4, 7, 8], "q": [1, 2, 3, 4, 7, 8, 11, 12]}
    rest = [f"r{i}" for i in range(16)]

    def texts_and_prints(seed):
        texts = [" ".join(f"z{seed}x{p}" if p % 7 == 0 and p // 7 in c else f"w{seed}x{p}" for p in range(100)) for c in changed.values()]
        texts += [" ".join(f"{r}x{p}" for p in range(20)) for r in rest]
        return dict(zip([*changed, *rest], texts)), dict(zip([*changed, *rest], N._fp.func(pa.array(texts)).to_pylist()))

    texts, fp = next((t, f) for t, f in map(texts_and_prints, range(2000))
                     if f["q"] < min(f["m1"], f["m2"]) < min(f["n1"], f["n2"], f["h"], f["x"]))
    bands = {1: ["m1", "m2", "n1", "n2"], 2: ["n1", "n2", "h", "x"], 3: ["h", *rest[:12]], 4: ["m2", *rest[12:]], 5: ["h", "x", "q"]}
    other = {"m2": range(50, 55), "n1": [0], "n2": [1, 2, 3], "h": [4, 5], "x": range(60, 69), "q": range(60, 70)}
    rng = np.random.default_rng(0)
    sig = {k: rng.integers(0, 256, N.SIZE).astype(np.uint8) if k in rest else np.zeros(N.SIZE, np.uint8) for k in texts}
    for k, at in other.items():
        sig[k][list(at)] = 1
    prints = spark.createDataFrame([(fp[k], 100, [b for b, m in bands.items() if k in m], sig[k].tobytes()) for k in texts], "fp binary, n bigint, bands array<bigint>, sig binary")
    docs = spark.createDataFrame([(t,) for t in texts.values()], "text string")
    name = {f: k for k, f in fp.items()}
    found = {frozenset((name[bytes(r.a)], name[bytes(r.b)])) for r in N.links(docs, prints).collect()}
    assert {frozenset(x) for x in (("m1", "m2"), ("n1", "h"), ("n2", "h"), ("x", "h"), ("q", "x"), ("m1", "n2"))} == found


def test_odd_rows(spark):
    long = "word " * 100_000 + "end"
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (5, "A"), (None, "p q r s t u v"), (None, "p q r s t u v"), (6, "p q r s t u v"),
            (None, "alone here"), (7, long), (8, long + " more"), (9, "a b c d e"), (9, "v w x y z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = collections.Counter((r.doc_id, r.class_id) for r in N.classes(docs).collect())
    assert got == collections.Counter([(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (5, 4), (None, 6), (None, 6), (6, 6), (None, None), (7, 7), (8, 7), (9, 9), (9, 9)])
    assert N.classes(docs.limit(0)).count() == 0
    copies = spark.createDataFrame([(2, "x y"), (2, "x y"), (3, "x y"), (4, "z")], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in N.drop_near_copies(copies).collect()) == [2, 4]


def test_one_row_of_each_component_is_kept(spark):
    near = " ".join(f"w{i}" for i in range(100))
    rows = [(9, "a b c d e"), (9, "v w x y z"), (9, "V w x y z"), (10, "v w x y z"),  # one id, two texts
            (1, near), (1, near + " more"), (None, near + " more"),  # copies beside a kept row of the same id and of none
            (None, "p q r"), (None, "P  q r"), (None, "alone"), (4, "alone here"),
            (7, None), (7, " \t\n\x0b\x0c\r"), (9, ""), (9, ""), (None, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, r.text) for r in N.drop_near_copies(docs).collect()]
    kept = collections.Counter((i, " ".join((t or "").lower().split())) for i, t in got)
    assert sum(n for (i, t), n in kept.items() if i == 1) == 1 and (None, near + " more") not in kept
    assert {k: n for k, n in kept.items() if k[0] != 1} == {
        (9, "a b c d e"): 1, (9, "v w x y z"): 1, (None, "p q r"): 1, (None, "alone"): 1, (4, "alone here"): 1, (7, ""): 2, (9, ""): 1, (None, ""): 2}


def test_word_rows_survive_any_cut():
    texts = ["Hello  world", None, "", " a b\tc\n", "x" * 50 + " " + "yy " * 40]
    whole = [h.tolist() for _, w, o in row_words(pa.array(texts)) for h in (w[a:b] for a, b in zip(o[:-1], o[1:]))]
    from stratum.llm import common

    old = common.blocks.__defaults__
    try:
        common.blocks.__defaults__ = (10,)
        cut = [h.tolist() for _, w, o in row_words(pa.array(texts)) for h in (w[a:b] for a, b in zip(o[:-1], o[1:]))]
    finally:
        common.blocks.__defaults__ = old
    assert whole == cut and [len(x) for x in whole] == [2, 0, 0, 3, 41]


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(None, 5), (7, None), (200, 200)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200}


def _bag(words):
    c = collections.Counter(words)
    keys = sorted(c)
    return np.array(keys, np.uint64).tobytes() + np.array([c[k] for k in keys], np.int64).tobytes()


def _jaccard(a, b):
    x, y = collections.Counter(a), collections.Counter(b)
    return sum((x & y).values()) / sum((x | y).values())


def _joined(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_forest_joins_what_all_pairs_join(seed):
    rnd = random.Random(seed)
    base = [[rnd.randint(0, 400) for _ in range(60)] for _ in range(4)]
    bags = []
    for _ in range(120):
        t = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 12)):
            t[rnd.randrange(len(t))] = rnd.randint(0, 10_000)
        bags.append(t[: rnd.randint(40, 60)] * rnd.choice([1, 1, 1, 2]))
    asking = [i for i in range(120) if i % 3]
    found, _ = N.forest([(bytes([i]), bytes([i]), _bag(t)) for i, t in enumerate(bags)], asking, 0.8)
    every = [(i, j) for i in asking for j in range(120) if i != j and _jaccard(bags[i], bags[j]) >= 0.8]
    assert _joined(120, [(a, b) for a, b, _ in found]) == _joined(120, every) and len(found) < 120
    assert all(abs(s - _jaccard(bags[a], bags[b])) < 1e-12 and s >= 0.8 for a, b, s in found)


def test_texts_below_the_threshold_are_hardly_compared():
    rnd = random.Random(5)
    common = [rnd.randint(0, 10**6) for _ in range(300)]
    bags = []
    for _ in range(1200):  # two of them have about 80 % of 300 in common: similarity 0.66
        t = list(common)
        for k in rnd.sample(range(300), 31):
            t[k] = rnd.randint(10**7, 10**9)
        bags.append(t)
    assert 0.6 < _jaccard(bags[0], bags[1]) < 0.72
    found, compared = N.forest([(str(i).encode(), str(i).encode(), _bag(t)) for i, t in enumerate(bags)], list(range(1200)), 0.8)
    assert compared < 1200 and found == []
    copies = [bags[0]] * 700 + [bags[1]] * 500
    found, compared = N.forest([(str(i).encode(), str(i).encode(), _bag(t)) for i, t in enumerate(copies)], list(range(1200)), 0.8)
    assert len(found) == compared == 1198


def test_memory_of_a_worker_follows_neither_the_batch_nor_its_texts():
    """Ten times the text takes little more than the result's own size."""
    import tracemalloc

    def peak(n):
        texts = pa.array([" ".join(f"w{i}x{k}" for k in range(300)) for i in range(n)])
        for f in (N._fp, N._prints):
            f.func(texts)  # tables that are made once
        tracemalloc.start()
        N._fp.func(texts)
        N._prints.func(texts)
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return top

    assert peak(1500) < 24 << 20


def test_python_gets_texts_in_small_batches(spark):
    from stratum.llm import common

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    rows = spark.range(0, 5 * common.TEXT_ROWS, 1, 1).selectExpr("cast(id AS string) AS text")
    got = [r.n for r in common.written(rows.mapInArrow(sizes, "n long"), "batches", texts=True).collect()]
    assert sum(got) == 5 * common.TEXT_ROWS and max(got) <= common.TEXT_ROWS
    assert spark.conf.get(name) == old
