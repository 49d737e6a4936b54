import collections
import hashlib
import random
import tempfile

import numpy as np
import pytest

from stratum.llm import column_bwt as c


def _least(pieces, least, span):
    held = {}
    for p, x in zip(pieces, least, strict=True):
        for i in range(len(p) - span + 1):
            held[p[i : i + span]] = min(held.get(p[i : i + span], 1 << 62), x)
    return [held[p[i : i + span]] for p in pieces for i in range(len(p) - span + 1)]


@pytest.mark.parametrize("seed", range(12))
def test_collection_equals_brute_force(seed):
    rng = random.Random(seed)
    span, letters = rng.choice([3, 5, 8]), rng.choice([b"ab", b"abc", bytes(range(200))])
    pieces = list({bytes(rng.choice(letters) for _ in range(rng.randint(span, span + 20))) for _ in range(rng.randint(1, 60))})
    least = np.array([rng.randint(0, 50) for _ in pieces])
    with tempfile.TemporaryDirectory() as folder:
        built = c.Collection(pieces, folder, span=span, block=rng.choice([4, 7, 64, 1 << 12]))
        assert built.least(least)[1].tolist() == _least(pieces, least, span)
        built.close()


def test_the_transform_is_the_sorted_collection():
    pieces = [b"banana", b"bandana", b"anna"]
    with tempfile.TemporaryDirectory() as folder:
        built = c.Collection(pieces, folder, span=3, block=5)
        entries = np.concatenate([e for _, e in built._blocks(built.rounds)])
        built.close()
    # $ of a piece that begins later comes later; ties of suffixes end there
    begun = sorted(range(3), key=lambda p: -len(pieces[p]))
    suffixes = sorted((pieces[p][i:] + bytes([0, begun.index(p)]), p, i) for p in range(3) for i in range(len(pieces[p]) + 1))
    assert entries.astype(np.uint8).tolist() == [pieces[p][i - 1] if i else c.END for _, p, i in suffixes]
    prefixes = [0]
    for (a, _, _), (b, _, _) in zip(suffixes, suffixes[1:], strict=False):
        n = 0
        while a[n] == b[n] and a[n]:
            n += 1
        prefixes.append(min(n, 3))
    assert ((entries >> 8) & 63).tolist() == prefixes


def _brute(rows):
    """(n_bytes, n_removed, n_spans, kept) of (id, bytes) rows."""
    rank = [1 << 63 if i is None else i for i, _ in rows]
    held = {}
    for r, (_, t) in zip(rank, rows, strict=True):
        for i in range(len(t) - 49):
            held[t[i : i + 50]] = min(held.get(t[i : i + 50], 1 << 64), r)
    out = []
    for r, (i, t) in zip(rank, rows, strict=True):
        gone = [False] * len(t)
        for k in range(len(t) - 49):
            if held[t[k : k + 50]] < r:
                gone[k : k + 50] = [True] * 50
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=repr)


def _found(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()), key=repr)


def _texts(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    passages = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(4)]
    out = []
    for i in range(n):
        t = " ".join(rng.choice(words) for _ in range(rng.randint(0, 120)))
        if rng.random() < 0.6:
            p = rng.choice(passages)
            a = rng.randint(0, 60)
            t = t[: len(t) // 2] + p[a : a + rng.randint(30, 200)] + t[len(t) // 2 :]
        if out and rng.random() < 0.2:
            t = rng.choice(out)[1]
        out.append((i, t))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("hot, section", [(64, 4 << 20), (1 << 30, 700)])
def test_drop_repeats_equals_brute_force(spark, monkeypatch, hot, section):
    monkeypatch.setattr(c, "BUCKET", 9000)
    monkeypatch.setattr(c, "HOT", hot)
    monkeypatch.setattr(c, "SECTION", section)
    rows = _texts(3, 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _found(c.drop_repeats(docs)) == _brute([(i, t.encode()) for i, t in rows])


def test_odd_rows(spark):
    long = "x" * 300 + "".join(random.Random(1).choice("abcdefgh") for _ in range(300_000))
    rows = [(5, None), (6, ""), (7, "short"), (1, "y" * 120), (2, "y" * 49), (3, "y" * 200), (3, "y" * 200), (3, "z" + "y" * 60), (None, "y" * 70),
            (None, "w" * 90), (None, "w" * 90), (8, "w" * 90), (9, long), (10, long[100:]), ((1 << 63) - 1, "v" * 70), (-4, "é" * 60), (11, "aé" + "é" * 60)]
    docs = spark.createDataFrame([(i, t, "other", 1) for i, t in rows], "doc_id long, text string, print string, doc int")
    assert _found(c.drop_repeats(docs)) == _brute([(i, (t or "").encode()) for i, t in rows])
    bad = spark.sql("SELECT 1L AS doc_id, cast(X'FFFE41' AS string) AS text")
    assert c.drop_repeats(bad).first().n_bytes == 7


def test_empty_table(spark):
    assert c.drop_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pieces_that_share_an_anchor_only_stay_outside():
    """Words in common are no passage in common: such pieces go to no bucket."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(20)) for _ in range(12)]
    texts = [" ".join(rng.choice(words) + str(rng.random()) for _ in range(60)).encode() for _ in range(40)]
    passage = "".join(rng.choice("qrstuvwxyz") for _ in range(50)).encode()
    texts[7] += passage
    texts[30] = texts[30][:500] + passage + texts[30][500:]

    def kept(texts):
        held, rows = c._Sections(1, np.zeros(0, np.uint64)), []
        for i, t in enumerate(texts):
            rows += [x for _, x in held.add(i, 0, t)]
        doc, _, at, n = c._shared(rows + [x for _, x in held.flush()])
        return [(d, a + k) for d, a, m in zip(doc.tolist(), at.tolist(), n.tolist(), strict=True) for k in range(m)]

    strings = collections.defaultdict(set)
    for i, t in enumerate(texts):
        for k in range(len(t) - 49):
            strings[t[k : k + 50]].add(i)
    needed = {(i, k) for i, t in enumerate(texts) for k in range(len(t) - 49) if len(strings[t[k : k + 50]]) > 1}
    found = kept(texts)
    assert needed and needed <= set(found) and len(found) == len(set(found))
    assert len(found) < 0.02 * sum(map(len, texts))


def test_periodic_texts_keep_their_shared_strings():
    """Anchors that come again within a string: equal strings still have equal marks."""
    rng = random.Random(12)
    texts = []
    for _ in range(60):
        unit = "".join(rng.choice("ab") for _ in range(rng.randint(1, 40)))
        t = (unit * 200)[: rng.randint(50, 400)]
        texts += [t, "".join(rng.choice("cd") for _ in range(rng.randint(0, 30))) + t[rng.randint(0, 20) :] + "e" * rng.randint(0, 60)]
    held, rows = c._Sections(1, np.zeros(0, np.uint64)), []
    for i, t in enumerate(texts):
        rows += [x for _, x in held.add(i, 0, t.encode())] if len(t) >= 50 else []
    doc, _, at, n = c._shared(rows + [x for _, x in held.flush()])
    found = {(d, a + k) for d, a, m in zip(doc.tolist(), at.tolist(), n.tolist(), strict=True) for k in range(m)}
    strings = collections.defaultdict(set)
    for i, t in enumerate(texts):
        for k in range(len(t) - 49):
            strings[t[k : k + 50]].add(i)
    assert {(i, k) for i, t in enumerate(texts) for k in range(len(t) - 49) if len(strings[t[k : k + 50]]) > 1} <= found


def test_strings_that_hold_an_unshared_side_stay_outside():
    """Pieces with one shared side go without the strings that hold the other one."""
    rng = random.Random(13)
    filler = lambda: bytes(rng.choice(b"abcdefghijklmnop") for _ in range(300))
    passages = [bytes(rng.choice(b"qrstuvwxyz") for _ in range(rng.choice([45, 49, 50, 60]))) for _ in range(80)]
    texts = [filler() + p + filler() for p in passages for _ in range(2)]
    held, rows = c._Sections(1, np.zeros(0, np.uint64)), []
    for i, t in enumerate(texts):
        rows += [x for _, x in held.add(i, 0, t)]
    doc, _, at, n = c._shared(rows + [x for _, x in held.flush()])
    found = {(d, a + k) for d, a, m in zip(doc.tolist(), at.tolist(), n.tolist(), strict=True) for k in range(m)}
    assert {(i, 300 + k) for i, t in enumerate(texts) for k in range(len(t) - 649)} <= found
    for d, k in found:
        place = k + int(c._hashes(np.frombuffer(texts[d][k : k + 50], np.uint8))[1].argmin())
        other = texts[d ^ 1]
        assert place - 17 < k or texts[d][place - 17 : place + 16] in other
        assert place + 33 > k + 50 or texts[d][place : place + 33] in other
