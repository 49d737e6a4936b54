"""Piece coding against the library; Viterbi against all segmentations."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
from sentencepiece import SentencePieceProcessor

from stratum.llm import piece_coding as C

FILE = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "a", " a  b ", "a\nb", " \n\n x", "▁a▁", "ﬁ é é 日本語 x²..", "a\tb\x00c", "...a,b;c_d__e", "x  y   z    w", " ", "   ", "()[]{}<s><0x41>", "I'm can't 'sfoo",
       "1234567.89,0x1F", "😀😀a", "#### ### ##", "http://a.b/c?d=e&f", "\n", "q" * 500]


def test_ids_and_round_trip(spark):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab ,.\n'_1²tiheronsé▁😀(") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, None, "clash"), (3, "a\nb", "clash"), (9999, "word " * 40_000, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    model = SentencePieceProcessor(model_file=FILE)
    out = C.decode(C.encode(docs, FILE), FILE).collect()
    assert len(out) == len(rows)
    for r in out:
        want = model.encode(r.text or "")
        assert r.ids == want and r.decoded == model.decode(want)
        if "▁" not in (r.text or ""):
            assert r.decoded == (r.text or "")
    assert C.decode(C.encode(docs.limit(0), FILE), FILE).count() == 0


def test_decoding_odd_ids(spark):
    model = SentencePieceProcessor(model_file=FILE)
    a, bad = model.encode("a")[0], model.piece_to_id("<0xE3>")
    rows = [(1, None), (2, []), (3, [1, a, 2]), (4, [bad, a])]
    got = {r.k: r.decoded for r in C.decode(spark.createDataFrame(rows, "k int, ids array<int>"), FILE).collect()}
    assert got == {1: None, 2: "", 3: "a", 4: "� a"}


def test_viterbi_finds_the_best_segmentation():
    rng = random.Random(2)
    for _ in range(60):
        pieces = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))): 0 for _ in range(8)} | {"a": 0, "b": 0, "▁": 0}
        pieces = {p: (i, -rng.random() * 5) for i, p in enumerate(pieces)}
        vocabulary = C.Pieces(pieces, {}, "unigram")
        words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(10)})
        for word, got in vocabulary.segment(words):
            best = -1e9
            for cuts in itertools.product((0, 1), repeat=len(word) - 1):
                parts, at = [], 0
                for i, c in enumerate((*cuts, 1)):
                    if c:
                        parts.append(word[at : i + 1])
                        at = i + 1
                if all(p in pieces for p in parts):
                    best = max(best, sum(pieces[p][1] for p in parts))
            assert "".join(got) == word and abs(sum(pieces[p][1] for p in got) - best) < 1e-9


def test_shared_prefixes_are_computed_once(monkeypatch):
    vocabulary, _ = C.load(FILE)
    seen = []
    old = C.Pieces._state
    monkeypatch.setattr(C.Pieces, "_state", lambda self, unit, i, stack: (seen.append((unit[:i])), old(self, unit, i, stack))[1])
    list(vocabulary.segment(sorted(["▁there", "▁therefore", "▁thereby", "▁the", "▁these"])))
    assert len(seen) == len(set(seen))


def _merged(text, score):
    """The pieces that merging the best-scored neighbours, leftmost first, ends with."""
    parts = list(text)
    while scored := [(-score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]:
        i = min(scored)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def test_fits_equal_plain_merging():
    rng = random.Random(3)
    for _ in range(300):
        pieces = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(8)} | {"a", "b"})
        vocabulary = C.Pieces({p: (i, -float(rng.randint(1, 6))) for i, p in enumerate(pieces)}, {})
        for last in [*pieces, "", "c"]:
            for piece in pieces:
                want = _merged(last + piece, vocabulary.score) == ([last, piece] if last else [piece])
                assert vocabulary._stays(last, piece) == want


def test_a_full_cache_changes_no_ids(monkeypatch):
    monkeypatch.setattr(C, "CACHE", 40)
    rng = random.Random(4)
    model = SentencePieceProcessor(model_file=FILE)
    encoder = C.Encoder(C.load(FILE)[0])
    for _ in range(40):
        texts = [" ".join("".join(rng.choice("abeinrst,.\n") for _ in range(rng.choice((1, 3, 9, 90)))) for _ in range(8)) for _ in range(3)] + ["the cat, the dog", ""]
        assert [np.frombuffer(ids, "<i4").tolist() for ids in encoder(texts)] == [model.encode(t) for t in texts]


def test_pieces_that_go_on_over_marks():
    vocabulary = C.Pieces({"a▁b": (0, -1.0), "▁": (1, -2.0), "a": (2, -2.0), "b": (3, -2.0)}, {}, "unigram")
    got = [np.frombuffer(ids, "<i4").tolist() for ids in C.Encoder(vocabulary)(["a b", "", "b a"])]
    assert got == [[1, 0], [], [1, 3, 1, 2]]


def test_nulls_among_ids(spark):
    a = SentencePieceProcessor(model_file=FILE).encode("a")[0]
    rows = [(1, [None, a, None]), (2, [None]), (3, None), (4, [a, a])]
    got = {r.k: r.decoded for r in C.decode(spark.createDataFrame(rows, "k int, ids array<int>"), FILE).collect()}
    assert got == {1: "a", 2: "", 3: None, 4: "a a"}


def test_registered_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    model = SentencePieceProcessor(model_file=FILE)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    out = C.op7_piece_coding(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        want = model.encode(texts[r.doc_id])
        assert r.ids == want and r.n_pieces == len(want)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].replace(C.MARK, " ").encode()).hexdigest()
