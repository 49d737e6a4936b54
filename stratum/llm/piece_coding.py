"""SentencePiece encoding and decoding by a shared-prefix forward pass.

A text gets the mark of a word start in front and for every space, and falls into
units at places that no piece of the vocabulary spans (found from the vocabulary:
before the marks, and behind a word character that no piece continues with a
mark of punctuation). The distinct units of some documents, sorted, are a trie in
depth-first order: a unit shares the forward states of its common prefix with the
unit before and computes only the rest. What stands in a state depends on the
model:

* ``unigram``: the best score of a segmentation of the prefix, and its last piece
  (Viterbi).
* ``bpe``: the last piece of the prefix's encoding. Best sums of scores do not give
  what a model of merges gives, so here the piece is the one that stays unmerged
  beside the last piece of what is before it; an encoding is right exactly if all
  its neighbours are, so a state again depends on the prefix alone.

Characters without a piece become the pieces of their UTF-8 bytes. A worker keeps
the ids of up to ``CACHE`` units and marked words (what is between two runs of
marks, of one unit or several) of at most ``LONG`` characters; only words that it
does not know are cut into units. Decoding joins pieces and bytes, turns marks
into spaces and takes the first one off.

Defined cases: null and empty texts have no ids and decode to the empty text;
null ids decode to null, a null among ids to nothing. A text that holds the mark itself decodes to a space
there; bytes that are no UTF-8 decode to U+FFFD; control ids decode to nothing.
Repeated rows get equal ids each, texts of any length are coded whole, an empty
table gives an empty one. Other columns go through; one with the name of the
result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
CACHE = 1_000_000
TAIL = 4  # last characters of a piece that bound how long it can be
GROUP = 1 << 20  # characters of the documents whose units are sorted together
LONG = 64  # characters of an entry of the cache
BLOCK = 1 << 18  # ids that are decoded at once
_RUNS = re.compile(f"{MARK}+[^{MARK}]*")


class Pieces:
    """A vocabulary: pieces with scores, ids of single bytes."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: dict[int, int], kind: str = "bpe"):
        self.ids = {p: i for p, (i, _) in pieces.items()}
        self.score = {p: s for p, (_, s) in pieces.items()}
        self.byte_ids, self.kind = byte_ids, kind
        self.longest = max(map(len, pieces), default=1)
        self.least = min(self.score.values(), default=0.0) - 10.0
        pairs = {a + b for p in pieces for a, b in zip(p, p[1:])}
        # a unit ends before a mark and behind a word character; not where some piece goes on
        going_on = {a for a, b in pairs if re.match(r"\w", a) and not re.match(r"\w", b)}
        self.across = any(a != MARK and b == MARK for a, b in pairs)  # pieces go on over marks
        if self.across:
            self.unit = re.compile(r"(?s).+")
        else:
            word = r"[^\W%s]" % "".join(map(re.escape, sorted(going_on))) if going_on else r"\w"
            other = rf"(?:[^\w{MARK}\n]|[{''.join(map(re.escape, sorted(going_on)))}])" if going_on else rf"[^\w{MARK}\n]"
            alone = r"\n|" if not any("\n" in p for p in pairs) else ""
            self.unit = re.compile(f"{alone}{MARK}*{other}*{word}+|{MARK}*{other}+|{MARK}+|\\n")
        self._packed = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        #: The length of the longest piece that ends with these ``TAIL`` characters.
        self.reach: dict[str, int] = {}
        for p in pieces:
            if len(p) >= TAIL:
                self.reach[p[-TAIL:]] = max(self.reach.get(p[-TAIL:], 0), len(p))
        #: Of each piece its state, and whether it stays behind the pieces met so far.
        self._own: dict[str, tuple[tuple[float, str], dict[str, bool]]] = {p: ((0.0, p), {}) for p in pieces if len(p) > 1}
        #: Lengths of the pieces that end with these ``TAIL + 1`` characters, longest first.
        self._lengths: dict[str, list[int]] = {}
        for p in sorted(pieces, key=len, reverse=True):
            if len(p) > TAIL:
                self._lengths.setdefault(p[-TAIL - 1 :], []).append(len(p))
        self._lengths = {tail: list(dict.fromkeys(n)) for tail, n in self._lengths.items()}
        self._ends: dict[str, tuple] = {}
        self._steps: dict[str, list[tuple[float, str, str]] | None] = {}

    def _merges(self, piece: str) -> list[tuple[float, str, str]] | None:
        """The merges that make the piece: score, then first and last part behind
        it; None if merging does not end with the piece."""
        if piece not in self._steps:
            parts, steps = list(piece), []
            while len(parts) > 1:
                scored = [(s, -i) for i in range(len(parts) - 1) if (s := self.score.get(parts[i] + parts[i + 1])) is not None]
                if not scored:
                    break
                s, i = max(scored)
                parts[-i : 2 - i] = [parts[-i] + parts[1 - i]]
                steps.append((s, parts[0], parts[-1]))
            self._steps[piece] = steps if len(parts) == 1 else None
        return self._steps[piece]

    def _stays(self, last: str, piece: str) -> bool:
        """Whether merging both together ends with these two: the merges of either
        side go on in the order of all, until one over the border comes first."""
        left, right = self._merges(last) if last else [], self._merges(piece)
        if left is None or right is None:
            return False
        if not last:
            return True
        end, begin, x, y = last[-1], piece[0], 0, 0
        while True:
            over = self.score.get(end + begin)
            a = left[x][0] if x < len(left) else None
            b = right[y][0] if y < len(right) else None
            if over is not None and (a is None or over > a) and (b is None or over >= b):
                return False
            if a is not None and (b is None or a >= b):
                end, x = left[x][2], x + 1
            elif b is not None:
                begin, y = right[y][1], y + 1
            else:
                return True

    def _ending(self, tail: str) -> tuple:
        """Of texts that end with the tail: whether longer pieces do, the pieces in
        the tail (length, state, where it stays), longest first, and the state of
        the last character."""
        near = [(k, *self._own[tail[-k:]]) for k in range(len(tail), 1, -1) if tail[-k:] in self._own]
        if len(self._ends) >= CACHE:
            self._ends.clear()
        self._ends[tail] = found = (self.reach.get(tail, 0) > TAIL, near, (0.0, tail[-1]))
        return found

    def _state(self, unit: str, i: int, stack: list[tuple[float, str]]) -> tuple[float, str]:
        """Forward state of the unit's first i characters."""
        if self.kind == "bpe":
            tail = unit[i - TAIL : i] if i > TAIL else unit[:i]
            far, near, alone = self._ends.get(tail) or self._ending(tail)
            if far and i > TAIL:
                for k in self._lengths.get(unit[i - TAIL - 1 : i], ()):
                    if k <= i and (own := self._own.get(unit[i - k : i])):
                        state, fits = own
                        last = stack[i - k][1]
                        if (stays := fits.get(last)) is None:
                            stays = fits[last] = self._stays(last, state[1])
                        if stays:
                            return state
            for k, state, fits in near:
                last = stack[i - k][1]
                if (stays := fits.get(last)) is None:
                    stays = fits[last] = self._stays(last, state[1])
                if stays:
                    return state
            return alone  # no longer piece stays, so the character does
        first = max(0, i - self.reach.get(unit[i - TAIL : i], TAIL - 1)) if i >= TAIL else 0
        score, best = self.score, None
        for j in range(first, i):
            piece = unit[j:i]
            s = score.get(piece, self.least if j == i - 1 else None)
            if s is not None and (best is None or stack[j][0] + s > best[0]):
                best = (stack[j][0] + s, piece)
        return best

    def segment(self, units: list[str]) -> Iterator[tuple[str, list[str]]]:
        """Pieces of the units, which come sorted."""
        stack, before, state = [(0.0, "")], "", self._state
        for unit in units:
            shared = 0
            for a, b in zip(before, unit):
                if a != b:
                    break
                shared += 1
            del stack[shared + 1 :]
            for i in range(shared + 1, len(unit) + 1):
                stack.append(state(unit, i, stack))
            before, pieces, i = unit, [], len(unit)
            while i:
                pieces.append(stack[i][1])
                i -= len(pieces[-1])
            pieces.reverse()
            yield unit, pieces

    def packed(self, pieces: list[str]) -> bytes:
        """Their ids, as little-endian 32-bit integers."""
        known = self._packed
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:  # a character without a piece: the pieces of its bytes
            for p in pieces:
                if p not in known:
                    known[p] = b"".join([self.byte_ids[b].to_bytes(4, "little") for b in p.encode()])
            return b"".join([known[p] for p in pieces])


def load(file: str, kind: str = "bpe") -> tuple[Pieces, list[bytes]]:
    """The vocabulary of a model file, and each id's bytes."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=file)
    pieces, byte_ids, text = {}, {}, []
    for i in range(model.vocab_size()):
        p = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
            text.append(bytes([int(p[3:5], 16)]))
        elif model.is_control(i):
            text.append(b"")
        elif model.is_unknown(i):
            text.append(" ⁇ ".encode())
        else:
            pieces[p] = (i, model.get_score(i))
            text.append(p.replace(MARK, " ").encode())
    return Pieces(pieces, byte_ids, kind), text


class Encoder:
    """Ids of texts, through a cache of marked words and units."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.cache = pieces, {}

    def _words(self, text: str) -> list[str]:
        """The marked text, cut before each run of marks."""
        if not text:
            return []
        if not self.pieces.across and "  " not in text and text[0] != " " and MARK not in text:
            return (MARK + text.replace(" ", " " + MARK)).split(" ")
        marked = MARK + text.replace(" ", MARK)
        return [marked] if self.pieces.across else _RUNS.findall(marked)

    def _learned(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words that are not in the cache."""
        units = {w: self.pieces.unit.findall(w) for w in words}
        missing = sorted(set().union(*units.values()).difference(self.cache))
        ids = {u: self.pieces.packed(parts) for u, parts in self.pieces.segment(missing)}
        for w, parts in units.items():
            if w not in ids:
                ids[w] = b"".join([ids[u] if u in ids else self.cache[u] for u in parts])
        return ids

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [self._words(t) for t in texts]
        found = [list(map(self.cache.get, words)) for words in split]
        new = {w for words, ids in zip(split, found, strict=True) if None in ids for w, i in zip(words, ids, strict=True) if i is None}
        learned = self._learned(new) if new else {}
        if len(self.cache) + len(learned) > CACHE:  # what these texts use stays
            self.cache = {w: i for words, ids in zip(split, found, strict=True) for w, i in zip(words, ids, strict=True) if i is not None}
        self.cache.update((u, i) for u, i in learned.items() if len(u) <= LONG)
        return [b"".join([learned[w] if i is None else i for w, i in zip(words, ids, strict=True)] if None in ids else ids)
                for words, ids in zip(split, found, strict=True)]


def encode(docs: DataFrame, file: str, text: str = "text", out: str = "ids", kind: str = "bpe") -> DataFrame:
    """``docs`` with the ids of each text (an existing column ``out`` is replaced)."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pa.Array) -> pa.Array:
        encoder = _encoder(file, kind)
        found: list[bytes] = []
        group: list[str] = []
        size = 0
        for t in texts:
            group.append(t.as_py() or "")
            size += len(group[-1])
            if size >= GROUP:
                found += encoder(group)
                group, size = [], 0
        found += encoder(group)
        ends = np.cumsum([0] + [len(f) // 4 for f in found]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))

    return docs.withColumn(out, ids(F.col(text)))


def decode(docs: DataFrame, file: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of each array of ids."""

    @F.arrow_udf(T.StringType())
    def text(column: pa.Array) -> pa.Array:
        return _decoded(column, _tables(file))

    return docs.withColumn(out, text(F.col(ids)))


def _decoded(column: pa.Array, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Array:
    """Texts of a column of arrays of ids."""
    starts, sizes, data = table
    ids = pc.fill_null(column.flatten(), len(sizes) - 1).to_numpy()
    parts, ends = [np.zeros(0, np.uint8)], [np.zeros(1, np.int64)]
    for lo in range(0, len(ids), BLOCK):
        some = ids[lo : lo + BLOCK]
        size = sizes[some]
        upto = np.cumsum(size)
        parts.append(data[np.repeat(starts[some] - (upto - size), size) + np.arange(upto[-1])])
        ends.append(upto + ends[-1][-1])
    joined = np.concatenate(parts)
    rows = np.concatenate([[0], np.cumsum(pc.fill_null(column.value_lengths(), 0).to_numpy())])
    offsets = np.concatenate(ends)[rows]
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    first = full[joined[offsets[full]] == ord(" ")]  # rows whose first byte goes
    joined = np.delete(joined, offsets[first])
    gone = np.zeros(len(offsets), np.int64)
    gone[first + 1] = 1
    offsets = (offsets - np.cumsum(gone)).astype(np.int32)
    raw = pa.Array.from_buffers(pa.binary(), len(column), [column.is_valid().buffers()[1], pa.py_buffer(offsets), pa.py_buffer(joined)])
    try:
        return raw.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        return pa.array([None if b is None else b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.string())


_loaded: dict = {}  # of a worker


def _encoder(file: str, kind: str) -> Encoder:
    if (file, kind) not in _loaded:
        _loaded[file, kind] = Encoder(load(file, kind)[0])
    return _loaded[file, kind]


def _tables(file: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each id's bytes start, how many they are, and all of them; the id
    behind the last has none."""
    if file not in _loaded:
        text = [*load(file)[1], b""]
        size = np.array([len(t) for t in text], np.int64)
        _loaded[file] = np.cumsum(size) - size, size, np.frombuffer(b"".join(text), np.uint8)
    return _loaded[file]


def op7_piece_coding(spark: SparkSession, sf_dir: str, file: str | None = None) -> DataFrame:
    """Every document's ids, and a digest of what they decode to."""
    import public_tokenizers

    file = file or public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = decode(encode(docs, file).drop("text"), file)
    return coded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))
