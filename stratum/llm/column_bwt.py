"""Removal of repeated passages by a collection Burrows-Wheeler transform.

A byte goes when a ``SPAN``-byte string that covers it also starts in a document
with a smaller id. Which strings do is read from the Burrows-Wheeler transform of
a collection of pieces and its common prefixes, built column by column: every
round puts one more symbol of each piece, from its end to its start, in front of
the suffix that is already in its place (short pieces begin later, so all end in
the same round). The place of the longer suffix follows
from the number of equal symbols before the shorter one (the transform's rank),
its common prefix with the neighbours from the least common prefix between two
equal symbols. A round reads the transform and the common prefixes of the last
one as files from front to back and writes them anew, with the new entries in
between; in memory are a block of the files and one entry a piece. After the last
round, runs of common prefixes of at least ``SPAN`` hold equal strings; the least
document of a run is known to each of its strings.

Pieces. Texts are cut into runs of strings that share an anchor: the least hash
of the ``ANCHOR``-byte strings inside. Equal strings have equal anchors, so a
bucket of anchors finds all their copies by itself; pieces of a bucket overlap
those of others by ``SPAN - 1`` bytes and no match is lost. A bucket holds about
``BUCKET`` bytes of text, so its collection does not grow with the corpus. The
strings of a piece have their anchor at one place, and every string holds the
``SIDE`` bytes in front of it or those behind it. So pieces of which no other document
has the anchor with either side can have no match and stay outside: where pieces are
goes to the buckets first, then the pieces of shared anchors and sides; of a piece
with one shared side only, the strings that do not hold the other one. Equal pieces
are one document of the collection, with the least of their ids. Anchors that are in
more than a 64th of a sample of documents are hot: their pieces are cut into single
strings, dealt by the whole string, and copies of a block of texts travel once. The
sample decides how work is spread, never what is found.

Defined cases: null texts are empty; texts shorter than ``SPAN`` bytes stay.
Bytes that are no UTF-8 become U+FFFD first. Rows that repeat an id never take
from each other; a null id comes after all others. Long texts are cut in sections
that overlap. Strings are judged on the input, not on what is left of it. An
empty table gives an empty one. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import tempfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import _U, mix, written

SPAN = 50
ANCHOR = 16
SIDE = (SPAN - ANCHOR) // 2  # bytes beside its anchor that every string has on one side at least
MOST = 48  # strings in a piece
SECTION = 4 << 20  # bytes of text looked at together
BUCKET = 8 << 20  # bytes of text a bucket
NEAR = 1 << 15  # positions hashed at once, near the processor
PIECES = 16 << 20  # bytes of pieces sent together
SAMPLE, HOT = 4096, 64
BLOCK = 1 << 17  # entries of a file read at once: what is computed of them stays near the processor
LAST = (1 << 63) - 1  # stands for a null id
END = 255  # no byte of UTF-8; in front of a piece's first symbol
_LONG, _PREFIX = 128, 63
_MARK, _SHARED = np.uint16(_LONG << 8), np.uint16(_PREFIX << 8)
_BASE, _FURTHER = _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F)
_SLOT = 64  # strings a piece may number


# ------------------------------------------------------------ the transform


class _Ranges:
    """Least values of ranges of an array of bytes."""

    def __init__(self, size: int):
        self.levels = np.empty((max(1, size.bit_length()), size), np.uint8)
        self.log = np.zeros(size + 1, np.int64)
        for k in range(1, len(self.levels)):
            self.log[1 << k :] = k

    def fill(self, values: np.ndarray) -> None:
        n = len(values)
        self.levels[0, :n] = values
        for k in range(1, n.bit_length()):
            half = 1 << (k - 1)
            np.minimum(self.levels[k - 1, : n - 2 * half + 1], self.levels[k - 1, half : n - half + 1], out=self.levels[k, : n - 2 * half + 1])

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of [lo, hi)."""
        k = self.log[hi - lo]
        return np.minimum(self.levels[k, lo], self.levels[k, hi - (1 << k)])


def _place(keys: np.ndarray) -> np.ndarray:
    """Places in the block of symbols with their places."""
    return (keys & 0xFFFFFF).astype(np.int64) >> 1


class Collection:
    """The transform of a collection as files in ``folder``: a symbol, a common
    prefix (with a mark of suffixes of ``span`` symbols and more) for each suffix,
    and a label for each marked one."""

    def __init__(self, pieces: list[bytes], folder: str, span: int = SPAN, block: int = BLOCK):
        self.span, self.block, self.folder = span, block, folder
        self.sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.text = np.frombuffer(b"".join(pieces), np.uint8)
        self.files: dict[str, BinaryIO] = {}
        # all pieces end in the same round, so short ones begin later
        self.rounds, self.last = 0, int(self.sizes.max())
        self.begin = self.last - self.sizes
        self.heads = np.cumsum(self.sizes) - 1 + self.begin  # less a round: the symbol put in place by it
        self.waiting = np.argsort(self.begin, kind="stable")
        self.n, self.begun = 0, 0
        self.number = np.dtype(np.int32 if len(pieces) * _SLOT < 1 << 31 else np.int64)  # of labels
        self.ranges = _Ranges(block)
        self.up, self.keys = np.arange(block, dtype=np.uint32) << 1, np.empty(block, np.uint32)
        self.symbols = np.arange(256, dtype=np.uint32) << 24
        self.counts = np.zeros(256, np.int64)
        nothing = np.zeros(0, np.int64)
        self.place = self.piece = nothing  # of the newest suffixes, in order
        self._insert(nothing, nothing.astype(np.uint8), nothing, nothing, nothing.astype(np.uint8))
        while self.rounds < self.last:
            places = self._places()
            self.rounds += 1
            self._insert(*places)

    def _file(self, name: str, turn: int) -> BinaryIO:
        """One of the two files of ``name``, at its start: files only grow, so they are written over."""
        key = f"{name}-{turn % 2}"
        if key not in self.files:
            self.files[key] = open(os.path.join(self.folder, key), "w+b")
        self.files[key].seek(0)
        return self.files[key]

    def close(self) -> None:
        for file in self.files.values():
            file.close()

    def _before(self, piece: np.ndarray) -> np.ndarray:
        """The symbols in front of what the pieces have in place."""
        if self.rounds == self.last:
            return np.full(len(piece), END, np.uint8)
        return self.text[self.heads[piece] - self.rounds]

    def _blocks(self, turn: int) -> Iterator[tuple[int, np.ndarray]]:
        entries = self._file("entries", turn)
        for lo in range(0, max(self.n, 1), self.block):
            yield lo, np.frombuffer(entries.read(2 * min(self.block, self.n - lo)), np.uint16)

    def _places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First pass. Of the suffixes made longer: place, common prefix with the
        one before, piece; of others whose neighbour is new: place, common prefix."""
        begun = int(np.searchsorted(self.begin[self.waiting], self.rounds + 1, "right"))
        below = begun + np.cumsum(self.counts) - self.counts
        passed = np.zeros(256, np.int64)
        carried = np.full(256, _PREFIX, np.uint8)  # least prefix since a symbol was last seen
        newest = np.zeros(256, bool)  # whether that one was new
        ranks, values = np.empty(len(self.place), np.int64), np.empty(len(self.place), np.uint8)
        others: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # symbol, rank, value
        for lo, entries in self._blocks(self.rounds):
            n = len(entries)
            prefixes = (entries >> 8).astype(np.uint8) & _PREFIX
            a, b = np.searchsorted(self.place, (lo, lo + n))
            at = self.place[a:b] - lo
            # the block by symbol and place; the last bit tells the new ones
            keys = self.keys[:n]
            np.left_shift(entries, 24, out=keys, dtype=np.uint32)
            keys |= self.up[:n]
            keys[at] |= 1
            keys.sort()
            start = np.searchsorted(keys, self.symbols)
            end = np.append(start[1:], n)
            count = end - start
            held = np.flatnonzero(count)
            self.ranges.fill(prefixes)
            by = np.argsort(self.symbol[a:b], kind="stable")
            at, symbol = at[by], self.symbol[a:b][by]
            k = np.flatnonzero((keys & 1).astype(bool))
            first = k == start[symbol]
            value = self.ranges.least(np.where(first, 0, _place(keys[k - 1]) + 1), at + 1)
            value[first] = np.minimum(value[first], carried[symbol[first]])
            rank = passed[symbol] + k - start[symbol]
            ranks[a + by], values[a + by] = rank, value
            # older entries behind new ones: the first of a symbol, then those in the block
            heads = held[newest[held]]
            heads = heads[keys[start[heads]] & 1 == 0]
            others.append((heads.astype(np.uint8), passed[heads], np.minimum(carried[heads], self.ranges.least(
                np.zeros(len(heads), np.int64), _place(keys[start[heads]]) + 1))))
            followed = np.flatnonzero(k + 1 < end[symbol])
            behind = keys[k[followed] + 1]
            older = behind & 1 == 0
            followed, behind = followed[older], _place(behind[older])
            others.append((symbol[followed], rank[followed] + 1, self.ranges.least(at[followed] + 1, behind + 1)))
            back = keys[end[held] - 1]
            last = _place(back)
            carried = np.minimum(carried, prefixes.min())
            carried[held] = _PREFIX
            more = last + 1 < n
            carried[held[more]] = self.ranges.least(last[more] + 1, np.full(int(more.sum()), n))
            newest[held] = back & 1 == 1
            passed += count

        def placed(symbol: np.ndarray, rank: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            by = np.argsort(symbol, kind="stable")  # places rise within a symbol
            return by, (below[symbol] + rank)[by], np.where(rank > 0, np.minimum(value + 1, self.span), 0).astype(np.uint8)[by]

        by, place, prefix = placed(self.symbol, ranks, values)
        _, other, changed = placed(*(np.concatenate(x) for x in zip(*others, strict=True)))
        return place, prefix, self.piece[by], other, changed

    def _insert(self, place: np.ndarray, prefix: np.ndarray, piece: np.ndarray, other: np.ndarray, changed: np.ndarray) -> None:
        """Second pass: the files written anew with the new suffixes in between."""
        old = self.rounds - 1
        # pieces that begin: empty suffixes behind those that are there
        fresh = self.waiting[self.begun : int(np.searchsorted(self.begin[self.waiting], self.rounds, "right"))]
        place = np.concatenate([np.arange(self.begun, self.begun + len(fresh)), place])
        piece = np.concatenate([fresh, piece])
        self.begun += len(fresh)
        symbol = self._before(piece)
        label = piece * _SLOT + self.last - self.rounds
        marked = self.rounds - self.begin[piece] >= self.span
        prefix = np.concatenate([np.zeros(len(fresh), np.uint8), prefix]) | np.where(marked, _LONG, 0).astype(np.uint8)
        label = label[marked].astype(self.number)
        passed = 0
        before = place - np.arange(len(place))  # older entries in front of each
        labels, out_labels = self._file("labels", old), self._file("labels", self.rounds)
        out_entries = self._file("entries", self.rounds)
        added = prefix.astype(np.uint16) << 8 | symbol
        changed = changed.astype(np.uint16) << 8
        a = 0
        for lo, entries in self._blocks(old):
            n = len(entries)
            b = len(place) if lo + n == self.n else int(np.searchsorted(before, lo + n))
            at = place[a:b] - (lo + a)
            kept = np.ones(n + b - a, bool)
            kept[at] = False
            merged = np.empty(len(kept), np.uint16)
            merged[kept] = entries
            merged[at] = added[a:b]
            c, d = np.searchsorted(other, (lo + a, lo + a + len(kept)))
            nearer = other[c:d] - (lo + a)
            merged[nearer] = merged[nearer] & ~_SHARED | changed[c:d]
            out_entries.write(merged.data)
            older = kept[np.flatnonzero(merged >= _MARK)]
            if len(older):
                both = np.empty(len(older), self.number)
                many = np.count_nonzero(older)
                both[older] = np.frombuffer(labels.read(self.number.itemsize * many), self.number)
                both[np.flatnonzero(~older)] = label[passed : passed + len(older) - many]
                passed += len(older) - many
                out_labels.write(both.data)
            a = b
        self.n += len(place)
        self.place, self.piece, self.symbol = place, piece, symbol
        self.counts += np.bincount(symbol, minlength=256)

    def least(self, of_piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first string of each piece, least number among the pieces that hold
        the string) from one read of the finished files."""
        strings = self.sizes - self.span + 1
        first = np.cumsum(strings) - strings
        out = np.empty(int(strings.sum()), of_piece.dtype)
        held_label, held_same = np.zeros(0, self.number), np.zeros(0, bool)
        labels = self._file("labels", self.rounds)
        for lo, entries in self._blocks(self.rounds):
            marks = entries[entries >= _MARK] >> 8 & _PREFIX
            label = np.concatenate([held_label, np.frombuffer(labels.read(self.number.itemsize * len(marks)), self.number)])
            same = np.concatenate([held_same, marks >= self.span])
            runs = np.flatnonzero(~same)
            done = len(label) if lo + len(entries) == self.n else (int(runs[-1]) if len(runs) else 0)
            held_label, held_same = label[done:], same[done:]
            if done:
                runs = runs[runs < done]
                own = of_piece[label[:done] // _SLOT]
                low = np.minimum.reduceat(own, runs)
                out[first[label[:done] // _SLOT] + label[:done] % _SLOT] = np.repeat(low, np.diff(np.append(runs, done)))
        return first, out


# ------------------------------------------------------------ pieces


def _packed(*arrays: np.ndarray) -> bytes:
    sizes = np.array([a.nbytes for a in arrays], np.int64)
    return zstandard.ZstdCompressor(3).compress(b"".join([sizes.tobytes(), *[np.ascontiguousarray(a).tobytes() for a in arrays]]))


def _unpacked(data: bytes, *dtypes: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    ends = np.cumsum(np.concatenate([[8 * len(dtypes)], np.frombuffer(raw, np.int64, len(dtypes))]))
    return [np.frombuffer(raw[a:b], t) for a, b, t in zip(ends[:-1].tolist(), ends[1:].tolist(), dtypes, strict=True)]


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each position: the eight bytes from there on, and the hash of the
    ``ANCHOR``-byte string that starts there."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words, hashes = np.empty(len(data), _U), np.empty(len(data) - ANCHOR + 1, _U)
    for lo in range(0, len(data), NEAR):
        hi = min(lo + NEAR, len(data))
        for k in range(8):
            words[lo + k : hi : 8] = padded[lo + k : lo + k + (hi - lo - k + 7) // 8 * 8].view("<u8")
    for lo in range(0, len(hashes), NEAR):
        h = words[lo : min(lo + NEAR, len(hashes))] * _BASE
        h += words[lo + ANCHOR - 8 : lo + ANCHOR - 8 + len(h)] * _FURTHER
        h ^= h >> _U(32)
        h *= _BASE
        h ^= h >> _U(29)
        hashes[lo : lo + len(h)] = h
    return words, hashes


def _least(hashes: np.ndarray) -> np.ndarray:
    """Of each position: the least of the hashes in the string that starts there."""
    width = SPAN - ANCHOR + 1
    out = np.empty(len(hashes) - width + 1, _U)
    for lo in range(0, len(out), NEAR):
        h, size = hashes[lo : lo + NEAR + width - 1], 1
        while size * 2 <= width:
            h = np.minimum(h[:-size], h[size:])
            size *= 2
        out[lo : lo + NEAR] = np.minimum(h[: len(h) - (width - size)], h[width - size :])
    return out


def anchors(data: np.ndarray) -> np.ndarray:
    """Of each position: the anchor of the string that starts there."""
    return _least(_hashes(data)[1])


def _sides(words: np.ndarray, h: np.ndarray, start: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the first anchor of the strings from ``start`` on, and hashes of the
    SIDE bytes in front of and behind it. Bytes that no string of the piece holds do no harm."""
    at = np.empty(len(start), np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(h, SPAN - ANCHOR + 1)
    for lo in range(0, len(start), 1 << 12):
        own = slice(lo, lo + (1 << 12))
        at[own] = start[own] + (windows[start[own]] == anchor[own, None]).argmax(1)

    def side(begin: np.ndarray) -> np.ndarray:  # SIDE = 17: two words and a byte
        first, second, third = (words[np.clip(begin + k, 0, len(words) - 1)] for k in (0, 8, SIDE - 8))
        return mix(mix(first * _BASE + second) * _FURTHER + third)

    return at, side(at - SIDE), side(at + ANCHOR)


class _Sections:
    """Sections of texts looked at together."""

    def __init__(self, buckets: int, hot: np.ndarray):
        self.buckets, self.hot = buckets, hot
        self.clear()

    def clear(self) -> None:
        self.parts: list[bytes] = []
        self.of: list[tuple[int, int, int]] = []  # id, print, offset in the text
        self.bytes = 0

    def add(self, doc: int, fp: int, text: bytes) -> Iterator[tuple[int, bytes]]:
        for at in range(0, len(text) - SPAN + 1, SECTION):
            part = text[at : at + SECTION + SPAN - 1]
            self.parts.append(part)
            self.of.append((doc, fp, at))
            self.bytes += len(part)
            if self.bytes >= SECTION:
                yield from self.flush()

    def cut(self) -> tuple[np.ndarray, ...]:
        """(start, strings, section, bytes before the anchor, key, marks of both sides) of the pieces."""
        raw = b"".join(self.parts)
        sizes = np.fromiter(map(len, self.parts), np.int64, len(self.parts))
        data, n, ends = np.frombuffer(raw, np.uint8), len(raw) - SPAN + 1, np.cumsum(sizes)
        over = (ends[:-1, None] + np.arange(1 - SPAN, 0)).ravel()  # strings that would reach into the next section
        lots = []
        for lo in range(0, n, NEAR - 3 * SPAN):  # with the bytes beside them that sides hold
            hi, begin = min(lo + NEAR - 3 * SPAN, n), max(lo - SIDE, 0)
            words, h = _hashes(data[begin : hi + 2 * SPAN])
            least = _least(h)
            own = slice(lo - begin, hi - begin)
            # another anchor, or the same one again behind the place that is left
            new = np.ones(hi - lo, bool)
            prior = slice(max(own.start - 1, 0), own.stop - 1)
            new[(hi - lo) - (prior.stop - prior.start) :] = (least[prior.start + 1 : own.stop] != least[prior]) | (h[prior] == least[prior])
            new[ends[slice(*np.searchsorted(ends, (lo, hi)))] - lo] = True
            new[over[slice(*np.searchsorted(over, (lo, hi)))] - lo] = False
            start = np.flatnonzero(new) + own.start
            place, *sides = _sides(words, h, start, least[start])
            lots.append((start + begin, least[start], place + begin, *sides))
        start, anchor, *sides = (np.concatenate(x) for x in zip(*lots, strict=True))
        section = np.searchsorted(ends, start, "right")
        strings = np.minimum(np.append(start[1:], n), ends[section] - SPAN + 1) - start
        most = np.where(np.isin(anchor, self.hot), 1, MOST)
        parts = -(-strings // most)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, strings, section, anchor, most, place, left, right = (np.repeat(x, parts) for x in (start, strings, section, anchor, most, *sides))
        start, strings = start + nth * most, np.minimum(most, strings - nth * most)
        key, is_hot = mix(anchor), np.flatnonzero(most == 1)
        left, right = mix(key ^ left), mix(key ^ right)
        if len(is_hot):  # dealt by the whole string
            key[is_hot] = mix(np.fromiter((zlib.crc32(raw[s : s + SPAN]) for s in start[is_hot].tolist()), _U, len(is_hot)))
            left[is_hot] = right[is_hot] = mix(key[is_hot])
        return start, strings, section, place - start, key, left, right

    def flush(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, references) rows: where pieces are, and marks of their anchors
        with either side."""
        if not self.parts:
            return
        start, strings, section, lead_in, key, left, right = self.cut()
        doc, fp, offset = (np.array(x, np.int64) for x in zip(*self.of, strict=True))
        lead = np.cumsum([0, *map(len, self.parts)])[:-1]
        at = start - lead[section] + offset[section]
        bucket = (key % _U(self.buckets)).astype(np.int64)
        for number, own in _groups(bucket):
            named, nth = np.unique(section[own], return_inverse=True)
            yield number, _packed(np.diff(doc[named], prepend=0), fp[named], np.diff(nth, prepend=0).astype(np.int32), at[own].astype(np.int32),
                                  strings[own].astype(np.uint8), lead_in[own].astype(np.uint8), *((x[own] >> _U(48)).astype(np.uint16) for x in (key, left, right)))
        self.clear()


def _groups(number: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(number, places) of each number."""
    small = number.astype(np.uint16) if len(number) and int(number.max()) < 1 << 16 else number
    order = np.argsort(small, kind="stable")
    edges = np.flatnonzero(np.diff(number[order], prepend=-1, append=-1))
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(number[order[lo]]), order[lo:hi]


_REFERENCE = ("<i8", "<i8", "<i4", "<i4", "u1", "u1", "<u2", "<u2", "<u2")


def _several(mark: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether another document has the mark."""
    order = np.argsort(mark)
    mark, doc = mark[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1]]))
    many = np.minimum.reduceat(doc, first) < np.maximum.reduceat(doc, first)
    out = np.empty(len(mark), bool)
    out[order] = np.repeat(many, np.diff(np.append(first, len(mark))))
    return out


def _shared(rows: list[bytes]) -> tuple[np.ndarray, ...]:
    """(id, print, start, strings) of the pieces of which other documents have the
    anchor with one side, without the strings that hold the other side."""
    lots = []
    for row in rows:
        doc, fp, nth, at, strings, ahead, anchor, *sides = _unpacked(row, *_REFERENCE)
        nth = np.cumsum(nth, dtype=np.int64)
        left, right = (anchor.astype(np.uint32) << 16 | side for side in sides)
        lots.append((np.cumsum(doc)[nth], fp[nth], at, strings, ahead, left, right))
    doc, fp, at, strings, ahead, left, right = (np.concatenate(x) for x in zip(*lots, strict=True))
    left, right = _several(left, doc), _several(right, doc)
    kept = left | right
    doc, fp, at, strings, ahead, left, right = (x[kept] for x in (doc, fp, at, strings, ahead.astype(np.int64), left, right))
    # strings from `a` to `b`: without the left side those with fewer bytes before the anchor, without the right one those with more
    a = np.where(left, 0, np.clip(ahead - SIDE + 1, 0, strings))
    b = np.where(right, strings, np.clip(ahead - (SPAN - ANCHOR - SIDE), 0, strings))
    some = a < b
    return doc[some], fp[some], (at + a)[some].astype(np.int32), (b - a)[some].astype(np.uint8)


class _Pieces:
    """Pieces of texts for the buckets."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.of: list[tuple[int, int]] = []
        self.lots: list[tuple[np.ndarray, ...]] = []  # text, bucket, start, strings
        self.cuts: list[bytes] = []
        self.bytes = 0

    def add(self, doc: int, fp: int, text: bytes, bucket: np.ndarray, start: np.ndarray, strings: np.ndarray) -> Iterator[tuple[int, bytes]]:
        for lo in range(0, len(start), SECTION // SPAN):
            part = slice(lo, lo + SECTION // SPAN)
            self.lots.append((np.full(len(start[part]), len(self.of)), bucket[part], start[part], strings[part]))
            self.cuts += [text[s : s + n + SPAN - 1] for s, n in zip(start[part].tolist(), strings[part].tolist(), strict=True)]
            self.of.append((doc, fp))
            self.bytes += int(strings[part].sum()) + (SPAN - 1) * len(strings[part])
            if self.bytes >= PIECES:
                yield from self.flush()

    def flush(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, pieces) rows. Copies of a piece are one; of a single string,
        as hot anchors are cut into, only the least id travels on."""
        if not self.lots:
            return
        text, bucket, start, strings = (np.concatenate(x) for x in zip(*self.lots, strict=True))
        doc, fp = (np.array(x, np.int64) for x in zip(*self.of, strict=True))
        for into, own in _groups(bucket):
            number: dict[bytes, int] = {}
            piece = np.fromiter((number.setdefault(self.cuts[i], len(number)) for i in own.tolist()), np.int64, len(own))
            named, nth = np.unique(text[own], return_inverse=True)
            docs, fps, at = doc[named], fp[named], start[own]
            least = np.full(len(number), LAST)
            np.minimum.at(least, piece, docs[nth])
            copies = (strings[own] == 1) & (docs[nth] > least[piece])
            left = ~copies
            sizes = np.empty(len(number), np.uint8)
            sizes[piece] = strings[own] + SPAN - 1
            yield into, _packed(
                np.diff(docs, prepend=0), fps, np.frombuffer(b"".join(number), np.uint8), sizes,
                np.diff(piece[left], prepend=0).astype(np.int32), np.diff(nth[left], prepend=0).astype(np.int32), at[left].astype(np.int32))
            if copies.any():  # judged here; spread over all buckets
                yield int(mix(docs[:1].astype(_U) + _U(len(own)))[0] % _U(self.buckets)), _packed(
                    np.diff(docs, prepend=0), fps, *[np.zeros(0, np.uint8)] * 4, np.stack([nth[copies], at[copies]]).astype(np.int32))
        self.clear()


_ROW = ("<i8", "<i8", "u1", "u1", "<i4", "<i4", "<i4")


def _spans_of_bucket(rows: list[bytes]) -> tuple[np.ndarray, ...]:
    """(id, print, from, to) of the repeated passages that a bucket finds."""
    out: list[tuple[np.ndarray, ...]] = []
    lots: list[tuple[np.ndarray, ...]] = []  # id, print, piece, start of each occurrence
    number: dict[bytes, int] = {}
    for row in rows:
        doc, fp, text, sizes, which, nth, start = _unpacked(row, *_ROW)
        doc = np.cumsum(doc)
        if not len(sizes):
            nth, start = start.reshape(2, -1)
            out.append((doc[nth], fp[nth], start, start + SPAN))
            continue
        raw, ends = text.tobytes(), np.cumsum(sizes, dtype=np.int64)
        renamed = np.fromiter((number.setdefault(raw[e - n : e], len(number)) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)),
                              np.int64, len(sizes))
        nth = np.cumsum(nth, dtype=np.int64)
        lots.append((doc[nth], fp[nth], renamed[np.cumsum(which, dtype=np.int64)], start))
    if lots:
        doc, fp, which, start = (np.concatenate(x).astype(np.int64) for x in zip(*lots, strict=True))
        least = np.full(len(number), LAST)
        np.minimum.at(least, which, doc)
        with tempfile.TemporaryDirectory(prefix="bwt-") as folder:
            built = Collection(list(number), folder)
            first, lowest = built.least(least)
            built.close()
        strings = built.sizes - SPAN + 1
        for lo in range(0, len(which), 1 << 18):  # occurrences string by string, in bounded lots
            own = slice(lo, lo + (1 << 18))
            count = strings[which[own]]
            of = np.repeat(np.arange(len(count)), count)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            gone = lowest[first[which[own]][of] + nth] < doc[own][of]
            new = gone.copy()
            new[1:] &= ~(gone[:-1] & (of[1:] == of[:-1]))
            last = gone.copy()
            last[:-1] &= ~(gone[1:] & (of[1:] == of[:-1]))
            a, b = np.flatnonzero(new), np.flatnonzero(last)
            out.append((doc[own][of[a]], fp[own][of[a]], start[own][of[a]] + nth[a], start[own][of[b]] + nth[b] + SPAN))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True))


def _joined(doc: np.ndarray, fp: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of each document in order, those that meet or overlap as one."""
    order = np.lexsort((lo, fp, doc))
    doc, fp, lo, hi = doc[order], fp[order], lo[order], hi[order]
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (fp[1:] != fp[:-1])
    # a running end that starts anew with each document
    group = np.cumsum(other)
    reach = np.maximum.accumulate(hi + group * (1 << 32)) - group * (1 << 32)
    new = other.copy()
    new[1:] |= lo[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return doc[first], fp[first], lo[first], reach[np.append(first[1:], len(doc)) - 1]


def _row(number: int, data: bytes, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({name: pa.array([number], pa.int64()), "data": pa.array([data], pa.binary())})


def _by_number(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """(number, data) of sorted rows, all of a number together."""
    at, held = None, []
    for batch in batches:
        for number, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if number != at and held:
                yield at, held
                held = []
            at = number
            held.append(data)
    if held:
        yield at, held


def _dealt(rows: DataFrame, by: str, number: int) -> DataFrame:
    return rows.repartition(number, by).sortWithinPartitions(by)


def _addressed(doc: np.ndarray, number: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows for the documents, which are dealt over ``number`` parts."""
    for part, own in _groups((mix(doc.astype(_U)) % _U(number)).astype(np.int64)):
        yield _row(part, _packed(doc[own], *(c[own] for c in columns)), "part")


def _documents(doc: np.ndarray, fp: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row a document, which holds its entries as lists."""
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (fp[1:] != fp[:-1])]))
    offsets = pa.array(np.append(first, len(doc)), pa.int32())
    return pa.RecordBatch.from_pydict({"doc": pa.array(doc[first], pa.int64()), "print": pa.array(fp[first], pa.int64())} | {
        n: pa.ListArray.from_arrays(offsets, pa.array(c, pa.int32())) for n, c in columns.items()})


def references(rows: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """(doc, print, pieces) of ``rows`` (doc, print, text): buckets, starts and
    lengths of the pieces whose anchor other documents have too."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Sections(buckets, hot)
        for batch in batches:
            for doc, fp, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from (_row(*x, "bucket") for x in held.add(doc, fp, text))
        yield from (_row(*x, "bucket") for x in held.flush())

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, data in _by_number(batches):
            doc, fp, at, strings = _shared(data)
            yield from _addressed(doc, buckets, fp, at, strings, np.full(len(doc), bucket, np.int32))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data in _by_number(batches):
            doc, fp, at, strings, bucket = (np.concatenate(x) for x in zip(*(_unpacked(d, "<i8", "<i8", "<i4", "u1", "<i4") for d in data), strict=True))
            order = np.lexsort((at, fp, doc))
            doc, fp, at, strings, bucket = (x[order] for x in (doc, fp, at, strings, bucket))
            first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (fp[1:] != fp[:-1])]))
            blobs = [_packed(bucket[a:b], np.diff(at[a:b], prepend=0).astype(np.int32), strings[a:b])
                     for a, b in zip(first.tolist(), [*first[1:].tolist(), len(doc)], strict=True)]
            yield pa.RecordBatch.from_pydict({"doc": pa.array(doc[first], pa.int64()), "print": pa.array(fp[first], pa.int64()), "pieces": pa.array(blobs, pa.binary())})

    return _dealt(_dealt(rows.select("doc", "print", "text").mapInArrow(cut, "bucket long, data binary"), "bucket", buckets).mapInArrow(
        found, "part long, data binary"), "part", buckets).mapInArrow(
        gathered, "doc long, print long, pieces binary")


def spans(texts: DataFrame, buckets: int) -> DataFrame:
    """(doc, print, from, to) of ``texts`` (doc, print, text, pieces): the passages
    to go, in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Pieces(buckets)
        for batch in batches:
            for i in range(batch.num_rows):
                doc, fp, text = (batch.column(c)[i].as_py() for c in range(3))
                bucket, start, strings = _unpacked(batch.column(3)[i].as_py(), "<i4", "<i4", "u1")
                yield from (_row(*x, "bucket") for x in held.add(doc, fp, text, bucket, np.cumsum(start, dtype=np.int64), strings.astype(np.int64)))
        yield from (_row(*x, "bucket") for x in held.flush())

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data in _by_number(batches):
            doc, fp, lo, hi = _joined(*_spans_of_bucket(data))
            yield from _addressed(doc, buckets, fp, lo.astype(np.int32), hi.astype(np.int32))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data in _by_number(batches):
            doc, fp, lo, hi = _joined(*(np.concatenate(x).astype(np.int64) for x in zip(*(_unpacked(d, "<i8", "<i8", "<i4", "<i4") for d in data), strict=True)))
            yield _documents(doc, fp, {"from": lo, "to": hi})

    return _dealt(_dealt(texts.select("doc", "print", "text", "pieces").mapInArrow(cut, "bucket long, data binary"), "bucket", buckets)
                  .mapInArrow(found, "part long, data binary"), "part", buckets).mapInArrow(
        gathered, "doc long, print long, from array<int>, to array<int>")


def _hot(rows: DataFrame, n: int) -> np.ndarray:
    """Anchors in more than a 64th of a sample of about ``SAMPLE`` documents: at
    most 64 times as many as a document of the sample has on average."""
    sample = rows.where(F.pmod(F.xxhash64("doc", "print"), F.lit(max(1, n))) < SAMPLE).select("text")

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = np.zeros(0, _U)
                for at in range(0, len(text) - SPAN + 1, SECTION):
                    own = np.union1d(own, anchors(np.frombuffer(text, np.uint8, min(SECTION + SPAN - 1, len(text) - at), at)))
                yield pa.RecordBatch.from_pydict({"anchor": pa.array(own.view(np.int64), pa.int64())})

    often = sample.mapInArrow(seen, "anchor long").groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > max(min(n, SAMPLE) // HOT, 2))
    return np.array([r["anchor"] for r in often.select("anchor").collect()], np.int64).view(_U)


def drop_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) of every row."""
    missing = F.col("id").isNull()
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.make_valid_utf8(F.coalesce(F.col(text), F.lit(""))).cast("binary").alias("text")).select(
        F.coalesce("id", F.lit(LAST)).alias("doc"), missing.alias("missing"), "text")
    # rows that share an id are told apart by a hash of the text, its last bit tells a missing id
    again = written(rows.groupBy("doc").agg(F.count("*").alias("n")).where(f"n > 1 OR doc = {LAST}").select("doc"), "bwt-repeated")
    bare = F.xxhash64("text").bitwiseAND(F.lit(-2))
    if again.isEmpty():
        rows = rows.select("doc", F.lit(0).cast("long").alias("print"), "text")
    else:
        rows = rows.join(again.withColumnRenamed("doc", "twice"), F.col("doc") == F.col("twice"), "left").select(
            "doc", F.when(F.col("twice").isNotNull(), bare.bitwiseOR(F.col("missing").cast("long"))).otherwise(0).alias("print"), "text")
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    buckets = max(1, -(-(size["bytes"] or 0) // BUCKET))
    # both joins deal the texts by the same keys, so Spark exchanges them once
    texts = rows.select("doc", "print", "text")
    named = lambda df: df.withColumnsRenamed({"doc": "f_doc", "print": "f_print"})
    same = (F.col("doc") == F.col("f_doc")) & (F.col("print") == F.col("f_print"))
    found = spans(texts.join(named(references(rows, buckets, _hot(rows, size["n"]))), same), buckets)

    def stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, los, his = (batch.column(i) for i in range(4))
            kept, removed, count = [], [], []
            for body, lo, hi in zip(texts, los, his, strict=True):
                body, lo, hi = body.as_py(), lo.as_py() or [], hi.as_py() or []
                kept.append(b"".join(body[a:b] for a, b in zip([0, *hi], [*lo, len(body)], strict=True)) if lo else body)
                removed.append(sum(hi) - sum(lo))
                count.append(len(lo))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(x) + n for x, n in zip(kept, removed, strict=True)], pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(count, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    own = F.when((F.col("doc") < LAST) | (F.col("print").bitwiseAND(F.lit(1)) == 0), F.col("doc"))
    joined = texts.join(named(found), same, "left").select(own.alias("id"), "text", "from", "to")
    out = joined.mapInArrow(stripped, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def op12_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 bytes that documents before it hold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeats(docs).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


OP12_SQL = """
WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS h FROM documents),
p AS (SELECT doc_id, unnest(generate_series(1, len(h) // 2)) AS i, h FROM d WHERE h <> ''),
w AS (SELECT doc_id, i, substr(h, 2 * i - 1, 2) AS b,
        CASE WHEN i + 49 <= len(h) // 2 THEN substr(h, 2 * i - 1, 100) END AS s FROM p),
m AS (SELECT doc_id, i, b, s IS NOT NULL AND min(doc_id) OVER (PARTITION BY s) < doc_id AS again FROM w),
c AS (SELECT doc_id, i, b, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM m),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM c),
k AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
        coalesce(string_agg(b, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k.kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
