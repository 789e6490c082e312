"""Suffix-array dedup: bytes that repeat an earlier document go.

A byte is removed if a string of `length` bytes covers it that also starts in a document with a smaller
key. Strings are judged on the input and never cross documents.

The index is a family of sparse suffix arrays. Of every string of `length` bytes, the k-gram with the least
hash is its anchor, wherever the string stands, so equal strings share their anchor. Suffixes are indexed at
anchors only, each with the bytes of all strings that chose the anchor. They are dealt to shards by the
anchor's hash. In a shard, the family has logarithmically many levels, each a sorted suffix array: a new batch
(the rows of several parts, by their number) gets a suffix array, it is scanned against every level for strings
that they share (a binary search finds the suffixes of a level whose anchor the batch has; only these are
compared), both sides keep which of their strings start in a smaller document, and then levels of about the
batch's size are merged with it. So each suffix is compared when it comes, and after that only with those that
share its anchor.

Steps, over parts of the corpus that are packed once into a bucketed table and never shuffled again:
1. each part sends the hashes of its anchors, and the shards answer, a bit each, which occur in two documents;
2. each part sends the suffixes at those anchors (each text once, with its smallest key), and the shards
   answer which of their strings start in a smaller document;
3. each part cuts its documents.
A passage that a third of all documents share is so sent once a part, not once a document.

Keys are integers. A null text is empty; a null key counts as larger than any other. Rows of equal keys
don't remove each other's bytes. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, small_batches, written
from .packs import by_shard, compress, expand, from_six, packed, six, unpack

LENGTH = 50
#: Bytes handled at a time (positions must fit in 24 bits; the arrays of so many stay in a core's cache).
PIECE = 1 << 18
#: Rows of a shard that make a batch, about, of however many parts; a batch a part would be the square of the corpus in batches.
BATCH = 1 << 18
#: Bytes of text for each shard, about, and the bounds of their number.
SHARD_BYTES, MIN_SHARDS, MAX_SHARDS = 8 << 20, 24, 20_000
_LAST = np.iinfo(np.int64).max
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.default_rng(4).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


@dataclass(frozen=True)
class Shape:
    """Sizes that follow from the length of a repeat."""

    length: int = LENGTH

    @property
    def k(self) -> int:
        """Bytes of an anchor."""
        return max(4, 2 * self.length // 5)

    @property
    def reach(self) -> int:
        """Strings that may choose one anchor; the anchor's bytes before it are one fewer."""
        return self.length - self.k + 1

    @property
    def row(self) -> int:
        return self.length + self.reach + 1


@dataclass
class Anchors:
    """Runs of strings of one anchor: where the anchor is, the first and the last string's start, and the anchor's hash."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    hash: np.ndarray


def anchors(text: np.ndarray, sizes: np.ndarray, shape: Shape) -> Anchors:
    """Of concatenated documents (bytes and the documents' sizes), at most PIECE + length bytes."""
    n = len(text)
    none = np.zeros(0, dtype=np.int64)
    if n < shape.length:
        return Anchors(none, none, none, none.astype(np.uint64))
    # hashes of k bytes, by doubling
    with np.errstate(over="ignore"):
        h, size, power = _TABLE[text], 1, _MULTIPLY
        parts = []
        while True:
            if shape.k & size:
                parts.append((h, size))
            if 2 * size > shape.k:
                break
            h = h[:-size] * power + h[size:]
            size, power = 2 * size, power * power
        h, done = None, 0
        for part, size in parts:
            p = np.uint64(pow(int(_MULTIPLY), size, 1 << 64))
            h = part if h is None else h[: n - done - size + 1] * p + part[done : done + n - done - size + 1]
            done += size
        h = _mix(h[: n - shape.k + 1])
    low = np.uint64((1 << 24) - 1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while 2 * size <= shape.reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < shape.reach:
        least = np.minimum(least[: -(shape.reach - size)], least[shape.reach - size :])
    anchor = (least & low).astype(np.int64)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    whole = doc[: n - shape.length + 1] == doc[shape.length - 1 :]
    new = np.empty(len(anchor), dtype=bool)
    new[0] = True
    new[1:] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor)) - 1
    use = whole[first]
    first, last = first[use], last[use]
    at = anchor[first]
    return Anchors(at, first, last, _mix(h[at] ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(16))


def suffixes(text: np.ndarray, a: Anchors, shape: Shape) -> np.ndarray:
    """A row of bytes for each run: the text from the anchor on, the text before it backwards, both padded, and their sizes."""
    length, back = shape.length, shape.reach - 1
    out = np.empty((len(a.at), shape.row), dtype=np.uint8)
    right, left = (a.last + length - a.at).astype(np.uint8), (a.at - a.first).astype(np.uint8)
    padded = np.concatenate((np.zeros(back, dtype=np.uint8), text, np.zeros(length, dtype=np.uint8)))
    around = np.ndarray(len(text) + 1, f"V{back + length}", padded, strides=(1,))[a.at].view(np.uint8).reshape(-1, back + length)
    np.multiply(around[:, back:], np.arange(length, dtype=np.uint8) < right[:, None], out=out[:, :length])
    np.multiply(around[:, :back][:, ::-1], np.arange(back, dtype=np.uint8) < left[:, None], out=out[:, length:-2])
    out[:, -2] = right
    out[:, -1] = left + 1  # never 0, so rows can be compared as strings
    return out


def _strings(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def _alike(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal strings are neighbours, and where in it others begin. By a hash of all bytes; what it makes equal is compared."""
    if not len(rows):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    width, h = rows.itemsize, np.zeros(len(rows), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in [*range(0, width - 7, 8), width - 8]:  # the last eight bytes may have some of those before
            h = _mix((h ^ np.ndarray(len(rows), "<u8", rows, at, (width,))) * _MULTIPLY)
    order = np.argsort(h)
    new = np.append(True, h[order][1:] != h[order][:-1])
    same = np.flatnonzero(~new)
    if any((rows[order[x]] != rows[order[x - 1]]).any() for x in np.split(same, range(1 << 16, len(same), 1 << 16))):
        order = np.argsort(rows, kind="stable")
        new[1:] = rows[order][1:] != rows[order][:-1]
    return order, np.flatnonzero(new)


def _sorted(rows: np.ndarray) -> np.ndarray:
    """The order of strings that all differ: by eight bytes at a time, of those that are equal up to there."""
    n, width = len(rows), rows.itemsize
    table = rows.view(np.uint8).reshape(n, width)
    order, tied, run = np.arange(n), np.arange(n), np.zeros(n, dtype=np.int64)
    for at in range(0, width, 8):
        word = np.zeros((len(tied), 8), dtype=np.uint8)
        word[:, : width - at] = table[order[tied], at : at + 8]
        word = word.view(">u8").ravel().astype(np.uint64)
        by = np.lexsort((word, run)) if at else np.argsort(word)
        order[tied] = order[tied][by]
        word, run = word[by], run[by]
        new = np.append(True, (word[1:] != word[:-1]) | (run[1:] != run[:-1]))
        more = ~new | ~np.append(new[1:], True)
        tied, run = tied[more], np.cumsum(new)[more]
        if not len(tied):
            break
    return order


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different string is, in the strings' order, and which of them each row is."""
    order, first = _alike(rows)
    by = _sorted(rows[order[first]])
    rank = np.empty(len(by), dtype=np.int64)
    rank[by] = np.arange(len(by))
    which = np.empty(len(rows), dtype=np.int64)
    which[order] = np.repeat(rank, np.diff(np.append(first, len(rows))))
    return order[first][by], which


@dataclass
class Level:
    """A suffix array: sorted rows, each once, with the smallest key that has it, and a bit for each string of the row that is known to start in a document with a key smaller than that."""

    rows: np.ndarray
    keys: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(rows: np.ndarray, keys: np.ndarray, bits: np.ndarray | None = None) -> Level:
        """rows as strings in any order, perhaps repeated. Of equal rows the one of the smallest key stays, with its bits: what is earlier than another need not be earlier than it."""
        bits = np.zeros(len(rows), dtype=np.uint64) if bits is None else bits
        if not len(rows):
            return Level(rows, keys, bits)
        at, which = _distinct(rows)
        least, known = np.full(len(at), _LAST), np.zeros(len(at), dtype=np.uint64)
        np.minimum.at(least, which, keys)
        use = keys == least[which]
        np.bitwise_or.at(known, which[use], bits[use])
        return Level(rows[at], least, known)

    def prefixes(self, k: int) -> np.ndarray:
        """The first k bytes of the rows."""
        return _strings(self.rows.view(np.uint8).reshape(-1, self.rows.itemsize)[:, :k])

    def sharing(self, prefixes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows that start with one of some sorted prefixes of k bytes, and how many start with each."""
        own = self.prefixes(k)
        low, high = np.searchsorted(own, prefixes, side="left"), np.searchsorted(own, prefixes, side="right")
        size = high - low
        return np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum()), size

    def find(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where rows are, and whether they are."""
        if rows is self.rows:
            return np.arange(len(rows)), np.ones(len(rows), dtype=bool)
        at = np.minimum(np.searchsorted(self.rows, rows), max(0, len(self.rows) - 1))
        return at, self.rows[at] == rows if len(self.rows) else np.zeros(len(rows), dtype=bool)


def earlier(rows: np.ndarray, keys: np.ndarray, shape: Shape) -> np.ndarray:
    """For each of some rows, a bit for each of its strings that another row has with a smaller key."""
    out = np.zeros(len(rows), dtype=np.uint64)
    table = rows.view(np.uint8).reshape(-1, shape.row)
    text = np.concatenate((table[:, shape.length : shape.length + shape.reach - 1][:, ::-1], table[:, : shape.length]), axis=1)
    right, left = table[:, -2].astype(int), table[:, -1].astype(int) - 1
    with np.errstate(over="ignore"):
        power, last = np.uint64(1), shape.reach - 1
        h = np.zeros(len(rows), dtype=np.uint64)
        for j in range(shape.length):
            h = h * _MULTIPLY + _TABLE[text[:, j]]
            power = power * _MULTIPLY if j else power
        for start in range(shape.reach):  # the hash rolls along the text; equal hashes are compared by their bytes
            before = last - start
            use = np.flatnonzero((before <= left) & (shape.length - before <= right))
            use = use[np.argsort(h[use])]
            same = h[use][1:] == h[use][:-1]
            if same.any():
                use = use[np.append(same, False) | np.append(False, same)]
                strings = text[use, start : start + shape.length]
                same = (h[use][1:] == h[use][:-1]) & (strings[1:] == strings[:-1]).all(axis=1)
                first = np.flatnonzero(np.append(True, ~same))
                least = np.repeat(np.minimum.reduceat(keys[use], first), np.diff(np.append(first, len(use))))
                out[use[least < keys[use]]] |= np.uint64(1) << np.uint64(before)
            if before:
                h = (h - _TABLE[text[:, start]] * power) * _MULTIPLY + _TABLE[text[:, start + shape.length]]
    return out


class SuffixFamily:
    """Levels of geometrically growing sizes; every batch is scanned against all of them when it comes."""

    def __init__(self, shape: Shape):
        self.shape, self.levels, self.compared = shape, [], 0

    def add(self, batch: Level) -> None:
        """Finds the strings that the batch shares with the levels and within itself; then it becomes a level, with which levels of its size or less are merged."""
        if not len(batch.rows):
            return
        own = batch.prefixes(self.shape.k)
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        size = np.diff(np.append(first, len(own)))
        near, sizes = zip(*(level.sharing(own[first], self.shape.k) for level in self.levels), strict=True) if self.levels else ((), ())
        mine = np.flatnonzero(np.repeat(sum(sizes, size) > 1, size))  # a row alone with its anchor shares no string
        rows = np.concatenate([batch.rows[mine], *(x.rows[at] for x, at in zip(self.levels, near, strict=True))])
        keys = np.concatenate([batch.keys[mine], *(x.keys[at] for x, at in zip(self.levels, near, strict=True))])
        bits, done = earlier(rows, keys, self.shape), len(mine)
        self.compared += len(rows)
        batch = Level(batch.rows, batch.keys, batch.bits.copy())
        batch.bits[mine] |= bits[:done]
        for level, at in zip(self.levels, near, strict=True):
            level.bits[at] |= bits[done : done + len(at)]
            done += len(at)
        while self.levels and len(self.levels[-1].rows) <= 2 * len(batch.rows):
            old = self.levels.pop()
            batch = Level.of(*(np.concatenate((getattr(old, x), getattr(batch, x))) for x in ("rows", "keys", "bits")))
        self.levels.append(batch)

    def hits(self, rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Of rows of a batch that was added: a bit for each string that starts in a document with a key smaller than the row's."""
        out = np.zeros(len(rows), dtype=np.uint64)
        for level in self.levels:
            at, there = level.find(rows)
            if there.any():
                out[there & (level.keys[at] < keys)] = ~np.uint64(0)
                own = there & (level.keys[at] == keys)
                out[own] |= level.bits[at[own]]
        return out


def found(parts: list[tuple[np.ndarray, np.ndarray]], shape: Shape) -> Iterator[np.ndarray]:
    """For the rows and keys that each part sent, a bit for each of a row's strings that starts in a document with a key smaller than the row's. Parts are joined to batches of BATCH rows, about."""
    family, batches, i = SuffixFamily(shape), [], 0
    ends = np.cumsum([len(k) for _, k in parts])
    while i < len(parts):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + BATCH, side="right")))
        rows, keys = (np.concatenate([part[x] for part in parts[i:j]]) for x in (0, 1))
        sizes = [len(k) for _, k in parts[i:j]]
        parts[i:j] = [None] * (j - i)  # rows are held once
        at, which = _distinct(rows)
        least = np.full(len(at), _LAST)
        np.minimum.at(least, which, keys)
        batch = Level(rows[at], least, np.zeros(len(at), dtype=np.uint64))
        family.add(batch)
        batches.append((batch, which, keys > least[which], sizes))
        i = j
    for batch, which, later, sizes in batches:
        mine = family.hits(batch.rows, batch.keys)[which]
        mine[later] = ~np.uint64(0)
        yield from np.split(mine, np.cumsum(sizes)[:-1])


def _pieces(sizes: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """Spans of documents (first, one beyond the last) of about PIECE bytes; a longer document is cut, so that every string lies in one piece. Then the start and end in bytes."""
    ends = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        start = int(ends[i] - sizes[i])
        j = max(i + 1, int(np.searchsorted(ends, start + PIECE, side="right")))
        end = int(ends[j - 1])
        if j == i + 1:
            for at in range(start, max(end - length + 1, start + 1), PIECE):
                yield i, j, at, min(end, at + PIECE + length - 1)
        else:
            yield i, j, start, end
        i = j


def _found(pack: bytes, shape: Shape) -> Iterator[tuple[np.ndarray, np.ndarray, Anchors, int]]:
    """Of each piece of a pack: its bytes, the number in the pack of each run's document, the runs, and where it starts."""
    _keys, sizes, text = unpack(pack)
    starts = np.cumsum(sizes) - sizes
    for i, j, start, end in _pieces(sizes, shape.length):
        own = sizes[i:j] if j > i + 1 else np.array([end - start])
        piece = text[start:end]
        a = anchors(piece, own, shape)
        yield piece, np.searchsorted(starts[i:j], a.first + start, side="right") - 1 + i, a, start


class _Part:
    """What a part of the corpus sends, computed anew in every step."""

    def __init__(self, packs: pd.DataFrame, shape: Shape):
        self.shape = shape
        self.packs = list(packs.sort_values("seq")["pack"])
        docs = [unpack(pack)[0].copy() for pack in self.packs]
        self.keys, rank = np.unique(np.concatenate([*docs, np.zeros(0, dtype=np.int64)]), return_inverse=True)
        #: Of each piece: the pack's number, start, end; of its runs where the anchor is, how far before it the last and the first string start, and which of the keys theirs are.
        self.pieces, hashes, done = [], [], 0
        for number, pack in enumerate(self.packs):
            own = rank[done : done + len(docs[number])].astype(np.int32)
            done += len(own)
            for piece, doc, a, start in _found(pack, shape):
                self.pieces.append((number, start, start + len(piece), a.at.astype(np.int32), (a.at - a.last).astype(np.uint8), (a.at - a.first).astype(np.uint8), own[doc]))
                hashes.append(a.hash)
        h = np.concatenate([*hashes, np.zeros(0, dtype=np.uint64)])
        k = np.concatenate([*(p[-1] for p in self.pieces), np.zeros(0, dtype=np.int32)])
        hashes = None
        order = np.argsort(h)
        h, k = h[order], k[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, dtype=np.int64)
        self.hashes = h[first]
        self.several = np.maximum.reduceat(k, first) != np.minimum.reduceat(k, first) if len(first) else np.zeros(0, dtype=bool)
        #: Which of the hashes each run has.
        self.place = np.empty(len(h), dtype=np.int32)
        self.place[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(h))))

    def sent(self, shards: int) -> Iterator[tuple[int, bytes, bytes]]:
        """Of each shard: hashes that one document has, and a bit for each that is in several here."""
        for s, at in by_shard(self.hashes, shards):
            yield s, six(self.hashes[at]), np.packbits(self.several[at]).tobytes()

    def shared(self, bits: pd.DataFrame, shards: int) -> np.ndarray:
        """For each hash, whether two documents have it."""
        answer = dict(zip(bits["shard"], bits["bits"], strict=True))
        out = np.zeros(len(self.hashes), dtype=bool)
        for s, at in by_shard(self.hashes, shards):
            if s in answer:
                out[at] = np.unpackbits(np.frombuffer(answer[s], np.uint8), count=len(at))
        return out

    def unique(self, shared: np.ndarray) -> Unique:
        """The runs at shared anchors; the others are forgotten."""
        used = shared[self.place]
        rows = np.empty(np.count_nonzero(used), dtype=f"S{self.shape.row}")  # as many as there are runs, if no row is repeated in its piece
        keys, places, runs, which, done, total = [], [], [], [], 0, 0
        text, of = None, -1
        while self.pieces:
            number, start, end, at, low, high, key = self.pieces.pop(0)
            use = np.flatnonzero(used[done : done + len(at)])
            place = self.place[done : done + len(at)][use]
            done += len(at)
            if not len(use):
                continue
            if of != number:
                text, of = unpack(self.packs[number])[2], number
            at, low, high, key = at[use], low[use], high[use], key[use]
            r = _strings(suffixes(text[start:end], Anchors(at, at - high, at - low, place), self.shape))
            order, first = _alike(r)
            rows[total : total + len(first)] = r[order[first]]
            keys.append(np.minimum.reduceat(key[order], first))
            places.append(place[order[first]])
            w = np.empty(len(r), dtype=np.int32)
            w[order] = np.repeat(np.arange(total, total + len(first), dtype=np.int32), np.diff(np.append(first, len(r))))
            total += len(first)
            runs.append((number, start, at, low, high, key))
            which.append(w)
        rows = rows[:total]
        k, place = (np.concatenate([*x, np.zeros(0, dtype=np.int32)]) for x in (keys, places))
        order, first = _alike(rows)
        rank = np.empty(total, dtype=np.int32)
        rank[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, total)))
        k = np.minimum.reduceat(k[order], first) if total else k
        return Unique(rows, order[first], self.keys[k], self.hashes[place[order[first]]], [(*x[:5], self.keys[x[5]], rank[w]) for x, w in zip(runs, which, strict=True)])


@dataclass
class Unique:
    """Of a part: where each different row is among rows, its smallest key here and its hash; and of each piece the pack's number, its start, where the runs' anchors are, how far before them the last and the first string start, the runs' keys, and which row each is."""

    rows: np.ndarray
    at: np.ndarray
    keys: np.ndarray
    hashes: np.ndarray
    runs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def find_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", key: str = "doc_id", with_text: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, spans (removed runs of bytes: starts and ends), kept_sha256, and with_text kept_text (the rest; bytes that no longer make a character are dropped): a row for each of docs."""
    spark, shape = docs.sparkSession, Shape(length)
    if not 8 <= length <= 75:
        raise ValueError("length must be 8 to 75 bytes")
    small_batches(spark)

    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(int(_LAST))).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    with packed(rows) as (packs, buckets):
        total = packs.agg(F.sum("size")).first()[0] or 0
        shards = int(min(MAX_SHARDS, max(MIN_SHARDS, total // SHARD_BYTES)))

        def send_hashes(own: pd.DataFrame) -> pd.DataFrame:
            give_back()
            part = int(own["part"].iloc[0])
            return pd.DataFrame([(s, part, h, b) for s, h, b in _Part(own, shape).sent(shards)], columns=["shard", "part", "hashes", "several"])

        def answer_hashes(sent: pd.DataFrame) -> pd.DataFrame:
            give_back()
            sent = sent.sort_values("part")
            lists = [from_six(x) for x in sent["hashes"]]
            every, count = np.unique(np.concatenate(lists), return_counts=True)
            out = []
            for part, own, several in zip(sent["part"], lists, sent["several"], strict=True):
                bits = (count[np.searchsorted(every, own)] > 1) | np.unpackbits(np.frombuffer(several, np.uint8), count=len(own)).astype(bool)
                if bits.any():
                    out.append((int(part), int(sent["shard"].iloc[0]), np.packbits(bits).tobytes()))
            return pd.DataFrame(out, columns=["part", "shard", "bits"])

        hashes = packs.groupBy("part").applyInPandas(send_hashes, "shard int, part long, hashes binary, several binary")
        bits = written(hashes.repartition(shards, "shard").groupBy("shard").applyInPandas(answer_hashes, "part long, shard int, bits binary"), "shared")

        def send_suffixes(own: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
            give_back()
            out = []
            if len(own) and len(answer):
                p = _Part(own, shape)
                u = p.unique(p.shared(answer, shards))
                for s, at in by_shard(u.hashes, shards):
                    out.append((s, int(own["part"].iloc[0]), compress(u.rows[u.at[at]]), u.keys[at].tobytes()))
            return pd.DataFrame(out, columns=["shard", "part", "rows", "keys"])

        def answer_suffixes(sent: pd.DataFrame) -> pd.DataFrame:
            give_back()
            sent = sent.sort_values("part")
            out = []
            for part, mine in zip(sent["part"], found([(expand(r, f"S{shape.row}"), np.frombuffer(k, np.int64)) for r, k in zip(sent["rows"], sent["keys"], strict=True)], shape), strict=True):
                if mine.any():
                    out.append((int(part), int(sent["shard"].iloc[0]), compress(mine)))
            return pd.DataFrame(out, columns=["part", "shard", "masks"])

        def by_part(df: DataFrame) -> DataFrame:
            return df.repartition(buckets, "part").groupBy("part")

        own = packs.groupBy("part")
        sent = own.cogroup(by_part(bits)).applyInPandas(send_suffixes, "shard int, part long, rows binary, keys binary")
        masks = written(sent.repartition(shards, "shard").groupBy("shard").applyInPandas(answer_suffixes, "part long, shard int, masks binary"), "masks")
        answers = bits.select("part", "shard", "bits", F.lit(None).cast("binary").alias("masks")).unionByName(masks.select("part", "shard", F.lit(None).cast("binary").alias("bits"), "masks"))
        def cut(own: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
            give_back()
            out = []
            matched: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
            p = None
            if len(own) and answer["masks"].notna().any():
                p = _Part(own, shape)
                u = p.unique(p.shared(answer[answer["bits"].notna()], shards))
                mask, given = np.zeros(len(u.at), dtype=np.uint64), dict(zip(answer["shard"][answer["masks"].notna()], answer["masks"][answer["masks"].notna()], strict=True))
                for s, at in by_shard(u.hashes, shards):
                    if s in given:
                        mask[at] = expand(given[s], np.uint64)
                u.rows = None
                while u.runs:
                    number, start, at, low, high, key, which = u.runs.pop(0)
                    every = (np.uint64(2) << high.astype(np.uint64)) - (np.uint64(1) << low.astype(np.uint64))
                    hits = np.where(u.keys[which] < key, every, mask[which] & every)
                    whole, some = hits == every, np.flatnonzero((hits != every) & (hits != 0))
                    spans = matched.setdefault(number, [])
                    spans.append((at[whole] - high[whole] + start, at[whole] - low[whole] + start + shape.length))
                    for before in range(shape.reach if len(some) else 0):
                        first = at[some[(hits[some] >> np.uint64(before)) & np.uint64(1) > 0]] - before + start
                        spans.append((first, first + shape.length))
            for number, pack in enumerate(p.packs if p else own.sort_values("seq")["pack"]):
                keys, sizes, text = unpack(pack)
                gone = np.zeros(len(text) + 1, dtype=np.int32)
                for first, end in matched.get(number, ()):
                    np.add.at(gone, first, 1)
                    np.add.at(gone, end, -1)
                gone = np.cumsum(gone[:-1]) > 0
                starts, none = np.cumsum(sizes) - sizes, np.zeros(0, dtype=np.int64)
                for k, a, n in zip(keys.tolist(), starts.tolist(), sizes.tolist(), strict=True):
                    g = gone[a : a + n]
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], g.view(np.int8), [0])))) if g.any() else none
                    kept = text[a : a + n][~g].tobytes() if len(edge) else text[a : a + n].tobytes()
                    row = (None if k == _LAST else k, n, n - len(kept), edge[::2].tolist(), edge[1::2].tolist(), hashlib.sha256(kept).hexdigest())
                    out.append((*row, kept.decode("utf-8", "ignore")) if with_text else row)
            return pd.DataFrame(out, columns=columns).astype({"_key": "Int64"})

        columns = ["_key", "n_bytes", "n_removed", "_starts", "_ends", "kept_sha256"] + ["kept_text"] * with_text
        result = own.cogroup(by_part(answers)).applyInPandas(cut, "_key long, n_bytes long, n_removed long, _starts array<long>, _ends array<long>, kept_sha256 string" + ", kept_text string" * with_text)
        spans = F.arrays_zip(F.col("_starts").alias("start"), F.col("_ends").alias("end")).alias("spans")
        more = ["kept_text"] * with_text
        return written(result.select(F.col("_key").alias(key), "n_bytes", "n_removed", spans, "kept_sha256", *more), "cut")
