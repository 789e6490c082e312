"""Collocations: phrases whose words meet more often than chance, found by hierarchical pair naming.

A phrase of k words is the pair of its first and its last k - 1 words, which overlap and are both frequent if
the phrase is (its parts occur wherever it does). So every level names pairs of the level before:

1. Texts are cut into words once and kept as blocks of a bounded size: the places of words, with a gap where
   a piece ends, and for each place a number in the block's own list of different words.
2. The entries of all lists meet, a row for each block and different phrase, and are summed; what occurs often enough
   gets a name (an id, of the first entry) that holds everywhere.
3. The names are joined back to the blocks, and each block puts them in the place of its numbers. Neighbouring places
   that both have a name are the pairs of the next level, listed again; what the level before had is deleted.

A pair's two halves are its parents, by id. Counts of all beginnings and ends come down these pointers, a join a
level, so every cut is looked up without a search; and the most frequent child of each parent tells whether the parent
is subsumed (a longer phrase that holds it and is as frequent implies one that is longer by a word).

Words and phrases are counted in the blocks before the shuffle, so a word that fills a third of all texts is a row a
block. Products are decimals of 38 digits. Languages are parts of the words, so one that most documents have is no group.

Null and empty texts, and texts of marks only, have no words. A null language is `und`, as is one that is so called.
Repeated rows count as often as they are there. Texts are cut between blocks only where a piece ends, so a piece
of any length stays whole; a text of one endless piece makes a block as long. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import discard
from .common import give_back, small_batches, written, written_alone

#: Bytes of text in a block, about.
BLOCK = 4 << 20
#: What ends a piece, and what stands between words.
BREAKS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
UNKNOWN = "und"
#: Shares in which the words or pairs of a level are dealt out, one after another, so that their shuffles don't lie on the disks together.
SHARES = 4
LEAST, LONGEST, SHOWN, PER_MILLE = 100, 5, 2000, 1000

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(GAPS)] = 1
_KIND[list(BREAKS)] = 2
#: Bits of a number in a block's list, and of a block's number in its task: (block, number) together name a gram.
IN_LIST, IN_TASK = 28, 12


def _packed(x: np.ndarray, kind: str = "<i4") -> bytes:
    """Whole numbers, compressed byte by byte, as most have few bits."""
    width = np.dtype(kind).itemsize
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x, dtype=kind).view(np.uint8).reshape(-1, width).T.tobytes())


def _unpacked(x: bytes, kind: str = "<i4") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _rising(x: np.ndarray) -> bytes:
    """Rising numbers as their steps, which take little room."""
    return _packed(np.diff(x, prepend=0))


def _row(**columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array([v]) for v in columns.values()], names=list(columns))


def words_of(raw: bytes) -> tuple[np.ndarray, pa.Array]:
    """Places and words of a text in UTF-8: a place is one more than the one before it in the same piece, and two more or further in another piece."""
    data = np.frombuffer(raw.lower(), dtype=np.uint8)  # of bytes, so A-Z only
    kind = _KIND[data]
    inside = kind == 0
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ended = np.cumsum(kind == 2)[starts] if len(starts) else np.zeros(0, dtype=np.int64)
    offsets = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes())])
    return np.arange(len(starts)) + ended, words


def _cut(raw: bytes, size: int) -> Iterator[bytes]:
    """raw in runs of about size bytes that end where a piece does."""
    while len(raw) > size:
        at = max(raw.rfind(bytes([b]), 0, size) for b in BREAKS)
        if at < 0:
            at = min((i for b in BREAKS if (i := raw.find(bytes([b]), size)) >= 0), default=len(raw) - 1)
        yield raw[: at + 1]
        raw = raw[at + 1 :]
    yield raw


def _block(number: int, texts: dict[str, list[bytes]]) -> pa.RecordBatch:
    """A block of texts by language."""
    langs, at, words, last = sorted(texts), [], [], 0
    of = []
    for i, lang in enumerate(langs):
        place, found = words_of(b"\n".join(texts[lang]))
        at.append(place + last)
        words.append(found)
        of.append(np.full(len(place), i, dtype=np.int64))
        last += int(place[-1]) + 2 if len(place) else 0
    coded = pa.chunked_array(words, pa.binary()).combine_chunks().dictionary_encode()
    shown = coded.dictionary
    keys = np.concatenate(of) * max(1, len(shown)) + coded.indices.to_numpy()
    different, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    lang = pa.array(langs, pa.string()).take(pa.array(different // max(1, len(shown))))
    word = shown.take(pa.array(different % max(1, len(shown)))).cast(pa.string())
    return _row(block=number, at=_rising(np.concatenate(at)), number=_packed(place), lang=_one(lang), word=_one(word), c=_one(pa.array(count)))


def _one(values: pa.Array) -> pa.Array:
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _blocks(docs: DataFrame) -> DataFrame:
    """Blocks of docs (lang, raw), as many for each task as its bytes need."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number, held, size = TaskContext.get().partitionId() << IN_TASK, 0, {}, 0

        def block() -> pa.RecordBatch:
            if number >> IN_TASK:
                raise ValueError(f"an input partition has more than {1 << IN_TASK} blocks of text; read it in smaller ones")
            return _block(first + number, held)

        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("raw"), strict=True):
                for run in _cut(raw.as_py(), BLOCK):
                    held.setdefault(lang, []).append(run)
                    size += len(run)
                    if size >= BLOCK:
                        yield block()
                        number, held, size = number + 1, {}, 0
        if held:
            yield block()
        give_back()

    return docs.mapInArrow(gather, "block long, at binary, number binary, lang array<string>, word array<string>, c array<long>")


def _named_pairs(blocks: DataFrame) -> DataFrame:
    """Blocks of the next level, from blocks (block, at, number) with i and id, the numbers that have a name and the names. Pairs are listed in order, as places in names."""

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                at, number = np.cumsum(_unpacked(batch.column("at")[r].as_py())), _unpacked(batch.column("number")[r].as_py())
                i, name = (batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in ("i", "id"))
                place = np.full(int(number.max()) + 1, -1, dtype=np.int64)
                place[i] = np.arange(len(i))
                own = place[number]
                has = own >= 0
                at, own = at[has], own[has]
                pair = np.flatnonzero(at[1:] == at[:-1] + 1)
                if not len(pair):
                    continue
                different, number, count = np.unique(own[pair] * len(i) + own[pair + 1], return_inverse=True, return_counts=True)
                yield _row(block=batch.column("block")[r].as_py(), at=_rising(at[pair]), number=_packed(number), names=_packed(name, "<i8"), a=_rising(different // len(i)), b=_packed(different % len(i)), c=_packed(count))
        give_back()

    return blocks.select("block", "at", "number", "i", "id").mapInArrow(rename, "block long, at binary, number binary, names binary, a binary, b binary, c binary")


def _listed_pairs(blocks: DataFrame, share: int) -> DataFrame:
    """block, i (the number in the block), a, b (names), c: a row for each different pair of each block that falls to a share of SHARES."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block, names, a, b, c = (batch.column(x)[r].as_py() for x in ("block", "names", "a", "b", "c"))
                name = _unpacked(names, "<i8")
                a, b = name[np.cumsum(_unpacked(a))], name[_unpacked(b)]
                own = np.flatnonzero(((a * 31 + b) * np.int64(0x5851F42D4C957F2D) >> 40) % SHARES == share)
                columns = [pa.array(np.full(len(own), block)), pa.array(own.astype(np.int32)), pa.array(a[own]), pa.array(b[own]), pa.array(_unpacked(c)[own].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "i", "a", "b", "c"])
        give_back()

    return blocks.select("block", "names", "a", "b", "c").mapInArrow(pairs, "block long, i int, a long, b long, c long")


def _named(listed: DataFrame, on: list[str], least: int, k: int) -> DataFrame:
    """block, i, id, f and the columns of on: the entries of lists that occur least times in all blocks together. The first entry's place, of all blocks that list a gram, is its name everywhere. Entries are dealt once; a group has a row a block at most, and its window spills."""
    whole = Window.partitionBy(*on)
    place = F.shiftleft("block", IN_LIST) + F.col("i")
    met = listed.withColumn("f", F.sum("c").over(whole)).withColumn("id", F.min(place).over(whole)).where(F.col("f") >= least)
    return written_alone(met.select("block", "i", "id", "f", *on), f"met{k}")


def _answered(blocks: DataFrame, met: DataFrame) -> DataFrame:
    """blocks with the numbers that have a name, i, and the names, id. A block's answers are no more than its list."""
    found = met.groupBy("block").agg(F.collect_list(F.struct("i", "id")).alias("x"))
    return blocks.select("block", "at", "number").join(found.select("block", F.col("x.i").alias("i"), F.col("x.id").alias("id")), "block")


def counted_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[list[DataFrame], DataFrame]:
    """The levels 1 to longest, and lang, n (words). A level has id, lang, phrase, last (its last word), f, heads and tails (counts of its first 1, 2, ... and last 1, 2, ... words), and from level 2 on its parents a (all but the last word) and b (all but the first)."""
    small_batches(docs.sparkSession)
    given = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("lang"), F.encode(F.col(f"`{text}`"), "UTF-8").alias("raw")).where("octet_length(raw) > 0")
    blocks = written_alone(_blocks(given), "blocks1", "block")
    words = blocks.select("block", F.posexplode(F.arrays_zip("lang", "word", "c")).alias("i", "x")).select("block", "i", "x.*")
    totals = written(words.groupBy("lang").agg(F.sum("c").alias("n")), "totals")
    share = F.pmod(F.xxhash64("lang", "word"), F.lit(SHARES))
    met = reduce(DataFrame.unionByName, [_named(words.where(share == i), ["lang", "word"], least, 1) for i in range(SHARES)])
    listed, blocks = blocks, written_alone(blocks.select("block", "at", "number"), "places1", "block")
    discard(listed)  # the words would lie beside the pairs
    level = met.groupBy("id", "lang", "word").agg(F.max("f").alias("f"))
    levels = [written_alone(level.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("heads"), F.array("f").alias("tails")), "level1")]
    for k in range(2, longest + 1):
        above, old = levels[-1], (blocks, met)
        blocks = written_alone(_named_pairs(_answered(blocks, met)), f"blocks{k}", "block")
        for table in old:
            discard(table)  # nothing reads it any more
        met = reduce(DataFrame.unionByName, [_named(_listed_pairs(blocks, i), ["a", "b"], least, k) for i in range(SHARES)])
        pairs = met.groupBy("id", "a", "b").agg(F.max("f").alias("f"))
        first = above.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("_phrase"), "heads")
        second = above.select(F.col("id").alias("b"), "last", "tails")
        found = pairs.join(first, "a").join(second, "b")
        levels.append(written_alone(found.select(
            "id", "lang", F.concat_ws(" ", "_phrase", "last").alias("phrase"), "last", "f",
            F.concat("heads", F.array("f")).alias("heads"), F.concat("tails", F.array("f")).alias("tails"), "a", "b",
        ), f"level{k}"))
    for table in (blocks, met):
        discard(table)
    return levels, totals


def _cuts(k: int) -> Column:
    """Of a phrase of k words: the cut of the least score, as score, cut, l and r."""
    wide = lambda c: c.cast("decimal(38,0)")
    above = wide(F.col("f")) * wide(F.lit(PER_MILLE)) * wide(F.col("n"))

    def cut(j: int) -> Column:
        left, right = F.get("heads", F.lit(j - 1)), F.get("tails", F.lit(k - j - 1))
        score = F.call_function("div", above, wide(left) * wide(right)).cast("long")
        return F.struct(score.alias("score"), F.lit(j).alias("cut"), left.alias("l"), right.alias("r"))

    return F.array_min(F.array(*(cut(j) for j in range(1, k))))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, shown: int = SHOWN, subsumed: int = 100) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score, words, cut: of each language the first `shown` phrases of two words or more by score, count and bytes. A phrase that lies in a longer one of at least `subsumed` hundredths of its count is left out."""
    levels, totals = counted_phrases(docs, text, lang, least, longest)
    out: DataFrame | None = None
    for k, level in enumerate(levels[1:], 2):
        if k < longest:
            child = levels[k]
            most = child.select(F.col("a").alias("id"), "f").unionByName(child.select(F.col("b").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("most"))
            level = level.join(most, "id", "left").where(F.col("most").isNull() | (100 * F.col("most") < subsumed * F.col("f")))
        scored = level.join(totals, "lang").withColumn("best", _cuts(k))
        scored = scored.select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "n", "best.score", F.lit(k).alias("words"), "best.cut")
        out = scored if out is None else out.unionByName(scored)
    if out is None:
        raise ValueError("a phrase has two words at least")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # in two steps, as all phrases of a language must not meet in one task
    shares = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    out = out.withColumn("_first", F.row_number().over(shares)).where(F.col("_first") <= shown).drop("_first")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    out = out.withColumn("_rank", rank).where(F.col("_rank") <= shown).withColumn("rank", F.col("_rank").cast("long"))
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "words", "cut")
