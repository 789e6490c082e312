"""N-gram Jaccard join: size-aware, heavy-light.

Documents become sets of hashed word n-grams; documents of one set are one node from then on. The number of
documents that have each n-gram is counted over the whole corpus, so n-grams are ordered rarest first.

- Small sets: every pair of small sets that links shares a subset of a size that follows from theirs; those
  subsets are enumerated, and equal subsets meet.
- Large sets: two sets that link share one of their first n-grams in the order; inverted lists of those
  are scanned. N-grams of one document make no list.

The boundary between small and large is where the subsets enumerated and the lists scanned cost least. A
parity bitmap bounds from below how much two sets differ, so most that can't link are told apart without their
sets. What is left falls into families, in which whole sets are compared; a pair that is connected already
isn't compared again, so a group of copies costs about its size, not its square. Lists and families beyond a
limit are cut into blocks that meet pairwise.

A text of fewer words than n is one n-gram; a text without words, or null, has an empty set and links to
nothing. Rows of equal keys and texts are one document (a key must not stand for different texts); a null key is its own component, null. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, small_batches, written
from .components import components
from .packs import by_shard, compress, expand, from_six, packed, six, unpack

#: Two sets link if 100 * intersection >= PERCENT * union; the derivations below hold for any percentage.
PERCENT, WORDS = 80, 5
#: Rows of a list, and of a family, that are compared in one go; larger lists name a family at once, larger families are cut into blocks.
LIMIT, FAMILY = 2048, 256
#: Bits of the parity bitmap, 64 to a word.
PARITY = 512
_SHARD_BYTES, _MIN_SHARDS, _MAX_SHARDS = 8 << 20, 24, 20_000
_M1, _M2, _ODD = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(2).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z are hashed as a-z
_GAP = np.zeros(256, dtype=bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_powers: list[np.ndarray] = []


def _mix(h: np.ndarray, m: np.uint64 = _M1) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * m
    return h ^ (h >> np.uint64(29))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number, and of its inverse, modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < n:
        odd, inverse = int(_ODD), pow(int(_ODD), -1, 1 << 64)
        _powers[:] = [np.cumprod(np.append(np.uint64(1), np.full(n, x, dtype=np.uint64))) for x in (odd, inverse)]
    return _powers[0], _powers[1]


def shingles(text: np.ndarray, sizes: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Of documents that each end in white space: hashes of every document's different n-grams, sorted, one document after the other, and how many each has."""
    none = np.zeros(0, dtype=np.uint64)
    if not len(text):
        return none, np.zeros(len(sizes), dtype=np.int64)
    gap = _GAP[text]
    start = np.flatnonzero(~gap & np.append(True, gap[:-1]))
    end = np.flatnonzero(gap & np.append(False, ~gap[:-1]))
    power, inverse = _power(len(text))
    total = np.cumsum(np.where(gap, np.uint64(0), _BYTE[text]) * power[: len(text)])
    total = np.append(np.uint64(0), total)
    word = _mix((total[end] - total[start]) * inverse[start] ^ (end - start).astype(np.uint64) * _M2)
    ends = np.cumsum(sizes)
    doc = np.searchsorted(ends, start, side="right")
    count = np.bincount(doc, minlength=len(sizes))
    factor = [np.uint64(pow(int(_M2), i + 2, 1 << 64)) for i in range(n)]
    hashes, of = [], []
    if len(word) >= n:
        h = sum((word[i : len(word) - n + 1 + i] * factor[i] for i in range(n)), np.uint64(0))
        whole = doc[: len(word) - n + 1] == doc[n - 1 :]
        hashes.append(_mix(h[whole]))
        of.append(doc[: len(word) - n + 1][whole])
    first = np.cumsum(count) - count
    for d in np.flatnonzero((count > 0) & (count < n)):
        h = np.uint64(int(count[d]))
        for i in range(int(count[d])):
            h = np.uint64((int(h) + int(word[first[d] + i]) * int(factor[i])) & 0xFFFFFFFFFFFFFFFF)
        hashes.append(_mix(np.array([h], dtype=np.uint64)))
        of.append(np.array([d]))
    if not hashes:
        return none, np.zeros(len(sizes), dtype=np.int64)
    h, d = np.concatenate(hashes), np.concatenate(of)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))
    return h[new], np.bincount(d[new], minlength=len(sizes))


def _signatures(h: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set."""
    at = np.cumsum(count) - count
    out = []
    for m in (_M2, _ODD):
        total = np.append(np.uint64(0), np.cumsum(_mix(h, m)))
        out.append((total[at + count] - total[at]).view(np.int64))
    return out[0], out[1]


def parity(tokens: np.ndarray) -> np.ndarray:
    """Of each bit, whether an odd number of tokens has it: where two differ, the sets differ."""
    odd = np.bincount((tokens >> np.uint64(50)).astype(np.int64) % PARITY, minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def shared_size(a: int, b: int, percent: int = PERCENT) -> int:
    """The least intersection of two sets of these sizes that link."""
    return -(-percent * (a + b) // (100 + percent))


def partner_sizes(n: int, percent: int = PERCENT) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """So many of a set's first n-grams: one is shared with any set that links."""
    return n - -(-percent * n // 100) + 1


def subset_count(n: int, shared: int, percent: int = PERCENT) -> int:
    """How many subsets() gives for a set of n n-grams, of which so many are in other documents."""
    return sum(math.comb(shared, t) for t in {shared_size(n, m, percent) for m in partner_sizes(n, percent)} if 0 < t <= min(n, shared))


def largest_boundary(percent: int = PERCENT, limit: int = LIMIT) -> int:
    """The size from which on enumeration costs more than any lists can: a list costs a row of it for each other, limit at most, as longer lists aren't compared."""
    n = 1
    while subset_count(n, n, percent) <= prefix_size(n, percent) * limit:
        n += 1
    return n


def subsets(tokens: np.ndarray, n: int, percent: int = PERCENT) -> np.ndarray:
    """Hashes of the subsets of tokens that a set of n n-grams (the others being in no other document) may share with a set that links."""
    out = []
    for t in sorted({shared_size(n, m, percent) for m in partner_sizes(n, percent)}):
        if 0 < t <= min(n, len(tokens)):
            out += [sum(c) % (1 << 64) * 2 + t for c in itertools.combinations([int(x) >> 1 for x in tokens], t)]
    return _mix(np.array([x % (1 << 64) for x in out], dtype=np.uint64), _M2)


class _Family:
    """Rows compared with each other, in the order of their sizes: edges join what isn't joined yet."""

    def __init__(self, nodes: np.ndarray, sizes: np.ndarray, bits: np.ndarray, sets: list[np.ndarray] | None, percent: int, side: np.ndarray | None = None):
        order = np.lexsort((nodes, sizes))
        self.nodes, self.sizes, self.bits, self.percent = nodes[order], sizes[order], bits[order], percent
        self.sets = [sets[i] for i in order] if sets is not None else None
        self.side = side[order] if side is not None else None

    def linked(self, i: int, j: int) -> bool:
        if self.sets is None:
            return True
        a, b = self.sets[i], self.sets[j]
        if len(a) > len(b):
            a, b = b, a
        k = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
        return 100 * k >= self.percent * (len(a) + len(b) - k)

    def edges(self) -> Iterator[tuple[int, int]]:
        label = np.arange(len(self.nodes))
        for i in range(1, len(self.nodes)):
            n = int(self.sizes[i])
            low = int(np.searchsorted(self.sizes[:i], -(-self.percent * n // 100)))
            if low >= i:
                continue
            differ = np.bitwise_count(self.bits[low:i] ^ self.bits[i]).sum(axis=1, dtype=np.int64)
            # linked sets of a and b n-grams differ in (100 - percent) / (100 + percent) * (a + b) at most
            near = np.flatnonzero(differ * (100 + self.percent) <= (100 - self.percent) * (n + self.sizes[low:i])) + low
            if self.side is not None:
                near = near[self.side[near] != self.side[i]]
            near = near[label[near] != label[i]]
            while len(near):
                j, near = near[0], near[1:]
                if self.linked(i, j):
                    yield int(self.nodes[i]), int(self.nodes[j])
                    label[label == label[i]] = label[j]
                    near = near[label[near] != label[i]]


def _runs(parts: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Rows of equal values of by, which stand together, as one frame."""
    held: list[pd.DataFrame] = []
    for part in parts:
        if not len(part):
            continue
        key = part[by]
        new = (key != key.shift()).any(axis=1).to_numpy()
        new[0] = bool(held) and tuple(held[-1][by].iloc[-1]) != tuple(key.iloc[0])
        cut = [0, *np.flatnonzero(new).tolist(), len(part)]
        if new[0]:
            cut = cut[1:]
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        for a, b in itertools.pairwise(cut):
            held.append(part.iloc[a:b])
            if b < len(part):
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _compare(percent: int, by: list[str], whole: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: set[tuple[int, int]] = set()
        give_back()
        for run in _runs(parts, by):
            if len(run) > 1:
                sets = [np.frombuffer(x, np.uint64) for x in run["tokens"]] if whole else None
                side = run["side"].to_numpy() if "side" in run and (run["side"] != 0).any() else None
                bits = np.frombuffer(b"".join(run["bits"]), np.uint64).reshape(len(run), -1)
                found.update(_Family(run["node"].to_numpy(), run["n"].to_numpy(), bits, sets, percent, side).edges())
            if len(found) > 50_000:
                yield pd.DataFrame(list(found), columns=["a", "b"])
                found = set()
        if found:
            yield pd.DataFrame(list(found), columns=["a", "b"])

    return compare


def _parts(own: pd.DataFrame, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each pack of a part: keys, n-grams, and how many each document has."""
    for pack in own.sort_values("seq")["pack"]:
        keys, sizes, text = unpack(pack)
        yield keys, *shingles(text, sizes, n)


def _counts(own: pd.DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A part's n-grams (48 bits of the hash), sorted, and how many different sets have each."""
    every, known = [], set()
    for _, h, count in _parts(own, n):
        s1, s2 = _signatures(h, count)
        use = np.zeros(len(count), dtype=bool)
        for i, sign in enumerate(zip(s1.tolist(), s2.tolist(), strict=True)):
            if count[i] and sign not in known:
                known.add(sign)
                use[i] = True
        every.append(h[np.repeat(use, count)] >> np.uint64(16))
    h = np.concatenate(every) if every else np.zeros(0, dtype=np.uint64)
    every.clear()
    h.sort()  # in place: np.unique would hold another copy
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.append(first, len(h)))
    return h[first], count


def _edges_of(lists: DataFrame, percent: int, limit: int) -> DataFrame:
    """Edges of pairs of a list that may link; in a list beyond the limit every row meets the least, which is right too, as families are compared whole."""
    size = lists.groupBy("list").agg(F.count("*").alias("rows"), F.min("node").alias("least"))
    size = size.where("rows > 1")
    heavy, light = size.where(F.col("rows") > limit), size.where(F.col("rows") <= limit).select("list")
    star = lists.join(heavy.select("list", "least"), "list").select(F.col("node").alias("a"), F.col("least").alias("b"))
    short = lists.join(light, "list").repartition("list").sortWithinPartitions("list")
    return short.mapInPandas(_compare(percent, ["list"], False), "a long, b long").unionByName(star).where("a <> b").distinct()


def _compare_families(sets: DataFrame, percent: int, limit: int) -> DataFrame:
    """Edges of sets (node, n, bits, tokens, family) that link and connect all that links within a family."""
    size = sets.groupBy("family").agg(F.count("*").alias("rows"))
    size = written(size, "families")
    small = sets.join(size.where(F.col("rows") <= limit).select("family"), "family").repartition("family").sortWithinPartitions("family")
    edges = small.mapInPandas(_compare(percent, ["family"], True), "a long, b long")
    large = size.where(F.col("rows") > limit)
    if large.limit(1).count() == 0:
        return edges
    # every row of a large family meets eight of its rows first
    big = sets.join(large.select("family"), "family")
    hubs = big.groupBy("family").agg(*(F.min(F.struct(F.xxhash64("node", F.lit(i)), "node")).alias(f"h{i}") for i in range(8)))
    hubs = hubs.select("family", F.explode(F.array_distinct(F.array(*(F.col(f"h{i}.node") for i in range(8))))).alias("hub"))
    hubs = hubs.join(sets.select(F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("tokens").alias("hub_tokens")), "hub")
    met = big.join(hubs, "family").where("node <> hub").where(F.col("n") * 100 >= F.col("hub_n") * percent).where(F.col("hub_n") * 100 >= F.col("n") * percent)

    def meet(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            keep = []
            for r in part.itertuples():
                a, b = np.frombuffer(r.tokens, np.uint64), np.frombuffer(r.hub_tokens, np.uint64)
                k = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * k >= percent * (len(a) + len(b) - k))
            yield pd.DataFrame({"a": part["node"][keep], "b": part["hub"][keep]})

    near = written(met.select("node", "tokens", "hub", "hub_tokens").mapInPandas(meet, "a long, b long"), "hubs")
    # blocks: a component of the first meeting that is large gets blocks of its own, which needn't meet each other
    comp = components(near)
    big = big.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    many = big.groupBy("family", "comp").agg(F.count("*").alias("of_comp"))
    half = max(1, limit // 2)
    big = big.join(many, ["family", "comp"]).join(large.select("family", F.col("rows").alias("of_family")), "family")
    pure = F.col("of_comp") > half
    deal = F.when(pure, F.col("of_comp")).otherwise(F.col("of_family"))
    block = F.pmod(F.xxhash64("node", F.lit(7)), F.ceil(deal / half).cast("long"))
    big = written(big.select("family", "node", "n", "bits", "tokens", F.when(pure, F.col("comp")).otherwise(-1).alias("own"), block.alias("block")), "large")
    blocks = big.select("family", "own", "block").distinct()
    other = blocks.select("family", F.col("own").alias("own2"), F.col("block").alias("block2"))
    units = blocks.join(other, "family").where("own < own2 OR own = own2 AND own = -1 AND block <= block2")
    units = written(units.select("family", "own", "block", "own2", "block2", F.monotonically_increasing_id().alias("unit")), "units")
    first = big.join(units, ["family", "own", "block"]).select("unit", "node", "n", "bits", "tokens", F.when((F.col("own") == F.col("own2")) & (F.col("block") == F.col("block2")), 0).otherwise(1).alias("side"))
    renamed = units.select("family", F.col("own2").alias("own"), F.col("block2").alias("block"), "unit", F.col("own").alias("o"), F.col("block").alias("b")).where("own <> o OR block <> b")
    second = big.join(renamed, ["family", "own", "block"]).select("unit", "node", "n", "bits", "tokens", F.lit(2).alias("side"))
    rest = first.unionByName(second).repartition("unit").sortWithinPartitions("unit").mapInPandas(_compare(percent, ["unit"], True), "a long, b long")
    return edges.unionByName(near.select("a", "b")).unionByName(rest)


def join_similar(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", key: str = "doc_id", limit: int = LIMIT, family: int = FAMILY, boundary: int | None = None) -> DataFrame:
    """key, n_shingles, component_id (the least key that is reachable by links, the row's own included): a row for each of docs. The boundary between small and large sets is chosen by cost if it isn't given."""
    spark = docs.sparkSession
    small_batches(spark)
    top = largest_boundary(percent, limit) if boundary is None else boundary
    given = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = given.where("key is not null").select("key", F.concat(F.col("text"), F.lit("\n")).cast("binary").alias("text"))

    def meta(keys: list[int], texts: list[bytes]) -> bytes:
        h, count = shingles(np.frombuffer(b"".join(texts), np.uint8), np.array(list(map(len, texts))), words)
        return compress(np.concatenate((np.array(keys, dtype=np.int64), count.astype(np.int64), *_signatures(h, count))))

    with packed(rows, meta) as (packs, buckets):
        total = packs.agg(F.sum("size")).first()[0] or 0
        shards = int(min(_MAX_SHARDS, max(_MIN_SHARDS, total // _SHARD_BYTES)))

        def unfold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                for p, x in zip(part["part"], part["more"], strict=True):
                    k, n, s1, s2 = expand(x, np.int64).reshape(4, -1)
                    yield pd.DataFrame({"part": np.full(len(k), p), "key": k, "n": n, "s1": s1, "s2": s2})

        every = written(packs.select("part", "more").mapInPandas(unfold, "part long, key long, n long, s1 long, s2 long"), "sets")
        nodes = written(every.where("n > 0").groupBy("s1", "s2", "n").agg(F.min(F.struct("key", "part")).alias("first")).select("s1", "s2", "n", F.col("first.key").alias("node"), "first.part"), "nodes")

        def send(own: pd.DataFrame) -> pd.DataFrame:
            give_back()
            h, count = _counts(own, words)
            part, count = int(own["part"].iloc[0]), np.minimum(count, 255).astype(np.uint8)
            return pd.DataFrame([(s, part, six(h[at]), compress(count[at])) for s, at in by_shard(h, shards)], columns=["shard", "part", "hashes", "counts"])

        def answer(sent: pd.DataFrame) -> pd.DataFrame:
            give_back()
            sent = sent.sort_values("part")
            lists = [from_six(x) for x in sent["hashes"]]
            h = np.concatenate(lists)
            count = np.concatenate([expand(x, np.uint8) for x in sent["counts"]]).astype(np.int64)
            order = np.argsort(h, kind="stable")
            first = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1]))
            level = np.empty(len(h), dtype=np.uint8)
            # 0: one set has it; then by powers of two
            level[order] = np.repeat(np.ceil(np.log2(np.add.reduceat(count[order], first))).astype(np.uint8), np.diff(np.append(first, len(h))))
            cut = np.cumsum([0, *map(len, lists)])
            out = [(int(p), int(sent["shard"].iloc[0]), compress(level[a:b])) for p, a, b in zip(sent["part"], cut[:-1], cut[1:], strict=True) if level[a:b].any()]
            return pd.DataFrame(out, columns=["part", "shard", "levels"])

        sent = packs.groupBy("part").applyInPandas(send, "shard int, part long, hashes binary, counts binary")
        levels = sent.repartition(shards, "shard").groupBy("shard").applyInPandas(answer, "part long, shard int, levels binary")
        answers = levels.withColumn("own", F.lit(None).cast("array<long>")).unionByName(
            nodes.groupBy("part").agg(F.collect_list("node").alias("own")).select("part", F.lit(-1).alias("shard"), F.lit(None).cast("binary").alias("levels"), "own")
        )

        def take(own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
            give_back()
            out = []
            mine = {int(k) for x in got["own"] if x is not None for k in x}
            level_of = {int(s): x for s, x in zip(got["shard"], got["levels"], strict=True) if x is not None}
            if mine and level_of and len(own):
                h, _ = _counts(own, words)
                give_back()
                level = np.zeros(len(h), dtype=np.uint8)
                for s, at in by_shard(h, shards):
                    if s in level_of:
                        level[at] = expand(level_of[s], np.uint8)
                for keys, tokens, count in _parts(own, words):
                    at = np.cumsum(count) - count
                    of = level[np.searchsorted(h, tokens >> np.uint64(16))] if len(tokens) else level[:0]
                    for k, a, n in zip(keys.tolist(), at.tolist(), count.tolist(), strict=True):
                        if not n or k not in mine:
                            continue
                        mine.discard(k)
                        t, l = tokens[a : a + n], of[a : a + n]
                        rare = np.lexsort((t, l))[: prefix_size(n, percent)]
                        rare = rare[l[rare] > 0]
                        shared = l > 0
                        cost = subset_count(n, int(shared.sum()), percent) if n < top else 0
                        if len(rare) or cost:  # else it is in no list
                            level_of_rare = np.left_shift(1, np.minimum(l[rare], 40).astype(np.int64))
                            out.append((k, n, t.tobytes(), parity(t).tobytes(), t[rare].view(np.int64).tolist(), np.packbits(shared).tobytes(), cost, int(np.minimum(level_of_rare, limit).sum())))
            return pd.DataFrame(out, columns=["node", "n", "tokens", "bits", "prefix", "shared", "subsets", "scan"])

        taken = packs.groupBy("part").cogroup(answers.repartition(buckets, "part").groupBy("part"))
        sets = written(taken.applyInPandas(take, "node long, n long, tokens binary, bits binary, prefix array<long>, shared binary, subsets long, scan long"), "candidates")

    # the boundary: sets below it are enumerated; lists are scanned for the others, and for those below that may link to them
    listed = lambda x: -(-percent * x // 100)
    if boundary is None:
        cost = {r["n"]: (r["s"], r["t"]) for r in sets.where(F.col("n") <= top).groupBy("n").agg(F.sum("subsets").alias("s"), F.sum("scan").alias("t")).collect()}  # a row for each size up to top
        boundary = min(range(1, top + 1), key=lambda x: (sum(s for n, (s, _) in cost.items() if n < x) + sum(t for n, (_, t) in cost.items() if n >= listed(x)), x))

    def enumerate_subsets(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            held, lists, rows = [], [], 0
            for i, (tokens, shared, n) in enumerate(zip(part["tokens"], part["shared"], part["n"], strict=True)):
                t = np.frombuffer(tokens, np.uint64)
                lists.append(subsets(t[np.unpackbits(np.frombuffer(shared, np.uint8), count=len(t)).astype(bool)], int(n), percent).view(np.int64))
                held.append(np.full(len(lists[-1]), i))
                rows += len(lists[-1])
                if rows > 50_000 or i == len(part) - 1:
                    yield part.iloc[np.concatenate(held)][["node", "n", "bits"]].assign(list=np.concatenate(lists))
                    held, lists, rows = [], [], 0

    small = sets.where(F.col("n") < boundary).select("node", "n", "bits", "tokens", "shared").mapInPandas(enumerate_subsets, "node long, n long, bits binary, list long")
    lists = small.unionByName(sets.where(F.col("n") >= listed(boundary)).select("node", "n", "bits", F.explode("prefix").alias("list")))
    families = components(_edges_of(lists, percent, limit))
    members = sets.select("node", "n", "bits", "tokens").join(families.withColumnRenamed("comp", "family"), "node")
    linked = components(_compare_families(members, percent, family))
    found = nodes.join(linked, "node", "left").select("s1", "s2", F.col("n").alias("size"), F.coalesce("comp", "node").alias("comp"))
    own = every.where("n > 0")
    comps = own.join(found, (own["s1"] == found["s1"]) & (own["s2"] == found["s2"]) & (own["n"] == found["size"])).select("key", "n", F.col("comp"))
    empty = every.where("n = 0").select("key", "n", F.col("key").alias("comp"))
    unkeyed = given.where("key is null").select("key", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("comp"))
    out = comps.unionByName(empty).unionByName(unkeyed)
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"))


def keep_one(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """docs without those that a smaller key's component already has: one document of each component stays, its least key."""
    stay = found.where(F.col("component_id").isNull() | (F.col(key) == F.col("component_id"))).select(F.col(key).alias("_stay")).distinct()
    return docs.join(stay, docs[key].eqNullSafe(stay["_stay"]), "left_semi")
