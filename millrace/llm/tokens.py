"""Token counts by heap-and-linked-list byte-pair merging.

Each piece of text starts as a linked list of its bytes. A heap holds the rank of every adjacent pair;
the lowest rank is popped, its two symbols become one, and the two new neighbour pairs are pushed. The
count is the initial symbols minus the merges, so no token identifier is ever looked up or emitted.

Nulls and empty texts have 0 tokens. A special string in a text is one token. Repeated rows are counted
each; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from heapq import heapify, heappop, heappush
from itertools import pairwise

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Splits a text into the pieces that merges don't cross (a fixed value of the vocabulary's format).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Counts kept per worker, and the longest string that is kept.
CACHE_ROWS, CACHE_CHARS = 600_000, 40
_SLOW = 1 << 50


def _byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary writes for each byte: printable bytes stand for themselves, the rest follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256))
    return [chr(b) if b in plain else chr(256 + next(rest)) for b in range(256)]


def unsupported(vocabulary: dict) -> list[str]:
    """What a vocabulary file asks for that isn't built here; counts would be wrong without a word."""
    model, split = vocabulary.get("model") or {}, vocabulary.get("pre_tokenizer") or {}
    out = [f"model {model.get('type')}"] if model.get("type", "BPE") != "BPE" else []
    out += [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        out.append("pre_tokenizer")
    if vocabulary.get("normalizer"):
        out.append("normalizer")
    out += [f"added token {x['content']!r}" for x in vocabulary.get("added_tokens") or [] if x.get("single_word") or x.get("lstrip") or x.get("rstrip")]
    return out


class MergeCounter:
    """Counts the tokens of texts under one vocabulary."""

    def __init__(self, vocabulary: dict):
        import regex

        if faults := unsupported(vocabulary):
            raise ValueError(f"this vocabulary isn't counted by byte-pair merging alone: {', '.join(faults)}")
        symbols = {x: i for i, x in enumerate(_byte_letters())}  # a byte's symbol is its number
        #: By left symbol, then right symbol: the rank of their merge. By rank: the symbol that it makes.
        self.rank: list[dict[int, int]] = [{} for _ in symbols]
        self.made: list[int] = []
        for rank, pair in enumerate(vocabulary["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            if (new := symbols.setdefault(a + b, len(symbols))) == len(self.rank):
                self.rank.append({})
            self.rank[symbols[a]].setdefault(symbols[b], rank)
            self.made.append(new)
        self.special = sorted((x["content"] for x in vocabulary.get("added_tokens") or []), key=len, reverse=True)
        self.pieces = regex.compile(PIECES)
        self.by_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.of_piece: dict[str, int] = {}
        self.of_word: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        """Symbols left of one piece after all merges."""
        at: list[int] = list(piece.encode())
        left = n = len(at)
        if n < 2:
            return n
        rank, made = self.rank, self.made
        # a heap entry is rank and position in one number; it is void once the pair at its position has another rank
        bits = 6 if n <= 64 else 40
        heap = [rank[a][b] << bits | i for i, (a, b) in enumerate(pairwise(at)) if b in rank[a]]
        if not heap:
            return n
        heapify(heap)
        after, before, low = list(range(1, n + 1)), list(range(-1, n - 1)), (1 << bits) - 1
        while heap:
            top = heappop(heap)
            i = top & low
            j = after[i]
            if j >= n or at[i] < 0:
                continue
            r = top >> bits
            if rank[at[i]].get(at[j]) != r:
                continue
            at[i] = new = made[r]
            at[j] = -1
            left -= 1
            after[i] = k = after[j]
            ranks = rank[new]
            if k < n:
                before[k] = i
                if at[k] in ranks:
                    heappush(heap, ranks[at[k]] << bits | i)
            h = before[i]
            if h >= 0 and new in rank[at[h]]:
                heappush(heap, rank[at[h]][new] << bits | h)
        return left

    def _piece(self, piece: str) -> int:
        n = self.of_piece.get(piece)
        if n is None:
            n = self.merged(piece)
            if len(piece) <= CACHE_CHARS:
                if len(self.of_piece) >= CACHE_ROWS:
                    self.of_piece.clear()
                self.of_piece[piece] = n
        return n

    def _slowly(self, text: str) -> int:
        return sum(map(self._piece, self.pieces.findall(text)))

    def _plain(self, text: str) -> int:
        """A piece always starts at a space whose neighbours aren't both white space, so texts are counted word by word; where a word could hide such a space, the whole text is split at once."""
        head, *words = text.split(" ")
        total, known = (_SLOW if not head or head[-1].isspace() else 0), self.of_word
        for word in words:
            n = known.get(word)
            if n is None:
                n = self._slowly(" " + word)
                if not word or word[-1].isspace():
                    n += _SLOW
                if len(word) <= CACHE_CHARS:
                    if len(known) >= CACHE_ROWS:
                        known.clear()
                    known[word] = n
            total += n
        return total + self._slowly(head) if total < _SLOW else self._slowly(text)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.by_special is None or not any(s in text for s in self.special):
            return self._plain(text)
        parts = self.by_special.split(text)
        return len(parts) - 1 + sum(self._plain(x) for x in parts if x)


_counters: dict[str, MergeCounter] = {}


def counter(name: str, vocabulary: Callable[[], str]) -> MergeCounter:
    """One counter per worker process and vocabulary."""
    if name not in _counters:
        _counters[name] = MergeCounter(json.loads(vocabulary()))
    return _counters[name]


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = 512, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_bytes, n_tokens, over_limit for every row of docs. The vocabulary file (about 1.5 MB, read on the driver) is broadcast."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary_path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        c = counter(vocabulary_path, lambda: sent.value)
        return pd.Series([c.count(x) for x in texts], dtype="int64")

    return docs.select(
        F.col(key), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), n_tokens(F.col(text)).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
