"""Benchmark decontamination: a hash set of normalised test n-grams, against every token window of the corpus.

A window is n consecutive words of a benchmark item; an item of fewer words, but not none, is one window.
Every document position whose words may start a window passes a bitmap first, sized by the windows (four words of the
window are hashed), then joins the windows themselves on their whole text, so each hit is verified. The
windows are broadcast while they are few; a larger benchmark is joined by a shuffle.

Null and empty texts have no words, thus no hits; a document with no words is never contaminated. Repeated
rows are judged each, as are rows with equal keys; an empty benchmark hits nothing. Other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, fits, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same in a text that isn't lowered.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bits of the bitmap, as powers of two: the least, and the most (a literal of 65,536 numbers, 512 KB). It has eight bits for each window or more, up to the most; beyond that it lets more positions through to the join, which decides.
LEAST_POWER, MOST_POWER = 18, 22
#: Windows that are broadcast at most, of about 100 bytes each.
BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _bit(words: Column, i: Column, size: int, power: int = MOST_POWER) -> Column:
    """The bit of the window of size words that starts at i, in a bitmap of 2 ** power bits."""
    at = sorted({0, size // 3, 2 * size // 3, size - 1})
    return F.xxhash64(*(F.get(words, i + k) for k in at)).bitwiseAND(F.lit((1 << power) - 1)).cast("int")


def windows(benchmark: DataFrame, n: int = 13, text: str = "text", item: str = "item_id") -> DataFrame:
    """item, size, window (its words, with spaces), bit: a row for each window of each item."""

    def cut(w: Column) -> Column:
        def of(size: int) -> Column:
            starts = F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size))
            return F.transform(starts, lambda i: F.struct(F.lit(size).alias("size"), F.array_join(F.slice(w, i + 1, F.lit(size)), " ").alias("window"), _bit(w, i, size).alias("bit")))

        out = of(n)
        for size in range(1, n):
            out = F.when(F.size(w) == size, of(size)).otherwise(out)
        return out

    return benchmark.select(F.col(item).alias("item"), F.explode(_let(words_of(F.col(text)), cut)).alias("w")).select("item", "w.*")


def _power(windows: int) -> int:
    return min(MOST_POWER, max(LEAST_POWER, windows.bit_length() + 3))


def _candidates(words: Column, sizes: list[int], bitmap: Column, power: int) -> Column:
    """Positions of words that may start a window, with the words there."""

    def of(size: int) -> Column:
        def starts(i: Column) -> Column:
            bit = _bit(words, i, size, power)
            return F.getbit(F.get(bitmap, F.shiftright(bit, 6)), bit.bitwiseAND(63)) == 1

        def cut(i: Column) -> Column:
            return F.struct(i.alias("start"), F.lit(size).alias("size"), F.array_join(F.slice(words, i + 1, F.lit(size)), " ").alias("window"))

        every = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(F.filter(every, starts), cut)

    return F.concat(*map(of, sizes))


def _hits(rows: DataFrame, keys: DataFrame, sets: DataFrame) -> DataFrame:
    """_row, hit (numbers of words), items for the rows that have a hit. Only candidates meet the windows, and only hits the sets of items, so no row goes into a join with a null key."""
    at = rows.where(F.size("at") > 0).select("_row", F.explode("at").alias("at")).select("_row", "at.*")
    covered = F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)
    by_row = at.join(keys, "window").groupBy("_row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(covered)))).alias("hit"), F.collect_set("set_id").alias("set_ids"))
    of_sets = by_row.select("_row", "hit", F.explode("set_ids").alias("set_id")).join(sets, "set_id")
    return of_sets.groupBy("_row").agg(F.first("hit").alias("hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 13, percent: int = 5, text: str = "text", key: str = "doc_id", bench_text: str = "text", item: str = "item_id") -> DataFrame:
    """key, n_words, n_hit, spans (array of first word and end), items (sorted as strings), contaminated: a row for each of docs.

    A word is hit if it lies in any occurrence of a window; a document is contaminated if some word is hit
    and hit words are percent or more of all.
    """
    cut = windows(benchmark, n, bench_text, item)
    known = cut.groupBy("size", "window", "bit").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    known = known.withColumn("set_id", F.xxhash64("items"))
    known = written(known, "windows")
    power = _power(known.count())
    low = F.col("bit").bitwiseAND(F.lit((1 << power) - 1))  # the low bits of a hash make the smaller bitmap
    # at most 2 ** (power - 6) rows and n sizes come to the driver
    bits = known.groupBy(F.shiftright(low, 6).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(63))).alias("word"), F.collect_set("size").alias("sizes")).collect()
    sizes = sorted({s for r in bits for s in r["sizes"]})
    by_at = {r["at"]: r["word"] for r in bits}
    # folded to one literal array; a list of columns would cross to the JVM one by one
    bitmap = F.from_json(F.lit(json.dumps([by_at.get(i, 0) for i in range(1 << (power - 6))])), "array<bigint>")

    def found(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), _candidates(w, sizes or [n], bitmap, power).alias("at"))

    rows = docs.select(F.col(key).alias("_key"), F.monotonically_increasing_id().alias("_row"), _let(words_of(F.col(text)), found).alias("_found"))
    # the texts are read once; nearly all documents have no candidate, and go on as a few numbers
    rows = written(rows.select("_key", "_row", "_found.*"), "candidates")
    keys, sets = known.select("window", "set_id"), known.select("set_id", "items").dropDuplicates(["set_id"])
    if fits(keys, BROADCAST_ROWS):
        keys, sets = F.broadcast(keys), F.broadcast(sets)
    whole = rows.select("_key", "_row", "n_words").join(_hits(rows, keys, sets), "_row", "left")
    whole = whole.withColumn("hit", F.coalesce("hit", F.array().cast("array<int>"))).withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    n_hit = F.size("hit").cast("long")
    return whole.select(F.col("_key").alias(key), "n_words", n_hit.alias("n_hit"), _let(F.col("hit"), _spans).alias("spans"), "items").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))
    )


def _spans(hit: Column) -> Column:
    """Runs of consecutive numbers of a sorted array, as structs of start and end."""
    starts = F.filter(hit, lambda x, i: F.when(i == 0, True).otherwise(F.get(hit, i - 1) < x - 1))
    ends = F.filter(hit, lambda x, i: F.when(i == F.size(hit) - 1, True).otherwise(F.get(hit, i + 1) > x + 1))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end")))


def without_spans(docs: DataFrame, found: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with the hit words cut out of the text, for those who would remove spans rather than documents. Keys must be unique; what stands between words stays."""
    spans = found.where("n_hit > 0").select(F.col(key), "spans")
    split = F.regexp_extract_all(F.col(text), F.lit(rf"(?:{WORD_ANY_CASE}|{WORD_ANY_CASE[0] + WORD_ANY_CASE[2:]})"), F.lit(0))

    def rest(parts: Column) -> Column:
        word = lambda p: p.rlike(WORD_ANY_CASE)
        offset = F.when(word(F.get(parts, F.lit(0))), 0).otherwise(1)
        kept = F.filter(parts, lambda p, i: ~word(p) | ~F.exists("spans", lambda s: (((i - offset) / 2) >= s["start"]) & (((i - offset) / 2) < s["end"])))
        return F.array_join(kept, "")

    cut = F.when(F.col("spans").isNotNull(), _let(split, rest)).otherwise(F.col(text))
    return docs.join(spans, key, "left").withColumn(text, cut).select(*docs.columns)
