"""Collocations against plain Python and DuckDB."""

import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest

from millrace.llm import phrases, queries
from millrace.sources.shared import _own

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, phrase string, a string, n string"


def brute(docs, least, longest, shown, subsumed=100):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        inside = Counter()
        for q, c in candidates.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    inside[q[i : i + k]] = max(inside[q[i : i + k]], c)
        rows = []
        for p, a in candidates.items():
            if p in inside and 100 * inside[p] >= subsumed * a:
                continue
            score, cut = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((lang, " ".join(p), a, counts[p[:cut]], counts[p[cut:]], n[lang], score, len(p), cut))
        rows.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i, *r[1:]) for i, r in enumerate(rows[:shown], 1)]
    return sorted(out)


def found(df, least, longest, shown, subsumed=100):
    return sorted(tuple(r) for r in phrases.collocations(df, least=least, longest=longest, shown=shown, subsumed=subsumed).collect())


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    words = ["new", "York", "CITY", "the", "of", "é", "É", " ", "a-b", "x\x00y", "ß", "𝒳", "to be", "or not\tto be"]
    out = [("".join(rnd.choice(words) + rnd.choice([" ", " ", "\t ", ", ", ".", "\n", "  "]) for _ in range(rnd.randint(0, 60))), rnd.choice(["en", "en", "de", None, "und", ""])) for _ in range(150)]
    out += [(None, "en"), ("", "en"), (" \t", None), (".,;:!?\n\x0b\x0c\r", "en"), ("one", "fr"), ("x " * 3000, "en"), ("p q r " * 400 + "." + "q r s " * 900, "de")]
    return out + [("copy of copy of copy", "en")] * 40


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i % 50, t, l, "x", "y", "z") for i, (t, l) in enumerate(texts)], SCHEMA).repartition(3)


@pytest.mark.parametrize(("least", "longest", "shown", "subsumed"), [(3, 5, 2000, 100), (2, 3, 10, 80), (20, 5, 7, 100), (1, 4, 5000, 100), (5, 2, 50, 100), (10**6, 5, 10, 100)])
def test_against_brute_force(docs, texts, least, longest, shown, subsumed):
    assert found(docs, least, longest, shown, subsumed) == brute(texts, least, longest, shown, subsumed)


def test_blocks_of_any_size(docs, texts, monkeypatch):
    """Texts longer than a block are cut where a piece ends; a piece longer than a block stays whole."""
    monkeypatch.setattr(phrases, "BLOCK", 64)
    assert b"".join(phrases._cut(b"ab cd. ef, gh" * 9, 20)) == b"ab cd. ef, gh" * 9
    assert [*phrases._cut(b"a" * 50 + b".b", 20)] == [b"a" * 50 + b".", b"b"]
    assert found(docs, 3, 5, 2000) == brute(texts, 3, 5, 2000)


def test_words_leave_the_disks(spark, docs, monkeypatch):
    """Words are dealt in shares, as pairs are, and their lists are gone when pairs are listed."""
    named, answered, shares, left = phrases._named, phrases._answered, [], []

    def in_shares(listed, on, least, k):
        if k == 1:
            shares.append({tuple(r) for r in listed.select("lang", "word").distinct().collect()})
        return named(listed, on, least, k)

    def after(blocks, met):
        left.append([*Path(_own(spark).removeprefix("file:")).rglob("blocks1/*.parquet")])
        return answered(blocks, met)

    monkeypatch.setattr(phrases, "_named", in_shares)
    monkeypatch.setattr(phrases, "_answered", after)
    phrases.counted_phrases(docs, least=3, longest=2)
    assert left == [[]]
    assert len(shares) == phrases.SHARES and all(shares) and len(set.union(*shares)) == sum(map(len, shares))


def test_numbers_beyond_64_bits(spark):
    """1000 * a * n and l * r as exact whole numbers."""
    from pyspark.sql import functions as F

    big = 3_000_000_000_007
    row = spark.range(1).select(F.lit(big).alias("f"), F.lit(9 * big + 1).alias("n"), F.array(F.lit(2 * big + 1), F.lit(big)).alias("heads"), F.array(F.lit(big + 3), F.lit(big)).alias("tails"))
    assert row.select(phrases._cuts(2).alias("x")).first().x.score == 1000 * big * (9 * big + 1) // ((2 * big + 1) * (big + 3))


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None, "", "", "")], SCHEMA), least=1).count() == 0
    with pytest.raises(ValueError):
        phrases.collocations(none, longest=1)


def test_query_against_brute_force_and_sql(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("text", "lang")
    want = brute([tuple(r) for r in docs.collect()], 100, 5, 2000)
    got = sorted(tuple(r) for r in queries.op13_collocations(spark, DATA).collect())
    assert got == [r[:8] for r in want] and len(got) > 10
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{Path(DATA) / 'documents.parquet'}'")
    sql = con.sql(queries.ORACLE["op13_collocations"])
    assert sorted(zip(*(sql.df()[c].tolist() for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")), strict=True)) == got
