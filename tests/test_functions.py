"""Text, age and rule expressions against vectors and against plain Python."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import ages, rules
from millrace.functions import textops as X


def apply(spark, f, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", f(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


LETTERS = [" ", "\t", "\n", "\x1c", "\x1f", "\x85", "\xa0", " ", "​", "a", "É", "ß", "Σ", "ц", "1", "²", "_", "-", "😀", "́"]


@pytest.fixture(scope="module")
def strings():
    rnd = random.Random(1)
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 12))) for _ in range(400)]


def test_white_space_as_python(spark, strings):
    assert apply(spark, X.collapse, strings) == [re.sub(r"\s+", " ", s).strip() for s in strings]
    assert apply(spark, X.strip, strings) == [s.strip() for s in strings]
    assert apply(spark, X.is_blank, strings) == [not s.strip() for s in strings]
    assert apply(spark, X.is_blank, [None]) == [True] and apply(spark, X.collapse, [None]) == [None]


def test_letters_as_python(spark, strings):
    assert apply(spark, X.letters_key, strings) == ["".join(c for c in s.lower() if c.isalpha())[:120] for s in strings]
    assert apply(spark, X.has_letter, strings) == [any(c.isalpha() for c in s) for s in strings]
    assert apply(spark, X.letters_key, [None, "x" * 500]) == ["", "x" * 120]


@pytest.mark.parametrize(
    ("flat", "body"),
    [
        ("Ann Lee3h • FollowUnd los!", "Und los!"),
        ("Ann 1w • Connect+ FollowText 27 reactionsAndela said", "Text"),
        ("Ann 2d •Body 2​​2 reactions5 comments", "Body"),
        ("x 5m • Following Text here", "Text here"),
        ("x 5m • + FollowEdited • Text", "Text"),
        ("x 5m • Text" + " 1…more reaction" * 40, "Text"),
        ("Ужос", "Ужос"),
        ("x 5m • Логично!", "Логично!"),
        ("x 5m • Text … more tail hashtag#tag Show translation", "Text tail #tag"),
        ("x 5m • Text 1 reaction 1 See 1 more comment", "Text"),
        ("x 5m • 12 reactions", ""),
        ("no header. Video Player is loading. rest", "no header."),
        ("x 5m • one Close Modal Dialog two", "one"),
        (None, None),
        ("", ""),
    ],
)
def test_body(spark, flat, body):
    assert apply(spark, X.body_of, [flat]) == [body]


def test_body_is_at_its_fixpoint(spark):
    rnd = random.Random(2)
    parts = ["word ", "3 reactions", " See 2 more comments", "​", " 1,000 comments ", "End of dialog window.", "1h • ", "…more ", "x"]
    flats = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(300)]
    once = apply(spark, X.body_of, flats)
    assert apply(spark, lambda c: X.strip(F.regexp_replace(c, X.TAIL_JUNK, "")), once) == once


def test_names_and_urls(spark):
    assert apply(spark, X.norm_name, ["Ann  LEE • 2nd", " Bo • Following ", None, "Cy • 3rd+"]) == ["ann lee", "bo", "", "cy"]
    assert apply(spark, X.without_query, ["/in/a?x=1?y", "/in/a", ""]) == ["/in/a", "/in/a", ""]
    assert apply(spark, X.fold_punctuation, ["a=b&c?d"]) == ["a-bandcd"]
    assert apply(spark, lambda c: X.or_default(c, "~"), ["", None, "x"]) == ["~", "~", "x"]


def test_ages(spark):
    given = ["3h", "23h", "5m", "2w", "1d", "", None, "3x", "h", "1_0h", "5023h", "-1h", "٣h"]
    assert apply(spark, ages.age_seconds, given) == [10800, 82800, 300, 1209600, 86400, None, None, None, None, None, 5023 * 3600, None, None]
    assert apply(spark, ages.age_unit, given[:8]) == ["h", "h", "m", "w", "d", "?", "?", "x"]
    seconds = [0, 3599, 3600, 86399, 86400, 604799, 604800, 10**7, -1]
    assert apply(spark, lambda c: ages.age_of(c.cast("long")), [str(s) for s in seconds]) == ["0m", "59m", "1h", "23h", "1d", "6d", "1w", "16w", None]


def test_units(spark):
    r = spark.sql("SELECT timestamp'1970-01-01 00:00:01.5' AS t, 20500000L AS b").select(ages.epoch_ms(F.col("t")), X.megabytes(F.col("b"))).first()
    assert tuple(r) == (1500, 20.5)


def test_times(spark):
    one = spark.sql("SELECT timestamp'2024-03-01 12:00:00.5' AS a, timestamp'2024-03-01 12:00:00' AS b, cast(null AS timestamp) AS n, 'posts_2024-02-28T01-02-03Z.jsonl' AS f, 'posts_x.jsonl' AS g")
    r = one.select(
        ages.iso(F.col("a")).alias("a"), ages.iso(F.col("b")).alias("b"), ages.iso(F.col("n")).alias("n"), ages.run_stamp(F.col("b")).alias("s"), ages.stamped(F.col("f")).alias("f"), ages.stamped(F.col("g")).alias("g"),
        ages.boundary(F.col("n"), F.col("b"), 2, 6).alias("first"), ages.boundary(F.col("b"), F.col("b"), 2, 6).alias("next"), ages.posted_at(F.col("b"), F.lit("2h")).alias("p"),
    ).first()
    assert (r["a"], r["b"], r["n"], r["s"], r["g"]) == ("2024-03-01T12:00:00.500000Z", "2024-03-01T12:00:00Z", None, "2024-03-01T12-00-00Z", None)
    assert r["f"] == dt.datetime(2024, 2, 28, 1, 2, 3)
    assert (r["first"], r["next"], r["p"]) == (dt.datetime(2024, 2, 28, 6), dt.datetime(2024, 3, 1, 6), dt.datetime(2024, 3, 1, 10))


GOOD = {"author_profile_url": "https://www.linkedin.com/in/a", "author_name": "A", "text": "Hallo", "post_relative_age": "23h", "post_time_iso": "2024-03-01 00:00:00", "scraped_at": "2024-03-02 00:00:00"}
BAD = [
    ({}, None),
    ({"author_profile_url": "/in/a"}, "author_profile_url"),
    ({"author_profile_url": None, "text": ""}, "author_profile_url"),
    ({"author_name": " "}, "author_name"),
    ({"text": "Feed post number 3"}, "text"),
    ({"text": "12 — 34"}, "text"),
    ({"text": " "}, "text"),
    ({"text": "Ужос"}, None),
    ({"post_relative_age": "5023h"}, "post_relative_age"),
    ({"post_relative_age": "502h"}, "post_relative_age"),
    ({"post_relative_age": "23h\n"}, "post_relative_age"),
    ({"post_time_iso": None}, "post_time_iso"),
    ({"post_time_iso": "2024-03-02 00:00:01"}, "model"),
    ({"post_time_iso": "2024-02-01 00:00:00"}, None),
    ({"post_time_iso": "2024-01-31 23:59:59"}, "model"),
]


def test_post_rules(spark):
    rows = [tuple((GOOD | change).values()) for change, _ in BAD]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{k} string" for k in GOOD))
    for c in ("post_time_iso", "scraped_at"):
        df = df.withColumn(c, F.try_to_timestamp(c))
    got = df.select("i", rules.first_failure(rules.post_rules()).alias("r")).orderBy("i").collect()
    assert [r["r"] for r in got] == [want for _, want in BAD]


def test_message_and_envelope_rules(spark):
    df = spark.sql("""SELECT * FROM VALUES (0, 'abcde', 1L, '12', 0), (1, '1bcde', 1L, 'x', 0), (2, 'abcd', 1L, 'x', 0), (3, 'abcde', 0L, 'x', 0), (4, 'abcde', 1L, ' ', 0), (5, 'abcde', 1L, 'x', 1), (6, null, null, null, 0)
      AS t(i, channel, message_id, text, late)""").selectExpr("*", "timestamp'2024-01-01' + make_interval(0,0,0,late) AS posted_at", "timestamp'2024-01-01' AS scraped_at")
    got = df.select("i", rules.first_failure(rules.message_rules()).alias("r")).orderBy("i").collect()
    assert [r["r"] for r in got] == [None, "channel", "channel", "message_id", "text", "model", "channel"]
    posts = spark.sql("SELECT * FROM VALUES (0, 'parsed', null), (1, 'gone', null), (2, 'sent', 11), (3, 'sent', 10), (4, null, 0) AS t(i, s, feedback)").selectExpr("*", "'x' AS id", "'p' AS platform", "'t' AS text", "struct(s AS state) AS status")
    got = posts.select("i", rules.first_failure(rules.envelope_rules()).alias("r")).orderBy("i").collect()
    assert [r["r"] for r in got] == [None, "status", "feedback", None, "status"]
    keys = spark.sql("SELECT array('a', 'b') AS k")
    assert keys.select(rules.first_failure([rules.extra_keys(F.col("k"), ["a"])])).first()[0] == "extra"
    assert keys.select(rules.first_failure([rules.extra_keys(F.col("k"), ["a", "b"])])).first()[0] is None


def test_white_space_that_is_even_is_not_touched():
    """One space between words is no match, so a text of plain words is not rewritten."""
    import re

    from millrace.functions import textops

    uneven = re.compile(textops._UNEVEN.removeprefix("(?U)"))
    assert uneven.findall("a b c") == [] and [m.group() for m in uneven.finditer(" a  b\tc \x1cd　e")] == ["  ", "\t", " \x1c", "　"]
