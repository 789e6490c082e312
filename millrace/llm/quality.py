"""Quality rules, line first: rules judge each line, failing lines go, and a text that loses too much is rejected.

All of it is column expressions. A null text has no words and fails the base rule, as an empty one does.
Ties and repeated rows don't matter, every row is judged by its own text; other columns are ignored.

Line rules (a line without a word is neither kept nor counted):
- repeated: it equals an earlier line of the text;
- navigation: three or more lone separators that make up a fifth of its words, or a menu word alone;
- boilerplate: a phrase by which sites ask for consent, claim rights with a year, name a licence, or ask to subscribe or share, in a short line;
- symbols: more than a tenth of its characters are of `[#*$%&|<>]`;
- shouting: ten or more letters, more than 7 of 10 upper-case;
- repetitive: ten or more words, fewer than 3 of 10 different;
- punctuation: eight or more words without any mark that ends or joins sentences.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE

SYMBOLS = "#*$%&|<>"
#: What menus and notices say, in the languages of the corpus.
LONE = ("|", "/", ">", "·", "•", "»", "›", "::", "--")
SEPARATORS = r"(?:^|[\x20\x09-\x0D])(?:[|/>·•»›]|::|--)(?:$|[\x20\x09-\x0D])"
MENU = r"(?i)^[\x20\x09-\x0D]*(?:home|menu|login|log in|sign in|sign up|register|search|next|previous|back to top|skip to content|share|print|startseite|anmelden|suche|weiter|zurück|accueil|connexion|rechercher|suivant|précédent|inicio|iniciar sesión|buscar|siguiente|anterior)[\x20\x09-\x0D]*$"
#: What a notice says, by a part that each of its forms has, in lowered text. A topic alone ("a cookie recipe") is no notice.
NOTICES = {
    "cookie": "(?:we|site|website|page) uses? cookies|use of cookies|(?:accept|allow|enable|manage|consent to|reject) (?:all |our |the use of |necessary )?cookies|cookie (?:policy|settings|preferences|consent|notice)|cookies akzeptieren|accepter (?:les |tous les )?cookies|aceptar (?:las |todas las )?cookies",
    "all rights reserved": "all rights reserved",
    "copyright": "copyright(?: [(]c[)])?[^a-z]{0,8}(?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}[^a-z]{0,4}copyright",
    "©": "©[^\\n]{0,60}(?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}[^a-z]{0,4}©",
    "under": "(?:licensed|released|published|distributed|available) under (?:the |a |an )?(?:terms of the )?(?:mit|apache|gnu|gpl|lgpl|agpl|bsd|mozilla|eclipse|creative commons|cc)[ -]",
    "this work is licensed": "this work is licensed",
    "privacy policy": "(?:our|this) privacy policy|^[^a-z]*privacy policy[^a-z]*$|privacy policy (?:[|]|·|and terms|& terms)",
    "terms of": "(?:our|these|agree to the|accept the) terms of (?:use|service)|^[^a-z]*terms of (?:use|service)[^a-z]*$",
    "javascript": "(?:please|must|need to) enable javascript|enable javascript (?:to|in)|javascript is (?:disabled|required)",
    "subscribe to": "subscribe to (?:our|my|this) |subscribe to the (?:newsletter|channel|blog|feed|podcast)",
    "newsletter": "(?:sign up|register) (?:for|to)[^.!?]{0,30}newsletter|newsletter abonnieren|notre newsletter|nuestra newsletter",
    "share this": "share this (?:article|post|page|story|with|on|via)",
    "alle rechte vorbehalten": "alle rechte vorbehalten",
    "datenschutz": "datenschutz(?:erklärung|hinweis|richtlinie|bestimmung)",
    "tous droits réservés": "tous droits réservés",
    "mentions légales": "mentions légales",
    "todos los derechos reservados": "todos los derechos reservados",
    "política de privacidad": "(?:nuestra|esta) política de privacidad|^[^a-z]*política de privacidad[^a-z]*$",
}
NOTICE = "|".join(NOTICES.values())
#: Words of the longest line that counts as a notice, and of the longest that MENU can match.
NOTICE_WORDS, MENU_WORDS = 30, 3
BLANKS = " \t\n\x0b\f\r"


def split_words(line: Column) -> Column:
    """The words of a text that has one."""
    return F.split(F.btrim(line, F.lit(BLANKS)), rf"[{SPACE}]+")


def _chars(text: Column) -> Column:
    """Code points that aren't white space."""
    return F.length(text) - F.regexp_count(text, F.lit(rf"[{SPACE}]"))


def _symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{SYMBOLS}]"))


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def with_repeated_words(rows: DataFrame, words: str, name: str, n: int = 3) -> DataFrame:
    """rows with name: how many of the column words lie in a window of n that occurs twice or more.

    A window's key is its hash with its place in the low bits, so a sort of the keys brings equal windows together;
    neighbours of one hash count only if their words are equal too. Each step is a column of its own, as a sort
    of numbers within generated code is many times faster than one in a lambda."""
    w, kept = F.col(words), rows.columns
    size = F.greatest(F.size(w) - (n - 1), F.lit(0))
    places = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.size(w).cast("long")))) - 1
    rows = rows.select(*kept, F.arrays_zip(*(F.slice(w, k + 1, size).alias(f"w{k}") for k in range(n))).alias("_windows"), F.coalesce(places, F.lit(0)).alias("_places"))
    rows = rows.select("*", F.bitwise_not("_places").bitwiseAND(F.lit((1 << 63) - 1)).alias("_high"))
    keys = F.transform("_windows", lambda x, i: F.xxhash64(x).bitwiseAND(F.col("_high")).bitwiseOR(i.cast("long")))
    rows = rows.select(*kept, "_places", F.sort_array(keys).alias("_keys"))
    last = F.greatest(F.size("_keys") - 1, F.lit(0))
    place = lambda x: x.bitwiseAND(F.col("_places"))

    def equal(x: Column) -> Column:
        i, j = place(x["a"]).cast("int"), place(x["b"]).cast("int")
        return reduce(lambda p, q: p & q, (w[i + k] == w[j + k] for k in range(n)), x["a"].bitwiseXOR(x["b"]) <= F.col("_places"))

    pairs = F.filter(F.arrays_zip(F.slice("_keys", 1, last).alias("a"), F.slice("_keys", 2, last).alias("b")), equal)
    rows = rows.select(*kept, "_places", pairs.alias("_pairs"))
    starts = F.concat(F.transform("_pairs", lambda x: place(x["a"])), F.transform("_pairs", lambda x: place(x["b"])))
    rows = rows.select(*kept, F.array_distinct(starts).alias("_starts"))
    covered = F.concat(*(F.transform("_starts", lambda x: x + k) for k in range(n)))  # noqa: B023
    return rows.select(*kept, F.size(F.array_distinct(covered)).cast("long").alias(name))


def line_fails(line: Column, words: Column | None = None) -> Column:
    """Whether a line with a word (its words too, where they are known) fails a rule; repeated lines are found elsewhere. A cheap test stands before each costly one that it implies."""
    words = split_words(line) if words is None else words
    n = F.size(words)
    upper, letters = (F.length(F.regexp_replace(line, rf"\P{{{kind}}}+", "")) for kind in ("Lu", "L"))
    marks = F.regexp_count(line, F.lit(SEPARATORS))
    low = F.lower(line)
    return (
        ((n <= MENU_WORDS) & line.rlike(MENU))
        | ((n >= 8) & ~line.rlike(r"[.!?…:;。！？]"))
        | ((n >= 10) & (10 * F.size(F.array_distinct(words)) < 3 * n))
        | (F.arrays_overlap(words, F.array(*map(F.lit, LONE))) & (marks >= 3) & (5 * marks >= n))
        | (line.rlike(f"[{SYMBOLS}]") & (10 * _symbols(line) > _chars(line)))
        | ((n <= NOTICE_WORDS) & _any([low.contains(x) for x in NOTICES]) & low.rlike(NOTICE))
        | ((upper >= 8) & (10 * upper > 7 * letters) & (letters >= 10))
    )


def judge_quality(
    docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = 50, max_repeat_percent: int = 50, min_kept_percent: int = 50, with_text: bool = False
) -> DataFrame:
    """key, the base counts, base_failed, kept_chars, kept, and with_text the cleaned text of every row."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(rf"[^{SPACE}]"))
    rows = docs.select(F.col(key), lines.alias("_lines"))
    rows = rows.select("*", F.transform("_lines", split_words).alias("_split"))  # the one time that words are cut
    rows = rows.select("*", F.flatten("_split").alias("_words"))
    rows = rows.select("*", F.array_join("_words", "").alias("_text"))
    good = F.filter(F.arrays_zip("_lines", "_split"), lambda x: ~line_fails(x["_lines"], x["_split"]))
    rows = rows.select(
        key,
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length("_text").cast("long").alias("word_chars"),
        _symbols(F.col("_text")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.array_distinct(F.transform(good, lambda x: x["_lines"])).alias("_kept"),
    )
    rows = with_repeated_words(rows, "_words", "n_repeat_words")
    rows = rows.withColumn("kept_chars", _chars(F.array_join("_kept", "")).cast("long"))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    rows = rows.withColumn("base_failed", base).withColumn("kept", ~base & (100 * F.col("kept_chars") >= min_kept_percent * F.col("word_chars")))
    out = [key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_chars"]
    return rows.select(*out, *([F.array_join("_kept", "\n").alias("clean_text")] if with_text else []))
