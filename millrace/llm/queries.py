"""The queries of this subpackage, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import lasting_folder
from . import decontaminate, erasure, html_extract, jaccard, language, mixing, phrases, quality, sharding, suffix_dedup, tokens, toxicity, urls
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

#: The url rules of the first contract, longest match wins.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_similar(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.find_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def toxicity_fold(key: str = "doc_id") -> Column:
    """The rows whose labels may be learned."""
    return F.crc32(F.col(key).cast("string")) % 5 != 0


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity_fold())
    return toxicity.score_toxicity(docs, model).select("doc_id", (~toxicity_fold()).alias("held_out"), "score", "predicted")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), "contaminated")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept_chars")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.train(docs, ~held_out)
    return language.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.into_shards(sharding.measured(table(spark, sf_dir, "documents")), ["key", "text_crc32", "size"])
    return rows.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op12_cascading_erasure(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: table(spark, sf_dir, name) for name in erasure.AMOUNTS}
    return erasure.erase_shop(tables, lasting_folder(spark, "erasure"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang")).drop("words", "cut")


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_html_extraction": op3_html_extraction,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_quality_rules": op7_quality_rules,
    "op8_language_id": op8_language_id,
    "op9_source_mixing": op9_source_mixing,
    "op10_token_counts": op10_token_counts,
    "op11_feistel_shards": op11_feistel_shards,
    "op12_cascading_erasure": op12_cascading_erasure,
    "op13_collocations": op13_collocations,
}



def _feistel_sql(rows: str) -> str:
    """The permutation of sharding, once over, of rows (i, x, a, b, n: a and b the sides, n the rows) in SQL."""
    p = sharding.Permutation(0)
    s = f"SELECT i, a, b, n, x // b AS l, x % b AS r FROM ({rows})"
    for j in range(p.rounds):
        half, other, side = ("r", "l", "a") if j % 2 == 0 else ("l", "r", "b")
        s = f"SELECT *, ({half} + {p.key(j)}) & {sharding.BITS} AS h FROM ({s})"
        for factor in sharding.FACTORS[:2]:
            s = f"SELECT * EXCLUDE h, (xor(h, h >> 15) * {factor}) & {sharding.BITS} AS h FROM ({s})"
        s = f"SELECT i, a, b, n, {half}, ({other} + xor(h, h >> 13)) % {side} AS {other} FROM ({s})"
    return f"SELECT i, l * b + r AS x, a, b, n FROM ({s})"


def _nibble(i: int) -> int:
    """What the CRC-32 polynomial makes of four bits."""
    for _ in range(4):
        i = (i >> 1) ^ (0xEDB88320 if i & 1 else 0)
    return i


ORACLE: dict[str, str] = {
    "op1_url_filter": r"""
WITH cut AS (
  SELECT page_id, strpos(coalesce(url, ''), '://') AS cut_at, coalesce(url, '') AS url FROM pages),
parts AS (
  SELECT page_id, CASE WHEN cut_at = 0 THEN '' ELSE substr(url, cut_at + 3) END AS rest FROM cut),
split AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
judged AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM split)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
""",
    "op2_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
meet AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM meet JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * k >= 80 * (x.n + y.n - k)),
pair AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a, b FROM pair UNION SELECT reach.a, pair.b FROM reach JOIN pair ON reach.b = pair.a)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce((SELECT min(b) FROM reach WHERE a = w.doc_id), w.doc_id)) AS component_id
FROM w LEFT JOIN sizes USING (doc_id)
""",
    # the pages of the driver hold their main text in one article, in headings and paragraphs
    "op3_html_extraction": r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?is)<article[^>]*>(.*?)</article>', 1) AS x FROM pages),
b AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(regexp_replace(x, '(?i)</?(?:h[1-6]|p|ul|ol|li|div|section|blockquote|table|tr|td|th|pre)(?: [^>]*)?>', chr(1), 'g'), '(?i)<br ?/?>', ' ', 'g'), '(?s)<!--.*?-->|<[^>]*>', '', 'g'), chr(1)) AS parts FROM a),
c AS (SELECT page_id, url, array_to_string(list_filter(list_transform(parts, lambda t: trim(regexp_replace(
  replace(replace(replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'),
  '[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{3000}]+', ' ', 'g'))), lambda t: t <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM c
""",
    "op4_suffix_dedup": r"""
WITH n AS (SELECT doc_id, encode(coalesce(text, '')) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
pos AS (SELECT doc_id, i, array_slice(h, i + 1, i + 50) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM n WHERE n >= 50)),
first AS (SELECT s, min(doc_id) AS least FROM pos GROUP BY s),
hit AS (SELECT DISTINCT doc_id, i FROM pos JOIN first USING (s) WHERE least < doc_id),
run AS (SELECT doc_id, i, sum(CASE WHEN i > prev + 50 OR prev IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM hit)),
span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY doc_id, r),
gap AS (SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM span UNION ALL SELECT doc_id, 0, min(a) FROM span GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(hex(array_slice(h, a + 1, coalesce(b, n))), '' ORDER BY a) AS k FROM gap JOIN n USING (doc_id) GROUP BY doc_id),
gone AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM span GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(unhex(k), h)) AS kept_sha256
FROM n LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op6_decontamination": r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (
  SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS s FROM bs),
sizes AS (SELECT DISTINCT size FROM win),
pos AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM dw CROSS JOIN sizes WHERE len(w) >= size),
cand AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s FROM pos),
hits AS (SELECT c.doc_id, c.size, c.i, win.item_id FROM cand c JOIN win ON c.s = win.s),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op7_quality_rules": rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM t),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
tri AS (SELECT doc_id, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS s FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM tri WHERE s IS NOT NULL) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
different AS (SELECT DISTINCT doc_id, line FROM lines),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
measured AS (
  SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    length(regexp_replace(line, '\P{{L}}+', '', 'g')) AS letters, length(regexp_replace(line, '\P{{Lu}}+', '', 'g')) AS upper_letters,
    length(line) - length(translate(line, '#*$%&|<>', '')) AS symbols, len(regexp_extract_all(line, '{quality.SEPARATORS}')) AS marks
  FROM different),
good AS (
  SELECT doc_id, sum(chars) AS chars FROM measured WHERE NOT (
    (marks >= 3 AND 5 * marks >= len(lw)) OR regexp_matches(line, '{quality.MENU}') OR (len(lw) <= {quality.NOTICE_WORDS} AND regexp_matches(lower(line), '{quality.NOTICE}'))
    OR 10 * symbols > chars OR (letters >= 10 AND 10 * upper_letters > 7 * letters) OR (len(lw) >= 10 AND 10 * len(list_distinct(lw)) < 3 * len(lw))
    OR (len(lw) >= 8 AND NOT regexp_matches(line, '[.!?…:;。！？]')))
  GROUP BY doc_id),
base AS (
  SELECT t.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, coalesce(good.chars, 0) AS good_chars
  FROM t JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN good USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * good_chars >= 50 * word_chars AS kept
FROM base
""",
    "op11_feistel_shards": rf"""
WITH RECURSIVE h AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, string_split(hex(encode(coalesce(text, ''))), '') AS h FROM documents),
bits AS (SELECT doc_id, size, list_transform(range(1, size * 2 - 1), lambda i: CAST(strpos('0123456789ABCDEF', h[i + CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END]) - 1 AS BIGINT)) AS h FROM h),
crc AS (SELECT doc_id, size, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], h), lambda c, x: xor(list_extract(CAST({[*map(_nibble, range(16))]} AS BIGINT[]), (xor(c, x) & 15) + 1), c >> 4))) AS text_crc32 FROM bits),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS i FROM crc),
sides AS (SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS a FROM documents),
cells AS (SELECT i, i AS x, a, (n + a - 1) // a AS b, n FROM numbered, sides),
walk AS ({_feistel_sql("SELECT * FROM cells")} UNION ALL {_feistel_sql("SELECT * FROM walk WHERE x >= n")})
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, CAST(x % 16 AS INTEGER) AS shard, CAST(x // 16 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard, i AS row_number
FROM numbered JOIN (SELECT i, x FROM walk WHERE x < n) USING (i)
""",
    "op13_collocations": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, s, count(*) AS f FROM grams GROUP BY ALL),
c AS (SELECT lang, k, s, f AS a, string_split(s, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
inner_ AS (SELECT lang, a, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) AS s FROM c),
longer AS (SELECT lang, s, max(a) AS most FROM inner_ GROUP BY ALL),
cuts AS (SELECT lang, s, k, a, cut, array_to_string(w[1:cut], ' ') AS x, array_to_string(w[cut + 1:k], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
scored AS (SELECT cuts.lang, cuts.s, a, cut, x.f AS l, y.f AS r, n, CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON cuts.lang = x.lang AND cuts.x = x.s JOIN f y ON cuts.lang = y.lang AND cuts.y = y.s JOIN total ON total.lang = cuts.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, s ORDER BY score, cut) AS b FROM scored),
kept AS (SELECT best.* FROM best LEFT JOIN longer USING (lang, s) WHERE b = 1 AND (most IS NULL OR 100 * most < 100 * a))
SELECT lang, rank, s AS phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank FROM kept) WHERE rank <= 2000
""",
}
