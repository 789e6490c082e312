"""The operators against brute force, and on nulls, empty tables, ties and extra columns."""

import hashlib
import json
import os
import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import decontaminate, html_extract, jaccard, language, mixing, quality, suffix_dedup, tokens, toxicity, urls
from millrace.llm.components import components

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()), T.StructField("score", T.StringType()), T.StructField("key", T.StringType()), T.StructField("n", T.StringType())])
WORDS = [a + b for a in "ka lo mi ne tu sar vel dim por gan".split() for b in "ra to shi nel kum bas dor fil hen zo".split()]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", ".", ",\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(1)
    passage = prose(rnd, 30)
    out = [prose(rnd, rnd.randint(0, 90)) for _ in range(60)]
    out += [out[i] for i in (3, 3, 8)]
    for i in (5, 9, 12, 12, 12):  # near copies
        w = out[i].split(" ")
        if len(w) > 3:
            w[rnd.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    out += [out[i] + " " + passage + " " + out[i + 1] for i in range(20, 26)]
    out += ["", None, "  \n ", "one", "One", "one two three", "a" * 300, "a" * 160, "é" * 80, "\x00" * 120, "x\x00y" * 60]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, f"s{i % 3}" if i % 7 else None, "x", "y", "z") for i, t in enumerate(texts)], DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# 1


def test_url_rules(spark):
    rules = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr")]
    cases = {
        "http://a.Example.COM/en/1": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "x://b.www.example.com/en/?q": ("b.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "deny-by-default"),
        "http://a.net/es": ("a.net", "/es", None, "deny-by-default"),
        "http://net/es/x": ("net", "/es/x", "net/es/", "block"),
        "http://a.net/frog": ("a.net", "/frog", "net/fr", "block"),
        "http://h?x=://b/": ("h", "", None, "deny-by-default"),
        "no scheme": ("", "", None, "deny-by-default"),
        "": ("", "", None, "deny-by-default"),
        None: ("", "", None, "deny-by-default"),
    }
    rows = spark.createDataFrame([(u, "clash") for u in cases], "url string, host string")
    got = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.filter_urls(rows, rules, default="deny-by-default").collect()}
    assert got == cases
    assert urls.filter_urls(rows.limit(0), []).count() == 0
    with pytest.raises(ValueError):
        urls.UrlTrie([("maybe", "a/")])


def test_url_ties_and_clashes(spark):
    rows = spark.createDataFrame([("http://a.com/x", "mine")] * 2 + [(None, None)], "url string, _judged string")
    both = [("allow", "a.com/x"), ("block", "a.com/x")]
    got = urls.filter_urls(rows, both).select("_judged", "verdict").collect()
    assert sorted(map(tuple, got), key=str) == [("mine", "block")] * 2 + [(None, "allow")]
    long = "http://a.com/x" + "y" * 2_000_000
    assert urls.filter_urls(spark.createDataFrame([(long,)], "url string"), both).first()["path"] == long[12:]


# 2


def brute_sets(texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        out.append(frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)]))
    return out


def brute_components(sets):
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("limit", [2048, 4])
def test_jaccard_components(docs, texts, limit):
    sets = brute_sets(texts)
    comps = brute_components(sets)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join_similar(docs, limit=limit, family=limit).collect()}
    assert got == {i: (len(s), comps[i]) for i, s in enumerate(sets)}
    kept = {r["doc_id"] for r in jaccard.keep_one(docs, jaccard.join_similar(docs)).collect()}
    assert kept == set(comps)


def test_jaccard_small_sets(spark):
    """Every pair of sizes below the largest boundary, with overlaps on either side of the threshold."""
    rnd, texts = random.Random(2), []
    for n in range(1, 16):
        base = [f"w{n}x{i}" for i in range(n + 4)]
        texts.append(" ".join(base))
        for cut in (1, 2, 3):
            texts += [" ".join(base[cut:]), " ".join(base[:-cut]), " ".join([*base, *(f"e{rnd.random()}" for _ in range(cut))])]
    comps = brute_components(brute_sets(texts))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for boundary in (None, 1, 8, 16):  # by cost, all by lists, some of each, all by subsets
        got = {r["doc_id"]: r["component_id"] for r in jaccard.join_similar(rows, boundary=boundary).collect()}
        assert got == dict(enumerate(comps)), boundary


def test_jaccard_edge_rows(spark, empty):
    assert jaccard.join_similar(empty).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, None)], "doc_id long, text string")
    got = sorted(map(tuple, jaccard.join_similar(rows).collect()), key=str)
    assert got == [(3, 0, 3), (7, 2, 7), (7, 2, 7), (None, None, None)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in [*range(41), 100]} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def chain(ids):
    return [(ids[i], ids[i + 1]) for i in range(len(ids) - 1)]


def test_components_of_long_chains(spark):
    """Orders of ids in which labels that only spread from neighbour to neighbour need hundreds of rounds."""
    n = 1000
    mixed = list(range(n))
    random.Random(4).shuffle(mixed)
    for ids in (mixed, [0, *range(n - 1, 0, -1)]):
        edges = chain(ids) + chain([5000 + x for x in ids[:300]])
        got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
        assert got == {x: 0 for x in ids} | {5000 + x: 5000 + min(ids[:300]) for x in ids[:300]}


def test_components_at_random(spark):
    """Sparse graphs with components of all sizes and shapes, and a star whose middle is its largest node."""
    rnd = random.Random(6)
    edges = [(rnd.randrange(600), rnd.randrange(600)) for _ in range(330)] + [(9999, 1000 + i) for i in range(50)]
    up = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    assert dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect())) == {x: find(x) for x in up}


# 3


def test_html_extraction_on_invented_pages(spark):
    trees, rnd, same = html_extract.trained(), random.Random(77), 0
    for _ in range(100):
        page, _ = html_extract._invented(rnd)
        root = html_extract.parse(page)
        nodes, _ = html_extract.featurise(root)
        every = html_extract.blocks(root, nodes, [n.tag not in html_extract.NEVER for n in nodes])
        want = [html_extract._MARK.sub("", b).strip() for b in every if html_extract._MARK.search(b)]
        same += html_extract.extract(html_extract._MARK.sub("", page), trees) == "\n".join(want)
    assert same >= 88


def test_html_extraction_edge_rows(spark):
    page = "<html><body><nav><ul><li><a href=/x>Home</a></li><li><a href=/y>News</a></li></ul></nav><article><h1>A title of words</h1><p>First &amp; <b>second</b>\n  words, and more of them.<p>Caf&eacute; text goes on here, with a sentence.</article><footer>&copy; us</footer></body></html>"
    rows = spark.createDataFrame([(1, page, "u"), (2, None, "u"), (3, "", None), (4, "<<<>>><p", "u"), (5, "<div>" * 3000, "u")], "page_id long, html string, text string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extract.extract_main_text(rows).collect()}
    want = "A title of words\nFirst & second words, and more of them.\nCafé text goes on here, with a sentence."
    assert got[1] == (want, len(want))
    assert got[2] == got[3] == got[5] == ("", 0)


PARTED = "<body><article><h1>Some title here</h1><p>First part of the text, with words.</p>{}<p>Second part of the text, with more words.</p></article></body>"


@pytest.mark.parametrize(
    ("between", "text"),
    [
        ('<svg class="i"/>', ""),
        ("<math/>", ""),
        ("<object data=x></object>", ""),
        ("<svg><path d=x /><title>no</title></svg>", ""),
        ("<svg><g>", ""),  # never closed: a block ends it
        ("<p>a\x0bb\u2003c\xa0d\x85and so on.</p>", "a b c d and so on.\n"),
        ("<div>" * 1000 + "</div>" * 1000, ""),
        ("<p>x &am<b>p; y</b> z it was.</p>", "x &amp; y z it was.\n"),  # no reference is made of two parts
    ],
)
def test_html_extraction_between_paragraphs(between, text):
    got = html_extract.extract(PARTED.format(between), html_extract.trained())
    assert got == f"Some title here\nFirst part of the text, with words.\n{text}Second part of the text, with more words."


@pytest.mark.parametrize("page", ["<a " * 330_000, "<a '" * 250_000 + ">", '<a "x>y" ' * 40_000, "<![CDATA[" * 110_000, "<!--" * 250_000, "<i>" * 60_000 + "<p>" * 60_000, "<b><div>" + "<i>" * 60_000 + "</b>" * 60_000, "<ul>" + "<i>" * 60_000 + "<li>" * 60_000])
def test_html_parser_reads_a_page_once(page):
    import time

    began = time.process_time()
    html_extract.parse(page)
    assert time.process_time() - began < 5  # a parser that looks again from every tag takes minutes


def test_html_extraction_repeated_rows(spark):
    rows = spark.createDataFrame([(1, PARTED, "u")] * 2 + [(None, PARTED, None)], "page_id long, html string, n_chars string")
    got = [tuple(r) for r in html_extract.extract_main_text(rows).collect()]
    assert len(got) == 3 and len({r[1] for r in got}) == 1


def test_decoding_is_hierarchical():
    root = html_extract.parse("<body><div><p>a b</p><p>c d</p></div></body>")
    nodes, _ = html_extract.featurise(root)
    for logits in ([0, 0, -5, 3, 3], [0, 0, 5, -3, 3], [0, 0, -5, 1, 1]):
        kept = html_extract.decode(nodes, logits)
        assert all(kept[n.parent.index] for i, n in enumerate(nodes) if kept[i] and n.parent)


# 4


def brute_cut(rows, length):
    first = {}
    for k, t in sorted(rows):
        for i in range(len(t) - length + 1):
            first.setdefault(t[i : i + length], k)
    out = {}
    for k, t in rows:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < k:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[k] = (len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("length", [50, 20])
def test_suffix_dedup(docs, texts, length):
    want = brute_cut([(i, (t or "").encode()) for i, t in enumerate(texts)], length)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in suffix_dedup.find_repeats(docs, length).collect()}
    assert got == want


def test_suffix_dedup_long_texts(spark, monkeypatch):
    """Documents longer than a piece, and repeats across pieces' edges."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 512)
    rnd = random.Random(3)
    a = prose(rnd, 700)
    rows = [(1, a), (2, "x" + a[200:2400] + "y" + prose(rnd, 300)), (3, prose(rnd, 50) + a)]
    packs = suffix_dedup._pieces
    import numpy as np

    for _, t in rows:  # every string in one piece
        sizes = np.array([len(t.encode())])
        starts = [s for _, _, a_, e in packs(sizes, 50) for s in range(a_, e - 49)]
        assert starts == list(range(int(sizes[0]) - 49))
    want = brute_cut([(i, t.encode()) for i, t in rows], 50)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in suffix_dedup.find_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_suffix_dedup_edge_rows(spark, empty):
    assert suffix_dedup.find_repeats(empty).count() == 0
    t = "the same text for each of these rows, of more than fifty bytes"
    rows = spark.createDataFrame([(5, t), (5, t), (None, t), (4, "é" + t)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_removed"], r["kept_text"]) for r in suffix_dedup.find_repeats(rows, with_text=True).collect()), key=str)
    assert got == [(4, 0, "é" + t), (5, len(t), ""), (5, len(t), ""), (None, len(t), "")]


def test_suffix_family():
    """Batches in any order of keys: hits of every batch against all others, few levels, few comparisons."""
    import numpy as np

    shape, rnd = suffix_dedup.Shape(50), np.random.default_rng(5)
    family, batches, every = suffix_dedup.SuffixFamily(shape), [], []
    words = rnd.integers(97, 123, (400, shape.row)).astype(np.uint8)
    for batch in rnd.permutation(40):
        rows = words[rnd.integers(0, 400, 30)].copy()
        rows[rnd.random(30) < 0.5, 45:60] = rnd.integers(97, 99, 15)  # the same anchor in other places
        rows[:, -2], rows[:, -1] = 50, rnd.integers(1, shape.reach + 1, 30)
        level = suffix_dedup.Level.of(suffix_dedup._strings(rows), rnd.permutation(1000)[:30] * 40 + batch)
        batches.append((level.rows, level.keys))
        every += list(zip(level.rows, level.keys, strict=True))
        family.add(level)
        assert len(family.levels) <= 9
    assert family.compared <= 12 * len(every)  # a row meets those of its anchor, not the family

    def strings(row):
        r = row.ljust(shape.row, b"\0")
        text = r[shape.length : shape.length + shape.reach - 1][::-1] + r[: shape.length]
        return {o: text[shape.reach - 1 - o :][: shape.length] for o in range(r[-1])}

    first = {}
    for row, key in every:
        for o, x in strings(row).items():
            first[o, x] = min(first.get((o, x), 1 << 60), key)
    for rows, keys in batches:
        for row, key, bits in zip(rows, keys, family.hits(rows, keys), strict=True):
            for o, x in strings(row).items():
                assert bool(int(bits) >> o & 1) == (first[o, x] < key)


@pytest.mark.parametrize("size", [1 << 18, 1000])
def test_suffix_parts_are_compared_by_batches(monkeypatch, size):
    """Many parts with different text around one line: batches are made by rows, not by parts, and each part gets its own answer."""
    import numpy as np

    shape, rnd, added = suffix_dedup.Shape(50), np.random.default_rng(6), []
    monkeypatch.setattr(suffix_dedup, "BATCH", size)
    add = suffix_dedup.SuffixFamily.add
    monkeypatch.setattr(suffix_dedup.SuffixFamily, "add", lambda self, batch: (added.append(self), add(self, batch)))
    line, parts = rnd.integers(97, 123, shape.row).astype(np.uint8), []
    for _ in range(300):
        rows = np.tile(line, (20, 1))
        rows[:, 40:45] = rnd.integers(97, 99, (20, 5))
        rows[:, 60] = rnd.integers(97, 123, 20)
        rows[:, -2], rows[:, -1] = 50, shape.reach
        rows = np.unique(suffix_dedup._strings(rows))
        parts.append((rows, rnd.permutation(10_000)[: len(rows)]))
    total = sum(len(keys) for _, keys in parts)

    def strings(row):
        text = row[shape.length : shape.length + shape.reach - 1][::-1] + row[: shape.length]
        return [(o, text[shape.reach - 1 - o :][: shape.length]) for o in range(shape.reach)]

    first = {}
    for rows, keys in parts:
        for row, key in zip(rows.tolist(), keys.tolist(), strict=True):
            for x in strings(row):
                first[x] = min(first.get(x, key), key)
    want = [[sum((first[x] < key) << x[0] for x in strings(row)) for row, key in zip(rows.tolist(), keys.tolist(), strict=True)] for rows, keys in parts]
    assert [(x & np.uint64((1 << shape.reach) - 1)).tolist() for x in suffix_dedup.found(list(parts), shape)] == want
    assert len(added) <= 1 + 2 * total // size and added[0].compared < 2 * total  # a batch a part would be 300, with far more comparisons


def test_suffix_rows_of_one_hash(monkeypatch):
    """Rows of equal hashes are told apart by their bytes."""
    import numpy as np

    rows = np.array([b"%08d" % x * 3 for x in (5, 3, 5, 4, 3, 11)])
    want = suffix_dedup._distinct(rows)
    assert rows[want[0]].tolist() == sorted(set(rows.tolist())) and (rows[want[0]][want[1]] == rows).all()
    monkeypatch.setattr(suffix_dedup, "_mix", lambda h: h * np.uint64(0))
    got = suffix_dedup._distinct(rows)
    assert (rows[got[0]] == rows[want[0]]).all() and (got[1] == want[1]).all()


# 5


def test_toxicity_grammar():
    lexicon = toxicity.Lexicon({"idiot": 1.0, "scum": 1.0}, {"lowei": 1.0})
    weigh = lambda t: sum(lexicon.clauses(t))
    assert weigh("nothing here") == 0
    assert weigh("what an idiot.") == pytest.approx(1.0)
    assert weigh("you idiot.") > weigh("what an idiot.") > weigh("he said idiot there") > 0
    assert weigh("not an idiot") < weigh("an idiot")
    assert weigh('"idiot"') == pytest.approx(0.5)
    assert weigh("lOWeischaft da") == pytest.approx(1.0)
    assert weigh("blowei idiots") == 0  # inside a word, and another word
    assert len(lexicon.clauses("idiot. scum! fine. scum")) == 3
    assert weigh("I will kill") == weigh("they beat the record") == 0.5  # a subject is no target
    assert weigh("kill you") == weigh("I will kill all of you") == weigh("ich werde dich töten") == weigh("je vais te tuer") == 1.0
    assert weigh("idiot, you") == pytest.approx(1.3) == weigh("you idiot") == weigh("you idiot you")
    assert weigh("idiot, she said") == pytest.approx(0.6) and weigh("I won't kill you") == pytest.approx(0.3)


def test_toxicity_machines_are_the_chains():
    """The composed machines give each clause what their transducers give one after the other."""
    rnd = random.Random(13)
    for m in toxicity.machines():
        assert len(m.moves) == len(toxicity.SYMBOLS) * len({s for s, _ in m.moves})  # every symbol moves every state
    for _ in range(300):
        clause = [(rnd.choice(toxicity.SYMBOLS[:-2]), rnd.random()) for _ in range(rnd.randint(0, 15))]
        want = clause
        for chain in (toxicity.BACKWARD, toxicity.FORWARD):
            want, states = want[::-1] if chain is toxicity.BACKWARD else want, [0] * len(chain)
            read = []
            for symbol, weight in want:
                for i, t in enumerate(chain):
                    states[i], symbol, factor = t.step(states[i], symbol)
                    weight *= factor
                read.append((symbol, weight))
            want = read[::-1] if chain is toxicity.BACKWARD else read
        assert toxicity.run(clause) == pytest.approx(sum(w for _, w in want))


def test_toxicity_held_out(spark):
    """The driver's documents: recall on the fold whose labels aren't learned, and clean documents left alone."""
    from millrace.llm import queries

    data = "/root/testdata/sf0.1"
    if not os.path.exists(data):
        pytest.skip("no test tables")
    got = queries.op5_toxicity(spark, data).where("held_out").join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").collect()
    toxic, clean = [r for r in got if r["toxic"] == 1], [r for r in got if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic) and sum(r["predicted"] for r in clean) <= 0.02 * len(clean)


def test_toxicity_learns_and_scores(spark, empty):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 4 == 0
        w = [rnd.choice(WORDS) for _ in range(40)]
        if toxic:
            for _ in range(3):
                w.insert(rnd.randrange(40), "grubo" + rnd.choice(WORDS))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    assert any("grubo".startswith(s) for s in model.stems)
    more = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (None, "x")], "doc_id long, text string"))
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(more.withColumn("score", F.lit("clash")), model).collect()}
    assert sum(got[i]["predicted"] == int(i % 4 == 0) for i in range(900)) >= 890
    assert got[-1]["score"] == got[-2]["score"] < 0.5 and all(0 <= r["score"] <= 1 for r in got.values())
    none = toxicity.train(empty, labels.limit(0), F.lit(True))
    assert toxicity.score_toxicity(empty, none).count() == 0


def test_toxicity_learns_rare_insults(spark):
    """Insults in 10 toxic texts each: enough in all labels, too few in a half of them."""
    rnd = random.Random(8)
    insults = ["zorblat", "quimpex", "vandruk", "yelfrig"]
    rows = []
    for i in range(240):
        w = [f"{rnd.choice(WORDS)}{chr(97 + rnd.randrange(26))}" for _ in range(30)]
        if i < 40:
            w.insert(rnd.randrange(1, 30), insults[i % 4])
        rows.append((i, " ".join(w), int(i < 40)))
    both = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(both.drop("toxic"), both.drop("text"), F.lit(True))
    missed = [x for x in insults if x not in model.words and not any(x.startswith(s) for s in model.stems)]
    assert missed == []


# 6


def brute_hits(text, items, n=13):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        for i in range(max(1, len(b) - n + 1) if b else 0):
            win = b[i : i + n]
            for j in range(len(w) - len(win) + 1):
                if w[j : j + len(win)] == win:
                    hit |= set(range(j, j + len(win)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_decontamination(spark, docs, texts, empty):
    items = [(1, texts[20]), (2, "One"), (10, texts[30]), (9, None), (4, "?!"), (5, texts[20]), (6, "kara lora"), (7, "")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    got = {r["doc_id"]: r for r in decontaminate.find_contamination(docs, bench).collect()}
    for i, t in enumerate(texts):
        n, hit, found = brute_hits(t, items)
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (n, hit, found)
        assert got[i]["contaminated"] == (hit > 0 and 20 * hit >= n)
        assert sum(s["end"] - s["start"] for s in got[i]["spans"]) == hit
    assert decontaminate.find_contamination(empty, bench).count() == 0
    assert decontaminate.find_contamination(docs, bench.limit(0)).where("n_hit > 0 OR contaminated").count() == 0
    cut = {r["doc_id"]: r["text"] for r in decontaminate.without_spans(docs, decontaminate.find_contamination(docs, bench)).collect()}
    for i, t in enumerate(texts):
        n, hit, _ = brute_hits(t, items)
        assert brute_hits(cut[i], [])[0] == n - hit


def test_decontamination_without_broadcast(spark, docs, texts, monkeypatch):
    """The shuffled path equals brute force, with a document twice, a long one, and no outer join on a window or a set."""
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    items = [(1, texts[20]), (2, "One"), (10, texts[30]), (9, None), (5, texts[20])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    long = " ".join(f"w{i}" for i in range(200_000)) + " " + texts[20] + " one"
    more = spark.createDataFrame([(0, texts[0]), (-1, long)], "doc_id long, text string")
    found = decontaminate.find_contamination(docs.select("doc_id", "text").unionByName(more), bench)
    said = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter, (window" not in said and "LeftOuter, (set_id" not in said and "LeftOuter, (_row" in said
    want = sorted((i, *brute_hits(t, items)) for i, t in [*enumerate(texts), (0, texts[0]), (-1, long)])
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()) == want


def test_decontamination_sizes_its_bitmap(spark):
    """More windows than the least bitmap is for; every item is found in its document and in no other."""
    rnd = random.Random(12)
    items = [(i, " ".join(f"{rnd.choice(WORDS)}{rnd.randrange(1000)}" for _ in range(43))) for i in range(1500)]
    assert decontaminate._power(1500 * 31) == 19 and decontaminate._power(10) == 18 and decontaminate._power(1 << 40) == 22
    rows = [(i, prose(rnd, 20) + " " + " ".join(t.split()[5:25])) for i, t in items[::10]] + [(-1, prose(rnd, 300)), (-2, None)]
    bench, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["items"], r["n_hit"]) for r in decontaminate.find_contamination(docs, bench).collect()}
    assert got == {i: ([str(i)], 20) for i, _ in items[::10]} | {-1: ([], 0), -2: ([], 0)}


# 7


def test_quality(docs, texts, empty):
    got = {r["doc_id"]: r for r in quality.judge_quality(docs, with_text=True).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        rep = {k + j for k, x in enumerate(tri) if tri.count(x) > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(rep), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(rep) > 50 * len(w))
        assert not (r["kept"] and r["base_failed"])
    assert quality.judge_quality(empty).count() == 0


def test_quality_lines(spark):
    cases = {
        "home | news | sport | weather | login": True,
        "Accueil": True,
        "All rights reserved.": True,
        "We use cookies to improve your visit.": True,
        "The cookie recipe that my grandmother wrote down needs butter, sugar and two eggs.": False,
        "Copyright (c) 2019 Example Press": True,
        "© Example Press, 2019-2024": True,
        "Copyright is a right that authors have, he told the class.": False,
        "The sign © came into law long ago, and nobody drew it by hand.": False,
        "Released under the MIT License.": True,
        "Licensed under CC BY-NC 4.0.": True,
        "The band's second record was released under the name of a friend.": False,
        "Sign up for our weekly newsletter!": True,
        "She printed a newsletter for the village, page by page.": False,
        "They subscribe to the view, as we all did, that it rains.": False,
        "Please enable JavaScript to see this page.": True,
        "Read our Privacy Policy.": True,
        "The privacy policy of the ministry changed, and nobody knew why.": False,
        "Lesen Sie unsere Datenschutzerklärung.": True,
        "Der Datenschutz beschäftigt den Landtag, wie jedes Jahr, lange.": False,
        "WORDS IN CAPITALS ALL ALONG THE LINE!!": True,
        "a$$ b%% c&& d## of&& more**": True,
        "same same same same same same same same same same.": True,
        "eight words that never come to an end": True,
        "A plain sentence of some words, as they go.": False,
        "Title": False,
        "This is Über gut, said Él.": False,
    }
    rows = spark.createDataFrame([(c,) for c in cases], "line string")
    assert {r["line"]: r["f"] for r in rows.select("line", quality.line_fails(F.col("line")).alias("f")).collect()} == cases


# 8


def test_language(spark, empty):
    rnd = random.Random(8)
    a, b = "the of and thing was with ing tion".split(), "der und die nicht schaft keit ein zwö".split()
    rows = [(i, " ".join(rnd.choice(a if i % 2 else b) + rnd.choice(["", "a", "e"]) for _ in range(rnd.randint(4, 60))), "en" if i % 2 else "de") for i in range(400)]
    rows += [(1000, None, "en"), (1001, "12 34 !", "de"), (1002, "the thing", None), (None, "und die", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = language.train(docs, F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(True)))
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    assert sum(got[i]["lang_pred"] == got[i]["lang"] for i in range(400)) >= 398
    assert got[1000]["lang_pred"] == got[1001]["lang_pred"] == "und" and got[1002]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language.train(empty.withColumn("lang", F.lit(None).cast("string")), F.lit(True)) is None
    assert language.predict(docs, None).where("lang_pred <> 'und'").count() == 0
    again = language.train(docs.unionByName(docs.where("lang IS NULL").withColumn("text", F.lit("zzzz qqqq"))), F.lit(True))
    assert (again.idf == language.train(docs, F.lit(True)).idf).all()  # rows without a language teach nothing
    clash = language.predict(docs.limit(2).withColumn("_predicted", F.lit("mine")), model).collect()
    assert [r["_predicted"] for r in clash] == ["mine"] * 2


def test_language_learns_every_language(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 30)
    rows = [(30 * j + i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}x " * 5 + "the", f"l{i}") for i in range(30) for j in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(language.train(docs, F.lit(True)).classes) == 30
    with pytest.raises(ValueError, match="more than 30 languages"):
        language.train(docs.unionByName(docs.limit(1).withColumn("lang", F.lit("one more"))), F.lit(True))


def test_language_held_out(spark):
    """The driver's documents: rows of the fold that isn't learned from."""
    from millrace.llm import queries

    data = "/root/testdata/sf0.01"
    if not os.path.exists(data):
        pytest.skip("no test tables")
    got = queries.op8_language_id(spark, data).join(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(got) > 200 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)


# 9


def test_targets():
    assert mixing.targets({}) == {}
    got = mixing.targets({"a": 100, "b": 1000, "c": 900, None: 0})
    assert got["a"] == 300 and got[None] == 0 and sum(got.values()) == pytest.approx(2000)
    assert got["b"] / got["c"] == pytest.approx(2)
    assert mixing.targets({"z": 5}) == {"z": 5}


def test_flight_keeps_the_balance():
    import numpy as np

    rnd = np.random.default_rng(9)
    p, size = rnd.random(500), rnd.integers(1, 300, 500).astype(float)
    out = mixing.flight(p, size, rnd.random(500))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and out @ size == pytest.approx(p @ size)


def test_mixing(spark, empty, monkeypatch):
    rnd = random.Random(9)
    rows = [(i, " ".join(["w"] * rnd.randint(0, 80)), rnd.choice(["a", "b", "c", "d", None])) for i in range(3000)] + [(9000, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    for block in (4096, 64):
        monkeypatch.setattr(mixing, "BLOCK", block)
        got = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
        again = mixing.mix(docs.repartition(7)).collect()
        assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in again}
        assert len(got) == 3001 and all(r["taken"] <= 3 * r["size"] for r in got)
        for s in ("a", "b", "c", "d", None):
            own = [r for r in got if r["source"] == s]
            assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(3, 0.01 * own[0]["target"])
    assert mixing.mix(empty).count() == 0


def test_mixing_repeated_rows(spark):
    """Rows of one key are drawn each by itself, so a source of many copies comes near its target too."""
    rows = [(1, "w " * 10, "a")] * 400 + [(2, "w " * 10, "b")] * 400 + [(3, "w " * 10, "c")] * 400
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)).groupBy("doc_id").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.count("*").alias("n")).collect()
    assert all(r["n"] == 400 and abs(r["t"] - r["g"]) <= 20 for r in got)


def test_mixing_deals_equal_rows_to_blocks(spark, monkeypatch):
    """Many equal rows are as many after they are numbered, each with its own number, and no block has much more than its share."""
    monkeypatch.setattr(mixing, "BLOCK", 256)
    rows = spark.range(20_000).select(F.lit(1).alias("key"), F.lit("a").alias("source"), F.lit(7).cast("long").alias("size"))
    rows = rows.unionByName(spark.createDataFrame([(2, None, 7), (2, None, 7), (None, "a", 0)], "key int, source string, size long"))
    got = mixing.numbered(rows)
    counts = {(r["key"], r["source"]): (r["n"], r["d"], r["m"]) for r in got.groupBy("key", "source").agg(F.count("*").alias("n"), F.count_distinct("nth").alias("d"), F.max("nth").alias("m")).collect()}
    assert counts == {(1, "a"): (20_000, 20_000, 19_999), (2, None): (2, 2, 1), (None, "a"): (1, 1, 0)}
    blocks = mixing.dealt(got.where("key = 1").withColumn("blocks", F.lit(79).cast("long")), 90).groupBy("block").count().collect()
    assert len(blocks) == 79 and max(r["count"] for r in blocks) < 256 * 1.4


# 10


def test_token_counts(spark, docs, texts, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, library = tokens.MergeCounter(json.load(open(path))), Tokenizer.from_file(path)
    rnd, letters = random.Random(10), " \n\t\x1c\x85 a b'sté½Ⅷ१ßДA0.,!😀\x00"
    for t in [*texts, *("".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) + rnd.choice(["", " <|endoftext|> x"]) for _ in range(3000))]:
        assert own.count(t) == len(library.encode(t or "", add_special_tokens=False).ids), repr(t)
    got = {r["doc_id"]: r for r in tokens.token_counts(docs, path, limit=100).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == Row(doc_id=i, n_bytes=len((t or "").encode()), n_tokens=n, over_limit=n > 100)
    assert tokens.token_counts(empty, path).count() == 0
    given = json.load(open(path))
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}, {"model": given["model"] | {"ignore_merges": True}}):
        with pytest.raises(ValueError, match="vocabulary"):
            tokens.MergeCounter(given | change)
