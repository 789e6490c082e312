"""Dedup, reports, trees, sources, the run and the stream, on small tables."""

import datetime as dt
import json
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions.rules import POST_FIELDS
from millrace.operators import dedup, quality, segments, structure, tree
from millrace.operators.history import KeyIndex
from millrace.operators.html_nodes import closed_references, html_nodes, nodes_of
from millrace.plans import envelope as E
from millrace.plans import parsing, status
from millrace.sources import channels, config, files
from millrace.streaming import stateful
from millrace.streaming.ingest import ingest
from millrace.streaming.stateful import ingest_first


@pytest.fixture(scope="module")
def posts(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.choice(["Один 1", "один 2!", "two", "", None])) for i in range(200)]
    df = spark.createDataFrame(rows, "n int, author string, text string")
    return rows, df.select("n", "author", "text", *dedup.post_key(F.col("author"), F.col("text")))


def key(r):
    return (r[1] or "", "".join(c for c in (r[2] or "").lower() if c.isalpha()))


def test_dedup(spark, posts):
    rows, df = posts
    keys, first = ["author_key", "body_key"], {}
    for r in rows:
        first.setdefault(key(r), r[0])
    for f in (dedup.keep_first, dedup.ranked_first):
        assert {r["n"] for r in f(df, keys, ["n"]).collect()} == set(first.values())
    old, new = df.where("n < 3"), df.where("n >= 3")
    had, want = {key(r) for r in rows[:3]}, {}
    for r in rows[3:]:
        if key(r) not in had:
            want.setdefault(key(r), r[0])
    assert {r["n"] for r in dedup.save_batch(new, old, keys, ["n"]).collect()} == set(want.values())
    again = old.unionByName(dedup.save_batch(new, old, keys, ["n"]))
    assert dedup.save_batch(new, again, keys, ["n"]).count() == 0  # saved twice, nothing new
    assert tuple(dedup.save_report(new, old, keys, ["n"]).first()) == (len(want), 197 - len(want), len(had))


def test_keep_first_keeps_one_of_rows_that_tie(spark):
    rows = [(1, "a", {"x": 1}), (1, "a", {"x": 1}), (1, "b", None), (2, "a", None), (None, None, None), (None, None, None), (3, None, None)]
    df = spark.createDataFrame(rows, "n int, k string, m map<string,int>")
    got = dedup.keep_first(df.select("n", "k", "m", F.lit(7).alias("_first")), ["k"], ["n"])
    assert got.columns == ["n", "k", "m", "_first"]
    assert sorted(((r["n"], r["k"]) for r in got.collect()), key=str) == [(1, "a"), (1, "b"), (None, None)]
    again = dedup.save_batch(df.drop("m").unionByName(df.drop("m")), df.where("k = 'b'").drop("m"), ["k"], ["n"])
    assert sorted(((r["n"], r["k"]) for r in again.collect()), key=str) == [(1, "a"), (None, None)]
    assert dedup.keep_first(df.limit(0), ["k"], ["n"]).count() == 0


def test_reports(spark, posts):
    rows, df = posts
    c = Counter(map(key, rows))
    got = quality.repeats(df, ["author_key", "body_key"], "body_key").first()
    assert tuple(got) == (200, len(c), sum(n - 1 for n in c.values()), sum(n for k, n in c.items() if not k[1]))
    sizes = sorted(len(r[2] or "") for r in rows)
    assert quality.median_length(df).first()[0] == sizes[100]
    low = quality.lengths(df.unionByName(df.limit(1).withColumn("text", F.repeat(F.lit("x"), F.lit(5950))))).first()
    assert tuple(low) == (0, 5950, 1)
    assert df.agg(quality.distinct_with_null(F.col("author"))).first()[0] == 3


@pytest.mark.parametrize("n", [1, 2, 4, 39, 40, 41, 777])
def test_order_statistics(spark, n):
    rnd = random.Random(n)
    values = [rnd.randint(0, 50) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = quality.order_statistic(df, F.col("v"), F.floor(F.col("v") / 7), F.floor(F.col("n") / 2), "m").first()[0]
    assert got == sorted(values)[n // 2]
    times = spark.createDataFrame([(f"2024-01-{1 + v // 10:02}T{v % 24:02}:00:00Z",) for v in values] + [("",), (None,)], "t string")
    assert quality.twentieth(times, F.col("t")).first()[0] == sorted(f"2024-01-{1 + v // 10:02}T{v % 24:02}:00:00Z" for v in values)[max(0, n // 20)]


@pytest.mark.parametrize("piece", [10**6, 7])
def test_ranked_values(spark, monkeypatch, piece):
    """Several ranks at once, one value with most rows, ranges that hold few values, and ranks that nothing has."""
    monkeypatch.setattr(quality, "PIECE", piece)
    rnd = random.Random(piece)
    values = [f"2024-01-01T05:00:00.{rnd.randint(0, 90):03}Z" for _ in range(300)] + ["2024-01-01T05:00:00.041Z"] * 150 + [None] * 5
    rnd.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v string")
    n = F.col("n")
    got = quality.ranked_values(df, F.col("v"), {"first": F.lit(0), "tenth": F.floor(n / 10), "median": F.floor(n / 2), "last": n - 1, "none": n}).first()
    there = sorted(v for v in values if v is not None)
    assert tuple(got) == (there[0], there[45], there[225], there[449], None)
    assert tuple(quality.ranked_values(df.where("v is null"), F.col("v"), {"a": F.lit(0), "b": n - 1}).first()) == (None, None)


def test_feed_order(spark):
    rows = [("f", i, a) for i, a in enumerate(["1m", "5m", "3m", None, "2h", "?", "1h", "1d", "1w", "2w", "3w", "1m"])] + [("g", 0, "1w")]
    df = spark.createDataFrame(rows, "feed string, n int, age string")
    got = {r["feed"]: tuple(r)[1:] for r in quality.inversions(df, F.col("age"), "n", ["feed"]).collect()}
    assert got == {"f": (10, 3, 30.0), "g": (1, 0, 0.0)}
    past = F.coalesce(F.right("age", F.lit(1)) == "w", F.lit(False))
    assert [tuple(r) for r in quality.streak_stop(df, past, "n", ["feed"], 3).collect()] == [("f", 10)]
    assert [tuple(r) for r in quality.unit_histogram(df, F.col("age"), "n").collect()] == [("m", 4, 0), ("w", 4, 0), ("?", 2, 3), ("h", 2, 4), ("d", 1, 7)]
    kept = [(r["feed"], r["n"]) for r in quality.tail(df, "age", "n", ["feed"], 2).orderBy("feed", "n").collect()]
    assert kept == [("f", 10), ("f", 11), ("g", 0)]
    grown = spark.createDataFrame([("f", i, v) for i, v in enumerate([1, 1, 1, 2, 2, 3])], "feed string, n int, v int")
    assert [r["stuck"] for r in quality.stuck_cycles(grown, "v", "n", ["feed"]).orderBy("n").collect()] == [0, 1, 2, 0, 1, 0]


@pytest.mark.parametrize("rows_a_range", [10**6, 40, 9])
def test_feeds_are_cut(spark, monkeypatch, rows_a_range):
    """Against plain loops: one feed with most rows, a null feed, short feeds, sizes and marks that are null, runs across many ranges."""
    monkeypatch.setattr(segments, "SEGMENT", rows_a_range)
    rnd = random.Random(rows_a_range)
    rows = [(rnd.choice(["big"] * 8 + ["b", None]) if i < 390 else f"one{i}", i, rnd.choice([1, 1, 1, 2, 3, None]) if i % 100 < 60 else 5, rnd.choice([True] * 7 + [False, None])) for i in range(400)]
    df = spark.createDataFrame(rows, "feed string, n int, v int, past boolean")
    rnd.shuffle(rows)
    feeds = {}
    for r in sorted(rows, key=lambda r: r[1]):
        feeds.setdefault(r[0], []).append(r)
    stuck, falls = {}, {}
    for f, own in feeds.items():
        since, last = 0, None
        for k, (_, n, v, _p) in enumerate(own):
            since = 0 if k == 0 or v is None or last is None or v > last else since + 1
            stuck[n], last = since, v
        values = [v for _, _, v, _p in own if v is not None]
        falls[f] = (len(values), sum(b < a for a, b in zip(values, values[1:])))
    assert {r["n"]: r["stuck"] for r in quality.stuck_cycles(df, "v", "n", ["feed"]).collect()} == stuck
    got = {r["feed"]: (r["n"], r["falls"]) for r in segments.falls(df, "v", "n", ["feed"]).collect()}
    assert got == {f: x for f, x in falls.items() if x[0]}
    for k in (1, 3, 14):
        want = {}
        for f, own in feeds.items():
            run = 0
            for _, n, _, p in own:
                run = run + 1 if p else 0
                if run == k:
                    want[f] = n
                    break
        assert {r["feed"]: r["stops_at"] for r in quality.streak_stop(df, F.col("past"), "n", ["feed"], k).collect()} == want
    assert quality.stuck_cycles(df.limit(0), "v", "n", ["feed"]).count() == 0 == quality.streak_stop(df.limit(0), F.col("past"), "n", ["feed"], 2).count()


PASSING = {"n": 100, "invalid": 0, "empty_bodies": 0, "repeats": 90, "near_clamp": 5, "ages": 100, "inversions": 10}


@pytest.mark.parametrize(
    ("change", "gate"),
    [
        ({}, None),
        ({"n": 0, "repeats": 0, "near_clamp": 0}, "no_rows"),
        ({"invalid": 1}, "invalid_rows"),
        ({"empty_bodies": 1}, "empty_rows"),
        ({"repeats": 91}, "repeating"),
        ({"n": 19, "repeats": 19, "near_clamp": 3}, None),
        ({"near_clamp": 6}, "clamped"),
        ({"n": 40, "repeats": 0, "near_clamp": 4}, "clamped"),
        ({"inversions": 11}, "disordered"),
        ({"ages": 19, "inversions": 19}, None),
    ],
)
def test_gates(spark, change, gate):
    given = PASSING | change
    got = quality.gates(spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} long" for k in given))).first()
    assert [g for g in ("no_rows", "invalid_rows", "empty_rows", "repeating", "clamped", "disordered") if got[g]] == ([gate] if gate else [])
    assert got["passed"] == (gate is None)


def test_nodes():
    rows = nodes_of('<!-- c --><ul><li>a<li>b<p>x<p>y</ul><script>1<2</script><br/>&amp;<i>z').to_pylist()
    assert [(r["depth"], r["tag"], r["text"]) for r in rows] == [
        (0, "#root", None), (1, "ul", None), (2, "li", None), (3, "#text", "a"), (2, "li", None), (3, "#text", "b"), (3, "p", None), (4, "#text", "x"), (3, "p", None), (4, "#text", "y"),
        (1, "script", None), (1, "br", None), (1, "#text", "&"), (1, "i", None), (2, "#text", "z"),
    ]
    for r in rows:
        below = [x for x in rows if r["pre"] <= x["pre"] < r["post"]]
        assert all(x["depth"] > r["depth"] for x in below[1:]) and (r["parent"] is None or rows[r["parent"]]["post"] >= r["post"] and rows[r["parent"]]["depth"] == r["depth"] - 1)
    assert nodes_of(None).num_rows == 1


def test_references_without_semicolon():
    page = '<h1 title="a&amp;b&copy=2">x&amp;&amp;&amp</h1>&#38;&#x26;&quot &nope;&ampx;&am'
    shown = lambda *how: [r["text"] or dict(r["attrs"]).get("title") for r in nodes_of(page, *how).to_pylist()[1:]]
    assert shown() == ["a&b©=2", "x&&&", '&&" &nope;&x;&am']
    assert shown(closed_references) == ["a&b&copy=2", "x&&&amp", "&&&quot &nope;&ampx;&am"]


def test_page_queries_with_cut_references(spark, tmp_path):
    """A title that was cut within a reference is shown as the SQL of both queries shows it."""
    import duckdb

    from millrace.plans import queries

    html = "<html><h1>a&amp;b &quot;c&quot; d&amp;&amp</h1><p>&lt;e&amp;gt; &copy</p></html>"
    spark.createDataFrame([(1, "u", html), (2, "u", "<h1>x&am</h1>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    for name in ("flatten_page", "page_titles"):
        assert sorted(map(tuple, queries.QUERIES[name](spark, str(tmp_path)).collect())) == sorted(con.sql(queries.ORACLE[name]).fetchall())


def test_nodes_of_odd_pages():
    shown = lambda page: [(r["tag"], dict(r["attrs"]), r["text"]) for r in nodes_of(page).to_pylist()[1:]]
    assert shown("<a href=\"x>y\" B='q' c=d/e f>t</a x>1 < 2 &lt; </ z>w<IMG src=a/>e<a \"b") == [("a", {"href": "x>y", "b": "q", "c": "d/e", "f": ""}, None), ("#text", {}, "t"), ("#text", {}, "1 < 2 < w"), ("img", {"src": "a/"}, None), ("#text", {}, 'e<a "b')]
    assert shown('<p a="1" a="2">x<!-- > --><!-->y<!DOCTYPE z><?q?>w') == [("p", {"a": "2"}, None), ("#text", {}, "xyw")]
    assert shown('<b x="y>z<i>') == [("b", {"x": '"y'}, None), ("#text", {}, "z"), ("i", {}, None)]  # a quote that isn't closed is none
    assert shown("a</b>c</p>") == [("#text", {}, "a"), ("#text", {}, "c")]
    assert shown("<script>var a = '<p>';</SCRIPT >b<style>c") == [("script", {}, None), ("#text", {}, "b"), ("style", {}, None)]
    assert shown("<table><tr><td>1<table><tr><td>2</table><td>3") == [(t, {}, x) for t, x in [("table", None), ("tr", None), ("td", None), ("#text", "1"), ("table", None), ("tr", None), ("td", None), ("#text", "2"), ("td", None), ("#text", "3")]]


@pytest.mark.parametrize("piece", ["<a ", "<div>", "<b>", "<p>x", '<a x="', '<a x="<a y=\'', "<", "<script>", "<!--", "</b", "<ul><li>", "<table><td>", "<div></p>", "&am", "<a/ "])
@pytest.mark.parametrize("tail", ["", '">'])
def test_hostile_pages_take_linear_time(piece, tail):
    """Eight times the page takes about eight times the time, where a quadratic reader takes sixty-four times."""

    def took(size):
        page = piece * (size // len(piece)) + tail
        best = 9e9
        for _ in range(3):
            began = time.process_time()
            nodes_of(page)
            best = min(best, time.process_time() - began)
        return best

    small, large = took(40_000), took(320_000)
    assert large < 25 * small + 0.05


BLOCK = '<div><div><a href="{liker}">Liker</a> likes this</div><div><div><a href="/in/x"></a><a href="{url}">{name} • 2nd</a></div><span>{age}</span></div><button aria-label="{label}"></button><p>{body}</p></div>'


@pytest.fixture(scope="module")
def feed(spark):
    me, hers = "https://www.linkedin.com/in/ann?x=1", "https://www.linkedin.com/company/co?y"
    menu = "Open control menu for post"
    block = lambda **k: BLOCK.format(**({"liker": "https://www.linkedin.com/in/liker", "url": me, "name": "Ann Lee", "label": menu, "age": "3h •", "body": "Hello there"} | k))
    blocks = [
        block(label=menu + " by Ann  Lee", body="First text 27 reactionsAndela"),
        block(url=hers, name="Co"),
        block(age="3,321 followersPromoted"),
        block(age="new"),
        block(age="502h •"),
        block(body="12 reactions", label=menu + " by Ann Lee"),
        f'<div><span>1d •</span><button aria-label="{menu}"></button>no links at all</div>',
    ]
    pages = [("one", "<main>" + "".join(blocks) + "</main>"), ("sole", "<body><i>x</i>" + blocks[0] + "</body>"), ("none", "<p>nothing"), ("null", None)]
    return spark.createDataFrame([(p, h, dt.datetime(2024, 3, 2)) for p, h in pages], "page string, html string, captured_at timestamp")


def test_posts(feed):
    rows = parsing.parse(feed).orderBy("page", "ordinal").collect()
    assert [r["outcome"] for r in rows if r["page"] == "one"] == ["record", "record", "ads", "no_age", "rejected_post_relative_age", "rejected_text", "no_author"]
    a, b = rows[0], rows[1]
    assert (a["author_profile_url"], a["author_name"], a["author_route"]) == ("https://www.linkedin.com/in/ann", "Ann Lee", "label")
    assert (b["author_profile_url"], b["author_name"], b["author_route"]) == ("https://www.linkedin.com/company/co", "Co", "walk")
    assert a["text"].startswith("First text") and "reactions" not in a["text"]
    assert a["post_time_iso"] == dt.datetime(2024, 3, 1, 21)
    assert [r["outcome"] for r in rows if r["page"] == "sole"] == ["record"] and not [r for r in rows if r["page"] in ("none", "null")]
    report = tree.parse_report(parsing.parse(feed)).first().asDict()
    assert report == {"containers": 8, "ads": 1, "no_age": 1, "no_author": 1, "author_by_label": 3, "author_by_walk": 2, "rejected": 2, "records": 3}
    assert {r["bucket"]: r["n"] for r in tree.rejected(parsing.parse(feed)).collect()} == {"rejected_post_relative_age": 1, "rejected_text": 1}


def test_containers(spark, feed):
    nodes = html_nodes(feed, "html", "page")
    mark = tree.has_prefix(tree.MARKER_TAG, tree.MARKER_ATTR, tree.MARKER_PREFIX)
    tops = tree.containers(nodes, mark).collect()
    assert {r["container"] for r in tops if r["page"] == "sole"} == {0}
    assert len({r["container"] for r in tops if r["page"] == "one"}) == 7
    assert tree.owners(nodes, mark).where("page = 'one' AND ancestor = 0").first()["owns"] == 7


def random_pages(spark):
    rnd = random.Random(8)
    pieces = ["<div>", "<div>", "</div>", "<span>", "</span>", "<a href='/in/x'>", "</a>", "<i>", "</i>", "a b", " ", "c  d", "\n", "<p>", "é"]
    pages = [(f"p{i % 30}", "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 80)))) for i in range(40)] + [("null", None), ("deep", "<div>" * 500 + "x" + "<a href=/in/y>" * 300)]
    return html_nodes(spark.createDataFrame(pages, "page string, html string").repartition(3), "html", "page").persist()


def by_page(nodes):
    out = {}
    for r in nodes.orderBy("row", "pre").collect():
        out.setdefault(r["row"], []).append(r)
    return out


def test_structure_against_brute_force(spark, monkeypatch):
    """Ancestors, owners, containers, flattened and shown texts of random pages, against comparing all nodes of a page."""
    nodes = random_pages(spark)
    link, pages = tree.has_prefix("a", "href", "/in"), by_page(nodes)
    is_link = lambda r: r["tag"] == "a" and r["attrs"].get("href", "").startswith("/in")
    above, owned, held, flat = set(), set(), set(), set()
    for row, of in pages.items():
        owns = [sum(is_link(y) for y in of[x["pre"] : x["post"]]) for x in of]
        for x in of:
            up = [y for y in of if y["pre"] <= x["pre"] < y["post"]]
            if is_link(x):
                above |= {(row, x["pre"], y["pre"]) for y in up}
                top = next((y for y in up if owns[y["pre"]] == 1), None)
                held |= {(row, x["pre"], top["pre"], top["tag"])} if top else set()
            if owns[x["pre"]]:
                owned.add((row, x["pre"], owns[x["pre"]]))
            if x["tag"] in ("div", "span"):
                flat.add((row, x["pre"], " ".join("".join(y["text"] or "" for y in of[x["pre"] : x["post"]]).split())))
    rows = lambda df, *c: {tuple(r[x] for x in ("row", *c)) for r in df.collect()}
    assert rows(tree.ancestors(nodes, link), "pre", "ancestor") == above and above
    assert rows(tree.owners(nodes, link), "ancestor", "owns") == owned
    assert rows(tree.containers(nodes, link), "marker", "container", "tag") == held and held
    assert rows(tree.flattened(nodes, F.col("tag").isin("div", "span")), "top", "flat") == flat and flat
    got = structure.contained(nodes, F.col("pre") == 0, F.when(F.col("tag").isin("div", "span"), 10**6), F.col("tag") == "span")
    assert {x for x in rows(got, "pre", "shown") if x[2] is not None} == flat
    spans = got.where("tag = 'span'").collect()
    for r in spans:
        ups, of = [], pages[r["row"]]
        x = of[r["pre"]]
        while x["parent"] is not None and len(ups) < 8:
            x = of[x["parent"]]
            ups.append((x["pre"], x["post"]))
        assert [(u["pre"], u["post"]) for u in r["ups"]] == ups
    assert {len(r["shown"].replace(" ", "")) for r in structure.contained(nodes, F.col("pre") == 0, F.lit(3), F.lit(False)).collect()} <= {0, 1, 2, 3, 4, 5, 6}


def test_structure_needs_whole_pages(spark):
    nodes = random_pages(spark)
    with pytest.raises(Exception, match="together and in order"):
        tree.owners(nodes.where("pre > 0"), F.lit(True)).collect()
    mixed = structure.together(nodes.repartition(5, "pre"))
    assert sorted(map(str, tree.owners(mixed, F.col("tag") == "a").collect())) == sorted(map(str, tree.owners(nodes, F.col("tag") == "a").collect()))
    assert tree.owners(nodes.limit(0), F.lit(True)).count() == 0


def test_repeated_page_ids_are_two_pages(spark, feed):
    twice = feed.where("page IN ('one', 'sole')").unionByName(feed.where("page = 'one'"))
    assert sorted(r["outcome"] for r in parsing.parse(twice).where("page = 'one'").collect()) == sorted(2 * [r["outcome"] for r in parsing.parse(feed).where("page = 'one'").collect()])
    one = spark.createDataFrame([("p", "<div><a href=/in/x>n</a></div>")] * 2, "page string, html string")
    nodes = html_nodes(one, "html", "page")
    tops = tree.containers(nodes, tree.has_prefix("a", "href", "/in"))
    assert [(r["page"], r["container"]) for r in tops.collect()] == [("p", 0)] * 2


def test_first_failures(spark):
    rows = spark.createDataFrame([(i, f"r{i}" if i % 3 == 1 else None) for i in range(20)], "n int, rule string")
    assert parsing.first_failures(rows, F.col("rule"), ["n"]).first()["failures"] == ["r1", "r4", "r7"]
    assert parsing.first_failures(rows.limit(1), F.col("rule"), ["n"]).first()["failures"] == []


def test_run_and_gate(spark, feed, tmp_path):
    table = str(tmp_path / "history")
    report, n = parsing.run(feed, None, table, "2024-03-02T00-00-00Z")
    assert report["passed"] and report["n"] == 3 and n == 2  # one post is on two pages
    history = spark.read.parquet(table)
    assert parsing.run(feed, history, table, "2024-03-03T00-00-00Z")[1] == 0
    assert parsing.run(feed, None, table, "x", report_only=True)[1] == 0
    assert report["missing_field"] == 0 and report["failures"] == []
    again = spark.read.parquet(table).where("run_ts = '2024-03-02T00-00-00Z'").drop("run_ts")
    assert files.append_run(spark.createDataFrame(again.collect(), again.schema), table, "2024-03-02T00-00-00Z") == 2
    assert spark.read.parquet(table).count() == 2  # the same stamp replaces its own rows
    with pytest.raises(parsing.BatchRejected, match="no_rows"):
        parsing.run(feed.where("page = 'none'"), None, table, "x")


def test_files(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p/a.html").write_bytes(b"<p>ok \xff</p>")
    (tmp_path / "p/b.txt").write_text("no")
    page = files.scan_pages(spark, str(tmp_path / "p")).first()
    assert page["html"] == "<p>ok �</p>" and page["page"].endswith("a.html")
    pages = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 3))], "page string, captured_at timestamp")
    assert files.newest(pages).first()["page"] == "b"
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    left = lambda runs: [r["page"] for r in files.unprocessed(pages, runs).orderBy("page").collect()]
    assert left(names("posts_2024-01-02T00-00-00Z.jsonl", "posts_2023-01-02T00-00-00Z.jsonl")) == ["b"]
    assert left(names("posts_zzz.jsonl")) == left(names()) == ["a", "b"]
    assert files.fresh(pages, F.lit(dt.datetime(2024, 1, 3, 0, 30))).count() == 1


def test_json_lines(spark, tmp_path):
    path = tmp_path / "posts_2024-01-01T00-00-00Z.jsonl"
    rows = [{"text": "é", "author_name": None}, {"text": "b", "text2": 1}]
    path.write_text("\n\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n  \n", encoding="utf-8")
    got = files.json_lines(spark, str(path), files.POST).orderBy("ordinal").collect()
    assert [r["text"] for r in got] == ["é", "b"] and got[0]["ordinal"] < got[1]["ordinal"]
    missing = files.json_lines(spark, str(path), files.POST).select(files.missing_keys(POST_FIELDS)).collect()
    assert all(r[0] for r in missing)
    assert files.history(spark, str(tmp_path)).count() == 2
    assert files.history(spark, str(tmp_path / "none")).count() == 0 == files.json_lines(spark, str(tmp_path / "none.jsonl"), files.POST).count()
    path.write_text("{broken\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        files.json_lines(spark, str(path), files.POST).collect()
    assert files.json_lines(spark, str(path), files.POST, strict=False).first()["text"] is None
    out = str(tmp_path / "out")
    files.write_lines(spark.sql("SELECT 'é' AS a, cast(null AS string) AS b, timestamp'2024-01-01 00:00:00' AS t"), out)
    assert json.loads(next((tmp_path / "out").glob("*.json")).read_text(encoding="utf-8")) == {"a": "é", "b": None, "t": "2024-01-01T00:00:00Z"}


@pytest.mark.parametrize("few", [200_000, 0])
def test_lines_keep_their_order_in_small_splits(spark, tmp_path, monkeypatch, few):
    """Files in many splits (or one), with blank lines, lines longer than a split, carriage returns, no end of line at the end, and names that occur twice."""
    monkeypatch.setattr(files, "FEW_SPLITS", few)
    rnd, want = random.Random(2), {}
    for name in ("a/x.jsonl", "b/x.jsonl", "b/y.jsonl", "b/empty.jsonl"):
        lines = [rnd.choice(["", "é" * rnd.randint(0, 9), "w" * rnd.randint(0, 400), "r\r", str(i)]) for i in range(0 if "empty" in name else 300)]
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(("\n".join(lines) + ("\n" if "/y" in name else "")).encode())
        if lines and "/y" not in name and not lines[-1]:
            lines.pop()
        for i, line in enumerate(lines):
            want[name.split("/")[1], i, line] = want.get((name.split("/")[1], i, line), 0) + 1
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "1000", "50"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = files.ordered_lines(spark, str(tmp_path / "*"))
            assert size == "128m" or spark.read.text(str(tmp_path / "*")).rdd.getNumPartitions() > 10
            assert Counter((r["file"], r["ordinal"], r["line"]) for r in df.collect()) == Counter(want), size
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert files.ordered_lines(spark, str(tmp_path / "b/empty.jsonl")).count() == 0


def test_lines_are_judged(spark, tmp_path):
    good = {"channel": "abcde", "channel_title": None, "message_id": 7, "text": "hi", "posted_at": "2024-01-01T00:00:00Z", "scraped_at": "2024-01-02T00:00:00Z"}
    rows = [good, {k: v for k, v in good.items() if k != "channel_title"}, good | {"more": 1}, {k: v for k, v in good.items() if k != "text"}, good | {"message_id": 0}, good | {"posted_at": "2024-01-03T00:00:00Z"}, good | {"channel": "1x"}]
    (tmp_path / "m.jsonl").write_text("\n".join(map(json.dumps, rows)))
    got = files.message_lines(spark, str(tmp_path / "m.jsonl")).orderBy("ordinal").collect()
    assert [r["outcome"] for r in got] == ["record", "record", "extra", "missing", "message_id", "model", "channel"]
    assert got[0]["url"] == "https://t.me/abcde/7"
    post = {"author_profile_url": "https://www.linkedin.com/in/a", "author_name": "A", "text": "Hallo", "post_relative_age": "23h", "post_time_iso": "2024-03-01T00:00:00Z", "scraped_at": "2024-03-02T00:00:00Z"}
    (tmp_path / "p.jsonl").write_text("\n".join(map(json.dumps, [post, post | {"extra": 1}, post | {"text": "1"}, post | {"scraped_at": "then"}])))
    assert [r["outcome"] for r in files.post_lines(spark, str(tmp_path / "p.jsonl")).orderBy("ordinal").collect()] == ["record", "extra", "text", "scraped_at"]


def test_collected(spark):
    pages = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 3))], "page string, captured_at timestamp")
    late, soon = F.lit(dt.datetime(2024, 1, 3, 1)), F.lit(dt.datetime(2024, 1, 3, 0, 10))
    assert [r["page"] for r in files.collected(pages, soon).collect()] == ["b"]
    assert files.collected(pages, late).count() == 0 and files.collected(pages, late, force=True).count() == 1
    assert files.collected(pages.limit(0), late, force=True).count() == 0


def test_intermediate_tables_go(spark):
    from millrace.sources import shared

    df = shared.materialised(spark.range(3), "x")
    assert df.count() == 3
    path = df.inputFiles()[0]
    shared.discard(df)
    assert not spark._jvm.java.io.File(path.removeprefix("file:").replace("///", "/")).exists()


GIVEN = {k: 3 for k in config.INTEGERS} | {"pg_down_delay": [300.0, 800], "scroll_fraction": [0.6, 0.9]}


@pytest.mark.parametrize("change", [{"settle_ms": 0}, {"settle_ms": "x"}, {"pg_down_delay": [2, 1]}, {"pg_down_delay": [1]}, {"scroll_fraction": [0.5, 1.1]}, {"max_posts": None}, {"stuck_limit": True}, {"scroll_fraction": [0.5, "1"]}])
def test_config_refuses(change):
    with pytest.raises(config.ConfigError):
        config.AcquisitionConfig.of(GIVEN | change)


def test_config(tmp_path):
    line = json.loads(config.AcquisitionConfig.of(GIVEN).line(5))
    assert line["delayMs"] == [300, 800] and line["stopBeforeMs"] == 5 and len(line) == 12
    for bad in ("[1]", "{"):
        (tmp_path / "c.json").write_text(bad)
        with pytest.raises(config.ConfigError):
            config.read_json(str(tmp_path / "c.json"))
    with pytest.raises(config.ConfigError):
        config.AcquisitionConfig.read(str(tmp_path / "none.json"))
    with pytest.raises(config.ConfigError, match="settle_ms must be at least 1; max_posts is missing"):
        config.AcquisitionConfig.of({k: v for k, v in GIVEN.items() if k != "max_posts"} | {"settle_ms": 0})
    assert config.sources({"sources": {"a": "file", "b": {"file": {"group_urls": ["u"]}}}}) == [("a", "file", []), ("b", "file", ["u"])]


def test_envelope(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES (1, 0.9D), (2, 0.1D), (3, null) AS t(n, v)")
    scoring = F.when(F.col("v").isNotNull(), F.array(E.score("m", "job", F.col("v"))))
    now = F.lit(dt.datetime(2024, 1, 1))
    posts = rows.select("n", *E.envelope(F.lit("p"), F.lit("t"), [F.col("n")], F.lit("web/x"), F.lit("u"), now, F.lit("f"), F.lit('{"a": [1]}'), scoring=scoring))
    assert len({r["id"] for r in posts.collect()}) == 3
    assert [r["n"] for r in E.outbox(posts, posts.limit(0), "job", 0.5).collect()] == [1]
    assert E.outbox(posts, posts.select("id"), "job", 0.5).count() == 0
    table = str(tmp_path / "posts")
    for _ in range(2):
        E.write_posts(posts, table)
        assert posts.sparkSession.read.parquet(table).count() == 3
    got = posts.select(F.try_variant_get("metadata.platform_data", "$.a[0]", "int"), E.source_type(F.col("metadata.source.path")), "status.state", "metadata.schema_version").first()
    assert tuple(got) == (1, "web", "parsed", 1)


def test_stream(spark, tmp_path):
    inbox, table, checkpoint = (str(tmp_path / x) for x in ("in", "table", "cp"))

    def put(*rows):
        spark.createDataFrame(list(rows), "n int, text string").coalesce(1).write.mode("append").parquet(inbox)

    def once(gate=None):
        stream = spark.readStream.schema("n int, text string").parquet(inbox)
        prepare = lambda df: df.select("n", "text", dedup.letters_key(F.col("text")).alias("k"))
        ingest(stream, table, checkpoint, ["k"], ["n"], prepare, gate)
        return sorted(r["n"] for r in spark.read.parquet(table).collect())

    put((1, "a 1"), (2, "a 2"), (3, "b"))
    assert once() == [1, 3]
    put((4, "b!"), (5, "c"))

    def refuse(batch):
        raise ValueError("gate")

    with pytest.raises(Exception, match="gate"):
        once(refuse)
    assert once() == [1, 3, 5] == once()


@pytest.mark.parametrize("capacity", [100_000, 40])
def test_key_index(spark, tmp_path, capacity):
    """Against sets, with nulls, keys added twice, and (capacity 40) filters that are far too small."""
    rnd = random.Random(6)
    make = lambda n: [(rnd.choice(["a", "b", None]), rnd.choice([f"k{rnd.randint(0, 3000)}", "é", "", None]) if i % 9 else f"k{i}", i) for i in range(n)]
    index = KeyIndex(spark, str(tmp_path / f"i{capacity}"), {"a": "string", "b": "string"}, capacity, 4)
    batch = make(500)
    df = spark.createDataFrame(batch, "a string, b string, n int")
    assert index.known(df) is None and index.unseen(df).count() == 500
    have = set()
    for _ in range(3):
        old = make(300)
        have |= {r[:2] for r in old}
        index.add(spark.createDataFrame(old + old[:50], "a string, b string, n int"))
    assert {tuple(r) for r in index.unseen(df).collect()} == {r for r in batch if r[:2] not in have}
    assert {tuple(r) for r in index.known(df).collect()} == {r[:2] for r in batch} & have
    assert index.unseen(df.limit(0)).count() == 0


def test_key_index_reads_only_what_may_be_hit(spark, tmp_path):
    """Keys read fall with the batch; a batch of new keys reads next to none, and what filters let through is about one in a hundred."""
    index = KeyIndex(spark, str(tmp_path / "i"), {"k": "long"}, 20_000, 32)
    index.add(spark.range(20_000).select(F.col("id").alias("k")))
    assert index.known(spark.range(10**6, 10**6 + 3).select(F.col("id").alias("k"))) is None
    passed = index.maybe(spark.range(10**6, 10**6 + 20_000).select(F.col("id").alias("k"))).count()
    assert passed < 800
    assert index.maybe(spark.range(20_000).select(F.col("id").alias("k"))).count() == 20_000  # none is missed
    few = index._stored("keys").where(F.col("_bucket").isin([r[0] for r in index.maybe(spark.range(3).select(F.col("id").alias("k"))).select("_bucket").distinct().collect()]))
    assert few.count() < 3 * 20_000 / 32 * 1.5


def test_index_catches_up(spark, tmp_path):
    """A run that wrote the history but not the index is made good at the next begin; one that wrote neither changes nothing."""
    table = str(tmp_path / "t")
    index = KeyIndex(spark, str(tmp_path / "i"), {"k": "long"}, buckets=4)
    ids = lambda a, b: spark.range(a, b).select(F.col("id").alias("k"))
    index.begin(None)
    ids(0, 10).write.parquet(table)
    assert index.known(ids(0, 10)) is None
    index.begin(spark.read.parquet(table))
    assert index.unseen(ids(5, 15)).count() == 5
    index.end()
    index.begin(spark.read.parquet(table))
    index.end()
    assert index.unseen(ids(5, 15)).count() == 5


def test_stateful_keep_first(spark, tmp_path):
    """Late and repeated rows, a null key, a hot key, history as first state, and a restart that reads files it hasn't read only."""
    inbox, table, checkpoint = (str(tmp_path / x) for x in ("in", "table", "cp"))
    schema = "n int, k string, t string"
    old = spark.createDataFrame([("old",)], "k string")

    def put(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)

    def once():
        q = ingest_first(spark.readStream.schema(schema).parquet(inbox), table, checkpoint, ["k"], ["n"], old)
        read = sum(p["numInputRows"] for p in q.recentProgress)
        return sorted((r["n"], r["k"]) for r in spark.read.parquet(table).collect()), read

    put([(n, "hot", "x") for n in range(3000, 0, -1)] + [(7, None, "y"), (5, None, "y"), (6, "old", "z"), (None, "b", "x"), (9, "b", "x")])
    want = [(1, "hot"), (5, None), (9, "b")]
    assert once() == (want, 3005)
    put([(0, "hot", "late"), (0, None, "late"), (4, "c", "new"), (4, "c", "new"), (1, "old", "late")])
    assert once() == (sorted(want + [(4, "c")]), 5)
    assert once()[0] == sorted(want + [(4, "c")])  # nothing new


def test_stateful_buckets(spark, tmp_path, monkeypatch):
    """Groups with very many keys, in several Arrow batches, on keys of two columns with nulls; long numbers beside null ones stay exact."""
    monkeypatch.setattr(stateful, "BUCKETS", 3, raising=False)
    inbox, table, checkpoint = (str(tmp_path / x) for x in ("in", "table", "cp"))
    schema = "n long, k long, t timestamp"
    rnd, far = random.Random(4), 2**60
    when = lambda i: None if i % 7 == 0 else dt.datetime(2024, 1, 1, 0, 0, 0, i % 3)
    rows = [(None if i % 11 == 0 else far + i, rnd.choice([None, *range(far, far + 700)]), when(rnd.randrange(50))) for i in range(9000)]
    old = sorted({r[1:] for r in rows if r[1] is not None and r[1] % 5 == 0}, key=str)
    history = spark.createDataFrame(old, "k long, t timestamp")
    want, seen = [], set(old)
    for part in (rows[:6000], rows[6000:], []):
        if part:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(inbox)
        ingest_first(spark.readStream.schema(schema).parquet(inbox), table, checkpoint, ["k", "t"], ["n"], history)
        for r in sorted(part, key=lambda r: (r[0] is None, r[0] or 0)):
            if r[1:] not in seen:
                seen.add(r[1:])
                want.append(r)
        assert sorted((tuple(r) for r in spark.read.parquet(table).collect()), key=str) == sorted(want, key=str)
    assert len(want) > 1000


def test_unknown_keys_at_any_depth(spark, tmp_path):
    good = {"id": "p:1", "platform": "p", "text": "t", "status": {"state": "sent"}, "scoring": [], "metadata": {"source": {"path": "p/x"}, "platform_data": {"any": {"thing": [1]}}}}
    scored = [{"model_name": "m", "task": "t", "value": 1.0}, {"model_name": "m", "x.y": 2}, {"x.y": 1}, 3, None]
    cases = [
        (json.dumps(good), [], "record"),
        (json.dumps(good | {"a": 1, "status": {"state": "sent", "b": 2}}), ["a", "status.b"], "extra"),
        (json.dumps(good | {"scoring": scored}), ["scoring[].x.y"], "extra"),
        (json.dumps(good | {"metadata": {"source": {"path": "p", "q": {"r": 1}}, "s": None}}), ["metadata.s", "metadata.source.q"], "extra"),
        (json.dumps(good | {"status": "sent"}), [], "status"),
        ("[1, 2]", None, "json"), ('{"id": ', None, "json"), ("null", None, "json"), ('{"id": 1, "id": 2}', None, "json"), ("{}", [], "id"),
    ]
    (tmp_path / "p.jsonl").write_text("\n\n".join(c[0] for c in cases))
    got = E.post_lines(spark, str(tmp_path / "p.jsonl")).orderBy("ordinal").collect()
    assert [(r["unknown"] and sorted(r["unknown"]) if r["unknown"] is not None else None, r["outcome"]) for r in got] == [c[1:] for c in cases]


def test_status_log(spark, tmp_path):
    """Runs repeated, killed before their commit, in a race, and with a state that isn't known."""
    log = status.StatusLog(spark, str(tmp_path / "log"))
    rows = lambda *r: spark.createDataFrame(list(r), "id string, state string")
    now = lambda: {r["id"]: r["state"] for r in log.latest().collect()}
    assert now() == {}
    for _ in range(2):
        assert log.append(lambda _: rows(("a", "sent"), ("a", "parsed"), ("b", "scored")), "one").count() == 3
    assert now() == {"a": "sent", "b": "scored"} and len(log.commits()) == 1
    with pytest.raises(Exception, match="no state: lost"):
        log.append(lambda _: rows(("a", "parsed"), ("c", "lost")), "two")
    rows(("z", "sent")).withColumn("version", F.lit(2)).write.parquet(str(tmp_path / "log/changes/killed"))
    assert now() == {"a": "sent", "b": "scored"}
    seen = []

    def slow(latest):
        seen.append(latest.count())
        if len(seen) == 1:
            log.append(lambda _: rows(("c", "parsed"), ("b", "irrelevant")), "faster")
        return rows(("d", "scored"))

    log.append(slow, "slower")
    assert seen == [2, 3] and [c.run for c in log.commits()] == ["one", "faster", "slower"]
    assert now() == {"a": "sent", "b": "irrelevant", "c": "parsed", "d": "scored"}
    assert log.append(lambda _: rows(), "empty").count() == 0 and now()["d"] == "scored"


def test_ranges_against_sets():
    rnd = random.Random(3)
    for _ in range(300):
        a, b = (channels.union([[x, x + rnd.randrange(6)] for x in (rnd.randrange(40) for _ in range(rnd.randrange(6)))]) for _ in range(2))
        numbers = lambda ranges: [n for low, high in ranges for n in range(low, high + 1)]
        assert numbers(channels.minus(a, b)) == sorted(set(numbers(a)) - set(numbers(b)))
        assert numbers(channels.union(a + b)) == sorted(set(numbers(a)) | set(numbers(b)))


def test_channel_archive(spark, tmp_path):
    archive, table, checkpoint = (str(tmp_path / x) for x in ("a", "t", "c"))
    message = "channel string, channel_title string, message_id long, text string, posted_at string, scraped_at string"

    def put(numbers, text, per_file, channel="news/1"):
        rows = [(channel, None, n, text, None, "2024") for n in numbers] + [(None, None, 1, "none", None, None), (channel, None, None, "none", None, None)]
        channels.export(spark.createDataFrame(rows, message), archive, per_file)

    def run():
        stream = channels.stream_archive(spark, archive).select("channel", "message_id", "text")
        stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema("channel string, message_id long, text string").parquet(table).collect())

    assert channels.read_archive(spark, str(tmp_path / "no")).count() == 0
    put([10, 11, 12, 12, 25], "one", 10)
    first = [("news/1", n, "one") for n in (10, 11, 12, 25)]
    assert run() == first == run()
    put(range(8, 15), "two", 100)  # overlaps, with numbers before and after
    second = sorted(first + [("news/1", n, "two") for n in (8, 9, 13, 14)])
    assert run() == second == run()
    put([5], "late\n\"line\" é", 10, "other")
    assert run() == sorted([*second, ("other", 5, "late\n\"line\" é")])
    batch = channels.read_archive(spark, archive)
    assert batch.count() == 9 and batch.where("channel = 'other'").first()["text"] == "late\n\"line\" é"
    assert sorted(r["message_id"] for r in batch.where("channel = 'news/1' and message_id > 9 and message_id <= 13").collect()) == [10, 11, 12, 13]
    assert batch.where("channel = 'news/1' and message_id in (9, 25)").count() == 2 and batch.where("message_id > 9 and message_id < 9").count() == 0
    reader = channels.ArchiveReader(archive)
    left = list(reader.pushFilters([channels.EqualTo(("channel",), "news/1"), channels.GreaterThan(("message_id",), 20)]))
    assert len(left) == 1 and [p.path.rsplit("/", 1)[1] for p in reader.partitions()] == ["25-25.jsonl"]  # one file is opened of four


def test_archive_of_many_small_channels(spark, tmp_path, monkeypatch):
    """Tasks are as many as the bytes ask for, each channel in a file of its own notwithstanding."""
    archive = str(tmp_path / "a")
    rows = spark.range(900).selectExpr("concat('c', id % 300) AS channel", "'t' AS channel_title", "id AS message_id", "string(id) AS text", "string(null) AS posted_at", "string(null) AS scraped_at")
    channels.export(rows, archive, 300)
    tasks = channels.ArchiveReader(archive).partitions()
    assert sum(1 + len(t.rest) for t in tasks) == 900 and len(tasks) == 4  # 256 files a task
    assert channels.ArchiveStream(archive).partitions({}, channels.ArchiveStream(archive).latestOffset())[0].rest
    assert sorted((r["channel"], r["message_id"], r["text"]) for r in channels.read_archive(spark, archive).collect()) == sorted((f"c{n % 300}", n, str(n)) for n in range(900))
    monkeypatch.setattr(channels, "TASK_BYTES", 1)  # no file is left out that is larger than a task
    assert len(channels.ArchiveReader(archive).partitions()) == 900


def test_report_while_saving(spark, posts):
    """Measures that are observed while rows are saved are those of the separate reports."""
    rows, df = posts
    keys = ["author_key", "body_key"]
    of = quality.measures("body_key", "text", F.when(F.col("text") == "two", "two"))
    first, told = quality.saved_first(df, keys, ["n"], of, "first")
    assert {r["n"] for r in first.collect()} == {min(r[0] for r in rows if key(r) == k) for k in set(map(key, rows))} and first.columns == df.columns
    want = quality.beside(quality.repeats(df, keys, "body_key"), quality.lengths(df)).first().asDict() | {"invalid": sum(r[2] == "two" for r in rows)}
    assert told.first().asDict() == want == quality.summary(df, keys, of).first().asDict()
    nothing = quality.saved_first(df.where("n < 0"), keys, ["n"], of, "first")
    assert nothing[0].count() == 0 and nothing[1].first()["n"] == 0 and nothing[1].first()["min_chars"] is None


def test_run_counts_authors_and_disorder(spark, tmp_path):
    t = dt.datetime(2024, 3, 1)
    rows = [("p", 0, i, url, "A", f"text {chr(97 + i % 5)}", age, t, t) for i, (url, age) in enumerate([("u1", "3h"), ("u1", "1h"), ("", None), (None, "2h"), ("u2", "1h"), ("u1", "3h")])]
    records = spark.createDataFrame(rows, "page string, row long, ordinal int, author_profile_url string, author_name string, text string, post_relative_age string, post_time_iso timestamp, scraped_at timestamp")
    first, told = parsing.saved(records)
    got = told.first()
    assert (got["n"], got["authors"], got["no_url"], got["ages"], got["inversions"], got["invalid"], got["missing_field"]) == (6, 4, 2, 5, 2, 6, 2)
    assert sorted(r["ordinal"] for r in first.collect()) == [0, 1, 2, 3, 4] and not got["passed"]
    assert parsing.saved(records.where("false"))[1].first()["no_rows"]
