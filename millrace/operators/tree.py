"""Operators on node tables: selection, ancestors, containers, flattened text, and records of posts.

What lies in what comes from `structure`, one pass over nodes in page order; all else is filters and aggregates.
A page is known by its id and the number of its row (PAGE), so an id that occurs twice is two pages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ages
from ..functions import textops as X
from ..functions.rules import first_failure, post_rules
from .structure import HOPS, PAGE, contained, enclosed
from .structure import owners as owners_of

#: Fixed values of the feed's markup.
MARKER_TAG, MARKER_ATTR, MARKER_PREFIX = "button", "aria-label", "Open control menu for post"
LINK_PARTS = ("/in/", "/company/")
AGE_TAGS, AGE_TEXT, AGE_CHARS = ("span", "time"), r"\A([0-9]{1,3})([mhdw])(?U)\s*(?:•|\z)", 40
MAX_HOPS, NAME_CHARS = HOPS, 90
#: Characters of a link's text, and of an element that may show an age, that are looked at.
LINK_CHARS, SHORT_CHARS = 1000, AGE_CHARS + 1


def has_prefix(tag: str, attr: str, prefix: str) -> Column:
    """Whether a node is an element of a tag whose attribute starts with prefix."""
    return (F.col("tag") == tag) & F.coalesce(F.element_at("attrs", F.lit(attr)).startswith(prefix), F.lit(False))


def has_parts(tag: str, attr: str, parts: tuple[str, ...]) -> Column:
    """Whether a node is an element of a tag whose attribute contains one of parts."""
    value = F.element_at("attrs", F.lit(attr))
    return (F.col("tag") == tag) & F.coalesce(reduce(lambda a, b: a | b, (value.contains(p) for p in parts)), F.lit(False))


def with_prefix(nodes: DataFrame, tag: str, attr: str, prefix: str) -> DataFrame:
    return nodes.where(has_prefix(tag, attr, prefix))


def with_parts(nodes: DataFrame, tag: str, attr: str, parts: tuple[str, ...]) -> DataFrame:
    """Page order is the order of pre."""
    return nodes.where(has_parts(tag, attr, parts))


def ancestors(nodes: DataFrame, which: Column) -> DataFrame:
    """page, row, pre, ancestor: the nodes for which which holds, each with itself and all above it, up to the root."""
    return enclosed(nodes, F.lit(True), which).select(*PAGE, "pre", F.col("top").alias("ancestor"))


def owners(nodes: DataFrame, mark: Column) -> DataFrame:
    """page, row, ancestor, owns: how many marks lie at or below each node that has any."""
    return owners_of(nodes.select(*PAGE, "pre", "post", "parent", *_used(nodes)), mark).where("owns > 0").select(*PAGE, F.col("pre").alias("ancestor"), "owns")


def _used(nodes: DataFrame) -> list[str]:
    """What conditions may ask for."""
    return [c for c in nodes.columns if c not in (*PAGE, "pre", "post", "parent")]


def containers(nodes: DataFrame, mark: Column) -> DataFrame:
    """page, row, marker, container, tag (the container's): the highest node that owns one mark only. A page's only mark has the root."""
    inside = contained(nodes, mark, F.lit(0), F.lit(False))
    return inside.where("pre = container").select(*PAGE, "marker", "container", "tag")


def _joined(order: str, text: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct(order, text)))), lambda x: x[text]), "")


def flattened(nodes: DataFrame, tops: Column, name: str = "flat") -> DataFrame:
    """page, row, top and all text at or below it, in page order, without anything between nodes, white space collapsed: a row for each node for which tops holds. A text goes to every top above it."""
    inside = enclosed(nodes, tops, tops | (F.col("tag") == "#text")).where("tag = '#text' OR pre = top")
    return inside.groupBy(*PAGE, "top").agg(X.collapse(_joined("pre", "text")).alias(name))


def first_shown(nodes: DataFrame, tags: tuple[str, ...], keeps: Column, name: str = "shown") -> DataFrame:
    """page, row, name: the flattened text (column flat in keeps) of the first element of tags on a page that keeps holds for."""
    shown = flattened(nodes, F.col("tag").isin(*tags)).where(keeps)
    return shown.groupBy(*PAGE).agg(F.min_by("flat", "top").alias(name))


def _author_by_label(label: Column, found: Column) -> tuple[Column, Column]:
    """The url of the first link that shows the name in the marker's label, and the name; nulls if there is none."""
    pattern = rf"^{MARKER_PREFIX} by (.+)$"
    name = X.collapse(F.regexp_extract(label, pattern, 1))
    wanted = F.nullif(X.norm_name(name), F.lit(""))
    url = F.get(F.filter(found, lambda x: (x["href"] != "") & (x["norm"] == wanted)), F.lit(0))["href"]
    return url, F.when(url.isNotNull(), F.substring(name, 1, NAME_CHARS))


def _author_by_walk(ups: Column, container: Column, found: Column) -> tuple[Column, Column]:
    """From above the age, the nearest ancestor with a link, not above the container; there the first link with a short text, else the first. Its url and its text as a name; nulls if there is none."""
    inside = F.transform(F.filter(ups, lambda u: u["pre"] >= container), lambda u: F.filter(found, lambda x: (x["pre"] >= u["pre"]) & (x["pre"] < u["post"])))
    nearest = F.get(F.filter(inside, lambda links: F.size(links) > 0), F.lit(0))
    good = F.filter(nearest, lambda x: (F.length(x["shown"]) > 0) & (F.length(x["shown"]) < NAME_CHARS))
    pick = F.coalesce(F.get(good, F.lit(0)), F.get(nearest, F.lit(0)))
    url = F.nullif(pick["href"], F.lit(""))
    return url, F.when(url.isNotNull(), F.nullif(F.substring(X.without_degree(pick["shown"]), 1, NAME_CHARS), F.lit("")))


def posts(nodes: DataFrame, fold: bool = False) -> DataFrame:
    """A row for each marker of each page: the record's columns, author_route (label, walk) and outcome (record, ads, no_age, no_author, rejected_<rule>). nodes carry their page's captured_at.

    A structural pass gives each node its container; one aggregate by container then gathers its texts, links and first age. A post without an age is dropped, whatever the reason, before its author is sought. Of a link's text the first LINK_CHARS characters count."""
    link, marker = has_parts("a", "href", LINK_PARTS), has_prefix(MARKER_TAG, MARKER_ATTR, MARKER_PREFIX)
    aged = F.col("tag").isin(*AGE_TAGS)
    marks = nodes.select(
        *PAGE, "captured_at", "pre", "post", "parent", "text", marker.alias("marks"), aged.alias("ages"),
        F.when(link, X.without_query(F.element_at("attrs", F.lit("href")))).alias("href"), F.when(marker, F.element_at("attrs", F.lit(MARKER_ATTR))).alias("label"),
    )
    inside = contained(marks, F.col("marks"), F.when(F.col("href").isNotNull(), LINK_CHARS).when(F.col("ages"), SHORT_CHARS), F.col("ages"))
    inside = inside.where("text IS NOT NULL OR href IS NOT NULL OR ages OR pre = marker")
    shows_age = F.col("ages") & (F.length("shown") <= AGE_CHARS) & F.col("shown").rlike(AGE_TEXT)
    age = F.concat(F.regexp_extract("shown", AGE_TEXT, 1), F.regexp_extract("shown", AGE_TEXT, 2))
    whole = inside.groupBy(*PAGE, "container", "marker").agg(
        F.first("captured_at").alias("captured_at"), F.max(F.when(F.col("pre") == F.col("marker"), F.col("label"))).alias("label"), _joined("pre", "text").alias("flat"),
        F.array_sort(F.collect_list(F.when(F.col("href").isNotNull(), F.struct("pre", "href", "shown", X.norm_name(F.col("shown")).alias("norm"))))).alias("links"),
        F.min_by(F.struct(age.alias("age"), "ups"), F.when(shows_age, F.col("pre"))).alias("first"),
    )
    # min_by skips rows without an order, so first is null where no age is shown
    flat = X.collapse(F.col("flat"))
    rows = whole.withColumn("flat", X.clamp(X.fold_punctuation(flat) if fold else flat))
    u1, n1 = _author_by_label(F.col("label"), F.col("links"))
    u2, n2 = _author_by_walk(F.col("first.ups"), F.col("container"), F.col("links"))
    rows = rows.select(*PAGE, "marker", "captured_at", "flat", F.col("first.age").alias("age"), u1.alias("u1"), n1.alias("n1"), u2.alias("u2"), n2.alias("n2"))
    label = F.col("u1").isNotNull()
    rows = rows.select(
        *PAGE,
        F.col("marker").alias("ordinal"),
        F.when(label, F.col("u1")).otherwise(F.col("u2")).alias("author_profile_url"),
        F.when(label, F.col("n1")).otherwise(F.col("n2")).alias("author_name"),
        X.body_of(F.col("flat")).alias("text"),
        F.col("age").alias("post_relative_age"),
        ages.posted_at(F.col("captured_at"), F.col("age")).alias("post_time_iso"),
        F.col("captured_at").alias("scraped_at"),
        F.when(F.col("age").isNull(), None).when(label, "label").when(F.col("u2").isNotNull(), "walk").alias("author_route"),
        F.col("flat").contains("Promoted").alias("_ad"),
    )
    failed = first_failure(post_rules())
    outcome = (
        F.when(F.col("post_relative_age").isNull() & F.col("_ad"), "ads").when(F.col("post_relative_age").isNull(), "no_age").when(F.col("author_profile_url").isNull(), "no_author")
        .when(failed.isNotNull(), F.concat(F.lit("rejected_"), failed)).otherwise("record")
    )
    return rows.withColumn("outcome", outcome).drop("_ad")


def parse_report(rows: DataFrame) -> DataFrame:
    """One row of counters over posts()."""
    o = F.col("outcome")
    return rows.agg(
        F.count("*").alias("containers"), F.count_if(o == "ads").alias("ads"), F.count_if(o == "no_age").alias("no_age"), F.count_if(o == "no_author").alias("no_author"),
        F.count_if(F.col("author_route") == "label").alias("author_by_label"), F.count_if(F.col("author_route") == "walk").alias("author_by_walk"),
        F.count_if(o.startswith("rejected_")).alias("rejected"), F.count_if(o == "record").alias("records"),
    )


def rejected(rows: DataFrame) -> DataFrame:
    """bucket, n: rejected posts by the rule that they broke first."""
    return rows.where(F.col("outcome").startswith("rejected_")).groupBy(F.col("outcome").alias("bucket")).agg(F.count("*").alias("n"))
