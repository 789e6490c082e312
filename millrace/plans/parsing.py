"""Pages to appended history: parse, judge, save; a batch that fails its gates is never saved."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ages import age_seconds
from ..functions.rules import POST_FIELDS, first_failure, post_rules
from ..operators import dedup, quality, tree
from ..operators.html_nodes import html_nodes
from ..sources.files import append_run
from ..sources.shared import discard

KEYS = ["author_key", "body_key"]


class BatchRejected(RuntimeError):
    """Names the gates that failed; carries counts only."""


def parse(pages: DataFrame) -> DataFrame:
    """pages (page, html, captured_at) to a row for each post, with its outcome. Pages are parsed once, and nodes read once."""
    return tree.posts(html_nodes(pages, "html", "page", ("captured_at",)))


def keyed(rows: DataFrame) -> DataFrame:
    return rows.select("*", *dedup.post_key(F.col("author_profile_url"), F.col("text")))


def batch_measures() -> list[quality.Measure]:
    """Counts, lengths, times and disorder of keyed records that have _seconds and _before, their age and the one before on the page."""
    c = F.col
    url = c("author_profile_url")
    return [
        *quality.measures("body_key", "text", first_failure(post_rules())),
        quality.counted("no_url", F.coalesce(url, F.lit("")) == ""),
        quality.counted("no_time", c("post_time_iso").isNull()),
        quality.counted("missing_field", reduce(lambda a, b: a | b, (c(f).isNull() for f in POST_FIELDS))),
        quality.least("oldest", c("post_time_iso")),
        quality.greatest("newest", c("post_time_iso")),
        quality.counted("ages", c("_seconds").isNotNull()),
        quality.counted("inversions", c("_seconds") < c("_before")),
        quality.counted("null_urls", url.isNull()),
        quality.counted("empty_urls", url == ""),
    ]


def saved(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first record of each key as a table, and one row: counts, lengths, times and gates of all records (with page, row and ordinal). Pages are read once for both; a page's posts are in one task as its nodes were."""
    earlier = Window.partitionBy("page", "row").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    rows = keyed(records).withColumn("_seconds", age_seconds(F.col("post_relative_age")))
    rows = rows.withColumn("_before", F.last("_seconds", ignorenulls=True).over(earlier))
    first, report = quality.saved_first(rows, KEYS, ["page", "row", "ordinal"], batch_measures(), "batch")
    # author_key is the url, a null one as an empty one
    others = first.select(F.nullif(F.col("author_key"), F.lit("")).alias("a")).agg(F.count_distinct("a").alias("named"))
    both = (F.col("null_urls") > 0).cast("int") + (F.col("empty_urls") > 0).cast("int")
    report = quality.beside(report, others).withColumn("authors", F.col("named") + both)
    return first.drop("_seconds", "_before"), quality.gates(report.drop("named", "null_urls", "empty_urls"))


def first_failures(rows: DataFrame, rule: Column, ordinal: list[str], n: int = 3) -> DataFrame:
    """One row: failures, the names of the rules that the first n failing rows broke. Each task sends n rows at most."""
    first = rows.select(F.struct(*ordinal).alias("at"), rule.alias("rule")).where("rule is not null").orderBy("at").limit(n)
    return first.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "rule"))), lambda x: x["rule"]).alias("failures"))


def run(pages: DataFrame, history: DataFrame | None, table: str, stamp: str, report_only: bool = False) -> tuple[dict, int]:
    """The whole run: the report as a dictionary, and how many records were appended. Records are saved and judged in one pass; a batch that fails isn't appended."""
    records = parse(pages).where("outcome = 'record'").drop("outcome", "author_route")
    first, judged = saved(records)
    try:
        report = judged.first().asDict() | {"failures": []}
        if report["invalid"]:  # only then are pages read again
            report["failures"] = first_failures(records, first_failure(post_rules()), ["page", "row", "ordinal"]).first()["failures"]
        if not report["passed"]:
            gates = ("no_rows", "invalid_rows", "empty_rows", "repeating", "clamped", "disordered")
            named = f" ({'; '.join(report['failures'])})" if report["failures"] else ""
            raise BatchRejected(", ".join(g for g in gates if report[g]) + named)
        if report_only:
            return report, 0
        new = dedup.against_history(first, history, KEYS) if history is not None else first
        return report, append_run(new.drop("row"), table, stamp)
    finally:
        discard(first)
