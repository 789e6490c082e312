"""A corpus pipeline of five operators; each stage works on all that its predecessor kept.

toxicity (toxic documents go), near-duplicate join (one document of each group stays), suffix dedup (bytes
that an earlier document has go), decontamination (contaminated documents go), mixing (copies to take of
each document). All but the last return the columns of documents, and any others that docs has, whatever their names.

A null or empty text is not toxic, links to nothing, loses nothing and is taken 0 words; a null doc_id counts as
larger than any other and is its own group; a null source is one source, the last. Equal rows are one group, of
which the near-duplicate stage keeps all rows of the least doc_id. Texts are read whole, however long.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard, mixing, suffix_dedup, toxicity
from millrace.llm.common import table, written
from millrace.llm.queries import toxicity_fold


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns c0, c1, ..., which clash with no operator's own, and the new name of each old one."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names, strict=True))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar predicts to be toxic go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity_fold())
    rows, name = _numbered(docs)
    return toxicity.score_toxicity(rows, model, name["text"]).where("predicted = 0").select(*rows.columns).toDF(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link, directly or through others, the one of the least doc_id stays."""
    return jaccard.keep_one(docs, jaccard.join_similar(docs.select("doc_id", "text")))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes that a 50-byte string of an earlier document covers are cut; documents of which nothing but white space is left go, if something was cut. doc_ids are unique by now."""
    cut = suffix_dedup.find_repeats(docs.select("doc_id", "text"), with_text=True).where("n_removed > 0").select(F.col("doc_id").alias("_id"), "kept_text").dropDuplicates(["_id"])
    rows, name = _numbered(docs)
    out = rows.join(cut, rows[name["doc_id"]].eqNullSafe(cut["_id"]), "left").where(F.col("kept_text").isNull() | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*(F.coalesce(new[c], F.col(name[c])).alias(c) if c in new else F.col(name[c]).alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which 5% or more of the words lie in 13-word windows of the benchmark go."""
    found = decontaminate.find_contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    bad = found.where("contaminated").select(F.col("doc_id").alias("_bad"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken: how often each document is taken, so that sources near their targets."""
    return mixing.mix(docs.select("doc_id", "text", "source"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each_group),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: SQL can express neither the learned toxicity model nor the suffix arrays; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
