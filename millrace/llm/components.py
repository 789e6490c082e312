"""Connected components of a table of edges, by contraction: every node joins its least neighbour, and the trees so made become the nodes of the next round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _ends(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").distinct()


def _roots(both: DataFrame, i: int) -> DataFrame:
    """node, comp: the root of the tree that each node of the edges (in both directions) is in.

    With N(x) as x's least neighbour, N(N(x)) <= x, as x is a neighbour of N(x). So steps to N end in two nodes
    that name each other; the lesser of them is the root, and the least node of its tree. Every tree has two
    nodes at least, which halves the nodes of a round, and a pass of jumps halves the depth of all trees."""
    near = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")), f"near{i}")
    back = near.select(F.col("node").alias("near"), F.col("near").alias("back"))
    root = (F.col("back") == F.col("node")) & (F.col("node") < F.col("near"))
    trees = written(near.join(back, "near").select("node", F.when(root, F.col("node")).otherwise(F.col("near")).alias("comp")), f"trees{i}")
    while True:
        up = trees.select(F.col("node").alias("comp"), F.col("comp").alias("upper"))
        jumped = written(trees.join(up, "comp").select("node", F.col("upper").alias("comp"), (F.col("upper") != F.col("comp")).alias("moved")), f"trees{i}")
        trees = jumped.select("node", "comp")
        if jumped.where("moved").limit(1).count() == 0:
            return trees


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the least node that node is connected to): a row for each node of edges (a, b; in any order, perhaps repeated) that has another for a neighbour. Rounds go on until no edge joins two trees. Each is written to the shared folder, which cuts the lineage; nothing comes to the driver but counts."""
    both = written(_ends(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))), "edges")
    labels, i = _roots(both, 0), 0
    trees = labels
    while True:
        of = lambda x: trees.select(F.col("node").alias(x), F.col("comp").alias(f"of_{x}"))  # noqa: B023, E731
        both = written(_ends(both.join(of("a"), "a").join(of("b"), "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))), "edges")
        if both.limit(1).count() == 0:
            return labels
        i += 1
        trees = _roots(both, i)
        upper = trees.select(F.col("node").alias("comp"), F.col("comp").alias("upper"))
        labels = written(labels.join(upper, "comp", "left").select("node", F.coalesce("upper", "comp").alias("comp")), f"labels{i}")
