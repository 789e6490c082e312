"""Structure of pages from node intervals: which nodes lie in which, found in one pass over nodes in page order.

Node d lies at or below node a if a.pre <= d.pre < a.post, so with a page's nodes in order every question about a subtree
is one about a run of rows: two searches in sorted numbers, no paths and no comparison of all pairs. Nodes arrive as
`html_nodes` gives them, a page's together and in order (others: `together`), and pages are worked on some at a
time; a page that is not whole or out of order is refused. What is found is columns of the nodes, on which filters, joins
and aggregates go on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workers import bounded_batches, give_back

#: What tells pages apart.
PAGE = ("page", "row")
#: Nodes that are worked on at once and their bytes, or those of one page if it has more.
NODES, BYTES = 20_000, 4 << 20
HOPS = 8


def together(nodes: DataFrame) -> DataFrame:
    """Any nodes, with those of a page together and in order: one shuffle."""
    return nodes.repartition("row").sortWithinPartitions("row", "pre")


class Pages:
    """Nodes of whole pages, one after another; all numbers are places in them."""

    def __init__(self, nodes: pa.Table):
        self.nodes, n = nodes, nodes.num_rows
        self.pre, post, parent = (nodes.column(c).to_numpy() for c in ("pre", "post", "parent"))
        self.at = np.arange(n)
        self.end = self.at + post - self.pre
        self.up = np.where(self.pre == 0, -1, self.at + np.nan_to_num(parent.astype(float)).astype(np.int64) - self.pre)
        starts = np.flatnonzero(self.pre == 0)
        if n and (len(starts) == 0 or starts[0] != 0 or not np.array_equal(self.pre, self.at - np.repeat(starts, np.diff([*starts, n]))) or not np.array_equal(self.end[starts], [*starts[1:], n])):
            raise ValueError("the nodes of a page must be all there, together and in order")

    def flag(self, column: str) -> np.ndarray:
        return self.nodes.column(column).fill_null(False).to_numpy().astype(bool)

    def owns(self, marks: np.ndarray) -> np.ndarray:
        """How many marks lie at or below each node."""
        upto = np.concatenate(([0], np.cumsum(marks)))
        return upto[self.end] - upto[self.at]

    def containers(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each node the container that it lies in and its mark (-1: none): the highest node with one mark only. Containers don't overlap."""
        owns = self.owns(marks)
        tops = np.flatnonzero((owns == 1) & ((self.up < 0) | (owns[self.up] != 1)))
        if not len(tops):
            return np.full(len(self.at), -1), np.full(len(self.at), -1)
        last = np.searchsorted(tops, self.at, "right") - 1
        inside = (last >= 0) & (self.at < self.end[tops[last]])
        marked = np.flatnonzero(marks)
        mark = marked[np.minimum(np.searchsorted(marked, tops), len(marked) - 1)]
        return np.where(inside, tops[last], -1), np.where(inside, mark[last], -1)

    def shown(self, limits: np.ndarray) -> list[str | None]:
        """The text at or below each node with a limit above 0, white space collapsed, up to as many other characters. No node costs more than its limit."""
        if not (limits > 0).any():
            return [None] * len(limits)
        texts = self.nodes.column("text").to_pylist()
        cores, sizes, places, gaps, gap = [], [], [], [], True  # of texts with more than white space; gaps: whether white space comes before
        for i, text in enumerate(texts):
            if not text:
                continue
            if core := " ".join(text.split()):
                cores.append(core)
                sizes.append(len(core) - core.count(" "))
                places.append(i)
                gaps.append(gap or text[0].isspace())
                gap = text[-1].isspace()
            else:
                gap = True
        at, out = np.array(places, dtype=np.int64), [None] * len(texts)
        for i in np.flatnonzero(limits > 0):
            j, upto, left, pieces = int(np.searchsorted(at, i)), int(self.end[i]), int(limits[i]), []
            while left > 0 and j < len(cores) and places[j] < upto:
                pieces.append((" " if gaps[j] and pieces else "") + cores[j][: 2 * left])
                left, j = left - sizes[j], j + 1
            out[i] = "".join(pieces)
        return out

    def climb(self, who: np.ndarray) -> pa.Array:
        """Of each flagged node the pre and post of up to HOPS nodes above it, the nearest first."""
        offsets, pre, post = np.zeros(len(self.at) + 1, dtype=np.int32), [], []
        offsets[1:][who] = [self._above(i, pre, post) for i in np.flatnonzero(who)]
        pairs = pa.StructArray.from_arrays([pa.array(pre, pa.int32()), pa.array(post, pa.int32())], ["pre", "post"])
        return pa.ListArray.from_arrays(pa.array(np.cumsum(offsets), pa.int32()), pairs)

    def _above(self, i: int, pre: list[int], post: list[int]) -> int:
        hops = 0
        while hops < HOPS and (i := int(self.up[i])) >= 0:
            pre.append(int(self.pre[i]))
            post.append(int(self.pre[i] + self.end[i] - i))
            hops += 1
        return hops


def by_pages(nodes: DataFrame, work: Callable[[Pages], pa.Table], schema: str) -> DataFrame:
    """What work makes of whole pages, some at a time."""
    bounded_batches(nodes.sparkSession)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < NODES and sum(b.nbytes for b in held) < BYTES:
                continue
            table = pa.Table.from_batches(held)
            starts = np.flatnonzero(table.column("pre").to_numpy() == 0)
            if len(starts) and (cut := int(starts[-1])):  # the last page may go on
                yield from work(Pages(table.slice(0, cut).combine_chunks())).to_batches()
                held = table.slice(cut).to_batches()
                give_back()
        if held:
            yield from work(Pages(pa.Table.from_batches(held).combine_chunks())).to_batches()

    return nodes.mapInArrow(merge, schema)


def _schema(nodes: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{c}` {t}" for c, t in nodes.dtypes), *more])


def enclosed(nodes: DataFrame, tops: Column, low: Column) -> DataFrame:
    """Structural join: the nodes for which low holds, once for each node at or above them for which tops holds, whose pre is the column top."""
    given = nodes.withColumns({"_tops": tops, "_low": low})
    kept = nodes.columns

    def work(pages: Pages) -> pa.Table:
        top, below = np.flatnonzero(pages.flag("_tops")), np.flatnonzero(pages.flag("_low"))
        first, last = np.searchsorted(below, top), np.searchsorted(below, pages.end[top])
        count = last - first
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        return pages.nodes.select(kept).take(pa.array(below[place])).append_column("top", pa.array(np.repeat(pages.pre[top], count), pa.int32()))

    return by_pages(given, work, _schema(nodes, "top int"))


def contained(nodes: DataFrame, mark: Column, shows: Column, climbs: Column) -> DataFrame:
    """The nodes that lie in a container of a mark, with container and marker (its pre and its mark's), shown (the text at or below, for nodes whose shows, a number of characters, is above 0) and ups (what is above nodes for which climbs holds, up to HOPS)."""
    given = nodes.withColumns({"_mark": mark, "_shows": F.coalesce(shows, F.lit(0)).cast("int"), "_climbs": climbs})
    kept = nodes.columns

    def work(pages: Pages) -> pa.Table:
        container, marker = pages.containers(pages.flag("_mark"))
        inside = container >= 0
        shown = pages.shown(np.where(inside, pages.nodes.column("_shows").to_numpy(), 0))
        out = pages.nodes.select(kept).append_column("container", pa.array(pages.pre[container], pa.int32())).append_column("marker", pa.array(pages.pre[marker], pa.int32()))
        out = out.append_column("shown", pa.array(shown, pa.string())).append_column("ups", pages.climb(pages.flag("_climbs") & inside))
        return out.filter(pa.array(inside))

    return by_pages(given, work, _schema(nodes, "container int", "marker int", "shown string", "ups array<struct<pre:int,post:int>>"))


def owners(nodes: DataFrame, mark: Column) -> DataFrame:
    """The nodes with owns: how many marks lie at or below each."""
    given, kept = nodes.withColumn("_mark", mark), nodes.columns

    def work(pages: Pages) -> pa.Table:
        return pages.nodes.select(kept).append_column("owns", pa.array(pages.owns(pages.flag("_mark")), pa.int64()))

    return by_pages(given, work, _schema(nodes, "owns long"))
