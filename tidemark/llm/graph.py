"""Connected components of links that do not fit one machine."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stored


def _contracted(links: DataFrame) -> DataFrame:
    """Links with the same components, at most one per end and task."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([root(x) for x in nodes], pa.int64()),
                pa.array(nodes, pa.int64()),
            ],
            ["a", "b"],
        )

    return links.select("a", "b").mapInArrow(contract, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every end of a link; the label is a node of its component.

    Each round hooks every node to its smallest neighbour, follows the hooks
    twice and goes on with the links between what is left; dense groups and
    stars are gone after a few rounds. A hot node costs a partial minimum only.
    The links of a task are first reduced to a spanning forest, whose size is
    bounded by the ends that the task has read.
    """
    links = stored(_contracted(links), "links")
    rounds = []
    while n_links := links.count():
        both = links.union(links.select("b", "a"))
        parents = (
            both.groupBy("a")
            .agg(F.min("b").alias("least"))
            .select(F.col("a").alias("node"), F.least("a", "least").alias("parent"))
        )
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("label"))
        hooked = stored(
            parents.join(up, "parent").select("node", "label"), "hooked", rows=2 * n_links
        )
        rounds.append(hooked)
        links = stored(
            links.join(hooked.toDF("a", "la"), "a")
            .join(hooked.toDF("b", "lb"), "b")
            .where("la != lb")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
            .distinct(),
            "links",
            rows=n_links,
        )
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = rounds.pop()
    while rounds:
        earlier = rounds.pop().withColumnRenamed("label", "via")
        later = labels.withColumnRenamed("node", "via")
        labels = earlier.join(later, "via", "left").select(
            "node", F.coalesce("label", "via").alias("label")
        )
    return labels
