"""Connected components by alternating large-star and small-star steps, few links in one pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.session import cut_lineage

#: Links that one task joins (16 bytes each); more are joined by distributed rounds.
FEW_LINKS = 1_000_000


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links (a, b) and the least node reachable from each."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    least = np.arange(len(nodes))
    while (apart := least[a] != least[b]).any():
        a, b = a[apart], b[apart]
        np.minimum.at(least, np.maximum(least[a], least[b]), np.minimum(least[a], least[b]))
        while ((next_least := least[least]) != least).any():
            least = next_least
    return nodes, nodes[least]


def _joined(links: DataFrame) -> DataFrame:
    """Components of links that fit one task."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
        for batch in batches:
            for k, own in enumerate(ends):
                own.append(batch.column(k).to_numpy(zero_copy_only=False))
        found = least_reachable(*map(np.concatenate, ends))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["node", "component"])

    return links.coalesce(1).mapInArrow(join, "node long, component long")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    lower = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lower.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of (a, b); the component is its least node.

    Up to ``FEW_LINKS`` links, which are counted first, are joined in one task.  Of
    more, each step is a partial aggregation and a join on the node; a node with very
    many links is split by adaptive execution.  Every round is written, so lost
    executors do not bring back earlier rounds.
    """
    links = links.filter("a != b").select("a", "b")
    if links.count() <= FEW_LINKS:
        return _joined(links)
    edges = cut_lineage(links.distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = cut_lineage(_small_star(_large_star(edges).distinct()), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own).distinct()
