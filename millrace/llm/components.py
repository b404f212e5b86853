"""Connected components of a graph given by its links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links with the same components: each node to the least of its component (numpy arrays of int64)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    keep = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[keep]], nodes[keep]


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one task, a bounded number at a time, to forests."""
    for batch in batches:
        a, b = forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that occurs in ``links`` (a, b: long): root is the least node it reaches.

    Alternating large-star and small-star steps (each halves the depth of the trees) until
    nothing changes. Both are a min per node, combined before the shuffle, and an even join; a
    node with very many links is split by Spark's skew join. Each round is written to the
    shared folder. An empty graph gives an empty frame; a link of a node to itself says nothing.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    links = stored(links.mapInArrow(_thin, "a long, b long").distinct(), "links")
    while True:
        both = links.union(links.select("b", "a")).toDF("node", "other")
        low = both.groupBy("node").agg(F.least("node", F.min("other")).alias("low"))
        # every larger neighbour of a node is linked to the node's least neighbour
        large = links.select(F.col("a").alias("node"), F.col("b").alias("other")).join(low, "node").select(F.col("low").alias("a"), F.col("other").alias("b"))
        large = large.where("a < b").distinct()
        # every neighbour up to the node itself is linked to the least of them
        least = large.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("low"))
        small = large.select(F.col("b").alias("node"), F.col("a").alias("other")).join(least, "node")
        small = small.select("low", "other").union(least.select("low", "node")).toDF("a", "b").where("a < b").distinct()
        new = stored(small, "links")
        left = new.groupBy().agg(F.count("*").alias("n"), F.count_distinct("b").alias("nodes")).first()
        inner = new.join(new.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1).count() if left["n"] == left["nodes"] else 1
        links = new
        if not inner:
            break
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(links.select("a", "a").distinct())
