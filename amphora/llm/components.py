"""Connected components of a graph that is given as edges, by alternating stars.

Each task first shrinks its own edges to a forest. Then, round by round, every
node is linked to the smallest node around it (large star), and the smaller
neighbours of a node to the smallest of them (small star), until the edges are
stars around the smallest node of each component. Rounds are written to the
shared checkpoint folder. Edges with a null end are no links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amphora.session import pin_table

EDGE = "a long, b long"


def smallest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1, the smallest node reachable over the edges a-b."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        for end in (a, b):
            np.minimum.at(new, end, low)
            np.minimum.at(new, label[end], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = smallest_reachable(len(nodes), ends[: len(a)], ends[len(a) :])
        kept = label != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[kept]), pa.array(nodes[label[kept]])], names=["a", "b"])


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``edges``: two long columns. Returns (node, component), one row for each
    node of an edge between different nodes; component is its smallest node."""
    first, second = edges.columns[:2]
    links = edges.select(F.col(first).cast("long").alias("a"), F.col(second).cast("long").alias("b")).where("a <> b").mapInArrow(_forest, EDGE)
    links, told = pin_table(links.distinct(), "links"), None
    for _ in range(most_rounds):
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low)
        links = pin_table(small.distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == told:
            own = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(own)
        told = now
    raise RuntimeError("the components did not settle")
