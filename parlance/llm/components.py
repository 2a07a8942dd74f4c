"""Connected components by alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import materialise, partitions, task

EDGE = "a long, b long"


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For edges of one batch: each node beside the smallest node of its component, roots left out."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forests of growing batches: at most one edge a node leaves, whatever the number of links read."""
    held: list[np.ndarray] = []
    rows = 0
    for batch in batches:
        held.append(np.stack([batch.column(k).to_numpy() for k in ("a", "b")]))
        rows += batch.num_rows
        if rows >= 500_000:
            held = [np.stack(local_forest(*np.concatenate(held, axis=1)))]
            rows = held[0].shape[1]
            if rows >= 250_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["a", "b"])
                held, rows = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in local_forest(*np.concatenate(held, axis=1))], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge table (a, b): the component is its smallest node.

    Each partition first contracts its own edges to a forest. Then rounds join
    every node to its smallest neighbour (partial aggregates and equi-joins, so a
    hub's edges are never gathered in a list) until no edge moves. Loops, nulls
    and repeated edges are ignored; an empty table gives an empty result.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # Dealt by the larger end: a hub is the smaller end of its edges, so they spread over all tasks.
    e = materialise(e.mapInArrow(task(_forest), EDGE).repartition(partitions(e.sparkSession), "a").mapInArrow(task(_forest), EDGE))
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = both.join(low, both.a == low.n).where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"), (F.col("m") != F.col("a")).alias("moved"))
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(low, large.a == low.n)
        # Links stay as they are if every node has one, to the smallest of all that it leads to.
        far = F.col("b") != F.col("m")
        small = small.select("a", F.col("m").alias("b"), (F.col("moved") | far).alias("moved")).union(small.where(far).select(F.col("b").alias("a"), F.col("m").alias("b"), F.lit(True).alias("moved")))
        told = Observation()
        e = materialise(small.groupBy("a", "b").agg(F.max("moved").alias("moved")).observe(told, F.max("moved").alias("moved"))).select("a", "b")
        if not told.get["moved"]:
            break
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()
