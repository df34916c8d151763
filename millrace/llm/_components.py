"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import materialize

#: Edges, each in both directions, up to which one task solves the graph: 4 MB of them. Each round over a small
#: graph would write a table of small files, and each file costs a local disk's writer several processes.
ONE_TASK = 1 << 18


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labels of a whole graph."""
    ends = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
    if not ends:
        return
    a, b = map(np.concatenate, zip(*ends, strict=True))
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = np.split(at, 2)
    label = np.arange(len(nodes))  # places in nodes, which rise with them
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for over in (label[a], label[b]):  # the labels of an edge's ends take the smaller of both
            np.minimum.at(new, over, low)
        while ((up := new[new]) != new).any():
            new = up
        if (new == label).all():
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(nodes[label], pa.int64())], ["node", "label"])


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, label) of every node of edges(a, b): label is the smallest node that it reaches.

    Up to ONE_TASK edges are solved in one task and written once. Beyond, in rounds: each round a
    node takes the smallest label around it and then that label's label, so paths halve. Labels of
    a round are a written table; only the numbers of edges and of changes reach the driver.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = materialize(both, "cc-edges")
    if both.count() <= ONE_TASK:
        return materialize(both.where("a < b").coalesce(1).mapInArrow(_solved, "node long, label long"), "cc-labels")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "cc-labels")
    for _ in range(rounds):
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("m"))
        new = labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        up = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        new = new.join(up, F.col("label") == F.col("_n"), "left").select("node", F.least("label", F.coalesce("_l", "label")).alias("label"), "old")
        new = materialize(new, "cc-labels")
        changed = new.where("label <> old").count()
        labels = new.select("node", "label")
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
