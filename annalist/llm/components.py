"""Connected components by randomised contraction, with nothing gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.common import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """Label the nodes of an undirected graph.

    ``edges`` has columns ``a`` and ``b`` (long). Returns one row ``(node, component)`` for
    each node that some edge between two different nodes touches; ``component`` is the
    smallest node reachable. Loops, repeated edges and null ends are ignored; no edges give
    no rows.

    Each round every node hooks to the neighbour (or itself) whose id hashes lowest, and the
    graph shrinks to the nodes that were hooked to. The hash makes the expected shrinkage a
    constant factor for every graph, so rounds grow with the logarithm of the nodes. The
    minimum is a partial aggregate, so a hub's edges meet as one row from each task.
    """
    e = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    e = materialize(e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    hops: list[DataFrame] = []
    while not e.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("n"))
        hop = e.groupBy("a").agg(F.min(rank("b")).alias("m")).select("a", F.least("m", rank("a"))["n"].alias("p"))
        hop = materialize(hop, "hops")
        hops.append(hop)
        to_b = hop.select(F.col("a").alias("b"), F.col("p").alias("q"))
        smaller = e.join(hop, "a").join(to_b, "b").where("p <> q").select(F.col("p").alias("a"), F.col("q").alias("b"))
        smaller = materialize(smaller.distinct(), "edges")
        discard(e)
        e = smaller
    if not hops:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = hops[0].select(F.col("a").alias("node"), F.col("p").alias("root"))
    for hop in hops[1:]:
        labels = labels.join(hop, labels["root"] == hop["a"], "left").select("node", F.coalesce("p", "root").alias("root"))
    labels = materialize(labels, "labels")
    discard(e, *hops)
    least = labels.groupBy("root").agg(F.least(F.min("node"), F.min("root")).alias("component"))
    return labels.join(least, "root").select("node", "component")


def star_edges(i, j, n: int):
    """Local components of the pairs ``i[k], j[k]`` of nodes 0..n-1, as edges to each root.

    Returns two arrays, nodes and their roots, for the nodes that are not roots. A task uses
    this to send on a spanning set of links instead of every link that it found.
    """
    import numpy as np

    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        if np.array_equal(before, label):
            break
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]
