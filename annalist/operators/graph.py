"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.sources.scratch import discard, materialize

#: So many nodes a task holds before it hands on what it has.
HELD = 500_000


def _contracted(edges: DataFrame) -> DataFrame:
    """The same components in fewer edges: each task ties the nodes of its edges to the least of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict = {}

        def root(x):
            while (up := above.setdefault(x, x)) != x:
                above[x] = x = above[up]
            return x

        def given() -> Iterator[pa.RecordBatch]:
            tied = [(x, r) for x in list(above) if (r := root(x)) != x]
            above.clear()
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in tied], kind), pa.array([r for _, r in tied], kind)], ["a", "b"])

        kind = None
        for batch in batches:
            kind = batch.schema.field("a").type
            for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                x, y = root(x), root(y)
                above[max(x, y)] = min(x, y)
            if len(above) > HELD:
                yield from given()
        if above:
            yield from given()

    return edges.mapInArrow(run, edges.schema)


def _unfinished(stars: DataFrame) -> bool:
    """Whether some node has two roots, or is tied to a node that is itself tied."""
    ends = stars.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(stars.select("b", F.lit(0), F.lit(1)))
    return not ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1").isEmpty()


def labels(edges: DataFrame) -> DataFrame:
    """``node, component`` of the nodes that have an edge to another node; see ``components``."""
    sound = edges.where("a <> b").select("a", "b").distinct()
    now = materialize(_contracted(sound), "edges")
    while _unfinished(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least.hint("merge"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = materialize(large, "large-star")
        first = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(first.hint("merge"), "a").select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b"))))).where("a <> b").distinct()
        later = materialize(_contracted(small), "small-star")
        discard(now, down)
        now = later
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: each node of ``edges`` (``a, b``) and the least node that it reaches.

    Tasks contract the edges they hold; then, in turn, every node ties its larger neighbours and
    its smaller ones to the least of them, until all pieces are stars. Rounds grow with the
    logarithm of the longest path at most. Rows are merged, not broadcast. Null ends are left out; a node tied only to itself is
    its own component.
    """
    sound = edges.where("a is not null and b is not null")
    nodes = sound.select(F.col("a").alias("node")).union(sound.select("b")).distinct()
    return nodes.join(labels(sound).hint("merge"), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
