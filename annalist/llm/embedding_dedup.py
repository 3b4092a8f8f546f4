"""Near-duplicate embeddings by counting collisions of one-dimensional projections."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.common import materialize, shards_for
from annalist.llm.components import connected_components, star_edges

MIN_COSINE = 0.95
#: Sorted projections whose window collisions are counted, and the half width of a window, in
#: distances of vectors at the least cosine.
PROJECTIONS = 32
WINDOW = 1.5
#: Width of a routing cell in the same unit, and vectors of random direction wanted in a cell.
CELL = 6.0
CELL_ROWS = 256
#: Chance to lose a pair at exactly the least cosine: in counting, and in routing.
MISS_COUNT = 1e-4
MISS_ROUTE = 1e-3
#: A cell with more vectors is divided into blocks, which are compared pair by pair of blocks.
LARGE_CELL = 4096
ROWS_PER_SHARD = 20_000
SEED = 20_240


@dataclass(frozen=True)
class Plan:
    """Numbers that hold for a run; they follow from the least cosine and the row count."""

    min_cosine: float
    cell_width: float
    cell_axes: int
    tables: int
    window: float
    least_count: int

    @staticmethod
    def of(rows: int, min_cosine: float = MIN_COSINE) -> Plan:
        distance = math.sqrt(2 - 2 * min_cosine)
        grid = np.linspace(0, 8, 20_001)
        density = np.exp(-(grid**2) / 2)
        same = lambda sd, width: float((np.maximum(0, 1 - grid * sd / width) * density).sum() / density.sum())
        near, far = same(distance, CELL * distance), same(math.sqrt(2), CELL * distance)
        axes = max(1, round(math.log(max(1.0, rows / CELL_ROWS)) / -math.log(far)))
        tables = math.ceil(math.log(MISS_ROUTE) / math.log(1 - near**axes))
        p = math.erf(WINDOW / math.sqrt(2))
        tail, count = 0.0, 0
        while (tail := tail + math.comb(PROJECTIONS, count) * p**count * (1 - p) ** (PROJECTIONS - count)) <= MISS_COUNT:
            count += 1
        return Plan(min_cosine, CELL * distance, axes, tables, WINDOW * distance, count)


_SCALE, _AXIS_SCALE = 2.0**20, 2.0**10


@lru_cache(maxsize=8)
def _axes(dimension: int, columns: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions, rounded to whole numbers, and a random offset for each."""
    rng = np.random.default_rng([SEED, kind, dimension])
    return np.round(rng.standard_normal((columns, dimension)).T * _AXIS_SCALE), rng.random(columns)


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _projected(units: np.ndarray, columns: int, kind: int) -> np.ndarray:
    """Projections, exact on rounded coordinates, so that every task gets the same numbers."""
    axes, _ = _axes(units.shape[1], columns, kind)
    return (np.round(units * _SCALE) @ axes) / (_SCALE * _AXIS_SCALE)


def cells(units: np.ndarray, plan: Plan) -> np.ndarray:
    """The routing cell of each vector in each table, as hashes."""
    n = plan.tables * plan.cell_axes
    step = np.floor(_projected(units, n, 0) / plan.cell_width + _axes(units.shape[1], n, 0)[1]).astype(np.int64).astype(np.uint64)
    mixed = np.full((len(units), plan.tables), np.uint64(units.shape[1]), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(plan.tables, dtype=np.uint64)
    for axis in range(plan.cell_axes):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + step[:, axis :: plan.cell_axes]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)


def colliding_pairs(group: np.ndarray, units: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group that collide in at least ``plan.least_count`` projections.

    ``group`` numbers the groups from 0, in order. For each projection the rows of a group are
    sorted, and each row's window holds the rows that follow within the window's half width;
    collisions are tallied for each pair. (The window is centred on the query; looking only
    ahead meets every pair once.)
    """
    sizes = np.bincount(group)
    first = np.cumsum(sizes) - sizes
    base = np.cumsum(sizes * sizes) - sizes * sizes
    local = np.arange(len(group)) - first[group]
    tally = np.zeros(int((sizes * sizes).sum()), dtype=np.uint8)
    projected = _projected(units, PROJECTIONS, 1)
    for column in projected.T:
        order = np.lexsort((column, group))
        value, own = column[order], group[order]
        at = np.arange(len(order))
        for step in range(1, int(sizes.max(initial=0))):
            at = at[: np.searchsorted(at, len(order) - step)]
            at = at[(own[at] == own[np.minimum(at + step, len(order) - 1)]) & (value[np.minimum(at + step, len(order) - 1)] - value[at] <= plan.window)]
            if not len(at):
                break
            i, j = local[order[at]], local[order[at + step]]
            g = own[at]
            tally[base[g] + np.minimum(i, j) * sizes[g] + np.maximum(i, j)] += 1
    found = np.flatnonzero(tally >= plan.least_count)
    g = np.searchsorted(base, found, side="right") - 1
    i, j = np.divmod(found - base[g], sizes[g])
    return first[g] + i, first[g] + j


def shard_links(shard: pd.DataFrame, plan: Plan) -> pd.DataFrame:
    """Links of one shard of the tables: how many each node has, and edges that span them.

    A pair is taken from the first table that brings it together, so it counts once.
    """
    parts = []
    for _, rows in shard.groupby(shard["e"].map(len)):
        rows = rows.sort_values(["cell", "block_a", "block_b", "node"])
        vectors = np.stack(rows["e"].to_numpy()).astype(np.float64)
        units = unit_vectors(vectors)
        group = np.cumsum(np.concatenate([[0], (np.diff(rows[["cell", "block_a", "block_b"]].to_numpy(), axis=0) != 0).any(axis=1)]))
        i, j = colliding_pairs(group, units, plan)
        a, b, own = (rows[c].to_numpy() for c in ("block_a", "block_b", "own"))
        apart = (a[i] == b[i]) | (own[i] != own[j])
        i, j = i[apart], j[apart]
        cosine = np.concatenate([np.einsum("nd,nd->n", units[i[k : k + 65536]], units[j[k : k + 65536]]) for k in range(0, len(i), 65536)] or [np.array([])])
        i, j = i[cosine >= plan.min_cosine], j[cosine >= plan.min_cosine]
        routed, table = cells(units, plan), rows["table"].to_numpy()
        fresh = np.ones(len(i), dtype=bool)
        for t in range(plan.tables):
            fresh &= (t >= table[i]) | (routed[i, t] != routed[j, t])
        i, j = i[fresh], j[fresh]
        node, n = rows["node"].to_numpy(), rows["n"].to_numpy()
        names, at = np.unique(node, return_inverse=True)
        links = np.zeros(len(names), dtype=np.int64)
        np.add.at(links, at[i], n[j])
        np.add.at(links, at[j], n[i])
        child, root = star_edges(at[i], at[j], len(names))
        some = links > 0
        parts.append(pd.DataFrame({"a": np.concatenate([names[some], names[child]]), "b": np.concatenate([names[some], names[root]]), "links": np.concatenate([links[some], np.zeros(len(child), dtype=np.int64)])}))
    return pd.concat(parts) if parts else pd.DataFrame({"a": [], "b": [], "links": []})


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", min_cosine: float = MIN_COSINE) -> DataFrame:
    """``id_col, n_links, component_id, kept`` for every row of ``vectors``.

    Two vectors are linked if their cosine, in double precision, is at least ``min_cosine``.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id
    reachable, and ``kept`` is true where that is the row's own.

    Equal vectors are one node with a count. Nodes are routed to cells: coarse cells of
    several projections, in as many tables as the wanted recall takes; cells that are too
    large are divided into blocks. In a cell, window collisions of sorted projections are
    counted for each pair, and pairs that reach the calibrated count are verified. Only
    counts and spanning edges leave a task.

    Ids are whole numbers, as numbers or text; another id counts as none. A vector that is null, empty, zero or holds null, NaN or infinity links with nothing, and
    so do vectors of different lengths. A row without an id links with nothing and has a null
    component. Repeated rows count as other rows. An empty table gives no rows; other columns
    are not looked at.
    """
    # floats stay floats on the way, which loses nothing; cosines are computed in double
    kind = vectors.schema[vector_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(id_col).try_cast("long").alias("number"), F.col(vector_col).cast(kind).alias("e"))
    sound = F.col("number").isNotNull() & F.coalesce(F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("e", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("sound", sound)
    nodes = rows.where("sound").groupBy("e").agg(F.min("number").alias("node"), F.count(F.lit(1)).alias("n"))
    nodes = materialize(nodes, "nodes")
    n_nodes = nodes.count()
    plan = Plan.of(n_nodes, min_cosine)

    def route(batches):
        for batch in batches:
            for _, part in batch.groupby(batch["e"].map(len)):
                routed = cells(unit_vectors(np.stack(part["e"].to_numpy()).astype(np.float64)), plan)
                for t in range(plan.tables):
                    yield part.assign(table=t, cell=routed[:, t])

    routed = nodes.mapInPandas(route, f"e {kind}, node long, n long, table int, cell long")
    large = routed.groupBy(F.col("cell").alias("_cell")).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > LARGE_CELL)
    large = materialize(large.select("_cell", F.ceil(F.col("_rows") / (LARGE_CELL / 2)).cast("int").alias("_blocks")), "large-cells")
    own = F.pmod(F.xxhash64("node"), F.coalesce("_blocks", F.lit(1))).cast("int")
    dealt = routed.join(large, F.col("cell") == F.col("_cell"), "left").withColumn("own", own)
    pairs = F.transform(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1), lambda x: F.struct(F.least("own", x).alias("block_a"), F.greatest("own", x).alias("block_b")))
    dealt = dealt.withColumn("p", F.explode(pairs)).select("cell", "p.block_a", "p.block_b", "own", "table", "node", "n", "e")
    shards = shards_for(n_nodes * plan.tables, ROWS_PER_SHARD, vectors.sparkSession)
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("cell", "block_a", "block_b"), F.lit(shards)))
    found = dealt.groupBy("shard").applyInPandas(lambda shard: shard_links(shard, plan), "a long, b long, links long")
    found = materialize(found, "links")
    links = found.where("a = b").groupBy(F.col("a").alias("_of")).agg(F.sum("links").alias("_links"))
    component = connected_components(found.where("a <> b")).select(F.col("node").alias("_node"), "component")
    nodes = nodes.join(links, F.col("node") == F.col("_of"), "left").join(component, F.col("node") == F.col("_node"), "left")
    nodes = nodes.select(F.col("e").alias("_e"), (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    linked = rows.where("sound").join(nodes, F.col("e") == F.col("_e")).select("id", "number", "n_links", "component_id")
    alone = rows.where(~F.col("sound")).select("id", "number", F.lit(0).cast("long").alias("n_links"), F.col("number").alias("component_id"))
    both = linked.union(alone).withColumn("kept", F.coalesce(F.col("number") == F.col("component_id"), F.lit(False)))
    return both.select(F.col("id").alias(id_col), "n_links", "component_id", "kept")
