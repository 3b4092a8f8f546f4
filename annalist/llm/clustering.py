"""Centroid clustering by Yinyang grouping, in exact integers.

Centroids fall into groups once. Each vector keeps an upper bound of the distance to its own
centroid and one lower bound a group. A round moves the bounds by what the centroids moved;
vectors whose upper bound stays below all lower bounds aren't looked at, of the others only groups
whose bound is not above the best distance are opened, and in them only the centroids whose own
bound is not. Vectors never travel: each round reads and writes them where they are, and a round's
new sums are the old ones changed by the vectors that moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.common import discard, id_text, materialize

CENTROIDS, ROUNDS, DIMS, SCALE, SEED = 16, 3, 64, 64, "1"
#: Centroids a group, on average.
PER_GROUP = 4
#: Components beyond this would give squared distances beyond 64 bits.
LARGEST = 1 << 27
#: Far above the relative error of a root in double precision, so that bounds stay bounds.
SLACK = 1e-9


def groups_of(centroids: np.ndarray, many: int) -> np.ndarray:
    """The group of each centroid, by five rounds of nearest means from evenly spaced ones."""
    points = centroids.astype(np.float64)
    means = points[np.linspace(0, len(points) - 1, many).astype(int)]
    for _ in range(5):
        group = ((points[:, None] - means) ** 2).sum(axis=2).argmin(axis=1)
        means = np.stack([points[group == g].mean(axis=0) if (group == g).any() else means[g] for g in range(many)])
    return group


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to a centroid, or to one centroid each."""
    gap = x - centroid
    return np.einsum("ij,ij->i", gap, gap)


def first_assignment(x: np.ndarray, centroids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``nearest, upper, lower`` of each row by looking at all centroids; ties go to the smaller number."""
    every = np.stack([squared(x, c) for c in centroids], axis=1)
    nearest, row = every.argmin(axis=1), np.arange(len(x))
    far = np.sqrt(every)
    upper = far[row, nearest]
    far[row, nearest] = np.inf
    return nearest, upper, np.stack([far[:, group == g].min(axis=1, initial=np.inf) for g in range(group.max() + 1)], axis=1)


def next_assignment(x: np.ndarray, nearest: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray, moved: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same after the centroids ``moved`` so far each, from the bounds before; also how many distances were computed.

    A bound equal to the best distance opens its group, so ties are settled by exact distances.
    """
    nearest, upper = nearest.copy(), (upper + moved[nearest]) * (1 + SLACK) + SLACK
    farthest = np.array([moved[group == g].max(initial=0.0) for g in range(lower.shape[1])])
    before, lower = lower, np.maximum(0.0, (lower - farthest) * (1 - SLACK) - SLACK)
    at = np.flatnonzero(upper >= lower.min(axis=1))
    own = squared(x[at], centroids[nearest[at]])
    upper[at], computed = np.sqrt(own) * (1 + SLACK), len(at)
    left = upper[at] >= lower[at].min(axis=1)
    at, best = at[left], own[left]
    start, open_ = nearest[at], lower[at] <= upper[at][:, None]
    now, bounds = start.copy(), np.where(open_, np.inf, lower[at])
    for c in range(len(centroids)):
        bound = np.maximum(0.0, (before[at, group[c]] - moved[c]) * (1 - SLACK) - SLACK)
        member = open_[:, group[c]] & (start != c)
        near = member & (bound <= np.sqrt(best) * (1 + SLACK))
        away = np.flatnonzero(member & ~near)
        bounds[away, group[c]] = np.minimum(bounds[away, group[c]], bound[away])
        r = np.flatnonzero(near)
        found = squared(x[at[r]], centroids[c])
        computed += len(r)
        wins = (found < best[r]) | ((found == best[r]) & (c < now[r]))
        beaten, loser = r[wins], r[~wins]
        bounds[beaten, group[now[beaten]]] = np.minimum(bounds[beaten, group[now[beaten]]], np.sqrt(best[beaten]) * (1 - SLACK))
        bounds[loser, group[c]] = np.minimum(bounds[loser, group[c]], np.sqrt(found[~wins]) * (1 - SLACK))
        best[beaten], now[beaten] = found[wins], c
    nearest[at], upper[at], lower[at] = now, np.sqrt(best) * (1 + SLACK), bounds
    return nearest, upper, lower, computed


def _rows(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width).astype(kind)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), pa.array(rows.ravel(), kind))


def _kept(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """``id, v``: the vectors in integers."""
    x = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    sound = F.forall(x, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    large = F.exists(x, lambda x: F.abs(x * scale) > LARGEST)
    refusal = F.raise_error(F.concat(F.lit("a component is too large for exact distances, vector "), id_text(id_col)))
    units = F.when(large, refusal.cast("array<int>")).otherwise(F.transform(x, lambda x: F.floor(x * scale).cast("int")))
    return vectors.where((F.size(vec_col) == dims) & sound).select(F.col(id_col).alias("id"), units.alias("v"))


def _pass(rows: DataFrame, centroids: np.ndarray, moved: np.ndarray | None, group: np.ndarray, with_distance: bool) -> DataFrame:
    """The state after one assignment: ``id, v, nearest, before, upper, lower, distance``."""
    width, many = centroids.shape[1], int(group.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch.column("v"), width, np.int64)
            if moved is None:
                before = np.full(len(x), -1)
                nearest, upper, lower = first_assignment(x, centroids, group)
            else:
                before = np.asarray(batch.column("nearest")).astype(np.int64)
                nearest, upper, lower, _ = next_assignment(x, before, np.asarray(batch.column("upper")), _rows(batch.column("lower"), many, np.float64), centroids, moved, group)
            distance = pa.array(squared(x, centroids[nearest])) if with_distance else pa.nulls(len(x), pa.int64())
            out = [batch.column("id"), batch.column("v"), pa.array(nearest, pa.int32()), pa.array(before, pa.int32()), pa.array(upper), _lists(lower, pa.float64()), distance]
            yield pa.RecordBatch.from_arrays(out, ["id", "v", "nearest", "before", "upper", "lower", "distance"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, v array<int>, nearest int, before int, upper double, lower array<double>, distance long")


def _changes(state: DataFrame, k: int, dims: int) -> tuple[list[int], list[list[int]]]:
    """How much each cluster's count and component sums changed, over the vectors that moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k + 1, dtype=np.int64), np.zeros((k + 1, dims), dtype=np.int64)
        for batch in batches:
            x = _rows(batch.column("v"), dims, np.int64)
            # the last row takes what had no cluster before
            for column, sign in (("nearest", 1), ("before", -1)):
                cluster = np.asarray(batch.column(column)).astype(np.int64)
                n += sign * np.bincount(cluster % (k + 1), minlength=k + 1)
                for c in np.unique(cluster[cluster >= 0]):
                    sums[c] += sign * x[cluster == c].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), _lists(np.concatenate([n[:k, None], sums[:k]], axis=1), pa.int64())], ["cluster", "part"])

    parts = state.where("nearest <> before").select("nearest", "before", "v").mapInArrow(run, "cluster int, part array<long>")
    each = parts.select("cluster", F.posexplode("part").alias("at", "part")).groupBy("cluster", "at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    n, sums = [0] * k, [[0] * dims for _ in range(k)]
    for cluster, at, part in each.collect():
        if at:
            sums[cluster][at - 1] = int(part)
        else:
            n[cluster] = int(part)
    return n, sums


def cluster(vectors: DataFrame, *, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: str = SEED, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    Kept are vectors with exactly ``dims`` components, none null or not finite; others give no
    row. A component x counts as the integer floor(scale * x). The first centroids are the k kept
    vectors whose ids, as text behind ``seed`` and a colon, have the smallest SHA-256 (equal ids:
    the smaller vector first; a null id counts as empty text); with fewer than k vectors there are
    as many centroids. Each of ``rounds`` rounds assigns every vector to the nearest centroid
    (ties: the smaller number) and moves each centroid that has vectors to the floor of their
    means; others stay. Distances are squared. Repeated rows count and come out as often as they
    are there, an empty table gives no rows, other columns aren't looked at. A component whose
    integer is beyond 2^27 fails the job and names the vector, as its distances would not fit.

    The driver holds the centroids and their sums alone, and each task gets the centroids.
    """
    spark = vectors.sparkSession
    rows = _kept(vectors, id_col, vec_col, dims, scale)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), id_text("id")).cast("binary"), 256)
    centroids = np.array([r["v"] for r in rows.orderBy(key, "v").limit(k).collect()], dtype=np.int64).reshape(-1, dims)
    schema = f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    k = len(centroids)
    group = groups_of(centroids, max(1, k // PER_GROUP))
    group = np.unique(group, return_inverse=True)[1]  # no group without centroids
    n, sums, moved, state = [0] * k, [[0] * dims for _ in range(k)], None, None
    for left in range(rounds, -1, -1):
        last, state = state, materialize(_pass(rows if state is None else state, centroids, moved, group, left == 0), "clusters")
        if last is not None:
            discard(last)
        if left:
            more, changes = _changes(state, k, dims)
            n = [a + b for a, b in zip(n, more, strict=True)]
            sums = [[a + b for a, b in zip(x, y, strict=True)] for x, y in zip(sums, changes, strict=True)]
            after = np.array([[s // m for s in own] if m else list(old) for own, m, old in zip(sums, n, centroids, strict=True)], dtype=np.int64)
            moved, centroids = np.sqrt(squared(after, centroids)), after
    total = {r[0]: int(r[1]) for r in state.groupBy("nearest").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("nearest") + 1)
    inertia = of([total.get(c, 0) for c in range(k)]).cast("long")
    return state.select(F.col("id").alias(id_col), F.col("nearest").alias("cluster"), "distance", inertia.alias("cluster_inertia"), F.lit(sum(total.values())).cast("long").alias("inertia"), of(digests).alias("centroid_sha256"))


_ASSIGN = """a{n} AS MATERIALIZED (SELECT vec_id, row, any_value(v) AS v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
  SELECT k.vec_id, k.row, k.v, m.c, list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - m.v[i]) * (k.v[i] - m.v[i])))::BIGINT AS d FROM kept k, c{n} m) GROUP BY vec_id, row)"""
_MOVE = """c{m} AS MATERIALIZED (SELECT c{n}.c, coalesce(s.v, c{n}.v) AS v FROM c{n} LEFT JOIN (SELECT c, list(x ORDER BY i) AS v FROM (
  SELECT c, i, floor(sum(v[i]) / count(*))::BIGINT AS x FROM a{n}, (SELECT unnest(range(1, 65)) AS i) GROUP BY c, i) GROUP BY c) s ON s.c = c{n}.c)"""
#: For the production parameters.
ORACLE_SQL = f"""WITH kept AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT 16)),
{", ".join(_ASSIGN.format(n=n) + ", " + _MOVE.format(n=n, m=n + 1) for n in range(ROUNDS))}, {_ASSIGN.format(n=ROUNDS)}
SELECT vec_id, CAST(a{ROUNDS}.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a{ROUNDS}.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
sha256(array_to_string(c{ROUNDS}.v, ',')) AS centroid_sha256 FROM a{ROUNDS} JOIN c{ROUNDS} ON a{ROUNDS}.c = c{ROUNDS}.c"""
