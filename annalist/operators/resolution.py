"""Reversible entity resolution: decisions are replayed, never applied for good.

Both sides of the joins here grow with the decisions, and their files are much smaller than their
rows; so they are merged, and none is sent through the driver.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.operators.graph import labels
from annalist.sources import epochs
from annalist.sources.scratch import materialize

LINKS = ("merge", "manual_link")


def effective(supersedes: dict[str, str | None]) -> set[str]:
    """The decisions that count: those that no decision which counts supersedes.

    Of A superseded by B superseded by C, C and A count. A circle is an error.
    """
    above = defaultdict(list)
    for decision, target in supersedes.items():
        if target in supersedes:
            above[target].append(decision)
    waiting = {d: len(above[d]) for d in supersedes}
    ready, out, beaten = [d for d, n in waiting.items() if not n], set(), set()
    while ready:
        decision = ready.pop()
        del waiting[decision]
        target = supersedes[decision]
        if decision not in beaten:
            out.add(decision)
            beaten.add(target)
        if target in waiting:
            waiting[target] -= 1
            if not waiting[target]:
                ready.append(target)
    if waiting:
        raise ValueError("decisions supersede each other in a circle")
    return out


def replay(decisions: Iterable[tuple[str, str, list[str], str | None]]) -> tuple[dict[str, set[str]], list[str], set[tuple[str, str]]]:
    """Groups of two or more, decisions that a block held back, and blocked pairs.

    ``decisions`` are ``id, action, members, group`` in order. A link pools its members with
    all who share a present group with one of them, and moves the pool to its group; a merge,
    unlike a manual link, is held back if the pool holds a blocked pair. A block only forbids
    later merges; unmerging takes members out; other actions leave groups alone.
    """
    home: dict[str, str | None] = {}
    inside: dict[str | None, set[str]] = defaultdict(set)
    foes: dict[str, set[str]] = defaultdict(set)
    held = []
    for decision, action, members, group in decisions:
        pool = set(members)
        if action == "manual_block":
            for m in pool:
                foes[m] |= pool - {m}
        elif action in (*LINKS, "unmerge"):
            present = {home[m] for m in pool if m in home}
            if action != "unmerge":
                pool = pool.union(*(inside[g] for g in present))
                if action == "merge" and any(not foes[m].isdisjoint(pool) for m in pool if m in foes):
                    held.append(decision)
                    continue
            for g in present:
                inside[g] -= pool
            if action == "unmerge":
                for m in pool:
                    home.pop(m, None)
            else:
                home.update(dict.fromkeys(pool, group))
                inside[group] |= pool
    pairs = {(a, b) for a, others in foes.items() for b in others if a < b}
    return {g: ms for g, ms in inside.items() if len(ms) > 1}, held, pairs


def latest_versions(decisions: DataFrame) -> DataFrame:
    """Each decision's highest version."""
    rest = [c for c in decisions.columns if c != "decision_id"]
    return decisions.groupBy("decision_id").agg(F.max_by(F.struct(*rest), "decision_version").alias("d")).select("decision_id", "d.*")


def node_table(decisions: DataFrame) -> DataFrame:
    """``decision_id, node``: a decision's members, its group, itself and what it supersedes."""
    node = lambda kind, c: F.concat(F.lit(kind), c)
    own = F.array_compact(F.array(node("d", F.col("decision_id")), node("g", F.col("group_id")), node("d", F.col("supersedes"))))
    members = F.transform(F.coalesce("members", F.array().cast("array<string>")), lambda m: node("m", m))
    return decisions.select("decision_id", F.explode(F.array_distinct(F.concat(own, F.array_compact(members)))).alias("node"))


def links(nodes: DataFrame) -> DataFrame:
    """``a, b``: each decision with the least one at each of its nodes; what is alone at all of its nodes has no row."""
    least = nodes.groupBy("node").agg(F.min("decision_id").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").select("node", "b")
    return nodes.join(least.hint("merge"), "node").where("decision_id <> b").select(F.col("decision_id").alias("a"), "b").distinct()


def with_parts(decisions: DataFrame) -> DataFrame:
    """Adds ``part``: decisions that share a member, a group or a supersession are in one part."""
    edges = materialize(links(node_table(decisions)), "decision-links")
    if edges.isEmpty():
        return decisions.withColumn("part", F.col("decision_id"))
    found = labels(edges).select(F.col("node").alias("decision_id"), F.col("component").alias("_part"))
    return decisions.join(found.hint("merge"), "decision_id", "left").withColumn("part", F.coalesce("_part", "decision_id")).drop("_part")


_RESULT = "part string, kind string, id string, other string"


def _replayed(rows: list[tuple[str, str, list[str], str | None, str | None]]) -> list[tuple[str, str, str | None]]:
    """What the decisions of one part, in order, come to."""
    counts = effective({d: s for d, _, _, _, s in rows})
    kept = [(d, action, members, group) for d, action, members, group, _ in rows if d in counts]
    groups, held, pairs = replay(kept)
    skipped = set(held)
    out = [("group", g, m) for g, ms in groups.items() for m in ms] + [("blocked", a, b) for a, b in pairs]
    out += [("skipped" if d in skipped else "applied", d, None) for d, *_ in kept]
    targets = {s for d, _, _, _, s in rows if s is not None and d in counts}
    return out + [("superseded", d, None) for d in {d for d, *_ in rows if d not in counts} | targets]


def replay_parts(ready: DataFrame) -> DataFrame:
    """``part, kind, id, other`` of decisions with parts.

    Parts follow each other in a task's sorted rows, so there is no frame for each; one part's
    rows are held at once.
    """
    columns = ["part", "decision_id", "action", "members", "group_id", "supersedes"]
    order = ["part", "effective_at", "recorded_at", "decision_version", "decision_id"]
    ordered = ready.repartition("part").sortWithinPartitions(*order).select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, out = None, [], []

        def given() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([r[n] for r in out], pa.string()) for n in range(4)], ["part", "kind", "id", "other"])
            out.clear()
            return made

        for batch in batches:
            for of, *row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if of != part:
                    out += [(part, *found) for found in (_replayed(rows) if rows else [])]
                    part, rows = of, []
                    if len(out) > 20_000:
                        yield given()
                rows.append((row[0], row[1], row[2] or [], *row[3:]))
        out += [(part, *found) for found in (_replayed(rows) if rows else [])]
        yield given()

    return ordered.mapInArrow(run, _RESULT)


def snapshot(decisions: DataFrame) -> DataFrame:
    """What a replay of all decisions comes to: rows ``kind, id, other``.

    ``group`` rows hold a group and a member, ``blocked`` rows a pair, and ``applied``,
    ``skipped`` and ``superseded`` rows a decision. The highest version of a decision counts.
    Order is by ``effective_at, recorded_at, decision_version, decision_id``. Parts that share
    nothing are replayed side by side; one part is one task, as each decision may depend on
    all before it.
    """
    return replay_parts(with_parts(latest_versions(decisions))).drop("part")


def advance(spark: SparkSession, path: str, decisions: DataFrame) -> int:
    """Carry the replay kept at ``path`` on by new decisions, or versions of decisions; returns the epoch.

    Kept are, by epoch, the decisions, nodes and results of parts, and which parts an epoch
    replaced. New decisions find the parts that hold one of their nodes; these fuse with them
    into new parts, which alone are replayed. An epoch counts once it is published, so a run that
    ends early leaves the state as it was, and can be repeated. Parts never divide again, which is
    sound: what shares nothing replays apart as it does together.
    """
    fresh = latest_versions(decisions).select(*_KEPT)
    nodes = materialize(node_table(fresh), "new-nodes")
    epoch = epochs.next_epoch(spark, path)
    stored = _living(spark, path, "nodes", "part string, node string")
    touched = materialize(stored.join(nodes.hint("merge"), "node").select("decision_id", F.col("part").alias("_part")).distinct(), "touched")
    bridges = touched.select(F.concat(F.lit("n"), "decision_id").alias("a"), F.concat(F.lit("o"), "_part").alias("b"))
    own = links(nodes).select(F.concat(F.lit("n"), "a").alias("a"), F.concat(F.lit("n"), "b").alias("b"))
    found = materialize(labels(own.union(bridges)), "fused")
    label = lambda kind, c: found.where(F.substring("node", 1, 1) == kind).select(F.expr("substring(node, 2)").alias(c), F.concat(F.lit(f"{epoch}:"), "component").alias("_new"))
    retired = materialize(label("o", "part"), "retired")
    here = fresh.join(label("n", "decision_id").hint("merge"), "decision_id", "left").withColumn("part", F.coalesce("_new", F.concat(F.lit(f"{epoch}:n"), "decision_id"))).drop("_new")
    before = _living(spark, path, "decisions", f"part string, {_KEPT_TYPES}").join(retired.hint("merge"), "part").withColumn("part", F.col("_new")).select("part", *_KEPT)
    ready = materialize(latest_versions(before.union(here.select("part", *_KEPT))).select("part", *_KEPT), "ready")
    of = ready.select("decision_id", "part")
    epochs.write(ready, path, epoch, "decisions")
    epochs.write(node_table(ready).join(of.hint("merge"), "decision_id").select("part", "node").distinct(), path, epoch, "nodes")
    epochs.write(replay_parts(ready), path, epoch, "results")
    epochs.write(retired.select("part"), path, epoch, "retired")
    epochs.publish(spark, path, epoch)
    return epoch


def kept_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """``kind, id, other`` of the replay kept at ``path``; the same as ``snapshot`` of all decisions that it was given."""
    return _living(spark, path, "results", _RESULT).drop("part")


#: What of a decision is kept, and its types.
_KEPT = ["decision_id", "decision_version", "action", "members", "group_id", "effective_at", "recorded_at", "supersedes"]
_KEPT_TYPES = "decision_id string, decision_version int, action string, members array<string>, group_id string, effective_at timestamp, recorded_at timestamp, supersedes string"


def _living(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """Rows of the parts that no later epoch replaced."""
    return epochs.read(spark, path, name, schema).join(epochs.read(spark, path, "retired", "part string").hint("merge"), "part", "left_anti")


def project_groups(decisions: DataFrame) -> DataFrame:
    """``group_id, member`` of the groups that a replay leaves."""
    return snapshot(decisions).where("kind = 'group'").select(F.col("id").alias("group_id"), F.col("other").alias("member"))


def group_of(groups: DataFrame, members: DataFrame, member: str) -> DataFrame:
    """The group of each member, or null."""
    return members.join(groups.select("group_id", F.col("member").alias(member)), member, "left")


def match_cascade(left: DataFrame, right: DataFrame, rules: list[tuple[str, list[str]]], left_id: str, right_id: str) -> DataFrame:
    """``left_id, right_id, rule``: rules in turn, each on what the earlier left unmatched."""
    found, rest = None, left
    for name, keys in rules:
        best = right.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(F.min(right_id).alias(right_id))
        hit = rest.join(best, keys).select(left_id, right_id, F.lit(name).alias("rule"))
        found = hit if found is None else found.union(hit)
        rest = rest.join(hit.select(left_id), left_id, "left_anti")
    return found
