"""Replays that are carried on, against replays of everything; epochs that end early."""

import random

import pytest
from pyspark.sql import functions as F

from annalist.operators import graph, resolution
from annalist.sources import epochs

SCHEMA = "decision_id string, decision_version int, action string, members array<string>, group_id string, effective_at timestamp, recorded_at timestamp, supersedes string"


def plain(rows):
    latest = {}
    for r in rows:
        if r[0] not in latest or r[1] > latest[r[0]][1]:
            latest[r[0]] = r
    rows = sorted(latest.values(), key=lambda r: (r[5], r[6], r[1], r[0]))
    counts = resolution.effective({r[0]: r[7] for r in rows})
    groups, held, pairs = resolution.replay([(r[0], r[2], r[3], r[4]) for r in rows if r[0] in counts])
    out = {("group", g, m) for g, ms in groups.items() for m in ms} | {("blocked", a, b) for a, b in pairs}
    out |= {("skipped" if r[0] in held else "applied", r[0], None) for r in rows if r[0] in counts}
    return out | {("superseded", s, None) for s in {r[0] for r in rows if r[0] not in counts} | {r[7] for r in rows if r[0] in counts and r[7]}}


def drawn(draw, spark, n, known):
    import datetime

    rows = []
    for _ in range(n):
        number = len(known) + len(rows)
        action = draw.choice(["merge"] * 6 + ["manual_link", "manual_block", "unmerge", "reject"])
        members = draw.sample([f"m{i}" for i in range(60)], 1 if action == "unmerge" else 2)
        again = draw.random() < 0.1 and known
        decision, version = (draw.choice(known)[0], number) if again else (f"d{number}", 1)
        at = datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=draw.randint(0, 500))
        earlier = [k[0] for k in known if int(k[0][1:]) < int(decision[1:])]
        supersedes = draw.choice(earlier) if draw.random() < 0.1 and earlier else "d-none" if draw.random() < 0.02 else None
        rows.append((decision, version, action, members, f"g{draw.randint(0, 30)}" if draw.random() < 0.3 else f"h{number}", at, at, supersedes))
    return rows


def test_ten_batches_come_to_what_one_replay_does(spark, tmp_path):
    draw, known, path = random.Random(8), [], str(tmp_path / "replay")
    assert resolution.kept_snapshot(spark, path).collect() == []
    for batch in range(10):
        rows = drawn(draw, spark, 12, known)
        known += rows
        assert resolution.advance(spark, path, spark.createDataFrame(rows, SCHEMA)) == batch + 1
        if batch == 4:
            # the same batch again, and a run that ends before it is published
            resolution.advance(spark, str(tmp_path / "other"), spark.createDataFrame(rows, SCHEMA))
            epochs.write(spark.range(3).select(F.lit("x").alias("part"), F.lit("group").alias("kind"), F.lit("y").alias("id"), F.lit("z").alias("other")), path, batch + 2, "results")
        assert {tuple(r) for r in resolution.kept_snapshot(spark, path).collect()} == plain(known)
    replaced = epochs.read(spark, path, "decisions").count() - len({r[0] for r in known})
    assert replaced > 0


def test_only_touched_parts_are_replayed(spark, tmp_path):
    path = str(tmp_path / "replay")
    rows = [(f"d{n}", 1, "merge", [f"a{n}", f"b{n}"], f"g{n}", None, None, None) for n in range(50)]
    resolution.advance(spark, path, spark.createDataFrame(rows, SCHEMA))
    resolution.advance(spark, path, spark.createDataFrame([("x", 1, "merge", ["a1", "a2"], "gx", None, None, None), ("y", 1, "reject", ["q"], None, None, None, None)], SCHEMA))
    again = spark.read.parquet(f"{path}/epoch=2/decisions")
    assert sorted(r[0] for r in again.select("decision_id").collect()) == ["d1", "d2", "x", "y"]
    assert again.where("decision_id <> 'y'").select("part").distinct().count() == 1


def test_an_epoch_is_published_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert epochs.next_epoch(spark, path) == 1 and epochs.published(spark, path) == []
    epochs.write(spark.range(2), path, 1, "rows")
    assert epochs.read(spark, path, "rows", "id long").count() == 0
    epochs.publish(spark, path, 1)
    with pytest.raises(epochs.Taken):
        epochs.publish(spark, path, 1)
    assert epochs.read(spark, path, "rows", "id long").count() == 2 and epochs.next_epoch(spark, path) == 2


def test_parts_of_hubs_and_loners(spark):
    rows = [(f"d{n}", 1, "merge", [f"a{n}", f"b{n}"], "hub" if n < 200 else f"g{n}", None, None, None) for n in range(400)]
    parts = {r["decision_id"]: r["part"] for r in resolution.with_parts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len({parts[f"d{n}"] for n in range(200)}) == 1 and len(set(parts.values())) == 201


def test_no_table_of_a_replay_is_sent_through_the_driver(spark, tmp_path, monkeypatch):
    plans, made, written = [], graph.materialize, epochs.write

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    for module in (resolution, graph):
        monkeypatch.setattr(module, "materialize", lambda df, name: made(seen(df), name))
    monkeypatch.setattr(epochs, "write", lambda df, *a, **k: written(seen(df), *a, **k))
    path = str(tmp_path / "replay")
    # a chain dealt so that one task doesn't hold it: contracting takes rounds of joins
    rows = spark.createDataFrame([(f"d{n * 37 % 101}", 1, "merge", [f"a{n}", f"a{n + 1}"], None, None, None, None) for n in range(101)], SCHEMA).repartition(4)
    for n in range(2):
        resolution.advance(spark, path, rows.where(F.crc32("decision_id") % 2 == n))
    seen(resolution.kept_snapshot(spark, path))
    seen(resolution.with_parts(rows))
    seen(graph.components(rows.select(F.col("members")[0].alias("a"), F.col("members")[1].alias("b"))))
    joins = [line for p in plans for line in p.splitlines() if "Join " in line]
    assert len(joins) > 10 and all("SortMergeJoin" in line for line in joins)
