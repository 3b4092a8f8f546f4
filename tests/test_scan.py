"""Scans of a key in parts against scans of whole keys."""

import random

import pytest
from pyspark.sql import functions as F

from annalist.operators import relational, scan, temporal


def versions(spark, n, kind):
    draw = random.Random(kind)

    def moment():
        return {"spread": draw.randint(0, 10 * n), "ties": draw.choice([7, 7, 7, draw.randint(0, 40)]), "one": 5}[kind]

    rows = [(None if i % 11 == 0 else "hot" if i % 5 else f"e{i % 7}", draw.randint(0, n), moment(), None if i % 97 == 0 else moment(), f"s{draw.randint(0, 3)}") for i in range(n)]
    made = spark.createDataFrame(rows, "entity string, version long, e long, i long, state_hash string")
    return made.select("entity", "version", F.timestamp_seconds("e").cast("timestamp_ntz").alias("effective_at"), F.timestamp_seconds("i").cast("timestamp_ntz").alias("ingested_at"), "state_hash")


@pytest.mark.parametrize("kind", ["spread", "ties", "one"])
def test_parts_give_what_whole_entities_give(spark, kind):
    made = versions(spark, 4_000, kind)
    whole, parts = (sorted(map(str, temporal.intervals(made, rows_per_part=n).collect())) for n in (10**9, 150))
    assert whole == parts
    order = ("ingested_at", "version", "state_hash_n")
    made = made.withColumn("state_hash_n", F.substring("state_hash", 2, 1).cast("long")).distinct()
    whole, parts = (sorted(map(str, temporal.compare_and_set(made, order=order, rows_per_part=n).collect())) for n in (10**9, 150))
    assert whole == parts


@pytest.mark.parametrize("kind", ["spread", "ties"])
def test_circuits_and_sessions_in_parts(spark, kind):
    made = versions(spark, 3_000, kind).select("entity", "effective_at", F.monotonically_increasing_id().alias("n"), (F.col("version") % 3 > 0).alias("failed"))
    made = made.withColumn("failed", F.when(F.col("n") % 50 > 0, F.col("failed")))
    for run in (lambda n: relational.circuit(made, "entity", ["effective_at", "n"], "failed", 3, n), lambda n: relational.sessions(made, "entity", "effective_at", 5, "n", n)):
        whole, parts = (sorted(map(str, run(n).collect())) for n in (10**9, 200))
        assert whole == parts
    last, run = {}, {}
    for r in sorted(relational.circuit(made, "entity", ["effective_at", "n"], "failed", 3, 200).collect(), key=lambda r: (r["effective_at"], r["n"])):
        run[r["entity"]] = run.get(r["entity"], 0) + 1 if r["failed"] else 0
        assert (r["consecutive_failures"], r["circuit_open"]) == (run[r["entity"]], run[r["entity"]] >= 3)
    for r in sorted(relational.sessions(made, "entity", "effective_at", 5, "n", 200).collect(), key=lambda r: (r["effective_at"], r["n"])):
        before = last.get(r["entity"])
        assert r["session"] == (1 if before is None else before[1] + ((r["effective_at"] - before[0]).total_seconds() > 5))
        last[r["entity"]] = (r["effective_at"], r["session"])


def test_no_task_gets_a_whole_entity(spark):
    made = spark.range(200_000).select(F.lit("hot").alias("k"), F.when(F.col("id") % 4 == 0, 77).otherwise(F.col("id") * 7919 % 1_000_003).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = scan.next_later(made, ["k"], "v", "n", 5_000)
        sizes = [r["count"] for r in found.select(F.spark_partition_id().alias("p"), "n").groupBy("p").agg(F.count(F.lit(1)).alias("count"), F.max("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 200_000 and max(sizes) < 45_000
    wrong = found.groupBy("v").agg(F.min("n").alias("n"), F.max("n").alias("m")).orderBy("v").collect()
    assert all(a["n"] == a["m"] == b["v"] for a, b in zip(wrong, wrong[1:], strict=False)) and wrong[-1]["n"] is None


def test_nothing_to_scan(spark):
    none = versions(spark, 10, "spread").where("false")
    assert temporal.intervals(none).collect() == [] and temporal.compare_and_set(none).collect() == []
