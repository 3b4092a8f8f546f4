"""The streaming forms agree with the batch forms."""

from pyspark.sql import functions as F

from annalist.operators import relational, temporal
from annalist.plans import catalogue
from annalist.sources.tables import entity_versions
from annalist.streaming import stateful

SF = "/root/testdata/sf0.001"


def drain(spark, df, name, mode="append"):
    run = df.writeStream.outputMode(mode).format("memory").queryName(name).start()
    run.processAllAvailable()
    run.stop()
    return {tuple(r) for r in spark.table(name).collect()}


def stream(spark, df, path):
    df.repartition(1).write.parquet(str(path))
    return spark.readStream.schema(df.schema).parquet(str(path))


def test_projection_stream(spark, tmp_path):
    arrivals = entity_versions(spark.read.parquet(f"{SF}/events.parquet")).withColumnRenamed("state", "state_hash")
    batch = temporal.compare_and_set(arrivals).select("entity", "version", "applied", "previous_version", "state_changed")
    assert drain(spark, stateful.project_current(stream(spark, arrivals, tmp_path / "a")), "projected") == {tuple(r) for r in batch.collect()}


def test_permit_stream(spark, tmp_path):
    requests = spark.read.parquet(f"{SF}/events.parquet").select(F.col("user_id").alias("origin"), F.col("ts").alias("at"), F.col("event_id").alias("request_id"))
    batch = {tuple(r) for r in relational.token_bucket(requests, capacity=2, per_second=0.0001).collect()}
    assert drain(spark, stateful.permits(stream(spark, requests, tmp_path / "r"), capacity=2, per_second=0.0001), "permits") == batch
    assert {g for _, _, g in batch} == {True, False}


def test_deliver_once(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    assert len(drain(spark, stateful.deliver_once(stream(spark, events.union(events.limit(50)), tmp_path / "e")), "once")) == events.count()


def test_versions_delivered_out_of_order(spark):
    rows = [(1, 3, "a", 1), (1, 1, "b", 2), (1, 2, "a", 3)]
    got = temporal.compare_and_set(spark.createDataFrame(rows, "entity long, version long, state_hash string, ingested_at long")).collect()
    assert {(r["version"], r["applied"], r["previous_version"]) for r in got} == {(3, True, None), (1, False, 3), (2, False, 3)}


def test_heartbeats_fold(spark):
    kept = catalogue.queries()["observations_heartbeat"](spark, SF)
    assert {r["reason"] for r in kept.select("reason").distinct().collect()} <= {"changed", "heartbeat"}


def test_heartbeat_stream(spark, tmp_path):
    seen = spark.read.parquet(f"{SF}/events.parquet").select(F.col("user_id").alias("entity"), F.col("ts").alias("observed_at"), F.col("event_type").alias("state_hash"))
    batch = {tuple(r) for r in temporal.heartbeat_observations(seen, heartbeat_seconds=3600).collect()}
    assert drain(spark, stateful.heartbeats(stream(spark, seen, tmp_path / "h"), heartbeat_seconds=3600), "beats") == batch


def test_window_counts_stream(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    closing = spark.createDataFrame([("2030-01-01 00:00:00", "end")], "ts string, event_type string").select(F.col("ts").cast("timestamp"), "event_type")
    path = tmp_path / "c"
    events.repartition(1).write.parquet(str(path))
    source = spark.readStream.schema(events.schema).parquet(str(path))
    run = stateful.tumbling_counts(source).writeStream.outputMode("append").format("memory").queryName("counts").start()
    run.processAllAvailable()
    closing.write.mode("append").parquet(str(path))
    run.processAllAvailable()
    run.stop()
    want = events.groupBy(F.window("ts", "1 hour")["start"].alias("bucket"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    assert {tuple(r) for r in spark.table("counts").collect()} == {tuple(r) for r in want.collect()}
