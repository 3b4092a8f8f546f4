"""Sinks that are stopped after each step and run again; releases that don't depend on how rows come."""

import hashlib
import pathlib

import pytest
from pyspark.sql import functions as F

from annalist.operators import ledger, release
from annalist.sources import epochs


class Stopped(Exception):
    pass


def stopping(monkeypatch, after):
    """Stop before the step of this number; returns the list of the steps taken."""
    steps = []
    for module, name in ((epochs, "next_epoch"), (epochs, "write"), (epochs, "publish"), (release, "write_release"), (release, "verify_release")):
        whole = getattr(module, name)

        def step(*args, whole=whole, name=name, **kwargs):
            if len(steps) == after:
                raise Stopped
            out = whole(*args, **kwargs)
            steps.append(name)
            return out

        monkeypatch.setattr(module, name, step)
    return steps


def run_again_after_each_step(monkeypatch, run, check):
    after = 0
    while True:
        with monkeypatch.context() as patched:
            stopping(patched, after)
            try:
                run(after)
                done = True
            except Stopped:
                done = False
        if not done:
            run(after)
        check(after)
        if done:
            return after
        after += 1


def test_ledgers(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, "late", 2), (1, "early", 1), (2, "x", 5), (None, "n", 1)], "k int, v string, t int").withColumn("at", F.timestamp_seconds("t"))

    def run(n):
        ledger.append_once(spark, f"{tmp_path}/{n}", rows, ["k"], "t", month_of="at")

    def check(n):
        run(n)
        assert sorted(map(str, ledger.ledger_rows(spark, f"{tmp_path}/{n}").select("k", "v").collect())) == ["Row(k=1, v='early')", "Row(k=2, v='x')", "Row(k=None, v='n')"]

    assert run_again_after_each_step(monkeypatch, run, check) == 3


def test_objects(spark, tmp_path, monkeypatch):
    objects = spark.createDataFrame([("a", b"1"), ("b", b"2"), ("a", b"1")], "key string, content binary")

    def run(n):
        ledger.put_objects(spark, f"{tmp_path}/{n}", objects)

    def check(n):
        assert {r["result"] for r in ledger.put_objects(spark, f"{tmp_path}/{n}", objects).collect()} == {"verified"}
        assert ledger.ledger_rows(spark, f"{tmp_path}/{n}").count() == 2

    assert run_again_after_each_step(monkeypatch, run, check) == 3


def test_compaction(spark, tmp_path, monkeypatch):
    versions = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 1, 1), (3, 1, 1), (3, 2, 9)], "entity int, version int, t int").withColumn("ingested_at", F.timestamp_seconds("t"))
    pins = spark.createDataFrame([(1, 2)], "entity int, version int")
    whole = {(r["entity"], r["version"]) for r in versions.collect()}

    def pairs(df):
        return sorted((r["entity"], r["version"]) for r in df.collect())

    def run(n):
        hot, cold = f"{tmp_path}/{n}/hot", f"{tmp_path}/{n}/cold"
        if not epochs.published(spark, hot):
            spark.createDataFrame([], "x int")
            versions.write.parquet(f"{hot}/epoch=1/rows")
            pathlib.Path(f"{hot}/_published").mkdir(parents=True)
            pathlib.Path(f"{hot}/_published/1").touch()
        ledger.compact(spark, hot, cold, pins, F.timestamp_seconds(F.lit(5)), ["entity"])

    def check(n):
        hot, cold = f"{tmp_path}/{n}/hot", f"{tmp_path}/{n}/cold"
        located = epochs.read(spark, cold, "locators")
        assert pairs(located) == [(1, 1), (3, 1)] and pairs(ledger.hot_rows(spark, hot)) == sorted(whole - {(1, 1), (3, 1)})
        found = [p for r in located.select("archive").distinct().collect() for p in pairs(spark.read.parquet(r["archive"]))]
        assert sorted(found) == [(1, 1), (3, 1)]
        assert ledger.compact(spark, hot, cold, pins, F.timestamp_seconds(F.lit(5)), ["entity"]) is None

    assert run_again_after_each_step(monkeypatch, run, check) >= 8


def digests(path):
    return sorted((str(p.parent.relative_to(path)), hashlib.sha256(p.read_bytes()).hexdigest()) for p in pathlib.Path(path).rglob("*.parquet"))


def test_releases_of_shuffled_rows_are_the_same_files(spark, tmp_path):
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, "large").otherwise((F.col("id") % 7).cast("string")).alias("p"), (F.col("id") * 7919 % 5_003).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"), F.timestamp_seconds("id").alias("t"))
    for name, n in (("a", 3), ("b", 7)):
        release.write_release(rows.repartition(n, F.rand(n)), f"{tmp_path}/{name}", ["p"], ["k"], "t", rows_per_file=1_500)
    assert digests(tmp_path / "a" / "data") == digests(tmp_path / "b" / "data") and digests(tmp_path / "a" / "manifest") == digests(tmp_path / "b" / "manifest")
    sizes = {(r["p"], r["_file"]): r["row_count"] for r in spark.read.parquet(f"{tmp_path}/a/manifest").collect()}
    large = [n for (p, _), n in sizes.items() if p == "large"]
    assert len(large) == 12 and sum(large) == 18_000 and max(large) < 3_000
    bounds = spark.read.parquet(f"{tmp_path}/a/data").where("p = 'large'").groupBy("_file").agg(F.min("k").alias("a"), F.max("k").alias("z")).orderBy("_file").collect()
    assert all(x["z"] < y["a"] for x, y in zip(bounds, bounds[1:], strict=False))
    assert release.verify_release(spark, f"{tmp_path}/a", ["p"], "t").count() == 0


def test_nulls_and_repeats_enter_the_hash(spark):
    def hashed(rows):
        return tuple(release.manifest(spark.createDataFrame(rows, "a string, b string, t int").withColumn("g", F.lit(1)), ["g"], "t", ["a", "b"]).select(*[f"hash_{n}" for n in range(4)]).first())

    cases = [[("x", None, 1)], [(None, "x", 1)], [("x", "x", 1)], [("x", None, 1)] * 2, [("x", None, 1), (None, "x", 1)], [(None, None, 1)], [("", None, 1)]]
    assert len({hashed(c) for c in cases}) == len(cases)
    assert hashed([("x", None, 1), ("y", "z", 1)]) == hashed([("y", "z", 1), ("x", None, 1)])


def test_rows_of_a_month_are_written_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from annalist.operators import ledger

    path = str(tmp_path / "many")
    rows = spark.range(2_000).select("id", F.lit("2026-01-02").cast("timestamp_ntz").alias("at")).coalesce(1)
    assert [ledger.append_once(spark, path, rows, ["id"], "at", month_of="at") for _ in range(2)] == [1, None]
    assert ledger.ledger_rows(spark, path).count() == 2_000
    assert len(list((tmp_path / "many/epoch=1/rows/month=2026-01").glob("*.parquet"))) > 1
