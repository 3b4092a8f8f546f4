"""Sketches of days against exact values, and reads that fall back to archives."""

import datetime

from pyspark.sql import functions as F

from annalist.operators import metrics, relational
from annalist.plans import catalogue


def events(spark, n=6_000):
    rows = spark.range(n).select((F.col("id") % 3).alias("kind"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 600).alias("at"), F.when(F.col("id") % 50 > 0, (F.col("id") * 7919 % 10_007).cast("double")).alias("v"), (F.col("id") * 31 % 997).alias("who"))
    return rows.union(spark.createDataFrame([(0, None, 1.0, 1)], "kind long, at timestamp, v double, who long"))


def test_days_kept_in_batches_are_one_day_each(spark, tmp_path):
    made, path = events(spark), str(tmp_path / "days")
    for batch in range(3):
        metrics.keep_days(spark, path, made.where(F.pmod(F.xxhash64("at"), F.lit(3)) == batch), ["kind"], "at", "v", "who")
    columns = ["kind", "day", "n", "missing", "least", "most"]
    key = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert key(metrics.kept_days(spark, path, ["kind"])) == key(metrics.daily(made, ["kind"], "at", "v", "who"))
    some = metrics.kept_days(spark, path, ["kind"], "2023-11-20", "2023-11-21")
    assert {r["day"] for r in some.collect()} == {datetime.date(2023, 11, 20), datetime.date(2023, 11, 21)}
    assert "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().executedPlan().toString()


def test_rolling_estimates_are_close(spark):
    made = events(spark)
    days = metrics.daily(made, ["kind"], "at", "v", "who")
    got = {(r["kind"], r["day"]): r for r in metrics.estimates(metrics.rolling(days, ["kind"], 7), ["kind", "day"]).collect()}
    rows = [r for r in made.collect() if r["at"] is not None]
    for (kind, day), r in got.items():
        own = [x for x in rows if x["kind"] == kind and 0 <= (day - x["at"].date()).days < 7]
        values = sorted(x["v"] for x in own if x["v"] is not None)
        assert (r["n"], r["missing"], r["least"], r["most"]) == (len(values), len(own) - len(values), values[0], values[-1])
        for p, share in ((r["p50"], 0.5), (r["p95"], 0.95)):
            assert abs(sum(v <= p for v in values) / len(values) - share) <= 0.03 + 1 / len(values)
        assert abs(r["different"] / len({x["who"] for x in own}) - 1) < 0.06
    assert set(got) == {(x["kind"], x["at"].date()) for x in rows}


def test_nothing_and_only_missing_values(spark):
    none = events(spark).where("v is null and kind = 1")
    found = metrics.estimates(metrics.merged(metrics.daily(none, ["kind"], "at", "v", "who"), ["kind"]), ["kind"]).collect()
    assert [(r["n"], r["p50"], r["mean"]) for r in found] == [(0, None, None)] and found[0]["missing"] > 0
    assert metrics.rolling(metrics.daily(none.where("false"), ["kind"], "at", "v", "who"), ["kind"]).collect() == []


def test_reads_fall_back_to_archives(spark, tmp_path):
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    index = df([(1, 1), (2, 1), (3, 2), (4, 1), (None, 1)], "key int, version int")
    hot = df([(1, 1, "a"), (2, 1, "b"), (3, 1, "old")], "key int, version int, body string")
    cold = df([(2, 1, "x", "B"), (3, 2, "y", "c"), (9, 1, "z", "d")], "key int, version int, archive string, body string")
    cold.write.partitionBy("archive").parquet(str(tmp_path / "cold"))
    stored = spark.read.parquet(str(tmp_path / "cold"))
    probes = df([(1,), (1,), (2,), (3,), (4,), (5,), (None,)], "key int")
    got = relational.located_or_archived(index, hot, cold.select("key", "version", "archive"), stored, probes, "body")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 1, "a", "hot", False), (2, 1, "b", "hot", True), (3, 2, "c", "archive", False), (4, 1, None, "missing", False), (5, None, None, "unknown", False), (None, None, None, "unknown", False)], key=repr)
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString().lower()


def test_events_are_not_repeated_before_they_are_joined(spark):
    # Spark takes repeated rows for as small as those they come from, and sent them all to the driver
    text = catalogue.queries()["rolling_capacity"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(sequence(cast(ts" not in text and "Generate inline(s" in text
