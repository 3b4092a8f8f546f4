"""Readers, and views of the given tables in the shapes that the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entity_versions(events: DataFrame) -> DataFrame:
    """Versions of entities: late arrivals and ties on both axes come from the event ids."""
    effective = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    ingested = F.expr("ts + make_dt_interval(0, 0, 0, (event_id * 7919) % 7200)")
    return events.select(F.col("user_id").alias("entity"), F.col("event_id").alias("version"), effective.alias("effective_at"), ingested.alias("ingested_at"), F.col("event_type").alias("state"))


def fetch_attempts(events: DataFrame) -> DataFrame:
    """Fetches with a status by event id; one in eleven bodies is empty."""
    statuses = F.array(*map(F.lit, FETCH_STATUSES))
    status = F.element_at(statuses, (F.pmod(F.col("event_id"), F.lit(len(FETCH_STATUSES))) + 1).cast("int"))
    return events.select("event_id", F.col("ts").alias("fetched_at"), F.col("user_id").alias("source"), status.alias("status"), (F.col("event_id") % 11 == 0).alias("body_empty"))


FETCH_STATUSES = (200, 304, 404, 429, 503, 206, 403, 301, 451, 200, 410, 500, 200)


def bucketed(df: DataFrame, table_name: str, key: str, buckets: int) -> DataFrame:
    """Keep ``df`` as a table bucketed and sorted by ``key``: later joins on it don't shuffle."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table_name)
    return df.sparkSession.table(table_name)


def verified_objects(spark: SparkSession, path: str, expected: DataFrame, max_bytes: int) -> DataFrame:
    """Binary objects with the digest they should have: ``path, length, status``.

    ``expected`` has ``path`` and ``sha256``. Status is ``ok``, ``too_large``, ``mismatch`` or
    ``unexpected``.
    """
    found = spark.read.format("binaryFile").load(path)
    digest = F.when(F.col("length") <= max_bytes, F.sha2("content", 256))
    joined = found.withColumn("digest", digest).join(expected, "path", "left")
    status = F.when(F.col("sha256").isNull(), "unexpected").when(F.col("length") > max_bytes, "too_large").when(F.col("digest") != F.col("sha256"), "mismatch").otherwise("ok")
    return joined.select("path", "length", status.alias("status"))
