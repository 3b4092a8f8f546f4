"""Tables that grow by epochs: a run stages an epoch's files and publishes it whole, or leaves no trace.

An epoch's tables are folders below ``path/epoch=N``. It counts from the moment at which its
marker is in ``path/_published``; the marker is made only if it isn't there, so of two writers of
an epoch one fails. What a run that ended early left in an epoch's folder is cleared by the next
writer of that epoch, and never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Taken(RuntimeError):
    """Another writer has published the epoch."""


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def published(spark: SparkSession, path: str) -> list[int]:
    """Epochs that count, in order."""
    system, at = _files(spark, f"{path}/_published")
    if not system.exists(at):
        return []
    return sorted(int(s.getPath().getName()) for s in system.listStatus(at) if s.getPath().getName().isdigit())


def next_epoch(spark: SparkSession, path: str) -> int:
    """The epoch after the last published one, its folder cleared."""
    epoch = (published(spark, path) or [0])[-1] + 1
    system, at = _files(spark, f"{path}/epoch={epoch}")
    system.delete(at, True)
    return epoch


def write(rows: DataFrame, path: str, epoch: int, name: str, *, partition_by: list[str] | None = None) -> None:
    """Stage one table of an epoch."""
    rows.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(f"{path}/epoch={epoch}/{name}")


def publish(spark: SparkSession, path: str, epoch: int) -> None:
    """Let an epoch count; ``Taken`` if it does already."""
    system, at = _files(spark, f"{path}/_published/{epoch}")
    try:
        system.create(at, False).close()
    except Exception as there:
        if "AlreadyExists" in str(there) or "already exists" in str(there):
            raise Taken(f"epoch {epoch} of {path}") from None
        raise


def read(spark: SparkSession, path: str, name: str, schema: str | None = None, *, where: str | None = None) -> DataFrame:
    """The rows of all published epochs that have the table; no rows, of ``schema``, if there are none.

    ``where`` is a filter on folders' columns, which prunes what is listed.
    """
    found = []
    for epoch in published(spark, path):
        system, at = _files(spark, f"{path}/epoch={epoch}/{name}")
        if system.exists(at):
            found.append(f"{path}/epoch={epoch}/{name}")
    if not found:
        return spark.createDataFrame([], schema or "nothing int")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if where is None and schema is not None:
        return reader.parquet(*found)
    # folders of several epochs have columns below different roots
    rows = [reader.option("basePath", p).parquet(p) for p in found]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out if where is None else out.where(F.expr(where))
