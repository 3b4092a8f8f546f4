"""Intermediate tables in the folder that a cluster's machines share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_scratch: dict[str, str] = {}
_tables: dict[str, SparkSession] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Where that is unset, a folder of this machine serves a session that runs in one process;
    on a cluster its executors would not find each other's files there, so the job fails.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = tempfile.mkdtemp(prefix="spark-annalist-", dir="/tmp")
    return _own_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{scratch_dir(spark)}/annalist-{name}-{uuid.uuid4().hex}"
    if not _tables:
        atexit.register(_discard_all)
    _tables[path] = spark
    return path


#: Whether what a query's shuffles wrote is deleted as soon as the query has ended.
_SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, *, compact: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs the tasks that read the table again, not
    the work that made it. Results are lazy and may read the table later, so it stays until
    ``discard`` or the end of the driver. ``compact`` is for tables of much text: they are
    packed more tightly, and what the shuffles wrote that made them is deleted at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if compact:
        before = spark.conf.get(_SHUFFLES_END)
        spark.conf.set(_SHUFFLES_END, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            spark.conf.set(_SHUFFLES_END, before)
    else:
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._annalist_path = path
    return out


def _delete(path: str, spark: SparkSession) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing will read again."""
    for df in tables:
        path = df._annalist_path
        if path in _tables:
            _delete(path, _tables.pop(path))


def _discard_all() -> None:
    for path, spark in list(_tables.items()):
        try:
            _delete(path, spark)
        except Exception:  # noqa: BLE001  the session's process may be gone
            return
