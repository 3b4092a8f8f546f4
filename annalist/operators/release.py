"""Dataset releases: parts with statistics, a content hash that rebuilds repeat, verification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.operators.scan import beside
from annalist.sources.scratch import materialize


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """52 bits of a row's MD5, from its columns as text, in the order of their names."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in sorted(columns or df.columns)]
    return F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts).cast("binary")), 1, 13), 16, 10).cast("decimal(38,0)")


def part_manifest(df: DataFrame, part_cols: list[str], time_col: str, content: list[str] | None = None) -> DataFrame:
    """One row a part: rows, first and last time, and an order-free hash of the content.

    ``content`` names the columns that the hash covers; by default all.
    """
    hashed = df.select(*part_cols, F.col(time_col).alias("_t"), row_hash(df, content).alias("_h"))
    return hashed.groupBy(*part_cols).agg(F.count(F.lit(1)).alias("row_count"), F.min("_t").alias("min_time"), F.max("_t").alias("max_time"), F.sum("_h").cast("string").alias("content_hash"))


def set_hash(columns: list[str]) -> list[Column]:
    """Four aggregates that are equal for equal multisets of rows, whatever their order: 256 bits in lanes.

    Lanes hash which columns are null beside the values, as a null leaves a hash as it is.
    """
    absent = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in sorted(columns)])
    lanes = [F.xxhash64(F.lit(f"lane {n}"), absent, *sorted(columns)) for n in range(4)]
    return [F.sum(lane.cast("decimal(38,0)")).cast("string").alias(f"hash_{n}") for n, lane in enumerate(lanes)]


#: Rows of a file, rows sampled for each bound between files, files of a part.
ROWS_PER_FILE, SAMPLED, MOST_FILES = 1_000_000, 20, 1_000
ROW_GROUP = 64 * 1024 * 1024


def with_files(df: DataFrame, part_cols: list[str], sort_cols: list[str], rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Adds ``_file``: ranges of ``sort_cols`` within a part, of about ``rows_per_file`` rows.

    Bounds come from the rows whose keys hash lowest, so they depend on the rows alone and not on
    how they are dealt. Rows of one key are in one file; a part has ``MOST_FILES`` files at most.
    """
    key = F.struct(*sort_cols)
    sizes = df.groupBy(*part_cols).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_files", F.least(F.ceil(F.col("_rows") / rows_per_file), F.lit(MOST_FILES)))
    large = materialize(sizes.where("_files > 1"), "large-parts")
    draw = F.pmod(F.xxhash64(F.lit("bound"), *sort_cols), F.lit(1_000_000_007)) / 1_000_000_007.0
    sample = beside(df.select(*part_cols, *sort_cols), large, part_cols, "_rows", "_files").where(draw < F.col("_files") * SAMPLED / F.col("_rows"))
    taken = sample.groupBy(*part_cols).agg(F.array_sort(F.collect_set(key)).alias("_s"), F.first("_files").alias("_f"))
    every = F.transform(F.sequence(F.lit(1), F.col("_f") - 1), lambda n: F.element_at("_s", F.least(F.ceil(n * F.size("_s") / F.col("_f")), F.size("_s")).cast("int")))
    bounds = materialize(taken.select(*part_cols, F.array_distinct(every).alias("_bounds")), "file-bounds")
    # bounds are in order: how many are below a key is found by halving
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2(F.size("_bounds") + 1.0)).cast("int")))
    middle = lambda a: F.floor((a["low"] + a["high"]) / 2).cast("int")
    below = lambda a: (a["low"] < a["high"]) & (F.get("_bounds", middle(a)) < key)
    halved = lambda a, _: F.struct(F.when(below(a), middle(a) + 1).otherwise(a["low"]).alias("low"), F.when(below(a) | (a["low"] >= a["high"]), a["high"]).otherwise(middle(a)).alias("high"))
    number = F.when(F.size("_bounds") > 0, F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size("_bounds").alias("high")), halved, lambda a: a["low"])).otherwise(0)
    return beside(df, bounds, part_cols, "_bounds").withColumn("_file", F.when(F.col("_bounds").isNull(), 0).otherwise(number)).drop("_bounds")


def manifest(df: DataFrame, by: list[str], time_col: str, content: list[str]) -> DataFrame:
    """One row for each ``by``: rows, first and last time, and the ``set_hash`` of the content."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), F.min(time_col).alias("min_time"), F.max(time_col).alias("max_time"), *set_hash(content))


def write_release(df: DataFrame, path: str, part_cols: list[str], sort_cols: list[str], time_col: str, *, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Parts as Parquet folders of files, and the manifest of each file beside them.

    The same rows give the same files, to the byte, however they come: bounds depend on the rows,
    a file's rows are in total order, and compression and row groups are set. A part is as many
    tasks as it has files. The input is computed once.
    """
    content = [c for c in df.columns if c not in part_cols]
    rows = materialize(with_files(materialize(df, "release"), part_cols, sort_cols, rows_per_file), "release-files")
    rest = [c for c in content if c not in sort_cols]
    files = rows.select(*part_cols, "_file").distinct().count()
    ordered = rows.repartition(max(1, files), *part_cols, "_file").sortWithinPartitions(*part_cols, "_file", *sort_cols, *rest)
    ordered.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).partitionBy(*part_cols, "_file").parquet(f"{path}/data")
    manifest(rows, [*part_cols, "_file"], time_col, content).coalesce(1).sortWithinPartitions(*part_cols, "_file").write.parquet(f"{path}/manifest")


def verify_release(spark: SparkSession, path: str, part_cols: list[str], time_col: str) -> DataFrame:
    """Parts with a file whose content is not what the manifest says; no rows for a sound release."""
    data, said = spark.read.parquet(f"{path}/data"), spark.read.parquet(f"{path}/manifest")
    by = [*part_cols, "_file"]
    found = manifest(data, by, time_col, [c for c in data.columns if c not in by])
    same = [found[c].cast("string").eqNullSafe(said[c].cast("string")) for c in by]
    joined = found.alias("f").join(said.alias("s"), same, "full")
    differs = reduce(lambda a, b: a | b, [~F.col(f"f.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("row_count", *(f"hash_{n}" for n in range(4)))])
    return joined.where(differs).select(*[F.coalesce(F.col(f"s.{c}").cast("string"), F.col(f"f.{c}").cast("string")).alias(c) for c in part_cols]).distinct()
