"""Capacity and metrics from sketches of days: kept once, merged for any stretch of days, never read from events again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.sources import epochs

#: Accuracy of quantile sketches (ranks within 1.4 % at k = 200 with 99 % confidence) and of distinct counts (2 ^ 12 registers: 1.6 % standard error).
QUANTILES, DISTINCT = 200, 12


def daily(events: DataFrame, by: list[str], at: str, value: str, who: str) -> DataFrame:
    """One row for each ``by`` and ``day``: ``n, missing, total, least, most`` of ``value``, and sketches of its quantiles and of how many different ``who``.

    Days are those of the session's time zone; events without a time have none and are left out.
    """
    number = F.col(value).cast("double")
    sound = F.when(number.isNotNull() & ~F.isnan(number), number)
    rows = events.where(F.col(at).isNotNull()).withColumn("day", F.col(at).cast("date"))
    return rows.groupBy(*by, "day").agg(
        F.count(sound).alias("n"),
        F.count_if(sound.isNull()).alias("missing"),
        F.sum(sound).alias("total"),
        F.min(sound).alias("least"),
        F.max(sound).alias("most"),
        F.kll_sketch_agg_double(sound, F.lit(QUANTILES)).alias("quantiles"),
        F.hll_sketch_agg(F.col(who).cast("string"), F.lit(DISTINCT)).alias("distinct"),
    )


def merged(days: DataFrame, by: list[str]) -> DataFrame:
    """The rows of the same ``by`` as one; what was merged can be merged again."""
    return days.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("missing").alias("missing"),
        F.sum("total").alias("total"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def rolling(days: DataFrame, by: list[str], length: int = 30) -> DataFrame:
    """For each day the merge of the ``length`` days that end with it; ``days`` are rows of ``daily``."""
    reach = F.sequence(F.col("day"), F.date_add("day", length - 1))
    last = days.groupBy(*by).agg(F.max("day").alias("_last"))
    spread = days.join(last, by).withColumn("until", F.explode(F.filter(reach, lambda d: d <= F.col("_last")))).drop("_last", "day")
    present = days.select(*by, F.col("day").alias("until"))
    return merged(spread.join(present, [*by, "until"], "left_semi"), [*by, "until"]).withColumnRenamed("until", "day")


def read_quantile(share: float) -> Column:
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(share)))


def estimates(sketches: DataFrame, by: list[str]) -> DataFrame:
    """``by, n, missing, mean, least, most, p50, p95, different``."""
    mean = F.when(F.col("n") > 0, F.col("total") / F.col("n"))
    return sketches.select(*by, "n", "missing", mean.alias("mean"), "least", "most", read_quantile(0.5).alias("p50"), read_quantile(0.95).alias("p95"), F.hll_sketch_estimate("distinct").alias("different"))


def keep_days(spark: SparkSession, path: str, events: DataFrame, by: list[str], at: str, value: str, who: str) -> int:
    """Add the sketches of new events to those kept at ``path``, as one epoch; late events of a day add to that day."""
    epoch = epochs.next_epoch(spark, path)
    epochs.write(daily(events, by, at, value, who), path, epoch, "days", partition_by=["day"])
    epochs.publish(spark, path, epoch)
    return epoch


def kept_days(spark: SparkSession, path: str, by: list[str], first: str | None = None, last: str | None = None) -> DataFrame:
    """The rows of ``daily`` kept at ``path``, one for each ``by`` and day; only folders from ``first`` to ``last`` are read."""
    bounds = [f"day >= date'{first}'"] * (first is not None) + [f"day <= date'{last}'"] * (last is not None)
    return merged(epochs.read(spark, path, "days", where=" and ".join(bounds) or "true"), [*by, "day"])
