"""Data-quality rules: violations as an array, and the split into accepted and quarantined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(rules: dict[str, Column]) -> Column:
    """Names of the rules that a row breaks, sorted; a rule that is null is broken."""
    return F.array_sort(F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])))


def split(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and quarantined rows with their violations."""
    checked = df.withColumn("violations", violations(rules))
    return checked.where(F.size("violations") == 0).drop("violations"), checked.where(F.size("violations") > 0)
