"""Ordered scans of one key's rows in many tasks: parts of the order, and what is carried between them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.sources.scratch import materialize

#: A key with more rows is divided, into parts of about so many, and into so many parts at most.
ROWS_PER_PART, MOST_PARTS = 1_000_000, 4_096


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of key columns, nulls being equal."""
    out = left[keys[0]].eqNullSafe(right[keys[0]])
    for k in keys[1:]:
        out &= left[k].eqNullSafe(right[k])
    return out


def beside(left: DataFrame, right: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """``left`` with columns of at most one row of ``right``, or nulls; null keys meet."""
    renamed = right.select(*[F.col(k).alias(f"__{n}") for n, k in enumerate(keys)], *columns)
    on = left[keys[0]].eqNullSafe(renamed["__0"])
    for n, k in enumerate(keys[1:], 1):
        on &= left[k].eqNullSafe(renamed[f"__{n}"])
    return left.join(renamed, on, "left").select(*left.columns, *columns)


def divided(rows: DataFrame, keys: list[str], axis: str, part: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame | None:
    """Adds ``part``, numbers that grow with ``axis`` (a long) within a key; None if no key has too many rows.

    Bounds come from mergeable quantile sketches of the keys that have too many rows. Each bound's
    own value is a part (an odd number), and so is each open range between two of them; so equal
    values are in one part, and a value with very many rows is alone in its part.
    """
    # few rows in all, which is cheap to know, need no look at the keys
    if rows.select(keys).count() <= rows_per_part:
        return None
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_part)
    sizes = materialize(sizes, "large-keys")
    largest = sizes.agg(F.max("_n")).first()[0]
    if largest is None:
        return None
    many = min(MOST_PARTS, -(-largest // rows_per_part))
    large = beside(rows.select(*keys, axis), sizes, keys, "_n").where("_n is not null")
    cuts = F.percentile_approx(axis, [n / many for n in range(1, many)] or [0.5], max(10_000, 20 * many))
    bounds = materialize(large.groupBy(*keys).agg(F.array_sort(F.array_distinct(cuts)).alias("_b")), "part-bounds")
    number = 2 * F.size(F.filter("_b", lambda b: b < F.col(axis))) + F.array_contains("_b", F.col(axis)).cast("int")
    # nulls come first, as they do in a sort
    placed = F.when(F.col("_b").isNull(), 0).when(F.col(axis).isNull(), -1).otherwise(number)
    return beside(rows, bounds, keys, "_b").withColumn(part, placed).drop("_b")


def next_later(rows: DataFrame, keys: list[str], axis: str, out: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Adds ``out``: the key's next strictly larger value of ``axis`` (a long), or null, as for a null.

    In descending order that is the least value so far, ties left out: a running minimum. A key
    with too many rows is scanned part by part: what a part doesn't know is the first value of
    the next part. Rows of a part of one value need no more than that and stay where they are.
    """
    later = lambda *by: Window.partitionBy(*by).orderBy(F.desc(axis)).rangeBetween(Window.unboundedPreceding, -1)
    running = lambda *by: F.when(F.col(axis).isNotNull(), F.min(axis).over(later(*by)))
    parted = divided(rows, keys, axis, "_part", rows_per_part)
    if parted is None:
        return rows.withColumn(out, running(*keys))
    firsts = parted.where(F.col(axis).isNotNull()).groupBy(*keys, "_part").agg(F.min(axis).alias("_first"))
    carried = firsts.withColumn("_next", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_part")))
    joined = beside(parted, materialize(carried, "carried"), [*keys, "_part"], "_next")
    one_value = F.col("_part") % 2 != 0
    alone = joined.where(one_value).select(*rows.columns, F.when(F.col(axis).isNotNull(), F.col("_next")).alias(out))
    found = joined.where(~one_value).withColumn("_within", running(*keys, "_part"))
    return found.select(*rows.columns, F.coalesce("_within", "_next").alias(out)).union(alone)


def longs(rows: DataFrame, columns: list[str]) -> dict[str, Column] | None:
    """Columns as longs in the same order, by new names; None if one is neither a whole number nor a time."""
    kinds = {c: rows.schema[c].dataType.simpleString() for c in columns}
    if not all(k in ("tinyint", "smallint", "int", "bigint", "date") or k.startswith("timestamp") for k in kinds.values()):
        return None
    as_long = lambda c: F.unix_micros(F.col(c).cast("timestamp")) if kinds[c].startswith("timestamp") else F.unix_date(F.col(c)).cast("long") if kinds[c] == "date" else F.col(c).cast("long")
    return {f"_o{n}": as_long(c) for n, c in enumerate(columns)}


def max_before(rows: DataFrame, keys: list[str], order: list[str], value: Column, out: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Adds ``out``: the largest ``value`` of the key's rows that come before in ``order`` (columns of longs), or null."""
    return _scanned(rows, keys, order, value, out, F.max, F.greatest, -1, rows_per_part)


def max_upto(rows: DataFrame, keys: list[str], order: list[str], value: Column, out: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """The same with the row itself."""
    return _scanned(rows, keys, order, value, out, F.max, F.greatest, 0, rows_per_part)


def sum_upto(rows: DataFrame, keys: list[str], order: list[str], value: Column, out: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Adds ``out``: the sum of ``value`` of the key's rows up to this one; zero where all are null."""
    add = lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    return _scanned(rows, keys, order, F.coalesce(value, F.lit(0)), out, F.sum, add, 0, rows_per_part)


def _scanned(rows: DataFrame, keys: list[str], order: list[str], value: Column, out: str, aggregate: Callable, join: Callable, last: int, rows_per_part: int) -> DataFrame:
    """A running aggregate from a key's first row to the row ``last`` away.

    A key with too many rows is divided along the first column of ``order``, and what has one
    value there along the next; a part's first row begins with what all parts before come to.
    Rows that agree in the whole order are one task.
    """
    rows = rows.withColumn("_v", value)
    by, parted = list(keys), None
    for n, axis in enumerate(order):
        deeper = divided(rows if parted is None else parted, by, axis, f"_part{n}", rows_per_part)
        if deeper is None:
            break
        parted, by = deeper, [*by, f"_part{n}"]
    frame = lambda to, *k: Window.partitionBy(*k).rowsBetween(Window.unboundedPreceding, to)
    if parted is None:
        return rows.withColumn(out, aggregate("_v").over(frame(last, *keys).orderBy(*order))).drop("_v")
    parts = [c for c in by if c not in keys]
    tops = parted.groupBy(*by).agg(aggregate("_v").alias("_top"))
    carried = materialize(tops.withColumn("_carried", aggregate("_top").over(frame(-1, *keys).orderBy(*parts))), "carried")
    joined = beside(parted, carried, by, "_carried")
    found = joined.withColumn(out, join(aggregate("_v").over(frame(last, *by).orderBy(*order)), F.col("_carried")))
    return found.drop("_v", "_carried", *parts)
