"""Bitemporal history: intervals on both axes, as-of reads, current state, state changes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.operators.scan import ROWS_PER_PART, longs, max_before, next_later


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def intervals(versions: DataFrame, *, entity: str = "entity", effective: str = "effective_at", ingested: str = "ingested_at", rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Adds ``valid_from, valid_to, known_from, known_to`` to each version.

    Both axes stand alone. An upper bound is the entity's next strictly later value, so ties
    share it, and a late arrival shortens the valid interval of an older version, never its
    known interval. The last upper bound is null. An entity with more than ``rows_per_part``
    versions is scanned in parts.
    """
    back = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    numbered = versions.withColumn("_e", _micros(effective)).withColumn("_i", _micros(ingested))
    found = next_later(next_later(numbered, [entity], "_e", "_valid_to", rows_per_part), [entity], "_i", "_known_to", rows_per_part)
    return found.select(*versions.columns, F.col(effective).alias("valid_from"), back("_valid_to").alias("valid_to"), F.col(ingested).alias("known_from"), back("_known_to").alias("known_to"))


def contains(valid_at: Column, known_at: Column) -> Column:
    """Half-open containment on both axes; no upper bound means open."""
    within = lambda a, b, t: (F.col(a) <= t) & (F.col(b).isNull() | (t < F.col(b)))
    return within("valid_from", "valid_to", valid_at) & within("known_from", "known_to", known_at)


def as_of(history: DataFrame, probes: DataFrame, *, entity: str = "entity") -> DataFrame:
    """The versions each probe (``entity, valid_at, known_at``) sees; equi-join, then range."""
    return probes.join(history, entity).where(contains(F.col("valid_at"), F.col("known_at")))


def current(versions: DataFrame, *, entity: str = "entity", order: str = "version") -> DataFrame:
    """The latest version of each entity, by partial aggregation: no group is sorted."""
    others = [c for c in versions.columns if c != entity]
    best = versions.groupBy(entity).agg(F.max(F.struct(order, *[c for c in others if c != order])).alias("v"))
    return best.select(entity, *[F.col(f"v.{c}").alias(c) for c in others])


def compare_and_set(arrivals: DataFrame, *, entity: str = "entity", version: str = "version", state_hash: str = "state_hash", order: tuple[str, ...] = ("ingested_at", "version"), rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Adds ``applied, previous_version, previous_hash, state_changed`` in order of arrival.

    A version is applied if it is higher than the current one at its arrival; every version
    keeps its row. The previous hash is the current row's, which is the highest version so
    far, not the arrival before. An entity with more than ``rows_per_part`` arrivals is scanned
    in parts.
    """
    whole = longs(arrivals, list(order))
    seen = max_before(arrivals.withColumns(whole), [entity], list(whole), F.struct(version, state_hash), "_top", rows_per_part)
    seen = seen.withColumn("previous_version", F.col(f"_top.{version}")).withColumn("previous_hash", F.col(f"_top.{state_hash}"))
    seen = seen.withColumn("applied", F.coalesce(F.col(version) > F.col("previous_version"), F.lit(True)))
    return seen.withColumn("state_changed", ~F.col(state_hash).eqNullSafe(F.col("previous_hash"))).drop("_top", *whole)


def change_events(receipts: DataFrame) -> DataFrame:
    """What is published: applied versions that changed the state."""
    return receipts.where("applied and state_changed")


def heartbeat_observations(arrivals: DataFrame, *, entity: str = "entity", at: str = "observed_at", state_hash: str = "state_hash", heartbeat_seconds: int = 86_400) -> DataFrame:
    """Rows to keep: a changed state, or the first after ``heartbeat_seconds`` without a row.

    What is kept depends on what was kept last, so an entity's rows are read in order, from
    a sort that spills, with the last kept row as the only state. Ties are taken by state.
    """
    names = ["entity", "t", "h"]
    rows = arrivals.select(F.col(entity).alias("entity"), F.unix_micros(F.col(at).cast("timestamp")).alias("t"), F.col(state_hash).alias("h"))
    ordered = rows.repartition("entity").sortWithinPartitions(*names)
    width = heartbeat_seconds * 1_000_000

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, last, held = None, None, None
        for batch in batches:
            out = []
            for who, t, h in zip(*(batch[c].tolist() for c in names), strict=True):
                reason = "changed" if last is None or who != of or h != held else "heartbeat" if t - last >= width else None
                if reason:
                    out.append((who, t, h, reason))
                    of, last, held = who, t, h
            yield pd.DataFrame(out, columns=[*names, "reason"])

    kinds = [rows.schema[c].dataType.simpleString() for c in names]
    kept = ordered.mapInPandas(keep, f"entity {kinds[0]}, t {kinds[1]}, h {kinds[2]}, reason string")
    return kept.select(F.col("entity").alias(entity), F.timestamp_micros("t").cast("timestamp_ntz").alias(at), F.col("h").alias(state_hash), "reason")


def state_disorder(versions: DataFrame, *, entity: str = "entity", version: str = "version", effective: str = "effective_at") -> DataFrame:
    """Versions that took effect before an earlier version of their entity did: backdated facts."""
    earlier = Window.partitionBy(entity).orderBy(version).rowsBetween(Window.unboundedPreceding, -1)
    return versions.withColumn("latest_before", F.max(effective).over(earlier)).where(F.col(effective) < F.col("latest_before"))
