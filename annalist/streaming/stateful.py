"""Streams: deliver events once, project current state, grant permits, count by window."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from annalist.operators.relational import refill_rate


def deliver_once(events: DataFrame, *, event_id: str = "event_id", at: str = "ts", late: str = "2 hours") -> DataFrame:
    """Each event id once; state is dropped when the watermark has passed."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([event_id])


def tumbling_counts(events: DataFrame, *, at: str = "ts", by: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by tumbling window and type, emitted when the window is over."""
    counted = events.withWatermark(at, late).groupBy(F.window(at, width), by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("bucket"), by, "n")


def project_current(arrivals: DataFrame) -> DataFrame:
    """The compare-and-set projection of ``entity, version, state_hash, ingested_at``.

    State is the current version and its hash; within a micro-batch arrivals are taken in the
    order of ``ingested_at`` and ``version``, as a stream has no other order there.
    """

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        version, state_hash = state.get if state.exists else (None, None)
        rows = pd.concat(list(batches)).sort_values(["ingested_at", "version"])
        out = []
        for v, h in zip(rows["version"], rows["state_hash"], strict=True):
            applied = version is None or v > version
            out.append((key[0], int(v), applied, None if version is None else int(version), h != state_hash))
            if applied:
                version, state_hash = int(v), h
        state.update((version, state_hash))
        yield pd.DataFrame(out, columns=["entity", "version", "applied", "previous_version", "state_changed"]).astype({"previous_version": "Int64"})

    return arrivals.groupBy("entity").applyInPandasWithState(step, "entity long, version long, applied boolean, previous_version long, state_changed boolean", "version long, state_hash string", "append", GroupStateTimeout.NoTimeout)


def permits(requests: DataFrame, *, capacity: int = 1, per_second: float = 0.2) -> DataFrame:
    """Token bucket of each ``origin`` for ``request_id, at``; grants as in the batch form."""
    unit, (num, den) = 10_000, refill_rate(per_second)

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, tokens = state.get if state.exists else (None, capacity * unit)
        rows = pd.concat(list(batches)).sort_values(["at", "request_id"])
        out = []
        for at, request in zip(rows["at"].astype("datetime64[us]").astype("int64"), rows["request_id"], strict=True):
            tokens = min(capacity * unit, tokens + (int(at) - (int(at) if last is None else last)) * num // den)
            granted = tokens >= unit
            tokens, last = tokens - unit * granted, int(at)
            out.append((key[0], int(request), bool(granted)))
        state.update((last, tokens))
        yield pd.DataFrame(out, columns=["origin", "request_id", "granted"])

    return requests.groupBy("origin").applyInPandasWithState(step, "origin long, request_id long, granted boolean", "last long, tokens long", "append", GroupStateTimeout.NoTimeout)


def heartbeats(arrivals: DataFrame, *, heartbeat_seconds: int = 86_400) -> DataFrame:
    """Observations to keep of ``entity, observed_at, state_hash``; the same as the batch form gives for arrivals in order."""
    width = heartbeat_seconds * 1_000_000

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = state.get if state.exists else (None, None)
        rows = pd.concat(list(batches)).sort_values(["observed_at", "state_hash"])
        out = []
        for at, h in zip(rows["observed_at"], rows["state_hash"], strict=True):
            t = int(at.value // 1000)
            reason = "changed" if last is None or h != held else "heartbeat" if t - last >= width else None
            if reason:
                out.append((key[0], at, h, reason))
                last, held = t, h
        state.update((last, held))
        yield pd.DataFrame(out, columns=["entity", "observed_at", "state_hash", "reason"])

    return arrivals.groupBy("entity").applyInPandasWithState(step, "entity long, observed_at timestamp_ntz, state_hash string, reason string", "last long, held string", "append", GroupStateTimeout.NoTimeout)
