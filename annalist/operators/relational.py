"""Queue, outbox and registry shapes: claims, pages, upserts, diffs, circuits."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.operators.scan import ROWS_PER_PART, longs, max_before, max_upto, sum_upto
from annalist.sources.scratch import materialize


def claim(jobs: DataFrame, job_types: list[str], now: Column, limit: int) -> DataFrame:
    """The jobs to lease next: ready, of a type, by priority, time and id (a top-k, no full sort)."""
    ready = jobs.where(F.col("status").isin("pending", "retry") & (F.col("not_before") <= now) & F.col("job_type").isin(*job_types))
    return ready.orderBy(F.desc("priority"), "not_before", "job_id").limit(limit)


def page_after(df: DataFrame, keys: list[str], cursor: list | None, limit: int) -> DataFrame:
    """A keyset page: rows after the cursor in the order of ``keys``."""
    if cursor is not None:
        ties = [reduce(lambda a, b: a & b, [F.col(k) == v for k, v in zip(keys[:n], cursor[:n], strict=True)], F.lit(True)) & (F.col(keys[n]) > cursor[n]) for n in range(len(keys))]
        df = df.where(reduce(lambda a, b: a | b, ties))
    return df.orderBy(*keys).limit(limit)


def _same(keys: list[str]) -> Column:
    """Equality of keys with those of the other side, which have an underscore before; nulls are equal."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])


def insert_if_absent(target: DataFrame, incoming: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """``target`` and the first row of each new key, by ``arrival``; present keys, null ones too, are untouched."""
    columns = [c for c in target.columns if c not in keys]
    first = incoming.groupBy(*keys).agg(F.min_by(F.struct(*columns), arrival).alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in columns])
    present = target.select(*[F.col(k).alias(f"_{k}") for k in keys])
    return target.unionByName(first.join(present, _same(keys), "left_anti"))


def upsert_distinct(target: DataFrame, incoming: DataFrame, keys: list[str], values: list[str], revision: str = "revision") -> DataFrame:
    """Update only what differs, null-safely; an update raises the revision, an insert has 1.

    Of several incoming rows of a key the greatest counts; null keys are equal.
    """
    best = incoming.groupBy(*keys).agg(F.max(F.struct(*values)).alias("_v"))
    new = best.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(f"_v.{v}").alias(f"_{v}") for v in values], F.lit(True).alias("_in"))
    both = target.join(new, _same(keys), "full")
    differs = F.coalesce(F.col("_in"), F.lit(False)) & reduce(lambda a, b: a | b, [~F.col(v).eqNullSafe(F.col(f"_{v}")) for v in values])
    made = F.col(revision).isNull()
    known = [F.when(made, F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    return both.select(*known, *[F.when(differs | made, F.col(f"_{v}")).otherwise(F.col(v)).alias(v) for v in values], F.when(made, 1).when(differs, F.col(revision) + 1).otherwise(F.col(revision)).cast("long").alias(revision))


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The greatest row of each key, as a partial aggregate."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in [*order, *rest]])


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Breaking changes between two lists of ``name, type, required``."""
    n = new.select(F.col("name"), F.col("type").alias("new_type"), F.col("required").alias("new_required"))
    both = old.join(n, "name", "full")
    problem = F.when(F.col("new_type").isNull(), "removed").when(F.col("type").isNull() & F.col("new_required"), "new_required").when(F.col("type") != F.col("new_type"), "type_changed").when(~F.col("required") & F.col("new_required"), "became_required")
    return both.select("name", problem.alias("problem")).where("problem is not null")


def circuit(outcomes: DataFrame, route: str, order: list[str], failed: str, threshold: int, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Adds ``consecutive_failures`` and ``circuit_open``: failures since the last success; an unknown outcome is none.

    That is all failures so far less those up to the last success, which two running aggregates
    tell, so a route with more than ``rows_per_part`` outcomes is scanned in parts. ``order`` is of
    whole numbers and times.
    """
    whole = longs(outcomes, order)
    fails = F.coalesce(F.col(failed), F.lit(False))
    counted = sum_upto(outcomes.withColumns(whole), [route], list(whole), fails.cast("long"), "_all", rows_per_part)
    counted = max_upto(counted, [route], list(whole), F.when(~fails, F.col("_all")), "_before", rows_per_part)
    counted = counted.withColumn("consecutive_failures", F.col("_all") - F.coalesce("_before", F.lit(0)))
    return counted.drop("_all", "_before", *whole).withColumn("circuit_open", F.col("consecutive_failures") >= threshold)


def sessions(df: DataFrame, key: str, at: str, gap_seconds: int, tie: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Adds ``session``, from 1: a gap longer than ``gap_seconds`` begins another; keys with very many rows are scanned in parts."""
    whole = longs(df, [at, tie])
    timed = max_before(df.withColumns(whole), [key], list(whole), F.col("_o0"), "_last", rows_per_part)
    begins = F.coalesce((F.col("_o0") - F.col("_last") > gap_seconds * 1_000_000).cast("long"), F.lit(1).cast("long"))
    return sum_upto(timed, [key], list(whole), begins, "session", rows_per_part).drop("_last", *whole)


def prior_median(df: DataFrame, key: str, order: list[str], value: str, runs: int) -> DataFrame:
    """Adds ``prior_median`` of the ``runs`` rows before; null unless there are that many."""
    before = Window.partitionBy(key).orderBy(*order).rowsBetween(-runs, -1)
    values = F.array_sort(F.collect_list(value).over(before))
    half = runs // 2
    middle = F.element_at(values, half + 1) if runs % 2 else (F.element_at(values, half) + F.element_at(values, half + 1)) / 2
    return df.withColumn("_n", F.size(values)).withColumn("prior_median", F.when(F.col("_n") == runs, F.try_element_at(values, F.lit(half + 1)) if runs % 2 else middle)).drop("_n")


def refill_rate(per_second: float, unit: int = 10_000) -> tuple[int, int]:
    """Ten-thousandths of a token by microsecond as an exact fraction, so that rounding down is the same everywhere."""
    return (Decimal(str(per_second)) * unit / 1_000_000).as_integer_ratio()


def token_bucket(requests: DataFrame, *, origin: str = "origin", at: str = "at", tie: str = "request_id", capacity: int = 1, per_second: float = 0.2) -> DataFrame:
    """``origin, request_id, granted``: each origin's requests against its bucket, in order.

    Tokens are whole ten-thousandths, as refills are rounded down; only a grant costs one.
    An origin's requests are read in order from a sort that spills, with the bucket as state.
    """
    names = ["origin", "t", "tie"]
    rows = requests.select(F.col(origin).alias("origin"), F.unix_micros(F.col(at).cast("timestamp")).alias("t"), F.col(tie).alias("tie"))
    unit, (num, den) = 10_000, refill_rate(per_second)

    def grant(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, last, tokens = None, None, 0
        for batch in batches:
            out = []
            for who, t, own in zip(*(batch[c].tolist() for c in names), strict=True):
                if last is None or who != of:
                    of, last, tokens = who, t, capacity * unit
                tokens = min(capacity * unit, tokens + (t - last) * num // den)
                granted = tokens >= unit
                tokens, last = tokens - unit * granted, t
                out.append((who, own, granted))
            yield pd.DataFrame(out, columns=["origin", "tie", "granted"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in names}
    found = rows.repartition("origin").sortWithinPartitions(*names).mapInPandas(grant, f"origin {kinds['origin']}, tie {kinds['tie']}, granted boolean")
    return found.select(F.col("origin").alias(origin), F.col("tie").alias(tie), "granted")


def insert_or_conflict(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """What inserting rows would do to each: ``created``, ``same`` or ``conflict``, beside the keys.

    A key that is present with other values is a conflict, and so is the second of two
    different new rows of one key, by their values' order. Values are compared null-safely.
    """
    values = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*values).alias("_old"), F.lit(True).alias("_is"))
    first = incoming.groupBy(*keys).agg(F.min(F.struct(*values)).alias("_first"))
    new = incoming.select(*keys, F.struct(*values).alias("_new")).join(first, keys).join(old, keys, "left")
    against = F.when(F.col("_is"), F.col("_old")).otherwise(F.col("_first"))
    status = F.when(~F.col("_new").eqNullSafe(against), "conflict").when(F.col("_is"), "same").otherwise("created")
    return new.select(*keys, F.col("_new.*"), status.alias("status"))


def next_versions(target: DataFrame, incoming: DataFrame, key: str, *, step: str, version: str = "version") -> DataFrame:
    """Number new rows of a key after its present versions; a step that is present keeps its version.

    ``step`` identifies the work that made a row, so a repeated delivery gets no number of
    its own. Repeats within ``incoming`` count once; new rows are numbered by their step.
    """
    done = target.select(key, step, F.col(version).alias("_had")).dropDuplicates([key, step])
    top = target.groupBy(key).agg(F.max(version).alias("_top"))
    new = incoming.dropDuplicates([key, step]).join(done, [key, step], "left").join(top, key, "left")
    place = F.row_number().over(Window.partitionBy(key, F.col("_had").isNull()).orderBy(step))
    numbered = new.withColumn(version, F.coalesce(F.col("_had"), F.coalesce("_top", F.lit(0)) + place).cast("long"))
    return numbered.withColumn("created", F.col("_had").isNull()).drop("_had", "_top")


def expired_leases(jobs: DataFrame, now: Column, max_attempts: Column) -> DataFrame:
    """What becomes of jobs whose lease has passed: ``retry``, or ``dead`` after the last attempt."""
    lapsed = jobs.where((F.col("status") == "leased") & (F.col("lease_expires_at") <= now))
    return lapsed.withColumn("next_status", F.when(F.col("attempt") < max_attempts, "retry").otherwise("dead"))


def can_commit(claims: DataFrame, now: Column, generation: Column) -> DataFrame:
    """Adds ``can_commit``: the claim is leased, of that generation, and its lease has not passed."""
    return claims.withColumn("can_commit", F.coalesce((F.col("status") == "leased") & (F.col("claim_generation") == generation) & (F.col("lease_expires_at") > now), F.lit(False)))


def orphans(objects: DataFrame, references: DataFrame, claims: DataFrame, now: Column, grace_seconds: int, *, key: str = "object_key") -> DataFrame:
    """Objects that nothing refers to, whose claim is not live, and that are older than the grace period."""
    live = claims.where((F.col("status") == "leased") & (F.col("lease_expires_at") > now)).select(key)
    old = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("created_at").cast("timestamp")) > grace_seconds * 1_000_000
    return objects.where(old).join(references.select(key), key, "left_anti").join(live, key, "left_anti")


def swept(candidates: DataFrame, live_again: DataFrame, *, key: str = "object_key") -> DataFrame:
    """A sweep's report: each candidate is ``deleted``, or ``skipped`` if it was claimed meanwhile."""
    again = live_again.select(F.col(key), F.lit(True).alias("_live")).distinct()
    return candidates.join(again, key, "left").withColumn("result", F.when(F.col("_live"), "skipped").otherwise("deleted")).drop("_live")


def backlog(outbox: DataFrame, now: Column, by: str) -> DataFrame:
    """``by, waiting, parked, oldest_seconds`` of what is not published."""
    waiting = outbox.where(F.col("published_at").isNull())
    age = (F.unix_micros(now.cast("timestamp")) - F.min(F.when(~F.col("parked"), F.unix_micros(F.col("created_at").cast("timestamp"))))) / 1_000_000
    return waiting.groupBy(by).agg(F.count_if(~F.col("parked")).alias("waiting"), F.count_if("parked").alias("parked"), F.greatest(age, F.lit(0.0)).alias("oldest_seconds"))


def unpublished(outbox: DataFrame, keys: list[str], limit: int, topic: str = "domain") -> DataFrame:
    """What to publish next: of a topic, not published, not parked, in order."""
    return outbox.where(F.col("published_at").isNull() & ~F.col("parked") & (F.col("topic") == topic)).orderBy(*keys).limit(limit)


def retries_since(attempts: DataFrame, since: Column, by: str) -> DataFrame:
    """``by, retries``: failed attempts after a moment that may be tried again."""
    return attempts.where((F.col("fetched_at") >= since) & (F.col("outcome") == "retryable")).groupBy(by).agg(F.count(F.lit(1)).alias("retries"))


def removals(seen: DataFrame, runs: DataFrame, *, key: str, source: str, run: str, misses: int = 3) -> DataFrame:
    """Items that are gone: missing from the ``misses`` latest complete runs of their source.

    ``runs`` holds the complete runs of each source in order of ``run``; an item that is in a
    later run is not gone. Sources with fewer runs lose nothing.
    """
    place = F.row_number().over(Window.partitionBy(source).orderBy(F.desc(run)))
    bar = runs.withColumn("_place", place).where(F.col("_place") == misses).select(source, F.col(run).alias("_bar"))
    last = seen.groupBy(source, key).agg(F.max(run).alias("last_seen"))
    return last.join(bar, source).where(F.col("last_seen") < F.col("_bar")).drop("_bar")


def located(index: DataFrame, documents: DataFrame, probes: DataFrame, *, key: str = "key", version: str = "version") -> DataFrame:
    """Two-step reads: probes find the exact version in an index, and only then the document."""
    return probes.join(index, key).join(documents, [key, version])


def located_or_archived(index: DataFrame, hot: DataFrame, locators: DataFrame, cold: DataFrame, probes: DataFrame, body: str, *, key: str = "key", version: str = "version", archive: str = "archive") -> DataFrame:
    """``key, version, body, found, conflict`` of each different probe, whatever is there.

    The index says a key's version; the document is then ``hot``, or in the ``archive`` that its
    locator names, or ``missing``; a key that the index doesn't know is ``unknown``. Where both
    have the document and they differ, the hot one counts and ``conflict`` is true. Index, locators
    and documents are first cut down to the probes' keys, archives to the folders that locators
    name, so that scans are filtered by small sides. A null key is unknown.
    """
    asked = materialize(probes.select(key).distinct(), "probes")
    some = asked.where(F.col(key).isNotNull())
    wanted = materialize(index.join(some, key, "left_semi").select(key, version), "located")
    present = hot.join(wanted, [key, version], "left_semi").select(key, version, F.col(body).alias("_hot"))
    places = materialize(locators.join(wanted, [key, version], "left_semi").select(key, version, archive).distinct(), "places")
    # always true; Spark prunes folders by a side only if that has a comparison
    named = places.where(F.length(F.col(archive).cast("string")) >= 0).select(archive).distinct()
    kept = cold.join(named, archive, "left_semi").join(places, [key, version, archive], "left_semi").select(key, version, F.col(body).alias("_cold"))
    read = asked.join(wanted, key, "left").join(present, [key, version], "left").join(kept, [key, version], "left")
    found = F.when(F.col(version).isNull(), "unknown").when(F.col("_hot").isNotNull(), "hot").when(F.col("_cold").isNotNull(), "archive").otherwise("missing")
    return read.select(key, version, F.coalesce("_hot", "_cold").alias(body), found.alias("found"), F.coalesce(F.col("_hot") != F.col("_cold"), F.lit(False)).alias("conflict"))


def changed_documents(stored: DataFrame, incoming: DataFrame, key: str, digest: str) -> DataFrame:
    """Adds ``result`` to incoming objects: ``new``, ``verified`` if the stored digest is the same, ``mismatch`` if not."""
    old = stored.select(key, F.col(digest).alias("_old"))
    result = F.when(F.col("_old").isNull(), "new").when(F.col("_old") == F.col(digest), "verified").otherwise("mismatch")
    return incoming.join(old, key, "left").withColumn("result", result).drop("_old")


def forecast(daily: DataFrame, key: str, day: str, value: str, ahead: tuple[int, ...] = (30, 90, 365)) -> DataFrame:
    """Median and 95th percentile of a key's daily values, and its straight trend so many days ahead."""
    t = F.datediff(F.col(day), F.lit("1970-01-01")).cast("double")
    y = F.col(value).cast("double")
    fitted = daily.groupBy(key).agg(F.percentile(value, 0.5).alias("p50"), F.percentile(value, 0.95).alias("p95"), F.regr_slope(y, t).alias("_slope"), F.regr_intercept(y, t).alias("_base"), F.max(t).alias("_last"))
    return fitted.select(key, "p50", "p95", *[F.greatest(F.lit(0.0), F.col("_base") + F.col("_slope") * (F.col("_last") + n)).alias(f"in_{n}_days") for n in ahead])
