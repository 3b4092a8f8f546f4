"""Append-only ledgers and what is watched in them: gates, counters, claims, compaction, exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.functions import text
from annalist.sources import epochs
from annalist.sources.scratch import materialize


def append_once(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], arrival: str, month_of: str | None = None) -> int | None:
    """Append rows whose keys are not there yet, the earliest of each key, in folders by month; the epoch, or None if nothing is new.

    The rows count once their epoch is published, so a run may end anywhere and be repeated; of two
    writers at once one fails. Only the key columns of what is there are read, and only those of
    the months that come in: a key stays in its month. Null keys are equal.
    """
    # rows are dealt to many tasks before the first of a key is found: that sorts what a task holds
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = rows.repartition(tasks, *keys).groupBy(*keys).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in keys]), arrival).alias("_v")).select(*keys, "_v.*").select(*rows.columns)
    if month_of is not None:
        first = first.withColumn("month", F.date_format(month_of, "yyyy-MM"))
    first = materialize(first, "incoming")
    present = ledger_rows(spark, path)
    if present is not None:
        if month_of is not None:
            months = [r[0] for r in first.select("month").distinct().collect()]
            present = present.where(F.col("month").isin(*months) if months else F.lit(False))
        # keys are small in files and many in rows, so they are merged, not sent to the driver
        first = first.join(present.select(*keys).withColumnsRenamed({k: f"_{k}" for k in keys}).hint("merge"), reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_anti")
    epoch = epochs.next_epoch(spark, path)
    if month_of is not None:  # a writer sorts its rows by month
        first = first.repartition(tasks, "month", F.pmod(F.xxhash64(*keys), F.lit(8)))
    epochs.write(first, path, epoch, "rows", partition_by=None if month_of is None else ["month"])
    if spark.read.schema(first.schema).parquet(f"{path}/epoch={epoch}/rows").isEmpty():
        return None
    epochs.publish(spark, path, epoch)
    return epoch


def ledger_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """What was appended to a ledger; None for a ledger without rows."""
    return epochs.read(spark, path, "rows") if epochs.published(spark, path) else None


def record_failures(spark: SparkSession, path: str, failures: DataFrame, keys: list[str], at: Column) -> int | None:
    """Keep parse failures, the first of each artifact and parser version, with when they were met; see ``append_once``."""
    return append_once(spark, path, failures.withColumn("failed_at", at), keys, "failed_at", month_of="failed_at")


def append_audit(spark: SparkSession, path: str, rows: DataFrame, key: str, at: str) -> DataFrame:
    """Append audit rows that say who, why and in which correlation; the others come back with what they break, and aren't kept."""
    from annalist.operators.contracts import audit_context
    from annalist.operators.quality import split

    sound, broken = split(rows, audit_context())
    append_once(spark, path, sound, [key], at, month_of=at)
    return broken


def object_heads(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modificationTime`` of stored objects; their contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")


def put_objects(spark: SparkSession, path: str, objects: DataFrame) -> DataFrame:
    """Store ``key, content`` by key: ``key, result`` with ``new``, ``verified`` or ``mismatch``. Only new ones are written, in one epoch."""
    from annalist.operators.relational import changed_documents

    incoming = objects.withColumn("sha256", F.sha2("content", 256)).dropDuplicates(["key"])
    stored = ledger_rows(spark, path)
    stored = incoming.select("key", "sha256").where("false") if stored is None else stored.select("key", "sha256")
    judged = materialize(changed_documents(stored, incoming, "key", "sha256"), "objects")
    new = judged.where("result = 'new'").select("key", "sha256", "content")
    if not new.isEmpty():
        epoch = epochs.next_epoch(spark, path)
        epochs.write(new, path, epoch, "rows")
        epochs.publish(spark, path, epoch)
    return judged.select("key", "result")


def lineage_mismatch(attempts: DataFrame, artifacts: DataFrame, key: str, names: list[str]) -> DataFrame:
    """``key, differs``: which of the named columns an attempt and its artifact tell differently."""
    other = artifacts.select(key, *[F.col(n).alias(f"_{n}") for n in names])
    differs = F.array_compact(F.array(*[F.when(~F.col(n).eqNullSafe(F.col(f"_{n}")), F.lit(n)) for n in names]))
    return attempts.join(other, key).select(key, differs.alias("differs")).where(F.size("differs") > 0)


def acknowledged(tasks: DataFrame, acknowledgements: DataFrame, key: str = "task_id") -> DataFrame:
    """Tasks that succeeded and were acknowledged."""
    return tasks.where(F.col("status") == "succeeded").join(acknowledgements.select(key), key, "left_semi")


def quarantined(tasks: DataFrame, entities: DataFrame, source: str, keys: list[str], cursor: list | None, limit: int) -> DataFrame:
    """A page of a source's quarantined tasks."""
    from annalist.operators.relational import page_after

    mine = tasks.where("status = 'quarantined'").join(entities.where(F.col("source_id") == source).select("entity_id"), "entity_id")
    return page_after(mine, keys, cursor, limit)


def receipt_page(receipts: DataFrame, keys: list[str], cursor: list | None, limit: int) -> tuple[DataFrame, DataFrame]:
    """A page of receipts, and the cursor of the next one: the page's last keys if there is more, else no row."""
    from annalist.operators.relational import page_after

    more = page_after(receipts, keys, cursor, limit + 1)
    read = more.agg(F.array_sort(F.collect_list(F.struct(*keys))).alias("k")).where(F.size("k") > limit)
    return more.orderBy(*keys).limit(limit), read.select(F.element_at("k", limit).alias("k")).select("k.*")


def parked(outbox: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """What is set aside and not published, oldest first."""
    return outbox.where(F.col("published_at").isNull() & F.col("parked")).orderBy(*keys).limit(limit)


def published(outbox: DataFrame, delivered: DataFrame, now: Column, key: str = "event_id") -> DataFrame:
    """The outbox with ``published_at`` set for what was delivered; a time that is set stays."""
    ids = delivered.select(key).distinct().withColumn("_now", now)
    return outbox.join(ids, key, "left").withColumn("published_at", F.coalesce("published_at", "_now")).drop("_now")


def expired_claims(claims: DataFrame, now: Column, limit: int) -> DataFrame:
    """Leased claims whose lease has passed, the oldest first."""
    return claims.where((F.col("status") == "leased") & (F.col("lease_expires_at") <= now)).orderBy("lease_expires_at", "object_key").limit(limit)


def live_permits(permits: DataFrame, now: Column, by: str = "origin") -> DataFrame:
    """``by, live``: permits that are neither released nor expired."""
    live = F.col("released_at").isNull() & (F.col("expires_at") > now)
    return permits.groupBy(by).agg(F.count_if(live).alias("live"))


def buckets(target: DataFrame, wanted: DataFrame, key: str = "origin") -> DataFrame:
    """Rate buckets as wanted: a new one is full, a present one keeps at most its new capacity and raises its revision."""
    both = target.select(key, "tokens", "revision").join(wanted, key, "full")
    have, want = F.col("revision").isNotNull(), F.col("capacity").isNotNull()
    tokens = F.when(have & want, F.least("tokens", "capacity")).otherwise(F.coalesce("tokens", "capacity"))
    return both.select(key, "capacity", tokens.alias("tokens"), F.when(have & want, F.col("revision") + 1).otherwise(F.coalesce("revision", F.lit(1))).cast("long").alias("revision"))


def preflight(sources: DataFrame, routes: DataFrame, policies: DataFrame, *, source: str, policy: str) -> DataFrame:
    """Sources with their routes, and with the policy that a route names, if there is one."""
    return sources.join(routes, source).join(policies, policy, "left")


def purge_page(outbox: DataFrame, tasks: DataFrame, acknowledgements: DataFrame, cutoff: Column, after: int | None, limit: int, key: str = "event_id") -> DataFrame:
    """The next ``limit`` keys that may be deleted, in order, after a key.

    Domain events that were published before ``cutoff``; internal ones made before it whose task
    succeeded and was acknowledged. What is not published, or parked, is never deleted.
    """
    from annalist.operators.relational import page_after

    settled = acknowledged(tasks, acknowledgements, key).select(key).distinct().withColumn("_settled", F.lit(True))
    seen = outbox.where((F.col("created_at") < cutoff) | (F.col("published_at") < cutoff)).join(settled, key, "left")
    domain = (F.col("topic") == "domain") & (F.col("published_at") < cutoff) & ~F.coalesce("parked", F.lit(False))
    internal = (F.col("topic") == "internal") & (F.col("created_at") < cutoff) & F.col("_settled")
    return page_after(seen.where(F.coalesce(domain, F.lit(False)) | F.coalesce(internal, F.lit(False))).select(key), [key], None if after is None else [after], limit)


def purged(outbox: DataFrame, keys: DataFrame, key: str = "event_id") -> DataFrame:
    """The outbox without these keys."""
    return outbox.join(keys, key, "left_anti")


def stale_tasks(tasks: DataFrame, cutoff: Column, after: int | None, limit: int, key: str = "task_id") -> DataFrame:
    """A page of unfinished tasks that nobody has taken, or finished, since ``cutoff``."""
    from annalist.operators.relational import page_after

    waiting = F.col("status").isin("pending", "retry") & (F.col("not_before") <= cutoff)
    held = (F.col("status") == "leased") & (F.col("leased_at") <= cutoff)
    return page_after(tasks.where(waiting | held), [key], None if after is None else [after], limit)


def with_stale_instances(instances: DataFrame, now: Column, ttl_seconds: int) -> DataFrame:
    """Living instances without a heartbeat for so long become ``stale``."""
    silent = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_heartbeat_at").cast("timestamp")) > ttl_seconds * 1_000_000
    return instances.withColumn("status", F.when(F.col("status").isin("starting", "ready", "draining") & silent, "stale").otherwise(F.col("status")))


def capacity(instances: DataFrame, by: str, slots: str) -> DataFrame:
    """``by, instances, slots, least`` of the living instances."""
    return instances.groupBy(by).agg(F.count(F.lit(1)).alias("instances"), F.coalesce(F.sum(slots), F.lit(0)).alias("slots"), F.min(slots).alias("least"))


def completeness(tasks: DataFrame, by: str, *, is_open: Column, is_quarantined: Column, at: str) -> DataFrame:
    """``by, open_tasks, oldest_open, quarantined, settled``, as partial counts."""
    return tasks.groupBy(by).agg(F.count_if(is_open).alias("open_tasks"), F.min(F.when(is_open, F.col(at))).alias("oldest_open"), F.count_if(is_quarantined).alias("quarantined"), (F.count_if(is_open) == 0).alias("settled"))


def confirmed(acknowledgements: DataFrame, entity: str, version: str) -> DataFrame:
    """``entity, tasks, confirmed``: different acknowledged versions, and the highest."""
    return acknowledgements.groupBy(entity).agg(F.count_distinct(version).alias("tasks"), F.max(version).alias("confirmed"))


def content_conflicts(artifacts: DataFrame, key: str = "object_key", digest: str = "sha256") -> DataFrame:
    """``key, digests``: keys under which more than one content was put."""
    return artifacts.groupBy(key).agg(F.count_distinct(digest).alias("digests")).where("digests > 1")


def http_counts(fetches: DataFrame, by: str = "source") -> DataFrame:
    """``by, status_class, responses, too_many``: responses by class, and how many were 429."""
    status = F.col("status")
    group = F.when(status.between(100, 599), F.concat(F.floor(status / 100).cast("string"), F.lit("xx"))).otherwise("other")
    return fetches.groupBy(by, group.alias("status_class")).agg(F.count(F.lit(1)).alias("responses"), F.count_if(status == 429).alias("too_many"))


def quality_gates(records: DataFrame, by: str, *, parsed: Column, complete: Column, category: Column, known: list[str], future: Column, inferred: Column, key: str, usual_inference: float, least_parsed: float = 0.99, least_complete: float = 0.995, inference_band: float = 0.10) -> DataFrame:
    """``by`` and the gates that its records miss.

    Shares of parsed and of complete records, categories that are not known, keys that come
    twice, times in the future, and a share of inferred times far from the usual one.
    """
    share = lambda c: F.avg(F.coalesce(c.cast("double"), F.lit(0.0)))
    seen = records.groupBy(by).agg(share(parsed).alias("p"), share(complete).alias("c"), F.count_if(~F.coalesce(category.isin(*known), F.lit(False))).alias("k"), F.count_if(future).alias("f"), share(inferred).alias("i"), F.count(F.lit(1)).alias("n"))
    # keys in two steps, so that a source's rows meet as partial counts
    twice = records.groupBy(by, key).agg(F.count(F.lit(1)).alias("m")).groupBy(by).agg(F.count_if(F.col("m") > 1).alias("d"))
    gates = {"parse_success": F.col("p") < least_parsed, "completeness": F.col("c") < least_complete, "unknown_category": F.col("k") > 0, "duplicate_keys": F.col("d") > 0, "future_time": F.col("f") > 0, "inference_rate": F.abs(F.col("i") - usual_inference) > inference_band}
    return seen.join(twice, by).select(by, F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in gates.items()]))).alias("missed"))


def fuzzy_match(left: DataFrame, right: DataFrame, block: list[str], name: str, left_id: str, right_id: str, most: int = 3) -> DataFrame:
    """``left_id, right_id, distance``: the nearest name of the same block within ``most`` edits.

    Candidates share the block and have lengths within ``most`` of each other; equal names of
    a block are compared once. A block of very many different names wants a narrower key.
    """
    names = lambda df, i, to: df.groupBy(*block, F.col(name).alias(to)).agg(F.min(i).alias(i))
    lengths = F.explode(F.sequence(F.length("_r") - most, F.length("_r") + most)).alias("_n")
    ours = names(left, left_id, "_l").drop(left_id).withColumn("_n", F.length("_l"))
    near = ours.join(names(right, right_id, "_r").select(*block, "_r", right_id, lengths), [*block, "_n"])
    near = near.withColumn("distance", F.levenshtein("_l", "_r", most)).where("distance >= 0")
    best = near.groupBy(*block, "_l").agg(F.min(F.struct("distance", right_id)).alias("b"))
    return left.withColumn("_l", F.col(name)).join(best, [*block, "_l"]).select(left_id, f"b.{right_id}", "b.distance")


def compacted(versions: DataFrame, pinned: DataFrame, before: Column, *, entity: str = "entity", version: str = "version", at: str = "ingested_at") -> tuple[DataFrame, DataFrame]:
    """Versions that stay, and those to archive: older than a moment, not an entity's latest, and not pinned by a release."""
    latest = versions.groupBy(entity).agg(F.max(version).alias(version)).withColumn("_keep", F.lit(True))
    pins = pinned.select(entity, version).distinct().withColumn("_pin", F.lit(True))
    marked = versions.join(latest, [entity, version], "left").join(pins, [entity, version], "left")
    goes = (F.col(at) < before) & F.col("_keep").isNull() & F.col("_pin").isNull()
    return marked.where(~goes).select(*versions.columns), marked.where(goes).select(*versions.columns)


def archive(versions: DataFrame, path: str, part_cols: list[str], time_col: str, *, entity: str = "entity", version: str = "version") -> DataFrame:
    """Write versions as a release, check it, publish it, and return a locator row for each; an unsound archive is an error."""
    from annalist.operators.release import verify_release, write_release

    spark = versions.sparkSession
    epoch = epochs.next_epoch(spark, path)
    at = f"{path}/epoch={epoch}"
    write_release(versions, at, part_cols, [entity, version], time_col)
    if not verify_release(spark, at, part_cols, time_col).isEmpty():
        raise RuntimeError(f"the archive at {at} is not what was written")
    located = versions.select(entity, version, F.lit(f"{at}/data").alias("archive"), *[c for c in part_cols if c not in (entity, version)])
    epochs.write(located, path, epoch, "locators")
    epochs.publish(spark, path, epoch)
    return epochs.read(spark, path, "locators")


def compact(spark: SparkSession, hot: str, cold: str, pinned: DataFrame, before: Column, part_cols: list[str], *, entity: str = "entity", version: str = "version", at: str = "ingested_at") -> int | None:
    """Move old versions of the table at ``hot`` into the archive at ``cold``; the new epoch of ``hot``, or None if nothing moves.

    In order: mark, write the archive, verify it, publish it with its locators, and only then
    publish a table without what moved. A run that ends in between has lost and doubled nothing:
    what the archive has already isn't written again, and the table that counts is the last
    published one (``hot_rows``).
    """
    rows = hot_rows(spark, hot)
    stay, go = compacted(rows, pinned, before, entity=entity, version=version, at=at)
    moved = epochs.read(spark, cold, "locators").select(entity, version) if epochs.published(spark, cold) else None
    fresh = materialize(go if moved is None else go.join(moved, [entity, version], "left_anti"), "to-archive")
    if not fresh.isEmpty():
        archive(fresh, cold, part_cols, at, entity=entity, version=version)
    elif go.isEmpty():
        return None
    epoch = epochs.next_epoch(spark, hot)
    epochs.write(stay, hot, epoch, "rows")
    epochs.publish(spark, hot, epoch)
    return epoch


def hot_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table of which each epoch is the whole."""
    return spark.read.parquet(f"{path}/epoch={epochs.published(spark, path)[-1]}/rows")


def disposition(error: Column, message: Column, permanent: list[str]) -> Column:
    """``result, message`` of a failed task: quarantine for permanent errors, else retry; without secrets and cut to length."""
    return F.struct(F.when(error.isin(*permanent), "quarantine").otherwise("retry").alias("result"), text.shortened(text.redact(F.concat(error, F.lit(": "), message))).alias("message"))


def ranked(scores: dict[str, Column]) -> Column:
    """An array of (language, confidence) from a column for each language: positive ones, best first, ties by name."""
    pairs = F.array(*[F.struct((-c).alias("minus"), F.lit(n).alias("language")) for n, c in sorted(scores.items())])
    return F.transform(F.array_sort(F.filter(pairs, lambda p: p["minus"] < 0)), lambda p: F.struct(p["language"].alias("language"), (-p["minus"]).alias("confidence")))


def exported(df: DataFrame, *, kind: list[str], source: list[str], start: Column, end: Column, at: str) -> DataFrame:
    """Rows of an export: of these kinds and sources, in a half-open interval of time."""
    return df.where(reduce(lambda a, b: a & b, [F.col("kind").isin(*kind), F.col("source").isin(*source), F.col(at) >= start, F.col(at) < end]))
