"""What records must hold, as named rules for ``quality.split``.

Each function gives the rules of one kind of record as ``name: column`` over the record's
columns, true where the rule holds. A null that a rule does not forbid keeps it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions import contacts, hashing, text, time

Rules = dict[str, Column]

#: Fixed values.
PRECISIONS = ("second", "minute", "hour", "day", "month", "year", "unknown")
BODY_REQUIRED, BODY_FORBIDDEN = ("full",), ("metadata_only", "blocked", "challenge", "gone")
RELEASE_STEPS = {"draft": ("building", "failed"), "building": ("validating", "failed"), "validating": ("published", "failed"), "published": ("superseded",), "failed": (), "superseded": ()}
POOL_MODES = ("manual", "auto")
HEX64 = "^[0-9a-f]{64}$"


def _c(name: str) -> Column:
    return F.col(name)


def _if_any(value: Column, holds: Column) -> Column:
    """Holds, or there is no value."""
    return value.isNull() | F.coalesce(holds, F.lit(False))


def _text(name: str, most: int | None = None) -> Column:
    length = F.length(_c(name))
    return F.coalesce(length >= 1, F.lit(False)) & (F.lit(True) if most is None else length <= most)


def source_time() -> Rules:
    return {"precision": _c("source_time_precision").isin(*PRECISIONS), "inferred": _c("source_time_inferred").isNotNull(), "locale": _if_any(_c("source_locale_raw"), F.length("source_locale_raw") <= 64)}


def system_time() -> Rules:
    return {"times": _c("observed_at").isNotNull() & _c("fetched_at").isNotNull() & _c("ingested_at").isNotNull(), "ingested_before_fetched": _c("ingested_at") >= _c("fetched_at")}


def entity_time() -> Rules:
    """A source's time that is the fetch's to the microsecond was never the source's."""
    apart = lambda c: _if_any(_c(c), _c(c) != _c("fetched_at"))
    return {**system_time(), "event_is_fetch": apart("source_event_at"), "update_is_fetch": apart("source_updated_at")}


def effective_time() -> Rules:
    return {"basis": _c("basis").isin("source_event", "source_updated", "observed"), "inferred": (_c("basis") == "source_event") | _c("inferred")}


def bitemporal_interval() -> Rules:
    """A valid interval may be empty, a known one may not."""
    return {"valid": _if_any(_c("valid_to"), _c("valid_to") >= _c("valid_from")), "known": _if_any(_c("known_to"), _c("known_to") > _c("known_from"))}


def money(amount: str = "amount_minor", currency: str = "currency") -> Rules:
    return {"amount": _c(amount).isNotNull(), "currency": _c(currency).rlike("^[A-Z]{3}$")}


def contact_value() -> Rules:
    normal = _c("normalized")
    return {"raw": _text("raw"), "phone": (_c("kind") != "phone") | _if_any(normal, contacts.is_e164(normal)), "email": (_c("kind") != "email") | _if_any(normal, normal == F.lower(normal))}


def measured_value() -> Rules:
    return {"value": _c("value").isNotNull(), "unit": _text("unit"), "raw": _text("raw_value")}


def source_identity(known: DataFrame | None = None) -> Rules:
    """``known_source`` is a column that a join with the registry gives; see ``with_registry``."""
    item = _c("source_item_id")
    return {"source": F.coalesce(_c("known_source"), F.lit(False)) if known is None else _c("source_id").isNotNull(), "item": _text("source_item_id", 512) & (item == F.trim(item))}


def with_registry(df: DataFrame, registry: DataFrame, key: str = "source_id", registry_key: str = "id") -> DataFrame:
    """Adds ``known_source``: the registry has the id."""
    ids = registry.select(F.col(registry_key).alias(key)).distinct().withColumn("known_source", F.lit(True))
    return df.join(ids, key, "left").withColumn("known_source", F.coalesce("known_source", F.lit(False)))


def raw_artifact() -> Rules:
    return {"status": _c("http_status").between(100, 599), "requested": _text("requested_url"), "final": _text("final_url"), "digest": _c("sha256").rlike(HEX64), "fetch": hashing.is_uuid(_c("fetch_id"))}


def upload_claim() -> Rules:
    return {"key": _text("object_key"), "owner": _text("owner"), "status": _c("status").isin("leased", "committed", "released", "expired"), "lease": _c("lease_expires_at").isNotNull(), "generation": _c("claim_generation") >= 1}


def lineage() -> Rules:
    return {"fetch": hashing.is_uuid(_c("fetch_id")), "raw": _c("raw_sha256").rlike(HEX64), "parser": _text("parser_version"), "task": hashing.is_uuid(_c("projection_task_id"))}


def lineage_task(task: str = "projection_task_id", in_lineage: str = "lineage_task_id") -> Rules:
    return {"lineage_task": _c(task) == _c(in_lineage)}


def version_snapshot() -> Rules:
    """Blocks are bounded JSON objects, and the state's hash is the one of the three of them."""
    bounded = {c: hashing.unbounded(_c(c)).isNull() for c in ("core", "attributes", "latest_state")}
    return {**bounded, "state_hash": _c("state_hash") == hashing.state_hash(_c("core"), _c("attributes"), _c("latest_state"))}


def current_document(own_version: str = "1.0") -> Rules:
    return {**version_snapshot(), "schema": text.readable(_c("schema_version"), own_version), "version": _c("projection_version") >= 1, "seen": _c("last_seen_at") >= _c("first_seen_at")}


def entity_version() -> Rules:
    """A stored version: what it replaced is whole, and its flags say what its numbers say."""
    first = _c("previous_version").isNull()
    return {
        "previous": first == _c("previous_hash").isNull(),
        "changed": _c("state_changed") == ~_c("previous_hash").eqNullSafe(_c("state_hash")),
        "applied": _c("applied") == (first | (_c("previous_version") < _c("version"))),
    }


def payload() -> Rules:
    bounded = {c: hashing.unbounded(_c(c)).isNull() for c in ("core", "attributes", "latest_state")}
    return {**entity_time(), **bounded}


def payload_matches_artifact(kind_domains: dict[str, tuple[str, ...]]) -> Rules:
    """A payload against the artifact it is said to be in (``artifact_`` columns)."""
    fits = reduce(lambda a, b: a | b, [(_c("entity_kind") == k) & _c("artifact_domain").isin(*d) for k, d in kind_domains.items()], F.lit(False))
    return {"entity": _c("entity_uuid") == _c("artifact_entity_uuid"), "schema": _c("schema_version") == _c("artifact_schema_version"), "domain": fits}


def observed_values() -> Rules:
    priced = _c("amount_minor").isNotNull() | _c("currency").isNotNull()
    return {"price": ~priced | reduce(lambda a, b: a & b, money().values()), "availability": _if_any(_c("availability"), _text("availability", 64)), "values": _if_any(_c("values"), hashing.unbounded(_c("values")).isNull())}


def projection_command() -> Rules:
    return {"entity": _c("entity_uuid") == _c("artifact_entity_uuid"), "version": _c("projection_version") >= 1, "priority": _c("priority").between(0, 100)}


def acknowledgement(receipts: DataFrame, at: Column) -> DataFrame:
    """What a projector sends back for its receipts."""
    digest = F.coalesce(F.col("event_sha256"), F.col("event_artifact_sha256"))
    names = ["projection_task_id", "entity_uuid", "projection_version", "target_collection", "document_id", "applied_to_current", "state_changed", "result_version", "result_hash", "event_id"]
    return receipts.select(*names, digest.alias("event_sha256"), at.alias("acknowledged_at"))


def same_receipt(stored: DataFrame, sent: DataFrame, key: str = "projection_task_id") -> DataFrame:
    """Receipts that were sent again with something else in them; they must not be applied."""
    values = [c for c in sent.columns if c != key]
    old = stored.select(key, F.struct(*values).alias("_old"))
    return sent.join(old, key).where(~F.struct(*values).eqNullSafe(F.col("_old"))).drop("_old")


def event_rows(receipts: DataFrame) -> DataFrame:
    """A change row and an outbox row for each receipt with an event, with the same bytes."""
    changed = receipts.where("event_id is not null")
    tables = F.explode(F.array(F.lit("changes"), F.lit("outbox"))).alias("table")
    return changed.select(tables, "event_id", F.col("entity_uuid").alias("aggregate_id"), F.col("result_version").alias("aggregate_version"), F.lit("domain").alias("topic"), "event_bytes", F.sha2("event_bytes", 256).alias("event_sha256"))


def contact_observation() -> Rules:
    return {"contacts": F.size("contacts").between(1, 64), "version": _c("projection_version") >= 1, **lineage_task()}


def review_question() -> Rules:
    return {"kind": _c("record_kind").isin("review", "question", "answer"), "content_version": _text("content_version")}


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has, and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def news_version() -> Rules:
    body = _c("body_sha256").isNotNull()
    return {"version": _c("version_number") >= 1, "body_missing": ~_c("content_access").isin(*BODY_REQUIRED) | body, "body_forbidden": ~_c("content_access").isin(*BODY_FORBIDDEN) | ~body, "language": _c("original_language").rlike("^[a-z]{2}$")}


def news_translation() -> Rules:
    status, some = _c("status"), _c("title").isNotNull() | _c("lead").isNotNull() | _c("body_text").isNotNull() | _c("body_artifact").isNotNull()
    key = hashing.translation_key(*map(_c, ("article_version_id", "target_language", "provider", "model_version", "glossary_version")))
    flags = _c("quality_flags")
    return {
        "key": _c("translation_idempotency_key") == key,
        "body": _c("body_text").isNull() | _c("body_artifact").isNull(),
        "cost": _if_any(_c("cost_minor"), _c("cost_minor") >= 0),
        "flags": flags.eqNullSafe(F.array_sort(F.array_distinct(flags))),
        "title": (status != "translated") | _c("title").isNotNull(),
        "retry_plan": (status == "translation_failed") == _c("retry_plan").isNotNull(),
        "text": ~status.isin("pending", "not_required") | ~some,
    }


def resolution_decision() -> Rules:
    members, action = F.size("members"), _c("action")
    return {
        "version": _c("decision_version") >= 1,
        "distinct": F.size(F.array_distinct("members")) == members,
        "members": F.when(action.isin("merge", "manual_link", "manual_block"), members >= 2).otherwise(members >= 1),
        "group": ~action.isin("merge", "manual_link") | _c("group_id").isNotNull(),
        "score": ((action != "merge") | _c("score").isNotNull()) & _if_any(_c("score"), _c("score").between(0, 1)),
        "supersedes_itself": ~F.coalesce(_c("supersedes") == _c("decision_id"), F.lit(False)),
    }


def release_manifest() -> Rules:
    state, published = _c("state"), _c("state").isin("published", "superseded")
    either = lambda c: _c(c).isNotNull() | _c(f"{c}_artifact").isNotNull()
    both = lambda c: _c(c).isNotNull() & _c(f"{c}_artifact").isNotNull()
    reasons = F.concat(*[F.coalesce(_c(c), F.array().cast("array<struct<source_id:string,policy_version:string,reason:string>>")) for c in ("excluded_sources", "degraded_sources")])
    return {
        "tag": _c("tag").rlike("^[A-Za-z0-9][A-Za-z0-9._-]*$"),
        "commit": _c("git_commit").rlike("^[0-9a-f]{7,64}$"),
        "entities": _c("entity_versions").isNull() != _c("partition_index_sha256").isNull(),
        "reasons": F.forall(reasons, lambda s: F.coalesce(F.length(s["reason"]) > 0, F.lit(False))),
        "reports": ~both("quality_report") & ~both("reconciliation_result"),
        "evidence": ~published | (_c("published_at").isNotNull() & (F.coalesce(F.size("parts"), F.lit(0)) > 0) & either("quality_report") & either("reconciliation_result")),
        "published_at": published | _c("published_at").isNull(),
        "superseding": ((state == "superseded") == _c("superseding_release_id").isNotNull()) & ~F.coalesce(_c("superseding_release_id") == _c("release_id"), F.lit(False)),
    }


def release_watermark() -> Rules:
    return {"snapshot_at": _c("snapshot_at").isNotNull(), "database": _text("postgres_snapshot")}


def source_inclusion() -> Rules:
    return {"source": _text("source_id"), "policy": _text("policy_version")}


def component_versions() -> Rules:
    return {c: _text(c) for c in ("parser_version", "normalizer_version", "matcher_version", "resolution_version")}


def entity_version_ref() -> Rules:
    return {"entity": hashing.is_uuid(_c("entity_uuid")), "version": _c("projection_version") >= 1}


def worker_pool() -> Rules:
    return {"least": _c("min_replicas") >= 0, "most": _c("max_replicas") >= _c("min_replicas"), "desired": _c("desired_replicas").between(_c("min_replicas"), _c("max_replicas")), "concurrency": _c("desired_concurrency") >= 1, "mode": _c("mode").isin(*POOL_MODES)}


def registry_entry() -> Rules:
    """An id begins with its kind."""
    return {"id": _c("id").rlike("^[a-z][a-z0-9_]*$") & _c("id").startswith(F.concat(_c("kind"), F.lit("_"))), "country": _c("country").rlike("^[A-Z]{2}$"), "name": _text("name"), "domains": F.size("domains") >= 1, "rating": _c("rating").between(0, 100), "research": _text("research")}


def normalized_url(original: str = "original", normal: str = "normalized") -> Rules:
    from annalist.functions import url

    return {"original": _text(original), "tracking": F.size(url.tracking_keys(_c(normal))) == 0}


def audit_context() -> Rules:
    return {"actor": _text("actor"), "reason": _text("reason"), "correlation": hashing.is_uuid(_c("correlation_id"))}


def can_transition(state: Column, target: Column) -> Column:
    """Whether a release may go from one state to another."""
    steps = F.create_map(*[x for k, v in RELEASE_STEPS.items() for x in (F.lit(k), F.array(*map(F.lit, v)).cast("array<string>"))])
    return F.coalesce(F.array_contains(steps[state], target), F.lit(False))


def manifest_update(before: DataFrame, after: DataFrame, key: str = "release_id") -> DataFrame:
    """``key, changed, allowed`` of manifests: a published one only changes to superseded, and a superseded one not at all."""
    names = [c for c in before.columns if c != key]
    new = after.select(key, *[F.col(c).alias(f"_{c}") for c in names])
    both = before.join(new, key)
    changed = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in names]))
    beyond = F.array_except(changed, F.array(F.lit("state"), F.lit("superseding_release_id")))
    step = F.col("state").eqNullSafe(F.col("_state")) | can_transition(F.col("state"), F.col("_state"))
    fixed = F.col("state").isin("published", "superseded")
    named_once = F.col("superseding_release_id").isNull() | F.col("superseding_release_id").eqNullSafe(F.col("_superseding_release_id"))
    return both.select(key, changed.alias("changed"), (step & (~fixed | ((F.size(beyond) == 0) & named_once))).alias("allowed"))


def combined(source: DataFrame, system: DataFrame, key: str) -> DataFrame:
    """Source and system times of a key in one row, with the rules that they break."""
    from annalist.operators.quality import violations

    both = source.join(system, key)
    return both.withColumn("violations", violations(entity_time()))


def derived_time(df: DataFrame) -> DataFrame:
    """Adds the effective time and its basis to rows with both axes."""
    return df.withColumn("effective", time.effective_time(F.col("source_event_at"), F.col("source_updated_at"), F.col("observed_at")))


#: What an event on a new version of an article holds.
NEWS_EVENT = "article_id string, version_number int, content_access string, body_sha256 string, original_language string"


def decoded_news(rows: DataFrame, data: str) -> DataFrame:
    """Adds ``event`` and the ``violations`` of its rules; bytes that are no such event have ``undecodable`` alone and no event."""
    from annalist.operators.quality import violations

    read = rows.withColumn("event", hashing.decoded_event(F.col(data), NEWS_EVENT))
    fields = [F.col(f"event.{f.split()[0]}").alias(f.split()[0]) for f in NEWS_EVENT.split(", ")]
    # the rules read plain columns
    spread = read.select(F.struct(*rows.columns).alias("_row"), "event", *fields).withColumn("_broken", violations({"article": _text("article_id"), **news_version()}))
    whole = F.col("event").isNotNull() & F.col("version_number").isNotNull()
    return spread.select("_row.*", F.when(whole, F.col("event")).alias("event"), F.when(whole, F.col("_broken")).otherwise(F.array(F.lit("undecodable"))).alias("violations"))
