"""Queries on rule sets and on sinks: columns in SQL that both engines read, rules on one side, predicates on the other."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F

from annalist.functions import hashing, network, preserve, text, url
from annalist.operators import contracts, fetching, ledger, quality, relational, release, resolution, translation
from annalist.plans import decisions
from annalist.plans.catalogue import query
from annalist.sources import registry
from annalist.sources.scratch import materialize, scratch_path
from annalist.sources.tables import table

_UUID = "'00000000-0000-4000-8000-000000000000'"
_IS_UUID = "regexp_full_match({0}, '[0-9a-f]{{8}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}')"
_IS_SHA = "regexp_full_match({0}, '[0-9a-f]{{64}}')"
_SHA = "sha2('x', 256)"
_FILLED = "length({0}) >= 1"


def _when(every: int, then: str, otherwise: str, rest: int = 0) -> str:
    return f"CASE WHEN k % {every} = {rest} THEN {then} ELSE {otherwise} END"


def _rules(name: str, rules: Callable[[], dict], columns: dict[str, str], holds: dict[str, str]) -> None:
    """Register a query that gives the broken rules of rows made of the orders' keys.

    ``columns`` are SQL that Spark and the other engine read alike; ``holds`` says each rule again.
    """
    made = ", ".join(f"{sql.replace(_SHA, repr('2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881'))} AS {c}" for c, sql in columns.items())
    broken = ", ".join(f"CASE WHEN NOT coalesce({sql}, false) THEN '{rule}' END" for rule, sql in holds.items())

    def run(spark, sf):
        rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k")).select("k", *[F.expr(sql).alias(c) for c, sql in columns.items()])
        return quality.split(rows, rules())[1].select("k", F.array_join("violations", ",").alias("violations"))

    run.__name__ = name
    query(f"""WITH o AS (SELECT o_orderkey AS k FROM orders), r AS (SELECT k, {made} FROM o), v AS (SELECT k, list_sort(list_filter([{broken}], lambda x: x IS NOT NULL)) AS v FROM r)
SELECT k, array_to_string(v, ',') AS violations FROM v WHERE len(v) > 0""")(run)


_TIMES = {"observed_at": "timestamp '2026-01-01 00:00:00'", "fetched_at": _when(7, "cast(null as timestamp)", "timestamp '2026-01-01 00:00:01'"), "ingested_at": _when(5, "timestamp '2026-01-01 00:00:00'", "timestamp '2026-01-01 00:00:02'"), "source_event_at": _when(3, "timestamp '2026-01-01 00:00:01'", "cast(null as timestamp)"), "source_updated_at": _when(11, "timestamp '2026-01-01 00:00:01'", "timestamp '2025-01-01 00:00:00'")}
_TIME_RULES = {"times": "observed_at IS NOT NULL AND fetched_at IS NOT NULL AND ingested_at IS NOT NULL", "ingested_before_fetched": "ingested_at >= fetched_at", "event_is_fetch": "source_event_at IS NULL OR source_event_at <> fetched_at", "update_is_fetch": "source_updated_at IS NULL OR source_updated_at <> fetched_at"}
_BLOCKS = {"core": _when(4, "'[1]'", "'{\"a\":1}'"), "attributes": _when(9, "'{\"a\"'", "'{}'"), "latest_state": _when(13, "cast(null as string)", "'{\"s\":\"x\"}'")}
_BLOCK_RULES = {c: f"{c} IS NOT NULL AND json_valid({c}) AND json_type(CASE WHEN json_valid({c}) THEN {c} END) = 'OBJECT'" for c in _BLOCKS}
_STATE = """sha256('{"attributes":{},"core":{"a":1},"latest_state":{"s":"x"},"v":1}')"""

_rules("rules_source_time", contracts.source_time, {"source_time_precision": _when(3, "'week'", "'month'"), "source_time_inferred": _when(5, "cast(null as boolean)", "true"), "source_locale_raw": _when(2, "repeat('x', 60 + cast(k % 9 as int))", "cast(null as string)")}, {"precision": "source_time_precision IN ('second', 'minute', 'hour', 'day', 'month', 'year', 'unknown')", "inferred": "source_time_inferred IS NOT NULL", "locale": "source_locale_raw IS NULL OR length(source_locale_raw) <= 64"})
_rules("rules_effective_time", contracts.effective_time, {"basis": _when(4, "'guessed'", _when(3, "'source_event'", "'observed'")), "inferred": "k % 2 = 0"}, {"basis": "basis IN ('source_event', 'source_updated', 'observed')", "inferred": "basis = 'source_event' OR inferred"})
_rules("rules_money", contracts.money, {"amount_minor": _when(3, "cast(null as int)", "5"), "currency": _when(4, "'eur'", _when(5, "'EURO'", "'EUR'"))}, {"amount": "amount_minor IS NOT NULL", "currency": "regexp_full_match(currency, '[A-Z]{3}')"})
_rules("rules_measured_value", contracts.measured_value, {"value": _when(3, "cast(null as double)", "1.5"), "unit": _when(4, "''", "'kg'"), "raw_value": _when(5, "cast(null as string)", "'1,5'")}, {"value": "value IS NOT NULL", "unit": _FILLED.format("unit"), "raw": _FILLED.format("raw_value")})
_rules("rules_raw_artifact", contracts.raw_artifact, {"http_status": "cast(90 + k % 600 as int)", "requested_url": _when(3, "''", "'u'"), "final_url": _when(4, "cast(null as string)", "'u'"), "sha256": _when(5, f"upper({_SHA})", _SHA), "fetch_id": _when(7, "'1'", _UUID)}, {"status": "http_status BETWEEN 100 AND 599", "requested": _FILLED.format("requested_url"), "final": _FILLED.format("final_url"), "digest": _IS_SHA.format("sha256"), "fetch": _IS_UUID.format("fetch_id")})
_rules("rules_upload_claim", contracts.upload_claim, {"object_key": _when(3, "''", "'k'"), "owner": _when(5, "cast(null as string)", "'o'"), "status": _when(4, "'lost'", _when(7, "'expired'", "'leased'")), "lease_expires_at": _when(8, "cast(null as timestamp)", "timestamp '2026-01-01 00:00:00'"), "claim_generation": "k % 3"}, {"key": _FILLED.format("object_key"), "owner": _FILLED.format("owner"), "status": "status IN ('leased', 'committed', 'released', 'expired')", "lease": "lease_expires_at IS NOT NULL", "generation": "claim_generation >= 1"})
_rules("rules_lineage", lambda: {**contracts.lineage(), **contracts.lineage_task()}, {"fetch_id": _when(3, "'x'", _UUID), "raw_sha256": _when(4, "'0'", _SHA), "parser_version": _when(5, "''", "'1'"), "projection_task_id": _when(7, "'t'", _UUID), "lineage_task_id": _when(11, "cast(null as string)", _UUID)}, {"fetch": _IS_UUID.format("fetch_id"), "raw": _IS_SHA.format("raw_sha256"), "parser": _FILLED.format("parser_version"), "task": _IS_UUID.format("projection_task_id"), "lineage_task": "projection_task_id = lineage_task_id"})
_rules("rules_payload", contracts.payload, {**_TIMES, **_BLOCKS}, {**_TIME_RULES, **_BLOCK_RULES})
_rules("rules_payload_artifact", lambda: contracts.payload_matches_artifact({"news": ("news", "press"), "car": ("cars",)}), {"entity_uuid": "cast(k as string)", "artifact_entity_uuid": "cast(k - cast(k % 5 = 0 as int) as string)", "schema_version": "'1.0'", "artifact_schema_version": _when(4, "'1.1'", "'1.0'"), "entity_kind": _when(2, "'news'", "'car'"), "artifact_domain": _when(3, "'press'", "'cars'")}, {"entity": "k % 5 <> 0", "schema": "artifact_schema_version = '1.0'", "domain": "CASE WHEN entity_kind = 'news' THEN artifact_domain IN ('news', 'press') ELSE artifact_domain = 'cars' END"})
_rules("rules_observed_values", contracts.observed_values, {"amount_minor": _when(3, "cast(null as int)", "5"), "currency": _when(4, "cast(null as string)", "'EUR'"), "availability": _when(5, "''", _when(7, "repeat('a', 65)", "cast(null as string)")), "values": _when(6, "'{'", _when(11, "cast(null as string)", "'{\"a\":[1]}'"))}, {"price": "(amount_minor IS NULL AND currency IS NULL) OR (amount_minor IS NOT NULL AND currency IS NOT NULL)", "availability": "availability IS NULL OR length(availability) BETWEEN 1 AND 64", "values": "values IS NULL OR json_valid(values)"})
_rules("rules_projection_command", contracts.projection_command, {"entity_uuid": "'a'", "artifact_entity_uuid": _when(3, "'b'", "'a'"), "projection_version": "k % 4", "priority": "k % 105 - 2"}, {"entity": "artifact_entity_uuid = 'a'", "version": "projection_version >= 1", "priority": "priority BETWEEN 0 AND 100"})
_rules("rules_review_question", contracts.review_question, {"record_kind": _when(3, "'rumour'", _when(2, "'answer'", "'review'")), "content_version": _when(5, "''", "'1'")}, {"kind": "record_kind IN ('review', 'question', 'answer')", "content_version": _FILLED.format("content_version")})
_rules("rules_release_parts", lambda: {**contracts.release_watermark(), **contracts.source_inclusion(), **contracts.component_versions(), **{f"ref_{n}": c for n, c in contracts.entity_version_ref().items()}}, {"snapshot_at": _when(3, "cast(null as timestamp)", "timestamp '2026-01-01 00:00:00'"), "postgres_snapshot": _when(4, "''", "'1'"), "source_id": _when(5, "''", "'s'"), "policy_version": "'1'", "parser_version": _when(7, "''", "'1'"), "normalizer_version": "'1'", "matcher_version": _when(9, "cast(null as string)", "'1'"), "resolution_version": "'1'", "entity_uuid": _when(11, "'e'", _UUID), "projection_version": "k % 6"}, {"snapshot_at": "snapshot_at IS NOT NULL", "database": _FILLED.format("postgres_snapshot"), "source": _FILLED.format("source_id"), "policy": "true", "parser_version": _FILLED.format("parser_version"), "normalizer_version": "true", "matcher_version": _FILLED.format("matcher_version"), "resolution_version": "true", "ref_entity": _IS_UUID.format("entity_uuid"), "ref_version": "projection_version >= 1"})
_rules("rules_audit_context", contracts.audit_context, {"actor": _when(3, "''", "'a'"), "reason": _when(4, "cast(null as string)", "'r'"), "correlation_id": _when(5, "upper('00000000-0000-4000-8000-00000000000a')", _UUID)}, {"actor": _FILLED.format("actor"), "reason": _FILLED.format("reason"), "correlation": _IS_UUID.format("correlation_id")})
_rules("rules_normalized_url", contracts.normalized_url, {"original": _when(3, "''", "'x'"), "normalized": _when(4, "'https://a.example/?utm_x=1'", _when(5, "'https://a.example/?q=1&gclid=2'", "'https://a.example/?q=utm_x'"))}, {"original": _FILLED.format("original"), "tracking": "NOT regexp_matches(normalized, '[?&](utm_[^=&]*|gclid)=')"})
_rules("rules_entity_version", contracts.entity_version, {"version": "k % 5", "previous_version": _when(3, "cast(null as bigint)", "k % 4"), "previous_hash": _when(7, "cast(null as string)", _when(3, "cast(null as string)", "'h'")), "state_hash": _when(2, "'h'", "'i'"), "state_changed": "k % 2 = 1", "applied": "k % 5 > 1"}, {"previous": "(previous_version IS NULL) = (previous_hash IS NULL)", "changed": "state_changed = (previous_hash IS DISTINCT FROM state_hash)", "applied": "applied = coalesce(previous_version < version, true)"})


@query("""WITH r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN '[1]' ELSE '{"a":1}' END AS core, CASE WHEN o_orderkey % 6 = 0 THEN 'v1:0' ELSE 'v1:' || sha256('{"attributes":{},"core":{"a":1},"latest_state":{"s":"x"},"v":1}') END AS state_hash,
CASE WHEN o_orderkey % 3 = 0 THEN '1.2' WHEN o_orderkey % 3 = 1 THEN '2.0' ELSE '1.0' END AS schema_version, o_orderkey % 7 AS projection_version, o_orderkey % 5 AS seen FROM orders),
v AS (SELECT k, [CASE WHEN core = '[1]' THEN 'core' END, CASE WHEN schema_version = '2.0' THEN 'schema' END, CASE WHEN seen < 2 THEN 'seen' END, CASE WHEN state_hash = 'v1:0' OR core = '[1]' THEN 'state_hash' END, CASE WHEN projection_version < 1 THEN 'version' END] AS v FROM r)
SELECT k, array_to_string(list_filter(v, lambda x: x IS NOT NULL), ',') AS violations FROM v WHERE len(list_filter(v, lambda x: x IS NOT NULL)) > 0""")
def rules_current_document(spark, sf):
    k = F.col("k")
    right = hashing.state_hash(F.lit('{"a": 1.0}'), F.lit("{}"), F.lit('{"s": "x"}'))
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    rows = rows.select("k", F.when(k % 4 == 0, "[1]").otherwise('{"a":1}').alias("core"), F.lit("{}").alias("attributes"), F.lit('{"s":"x"}').alias("latest_state"), F.when(k % 6 == 0, "v1:0").otherwise(right).alias("state_hash"), F.when(k % 3 == 0, "1.2").when(k % 3 == 1, "2.0").otherwise("1.0").alias("schema_version"), (k % 7).alias("projection_version"), F.lit(2).alias("first_seen_at"), (k % 5).alias("last_seen_at"))
    return quality.split(rows, contracts.current_document("1.5"))[1].select("k", F.array_join("violations", ",").alias("violations"))


@query("""WITH r AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 = 0 THEN 'news_' ELSE 'cars_' END || n_nationkey AS id, CASE WHEN n_nationkey % 5 = 0 THEN 'ukr' ELSE 'UA' END AS country, n_name AS name, n_nationkey % 4 AS domains, n_nationkey * 5 AS rating, CASE WHEN n_nationkey % 7 = 0 THEN '' ELSE 'r' END AS research FROM nation),
v AS (SELECT k, [CASE WHEN country = 'ukr' THEN 'country' END, CASE WHEN domains < 1 THEN 'domains' END, CASE WHEN id NOT LIKE 'news\\_%' ESCAPE '\\' THEN 'id' END, CASE WHEN rating > 100 THEN 'rating' END, CASE WHEN research = '' THEN 'research' END] AS v FROM r)
SELECT k, array_to_string(list_filter(v, lambda x: x IS NOT NULL), ',') AS violations FROM v WHERE len(list_filter(v, lambda x: x IS NOT NULL)) > 0""")
def rules_registry_entry(spark, sf):
    k = F.col("n_nationkey")
    rows = table(spark, sf, "nation").select(k.alias("k"), F.concat(F.when(k % 3 == 0, "news_").otherwise("cars_"), k.cast("string")).alias("id"), F.lit("news").alias("kind"), F.when(k % 5 == 0, "ukr").otherwise("UA").alias("country"), F.col("n_name").alias("name"), F.slice(F.array(*map(F.lit, "abc")), F.lit(1), (k % 4).cast("int")).alias("domains"), (k * 5).alias("rating"), F.when(k % 7 == 0, "").otherwise("r").alias("research"))
    return quality.split(rows, contracts.registry_entry())[1].select("k", F.array_join("violations", ",").alias("violations"))


@query("""WITH r AS (SELECT o_orderkey AS k, o_orderkey % 70 AS n FROM orders), v AS (SELECT k, [CASE WHEN n = 0 OR n > 64 THEN 'contacts' END, CASE WHEN k % 4 = 0 THEN 'lineage_task' END, CASE WHEN k % 5 = 0 THEN 'version' END] AS v FROM r)
SELECT k, array_to_string(list_filter(v, lambda x: x IS NOT NULL), ',') AS violations FROM v WHERE len(list_filter(v, lambda x: x IS NOT NULL)) > 0""")
def rules_contact_observation(spark, sf):
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(k.alias("k"), F.array_repeat(F.lit("c"), (k % 70).cast("int")).alias("contacts"), (k % 5).alias("projection_version"), F.lit("t").alias("projection_task_id"), F.when(k % 4 == 0, "u").otherwise("t").alias("lineage_task_id"))
    return quality.split(rows, contracts.contact_observation())[1].select("k", F.array_join("violations", ",").alias("violations"))


_MANIFESTS = "CASE o_orderkey % 4 WHEN 0 THEN 'draft' WHEN 1 THEN 'published' WHEN 2 THEN 'superseded' ELSE 'building' END"


@query(f"""WITH m AS (SELECT o_orderkey AS k, {_MANIFESTS} AS state, o_orderkey % 3 = 0 AS bad_tag, o_orderkey % 5 = 0 AS short, o_orderkey % 7 = 0 AS twofold, o_orderkey % 11 = 0 AS dated, o_orderkey % 13 = 0 AS silent, o_orderkey % 6 = 0 AS named, o_orderkey % 9 = 0 AS bare FROM orders),
v AS (SELECT k, [CASE WHEN short THEN 'commit' END, CASE WHEN twofold THEN 'entities' END, CASE WHEN state IN ('published', 'superseded') AND (NOT dated OR bare) THEN 'evidence' END, CASE WHEN state NOT IN ('published', 'superseded') AND dated THEN 'published_at' END,
CASE WHEN silent THEN 'reasons' END, CASE WHEN bare THEN 'reports' END, CASE WHEN (state = 'superseded') <> named THEN 'superseding' END, CASE WHEN bad_tag THEN 'tag' END] AS v FROM m)
SELECT k, array_to_string(list_filter(v, lambda x: x IS NOT NULL), ',') AS violations FROM v WHERE len(list_filter(v, lambda x: x IS NOT NULL)) > 0""")
def rules_release_manifest(spark, sf):
    k = F.col("k")
    none, source = F.lit(None).cast("string"), "array<struct<source_id:string,policy_version:string,reason:string>>"
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.expr(_MANIFESTS).alias("state"))
    rows = rows.select("k", "state", k.cast("string").alias("release_id"), F.when(k % 3 == 0, "v 1").otherwise("v1.0").alias("tag"), F.when(k % 5 == 0, "abc").otherwise("abcdef0").alias("git_commit"), F.when(k % 7 == 0, "e").otherwise(none).alias("entity_versions"), F.lit("h").alias("partition_index_sha256"))
    silent = F.array(F.struct(F.lit("s").alias("source_id"), F.lit("1").alias("policy_version"), F.when(k % 13 == 0, "").otherwise("r").alias("reason"))).cast(source)
    bare = F.when(k % 9 == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(1)))
    rows = rows.withColumns({"excluded_sources": silent, "degraded_sources": F.lit(None).cast(source), "quality_report": F.lit("q"), "quality_report_artifact": F.when(k % 9 == 0, "q").otherwise(none), "reconciliation_result": none, "reconciliation_result_artifact": F.lit("r"), "published_at": F.when(k % 11 == 0, F.lit("now")), "parts": bare, "superseding_release_id": F.when(k % 6 == 0, F.concat(k.cast("string"), F.lit("n")))})
    return quality.split(rows, contracts.release_manifest())[1].select("k", F.array_join("violations", ",").alias("violations"))


@query(f"""WITH b AS (SELECT o_orderkey AS k, {_MANIFESTS} AS state, CASE WHEN o_orderkey % 4 = 2 THEN 'x' END AS named FROM orders), a AS (SELECT *, CASE k % 3 WHEN 0 THEN state WHEN 1 THEN 'superseded' ELSE 'building' END AS next, k % 5 = 0 AS parts, CASE WHEN k % 7 = 0 THEN 'y' ELSE named END AS next_named FROM b)
SELECT k AS release_id, (next = state OR (state, next) IN (('draft', 'building'), ('published', 'superseded'))) AND (state NOT IN ('published', 'superseded') OR (NOT parts AND (named IS NULL OR named IS NOT DISTINCT FROM next_named))) AS allowed FROM a""")
def manifest_updates(spark, sf):
    k = F.col("o_orderkey")
    before = table(spark, sf, "orders").select(k.alias("release_id"), F.expr(_MANIFESTS).alias("state"), F.lit(1).alias("parts"), F.when(k % 4 == 2, "x").alias("superseding_release_id"))
    r = F.col("release_id")
    after = before.select("release_id", F.when(r % 3 == 0, F.col("state")).when(r % 3 == 1, "superseded").otherwise("building").alias("state"), F.when(r % 5 == 0, 2).otherwise(1).alias("parts"), F.when(r % 7 == 0, "y").otherwise(F.col("superseding_release_id")).alias("superseding_release_id"))
    return contracts.manifest_update(before, after).select("release_id", "allowed")


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'event_is_fetch' ELSE '' END AS violations FROM events")
def combined_times(spark, sf):
    events, k = table(spark, sf, "events"), F.col("event_id")
    none = F.lit(None).cast("timestamp_ntz")
    source = events.select("event_id", F.when(k % 4 == 0, F.col("ts")).otherwise(none).alias("source_event_at"), none.alias("source_updated_at"))
    system = events.select("event_id", F.col("ts").alias("observed_at"), F.col("ts").alias("fetched_at"), F.col("ts").alias("ingested_at"))
    return contracts.combined(source, system, "event_id").select("event_id", F.array_join("violations", ",").alias("violations"))


# --- receipts, events and keys

@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'changes' ELSE 'outbox' END AS \"table\", user_id AS aggregate_id, sha256(event_type) AS event_sha256 FROM (SELECT * FROM events WHERE event_id % 3 > 0) UNION ALL SELECT event_id, CASE WHEN event_id % 2 = 1 THEN 'changes' ELSE 'outbox' END, user_id, sha256(event_type) FROM events WHERE event_id % 3 > 0")
def receipt_events(spark, sf):
    receipts = table(spark, sf, "events").select(F.when(F.col("event_id") % 3 > 0, F.col("event_id")).alias("event_id"), F.col("user_id").alias("entity_uuid"), F.lit(1).alias("result_version"), F.encode("event_type", "UTF-8").alias("event_bytes"))
    return contracts.event_rows(receipts).select("event_id", "table", "aggregate_id", "event_sha256")


@query("SELECT o_orderkey AS projection_task_id, 'h' || CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE o_orderstatus END AS event_sha256, o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 AS differs FROM orders")
def receipts_again(spark, sf):
    k = F.col("o_orderkey")
    names = ["entity_uuid", "target_collection", "document_id"]
    row = lambda digest, version: table(spark, sf, "orders").select(k.alias("projection_task_id"), *[F.lit("a").alias(n) for n in names], version.alias("projection_version"), F.lit(True).alias("applied_to_current"), F.lit(True).alias("state_changed"), F.lit(1).alias("result_version"), F.lit("h").alias("result_hash"), k.alias("event_id"), F.when(k % 2 == 0, digest).alias("event_sha256"), F.when(k % 2 == 1, digest).alias("event_artifact_sha256"))
    stored = contracts.acknowledgement(row(F.concat(F.lit("h"), F.col("o_orderstatus")), F.lit(1)), F.lit("now"))
    sent = contracts.acknowledgement(row(F.concat(F.lit("h"), F.when(k % 5 == 0, "x").otherwise(F.col("o_orderstatus"))), F.when(k % 7 == 0, 2).otherwise(1)), F.lit("now"))
    differs = contracts.same_receipt(stored, sent).select("projection_task_id", F.lit(True).alias("differs"))
    return sent.join(differs, "projection_task_id", "left").select("projection_task_id", "event_sha256", F.coalesce("differs", F.lit(False)).alias("differs"))


@query("""SELECT event_id, sha256(concat_ws(chr(31), event_type, CAST(user_id AS VARCHAR), 'v1')) AS parse_key, rtrim(rtrim(CAST(CAST(value AS DECIMAL(18, 4)) AS VARCHAR), '0'), '.') AS amount, event_type AS decoded_type, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS decoded_user, CASE event_id % 4 WHEN 0 THEN '$: object' WHEN 1 THEN '$.a: characters' WHEN 2 THEN '$: json' END AS beyond FROM events WHERE value <> 0""")
def keys_and_events(spark, sf):
    k = F.col("event_id")
    made = F.to_json(F.struct("event_type", F.when(k % 5 > 0, F.col("user_id")).alias("user_id")))
    event = hashing.encoded_event(made, "application/json")
    decoded = hashing.decoded_event(event["bytes"], "event_type string, user_id long")
    document = F.when(k % 4 == 0, F.lit("[1]")).when(k % 4 == 1, F.concat(F.lit('{"a":"'), F.repeat(F.lit("x"), F.lit(65_537)), F.lit('"}'))).when(k % 4 == 2, F.lit("{")).otherwise(F.lit('{"a":1}'))
    rows = table(spark, sf, "events").where("value <> 0").select("event_id", hashing.parse_key(F.col("event_type"), F.col("user_id").cast("string"), F.lit("v1")).alias("parse_key"), hashing.decimal_text(F.col("value").cast("decimal(18,4)")).alias("amount"), decoded.alias("d"), hashing.unbounded(document).alias("beyond"))
    return rows.select("event_id", "parse_key", "amount", F.col("d.event_type").alias("decoded_type"), F.col("d.user_id").alias("decoded_user"), "beyond")


# --- hosts and numbers

@query("SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'ssrf_forbidden_host' WHEN 1 THEN 'ssrf_forbidden_host' WHEN 2 THEN 'ssrf_forbidden_address' WHEN 3 THEN 'host_noncanonical_ip' END AS code FROM pages")
def host_names(spark, sf):
    k = F.col("page_id") % 5
    host = F.when(k == 0, "Localhost").when(k == 1, F.concat(url.host(F.col("url")), F.lit("."))).when(k == 2, F.concat(F.lit("0x7f."), (F.col("page_id") % 256).cast("string"))).when(k == 3, "8.8.2056").otherwise(url.host(F.col("url")))
    return table(spark, sf, "pages").select("page_id", network.host_guard(host)["code"].alias("code"))


@query("SELECT page_id, CASE WHEN page_id % 4 = 3 THEN '93.184.216.' || page_id % 200 END AS address, CASE page_id % 4 WHEN 0 THEN 'dns_error' WHEN 1 THEN 'ssrf_forbidden_address' WHEN 2 THEN 'ssrf_forbidden_address' END AS code FROM pages")
def pinned_addresses(spark, sf):
    k = F.col("page_id") % 4
    public = F.concat(F.lit("93.184.216."), (F.col("page_id") % 200).cast("string"))
    answers = F.when(k == 0, F.array().cast("array<string>")).when(k == 1, F.array(public, F.lit("10.0.0.1"))).when(k == 2, F.array(F.lit("::ffff:192.168.0.1"), public)).otherwise(F.array(public, F.lit("2606:2800::1")))
    return table(spark, sf, "pages").select("page_id", network.pinned(url.host(F.col("url")), answers).alias("p")).select("page_id", "p.*")


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '-' ELSE '' END || CAST(1000 + o_orderkey % 9000 AS VARCHAR) || CASE o_orderkey % 3 WHEN 0 THEN '.25' ELSE '' END AS number FROM orders")
def locale_numbers(spark, sf):
    k, whole = F.col("o_orderkey"), F.lit(1000) + F.col("o_orderkey") % 9000
    grouped = lambda mark: F.concat(F.substring(whole.cast("string"), 1, 1), F.lit(mark), F.substring(whole.cast("string"), 2, 3))
    raw = F.when(k % 3 == 0, F.concat(grouped("."), F.lit(",25"))).when(k % 3 == 1, grouped(",")).otherwise(grouped(" "))
    return table(spark, sf, "orders").select("o_orderkey", text.normalize_number(F.concat(F.when(k % 4 == 0, "−").otherwise(""), raw)).alias("number"))


_ESCAPED = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(f"SELECT doc_id, sha256({_ESCAPED}) AS unmasked_sha256, '' AS issues FROM documents")
def unmasked_texts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.expr(_ESCAPED).alias("html")).withColumn("m", preserve.mask(F.col("html")))
    return docs.select("doc_id", F.sha2(preserve.unmask(F.col("m.masked"), F.col("m")), 256).alias("unmasked_sha256"), F.array_join(preserve.issues(F.col("html"), F.col("m"), F.col("m.masked")), ",").alias("issues"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'fr' WHEN length(trim(regexp_replace(text, '[\x00-\x20\x7F]+', ' ', 'g'))) < 30 THEN 'de' ELSE lang END AS language,
CASE WHEN doc_id % 3 = 0 THEN 'lang_attribute' WHEN length(trim(regexp_replace(text, '[\x00-\x20\x7F]+', ' ', 'g'))) < 30 THEN 'inherited' ELSE 'classifier' END AS basis FROM documents""")
def segment_languages(spark, sf):
    from annalist.plans.records import learned_ranking

    article = F.struct(F.lit("de").alias("language"), F.lit(1.0).alias("confidence"), F.lit("metadata").alias("basis"), F.lit(False).alias("uncertain"), F.lit(None).cast("string").alias("candidate"))
    found = text.segment_language(F.when(F.col("doc_id") % 3 == 0, "fr-CA"), text.normalize(F.col("text")), learned_ranking(spark, sf)(F.col("text")), article, ["en", "de", "fr", "es"])
    return table(spark, sf, "documents").select("doc_id", found.alias("d")).select("doc_id", "d.language", "d.basis")


# --- sinks

@query("SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS row_count, min(c_custkey) AS least, max(c_custkey) AS most, false AS broken FROM customer GROUP BY c_mktsegment")
def release_round_trip(spark, sf):
    """Customers by segment, written as a release in small files, verified, and read from its manifest."""
    path = scratch_path(spark, "round-trip")
    release.write_release(table(spark, sf, "customer"), path, ["c_mktsegment"], ["c_custkey"], "c_custkey", rows_per_file=100)
    broken = release.verify_release(spark, path, ["c_mktsegment"], "c_custkey").select("c_mktsegment", F.lit(True).alias("b"))
    parts = spark.read.parquet(f"{path}/manifest").groupBy("c_mktsegment").agg(F.sum("row_count").alias("row_count"), F.min("min_time").alias("least"), F.max("max_time").alias("most"))
    return parts.join(broken, "c_mktsegment", "left").select("c_mktsegment", "row_count", "least", "most", F.coalesce("b", F.lit(False)).alias("broken"))


@query("SELECT user_id, min(event_id) AS event_id, strftime(arg_min(ts, event_id), '%Y-%m') AS month FROM events GROUP BY user_id, strftime(ts, '%Y-%m')")
def ledger_months(spark, sf):
    """The first event of each user and month, appended in three runs of which one comes twice."""
    path = scratch_path(spark, "ledger")
    events = table(spark, sf, "events").select("user_id", F.date_format("ts", "yyyy-MM").alias("m"), "event_id", "ts")
    for batch in (0, 1, 1, 2):
        ledger.append_once(spark, path, events.where(F.floor(F.col("event_id") * 3 / F.lit(events.count())) == batch), ["user_id", "m"], "event_id", month_of="ts")
    return ledger.ledger_rows(spark, path).select("user_id", "event_id", "month")


@query("""WITH d AS (SELECT DISTINCT 'raw/' || sha256(text) AS key, doc_id % 3 AS r, sha256(text) AS h FROM documents), first AS (SELECT DISTINCT key FROM d WHERE r < 2), second AS (SELECT DISTINCT key FROM d WHERE r > 0)
SELECT key, CASE WHEN key IN (SELECT key FROM first) THEN 'verified' ELSE 'new' END AS result FROM second""")
def objects_put(spark, sf):
    """Texts stored by the key of their content, in two runs that overlap."""
    path = scratch_path(spark, "objects")
    content = F.encode("text", "UTF-8")
    objects = table(spark, sf, "documents").select("doc_id", hashing.raw_object_key(content).alias("key"), content.alias("content"))
    ledger.put_objects(spark, path, objects.where("doc_id % 3 < 2").drop("doc_id"))
    return ledger.put_objects(spark, path, objects.where("doc_id % 3 > 0").drop("doc_id"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE 'v' || (1 + event_id % 3) END AS parser_version, CASE WHEN event_id % 3 = 2 THEN 'no_parser' WHEN event_id % 5 = 0 THEN 'malformed' END AS error, CASE WHEN event_id % 3 < 2 AND event_id % 5 > 0 THEN user_id END AS user_id FROM events")
def parsed_artifacts(spark, sf):
    k = F.col("event_id")
    content = F.when(k % 5 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct("user_id", "event_type")))
    kind = F.element_at(F.array(*map(F.lit, ("a", "b", "c"))), (k % 3 + 1).cast("int"))
    artifacts = table(spark, sf, "events").select("event_id", kind.alias("kind"), content.alias("content"))
    good, bad = registry.parsed(artifacts, {"a": "v1", "b": "v2"}, "user_id long, event_type string")
    return good.select("event_id", "parser_version", F.lit(None).cast("string").alias("error"), "record.user_id").union(bad.select("event_id", "parser_version", "error", F.lit(None).cast("long")))


@query("SELECT o_orderkey, o_orderstatus = 'O' AND o_orderkey % 3 = 1 AND o_orderdate > TIMESTAMP '1995-06-01' AS can_commit FROM orders")
def claims_to_commit(spark, sf):
    claims = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "leased").otherwise("released").alias("status"), (F.col("o_orderkey") % 3).alias("claim_generation"), F.col("o_orderdate").alias("lease_expires_at"))
    return relational.can_commit(claims, F.lit("1995-06-01 00:00:00").cast("timestamp_ntz"), F.lit(1)).select("o_orderkey", "can_commit")


@query("SELECT CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) THEN 'skipped' ELSE 'deleted' END AS result, CAST(count(*) AS BIGINT) AS objects FROM documents d GROUP BY 1")
def sweep_report(spark, sf):
    documents = table(spark, sf, "documents").select(F.col("doc_id").alias("object_key"))
    live = table(spark, sf, "labels").select(F.col("doc_id").alias("object_key"))
    return relational.swept(documents, live).groupBy("result").agg(F.count(F.lit(1)).alias("objects"))


@query("""WITH g AS (SELECT c_custkey AS k, (c_custkey - 1) // 4 % 4 AS kind, (c_custkey - 1) % 4 AS place, c_custkey - (c_custkey - 1) % 4 AS anchor FROM customer)
SELECT CAST(k AS VARCHAR) AS member, CASE WHEN kind = 0 AND place < 3 OR kind = 1 AND place < 2 THEN 'g' || anchor || '-2' WHEN kind = 3 THEN 'g' || anchor || '-4' END AS group_id FROM g WHERE k > 0 AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = anchor)""")
def groups_of_customers(spark, sf):
    customers = table(spark, sf, "customer").where("c_custkey > 0")
    known = customers.select((F.col("c_custkey") - (F.col("c_custkey") - 1) % 4).alias("anchor"), F.col("c_custkey").cast("string").alias("member"))
    known = known.join(customers.select(F.col("c_custkey").alias("anchor")), "anchor", "left_semi").select("member")
    return resolution.group_of(resolution.project_groups(decisions.scripted(spark, sf).drop("batch")), known, "member").select("member", "group_id")


#: A glossary: terms by language, or for all.
_GLOSSARY = {"schema": 1, "target_language": "uk", "pairs": {"en": [{"term": "the", "target": "той"}, {"term": "is", "keep": True}], "de": [{"term": "und", "target": "і"}], "*": [{"term": "Spark", "keep": True}]}}


@query("""WITH t(language, term, replacement) AS (VALUES ('en', 'the', 'той'), ('en', 'is', 'is'), ('de', 'und', 'і'), ('*', 'Spark', 'Spark'))
SELECT lang, term, replacement, CAST(count(*) AS BIGINT) AS documents FROM documents JOIN t ON language IN (lang, '*') GROUP BY ALL""")
def glossary_entries(spark, sf):
    terms = registry.glossary_terms(spark, registry.glossary(_GLOSSARY)[1])
    counts = table(spark, sf, "documents").where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("documents"))
    each = counts.withColumn("language", F.explode(F.array("lang", F.lit(registry.ANY_LANGUAGE))))
    return each.join(terms, "language").select("lang", "term", "replacement", "documents")


# --- retention and staleness

_OUTBOX = "o AS (SELECT o_orderkey AS event_id, CASE WHEN o_orderkey % 3 = 0 THEN 'internal' ELSE 'domain' END AS topic, o_orderdate AS created_at, CASE WHEN o_orderkey % 4 > 0 THEN o_orderdate + INTERVAL 1 DAY END AS published_at, o_orderkey % 11 = 0 AS parked, o_orderstatus FROM orders)"


@query(f"""WITH {_OUTBOX}, done AS (SELECT event_id FROM o WHERE o_orderstatus = 'F' AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = event_id AND l_returnflag = 'R'))
SELECT event_id FROM o WHERE event_id > 1000 AND ((topic = 'domain' AND published_at < TIMESTAMP '1996-06-01' AND NOT parked) OR (topic = 'internal' AND created_at < TIMESTAMP '1996-06-01' AND event_id IN (SELECT event_id FROM done))) ORDER BY event_id LIMIT 500""")
def purge_page(spark, sf):
    k, orders = F.col("o_orderkey"), table(spark, sf, "orders")
    outbox = orders.select(k.alias("event_id"), F.when(k % 3 == 0, "internal").otherwise("domain").alias("topic"), F.col("o_orderdate").alias("created_at"), F.when(k % 4 > 0, F.expr("o_orderdate + INTERVAL 1 DAY")).alias("published_at"), (k % 11 == 0).alias("parked"))
    tasks = orders.select(k.alias("event_id"), F.when(F.col("o_orderstatus") == "F", "succeeded").otherwise("pending").alias("status"))
    acknowledgements = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("event_id"))
    return ledger.purge_page(outbox, tasks, acknowledgements, F.lit("1996-06-01 00:00:00").cast("timestamp_ntz"), 1000, 500)


@query("""SELECT o_orderkey AS task_id, CASE o_orderstatus WHEN 'O' THEN 'retry' WHEN 'P' THEN 'leased' ELSE 'succeeded' END AS status FROM orders
WHERE o_orderkey > 100 AND (o_orderstatus = 'O' AND o_orderdate <= TIMESTAMP '1997-01-01' OR o_orderstatus = 'P' AND o_orderdate + INTERVAL 2 DAY <= TIMESTAMP '1997-01-01') ORDER BY o_orderkey LIMIT 300""")
def stale_tasks(spark, sf):
    status = F.when(F.col("o_orderstatus") == "O", "retry").when(F.col("o_orderstatus") == "P", "leased").otherwise("succeeded")
    tasks = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task_id"), status.alias("status"), F.col("o_orderdate").alias("not_before"), F.expr("o_orderdate + INTERVAL 2 DAY").alias("leased_at"))
    return ledger.stale_tasks(tasks, F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"), 100, 300).select("task_id", "status")


@query("""WITH i AS (SELECT user_id, max(ts) AS last, ['starting', 'ready', 'draining', 'stopped'][1 + user_id % 4] AS status FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN status <> 'stopped' AND (SELECT max(ts) FROM events) - last > INTERVAL 1 HOUR THEN 'stale' ELSE status END AS status FROM i""")
def stale_instances(spark, sf):
    events = table(spark, sf, "events")
    status = F.element_at(F.array(*map(F.lit, ("starting", "ready", "draining", "stopped"))), (F.col("user_id") % 4 + 1).cast("int"))
    instances = events.groupBy("user_id").agg(F.max("ts").alias("last_heartbeat_at")).withColumn("status", status)
    now = F.lit(events.agg(F.max("ts")).first()[0])
    return ledger.with_stale_instances(instances, now, 3_600).select("user_id", "status")


# --- bodies and robots files

@query("SELECT page_id, CASE WHEN page_id % 5 = 4 THEN NULL ELSE sha256(html) END AS body_sha256, CASE WHEN page_id % 5 = 4 THEN 'content_decoding_error' END AS error FROM pages")
def decoded_chains(spark, sf):
    """Bodies in gzip, in deflate within gzip, in two gzip layers, in upper-case names, and cut off."""

    @F.pandas_udf("binary")
    def packed(kinds: pd.Series, texts: pd.Series) -> pd.Series:
        def one(kind: int, body: bytes) -> bytes:
            inner = zlib.compress(body) if kind == 1 else gzip.compress(body) if kind == 2 else body
            return gzip.compress(inner)[: -9 if kind == 4 else None]

        return pd.Series([one(k, t.encode()) for k, t in zip(kinds, texts, strict=True)])

    k = F.col("page_id") % 5
    names = F.element_at(F.array(*map(F.lit, ("gzip", "deflate, gzip", "gzip,gzip", "GZIP", "x-gzip"))), (k + 1).cast("int"))
    rows = table(spark, sf, "pages").select("page_id", packed(k, F.col("html")).alias("body"), names.alias("content_encoding"))
    return registry.decoded_bodies(rows).select("page_id", F.sha2("data", 256).alias("body_sha256"), "error")


@query("""WITH p AS (SELECT page_id, page_id % 4 AS f, regexp_extract(url, '^https?://[^/?#]*([^#]*)', 1) AS path FROM pages)
SELECT page_id, CASE f WHEN 0 THEN NOT starts_with(path, '/en/') WHEN 1 THEN starts_with(path, '/fr/8') OR NOT starts_with(path, '/fr/') WHEN 2 THEN true ELSE starts_with(path, '/de/') END AS allowed FROM p""")
def robots_by_file(spark, sf):
    """Pages against robots files of four kinds, each of which is read once."""
    files = {0: b"User-agent: *\nDisallow: /en/\n", 1: b"User-agent: *\nAllow: /fr/8\nDisallow: /fr/\n", 2: b"User-agent: other\nDisallow: /\n", 3: b"User-agent: other\nAllow: /\n\nUser-agent: annalist\nAllow: /de/\nDisallow: /\n"}
    pages = table(spark, sf, "pages").withColumn("f", F.col("page_id") % 4)
    body = F.element_at(F.array(*[F.lit(bytearray(b)) for b in files.values()]), (F.col("f") + 1).cast("int"))
    rules = fetching.robots_rules(pages.select("f").distinct().withColumn("body", body), "annalist/1.0", ["f"])
    return pages.join(rules, "f").select("page_id", fetching.allowed(F.col("rules"), F.col("url")).alias("allowed"))


# --- events on news, failures and audits

@query("""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id % 5 END AS version, ['full', 'blocked'][1 + doc_id % 2] AS access, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 'x' END AS body, CASE WHEN doc_id % 11 = 0 THEN 'de-AT' ELSE lang END AS lang FROM documents),
v AS (SELECT doc_id, CASE WHEN version IS NULL THEN ['undecodable'] ELSE list_filter([CASE WHEN access = 'blocked' AND body IS NOT NULL THEN 'body_forbidden' END, CASE WHEN access = 'full' AND body IS NULL THEN 'body_missing' END, CASE WHEN lang = 'de-AT' THEN 'language' END, CASE WHEN version < 1 THEN 'version' END], lambda x: x IS NOT NULL) END AS v FROM d)
SELECT doc_id, array_to_string(v, ',') AS violations FROM v""")
def decoded_news(spark, sf):
    k = F.col("doc_id")
    event = F.struct(k.cast("string").alias("article_id"), (k % 5).alias("version_number"), F.element_at(F.array(F.lit("full"), F.lit("blocked")), (k % 2 + 1).cast("int")).alias("content_access"), F.when(k % 3 > 0, "x").alias("body_sha256"), F.when(k % 11 == 0, "de-AT").otherwise(F.col("lang")).alias("original_language"))
    data = F.when(k % 7 == 0, F.encode(F.lit("{broken"), "UTF-8")).otherwise(hashing.encoded_event(F.to_json(event), "application/json")["bytes"])
    return contracts.decoded_news(table(spark, sf, "documents").select("doc_id", data.alias("data")), "data").select("doc_id", F.array_join("violations", ",").alias("violations"))


@query("SELECT event_id, 'v' || (1 + event_id % 3) AS parser_version, 'malformed' AS error FROM events WHERE event_id % 3 < 2 AND event_id % 5 = 0 UNION ALL SELECT event_id, NULL, 'no_parser' FROM events WHERE event_id % 3 = 2")
def parse_failures(spark, sf):
    """Artifacts that no parser read, kept by artifact and parser version; the run comes twice."""
    k, path = F.col("event_id"), scratch_path(spark, "failures")
    kind = F.element_at(F.array(*map(F.lit, ("a", "b", "c"))), (k % 3 + 1).cast("int"))
    artifacts = table(spark, sf, "events").select("event_id", kind.alias("kind"), F.when(k % 5 == 0, F.lit("{broken")).otherwise("{}").alias("content"))
    failed = registry.parsed(artifacts, {"a": "v1", "b": "v2"}, "user_id long")[1].select("event_id", "parser_version", "error")
    for day in (1, 2):
        ledger.record_failures(spark, path, failed, ["event_id", "parser_version"], F.lit(f"2026-01-0{day} 00:00:00").cast("timestamp_ntz"))
    return ledger.ledger_rows(spark, path).select("event_id", "parser_version", "error")


@query("SELECT o_orderkey AS audit_id, strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE o_orderkey % 3 > 0 AND o_orderkey % 5 > 0")
def audit_trail(spark, sf):
    k, path = F.col("o_orderkey"), scratch_path(spark, "audit")
    rows = table(spark, sf, "orders").select(k.alias("audit_id"), F.when(k % 3 > 0, "clerk").otherwise("").alias("actor"), F.when(k % 5 > 0, "moved").alias("reason"), F.lit("00000000-0000-4000-8000-000000000000").alias("correlation_id"), F.col("o_orderdate").alias("at"))
    for _ in range(2):
        ledger.append_audit(spark, path, rows, "audit_id", "at")
    return ledger.ledger_rows(spark, path).select("audit_id", "month")


# --- translated markup

@query("""SELECT c_custkey, '<!-- k --><div title="' || CASE WHEN c_custkey % 2 = 0 THEN '&lt;' || c_mktsegment || '&quot;' ELSE c_mktsegment END || '"><h1>~' || c_name || '</h1><script>var x = "</p>";</script><p> ~' || c_mktsegment || ' <b>bold</b>: ' || c_custkey || '. </p><hr><ul><li>' || CASE WHEN c_custkey % 3 = 0 THEN 'one' ELSE '~one' END || '<li>~two</ul></div>' AS html FROM customer""")
def html_translated(spark, sf):
    """Documents with headings, inline elements, scripts, attributes and open list items, with translations put in."""
    k, name, segment = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    c = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    source = c('<!-- k --><div title="', segment, '"><h1>', name, '</h1><script>var x = "</p>";</script><p> ', segment, " <b>bold</b>: ", k.cast("string"), ". </p><hr><ul><li>one<li>two</ul></div>")
    # small rows make much work, so they are dealt to more tasks than their file has parts
    customers = table(spark, sf, "customer").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    parts = materialize(translation.pieces(customers.select("c_custkey", source.alias("html")), ["c_custkey"], "html", translated=("title",)), "pieces")
    new = F.when(F.col("kind") == "text", F.concat(F.lit("~"), F.col("html"))).otherwise(F.concat(F.lit("<"), F.col("text"), F.lit('"')))
    wanted = F.when(F.col("kind") == "text", ~((F.col("text") == "one") & (k % 3 == 0))).when(F.col("kind") == "attribute", k % 2 == 0).otherwise(False)
    return translation.reassemble(parts, ["c_custkey"], parts.where(wanted).select("c_custkey", "pos", new.alias("translated")))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN sha256('{"a":"\uFDD01\uFDD0","u":' || user_id || '}') WHEN 1 THEN sha256('{"a":[1.5,100,-2,0],"u":' || user_id || '}') WHEN 2 THEN sha256('{"a":{"b":null,"é":true},"u":"' || event_type || '"}') END AS document_sha256 FROM events""")
def canonical_hashes(spark, sf):
    """Nested documents whatever their order, forms of numbers and of letters; the last kind has no canonical form."""
    user, k = F.col("user_id").cast("string"), F.col("event_id") % 4
    c = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    document = F.when(k == 0, c('{"u": ', user, ', "a": "\ufdd01\ufdd0"}')).when(k == 1, c('{"a": [1.50, 1E2, -2.0, -0.0], "u": ', user, "}")).when(k == 2, c('{"u": "', F.col("event_type"), '", "a": {"e\u0301": true, "b": null}}')).otherwise(c('{"u": 1E999999999, "a": ', user, "}"))
    return table(spark, sf, "events").select("event_id", hashing.canonical_sha256(document).alias("document_sha256"))
