"""Queries on records and their rules: identity, resolution, upserts, time, queues, translation."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.functions import contacts, hashing, network, preserve, text, time, url
from annalist.operators import contracts, languages, quality, relational, release, resolution, temporal, translation
from annalist.plans.catalogue import query
from annalist.sources import registry
from annalist.sources.scratch import materialize
from annalist.sources.tables import entity_versions, fetch_attempts, table

_UUID = lambda c, kind: F.concat(F.lpad(F.lower(F.hex(c)), 8, "0"), F.lit(f"-0000-{kind}000-8000-000000000000"))


# --- resolution

def _decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer merges with the next; every fifth such decision is superseded by the one before, and tenths come in two versions."""
    key = F.col("c_custkey")
    members = F.array(key.cast("string"), (key - key % 2 + 100_000_000).cast("string"))
    at = F.timestamp_seconds(F.lit(1_700_000_000) + key)
    supersedes = F.when(key % 5 == 1, (key - 1).cast("string"))
    made = table(spark, sf, "customer").select(key.cast("string").alias("decision_id"), F.lit(1).alias("decision_version"), F.lit("merge").alias("action"), members.alias("members"), F.concat(F.lit("g"), key.cast("string")).alias("group_id"), at.alias("effective_at"), at.alias("recorded_at"), supersedes.alias("supersedes"))
    again = made.where("cast(decision_id as long) % 10 = 4").withColumn("decision_version", F.lit(2)).withColumn("group_id", F.concat("group_id", F.lit("b")))
    return made.union(again)


@query("""WITH d AS (SELECT c_custkey AS k, c_custkey - c_custkey % 2 AS pair FROM customer),
e AS (SELECT * FROM d WHERE NOT (k % 5 = 0 AND EXISTS (SELECT 1 FROM d x WHERE x.k = d.k + 1))),
latest AS (SELECT pair, max(k) AS k FROM e GROUP BY pair),
members AS (SELECT pair, CAST(k AS VARCHAR) AS member FROM e UNION ALL SELECT DISTINCT pair, CAST(pair + 100000000 AS VARCHAR) FROM e)
SELECT 'g' || l.k || CASE WHEN l.k % 10 = 4 THEN 'b' ELSE '' END AS group_id, m.member FROM latest l JOIN members m USING (pair)""")
def resolution_replay(spark, sf):
    return resolution.project_groups(_decisions(spark, sf))


@query("SELECT CAST(c_custkey AS VARCHAR) AS decision_id FROM customer WHERE c_custkey % 5 = 0 AND c_custkey + 1 IN (SELECT c_custkey FROM customer)")
def resolution_superseded(spark, sf):
    return resolution.snapshot(_decisions(spark, sf)).where("kind = 'superseded'").select(F.col("id").alias("decision_id"))


_OFFERS = "offers AS (SELECT p_partkey AS offer_id, CASE WHEN p_partkey % 2 = 0 THEN p_partkey END AS gtin, p_brand AS brand, p_type || p_size AS mpn FROM part), cat AS (SELECT p_partkey AS product_id, 4 * p_partkey AS gtin, p_brand AS brand, p_type || (p_size + 1) AS mpn FROM part)"


@query(f"""WITH {_OFFERS},
a AS (SELECT offer_id, min(product_id) AS product_id, 'gtin' AS rule FROM offers JOIN cat USING (gtin) GROUP BY offer_id),
b AS (SELECT offer_id, min(product_id) AS product_id, 'brand_mpn' AS rule FROM offers JOIN cat USING (brand, mpn) WHERE offer_id NOT IN (SELECT offer_id FROM a) GROUP BY offer_id)
SELECT * FROM a UNION ALL SELECT * FROM b""")
def match_cascade(spark, sf):
    part = table(spark, sf, "part")
    offers = part.select(F.col("p_partkey").alias("offer_id"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey")).alias("gtin"), F.col("p_brand").alias("brand"), F.concat("p_type", F.col("p_size").cast("string")).alias("mpn"))
    cat = part.select(F.col("p_partkey").alias("product_id"), (4 * F.col("p_partkey")).alias("gtin"), F.col("p_brand").alias("brand"), F.concat("p_type", (F.col("p_size") + 1).cast("string")).alias("mpn"))
    return resolution.match_cascade(offers, cat, [("gtin", ["gtin"]), ("brand_mpn", ["brand", "mpn"])], "offer_id", "product_id")


# --- upserts and diffs

@query("""WITH first AS (SELECT o_custkey, min(o_orderkey) AS job_id, arg_min(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY o_custkey), present AS (SELECT c_custkey AS o_custkey, -c_custkey AS job_id, 'done' AS status FROM customer WHERE c_acctbal < 0)
SELECT * FROM present UNION ALL SELECT * FROM first WHERE o_custkey NOT IN (SELECT o_custkey FROM present)""")
def enqueue_once(spark, sf):
    present = table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"), (-F.col("c_custkey")).alias("job_id"), F.lit("done").alias("status"))
    incoming = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("job_id"), F.col("o_orderstatus").alias("status"))
    return relational.insert_if_absent(present, incoming, ["o_custkey"], "job_id")


@query("""WITH cur AS (SELECT c_custkey AS id, c_acctbal AS v FROM customer), new AS (SELECT o_custkey AS id, CASE WHEN count(*) % 2 = 0 THEN max(o_totalprice) ELSE max(c_acctbal) END AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey UNION ALL SELECT s_suppkey + 1000000000, s_acctbal FROM supplier)
SELECT coalesce(cur.id, new.id) AS id, CASE WHEN new.id IS NULL THEN cur.v ELSE new.v END AS v, CAST(CASE WHEN cur.id IS NULL THEN 1 WHEN new.id IS NOT NULL AND cur.v IS DISTINCT FROM new.v THEN 2 ELSE 1 END AS BIGINT) AS revision FROM cur FULL JOIN new ON cur.id = new.id""")
def upsert_cursor(spark, sf):
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    cur = customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("v"), F.lit(1).cast("long").alias("revision"))
    both = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("o_custkey").alias("id")).agg(F.when(F.count(F.lit(1)) % 2 == 0, F.max("o_totalprice")).otherwise(F.max("c_acctbal")).alias("v"))
    new = both.union(table(spark, sf, "supplier").select(F.col("s_suppkey") + 1_000_000_000, "s_acctbal"))
    return relational.upsert_distinct(cur, new, ["id"], ["v"])


@query("""SELECT s.c_custkey AS id, s.c_nationkey AS nation, CASE WHEN t.s_suppkey IS NULL THEN 'created' WHEN t.s_nationkey = s.c_nationkey THEN 'same' ELSE 'conflict' END AS status FROM customer s LEFT JOIN supplier t ON t.s_suppkey = s.c_custkey""")
def insert_or_conflict(spark, sf):
    present = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"))
    incoming = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    return relational.insert_or_conflict(present, incoming, ["id"])


@query("""WITH had AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS version FROM orders WHERE o_orderstatus = 'F'), top AS (SELECT o_custkey, max(version) AS top FROM had GROUP BY o_custkey)
SELECT o.o_custkey, o.o_orderkey, CAST(coalesce(h.version, coalesce(t.top, 0) + row_number() OVER (PARTITION BY o.o_custkey, h.version IS NULL ORDER BY o.o_orderkey)) AS BIGINT) AS version, h.version IS NULL AS created
FROM orders o LEFT JOIN had h USING (o_custkey, o_orderkey) LEFT JOIN top t ON t.o_custkey = o.o_custkey""")
def next_versions(spark, sf):
    from pyspark.sql import Window

    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    had = orders.where("o_orderstatus = 'F'").withColumn("version", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))).drop("o_orderstatus")
    return relational.next_versions(had, orders.drop("o_orderstatus"), "o_custkey", step="o_orderkey")


@query("""WITH old AS (SELECT n_name AS name, CAST(n_regionkey AS VARCHAR) AS type, n_nationkey % 2 = 0 AS required FROM nation), new AS (SELECT s_suppkey AS k, n_name AS name, CAST(n_regionkey + (s_suppkey % 3 = 0)::INT AS VARCHAR) AS type, s_suppkey % 2 = 1 AS required FROM supplier JOIN nation ON s_suppkey = n_nationkey UNION ALL SELECT r_regionkey, r_name, 'r', r_regionkey % 2 = 0 FROM region)
SELECT name, CASE WHEN new.type IS NULL THEN 'removed' WHEN old.type IS NULL AND new.required THEN 'new_required' WHEN old.type <> new.type THEN 'type_changed' WHEN NOT old.required AND new.required THEN 'became_required' END AS problem FROM old FULL JOIN new USING (name)
WHERE new.type IS NULL OR (old.type IS NULL AND new.required) OR old.type <> new.type OR (NOT old.required AND new.required)""")
def schema_compat(spark, sf):
    nation, supplier, region = (table(spark, sf, t) for t in ("nation", "supplier", "region"))
    old = nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("type"), (F.col("n_nationkey") % 2 == 0).alias("required"))
    new = supplier.join(nation, F.col("s_suppkey") == F.col("n_nationkey")).select(F.col("n_name").alias("name"), (F.col("n_regionkey") + (F.col("s_suppkey") % 3 == 0).cast("int")).cast("string").alias("type"), (F.col("s_suppkey") % 2 == 1).alias("required"))
    return relational.schema_diff(old, new.union(region.select("r_name", F.lit("r"), F.col("r_regionkey") % 2 == 0)))


@query("""WITH parts AS (SELECT *, md5(l_comment) AS h FROM (SELECT *, concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR), strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')) AS l_comment FROM lineitem))
SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS row_count, min(l_shipdate) AS min_time, max(l_shipdate) AS max_time, CAST(sum(CAST('0x' || substr(h, 1, 13) AS BIGINT)::HUGEINT) AS VARCHAR) AS content_hash FROM parts GROUP BY ALL""")
def release_parts(spark, sf):
    line = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_shipdate", F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("content"))
    return release.part_manifest(line, ["l_returnflag", "l_linestatus"], "l_shipdate", content=["content"])


@query("""WITH m AS (SELECT o_orderkey AS k, ['draft', 'building', 'validating', 'published', 'failed', 'superseded'][1 + o_orderkey % 6] AS state, ['draft', 'building', 'validating', 'published', 'failed', 'superseded'][1 + o_custkey % 6] AS target FROM orders)
SELECT k, state, target, (state, target) IN (('draft', 'building'), ('draft', 'failed'), ('building', 'validating'), ('building', 'failed'), ('validating', 'published'), ('validating', 'failed'), ('published', 'superseded')) AS allowed FROM m""")
def release_transition(spark, sf):
    states = F.array(*map(F.lit, contracts.RELEASE_STEPS))
    at = lambda c: F.element_at(states, (F.col(c) % 6 + 1).cast("int"))
    states = F.array(*map(F.lit, ("draft", "building", "validating", "published", "failed", "superseded")))
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), at("o_orderkey").alias("state"), at("o_custkey").alias("target")).withColumn("allowed", contracts.can_transition(F.col("state"), F.col("target")))


# --- identity

@query("""SELECT p_partkey, 'v1:' || sha256('{"attributes":{"brand":"' || lower(p_brand) || '","mpn":"' || lower(regexp_replace(trim(p_name || '  ' || p_type), ' +', ' ', 'g')) || '"},"url":"https://shop.example/p/' || p_partkey || '","v":1}') AS identity_hash FROM part""")
def identity_hash(spark, sf):
    attributes = F.create_map(F.lit(" MPN"), F.concat("p_name", F.lit("  "), "p_type"), F.lit("Brand"), F.col("p_brand"), F.lit("none"), F.lit(" "))
    address = F.concat(F.lit(" https://shop.example/p/"), F.col("p_partkey").cast("string"))
    return table(spark, sf, "part").select("p_partkey", hashing.identity_hash(address, attributes).alias("identity_hash"))


@query("""SELECT event_id, 'v1:' || sha256('{"attributes":{"a":[1,2.5,"x"],"b":{"c":null,"d":true}},"core":{"k":' || json_extract_string(props, '$.k') || '},"latest_state":{"type":"' || event_type || '","user":' || user_id || '},"v":1}') AS state_hash FROM events""")
def state_hash(spark, sf):
    latest = F.concat(F.lit('{"user": '), F.col("user_id").cast("string"), F.lit(', "type": "'), F.col("event_type"), F.lit('"}'))
    return table(spark, sf, "events").select("event_id", hashing.state_hash(F.col("props"), F.lit('{"b": {"d": true, "c": null}, "a": [1, 2.50, "x"]}'), latest).alias("state_hash"))


@query("""SELECT conv_id, turn, sha256('{"article_version_id":"' || conv_id || '","glossary_version":"g","model_version":"nmt","provider":"p","target_language":"uk"}') AS translation_key,
sha256('{"glossary_version":"g","normalized_segment_hash":"' || sha256(trim(regexp_replace(nfc_normalize(text), '[\\x00-\\x20\\x7F]+', ' ', 'g'))) || '","provider":{"model_version":"nmt","name":"p"},"source_language":"' || role || '","target_language":"uk"}') AS memory_key FROM conversations""")
def translation_keys(spark, sf):
    g, model, provider = F.lit("g"), F.lit("nmt"), F.lit("p")
    key = hashing.translation_key(F.col("conv_id").cast("string"), F.lit(" UK "), provider, model, g)
    return table(spark, sf, "conversations").select("conv_id", "turn", key.alias("translation_key"), hashing.memory_key(F.col("role"), F.lit("uk"), hashing.segment_hash(F.col("text")), provider, model, g).alias("memory_key"))


@query("""SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) AS time_part, date_trunc('millisecond', ts) AS back FROM (SELECT event_id, ts, lpad(to_hex(epoch_ms(ts)), 12, '0') AS h FROM (SELECT event_id, ts FROM events))""".replace("to_hex(epoch_ms(ts))", "lower(to_hex(epoch_us(ts) // 1000))"))
def uuid7_ids(spark, sf):
    made = table(spark, sf, "events").select("event_id", hashing.uuid7(F.col("ts"), F.col("event_id"), F.col("event_id")).alias("id"))
    return made.select("event_id", F.substring("id", 1, 13).alias("time_part"), hashing.uuid7_time(F.col("id")).cast("timestamp_ntz").alias("back"))


@query("""SELECT doc_id, 'normalized/' || doc_id || '/' || sha256(text) || '.json' AS object_key, octet_length(encode('{"text":' || to_json(text) || '}')) > 262144 AS too_large FROM documents""")
def event_size(spark, sf):
    event = F.to_json(F.struct("text"))
    docs = table(spark, sf, "documents").select("doc_id", hashing.normalized_object_key(F.col("doc_id").cast("string"), hashing.sha256_hex("text")).alias("object_key"), hashing.encoded_event(event, "application/json").alias("e"))
    return docs.select("doc_id", "object_key", "e.too_large")


# --- labels, contacts, networks

@query(r"""SELECT c_custkey, lower(c_name) || '@' || lower(replace(c_mktsegment, ' ', '')) || '.example.com' AS email, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '+38067' || lpad(CAST(c_custkey % 10000000 AS VARCHAR), 7, '0') END AS phone FROM customer""")
def contact_forms(spark, sf):
    seven = F.lpad((F.col("c_custkey") % 10_000_000).cast("string"), 7, "0")
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("067 "), seven, F.lit(" ext"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("(067) "), F.substring(seven, 1, 3), F.lit("-"), F.substring(seven, 4, 4))).otherwise(F.concat(F.lit("00380 67 "), seven))
    address = F.concat(F.lit(" "), F.upper("c_name"), F.lit("@"), F.regexp_replace("c_mktsegment", " ", ""), F.lit(".Example.COM "))
    return table(spark, sf, "customer").select("c_custkey", contacts.contact(F.lit("email"), address).alias("email"), contacts.contact(F.lit("phone"), raw).alias("phone"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'de' WHEN 1 THEN 'pt' END AS tag, CASE o_orderkey % 5 WHEN 0 THEN 'full' WHEN 1 THEN 'metadata_only' WHEN 2 THEN 'gone' WHEN 3 THEN 'retryable' END AS access,
'GET https://[redacted]@h.example/' || o_orderkey || '?Token=[redacted]&q=' || o_custkey AS message, CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 3 = 1 THEN o_custkey END AS major, o_orderkey % 3 = 0 AND o_custkey <= 3 AS readable FROM orders""")
def label_forms(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pick = lambda n, *v: F.element_at(F.array(*map(F.lit, v)), (k % n + 1).cast("int"))
    version = F.when(k % 3 == 0, F.concat(F.lit("1."), c.cast("string"))).when(k % 3 == 1, F.concat(c.cast("string"), F.lit(".0"))).otherwise(F.concat(c.cast("string"), F.lit(".x")))
    message = F.concat(F.lit("GET https://me:pw@h.example/"), k.cast("string"), F.lit("?Token=ab"), k.cast("string"), F.lit("&q="), c.cast("string"))
    readable = text.readable(version, "1.3")
    return table(spark, sf, "orders").select("o_orderkey", text.language_tag(pick(4, " de-AT", "pt_BR", "eng", "")).alias("tag"), text.access_state(pick(5, " Free", "body_unavailable", "gone", "retryable", "nothing")).alias("access"), text.redact(message).alias("message"), text.schema_version(version)["major"].cast("long").alias("major"), (readable & (k % 3 == 0)).alias("readable"))


@query("""WITH h AS (SELECT event_id, [10, 127, 172, 192, 169, 100, 8, 0][1 + CAST(event_id % 8 AS INT)] AS a, CAST((event_id // 8) % 256 AS INT) AS b FROM events)
SELECT event_id, CASE WHEN a = 0 THEN 'private' WHEN a = 127 THEN 'loopback' WHEN a = 169 AND b = 254 THEN 'link-local' WHEN a = 10 OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168) THEN 'private' WHEN a = 100 AND b BETWEEN 64 AND 127 THEN 'not global' END AS why FROM h""")
def address_guard(spark, sf):
    first = F.element_at(F.array(*map(F.lit, (10, 127, 172, 192, 169, 100, 8, 0))), (F.col("event_id") % 8 + 1).cast("int"))
    second = F.floor(F.col("event_id") / 8) % 256
    host = F.concat_ws(".", first.cast("string"), second.cast("string"), F.lit("5"), F.lit("9"))
    return table(spark, sf, "events").select("event_id", network.host_guard(host)["why"].alias("why"))


@query("SELECT page_id, NOT (regexp_matches(url, '^https?://[^/]*/en/') OR regexp_matches(url, '^https?://[^/?#]*/[^?#]*\\?.*page=')) OR page_id % 3 = 0 AS allowed FROM pages".replace(" OR regexp_matches(url, '^https?://[^/?#]*/[^?#]*\\?.*page=')", ""))
def robots_rules(spark, sf):
    policy = F.when(F.col("page_id") % 3 == 0, "ignore").otherwise("respect")
    body = F.encode(F.lit("User-agent: *\nDisallow: /en/\nAllow: /fr/\n"), "UTF-8")
    return table(spark, sf, "pages").select("page_id", network.robots_allows(policy, body, F.col("url"), "reader").alias("allowed"))


@query("""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/moved/' || page_id WHEN url LIKE 'https:%' THEN NULL ELSE 'http://other.example/' || page_id END AS url, CASE WHEN page_id % 2 = 1 AND url LIKE 'https:%' THEN 'redirect_downgrade' END AS problem FROM pages""")
def redirects(spark, sf):
    location = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(" /moved/"), F.col("page_id").cast("string"), F.lit("#x"))).otherwise(F.concat(F.lit("http://other.example/"), F.col("page_id").cast("string")))
    return table(spark, sf, "pages").select("page_id", url.redirected(F.col("url"), location).alias("r")).select("page_id", "r.*")


# --- time and retries

@query("""WITH f AS (SELECT event_id, ['timeout', 'dns_error', 'media_binary_skipped', 'body_too_large', 'too_many_redirects'][1 + CAST(event_id % 5 AS INT)] AS error, event_id % 7 = 0 AS policy FROM events)
SELECT event_id, CASE WHEN policy THEN 'permanent_failure' WHEN error IN ('timeout', 'dns_error') THEN 'retryable' WHEN error = 'media_binary_skipped' THEN 'success' ELSE 'permanent_failure' END AS outcome, CASE WHEN NOT policy AND error = 'media_binary_skipped' THEN 'metadata_only' ELSE 'unknown' END AS access,
CASE WHEN policy THEN 'policy_blocked' ELSE error END AS code, CASE WHEN policy THEN error END AS reason, NOT policy AND error = 'body_too_large' AS quarantine FROM f""")
def error_classify(spark, sf):
    error = F.element_at(F.array(*map(F.lit, ("timeout", "dns_error", "media_binary_skipped", "body_too_large", "too_many_redirects"))), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", time.classify_error(error, F.col("event_id") % 7 == 0).alias("d")).select("event_id", "d.*")


@query("""WITH o AS (SELECT o_orderkey, ['retryable', 'success', 'permanent_failure'][1 + CAST(o_orderkey % 3 AS INT)] AS outcome, 1 + o_orderkey % 5 AS attempt, (o_custkey % 10) / 10.0 AS luck, CASE WHEN o_custkey % 4 = 0 THEN o_custkey % 200 END AS after FROM orders)
SELECT o_orderkey, outcome = 'retryable' AND attempt < 4 AS retry, round(CASE WHEN outcome = 'retryable' AND attempt < 4 THEN greatest([5, 30, 120, 600][CAST(attempt AS INT)] * (1 + luck * 0.2), coalesce(after, 0)) END::DOUBLE, 6) AS delay, outcome = 'permanent_failure' OR (outcome = 'retryable' AND attempt >= 4) AS dead_letter FROM o""")
def retry_decision(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    outcome = F.element_at(F.array(*map(F.lit, ("retryable", "success", "permanent_failure"))), (k % 3 + 1).cast("int"))
    planned = time.retry_plan(outcome, 1 + k % 5, F.when(c % 4 == 0, c % 200), (c % 10) / 10.0)
    return table(spark, sf, "orders").select("o_orderkey", planned.alias("p")).select("o_orderkey", "p.retry", F.round("p.delay", 6).alias("delay"), "p.dead_letter")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(least(greatest(o_orderkey, 5), 86400) AS BIGINT) WHEN o_orderkey % 3 = 1 AND o_orderdate >= TIMESTAMP '1997-01-01' THEN CAST(least(greatest(epoch(o_orderdate) - epoch(TIMESTAMP '1997-01-01'), 5), 86400) AS BIGINT) ELSE 600 END AS seconds,
CASE WHEN o_orderkey % 2 = 0 THEN greatest(o_orderdate, TIMESTAMP '1997-01-01') ELSE TIMESTAMP '1997-01-01' + to_seconds(o_custkey) END AS next_at FROM orders""")
def retry_times(spark, sf):
    now, k = F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"), F.col("o_orderkey")
    header = F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, F.date_format("o_orderdate", "EEE, d MMM yyyy HH:mm:ss 'GMT'")).otherwise("-5")
    at = time.next_attempt(now, F.col("o_custkey"), F.when(k % 2 == 0, F.col("o_orderdate")))
    return table(spark, sf, "orders").select("o_orderkey", time.retry_after_seconds(header, now).alias("seconds"), at.alias("next_at"))


# --- rules

def _broken(df: DataFrame, key: str, rules: dict) -> DataFrame:
    return quality.split(df, rules)[1].select(key, F.array_join("violations", ",").alias("violations"))


@query("""WITH t AS (SELECT event_id, ts AS fetched_at, CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 1 HOUR END AS source_event_at, ts + to_seconds(event_id % 5 - 1) AS ingested_at, event_id % 6 = 0 AS inferred FROM events)
SELECT event_id, array_to_string(list_filter([CASE WHEN event_id % 4 = 0 THEN 'event_is_fetch' END, CASE WHEN ingested_at < fetched_at THEN 'ingested_before_fetched' END], lambda x: x IS NOT NULL), ',') AS violations FROM t WHERE event_id % 4 = 0 OR ingested_at < fetched_at""")
def dq_times(spark, sf):
    k = F.col("event_id")
    rows = table(spark, sf, "events").select("event_id", F.col("ts").alias("observed_at"), F.col("ts").alias("fetched_at"), F.when(k % 4 == 0, F.col("ts")).when(k % 4 == 1, F.expr("ts - INTERVAL 1 HOUR")).alias("source_event_at"), F.lit(None).cast("timestamp_ntz").alias("source_updated_at"), F.expr("ts + make_dt_interval(0, 0, 0, event_id % 5 - 1)").alias("ingested_at"))
    return _broken(rows, "event_id", contracts.entity_time())


@query("""WITH i AS (SELECT o_orderkey, o_orderdate AS valid_from, o_orderdate + to_days(CAST(o_orderkey % 5 - 2 AS INT)) AS valid_to, o_orderdate AS known_from, CASE WHEN o_custkey % 3 > 0 THEN o_orderdate + to_days(CAST(o_custkey % 4 AS INT)) END AS known_to FROM orders)
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN known_to <= known_from THEN 'known' END, CASE WHEN valid_to < valid_from THEN 'valid' END], lambda x: x IS NOT NULL), ',') AS violations FROM i WHERE coalesce(known_to <= known_from, false) OR valid_to < valid_from""")
def dq_intervals(spark, sf):
    at = lambda c, days: F.timestamp_micros(F.unix_micros(F.col(c).cast("timestamp")) + days * 86_400_000_000).cast("timestamp_ntz")
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("valid_from"), at("o_orderdate", F.col("o_orderkey") % 5 - 2).alias("valid_to"), F.col("o_orderdate").alias("known_from"), F.when(F.col("o_custkey") % 3 > 0, at("o_orderdate", F.col("o_custkey") % 4)).alias("known_to"))
    return _broken(rows, "o_orderkey", contracts.bitemporal_interval())


@query("""WITH c AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'phone' WHEN 1 THEN 'email' ELSE 'url' END AS kind, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS raw, CASE c_custkey % 4 WHEN 0 THEN '+3806712345' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') WHEN 1 THEN c_name WHEN 2 THEN lower(c_name) END AS normalized FROM customer), v AS (SELECT *,
kind = 'email' AND normalized <> lower(normalized) AS email, kind = 'phone' AND NOT regexp_full_match(normalized, '\\+[1-9][0-9]{6,14}') AS phone FROM c)
SELECT c_custkey, array_to_string(list_filter([CASE WHEN email THEN 'email' END, CASE WHEN phone THEN 'phone' END, CASE WHEN raw = '' THEN 'raw' END], lambda x: x IS NOT NULL), ',') AS violations FROM v WHERE email OR phone OR raw = ''""".replace("\\\\", "\\"))
def dq_contacts(spark, sf):
    k, name = F.col("c_custkey"), F.col("c_name")
    normal = F.when(k % 4 == 0, F.concat(F.lit("+3806712345"), F.lpad((k % 100).cast("string"), 2, "0"))).when(k % 4 == 1, name).when(k % 4 == 2, F.lower(name))
    rows = table(spark, sf, "customer").select("c_custkey", F.when(k % 3 == 0, "phone").when(k % 3 == 1, "email").otherwise("url").alias("kind"), F.when(k % 5 == 0, "").otherwise(name).alias("raw"), normal.alias("normalized"))
    return _broken(rows, "c_custkey", contracts.contact_value())


@query("""WITH s AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE '' END || c_name AS item, c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) AS known FROM customer)
SELECT c_custkey, array_to_string(list_filter([CASE WHEN item <> trim(item) THEN 'item' END, CASE WHEN NOT known THEN 'source' END], lambda x: x IS NOT NULL), ',') AS violations FROM s WHERE item <> trim(item) OR NOT known""")
def dq_sources(spark, sf):
    known = table(spark, sf, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("id"))
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("source_id"), F.concat(F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(""), "c_name").alias("source_item_id"))
    return _broken(contracts.with_registry(rows, known), "c_custkey", contracts.source_identity())


@query("""WITH d AS (SELECT o_orderkey AS k, ['merge', 'manual_link', 'manual_block', 'unmerge', 'reject'][1 + CAST(o_orderkey % 5 AS INT)] AS action, CASE WHEN o_custkey % 3 = 0 THEN [o_custkey] WHEN o_custkey % 3 = 1 THEN [o_custkey, o_custkey] ELSE [o_custkey, o_custkey + 1] END AS members, o_custkey % 7 > 0 AS grouped, CASE WHEN o_custkey % 4 > 0 THEN (o_custkey % 13) / 10.0 END AS score, o_custkey % 11 = 0 AS own FROM orders),
v AS (SELECT k, [CASE WHEN len(list_distinct(members)) <> len(members) THEN 'distinct' END, CASE WHEN action IN ('merge', 'manual_link') AND NOT grouped THEN 'group' END, CASE WHEN action IN ('merge', 'manual_link', 'manual_block') AND len(members) < 2 THEN 'members' END, CASE WHEN (action = 'merge' AND score IS NULL) OR coalesce(score > 1, false) THEN 'score' END, CASE WHEN own THEN 'supersedes_itself' END] AS v FROM d)
SELECT k, array_to_string(list_filter(v, lambda x: x IS NOT NULL), ',') AS violations FROM v WHERE len(list_filter(v, lambda x: x IS NOT NULL)) > 0""")
def dq_decisions(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    members = F.when(c % 3 == 0, F.array(c)).when(c % 3 == 1, F.array(c, c)).otherwise(F.array(c, c + 1))
    action = F.element_at(F.array(*map(F.lit, ("merge", "manual_link", "manual_block", "unmerge", "reject"))), (k % 5 + 1).cast("int"))
    rows = table(spark, sf, "orders").select(k.alias("k"), F.lit(1).alias("decision_version"), action.alias("action"), members.alias("members"), F.when(c % 7 > 0, c).alias("group_id"), F.when(c % 4 > 0, (c % 13) / 10.0).alias("score"), k.alias("decision_id"), F.when(c % 11 == 0, k).alias("supersedes"))
    return _broken(rows, "k", contracts.resolution_decision())


@query("""WITH n AS (SELECT doc_id, ['full', 'partial', 'blocked', 'gone', 'premium'][1 + CAST(doc_id % 5 AS INT)] AS access, CASE WHEN n_chars > 1000 THEN sha256(text) END AS body, lang FROM documents),
v AS (SELECT doc_id, [CASE WHEN access IN ('blocked', 'gone') AND body IS NOT NULL THEN 'body_forbidden' END, CASE WHEN access = 'full' AND body IS NULL THEN 'body_missing' END, CASE WHEN doc_id % 17 = 0 THEN 'language' END] AS v FROM n)
SELECT doc_id, array_to_string(list_filter(v, lambda x: x IS NOT NULL), ',') AS violations FROM v WHERE len(list_filter(v, lambda x: x IS NOT NULL)) > 0""")
def dq_news(spark, sf):
    access = F.element_at(F.array(*map(F.lit, ("full", "partial", "blocked", "gone", "premium"))), (F.col("doc_id") % 5 + 1).cast("int"))
    rows = table(spark, sf, "documents").select("doc_id", F.lit(1).alias("version_number"), access.alias("content_access"), F.when(F.col("n_chars") > 1000, F.sha2("text", 256)).alias("body_sha256"), F.when(F.col("doc_id") % 17 == 0, "de-AT").otherwise(F.col("lang")).alias("original_language"))
    return _broken(rows, "doc_id", contracts.news_version())


@query("""WITH t AS (SELECT doc_id, ['translated', 'translation_failed', 'pending'][1 + CAST(doc_id % 3 AS INT)] AS status, CASE WHEN n_chars % 2 = 0 THEN 'T' END AS title, CASE WHEN n_chars % 5 = 0 THEN 'again' END AS plan, CASE WHEN n_chars % 7 = 0 THEN ['b', 'a'] ELSE ['a', 'b'] END AS flags, n_chars % 4 - 1 AS cost, n_chars % 9 = 0 AS wrong FROM documents),
v AS (SELECT doc_id, [CASE WHEN cost < 0 THEN 'cost' END, CASE WHEN flags = ['b', 'a'] THEN 'flags' END, CASE WHEN wrong THEN 'key' END, CASE WHEN (status = 'translation_failed') <> (plan IS NOT NULL) THEN 'retry_plan' END, CASE WHEN status = 'pending' AND title IS NOT NULL THEN 'text' END, CASE WHEN status = 'translated' AND title IS NULL THEN 'title' END] AS v FROM t)
SELECT doc_id, array_to_string(list_filter(v, lambda x: x IS NOT NULL), ',') AS violations FROM v WHERE len(list_filter(v, lambda x: x IS NOT NULL)) > 0""")
def dq_translations(spark, sf):
    n, k = F.col("n_chars"), F.col("doc_id")
    rows = table(spark, sf, "documents").select("doc_id", F.element_at(F.array(*map(F.lit, ("translated", "translation_failed", "pending"))), (k % 3 + 1).cast("int")).alias("status"), F.when(n % 2 == 0, "T").alias("title"), F.lit(None).cast("string").alias("lead"), F.lit(None).cast("string").alias("body_text"), F.lit(None).cast("string").alias("body_artifact"), F.when(n % 5 == 0, "again").alias("retry_plan"), F.when(n % 7 == 0, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("quality_flags"), (n % 4 - 1).alias("cost_minor"), k.cast("string").alias("article_version_id"), F.lit("uk").alias("target_language"), F.lit("p").alias("provider"), F.lit("m").alias("model_version"), F.lit("g").alias("glossary_version"), (n % 9 == 0).alias("wrong"))
    key = F.when(F.col("wrong"), F.sha2(F.lit("x"), 256)).otherwise(hashing.translation_key(*map(F.col, ("article_version_id", "target_language", "provider", "model_version", "glossary_version"))))
    return _broken(rows.withColumn("translation_idempotency_key", key), "doc_id", contracts.news_translation())


@query("""WITH cas AS (SELECT event_id, user_id, event_id AS version, event_type AS state_hash, lag(event_id) OVER w AS previous_version, lag(event_type) OVER w AS previous_hash FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
v AS (SELECT event_id, [CASE WHEN NOT (event_id % 3 > 0) = (previous_version IS NULL OR previous_version < version) THEN 'applied' END, CASE WHEN (event_id % 2 = 0) <> (previous_hash IS DISTINCT FROM state_hash) THEN 'changed' END] AS v FROM cas)
SELECT event_id, array_to_string(list_filter(v, lambda x: x IS NOT NULL), ',') AS violations FROM v WHERE len(list_filter(v, lambda x: x IS NOT NULL)) > 0""")
def dq_versions(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event_id")
    k = F.col("event_id")
    rows = table(spark, sf, "events").select("event_id", k.alias("version"), F.col("event_type").alias("state_hash"), F.lag("event_id").over(w).alias("previous_version"), F.lag("event_type").over(w).alias("previous_hash"), (k % 3 > 0).alias("applied"), (k % 2 == 0).alias("state_changed"))
    return _broken(rows, "event_id", contracts.entity_version())


@query("""WITH p AS (SELECT s_suppkey, s_suppkey % 3 - 1 AS least, s_suppkey % 5 AS most, s_suppkey % 4 AS wanted, s_nationkey % 2 AS each, CASE WHEN s_suppkey % 9 = 0 THEN 'off' ELSE 'auto' END AS mode FROM supplier),
v AS (SELECT s_suppkey, [CASE WHEN each < 1 THEN 'concurrency' END, CASE WHEN NOT wanted BETWEEN least AND most THEN 'desired' END, CASE WHEN least < 0 THEN 'least' END, CASE WHEN mode = 'off' THEN 'mode' END, CASE WHEN most < least THEN 'most' END] AS v FROM p)
SELECT s_suppkey, array_to_string(list_filter(v, lambda x: x IS NOT NULL), ',') AS violations FROM v WHERE len(list_filter(v, lambda x: x IS NOT NULL)) > 0""")
def dq_pools(spark, sf):
    k = F.col("s_suppkey")
    rows = table(spark, sf, "supplier").select("s_suppkey", (k % 3 - 1).alias("min_replicas"), (k % 5).alias("max_replicas"), (k % 4).alias("desired_replicas"), (F.col("s_nationkey") % 2).alias("desired_concurrency"), F.when(k % 9 == 0, "off").otherwise("auto").alias("mode"))
    return _broken(rows, "s_suppkey", contracts.worker_pool())


@query("SELECT o_custkey, o_orderpriority, CAST(count(*) AS BIGINT) AS rows FROM orders GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return contracts.duplicate_keys(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"])


# --- queues

_LEASES = "leases AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'leased' ELSE 'done' END AS status, o_orderdate AS lease_expires_at, 1 + o_custkey % 4 AS attempt FROM orders)"


@query(f"WITH {_LEASES} SELECT o_orderkey, CASE WHEN attempt < 4 THEN 'retry' ELSE 'dead' END AS next_status FROM leases WHERE status = 'leased' AND lease_expires_at <= TIMESTAMP '1997-01-01'")
def expired_leases(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "leased").otherwise("done").alias("status"), F.col("o_orderdate").alias("lease_expires_at"), (1 + F.col("o_custkey") % 4).alias("attempt"))
    return relational.expired_leases(rows, F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"), F.lit(4)).select("o_orderkey", "next_status")


@query("""SELECT o_orderpriority, CAST(count(*) FILTER (o_orderkey % 7 > 0) AS BIGINT) AS waiting, CAST(count(*) FILTER (o_orderkey % 7 = 0) AS BIGINT) AS parked, CAST(greatest(epoch(TIMESTAMP '1999-01-01') - epoch(min(o_orderdate) FILTER (o_orderkey % 7 > 0)), 0) AS DOUBLE) AS oldest_seconds FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_orderpriority""")
def outbox_backlog(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderpriority", F.col("o_orderdate").alias("created_at"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("published_at"), (F.col("o_orderkey") % 7 == 0).alias("parked"))
    return relational.backlog(rows, F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"), "o_orderpriority")


@query("SELECT o_orderdate AS created_at, o_orderkey AS event_id FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 7 > 0 AND o_orderpriority = '1-URGENT' ORDER BY 1, 2 LIMIT 100")
def outbox_page(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderdate").alias("created_at"), F.col("o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("topic"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("published_at"), (F.col("o_orderkey") % 7 == 0).alias("parked"))
    return relational.unpublished(rows, ["created_at", "event_id"], 100, "1-URGENT").select("created_at", "event_id")


@query("""SELECT d.doc_id FROM documents d WHERE d.doc_id % 3 = 0 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AND NOT EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = d.doc_id AND c.turn % 2 = 0)""")
def sweep_candidates(spark, sf):
    now = F.lit("2026-01-10 00:00:00").cast("timestamp_ntz")
    made = F.when(F.col("doc_id") % 3 == 0, F.lit("2026-01-01")).otherwise(F.lit("2026-01-09 23:59:00")).cast("timestamp_ntz")
    objects = table(spark, sf, "documents").select(F.col("doc_id").alias("object_key"), made.alias("created_at"))
    claims = table(spark, sf, "conversations").select(F.col("conv_id").alias("object_key"), F.when(F.col("turn") % 2 == 0, "leased").otherwise("released").alias("status"), F.lit("2026-01-11").cast("timestamp_ntz").alias("lease_expires_at"))
    found = relational.orphans(objects, table(spark, sf, "labels").select(F.col("doc_id").alias("object_key")), claims, now, 3600)
    return found.select(F.col("object_key").alias("doc_id"))


@query("""WITH runs AS (SELECT DISTINCT l_returnflag AS source, CAST(date_trunc('month', l_shipdate) AS DATE) AS run FROM lineitem), bar AS (SELECT source, run AS bar FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY run DESC) AS n FROM runs) WHERE n = 3)
SELECT l_returnflag AS source, l_partkey AS item, max(CAST(date_trunc('month', l_shipdate) AS DATE)) AS last_seen FROM lineitem JOIN bar ON l_returnflag = bar.source GROUP BY ALL HAVING max(CAST(date_trunc('month', l_shipdate) AS DATE)) < any_value(bar)""")
def removals(spark, sf):
    seen = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("source"), F.col("l_partkey").alias("item"), F.trunc("l_shipdate", "month").alias("run"))
    return relational.removals(seen, seen.select("source", "run").distinct(), key="item", source="source", run="run")


@query("""WITH d AS (SELECT l_returnflag, CAST(l_shipdate AS DATE) AS day, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY ALL), f AS (SELECT l_returnflag, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.95) AS p95, regr_slope(n, day - DATE '1970-01-01') AS slope, regr_intercept(n, day - DATE '1970-01-01') AS base, max(day - DATE '1970-01-01') AS last FROM d GROUP BY l_returnflag)
SELECT l_returnflag, round(p50, 4) AS p50, round(p95, 4) AS p95, round(greatest(0, base + slope * (last + 30)), 3) AS in_30_days, round(greatest(0, base + slope * (last + 365)), 3) AS in_365_days FROM f""")
def capacity_forecast(spark, sf):
    daily = table(spark, sf, "lineitem").groupBy("l_returnflag", F.col("l_shipdate").cast("date").alias("day")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    found = relational.forecast(daily, "l_returnflag", "day", "n")
    return found.select("l_returnflag", F.round("p50", 4).alias("p50"), F.round("p95", 4).alias("p95"), F.round("in_30_days", 3).alias("in_30_days"), F.round("in_365_days", 3).alias("in_365_days"))


@query("""WITH f AS (SELECT event_id, ts, user_id AS source_id, [200, 304, 404, 500][1 + CAST(event_id % 4 AS INT)] AS http_status FROM events)
SELECT source_id, max(ts) AS fetched_at, arg_max(http_status, (ts, http_status)) AS http_status, CASE WHEN arg_max(http_status, (ts, http_status)) <> 404 THEN arg_max(CASE WHEN http_status = 200 THEN 'sha' || event_id END, ts) FILTER (http_status = 200) END AS raw_sha256, max(ts) > TIMESTAMP '2024-03-01' AS fresh FROM f WHERE http_status IN (200, 304, 404) GROUP BY source_id""")
def robots_snapshots(spark, sf):
    status = F.element_at(F.array(*map(F.lit, (200, 304, 404, 500))), (F.col("event_id") % 4 + 1).cast("int"))
    rows = table(spark, sf, "events").select(F.col("user_id").alias("source_id"), F.lit("r").alias("requested_url"), F.lit("robots").alias("request_variant"), F.col("ts").alias("fetched_at"), status.alias("http_status"), F.when(status == 200, F.concat(F.lit("sha"), F.col("event_id").cast("string"))).alias("raw_sha256"))
    now = F.lit("2024-03-02 00:00:00").cast("timestamp_ntz")
    return network.latest_robots(rows, now, 86_400).drop("requested_url")


@query("SELECT doc_id, CASE WHEN b.item_id IS NULL THEN 'new' WHEN sha256(d.text) = sha256(b.text) THEN 'verified' ELSE 'mismatch' END AS result FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id")
def upload_check(spark, sf):
    stored = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), F.sha2("text", 256).alias("sha256"))
    incoming = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return relational.changed_documents(stored, incoming, "doc_id", "sha256").select("doc_id", "result")


@query("SELECT c.c_custkey AS key, o.o_orderkey AS version, o.o_totalprice AS total FROM customer c JOIN (SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey) i ON i.o_custkey = c.c_custkey JOIN orders o ON o.o_custkey = i.o_custkey AND o.o_orderkey = i.o_orderkey WHERE c.c_mktsegment = 'BUILDING'")
def located_read(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("version"), F.col("o_totalprice").alias("total"))
    index = orders.groupBy("key").agg(F.max("version").alias("version"))
    probes = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("key"))
    return relational.located(index, orders, probes)


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS retries FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND event_id % 13 IN (4, 11) OR (ts >= TIMESTAMP '2024-01-10' AND event_id % 13 IN (0, 5, 9, 12) AND event_id % 11 = 0) OR (ts >= TIMESTAMP '2024-01-10' AND event_id % 13 = 3) GROUP BY user_id")
def retries_since(spark, sf):
    rows = fetch_attempts(table(spark, sf, "events")).withColumn("outcome", time.classify_status(F.col("status"), F.col("body_empty"))["outcome"]).withColumnRenamed("source", "user_id")
    return relational.retries_since(rows, F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), "user_id")


@query("""WITH v AS (SELECT user_id AS entity, event_id AS version, date_trunc('hour', ts) - to_hours(CAST(event_id % 3 AS INT) * 40) AS effective_at FROM events), w AS (SELECT *, max(effective_at) OVER (PARTITION BY entity ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_before FROM v)
SELECT entity, version, effective_at, latest_before FROM w WHERE effective_at < latest_before""")
def backdated_versions(spark, sf):
    rows = entity_versions(table(spark, sf, "events")).select("entity", "version", (F.col("effective_at") - F.expr("make_dt_interval(0, cast(version % 3 as int) * 40)")).alias("effective_at"))
    return temporal.state_disorder(rows)


# --- markup and translation

@query("SELECT page_id, sha256(html) AS html_sha256 FROM pages")
def html_reassembly(spark, sf):
    """Pages that are taken apart and put together without translations are what they were."""
    parts = translation.pieces(table(spark, sf, "pages"), ["page_id"], "html", limit=200, translated=("alt", "title", "content"))
    none = parts.where("false").select("page_id", "pos", F.lit("").alias("translated"))
    return translation.reassemble(parts, ["page_id"], none).select("page_id", F.sha2("html", 256).alias("html_sha256"))


@query(r"""WITH t AS (SELECT page_id, list_transform(regexp_extract_all(html, '<li>([^<]*)</li>|<li><a [^>]*>([^<]*)</a></li>', 0), lambda x: regexp_replace(regexp_replace(x, '^<li>', ''), '</li>$', '')) AS found FROM pages)
SELECT page_id, CAST(count(*) AS BIGINT) AS items FROM (SELECT page_id, unnest(found) AS item FROM t) WHERE regexp_matches(regexp_replace(item, '<[^>]*>', '', 'g'), '[\pL\pN]') GROUP BY page_id""")
def html_list_items(spark, sf):
    parts = translation.pieces(table(spark, sf, "pages"), ["page_id"], "html")
    return parts.where("kind = 'text' and block = 'li'").groupBy("page_id").agg(F.count(F.lit(1)).alias("items"))


@query()
def html_segments(spark, sf):
    return translation.pieces(table(spark, sf, "pages"), ["page_id"], "html").where("kind <> 'literal'").select("page_id", "pos", "kind", "block", "lang", "text")


@query()
def mask_numbers(spark, sf):
    masked = table(spark, sf, "documents").select("doc_id", preserve.mask(F.col("text")).alias("m"))
    return masked.select("doc_id", F.size("m.placeholders").alias("n_spans"), F.sha2("m.masked", 256).alias("masked_sha256"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[\pL\pN_.+-]+@[\pL\pN_-]+(\.[\pL\pN_-]+)+')) AS INT) AS emails FROM documents")
def mask_emails(spark, sf):
    masked = table(spark, sf, "documents").select("doc_id", preserve.mask(F.col("text"))["placeholders"].alias("p"))
    return masked.select("doc_id", F.size(F.filter("p", lambda p: p["kind"] == "email")).alias("emails"))


@query()
def preservation_check(spark, sf):
    """What is reported of translations that lose, repeat or invent a placeholder, by the document's number."""
    k, mark = F.col("doc_id") % 4, F.lit('<x id="1"/>')
    masked = table(spark, sf, "documents").select("doc_id", F.col("text"), preserve.mask(F.col("text")).alias("m"))
    said = F.when(k == 1, F.replace("m.masked", mark, F.lit(""))).when(k == 2, F.concat("m.masked", mark)).when(k == 3, F.concat("m.masked", F.lit('<x id="9999"/>'))).otherwise(F.col("m.masked"))
    return masked.select("doc_id", F.array_join(preserve.issues(F.col("text"), F.col("m"), said), ",").alias("issues"))


_SUPPORTED = ["en", "de", "fr"]


def _ranking(c):
    share = (F.length(c) % 100) / 100.0
    own, other = F.struct(F.lit("de").alias("language"), share.alias("confidence")), F.struct(F.lit("it").alias("language"), (1 - share).alias("confidence"))
    return F.when(share >= 0.5, F.array(own, other)).otherwise(F.array(other, own))


@query("""WITH d AS (SELECT doc_id, lang, length(text) AS n, text, (length(text) % 100) / 100.0 AS c FROM documents)
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN lang WHEN doc_id % 4 = 1 THEN 'en' WHEN c >= 0.3 THEN 'de' ELSE 'it' END AS language, CASE WHEN doc_id % 4 = 0 THEN 'metadata' WHEN doc_id % 4 = 1 THEN 'lang_attribute' ELSE 'classifier' END AS basis,
CASE WHEN doc_id % 4 < 2 THEN false WHEN c >= 0.5 THEN false WHEN c >= 0.3 THEN true ELSE 1 - c < 0.6 END AS uncertain FROM d""")
def language_decision(spark, sf):
    k = F.col("doc_id") % 4
    docs = table(spark, sf, "documents").withColumn("d", text.article_language(F.when(k == 0, F.concat("lang", F.lit("-XX"))), F.when(k == 1, "EN_us"), F.col("text"), _ranking(F.col("text")), _SUPPORTED))
    return docs.select("doc_id", "d.language", "d.basis", "d.uncertain")


def learned_ranking(spark: SparkSession, sf: str):
    """Rankings by what four fifths of the documents teach."""
    return languages.profiles(languages.profile_table(table(spark, sf, "documents").where("doc_id % 5 > 0"))).ranking()


@query("SELECT lang, doc_id % 5 = 0 AS held_out, CAST(count(*) AS BIGINT) AS docs, true AS accurate FROM documents GROUP BY ALL")
def language_accuracy(spark, sf):
    """Documents by language, learned from or held out, and whether the classifier's best answer is right for 98 in 100."""
    best = F.try_element_at(learned_ranking(spark, sf)(F.col("text")), F.lit(1))["language"]
    judged = table(spark, sf, "documents").withColumn("best", best).withColumn("held_out", F.col("doc_id") % 5 == 0)
    return judged.groupBy("lang", "held_out").agg(F.count(F.lit(1)).alias("docs"), (F.avg(F.col("best").eqNullSafe(F.col("lang")).cast("int")) >= 0.98).alias("accurate"))


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 1 THEN 'en' ELSE lang END AS language, CASE doc_id % 4 WHEN 0 THEN 'metadata' WHEN 1 THEN 'lang_attribute' ELSE 'classifier' END AS basis, false AS uncertain, CASE WHEN doc_id % 4 > 1 THEN lang END AS candidate FROM documents""")
def language_decision_learned(spark, sf):
    """Decisions on documents: of what they declare, and of what the classifier ranks first."""
    k = F.col("doc_id") % 4
    decided = text.article_language(F.when(k == 0, F.concat("lang", F.lit("-XX"))), F.when(k == 1, "EN_us"), F.col("text"), learned_ranking(spark, sf)(F.col("text")), [*_SUPPORTED, "es"])
    return table(spark, sf, "documents").select("doc_id", decided.alias("d")).select("doc_id", "d.language", "d.basis", "d.uncertain", "d.candidate")


def _articles(spark: SparkSession, sf: str) -> DataFrame:
    # reading articles is much work, so they are dealt to more tasks than their files have parts
    docs = table(spark, sf, "documents").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    access = F.element_at(F.array(*map(F.lit, ("full", "partial", "metadata_only"))), (F.col("doc_id") % 3 + 1).cast("int"))
    return docs.select(F.col("doc_id").alias("article_id"), access.alias("access"), F.when(F.col("doc_id") % 5 > 0, F.col("lang")).alias("declared"), F.substring("text", 1, 40).alias("title"), F.lit(None).cast("string").alias("lead"), F.concat(F.lit("<p>"), F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</p>")).alias("body_html"))


@query()
def translation_plan(spark, sf):
    planned = translation.plan(_articles(spark, sf), learned_ranking(spark, sf), _SUPPORTED, limit=1000)
    return planned.where("kind <> 'literal'").select("article_id", "field", "pos", "language.language", "language.basis", "action")


@query()
def translation_outcome(spark, sf):
    """Articles through plan, a memory that every third article has filled, and a translator that only marks what it gets."""
    ranking = learned_ranking(spark, sf)
    marked = lambda todo: todo.select("key", F.concat(F.lit("~"), "masked").alias("translated_text"))
    names = {"provider": "p", "model": "m", "glossary_version": "g"}
    planned = translation.kept(translation.plan(_articles(spark, sf), ranking, _SUPPORTED, limit=1000))
    _, entries = translation.execute(planned.where("article_id % 3 = 0"), spark.createDataFrame([], "key string, translated_text string"), marked, stored=True, **names)
    memory = materialize(entries.select("key", "translated_text"), "memory", compact=True)
    outcome, _ = translation.execute(planned, memory, marked, stored=True, **names)
    return outcome.select("article_id", "not_required", "complete", F.array_join("quality_flags", ",").alias("quality_flags"), "memory_hits", "provider_segments", F.sha2("body_html", 256).alias("body_sha256"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 2 THEN NULL ELSE sha256(html) END AS body_sha256, CASE WHEN page_id % 3 = 2 THEN 'content_decoding_error' END AS error FROM pages")
def decoded_bodies(spark, sf):
    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: zlib.compress(t.encode()))

    k = F.col("page_id") % 3
    rows = table(spark, sf, "pages").select("page_id", F.when(k == 0, packed("html")).otherwise(F.encode("html", "UTF-8")).alias("body"), F.when(k == 0, " Deflate").when(k == 1, "identity").otherwise("br").alias("content_encoding"))
    return registry.decoded_bodies(rows).select("page_id", F.sha2("data", 256).alias("body_sha256"), "error")
