"""Queries on append-only ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from annalist.operators import ledger
from annalist.plans.catalogue import query
from annalist.sources.tables import entity_versions, fetch_attempts, table

_NOW = "1997-01-01 00:00:00"


def _at(moment: str):
    return F.lit(moment).cast("timestamp_ntz")


@query("""WITH f AS (SELECT user_id AS source, [200, 304, 404, 429, 503, 206, 403, 301, 451, 200, 410, 500, 200][CAST(event_id % 13 AS INT) + 1] AS status FROM events)
SELECT source, CAST(status // 100 AS VARCHAR) || 'xx' AS status_class, CAST(count(*) AS BIGINT) AS responses, CAST(count(*) FILTER (status = 429) AS BIGINT) AS too_many FROM f GROUP BY ALL""")
def http_counts(spark, sf):
    return ledger.http_counts(fetch_attempts(table(spark, sf, "events")))


@query("""WITH r AS (SELECT source, doc_id, length(text) > 0 AS parsed, n_chars >= 100 AS complete, lang, doc_id % 2 = 0 AS inferred FROM documents), a AS (SELECT source, avg(parsed::INT) AS p, avg(complete::INT) AS c, count(*) FILTER (lang NOT IN ('en', 'de', 'fr')) AS k, avg(inferred::INT) AS i, count(*) > count(DISTINCT doc_id) AS d FROM r GROUP BY source)
SELECT source, array_to_string(list_filter([CASE WHEN c < 0.995 THEN 'completeness' END, CASE WHEN d THEN 'duplicate_keys' END, CASE WHEN abs(i - 0.4) > 0.1 THEN 'inference_rate' END, CASE WHEN p < 0.99 THEN 'parse_success' END, CASE WHEN k > 0 THEN 'unknown_category' END], lambda x: x IS NOT NULL), ',') AS missed FROM a""")
def quality_gates(spark, sf):
    found = ledger.quality_gates(table(spark, sf, "documents"), "source", parsed=F.length("text") > 0, complete=F.col("n_chars") >= 100, category=F.col("lang"), known=["en", "de", "fr"], future=F.lit(False), inferred=F.col("doc_id") % 2 == 0, key="doc_id", usual_inference=0.4)
    return found.select("source", F.array_join("missed", ",").alias("missed"))


@query(f"SELECT o_orderpriority AS origin, CAST(count(*) FILTER (o_orderstatus = 'O' AND o_orderdate > TIMESTAMP '{_NOW}') AS BIGINT) AS live FROM orders GROUP BY o_orderpriority")
def live_permits(spark, sf):
    permits = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("origin"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("released_at"), F.col("o_orderdate").alias("expires_at"))
    return ledger.live_permits(permits, _at(_NOW))


@query(f"SELECT o_orderkey AS object_key, o_orderdate AS lease_expires_at FROM orders WHERE o_orderstatus = 'P' AND o_orderdate <= TIMESTAMP '{_NOW}' ORDER BY o_orderdate, o_orderkey LIMIT 100")
def expired_claims(spark, sf):
    claims = table(spark, sf, "orders").select(F.col("o_orderkey").alias("object_key"), F.when(F.col("o_orderstatus") == "P", "leased").otherwise("done").alias("status"), F.col("o_orderdate").alias("lease_expires_at"))
    return ledger.expired_claims(claims, _at(_NOW), 100).select("object_key", "lease_expires_at")


@query("SELECT o_orderkey AS event_id, o_orderdate AS created_at FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 7 = 0 ORDER BY 2, 1 LIMIT 50")
def parked_events(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("created_at"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("published_at"), (F.col("o_orderkey") % 7 == 0).alias("parked"))
    return ledger.parked(rows, ["created_at", "event_id"], 50).select("event_id", "created_at")


@query(f"SELECT o_orderkey AS event_id, CASE WHEN o_orderstatus = 'F' THEN o_orderdate WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') THEN TIMESTAMP '{_NOW}' END AS published_at FROM orders")
def mark_published(spark, sf):
    outbox = table(spark, sf, "orders").select(F.col("o_orderkey").alias("event_id"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("published_at"))
    delivered = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("event_id"))
    return ledger.published(outbox, delivered, _at(_NOW))


@query("SELECT o_orderdate AS committed_at, o_orderkey AS id FROM orders WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1996-01-01', 0) ORDER BY 1, 2 LIMIT 75")
def receipt_page(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderdate").alias("committed_at"), F.col("o_orderkey").alias("id"))
    return ledger.receipt_page(rows, ["committed_at", "id"], [_at("1996-01-01 00:00:00"), 0], 75)[0]


@query("SELECT (SELECT o_orderdate FROM p ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) AS committed_at, (SELECT o_orderkey FROM p ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) AS id FROM (SELECT 1)".replace("SELECT (SELECT", "WITH p AS (SELECT o_orderdate, o_orderkey FROM orders ORDER BY 1, 2 LIMIT 75) SELECT (SELECT", 1))
def receipt_cursor(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderdate").alias("committed_at"), F.col("o_orderkey").alias("id"))
    return ledger.receipt_page(rows, ["committed_at", "id"], None, 75)[1]


@query("SELECT o_orderkey AS task_id, o_custkey AS entity_id FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P' AND c_mktsegment = 'BUILDING' AND o_orderkey > 100 ORDER BY o_orderkey LIMIT 60")
def quarantined_page(spark, sf):
    tasks = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task_id"), F.col("o_custkey").alias("entity_id"), F.when(F.col("o_orderstatus") == "P", "quarantined").otherwise("done").alias("status"))
    entities = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("source_id"))
    return ledger.quarantined(tasks, entities, "BUILDING", ["task_id"], [100], 60).select("task_id", "entity_id")


@query("SELECT coalesce(s.s_suppkey, n.n_nationkey) AS origin, CASE WHEN n.n_nationkey IS NOT NULL THEN 2 * n_regionkey END AS capacity, CASE WHEN s.s_suppkey IS NULL THEN 2 * n_regionkey WHEN n.n_nationkey IS NULL THEN s_nationkey ELSE least(s_nationkey, 2 * n_regionkey) END AS tokens, CAST(CASE WHEN s.s_suppkey IS NOT NULL AND n.n_nationkey IS NOT NULL THEN 2 ELSE 1 END AS BIGINT) AS revision FROM supplier s FULL JOIN nation n ON s_suppkey = n_nationkey")
def rate_buckets(spark, sf):
    have = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("origin"), F.col("s_nationkey").alias("tokens"), F.lit(1).cast("long").alias("revision"))
    want = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("origin"), (2 * F.col("n_regionkey")).alias("capacity"))
    return ledger.buckets(have, want)


@query("SELECT c_nationkey AS object_key, CAST(count(DISTINCT c_mktsegment) AS BIGINT) AS digests FROM customer GROUP BY c_nationkey HAVING count(DISTINCT c_mktsegment) > 1")
def content_conflicts(spark, sf):
    return ledger.content_conflicts(table(spark, sf, "customer").select(F.col("c_nationkey").alias("object_key"), F.col("c_mktsegment").alias("sha256")))


@query("SELECT o_orderkey AS key, array_to_string(list_filter([CASE WHEN o_custkey <> l_partkey THEN 'fetch' END, CASE WHEN o_orderstatus <> l_linestatus THEN 'status' END], lambda x: x IS NOT NULL), ',') AS differs FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber = 1 WHERE o_custkey <> l_partkey OR o_orderstatus <> l_linestatus")
def lineage_mismatch(spark, sf):
    attempts = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("fetch"), F.col("o_orderstatus").alias("status"))
    artifacts = table(spark, sf, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("key"), F.col("l_partkey").alias("fetch"), F.col("l_linestatus").alias("status"))
    return ledger.lineage_mismatch(attempts, artifacts, "key", ["fetch", "status"]).select("key", F.array_join("differs", ",").alias("differs"))


@query("SELECT o_orderkey AS task_id FROM orders WHERE o_orderstatus = 'F' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')")
def acknowledged_tasks(spark, sf):
    tasks = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task_id"), F.when(F.col("o_orderstatus") == "F", "succeeded").otherwise("open").alias("status"))
    return ledger.acknowledged(tasks, table(spark, sf, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("task_id"))).select("task_id")


@query("""WITH o AS (SELECT p_partkey AS offer_id, p_brand, p_name FROM part), c AS (SELECT p_partkey AS product_id, p_brand, regexp_replace(p_name, '^([^aeiou]*)[aeiou]', '\\1x') AS p_name FROM part), m AS (SELECT o.offer_id, c.product_id, levenshtein(o.p_name, c.p_name) AS distance FROM o JOIN c USING (p_brand) WHERE levenshtein(o.p_name, c.p_name) <= 3)
SELECT offer_id, arg_min(product_id, (distance, product_id)) AS product_id, CAST(min(distance) AS INT) AS distance FROM m GROUP BY offer_id""")
def fuzzy_match(spark, sf):
    part = table(spark, sf, "part")
    offers = part.select(F.col("p_partkey").alias("offer_id"), "p_brand", "p_name")
    products = part.select(F.col("p_partkey").alias("product_id"), "p_brand", F.regexp_replace("p_name", "^([^aeiou]*)[aeiou]", "$1x").alias("p_name"))
    return ledger.fuzzy_match(offers, products, ["p_brand"], "p_name", "offer_id", "product_id")


@query("""WITH v AS (SELECT user_id AS entity, event_id AS version, ts + to_seconds((event_id * 7919) % 7200) AS ingested_at FROM events)
SELECT entity, version FROM v WHERE ingested_at < TIMESTAMP '2024-01-15' AND version < (SELECT max(version) FROM v x WHERE x.entity = v.entity) AND version NOT IN (SELECT doc_id FROM labels)""")
def compaction(spark, sf):
    versions = entity_versions(table(spark, sf, "events"))
    pins = versions.join(table(spark, sf, "labels").select(F.col("doc_id").alias("version")), "version", "left_semi")
    return ledger.compacted(versions, pins, _at("2024-01-15 00:00:00"))[1].select("entity", "version")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'quarantine' ELSE 'retry' END AS result, CASE WHEN event_id % 3 = 0 THEN 'bad_input' ELSE 'timeout' END || ': at https://[redacted]@h.example/?key=' || event_id || '&token=[redacted]' AS message FROM events")
def task_disposition(spark, sf):
    error = F.when(F.col("event_id") % 3 == 0, "bad_input").otherwise("timeout")
    said = F.concat(F.lit("at https://u:p@h.example/?key="), F.col("event_id").cast("string"), F.lit("&token=abc"))
    return table(spark, sf, "events").select("event_id", ledger.disposition(error, said, ["bad_input"]).alias("d")).select("event_id", "d.*")


@query("SELECT doc_id, CASE WHEN n_chars % 10 > n_chars % 7 THEN 'de' WHEN n_chars % 7 > 0 THEN CASE WHEN n_chars % 10 = n_chars % 7 THEN 'de' ELSE 'en' END END AS best FROM documents")
def ranked_languages(spark, sf):
    scores = {"en": (F.col("n_chars") % 7) / 10.0, "de": (F.col("n_chars") % 10) / 10.0, "fr": F.lit(0.0)}
    return table(spark, sf, "documents").select("doc_id", F.try_element_at(ledger.ranked(scores), F.lit(1))["language"].alias("best"))


@query("SELECT event_id, ts FROM events WHERE event_type IN ('click', 'error') AND user_id IN (1, 2, 3) AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'")
def export_slice(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", F.col("event_type").alias("kind"), F.col("user_id").alias("source"))
    return ledger.exported(rows, kind=["click", "error"], source=[1, 2, 3], start=_at("2024-01-05 00:00:00"), end=_at("2024-01-20 00:00:00"), at="ts").select("event_id", "ts")
