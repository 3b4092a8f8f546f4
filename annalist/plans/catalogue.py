"""Queries by name, and for each the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.functions import hashing, text, time, url
from annalist.operators import ledger, quality, relational, temporal
from annalist.sources.tables import FETCH_STATUSES, entity_versions, fetch_attempts, table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

_VERSIONS = "versions AS (SELECT user_id AS entity, event_id AS version, date_trunc('hour', ts) AS effective_at, ts + to_seconds((event_id * 7919) % 7200) AS ingested_at, event_type AS state FROM events)"
_HISTORY = f"""{_VERSIONS}, history AS (SELECT *, effective_at AS valid_from, ingested_at AS known_from,
  min(effective_at) OVER (PARTITION BY entity ORDER BY effective_at RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS valid_to,
  min(ingested_at) OVER (PARTITION BY entity ORDER BY ingested_at RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS known_to FROM versions)"""
_FETCHES = f"fetches AS (SELECT event_id, ts AS fetched_at, user_id AS source, [{', '.join(map(str, FETCH_STATUSES))}][CAST(event_id % {len(FETCH_STATUSES)} AS INT) + 1] AS status, event_id % 11 = 0 AS body_empty FROM events)"
_CAS = f"""{_VERSIONS}, cas AS (SELECT *, max(version) OVER w AS previous_version, arg_max(state, version) OVER w AS previous_hash FROM versions
  WINDOW w AS (PARTITION BY entity ORDER BY ingested_at, version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def query(sql: str | None = None):
    def keep(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from annalist.plans import decisions, ledgers, records, rules  # noqa: F401  add their own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from annalist.plans import decisions, ledgers, records, rules  # noqa: F401

    return dict(_SQL)


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return temporal.intervals(entity_versions(table(spark, sf, "events")))


@query(f"WITH {_HISTORY} SELECT entity, version, valid_from, valid_to, known_from, known_to FROM history")
def bitemporal_intervals(spark, sf):
    return _history(spark, sf).select("entity", "version", "valid_from", "valid_to", "known_from", "known_to")


@query(f"""WITH {_HISTORY}, probes AS (SELECT user_id AS entity, max(ts) - INTERVAL 36 HOUR AS valid_at, max(ts) - INTERVAL 30 HOUR AS known_at FROM events GROUP BY user_id)
SELECT p.entity, valid_at, known_at, version, state FROM probes p JOIN history h ON p.entity = h.entity
WHERE valid_from <= valid_at AND (valid_to IS NULL OR valid_at < valid_to) AND known_from <= known_at AND (known_to IS NULL OR known_at < known_to)""")
def bitemporal_as_of(spark, sf):
    probes = table(spark, sf, "events").groupBy(F.col("user_id").alias("entity")).agg((F.max("ts") - F.expr("INTERVAL 36 HOUR")).alias("valid_at"), (F.max("ts") - F.expr("INTERVAL 30 HOUR")).alias("known_at"))
    return temporal.as_of(_history(spark, sf), probes).select("entity", "valid_at", "known_at", "version", "state")


@query("""SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN ts END, CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL 1 HOUR END, ts + INTERVAL 2 HOUR) AS effective_at,
CASE WHEN event_id % 3 = 0 THEN 'source_event' WHEN event_id % 5 = 0 THEN 'source_updated' ELSE 'observed' END AS basis, event_id % 3 <> 0 AS inferred FROM events""")
def effective_time(spark, sf):
    source = F.when(F.col("event_id") % 3 == 0, F.col("ts"))
    updated = F.when(F.col("event_id") % 5 == 0, F.expr("ts + INTERVAL 1 HOUR"))
    return table(spark, sf, "events").select("event_id", time.effective_time(source, updated, F.expr("ts + INTERVAL 2 HOUR")).alias("e")).select("event_id", "e.*")


@query(f"WITH {_VERSIONS} SELECT entity, max(version) AS version, arg_max(state, version) AS state, arg_max(effective_at, version) AS effective_at FROM versions GROUP BY entity")
def current_state(spark, sf):
    return temporal.current(entity_versions(table(spark, sf, "events"))).select("entity", "version", "state", "effective_at")


def _receipts(spark, sf):
    return temporal.compare_and_set(entity_versions(table(spark, sf, "events")).withColumnRenamed("state", "state_hash"))


@query(f"WITH {_CAS} SELECT entity, version, previous_version, previous_hash, coalesce(version > previous_version, true) AS applied, state IS DISTINCT FROM previous_hash AS state_changed FROM cas")
def version_cas(spark, sf):
    return _receipts(spark, sf).select("entity", "version", "previous_version", "previous_hash", "applied", "state_changed")


@query(f"WITH {_CAS} SELECT entity, version, state AS state_hash FROM cas WHERE coalesce(version > previous_version, true) AND state IS DISTINCT FROM previous_hash")
def change_events(spark, sf):
    return temporal.change_events(_receipts(spark, sf)).select("entity", "version", "state_hash")


@query("""WITH RECURSIVE r AS (SELECT user_id AS e, epoch_us(ts) AS t, ts, event_type AS h, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type) AS n FROM events),
s AS (SELECT e, n, ts, h, t AS last, h AS held, 'changed' AS reason FROM r WHERE n = 1
UNION ALL SELECT r.e, r.n, r.ts, r.h, CASE WHEN r.h <> s.held OR r.t - s.last >= 86400000000 THEN r.t ELSE s.last END, r.h, CASE WHEN r.h <> s.held THEN 'changed' WHEN r.t - s.last >= 86400000000 THEN 'heartbeat' END FROM s JOIN r ON r.e = s.e AND r.n = s.n + 1)
SELECT e AS entity, ts AS observed_at, h AS state_hash, reason FROM s WHERE reason IS NOT NULL""")
def observations_heartbeat(spark, sf):
    seen = table(spark, sf, "events").select(F.col("user_id").alias("entity"), F.col("ts").alias("observed_at"), F.col("event_type").alias("state_hash"))
    return temporal.heartbeat_observations(seen)


@query("SELECT l_orderkey, CAST(count(DISTINCT l_linenumber) AS BIGINT) AS tasks, max(l_linenumber) AS confirmed FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey")
def ack_confirmed(spark, sf):
    acks = table(spark, sf, "lineitem").where("l_linestatus = 'F'").select("l_orderkey", "l_linenumber")
    return ledger.confirmed(acks, "l_orderkey", "l_linenumber")


_P = r"'^([A-Za-z][A-Za-z0-9+.-]*)://(?:([^/?#@]*)@)?(\[[^\]]*\]|[^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$'"
_KEYS = "['" + "','".join(url.TRACKING_KEYS) + "']"
#: The pages' URLs, and the forms they take with an empty parameter, a default port, and a fragment.
_URLS = "urls AS (SELECT page_id, CASE page_id % 4 WHEN 1 THEN regexp_replace(url, '^(https?)://([^/]*)', '\\1://\\2:' || CASE WHEN url LIKE 'https%' THEN '443' ELSE '80' END) WHEN 2 THEN url || CASE WHEN contains(url, '?') THEN '&&z=1&' ELSE '?&z=1&&GCLID=x' END WHEN 3 THEN upper(left(url, 8)) || substr(url, 9) || '#part' ELSE url END AS url FROM pages)"
_URL = f"""{_URLS}, parts AS (SELECT page_id, url, lower(regexp_extract(url, {_P}, 1)) AS scheme, lower(regexp_extract(url, {_P}, 3)) AS host, regexp_extract(url, {_P}, 4) AS port,
  regexp_extract(url, {_P}, 5) AS path, string_split(regexp_extract(url, {_P}, 6), '&') AS params FROM urls),
normal AS (SELECT *, scheme || '://' || host || CASE WHEN port = '' OR port = (CASE scheme WHEN 'http' THEN '80' WHEN 'https' THEN '443' END) THEN '' ELSE ':' || port END AS origin,
  list_filter(params, lambda p: lower(split_part(p, '=', 1)) LIKE 'utm\\_%' ESCAPE '\\' OR list_contains({_KEYS}, lower(split_part(p, '=', 1)))) AS tracking,
  array_to_string(list_filter(params, lambda p: NOT (lower(split_part(p, '=', 1)) LIKE 'utm\\_%' ESCAPE '\\' OR list_contains({_KEYS}, lower(split_part(p, '=', 1))) OR p = '')), '&') AS kept FROM parts)"""


def _urls(spark, sf):
    given, port = F.col("url"), F.when(F.col("url").startswith("https"), "443").otherwise("80")
    ported = F.regexp_replace(given, F.lit("^(https?)://([^/]*)"), F.concat(F.lit("$1://$2:"), port))
    more = F.concat(given, F.when(F.contains(given, F.lit("?")), "&&z=1&").otherwise("?&z=1&&GCLID=x"))
    loud = F.concat(F.upper(F.substring(given, 1, 8)), F.substring(given, F.lit(9), F.length(given)), F.lit("#part"))
    form = F.col("page_id") % 4
    return table(spark, sf, "pages").select("page_id", F.when(form == 1, ported).when(form == 2, more).when(form == 3, loud).otherwise(given).alias("url"))


@query(f"WITH {_URL} SELECT page_id, origin || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN kept = '' THEN '' ELSE '?' || kept END AS normalized FROM normal")
def url_normalize(spark, sf):
    return _urls(spark, sf).select("page_id", url.normalize(F.col("url")).alias("normalized"))


@query(f"WITH {_URL} SELECT origin, origin || '/robots.txt' AS robots_url, CAST(count(*) AS BIGINT) AS pages FROM normal GROUP BY origin")
def url_origin(spark, sf):
    pages = _urls(spark, sf).select(url.origin(F.col("url")).alias("origin"), url.robots_url(F.col("url")).alias("robots_url"))
    return pages.groupBy("origin", "robots_url").agg(F.count(F.lit(1)).alias("pages"))


@query(f"WITH {_URL} SELECT page_id, array_to_string(list_sort(list_distinct(list_transform(tracking, lambda p: lower(split_part(p, '=', 1))))), ',') AS keys FROM normal WHERE len(tracking) > 0")
def url_tracking_keys(spark, sf):
    keys = url.tracking_keys(F.col("url"))
    return _urls(spark, sf).where(F.size(keys) > 0).select("page_id", F.array_join(keys, ",").alias("keys"))


_DENIED = ("spam-farm.example.org", "cheap-pills.example.com")


@query(f"""WITH {_URL} SELECT page_id, CASE WHEN scheme NOT IN ('http', 'https') THEN 'scheme_forbidden' WHEN host = '' THEN 'url_invalid'
WHEN host IN {_DENIED} OR host LIKE '%.{_DENIED[0]}' OR host LIKE '%.{_DENIED[1]}' THEN 'host_denied' WHEN regexp_matches(origin || path, '/7[0-9]*$') THEN 'path_denied' END AS reason FROM normal""")
def route_guard(spark, sf):
    return _urls(spark, sf).select("page_id", url.guard(F.col("url"), _DENIED, (r"^[^?]*/7[0-9]*(?:\?.*)?$",)).alias("reason"))


@query(f"WITH {_URL} SELECT page_id, host FROM normal WHERE host IN {_DENIED} OR host LIKE '%.{_DENIED[0]}' OR host LIKE '%.{_DENIED[1]}'")
def denylist_semi(spark, sf):
    denied = spark.createDataFrame([(d,) for d in _DENIED], "suffix string")
    pages = _urls(spark, sf).select("page_id", url.host(F.col("url")).alias("host"), F.explode(url.host_suffixes(F.col("url"))).alias("suffix"))
    return pages.join(denied, "suffix", "left_semi").select("page_id", "host").distinct()


@query("SELECT sha256(text) AS sha256, min(doc_id) AS first_doc, CAST(count(*) AS BIGINT) AS uploads FROM documents GROUP BY sha256(text)")
def raw_object_dedup(spark, sf):
    return table(spark, sf, "documents").groupBy(hashing.sha256_hex("text").alias("sha256")).agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("uploads"))


@query("""SELECT page_id, sha256('{"normalized_url":"' || url || '","planned_at_bucket":"2026-09-01T12:30:00.000000Z","request_variant":"default","source_id":"news_' || (page_id % 7) || '"}') AS key FROM pages""")
def idempotency_key(spark, sf):
    at = F.to_timestamp(F.lit("2026-09-01 12:30:00"))
    key = hashing.fetch_key(F.concat(F.lit("news_"), (F.col("page_id") % 7).cast("string")), F.col("url"), at, F.lit("default"))
    return table(spark, sf, "pages").select("page_id", key.alias("key"))


@query(r"SELECT doc_id, sha256(trim(regexp_replace(nfc_normalize(text), '[\x00-\x20\x7F]+', ' ', 'g'))) AS text_hash FROM documents")
def normalize_text_hash(spark, sf):
    return table(spark, sf, "documents").select("doc_id", hashing.sha256_hex(text.normalize(F.col("text"))).alias("text_hash"))


@query("SELECT event_id, time_bucket(INTERVAL 900 SECOND, ts, TIMESTAMP '1970-01-01') AS bucket FROM events")
def bucket_floor(spark, sf):
    return table(spark, sf, "events").select("event_id", time.bucket_start(F.col("ts"), 900).alias("bucket"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS bucket, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL")
def tumbling_counts(spark, sf):
    return table(spark, sf, "events").groupBy(time.bucket_start(F.col("ts"), 3600).alias("bucket"), "event_type").agg(F.count(F.lit(1)).alias("n"))


def _retry_after():
    """A header that every second fetch gives in seconds; the others give no number."""
    return F.when(F.col("event_id") % 2 == 0, (F.col("event_id") % 100).cast("string")).otherwise("soon")


@query(f"""WITH {_FETCHES} SELECT event_id, status,
CASE WHEN status = 304 THEN 'success' WHEN status BETWEEN 200 AND 299 THEN CASE WHEN body_empty THEN 'retryable' ELSE 'success' END WHEN status IN (429, 408, 425, 500, 502, 503, 504) THEN 'retryable' ELSE 'permanent_failure' END AS outcome,
CASE WHEN status BETWEEN 200 AND 299 AND NOT body_empty THEN CASE WHEN status = 206 THEN 'partial' ELSE 'full' END WHEN status IN (401, 403, 451) THEN 'blocked' WHEN status IN (404, 410) THEN 'gone' ELSE 'unknown' END AS access,
CASE WHEN status = 304 THEN NULL WHEN status BETWEEN 200 AND 299 THEN CASE WHEN body_empty THEN 'empty_body' END WHEN status BETWEEN 300 AND 399 THEN 'redirect_invalid' ELSE 'http_' || status END AS code,
CASE WHEN status BETWEEN 300 AND 399 AND status <> 304 THEN 'http_' || status END AS reason, CAST(CASE WHEN status = 429 THEN CASE WHEN event_id % 2 = 0 THEN least(greatest(event_id % 100, 5), 86400) ELSE 600 END END AS BIGINT) AS retry_after,
status = 429 AS block_origin, status IN (401, 403) AS route_incident, status IN (401, 403) AS browser_candidate, status = 304 AS not_modified, false AS quarantine FROM fetches""")
def http_classify(spark, sf):
    return fetch_attempts(table(spark, sf, "events")).select("event_id", "status", time.classify_status(F.col("status"), F.col("body_empty"), _retry_after()).alias("d")).select("event_id", "status", "d.*")


@query("""SELECT o_orderkey, 1 + o_orderkey % 5 AS attempt, CASE WHEN 1 + o_orderkey % 5 < 4 THEN greatest([5, 30, 120, 600][CAST(1 + o_orderkey % 5 AS INT)], coalesce(CASE WHEN o_orderkey % 4 = 0 THEN o_custkey % 200 END, 0)) END AS delay_seconds FROM orders""")
def retry_plan(spark, sf):
    attempt = F.lit(1) + F.col("o_orderkey") % 5
    after = F.when(F.col("o_orderkey") % 4 == 0, F.col("o_custkey") % 200)
    return table(spark, sf, "orders").select("o_orderkey", attempt.alias("attempt"), time.retry_delay(attempt, after).alias("delay_seconds"))


@query("SELECT o_orderkey, CAST(least(5 * pow(2, o_orderkey % 12), 3600) AS BIGINT) AS delay_seconds FROM orders")
def backoff_delay(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", time.backoff_seconds(F.col("o_orderkey") % 12 + 1).alias("delay_seconds"))


_JOBS = "jobs AS (SELECT o_orderkey AS job_id, CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'P' THEN 'retry' ELSE 'done' END AS status, CAST(o_orderkey % 9 AS INT) AS priority, o_orderdate AS not_before, o_orderpriority AS job_type FROM orders)"


def _jobs(spark, sf):
    status = F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "P", "retry").otherwise("done")
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"), status.alias("status"), (F.col("o_orderkey") % 9).cast("int").alias("priority"), F.col("o_orderdate").alias("not_before"), F.col("o_orderpriority").alias("job_type"))


@query(f"WITH {_JOBS} SELECT job_id, priority, not_before FROM jobs WHERE status IN ('pending', 'retry') AND not_before <= TIMESTAMP '1997-01-01' AND job_type IN ('1-URGENT', '2-HIGH') ORDER BY priority DESC, not_before, job_id LIMIT 50")
def claim_topk(spark, sf):
    now = F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    return relational.claim(_jobs(spark, sf), ["1-URGENT", "2-HIGH"], now, 50).select("job_id", "priority", "not_before")


@query(f"WITH {_JOBS} SELECT priority, job_id, status FROM jobs WHERE (priority, job_id) > (4, 500) ORDER BY priority, job_id LIMIT 100")
def keyset_page(spark, sf):
    return relational.page_after(_jobs(spark, sf).select("priority", "job_id", "status"), ["priority", "job_id"], [4, 500], 100)


@query("SELECT s_suppkey, n_name, r_name, CASE WHEN s_acctbal < 0 THEN 'paused' ELSE 'active' END AS state FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def preflight_join(spark, sf):
    supplier, nation, region = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    joined = ledger.preflight(supplier.withColumnRenamed("s_nationkey", "n_nationkey"), nation, region.withColumnRenamed("r_regionkey", "n_regionkey"), source="n_nationkey", policy="n_regionkey")
    return joined.select("s_suppkey", "n_name", "r_name", F.when(F.col("s_acctbal") < 0, "paused").otherwise("active").alias("state"))


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def purge_exists(spark, sf):
    returned = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").join(returned, "o_orderkey", "left_semi").select("o_orderkey")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AND NOT EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = d.doc_id) AND n_chars > 100")
def orphan_anti(spark, sf):
    docs = table(spark, sf, "documents").where("n_chars > 100").select("doc_id")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left_anti").join(table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id")), "doc_id", "left_anti")


@query(f"WITH {_FETCHES} SELECT source, max(fetched_at) AS fetched_at, arg_max(event_id, (fetched_at, event_id)) AS event_id FROM fetches WHERE status IN (200, 206) GROUP BY source")
def latest_validators(spark, sf):
    good = fetch_attempts(table(spark, sf, "events")).where("status in (200, 206)").select("source", "fetched_at", "event_id")
    return relational.latest_by(good, ["source"], ["fetched_at", "event_id"])


@query("""SELECT c_mktsegment, CAST(count(*) FILTER (o_orderstatus = 'O') AS BIGINT) AS open_tasks, min(o_orderdate) FILTER (o_orderstatus = 'O') AS oldest_open,
CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS quarantined, count(*) FILTER (o_orderstatus = 'O') = 0 AS settled FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def completeness(spark, sf):
    joined = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return ledger.completeness(joined, "c_mktsegment", is_open=F.col("o_orderstatus") == "O", is_quarantined=F.col("o_orderstatus") == "P", at="o_orderdate")


@query("SELECT s_nationkey AS role, CAST(count(*) AS BIGINT) AS instances, CAST(coalesce(sum(s_suppkey % 16), 0) AS BIGINT) AS slots, min(s_suppkey % 16) AS least FROM supplier WHERE s_acctbal > 0 GROUP BY s_nationkey")
def observed_capacity(spark, sf):
    instances = table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("role"), (F.col("s_suppkey") % 16).alias("n"))
    return ledger.capacity(instances, "role", "n")


@query("SELECT source, CAST(count(*) AS BIGINT) AS uploads, CAST(count(DISTINCT text) AS BIGINT) AS objects, round((count(*) - count(DISTINCT text)) / count(*)::DOUBLE, 6) AS dedup_ratio FROM documents GROUP BY source")
def dedup_ratio(spark, sf):
    # two levels: a text's rows meet as one partial count from each task
    by_text = table(spark, sf, "documents").groupBy("source", F.xxhash64("text").alias("h"), hashing.sha256_hex("text").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return by_text.groupBy("source").agg(F.sum("n").alias("uploads"), F.count(F.lit(1)).alias("objects")).withColumn("dedup_ratio", F.round((F.col("uploads") - F.col("objects")) / F.col("uploads"), 6))


@query(f"""WITH {_FETCHES}, runs AS (SELECT *, status >= 400 AS failed, sum(CASE WHEN status >= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY source ORDER BY fetched_at, event_id ROWS UNBOUNDED PRECEDING) AS run FROM fetches)
SELECT event_id, source, CAST(sum(failed::INT) OVER (PARTITION BY source, run ORDER BY fetched_at, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS consecutive_failures,
sum(failed::INT) OVER (PARTITION BY source, run ORDER BY fetched_at, event_id ROWS UNBOUNDED PRECEDING) >= 3 AS circuit_open FROM runs""")
def route_circuit(spark, sf):
    fetches = fetch_attempts(table(spark, sf, "events")).withColumn("failed", F.col("status") >= 400)
    return relational.circuit(fetches, "source", ["fetched_at", "event_id"], "failed", 3).select("event_id", "source", "consecutive_failures", "circuit_open")


@query("""WITH RECURSIVE r AS (SELECT user_id AS origin, epoch_us(ts) AS t, event_id AS request_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
s AS (SELECT origin, request_id, n, t, 10000::BIGINT AS tokens, true AS granted FROM r WHERE n = 1
UNION ALL SELECT origin, request_id, n, t, g - CASE WHEN g >= 10000 THEN 10000 ELSE 0 END, g >= 10000 FROM (SELECT r.*, least(20000, s.tokens + (r.t - s.t) // 1000000) AS g FROM s JOIN r ON r.origin = s.origin AND r.n = s.n + 1))
SELECT origin, request_id, granted FROM s""")
def token_bucket(spark, sf):
    requests = table(spark, sf, "events").select(F.col("user_id").alias("origin"), F.col("ts").alias("at"), F.col("event_id").alias("request_id"))
    return relational.token_bucket(requests, capacity=2, per_second=0.0001)


@query("""WITH g AS (SELECT event_id, user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh FROM events)
SELECT event_id, user_id, CAST(sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM g""")
def session_gaps(spark, sf):
    return relational.sessions(table(spark, sf, "events"), "user_id", "ts", 12 * 3600, "event_id").select("event_id", "user_id", "session")


_YIELD = "runs AS (SELECT l_returnflag AS source, CAST(l_shipdate AS DATE) AS run_date, CAST(count(*) AS BIGINT) AS yield FROM lineitem GROUP BY ALL)"


@query(f"""WITH {_YIELD}, m AS (SELECT *, count(*) OVER w AS n, median(yield) OVER w AS med FROM runs WINDOW w AS (PARTITION BY source ORDER BY run_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT source, run_date, yield, CASE WHEN n = 7 THEN CAST(med AS BIGINT) END AS prior_median, coalesce(n = 7 AND yield < 0.7 * med, false) AS alarm FROM m""")
def quality_gate_median(spark, sf):
    runs = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("source"), F.col("l_shipdate").cast("date").alias("run_date")).agg(F.count(F.lit(1)).alias("yield"))
    return relational.prior_median(runs, "source", ["run_date"], "yield", 7).withColumn("alarm", F.coalesce(F.col("yield") < 0.7 * F.col("prior_median"), F.lit(False)))


@query("SELECT conv_id, turn, m.item_id AS item_id, m.item_id IS NOT NULL AS hit FROM conversations c LEFT JOIN (SELECT sha256(trim(text)) AS k, min(item_id) AS item_id FROM benchmark GROUP BY 1) m ON sha256(trim(c.text)) = m.k")
def tm_hits(spark, sf):
    memory = table(spark, sf, "benchmark").groupBy(hashing.sha256_hex(F.trim("text")).alias("k")).agg(F.min("item_id").alias("item_id"))
    turns = table(spark, sf, "conversations").withColumn("k", hashing.sha256_hex(F.trim("text")))
    return turns.join(memory, "k", "left").select("conv_id", "turn", "item_id", F.col("item_id").isNotNull().alias("hit"))


@query("""SELECT c_custkey, array_to_string(list_filter([CASE WHEN NOT c_acctbal >= 0 THEN 'balance' END, CASE WHEN NOT regexp_full_match(c_name, 'Customer#0*[0-9]*[02468]') THEN 'name' END, CASE WHEN NOT c_nationkey BETWEEN 0 AND 20 THEN 'nation' END], lambda x: x IS NOT NULL), ',') AS violations
FROM customer WHERE NOT (c_acctbal >= 0 AND regexp_full_match(c_name, 'Customer#0*[0-9]*[02468]') AND c_nationkey BETWEEN 0 AND 20)""")
def dq_violations(spark, sf):
    rules = {"balance": F.col("c_acctbal") >= 0, "name": F.col("c_name").rlike("^Customer#0*[0-9]*[02468]$"), "nation": F.col("c_nationkey").between(0, 20)}
    return quality.split(table(spark, sf, "customer"), rules)[1].select("c_custkey", F.array_join("violations", ",").alias("violations"))


@query("SELECT user_id, CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS errors, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.95), 4) AS p95 FROM events GROUP BY user_id")
def capacity_percentiles(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("errors"), F.round(F.percentile("value", 0.5), 4).alias("p50"), F.round(F.percentile("value", 0.95), 4).alias("p95"))
