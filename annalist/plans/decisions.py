"""Queries on decisions: replays of resolutions, fetches, matches, languages."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annalist.functions import url
from annalist.operators import fetching, matching, metrics, relational, resolution
from annalist.plans.catalogue import query
from annalist.sources import registry
from annalist.sources.scratch import materialize, scratch_path
from annalist.sources.tables import table

# --- resolution

#: By number modulo 4, the decisions on four customers a, b, c and d: action, members, whether it supersedes the one before.
_SCRIPTS = {
    0: [("merge", "ab", False), ("merge", "bc", False)],
    1: [("manual_block", "ac", False), ("merge", "ab", False), ("merge", "bc", False)],
    2: [("manual_block", "ab", False), ("manual_link", "ab", False), ("unmerge", "a", False)],
    3: [("merge", "ab", False), ("merge", "cd", False), ("merge", "ac", False), ("manual_link", "bd", True)],
}


def scripted(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions of every kind on each four customers."""
    anchor = F.col("c_custkey")
    name = lambda m: (anchor + "abcd".index(m)).cast("string")
    step = lambda n, action, members, supersedes: F.struct(F.lit(n).alias("n"), F.lit(action).alias("action"), F.array(*map(name, members)).alias("members"), F.lit(supersedes).alias("s"))
    script = F.array()
    for kind, steps in _SCRIPTS.items():
        script = F.when(F.floor(anchor / 4) % 4 == kind, F.array(*[step(n, *s) for n, s in enumerate(steps, 1)])).otherwise(script) if kind else F.array(*[step(n, *s) for n, s in enumerate(steps, 1)])
    steps = table(spark, sf, "customer").where("c_custkey % 4 = 1").select("c_custkey", F.inline(script))
    of = lambda n: F.concat(anchor.cast("string"), F.lit("-"), n.cast("string"))
    n, at = F.col("n"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("n"))
    group = F.when(F.col("action").isin("merge", "manual_link"), F.concat(F.lit("g"), of(n)))
    return steps.select(of(n).alias("decision_id"), F.lit(1).alias("decision_version"), "action", "members", group.alias("group_id"), at.alias("effective_at"), at.alias("recorded_at"), F.when(F.col("s"), of(n - 1)).alias("supersedes"), ((anchor + n) % 3).alias("batch"))


_OUTCOME = """WITH a AS (SELECT c_custkey AS k, c_custkey // 4 % 4 AS kind FROM customer WHERE c_custkey % 4 = 1),
made(kind, what, id, members) AS (VALUES (0, 'group', 2, [0, 1, 2]), (1, 'group', 2, [0, 1]), (3, 'group', 4, [0, 1, 2, 3])),
told(kind, what, ids) AS (VALUES (0, 'applied', [1, 2]), (1, 'applied', [1, 2]), (1, 'skipped', [3]), (2, 'applied', [1, 2, 3]), (3, 'applied', [1, 2, 4]), (3, 'superseded', [3])),
foes(kind, other) AS (VALUES (1, 2), (2, 1))
SELECT what AS kind, 'g' || k || '-' || id AS id, CAST(k + unnest(members) AS VARCHAR) AS other FROM a JOIN made USING (kind)
UNION ALL SELECT what, k || '-' || unnest(ids), NULL FROM a JOIN told USING (kind)
UNION ALL SELECT 'blocked', least(k::VARCHAR, (k + other)::VARCHAR), greatest(k::VARCHAR, (k + other)::VARCHAR) FROM a JOIN foes USING (kind)"""


@query(_OUTCOME)
def resolution_mixed(spark, sf):
    return resolution.snapshot(scripted(spark, sf).drop("batch"))


@query(_OUTCOME)
def resolution_incremental(spark, sf):
    path, made = scratch_path(spark, "replay"), scripted(spark, sf)
    for batch in range(3):
        resolution.advance(spark, path, made.where(F.col("batch") == batch))
    return resolution.kept_snapshot(spark, path)


# --- fetches

_NOON = "2026-09-01 12:00:00"
#: What is wrong, or happens, by number of the page modulo 26: exit, result, code, reason, seconds, steps, stored, parsed, reset, opened, browser.
_EXPECTED = """(0, 'source', 'permanent', 'fetch_source_missing', NULL, NULL, 1, 0, 0, 0, 0, 0), (1, 'arguments', 'permanent', 'fetch_args_invalid', NULL, NULL, 2, 0, 0, 0, 0, 0),
(2, 'arguments', 'permanent', 'fetch_args_invalid', NULL, NULL, 2, 0, 0, 0, 0, 0), (3, 'arguments', 'permanent', 'fetch_args_invalid', NULL, NULL, 2, 0, 0, 0, 0, 0),
(4, 'preflight', 'permanent', 'fetch_preflight_missing', NULL, NULL, 3, 0, 0, 0, 0, 0), (5, 'source_state', 'deferred', 'source_not_enabled', NULL, 5, 4, 0, 0, 0, 0, 0),
(6, 'policy', 'permanent', 'source_policy_missing', NULL, NULL, 5, 0, 0, 0, 0, 0), (7, 'robots_policy', 'permanent', 'robots_policy_invalid', NULL, NULL, 6, 0, 0, 0, 0, 0),
(8, 'route', 'deferred', 'route_not_available', NULL, 100, 7, 0, 0, 0, 0, 0), (9, 'route', 'deferred', 'route_not_available', NULL, 5, 7, 0, 0, 0, 0, 0),
(10, 'robots_fresh', 'success', NULL, NULL, NULL, 8, 0, 0, 0, 0, 0), (11, 'robots_rules', 'permanent', 'policy_blocked', 'robots_disallowed', NULL, 9, 0, 0, 0, 0, 0),
(12, 'guard', 'permanent', 'policy_blocked', 'ssrf_forbidden_address', NULL, 10, 0, 0, 0, 0, 0), (13, 'ready', 'ready', NULL, NULL, NULL, 11, 0, 0, 0, 0, 0),
(14, 'permit', 'deferred', 'origin_busy', NULL, 60, 12, 0, 0, 0, 0, 0), (15, 'upload', 'deferred', 'upload_claim_busy', NULL, 5, 13, 0, 0, 0, 0, 0),
(16, 'success', 'success', NULL, NULL, NULL, 14, 1, 1, 1, 0, 0), (17, 'success', 'success', NULL, NULL, NULL, 14, 0, 0, 1, 0, 0), (18, 'success', 'success', NULL, NULL, NULL, 14, 1, 0, 1, 0, 0),
(19, 'retry', 'retry', 'http_503', NULL, 5, 15, 0, 0, 0, 0, 0), (20, 'retry', 'retry', 'http_429', NULL, 50, 15, 0, 0, 0, 0, 0), (21, 'dead_letter', 'dead_letter', 'timeout', NULL, NULL, 17, 0, 0, 0, 0, 0),
(22, 'quarantine', 'quarantine', 'body_too_large', NULL, NULL, 16, 0, 0, 0, 0, 0), (23, 'permanent', 'permanent', 'http_404', NULL, NULL, 18, 0, 0, 0, 0, 0),
(24, 'permanent', 'permanent', 'http_403', NULL, NULL, 18, 0, 0, 0, 1, 1), (25, 'permanent', 'permanent', 'policy_blocked', 'redirect_downgrade', NULL, 18, 0, 0, 0, 0, 0)"""


def _by_kind(given: dict, otherwise=None):
    """A column by the page's number modulo 26; what isn't given is ``otherwise``."""
    out = otherwise if otherwise is not None else F.lit(None)
    for k, value in given.items():
        out = F.when(F.col("k") == k, value).otherwise(out)
    return out


@query(f"""WITH e(k, exit, result, code, reason, wait, steps, stored, parsed, reset, opened, browser) AS (VALUES {_EXPECTED})
SELECT page_id AS task_id, exit, result, code, reason, TIMESTAMP '{_NOON}' + to_seconds(wait) AS until, steps, stored = 1 AS stored, parsed = 1 AS parsed, reset = 1 AS reset, opened = 1 AS opened, browser = 1 AS browser FROM pages JOIN e ON page_id % 26 = k""")
def fetch_decisions(spark, sf):
    pages = table(spark, sf, "pages").withColumn("k", F.col("page_id") % 26)
    now = F.lit(_NOON).cast("timestamp_ntz")
    source, route = F.concat(F.lit("news_"), F.col("k")), F.concat(F.lpad(F.hex("k"), 8, "0"), F.lit("-0000-4000-8000-000000000000"))
    route = F.lower(route)
    tasks = pages.select(F.col("page_id").alias("task_id"), _by_kind({0: F.lit(None)}, source).alias("source_id"), _by_kind({1: F.lit("route")}, route).alias("route_id"), _by_kind({3: F.lit("no url"), 12: F.lit("http://10.0.0.1/x")}, F.col("url")).alias("url"), _by_kind({2: F.lit("bogus"), 10: F.lit("robots"), 18: F.lit("robots")}, F.lit("page")).alias("request_kind"), _by_kind({20: F.lit(2), 21: F.lit(4)}, F.lit(1)).alias("attempt"))
    kinds = pages.select("k").distinct()
    held = _by_kind({8: F.expr(f"timestamp_ntz'{_NOON}' + interval 100 second")}).cast("timestamp_ntz")
    preflight = kinds.where("k <> 4").select(source.alias("source_id"), route.alias("route_id"), _by_kind({5: F.lit("paused")}, F.lit("enabled")).alias("source_state"), (F.col("k") != 6).alias("has_policy"), _by_kind({7: F.lit("maybe")}, F.lit("respect")).alias("robots_policy"), _by_kind({8: F.lit("circuit_open"), 9: F.lit("unsupported")}, F.lit("active")).alias("route_state"), held.alias("circuit_open_until"), F.lit("detail").alias("route_kind"), F.lit(True).alias("browser_allowed"))
    files = pages.select(source.alias("source_id"), url.origin(F.col("url")).alias("origin"), "k").distinct()
    body = F.when(F.col("k") == 11, F.lit("User-agent: *\nDisallow: /\n")).otherwise(F.lit("User-agent: *\nDisallow: /private\n"))
    robots = fetching.robots_rules(files.withColumn("body", body).withColumn("fresh", F.col("k") == 10), "annalist", ["source_id", "origin", "fresh"])
    status = _by_kind({15: F.lit(200), 16: F.lit(200), 17: F.lit(304), 18: F.lit(200), 19: F.lit(503), 20: F.lit(429), 23: F.lit(404), 24: F.lit(403)}).cast("int")
    error = _by_kind({21: F.lit("timeout"), 22: F.lit("body_too_large"), 25: F.lit("redirect_downgrade")}).cast("string")
    permit = _by_kind({14: F.lit("origin_busy")}).cast("string")
    responses = pages.where("k <> 13").select(F.col("page_id").alias("task_id"), status.alias("status"), F.lit(False).alias("body_empty"), error.alias("error"), (F.col("k") == 25).alias("by_policy"), permit.alias("permit_code"), F.expr(f"timestamp_ntz'{_NOON}' + interval 60 second").alias("permit_until"), F.when(F.col("k") == 20, "50").alias("retry_after"), (F.col("k") == 15).alias("upload_busy"))
    return fetching.decide(tasks, preflight, robots, responses, now).withColumn("steps", F.size("chain")).drop("chain")


# --- matches

@query("SELECT a.c_name AS left_name, b.c_name AS right_name, CAST(levenshtein(a.c_name, b.c_name) AS INTEGER) AS distance FROM customer a, customer b WHERE levenshtein(a.c_name, b.c_name) <= 1")
def near_names(spark, sf):
    names = table(spark, sf, "customer").select(F.col("c_name").alias("name"))
    return matching.near_names(names, names, 1)


_PRODUCTS = """WITH o AS (SELECT p_partkey AS offer_id, CASE WHEN p_partkey % 4 = 0 THEN p_partkey END AS gtin, p_brand AS brand, CASE WHEN p_partkey % 4 = 1 THEN p_type || p_size END AS mpn, replace(p_name, 'r', 'x') AS title FROM part),
p AS (SELECT p_partkey AS product_id, 4 * p_partkey AS gtin, p_brand AS brand, p_type || (p_size + 1) AS mpn, p_name AS title FROM part),
a AS (SELECT offer_id, min(product_id) AS product_id FROM o JOIN p USING (gtin) GROUP BY offer_id), ra AS (SELECT * FROM o WHERE offer_id NOT IN (SELECT offer_id FROM a)),
b AS (SELECT offer_id, min(product_id) AS product_id FROM ra JOIN p USING (brand, mpn) GROUP BY offer_id), rb AS (SELECT * FROM ra WHERE offer_id NOT IN (SELECT offer_id FROM b)),
c AS (SELECT offer_id, min((levenshtein(rb.title, p.title), product_id)) AS m FROM rb JOIN p USING (brand) WHERE levenshtein(rb.title, p.title) <= 2 GROUP BY offer_id)
SELECT offer_id, product_id, 'gtin' AS rule, 0::DOUBLE AS distance, true AS sure FROM a UNION ALL SELECT offer_id, product_id, 'brand_mpn', 0, true FROM b UNION ALL SELECT offer_id, m[2], 'fuzzy_name', m[1], false FROM c"""


@query(_PRODUCTS)
def product_cascade(spark, sf):
    part, k = table(spark, sf, "part"), F.col("p_partkey")
    offers = part.select(k.alias("offer_id"), F.when(k % 4 == 0, k).alias("gtin"), F.col("p_brand").alias("brand"), F.when(k % 4 == 1, F.concat("p_type", F.col("p_size").cast("string"))).alias("mpn"), F.replace("p_name", F.lit("r"), F.lit("x")).alias("title"))
    products = part.select(k.alias("product_id"), (4 * k).alias("gtin"), F.col("p_brand").alias("brand"), F.concat("p_type", (F.col("p_size") + 1).cast("string")).alias("mpn"), F.col("p_name").alias("title"))
    return matching.cascade(offers, products, matching.PRODUCTS, "offer_id", "product_id")


_VEHICLES = """WITH l AS (SELECT p_partkey AS listing_id, CASE WHEN p_partkey % 5 = 0 THEN 's' || p_partkey END AS source_id, CASE WHEN p_partkey % 5 = 1 THEN 'V' || p_partkey END AS vin, p_brand AS make, p_type AS model, 1990 + p_size % 4 AS year, p_partkey * 104729 % 50000 AS mileage FROM part),
v AS (SELECT p_partkey AS vehicle_id, 's' || 5 * p_partkey AS source_id, 'V' || (10 * p_partkey + 1) AS vin, p_brand AS make, p_type AS model, 1990 + p_size % 4 AS year, p_partkey * 7919 % 50000 AS mileage FROM part),
a AS (SELECT listing_id, min(vehicle_id) AS vehicle_id FROM l JOIN v USING (source_id) GROUP BY listing_id), ra AS (SELECT * FROM l WHERE listing_id NOT IN (SELECT listing_id FROM a)),
b AS (SELECT listing_id, min(vehicle_id) AS vehicle_id FROM ra JOIN v USING (vin) GROUP BY listing_id), rb AS (SELECT * FROM ra WHERE listing_id NOT IN (SELECT listing_id FROM b)),
c AS (SELECT listing_id, min((abs(rb.mileage - v.mileage), vehicle_id)) AS m FROM rb JOIN v USING (make, model, year) WHERE abs(rb.mileage - v.mileage) <= 1000 GROUP BY listing_id)
SELECT listing_id, vehicle_id, 'source_id' AS rule, 0::DOUBLE AS distance, true AS sure FROM a UNION ALL SELECT listing_id, vehicle_id, 'vin', 0, true FROM b UNION ALL SELECT listing_id, m[2], 'make_model_year_mileage', m[1], false FROM c"""


@query(_VEHICLES)
def vehicle_cascade(spark, sf):
    part, k = table(spark, sf, "part"), F.col("p_partkey")
    common = [F.col("p_brand").alias("make"), F.col("p_type").alias("model"), (F.lit(1990) + F.col("p_size") % 4).alias("year")]
    listings = part.select(k.alias("listing_id"), F.when(k % 5 == 0, F.concat(F.lit("s"), k.cast("string"))).alias("source_id"), F.when(k % 5 == 1, F.concat(F.lit("V"), k.cast("string"))).alias("vin"), *common, (k * 104_729 % 50_000).alias("mileage"))
    vehicles = part.select(k.alias("vehicle_id"), F.concat(F.lit("s"), (5 * k).cast("string")).alias("source_id"), F.concat(F.lit("V"), (10 * k + 1).cast("string")).alias("vin"), *common, (k * 7_919 % 50_000).alias("mileage"))
    return matching.cascade(listings, vehicles, matching.VEHICLES, "listing_id", "vehicle_id")


# --- capacity

_WINDOWS = "days AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS day FROM events)"


@query(f"""WITH {_WINDOWS} SELECT d.event_type, d.day, CAST(count(*) AS BIGINT) AS n, round(min(value), 6) AS least, round(max(value), 6) AS most, true AS p50_close, true AS p95_close, true AS different_close
FROM days d JOIN events e ON e.event_type = d.event_type AND CAST(e.ts AS DATE) BETWEEN d.day - 29 AND d.day GROUP BY d.event_type, d.day""")
def rolling_capacity(spark, sf):
    """Thirty days to each day from kept sketches of days, beside exact ranks and counts of the events: within 3 in 100 (and a row), and 6 in 100."""
    events, path = table(spark, sf, "events").select("event_type", "ts", "value", "user_id", "event_id"), scratch_path(spark, "days")
    for batch in range(2):
        metrics.keep_days(spark, path, events.where(F.col("event_id") % 2 == batch), ["event_type"], "ts", "value", "user_id")
    found = metrics.estimates(metrics.rolling(metrics.kept_days(spark, path, ["event_type"]), ["event_type"]), ["event_type", "day"])
    found = materialize(found, "estimates")
    days = lambda d: F.sequence(d, F.date_add(d, 29))
    # events meet the stretches of days that they are in before they are repeated for each
    stretches = found.select("event_type", F.explode(days(F.date_sub("day", 29))).alias("at"), F.struct("day", "p50", "p95").alias("s")).groupBy("event_type", "at").agg(F.collect_list("s").alias("s"))
    dated = events.withColumn("at", F.col("ts").cast("date"))
    below = lambda p: F.avg((F.col("value") <= F.col(p)).cast("int"))
    spread = dated.select("event_type", "at", "value").join(materialize(stretches, "stretches"), ["event_type", "at"]).select("event_type", "value", F.inline("s"))
    ranks = spread.groupBy("event_type", "day").agg((F.abs(below("p50") - 0.5) <= 0.03 + 1 / F.count("value")).alias("p50_close"), (F.abs(below("p95") - 0.95) <= 0.03 + 1 / F.count("value")).alias("p95_close"))
    # a user counts once for each day that ends a stretch with an event of theirs
    theirs = dated.where("user_id is not null").groupBy("event_type", "user_id").agg(F.collect_set("at").alias("own"))
    users = theirs.select("event_type", F.explode(F.array_distinct(F.flatten(F.transform("own", days)))).alias("day")).groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("users"))
    close = F.abs(F.col("different") / F.col("users") - 1) < 0.06
    return found.join(ranks, ["event_type", "day"]).join(users, ["event_type", "day"], "left").select("event_type", "day", "n", F.round("least", 6).alias("least"), F.round("most", 6).alias("most"), "p50_close", "p95_close", close.alias("different_close"))


# --- reads

_LOCATED = """WITH i AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS version FROM orders WHERE o_orderkey % 11 <> 0),
h AS (SELECT o_orderkey AS key, 1 AS version, o_orderstatus AS body FROM orders WHERE o_orderkey % 3 > 0 AND o_orderkey % 7 > 0),
a AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS version, 'part-' || o_orderkey % 4 AS archive, CASE WHEN o_orderkey % 5 = 0 THEN 'other' ELSE o_orderstatus END AS body FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 10 = 0),
p AS (SELECT DISTINCT l_orderkey AS key FROM lineitem WHERE l_linenumber = 1 UNION SELECT -c_custkey - 1 FROM customer)
SELECT p.key, i.version, coalesce(h.body, CASE WHEN i.version IS NOT NULL THEN a.body END) AS body, CASE WHEN i.version IS NULL THEN 'unknown' WHEN h.body IS NOT NULL THEN 'hot' WHEN a.body IS NOT NULL THEN 'archive' ELSE 'missing' END AS found,
coalesce(h.body <> a.body, false) AS conflict FROM p LEFT JOIN i ON i.key = p.key LEFT JOIN h ON h.key = p.key AND h.version = i.version LEFT JOIN a ON a.key = p.key AND a.version = i.version"""


@query(_LOCATED)
def located_or_archived(spark, sf):
    orders, k = table(spark, sf, "orders"), F.col("o_orderkey")
    version = F.when(k % 7 == 0, 2).otherwise(1)
    index = orders.where(k % 11 != 0).select(k.alias("key"), version.alias("version"))
    hot = orders.where((k % 3 > 0) & (k % 7 > 0)).select(k.alias("key"), F.lit(1).alias("version"), F.col("o_orderstatus").alias("body"))
    kept = orders.where((k % 3 == 0) | (k % 10 == 0)).select(k.alias("key"), version.alias("version"), F.concat(F.lit("part-"), (k % 4).cast("string")).alias("archive"), F.when(k % 5 == 0, "other").otherwise(F.col("o_orderstatus")).alias("body"))
    path = scratch_path(spark, "cold")
    kept.write.partitionBy("archive").parquet(path)
    probes = table(spark, sf, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("key")).union(table(spark, sf, "customer").select(-F.col("c_custkey") - 1))
    found = relational.located_or_archived(index, hot, kept.select("key", "version", "archive"), spark.read.parquet(path), probes, "body")
    return found.select("key", "version", "body", "found", "conflict")


# --- feeds

_FEEDS = """WITH p AS (SELECT page_id, url, page_id % 8 AS feed FROM pages)
SELECT feed AS source_id, CASE feed % 4 WHEN 2 THEN 'url' WHEN 3 THEN 'sitemap' ELSE 'item' END AS kind, url, CASE feed % 4 WHEN 0 THEN 'Page ' || page_id || ' & </item>' WHEN 1 THEN 'Page <' || page_id || '>' END AS title, 't' || page_id AS published, NULL::VARCHAR AS error FROM p"""


@query(_FEEDS)
def feed_entries(spark, sf):
    """The pages as entries of feeds of four kinds, every other feed packed in two gzip members."""
    page, g = F.col("page_id").cast("string"), F.col("feed") % 4
    link = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    c = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    rss = c("<item><title><![CDATA[Page ", page, " & </item>]]></title><link>", link, "</link><!-- <item> --><pubDate>t", page, "</pubDate></item>")
    atom = c('<a:entry><a:title>Page &lt;', page, '&gt;</a:title><a:link rel="self" href="https://self.example/"/><a:link href=\'', link, "' rel='alternate'/><a:author><a:title>x</a:title></a:author><a:updated>t", page, "</a:updated></a:entry>")
    site = c("<url><loc> ", link, "\n</loc><lastmod>t", page, "</lastmod></url>")
    index = c("<sitemap><loc>", link, "</loc><lastmod>t", page, "</lastmod></sitemap>")
    one = F.when(g == 0, rss).when(g == 1, atom).when(g == 2, site).otherwise(index)
    heads = F.when(g == 0, "<rss><channel><title>all</title>").when(g == 1, "<a:feed xmlns:a='x'><a:title>all</a:title>").when(g == 2, "<urlset>").otherwise("<sitemapindex>")

    @F.pandas_udf("binary")
    def packed(numbers: pd.Series, texts: pd.Series) -> pd.Series:
        half = lambda t: gzip.compress(t[: len(t) // 2]) + gzip.compress(t[len(t) // 2 :])
        return pd.Series([half(t.encode()) if n % 2 else t.encode() for n, t in zip(numbers, texts, strict=True)])

    pages = table(spark, sf, "pages").withColumn("feed", F.col("page_id") % 8)
    feeds = pages.select("feed", heads.alias("head"), one.alias("one"), "page_id").groupBy("feed").agg(F.concat(F.first("head"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", "one"))), lambda r: r["one"]), "\n")).alias("text"))
    return registry.feed_items(feeds.select(F.col("feed").alias("source_id"), packed("feed", "text").alias("body")))


@query("""SELECT conv_id AS key, CAST(sum(strlen(text)) AS BIGINT) AS size, CASE WHEN conv_id % 7 = 0 THEN 'missing' WHEN sum(strlen(text)) > 6000 THEN 'too_large' WHEN conv_id % 7 = 1 AND count(*) > 1 THEN 'incomplete' WHEN conv_id % 7 = 2 THEN 'mismatch' ELSE 'ok' END AS status
FROM (SELECT conv_id, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, count(*) OVER (PARTITION BY conv_id) AS m FROM conversations) WHERE NOT (conv_id % 7 = 1 AND m > 1 AND n = 1) GROUP BY conv_id""".replace("CAST(sum(strlen(text)) AS BIGINT) AS size", "CASE WHEN conv_id % 7 > 0 THEN CAST(sum(strlen(text)) AS BIGINT) END AS size").replace("count(*) > 1 THEN 'incomplete'", "max(m) > 1 THEN 'incomplete'"))
def verified_pieces(spark, sf):
    """Conversations as bodies in pieces, of which some lack their first piece, have another digest, or aren't there."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    ranked = turns.withColumn("seq", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1)
    whole = ranked.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda r: r["text"]), "").alias("t"), F.count(F.lit(1)).alias("pieces"))
    k = F.col("conv_id") % 7
    expected = whole.select(F.col("conv_id").alias("key"), F.sha2(F.when(k == 2, "other").otherwise(F.col("t")), 256).alias("sha256"), "pieces")
    lost = (k == 0) | ((k == 1) & (F.col("pieces") > 1) & (F.col("seq") == 0))
    chunks = ranked.join(whole.select("conv_id", "pieces"), "conv_id").where(~lost).select(F.col("conv_id").alias("key"), "seq", F.encode("text", "UTF-8").alias("content"))
    return registry.verified_chunks(chunks, expected, 6_000)
