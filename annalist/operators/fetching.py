"""What comes of each fetch: all checks, the response and its effects, as one step on tables."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote
from urllib.robotparser import RobotFileParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions import hashing, network, time, url

#: Kinds of requests, states that let a fetch through or hold it, routes that a browser may take.
REQUEST_KINDS = ("page", "sitemap", "robots", "api")
ENABLED, HELD_ROUTES, BROWSER_ROUTES = "enabled", ("circuit_open", "unsupported"), ("category", "detail")
RULES = "array<struct<allow: boolean, path: string>>"


def robots_rules(robots: DataFrame, agent: str, keys: list[str], body: str = "body") -> DataFrame:
    """``keys`` and ``rules``: what each robots file says to an agent, in its order; a null body and a file without rules for it have none.

    Files are read once each, here, and not for each URL.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rules = [_rules_for(b, agent) for b in batch.column(body).to_pylist()]
            kept = [batch.column(k) for k in keys]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rules, pa.list_(pa.struct([("allow", pa.bool_()), ("path", pa.string())])))], [*keys, "rules"])

    kinds = ", ".join(f"`{k}` {robots.schema[k].dataType.simpleString()}" for k in keys)
    return robots.select(*keys, F.col(body).cast("binary").alias(body)).mapInArrow(run, f"{kinds}, rules {RULES}")


def _rules_for(body: bytes | None, agent: str) -> list[dict]:
    if body is None:
        return []
    parser = RobotFileParser()
    parser.parse(body.decode("utf-8", errors="replace").splitlines())
    mine = next((e for e in [*parser.entries, parser.default_entry] if e is not None and e.applies_to(agent)), None)
    return [{"allow": bool(r.allowance), "path": "*" if r.path == "*" else unquote(r.path)} for r in mine.rulelines] if mine else []


def allowed(rules: Column, address: Column) -> Column:
    """Whether the first rule whose path begins the URL's allows it; without such a rule it is allowed.

    Paths are compared without percent signs' codes; what is no such code is compared as it is.
    """
    path = F.regexp_extract(address, r"^[^:/?#]+://[^/?#]*(.*)$", 1)
    plain = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    shown = F.when(plain.startswith("/"), plain).otherwise(F.concat(F.lit("/"), plain))
    hit = F.filter(F.coalesce(rules, F.array().cast(RULES)), lambda r: (r["path"] == "*") | F.startswith(shown, r["path"]))
    return F.coalesce(F.try_element_at(hit, F.lit(1))["allow"], F.lit(True))


def decide(tasks: DataFrame, preflight: DataFrame, robots: DataFrame, responses: DataFrame, now: Column, *, denied_hosts: tuple[str, ...] = (), defer_seconds: int = 5, max_attempts: int = time.MAX_ATTEMPTS) -> DataFrame:
    """One row a task: the exit it takes, and what follows from it.

    ``tasks``: ``task_id, source_id, route_id, url, request_kind, attempt``. ``preflight``, one row
    a ``source_id, route_id``: ``source_state, has_policy, robots_policy, route_state,
    circuit_open_until, route_kind, browser_allowed``. ``robots``, one row a ``source_id,
    origin``: ``rules`` (see ``robots_rules``), ``fresh``. ``responses``, one row a ``task_id``
    that was tried: ``status, body_empty, error, by_policy, permit_code, permit_until, retry_after,
    upload_busy``.

    Exits exclude each other: a task takes the first that holds, in the order of ``_exits``;
    ``chain`` names the checks it passed and that exit. ``result`` is ``success``, ``ready`` (all
    checks passed, not tried yet), ``deferred`` or ``retry`` with ``until``, ``quarantine``,
    ``dead_letter`` or ``permanent``, with ``code`` and ``reason``. Effects are flags: the body is
    ``stored``, to be ``parsed``; the route's failures are ``reset`` or its circuit is
    ``opened``, and a ``browser`` may try. Null and unknown values fail the check they belong to.
    """
    origin = url.origin(F.col("url"))
    joined = tasks.withColumn("origin", origin)
    joined = joined.join(preflight.withColumn("_known", F.lit(True)), ["source_id", "route_id"], "left").join(robots, ["source_id", "origin"], "left")
    joined = joined.join(responses.withColumn("_tried", F.lit(True)), "task_id", "left")
    answer = time.classify_status(F.col("status"), F.coalesce("body_empty", F.lit(False)), F.col("retry_after"))
    error = time.classify_error(F.col("error"), F.coalesce("by_policy", F.lit(False)))
    common = ["outcome", "code", "reason", "quarantine"]
    either = F.when(F.col("status").isNotNull(), F.struct(*[answer[c].alias(c) for c in [*common, "retry_after", "route_incident", "not_modified"]]))
    either = either.otherwise(F.struct(*[error[c].alias(c) for c in common], F.lit(None).cast("long").alias("retry_after"), F.lit(False).alias("route_incident"), F.lit(False).alias("not_modified")))
    guard = F.coalesce(url.guard(F.col("url"), denied_hosts), network.host_guard(url.host(F.col("url")))["code"])
    seen = joined.withColumn("answer", either).withColumn("guard", guard)
    exits = _exits(now, defer_seconds, max_attempts)
    chosen = F.coalesce(*[F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(n).alias("n"), F.lit(name).alias("exit"), result.alias("result"), code.cast("string").alias("code"), reason.cast("string").alias("reason"), until.cast("timestamp_ntz").alias("until"))) for n, (name, when, result, code, reason, until) in enumerate(exits, 1)])
    names = F.array(*[F.lit(name) for name, *_ in exits])
    done = seen.withColumn("x", chosen)
    success = F.col("x.exit") == "success"
    stored = success & ~F.col("answer.not_modified") & F.col("status").isNotNull()
    opened = F.col("answer.route_incident") & F.col("x.exit").isin("quarantine", "permanent")
    browser = opened & F.coalesce("browser_allowed", F.lit(False)) & F.coalesce(F.col("route_kind").isin(*BROWSER_ROUTES), F.lit(False))
    return done.select("task_id", "x.exit", "x.result", "x.code", "x.reason", "x.until", F.slice(names, F.lit(1), F.col("x.n")).alias("chain"), stored.alias("stored"), (stored & (F.col("request_kind") != "robots")).alias("parsed"), success.alias("reset"), opened.alias("opened"), browser.alias("browser"))


def _exits(now: Column, defer_seconds: int, max_attempts: int) -> list[tuple[str, Column, Column, Column, Column, Column]]:
    """In order: name, condition, result, code, reason, time. The last one always holds."""
    c, none = F.col, F.lit(None)
    later = lambda seconds: time.next_attempt(now, seconds, F.lit(None).cast("timestamp_ntz"))
    soon = later(F.lit(defer_seconds))
    at_least = lambda t: F.greatest(F.coalesce(t.cast("timestamp_ntz"), soon), soon)
    permanent, deferred, ok = F.lit("permanent"), F.lit("deferred"), F.lit("success")
    fails = lambda *holds: ~F.coalesce(*[holds[0]], F.lit(False))
    answer = c("answer")
    plan = time.retry_plan(answer["outcome"], c("attempt"), answer["retry_after"], max_attempts=max_attempts)
    return [
        ("source", c("source_id").isNull(), permanent, F.lit("fetch_source_missing"), none, none),
        ("arguments", fails(hashing.is_uuid(c("route_id")) & c("request_kind").isin(*REQUEST_KINDS) & c("origin").isNotNull()), permanent, F.lit("fetch_args_invalid"), none, none),
        ("preflight", c("_known").isNull(), permanent, F.lit("fetch_preflight_missing"), none, none),
        ("source_state", fails(c("source_state") == ENABLED), deferred, F.lit("source_not_enabled"), none, soon),
        ("policy", fails(c("has_policy")), permanent, F.lit("source_policy_missing"), none, none),
        ("robots_policy", fails(c("robots_policy").isin(*network.ROBOTS_POLICIES)), permanent, F.lit("robots_policy_invalid"), none, none),
        ("route", c("route_state").isin(*HELD_ROUTES), deferred, F.lit("route_not_available"), none, at_least(c("circuit_open_until"))),
        ("robots_fresh", (c("request_kind") == "robots") & c("fresh"), ok, none, none, none),
        ("robots_rules", (c("request_kind") == "page") & (c("robots_policy") == "respect") & ~allowed(c("rules"), c("url")), permanent, F.lit("policy_blocked"), F.lit("robots_disallowed"), none),
        ("guard", c("guard").isNotNull(), permanent, F.lit("policy_blocked"), c("guard"), none),
        ("ready", c("_tried").isNull(), F.lit("ready"), none, none, none),
        ("permit", c("permit_code").isNotNull(), deferred, c("permit_code"), none, at_least(c("permit_until"))),
        ("upload", (answer["outcome"] == "success") & ~answer["not_modified"] & c("upload_busy"), deferred, F.lit("upload_claim_busy"), none, soon),
        ("success", answer["outcome"] == "success", ok, none, none, none),
        ("retry", plan["retry"], F.lit("retry"), answer["code"], none, later(plan["delay"])),
        ("quarantine", answer["quarantine"], F.lit("quarantine"), answer["code"], answer["reason"], none),
        ("dead_letter", answer["outcome"] == "retryable", F.lit("dead_letter"), answer["code"], none, none),
        ("permanent", F.lit(True), permanent, answer["code"], answer["reason"], none),
    ]
