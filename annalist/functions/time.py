"""Effective time, fetch outcomes, and retry arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
RETRYABLE_STATUSES = (408, 425, 500, 502, 503, 504)
BACKOFF_SECONDS = (5, 30, 120, 600)
MAX_ATTEMPTS = 4
RETRY_AFTER_MIN, RETRY_AFTER_MAX, RETRY_AFTER_DEFAULT = 5, 86_400, 600


def effective_time(source_event: Column, source_updated: Column, observed: Column) -> Column:
    """``effective_at, basis, inferred``: the first axis that is known; observation is inferred."""
    basis = F.when(source_event.isNotNull(), "source_event").when(source_updated.isNotNull(), "source_updated").otherwise("observed")
    return F.struct(F.coalesce(source_event, source_updated, observed).alias("effective_at"), basis.alias("basis"), (basis != "source_event").alias("inferred"))


#: Errors without a status, by what becomes of them.
RETRYABLE_ERRORS = ("timeout", "network_error", "dns_error", "permit_lease_too_short")
QUARANTINE_ERRORS = ("body_too_large", "decompression_bomb", "content_decoding_error")
JITTER = 0.2


def classify_status(status: Column, body_empty: Column, retry_after: Column | None = None) -> Column:
    """What a response after redirects means.

    ``outcome, access, code, reason``, ``retry_after`` in seconds (429 only), and the flags
    ``block_origin, route_incident, browser_candidate, not_modified, quarantine``.
    """
    http = F.concat(F.lit("http_"), status.cast("string"))
    ok, empty, redirect = status.between(200, 299), status.between(200, 299) & body_empty, status.between(300, 399) & (status != 304)
    outcome = F.when(status == 304, "success").when(empty, "retryable").when(ok, "success").when((status == 429) | status.isin(*RETRYABLE_STATUSES), "retryable").otherwise("permanent_failure")
    access = F.when(status == 304, "unknown").when(empty, "unknown").when(status == 206, "partial").when(ok, "full").when(status.isin(401, 403, 451), "blocked").when(status.isin(404, 410), "gone").otherwise("unknown")
    code = F.when(empty, "empty_body").when((status == 304) | ok, None).when(redirect, "redirect_invalid").otherwise(http)
    wait = F.when(status == 429, retry_after_seconds(F.lit(None).cast("string") if retry_after is None else retry_after))
    refused = status.isin(401, 403)
    return F.struct(outcome.alias("outcome"), access.alias("access"), code.alias("code"), F.when(redirect, http).alias("reason"), wait.alias("retry_after"), (status == 429).alias("block_origin"), refused.alias("route_incident"), refused.alias("browser_candidate"), (status == 304).alias("not_modified"), F.lit(False).alias("quarantine"))


def classify_error(error: Column, policy: Column) -> Column:
    """What an error without a status means: ``outcome, access, code, reason, quarantine``.

    Where ``policy`` is true a rule refused the request, and the error is its reason.
    """
    outcome = F.when(policy, "permanent_failure").when(error.isin(*RETRYABLE_ERRORS), "retryable").when(error == "media_binary_skipped", "success").otherwise("permanent_failure")
    access = F.when(~policy & (error == "media_binary_skipped"), "metadata_only").otherwise("unknown")
    return F.struct(outcome.alias("outcome"), access.alias("access"), F.when(policy, "policy_blocked").otherwise(error).alias("code"), F.when(policy, error).alias("reason"), (~policy & error.isin(*QUARANTINE_ERRORS)).alias("quarantine"))


def retry_after_seconds(value: Column, now: Column | None = None) -> Column:
    """Seconds of a Retry-After header, clamped: ASCII digits, or a date seen from ``now``.

    Anything else, and a date that has passed, gives the default.
    """
    text = F.trim(value)
    seconds = F.when(text.rlike(r"^[0-9]{1,9}$"), text.cast("long")).when(text.rlike(r"^[0-9]+$"), F.lit(RETRY_AFTER_MAX))
    if now is not None:
        date = F.regexp_extract(text, r"^(?:[A-Za-z]{3}, )?(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) (?:GMT|UTC|\+0000)$", 1)
        away = F.unix_seconds(F.try_to_timestamp(F.nullif(date, F.lit("")), F.lit("d MMM yyyy HH:mm:ss"))) - F.unix_seconds(now.cast("timestamp"))
        seconds = F.coalesce(seconds, F.when(away >= 0, away))
    clamped = F.least(F.greatest(seconds, F.lit(RETRY_AFTER_MIN)), F.lit(RETRY_AFTER_MAX))
    return F.when(seconds.isNotNull(), clamped).otherwise(F.lit(RETRY_AFTER_DEFAULT)).cast("long")


def retry_delay(attempt: Column, retry_after: Column) -> Column:
    """Seconds until the next attempt, without jitter; null if there is none."""
    return retry_plan(F.lit("retryable"), attempt, retry_after)["delay"].cast("long")


def retry_plan(outcome: Column, attempt: Column, retry_after: Column, luck: Column | None = None, max_attempts: int = MAX_ATTEMPTS) -> Column:
    """``retry, delay, dead_letter`` after an attempt.

    ``luck`` (0 to 1) lengthens the delay by up to a fifth; it is never below Retry-After.
    """
    wait = F.element_at(F.array(*map(F.lit, BACKOFF_SECONDS)), F.greatest(F.least(attempt, F.lit(len(BACKOFF_SECONDS))), F.lit(1)).cast("int"))
    wait = wait.cast("double") * (1 + (F.lit(0.0) if luck is None else luck) * JITTER)
    again = (outcome == "retryable") & (attempt < max_attempts)
    return F.struct(again.alias("retry"), F.when(again, F.greatest(wait, F.coalesce(retry_after.cast("double"), F.lit(0.0)))).alias("delay"), ((outcome != "success") & ~again).alias("dead_letter"))


def next_attempt(now: Column, delay_seconds: Column, not_before: Column, max_defer_seconds: int | None = None) -> Column:
    """When to try again: a stated time, but not before now, else now and the delay; at most ``max_defer_seconds`` away."""
    later = F.timestamp_micros(F.unix_micros(now.cast("timestamp")) + (delay_seconds * 1_000_000).cast("long")).cast("timestamp_ntz")
    at = F.when(not_before.isNotNull(), F.greatest(not_before, now)).otherwise(later)
    if max_defer_seconds is None:
        return at
    return F.least(at, F.timestamp_micros(F.unix_micros(now.cast("timestamp")) + max_defer_seconds * 1_000_000).cast("timestamp_ntz"))


def entity_time(source: Column, system: Column) -> Column:
    """Both time axes in one struct; see the rules of ``entity_time`` for what it must hold."""
    ours = [source[c].alias(c) for c in ("source_event_at", "source_updated_at")]
    return F.struct(*ours, *[system[c].alias(c) for c in ("observed_at", "fetched_at", "ingested_at")], source["source_time_inferred"].alias("source_time_inferred"))


def backoff_seconds(attempt: Column, base: int = 5, multiplier: int = 2, most: int = 3600) -> Column:
    """``base * multiplier ** (attempt - 1)``, at most ``most``; the exponent stops at 63."""
    return F.least(F.lit(float(base)) * F.pow(F.lit(float(multiplier)), F.least(attempt - 1, F.lit(63))), F.lit(float(most))).cast("long")


def bucket_start(ts: Column, seconds: int) -> Column:
    """The start of the tumbling bucket that holds ``ts``, counted from the epoch."""
    return F.window(ts, f"{seconds} seconds")["start"]
