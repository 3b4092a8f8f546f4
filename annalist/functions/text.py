"""Text: normal form, numbers, labels, and which language a text is in."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ASCII = r"^[\x00-\x7F]*$"
_JOINERS = "‌‍"


def _normal(text: str) -> str:
    out = []
    for c in unicodedata.normalize("NFC", text):
        kind = unicodedata.category(c)
        if kind == "Cc":
            out.append(" ")
        elif kind != "Cf" or c in _JOINERS:
            out.append(c)
    return " ".join("".join(out).split())


@F.pandas_udf(T.StringType())
def _normal_unicode(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else _normal(t))


def normalize(text: Column) -> Column:
    """NFC, controls as blanks, format characters dropped (joiners stay), white space squeezed.

    ASCII text never leaves the JVM; other text takes the vectorised Python path.
    """
    ascii_form = F.trim(F.regexp_replace(text, r"[\x00-\x20\x7F]+", " "))
    return F.when(text.rlike(_ASCII), ascii_form).otherwise(_normal_unicode(F.when(~text.rlike(_ASCII), text)))


def normalize_number(raw: Column) -> Column:
    """A number of any locale in one form: ``1.234,5`` and ``1 234,5`` become ``1234.5``.

    Of two different separators the last is the decimal one. A single separator groups if
    exactly three digits follow it, or if it comes more than once.
    """
    sign = F.when(raw.rlike("^[-−–]"), "-").otherwise("")
    digits = F.regexp_replace(raw, "[-−–\\s   '’]", "")
    marks = F.regexp_replace(digits, r"[^.,]", "")
    tail = F.regexp_extract(digits, r"([^.,]*)$", 1)
    head = F.regexp_replace(F.regexp_replace(digits, r"[.,][^.,]*$", ""), r"[.,]", "")
    both = F.contains(marks, F.lit(".")) & F.contains(marks, F.lit(","))
    groups = ~both & ((F.length(marks) > 1) | (F.length(tail) == 3))
    plain = F.when(marks == "", digits).when(groups, F.regexp_replace(digits, r"[.,]", "")).otherwise(F.concat(head, F.lit("."), tail))
    return F.concat(sign, plain)


def attribute_text(text: Column) -> Column:
    """NFC, white space squeezed, case folded (not only lowered): how identity compares attributes."""
    ascii_form = F.lower(F.trim(F.regexp_replace(text, r"[\x09-\x0D\x1C-\x20]+", " ")))
    return F.when(text.rlike(_ASCII), ascii_form).otherwise(_folded(F.when(~text.rlike(_ASCII), text)))


@F.pandas_udf(T.StringType())
def _folded(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else " ".join(unicodedata.normalize("NFC", t).split()).casefold())


def language_tag(tag: Column) -> Column:
    """The two-letter language of a tag or locale such as ``de-AT`` and ``pt_BR``; null for anything else."""
    primary = F.lower(F.regexp_extract(F.trim(tag), r"^([^-_]*)", 1))
    return F.when(primary.rlike("^[a-z]{2}$"), primary)


def attribute_texts(texts: Column) -> Column:
    """``attribute_text`` of each of an array of texts; only arrays beyond ASCII leave the JVM."""
    plain = F.forall(texts, lambda t: t.isNull() | t.rlike(_ASCII))
    ascii_form = F.transform(texts, lambda t: F.lower(F.trim(F.regexp_replace(t, r"[\x09-\x0D\x1C-\x20]+", " "))))
    return F.when(plain, ascii_form).otherwise(_all_folded(F.when(~plain, texts)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _all_folded(arrays: pd.Series) -> pd.Series:
    fold = lambda t: None if t is None else " ".join(unicodedata.normalize("NFC", t).split()).casefold()
    return arrays.map(lambda a: None if a is None else [fold(t) for t in a])


#: Labels of access, and what some of them are called elsewhere.
ACCESS = ("full", "partial", "metadata_only", "blocked", "challenge", "premium", "gone", "unknown")
ACCESS_ALIASES = {"free": "full", "body_unavailable": "metadata_only", "retryable": "retryable"}


def access_state(label: Column) -> Column:
    """A label of access in one vocabulary; null for a label that is not known."""
    key = F.lower(F.trim(label))
    known = F.create_map(*[F.lit(x) for k in [*ACCESS_ALIASES, *ACCESS] for x in (k, ACCESS_ALIASES.get(k, k))])
    return known[key]


def schema_version(value: Column) -> Column:
    """``major, minor`` of ``major.minor``; null for another form."""
    pair = F.split(value, r"\.")
    parsed = F.struct(pair[0].cast("int").alias("major"), pair[1].cast("int").alias("minor"))
    return F.when(value.rlike(r"^(0|[1-9][0-9]{0,8})\.(0|[1-9][0-9]{0,8})$"), parsed)


def readable(version: Column, own: str) -> Column:
    """Whether a reader of version ``own`` takes a document: same major number, minor not above."""
    major, minor = map(int, own.split("."))
    parsed = schema_version(version)
    return F.coalesce((parsed["major"] == major) & (parsed["minor"] <= minor), F.lit(False))


#: Ends of names whose values are secrets, and what stands in for these.
SECRET_NAMES = ("token", "apikey", "api_key", "api-key", "password", "passwd", "secret", "signature", "sig")
REDACTED = "[redacted]"


def _without_logins(message: Column) -> Column:
    """User and password before the at sign of a URL's authority go; the pieces between ``://`` are looked at one by one."""
    pieces = F.split(message, "://", -1)

    def one(piece: Column, n: Column) -> Column:
        authority = F.regexp_extract(piece, r"^[^/\s]*", 0)
        at, colon = F.instr(authority, "@"), F.instr(authority, ":")
        behind_scheme = F.when(n > 0, F.element_at(pieces, n).rlike(r"[A-Za-z][\w+.-]*$")).otherwise(False)
        return F.when(behind_scheme & (colon > 1) & (at > colon), F.concat(F.lit(REDACTED), F.substr(piece, at))).otherwise(piece)

    return F.array_join(F.transform(pieces, one), "://")


def _without_values(message: Column) -> Column:
    """Values behind secret names go, up to white space, an ampersand, a hash or a quote.

    The pieces between equality signs are read in order. ``mode`` says what a piece is: 0 plain, 1
    the beginning of a secret, 2 its next part, 3 its next part while nothing of it was seen.
    """
    ends_secret = lambda c: F.exists(F.array(*map(F.lit, SECRET_NAMES)), lambda n: F.endswith(F.lower(c), n))

    def step(acc: Column, piece: Column) -> Column:
        stop = F.regexp_instr(piece, F.lit(r"[\s&#\"']"))
        secret, whole = acc["mode"] > 0, stop == 0
        rest = F.when(secret & whole, "").when(secret, F.substr(piece, stop)).otherwise(piece)
        shows = (acc["mode"] == 3) | ((acc["mode"] == 1) & F.when(whole, piece != "").otherwise(stop > 1))
        sign = F.when(acc["first"] | acc["mode"].isin(2, 3), "").otherwise("=")
        mode = F.when(secret & whole, F.when((acc["mode"] == 1) & (piece == ""), 3).otherwise(2)).when(ends_secret(rest), 1).otherwise(0)
        text = F.concat(acc["text"], sign, F.when(shows, REDACTED).otherwise(""), rest)
        return F.struct(text.alias("text"), mode.cast("int").alias("mode"), F.lit(False).alias("first"))

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("mode"), F.lit(True).alias("first"))
    return F.aggregate(F.split(message, "=", -1), start, step, lambda acc: acc["text"])


def redact(message: Column) -> Column:
    """No credentials in URLs, no values of secret parameters."""
    return _without_values(_without_logins(message))


def shortened(message: Column, limit: int = 2048) -> Column:
    """At most ``limit`` characters, the last an ellipsis if something is left out."""
    return F.when(F.length(message) > limit, F.concat(F.substring(message, 1, limit - 1), F.lit("…"))).otherwise(message)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value that stands only once in the expression, however often it is used: filters copy expressions."""
    return F.element_at(F.transform(F.array(value), use), 1)


def classified(ranking: Column, supported: list[str], *, target: str = "uk", min_confidence: float = 0.6, neighbour: float = 0.3) -> Column:
    """``language, confidence, uncertain, candidate`` of a ranking of (language, confidence), best first.

    The best language's confidence is its share among the supported ones. If it is not
    supported, a supported one with enough confidence stands in, as an uncertain answer.
    Null if the ranking is empty.
    """
    ours = [*supported, target]

    def answered(ranking: Column) -> Column:
        fits = F.filter(ranking, lambda r: r["language"].isin(*ours))
        best, near = F.try_element_at(ranking, F.lit(1)), F.try_element_at(fits, F.lit(1))
        mass = F.aggregate(fits, F.lit(0.0), lambda a, r: a + r["confidence"])
        answer = lambda language, confidence, unsure: F.struct(language.alias("language"), confidence.alias("confidence"), unsure.alias("uncertain"), best["language"].alias("candidate"))
        share = F.when(mass > 0, best["confidence"] / mass).otherwise(best["confidence"])
        own = answer(best["language"], share, share < min_confidence)
        other = answer(near["language"], near["confidence"], F.lit(True))
        alone = answer(best["language"], best["confidence"], best["confidence"] < min_confidence)
        return F.when(best.isNotNull(), F.when(best["language"].isin(*ours), own).when(near["confidence"] >= neighbour, other).otherwise(alone))

    return _once(ranking, answered)


def article_language(declared: Column, root_lang: Column, text: Column, ranking: Column, supported: list[str], **options) -> Column:
    """``language, confidence, basis, uncertain, candidate`` of an article: what it says of itself, else the classifier."""
    answer = lambda language, confidence, basis, unsure, candidate: F.struct(language.cast("string").alias("language"), confidence.cast("double").alias("confidence"), F.lit(basis).alias("basis"), unsure.alias("uncertain"), candidate.cast("string").alias("candidate"))
    none, no, yes = F.lit(None), F.lit(False), F.lit(True)
    by_class = _once(classified(ranking, supported, **options), lambda found: answer(found["language"], F.coalesce(found["confidence"], F.lit(0.0)), "classifier", F.coalesce(found["uncertain"], yes), found["candidate"]))
    empty = F.coalesce(F.trim(text) == "", yes)
    return (
        F.when(language_tag(declared).isNotNull(), answer(language_tag(declared), F.lit(1.0), "metadata", no, none))
        .when(language_tag(root_lang).isNotNull(), answer(language_tag(root_lang), F.lit(1.0), "lang_attribute", no, none))
        .when(empty, answer(none, F.lit(0.0), "none", yes, none))
        .otherwise(by_class)
    )


def is_small(text: Column, short: int = 30) -> Column:
    """Whether a segment says too little of its language."""
    return (F.length(text) < short) | ~text.rlike(r"\p{L}")


def segment_language(own_lang: Column, text: Column, ranking: Column, article: Column, supported: list[str], *, short: int = 30, min_confidence: float = 0.6) -> Column:
    """The same of a segment: its own attribute, the article's language if it is short, else the classifier.

    A classifier that is not sure leaves the article's language, marked as uncertain, with
    its own candidate beside it.
    """
    answer = lambda language, confidence, basis, unsure, candidate: F.struct(language.cast("string").alias("language"), confidence.cast("double").alias("confidence"), F.lit(basis).alias("basis"), unsure.alias("uncertain"), candidate.cast("string").alias("candidate"))
    inherited = answer(article["language"], article["confidence"], "inherited", article["uncertain"], article["candidate"])
    small = is_small(text, short)

    def by_class(found: Column) -> Column:
        sure = F.coalesce((found["confidence"] >= min_confidence) | (found["candidate"] != found["language"]), F.lit(False))
        unsure = answer(article["language"], F.coalesce(found["confidence"], F.lit(0.0)), "inherited", F.lit(True), found["candidate"])
        return F.when(sure, answer(found["language"], found["confidence"], "classifier", found["uncertain"], found["candidate"])).otherwise(unsure)

    return (
        F.when(language_tag(own_lang).isNotNull(), answer(language_tag(own_lang), F.lit(1.0), "lang_attribute", F.lit(False), F.lit(None)))
        .when(small, inherited)
        .otherwise(_once(classified(ranking, supported, min_confidence=min_confidence), by_class))
    )


def action(language: Column, supported: list[str], target: str = "uk") -> Column:
    """What to do with a segment in a language."""
    return F.when(language == target, "keep").when(language.isin(*supported), "translate").otherwise("unsupported")
