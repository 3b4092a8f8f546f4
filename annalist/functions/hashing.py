"""Canonical forms and content identities."""

from __future__ import annotations

import json
import unicodedata
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.functions.text import attribute_texts, normalize


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def utc_text(ts: Column) -> Column:
    """A timestamp with six digits after the second and ``Z``, always."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def decimal_text(value: Column) -> Column:
    """A decimal without exponent and trailing zeros; minus zero is zero."""
    plain = F.regexp_replace(F.regexp_replace(value.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(plain.rlike(r"^-?0$"), "0").otherwise(plain)


#: Control characters whose escapes have letters in them.
_LETTERED = [f"{n:04X}" for n in range(32) if n not in (8, 9, 10, 12, 13) and not f"{n:04X}".isdigit()]


def _plain_escapes(json_text: Column) -> Column:
    """Escapes of control characters with small letters, where Spark writes capitals; escaped backslashes are no escapes."""
    out = json_text
    for code in _LETTERED:
        out = F.regexp_replace(out, rf"(?<!\\)((?:\\\\)*)\\u{code}", rf"$1\\u{code.lower()}")
    return F.when(F.contains(json_text, F.lit("\\u00")), out).otherwise(json_text)


def flat_json(**fields: Column) -> Column:
    """Canonical JSON of a flat record of strings: sorted keys, no blanks, nulls written."""
    return _plain_escapes(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"}))


def flat_hash(**fields: Column) -> Column:
    return sha256_hex(flat_json(**fields))


def fetch_key(source_id: Column, url: Column, planned_at: Column, variant: Column) -> Column:
    """Identity of a planned fetch."""
    return flat_hash(normalized_url=url, planned_at_bucket=utc_text(planned_at), request_variant=variant, source_id=source_id)


def parse_key(*parts: Column) -> Column:
    return sha256_hex(F.concat_ws("\u001f", *parts))


class NotCanonical(ValueError):
    """A value without a canonical form."""


#: Numbers whose plain form would have more digits have no canonical form.
MOST_DIGITS = 4_300


class _Plain(float):
    """A number that isn't an integer, with its text as it is written."""

    def __new__(cls, text: str):
        own = super().__new__(cls, text)
        own.text = _plain_decimal(text)
        return own


def _refuse(name: str):
    raise NotCanonical(name)


_DECODER = json.JSONDecoder(parse_float=_Plain, parse_constant=_refuse)
_STRING = json.JSONEncoder(ensure_ascii=False).encode
_CONSTANTS = {None: "null", True: "true", False: "false"}


def _written(value) -> str:
    if isinstance(value, str):
        return _STRING(value if value.isascii() else unicodedata.normalize("NFC", value))
    if isinstance(value, dict):
        named = {k if k.isascii() else unicodedata.normalize("NFC", k): v for k, v in value.items()}
        if len(named) < len(value):
            raise NotCanonical("keys collide")
        return "{" + ",".join([f"{_STRING(k)}:{_written(named[k])}" for k in sorted(named)]) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_written, value)) + "]"
    if isinstance(value, _Plain):
        return value.text
    return _CONSTANTS[value] if value is None or isinstance(value, bool) else str(value)


def canonical_text(document: str) -> str:
    """JSON text with sorted keys, no blanks, NFC strings and plain numbers.

    Integers stay; decimals lose exponents and zeros at their end. Keys that become one, NaN and
    infinity, lone surrogates, trees too deep to walk, and numbers of more than ``MOST_DIGITS``
    digits are errors.
    """
    try:
        out = _written(_DECODER.decode(document))
    except RecursionError:
        raise NotCanonical("too deep") from None
    out.encode("utf-8")
    return out


def _plain_decimal(text: str) -> str:
    value = Decimal(text)
    if not value.is_finite() or abs(value.adjusted()) > MOST_DIGITS or len(value.as_tuple().digits) > MOST_DIGITS:
        raise NotCanonical(text[:40])
    plain = f"{value:f}"
    plain = plain.rstrip("0").rstrip(".") if "." in plain else plain
    return "0" if plain in ("-0", "") else plain


def _canonical_or_none(text: str | None) -> str | None:
    try:
        return None if text is None else canonical_text(text)
    except (ValueError, ArithmeticError):
        return None


@F.pandas_udf(T.StringType())
def canonical_json(documents: pd.Series) -> pd.Series:
    """The canonical form of JSON texts; null for what has none. Equal texts of a batch are read once."""
    which, distinct = pd.factorize(documents)
    forms = np.array([*map(_canonical_or_none, distinct), None], dtype=object)
    return pd.Series(forms[which])  # nulls are the last


def canonical_sha256(document: Column) -> Column:
    """The hash of a nested JSON document, whatever the order of its keys."""
    return sha256_hex(canonical_json(document))


def _quoted(text: Column) -> Column:
    """A JSON string with only the escapes that JSON needs."""
    return F.regexp_extract(_plain_escapes(F.to_json(F.struct(text.alias("v")), {"ignoreNullFields": "false"})), r"^\{\"v\":(.*)\}$", 1)


def identity_hash(url: Column, attributes: Column) -> Column:
    """``v1:`` and the hash of a page's URL and stable attributes (a map of strings).

    Names and values are compared in folded case with white space squeezed; null and empty
    ones don't count. Null if two names become one.
    """
    pairs = F.arrays_zip(attribute_texts(F.map_keys(attributes)).alias("k"), attribute_texts(F.map_values(attributes)).alias("v"))
    named = F.transform(pairs, lambda p: F.struct(p["k"].alias("k"), p["v"].alias("v")))
    return _identity(F.trim(url), named)


def _identity(url: Column, pairs: Column) -> Column:
    kept = F.array_sort(F.filter(pairs, lambda p: F.coalesce(p["v"] != "", F.lit(False))))
    names = F.transform(kept, lambda p: p["k"])
    body = F.array_join(F.transform(kept, lambda p: F.concat(_quoted(p["k"]), F.lit(":"), _quoted(p["v"]))), ",")
    text = F.concat(F.lit('{"attributes":{'), body, F.lit('},"url":'), _quoted(url), F.lit(',"v":1}'))
    return F.when(F.size(F.array_distinct(names)) == F.size(names), F.concat(F.lit("v1:"), sha256_hex(text)))


def state_hash(core: Column, attributes: Column, latest_state: Column) -> Column:
    """``v1:`` and the hash of three JSON objects; null if one of them has no canonical form."""
    return F.concat(F.lit("v1:"), sha256_hex(_state_text(core, attributes, latest_state)))


@F.pandas_udf(T.StringType())
def _state_text(core: pd.Series, attributes: pd.Series, latest_state: pd.Series) -> pd.Series:
    """One trip to Python for all three."""
    forms = []
    for texts in (attributes, core, latest_state):
        which, distinct = pd.factorize(texts)
        forms.append(np.array([*map(_canonical_or_none, distinct), None], dtype=object)[which])
    return pd.Series([None if a is None or c is None or s is None else f'{{"attributes":{a},"core":{c},"latest_state":{s},"v":1}}' for a, c, s in zip(*forms, strict=True)], dtype=object)


def translation_key(article_version: Column, target: Column, provider: Column, model: Column, glossary: Column) -> Column:
    """Identity of a translation of an article's version."""
    return flat_hash(article_version_id=article_version, glossary_version=glossary, model_version=model, provider=provider, target_language=F.lower(F.trim(target)))


def segment_hash(masked: Column) -> Column:
    return sha256_hex(normalize(masked))


def memory_key(source: Column, target: Column, segment: Column, provider: Column, model: Column, glossary: Column) -> Column:
    """Key of a translated segment; the provider is an object of its own in it."""
    nested = F.struct(glossary.alias("glossary_version"), segment.alias("normalized_segment_hash"), F.struct(model.alias("model_version"), provider.alias("name")).alias("provider"), source.alias("source_language"), target.alias("target_language"))
    return sha256_hex(_plain_escapes(F.to_json(nested, {"ignoreNullFields": "false"})))


#: Bounds of nested documents, and of what an event carries itself.
BOUNDS = {"depth": 8, "items": 256, "keys": 512, "characters": 65_536, "key_characters": 256, "bytes": 1 << 20}
INLINE_BYTES = 256 * 1024


def _beyond(value, depth: int = 1, path: str = "$") -> str | None:
    """Where a tree first goes beyond a bound, and which; None if it does not."""
    if depth > BOUNDS["depth"]:
        return f"{path}: depth"
    if isinstance(value, str) and len(value) > BOUNDS["characters"]:
        return f"{path}: characters"
    if isinstance(value, int) and not isinstance(value, bool) and not -(2**63) <= value < 2**63:
        return f"{path}: integer"
    if isinstance(value, list):
        inner = ((f"{path}[{n}]", v) for n, v in enumerate(value))
        return f"{path}: items" if len(value) > BOUNDS["items"] else next(filter(None, (_beyond(v, depth + 1, p) for p, v in inner)), None)
    if isinstance(value, dict):
        long = next((k for k in value if len(k) > BOUNDS["key_characters"]), None)
        if len(value) > BOUNDS["keys"] or long is not None:
            return f"{path}: keys" if long is None else f"{path}: key_characters"
        return next(filter(None, (_beyond(v, depth + 1, f"{path}.{k}") for k, v in value.items())), None)
    return None


@F.pandas_udf(T.StringType())
def unbounded(documents: pd.Series) -> pd.Series:
    """Why a JSON text is no bounded object, with the place; null if it is one."""

    def one(text):
        try:
            if text is None or not isinstance(value := json.loads(text), dict):
                return "$: object"
            return _beyond(value) or ("$: bytes" if len(canonical_text(text).encode()) > BOUNDS["bytes"] else None)
        except (ValueError, ArithmeticError, RecursionError):
            return "$: json"

    return documents.map(one)


def encoded_event(event: Column, media_type: str) -> Column:
    """``bytes, media_type, sha256, too_large`` of an event's JSON; a large one belongs into an artifact."""
    data = F.encode(canonical_json(event), "UTF-8")
    large = F.octet_length(data) > INLINE_BYTES
    return F.struct(F.when(~large, data).alias("bytes"), F.lit(media_type).alias("media_type"), F.sha2(data, 256).alias("sha256"), large.alias("too_large"))


def decoded_event(data: Column, schema: str) -> Column:
    """The event in canonical bytes, as a struct; null for bytes that are no such event."""
    return F.from_json(F.decode(data, "UTF-8"), schema)


def uuid7_time(value: Column) -> Column:
    """The time in a version 7 UUID; null for another version."""
    ms = F.conv(F.concat(F.substring(value, 1, 8), F.substring(value, 10, 4)), 16, 10).cast("long")
    return F.when(is_uuid(value, 7), F.timestamp_millis(ms))


def uuid7(ts: Column, place: Column, seed: Column) -> Column:
    """A version 7 UUID from a time, a place among the rows of one millisecond, and a seed.

    Ids grow with time and place, which has 26 bits on both sides of the version and variant, and
    the seed's hash fills the rest, so that reruns give the same ids. A place beyond that is an error.
    """
    ms = F.lpad(F.lower(F.hex(F.unix_millis(ts.cast("timestamp")))), 12, "0")
    digits = lambda number: F.lpad(F.lower(F.hex(number)), 3, "0")
    whole = F.when(place.between(0, (1 << 26) - 1), place.cast("long")).otherwise(F.raise_error(F.lit("more than 2^26 ids of one millisecond")).cast("long"))
    high, low = F.shiftright(whole, 14), whole.bitwiseAND(F.lit(16_383).cast("long"))
    variant = F.element_at(F.array(*map(F.lit, "89ab")), (F.shiftright(low, 12) + 1).cast("int"))
    last = F.substring(sha256_hex(seed.cast("string")), 1, 12)
    return F.concat(F.substring(ms, 1, 8), F.lit("-"), F.substring(ms, 9, 4), F.lit("-7"), digits(high), F.lit("-"), variant, digits(low.bitwiseAND(F.lit(4_095).cast("long"))), F.lit("-"), last)


def is_uuid(value: Column, version: int | None = None) -> Column:
    digit = "[0-9a-f]" if version is None else str(version)
    return F.coalesce(value.rlike(f"^[0-9a-f]{{8}}-[0-9a-f]{{4}}-{digit}[0-9a-f]{{3}}-[0-9a-f]{{4}}-[0-9a-f]{{12}}$"), F.lit(False))


def raw_object_key(content: Column) -> Column:
    """Where the bytes of a page are kept."""
    return F.concat(F.lit("raw/"), F.sha2(content, 256))


def normalized_object_key(entity: Column, digest: Column) -> Column:
    """Where a normalised document is kept; null for a digest that is none."""
    return F.when(digest.rlike("^[0-9a-f]{64}$"), F.concat(F.lit("normalized/"), entity, F.lit("/"), digest, F.lit(".json")))
