"""Contact values in one form."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Country codes, trunk prefixes and lengths of national numbers, by region.
PHONE_RULES = {"UA": ("380", "0", (9, 9)), "PL": ("48", "", (9, 9)), "DE": ("49", "0", (6, 13)), "AT": ("43", "0", (6, 13)), "CZ": ("420", "", (9, 9)), "RO": ("40", "0", (9, 9)), "HU": ("36", "06", (8, 9)), "GB": ("44", "0", (9, 10)), "US": ("1", "1", (10, 10))}
E164 = r"^\+[1-9][0-9]{6,14}$"


def is_e164(value: Column) -> Column:
    return value.rlike(E164)


def phone(raw: Column, region: str = "UA") -> Column:
    """A phone number as ``+`` and digits; null if it has no such form.

    An approximation without a database of number ranges: country codes and lengths of
    national numbers are checked for the regions of ``PHONE_RULES``; other international
    numbers only need the general form. Letters and extensions have no form.
    """
    code, trunk, (least, most) = PHONE_RULES[region]
    plain = F.regexp_replace(F.trim(raw), r"[\s(). /-]", "")
    international = F.regexp_replace(plain, "^00", "+")
    national = F.regexp_replace(plain, f"^{trunk}", "") if trunk else plain
    local = F.when(F.length(national).between(least, most), F.concat(F.lit(f"+{code}"), national))
    number = F.when(~plain.rlike(r"^\+?[0-9]+$"), None).when(international.startswith("+"), international).otherwise(local)
    wrong = F.lit(False)
    for known, _, (short, long) in PHONE_RULES.values():
        wrong = wrong | (number.startswith(f"+{known}") & ~(F.length(number) - len(known) - 1).between(short, long))
    return F.when(is_e164(number) & ~wrong, number)


@F.pandas_udf(T.StringType())
def _domain(domains: pd.Series) -> pd.Series:
    import idna

    def one(name):
        try:
            return None if name is None else idna.encode(unicodedata.normalize("NFC", name).lower(), uts46=True).decode("ascii")
        except idna.IDNAError:
            return None

    return domains.map(one)


def email(raw: Column) -> Column:
    """Lower case, the domain in its ASCII form; null without both parts, or with white space.

    ASCII domains of letters, digits, hyphens and dots never leave the JVM.
    """
    text = F.trim(raw)
    local, domain = F.regexp_extract(text, "^(.*)@([^@]*)$", 1), F.regexp_extract(text, "^(.*)@([^@]*)$", 2)
    usual = domain.rlike(r"^(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)*[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?$") & ~domain.rlike(r"(?i)(^|\.)(xn--|..--)")
    ascii_domain = F.when(usual, F.lower(domain)).otherwise(_domain(F.when(~usual, domain)))
    whole = (local != "") & (domain != "") & ~text.rlike(r"[\s ]")
    return F.when(whole, F.concat(F.lower(local), F.lit("@"), ascii_domain))


@F.pandas_udf(T.StringType())
def _composed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t).strip() or None)


def contact(kind: Column, raw: Column, region: str = "UA") -> Column:
    """The form of a phone number or an e-mail address; of another contact the composed, trimmed text."""
    return F.when(kind == "phone", phone(raw, region)).when(kind == "email", email(raw)).otherwise(_composed(F.when(~kind.isin("phone", "email"), raw)))
