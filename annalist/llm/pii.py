"""Surrogates for personal data: keyed, type-consistent, distinct, and the same for every mention."""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.common import discard, fresh, materialize, quoted

KEY = b"surrogates-1"
#: So many redrawn surrogates at most travel to the tasks with the code; more are joined.
MAX_SHIPPED = 50_000
#: A draw space that is still too small after so many rounds fails the job.
MAX_ROUNDS = 100

#: Fixed lists: given names by script and gender, and titles by gender.
GIVEN = {
    ("latin", "f"): "Anna Clara Elena Emma Eva Ingrid Irene Julia Laura Lena Lucia Maria Marta Nina Nora Olivia Paula Rosa Sara Sofia Sophie Teresa Vera Victoria".split(),
    ("latin", "m"): "Adam Albert Anton Bruno Carlos Daniel David Erik Felix Georg Henri Hugo Ivan Jakob James John Jorge Karl Louis Lukas Martin Oscar Paul Thomas".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Лариса Мария Надежда Ольга Софія Тетяна".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Дмитрий Иван Максим Николай Олег Павел Роман Сергей Тарас".split(),
    ("greek", "f"): "Άννα Βασιλική Ελένη Ειρήνη Ιωάννα Κατερίνα Μαρία Σοφία".split(),
    ("greek", "m"): "Αλέξανδρος Γιώργος Δημήτρης Κώστας Μιχάλης Νίκος Πέτρος Σπύρος".split(),
    ("arabic", "f"): "أمينة خديجة زينب سارة فاطمة ليلى مريم نور".split(),
    ("arabic", "m"): "أحمد إبراهيم حسن خالد سعيد عمر محمد يوسف".split(),
}
TITLES = {"f": ["Mrs.", "Ms.", "Miss", "Frau", "Mme", "Madame", "Sra.", "Señora", "пані", "госпожа", "κυρία", "السيدة"], "m": ["Mr.", "Herr", "Monsieur", "Sr.", "Señor", "пан", "господин", "κύριος", "السيد"], "": ["Dr.", "Prof."]}
#: What made-up surnames consist of, by script.
SYLLABLES = {
    "latin": "ba ber do del fa fen gar go hal ka ler lin lo mar men mo na nor pe ra ren ri ro sa sen so ta tel to va ver vi wen".split(),
    "cyrillic": "ба бер во гор да дов ка ко лен ло мар ми на нов ни па пет ра ро са сен со та тов".split(),
    "greek": "αν βα γο δα ερ θε κα κο λα λι μα μι να νι πα πε ρα ρι σα σο τα τη φο χα".split(),
    "arabic": "با دي را زي سا شا عا فا قا كا لا ما نا نو ها يا".split(),
    "hebrew": "בן גל דר הר זי חן טל כר לב מן נר עד פז צר רם שי".split(),
    "cjk": "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧",
    "kana": "あかきくけこさしすせたちつてとなにのはひふへほまみむめもやゆよ",
    "hangul": "김이박최정강조윤장임한오서신권황안송류전홍고문손양배백허남심",
}
#: Where scripts are among the characters, and the letters that stand for others of the script.
SCRIPTS = [
    ("latin", "A", "ɏ", "abcdefghijklmnopqrstuvwxyz"),
    ("greek", "Ͱ", "Ͽ", "αβγδεζηθικλμνξοπρστυφχψω"),
    ("cyrillic", "Ѐ", "ӿ", "абвгдежзиклмнопрстуфхцчш"),
    ("hebrew", "א", "ת", "אבגדהוזחטיכלמנסעפצקרשת"),
    ("arabic", "ء", "ۿ", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"),
    ("kana", "ぁ", "ヿ", SYLLABLES["kana"]),
    ("cjk", "㐀", "鿿", SYLLABLES["cjk"]),
    ("hangul", "가", "힣", SYLLABLES["hangul"]),
]
TITLE_GENDER = {t: g for g, all_ in TITLES.items() for t in all_}
NAME_GENDER = {n.lower(): g for (_, g), names in GIVEN.items() for n in names}
_PUNCTUATION = "!#$%&*+-./:?@^_~"
_BY_LENGTH = sorted(TITLE_GENDER, key=len, reverse=True)

_EMAIL = r"[^\W_][\w.+%-]*@(?:[\w-]+\.)+[^\W\d_]{2,}"
#: Access keys: a fixed prefix, and what follows it.
KEYS = [("AKIA", r"[0-9A-Z]{16}\b"), ("ASIA", r"[0-9A-Z]{16}\b"), *((p, r"[0-9A-Za-z]{30,}\b") for p in ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")), ("github_pat_", r"\w{22,}"), ("glpat-", r"[\w-]{20,}"), ("sk-", r"[\w-]{20,}"), ("AIza", r"[\w-]{35}(?!\w)"), *((f"xox{c}-", r"[\w-]{10,}") for c in "abprs")]
_KEY = re.compile(r"(?<!\w)(?:" + "|".join(f"{re.escape(p)}(?:{rest})" for p, rest in KEYS) + ")")
_PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?P<value>(?:[A-Za-z0-9+/=\s:,.]|-(?!-))+)")
SECRETS = ["password", "passwd", "pwd", "secret", "api_key", "token", "authorization"]
# a key word in any case, quoted or not, = or :, how a header names its kind, and the value to its end
_SECRET = re.compile(rf"(?ai:{'|'.join(SECRETS)})\\?[\"']?[ \t]*[=:][ \t]*\\?[\"']?(?:(?ai:bearer|basic|digest)[ \t]+)?(?P<value>[^\s\"',;]{{6,}})")
#: A bearer's token without its header has a digit, as "bearer" is a word as well.
_BEARER = re.compile(r"(?ai:bearer)[ \t]+(?=[A-Za-z._~+/=-]*[0-9])(?P<value>[\w.~+/=-]{16,})")
_BEGINS = re.compile(f"{_EMAIL}|{_KEY.pattern}")
_DOMAIN = re.compile(r"@(?:[\w-]+\.)+[^\W\d_]{2,}")
_NUMERIC = re.compile(
    r"(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?\(0\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\w)"
    r"|(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\w)"
    r"|(?<![\w.,+-])(?:0\d{2,4}|\(0\d{2,4}\))[ -]\d{3,4}[ -]\d{3,4}(?![\w-]|[.,]\d)"
    r"|(?<![\w+(.-])1[ .-]\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?![\w-])"
    r"|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\w)|(?<![\w.-])\d{3}-\d{3}-\d{4}(?![\w-])|(?<![\w.,-])[2-9]\d\d([ .])[2-9]\d\d\2\d{4}(?![\w-]|[.,]\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<ipv4>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<card>(?<![\w.-])(?:[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{3,4}|3[47]\d\d([ -]?)\d{6}\7\d{5})(?![\w-]))"
)
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")
_HEX_COLON = frozenset("0123456789abcdefABCDEF:")
_MARK = re.compile(r"@|[0-9]+")
_JOINED = re.compile(r"[^-]+")
_PART = re.compile(r"[^\W\d_]+")
_WORD = re.compile(r"(?<!\w)[^\W\d_]+(?:['’-](?!s\b)[^\W\d_]+)*(?!\w)")
#: Scripts that put no blanks between words.
_DENSE = ("cjk", "kana", "hangul", "")
_WORD_OF_NAME = re.compile(r"(?:[^\W\d_]\.\s?)*(?P<name>[^\W\d_]+(?:['’-](?!s\b)[^\W\d_]+)*)")


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _iban_rest(iban: str) -> int:
    """The number an IBAN's letters and digits stand for, modulo 97; 1 if its check digits are right."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def script_of(text: str) -> str:
    """The script of a text's first letter; the empty text for one not listed."""
    for c in text:
        if c.isalpha():
            return next((name for name, first, last, _ in SCRIPTS if first <= c <= last), "")
    return "latin"


def _cues(text: str) -> list[tuple[int, int, str]]:
    """Where mentions may begin: position, end of what gave it away, and which pattern to try."""
    found = []
    for m in _MARK.finditer(text):
        found.append((m.start(), m.end(), "email" if text[m.start()] == "@" else "digits"))
    folded = text.lower()
    if len(folded) != len(text):
        folded = "".join(low if len(low := c.lower()) == 1 else c for c in text)
    words = [(text, f"{t} ", "name") for t in TITLE_GENDER] + [(text, p, "key") for p, _ in KEYS] + [(folded, s, "secret") for s in SECRETS] + [(folded, "bearer", "bearer"), (text, "-----BEGIN ", "pem")]
    for where, word, kind in words:
        at = where.find(word)
        while at >= 0:
            found.append((at, at + len(word), kind))
            at = where.find(word, at + 1)
    return found


def _candidates(text: str) -> list[tuple[int, int, int, str]]:
    """``start, rank, cue, pattern`` in the order in which they are tried; no length is limited."""
    out = []
    for at, end, kind in _cues(text):
        if kind == "email":
            start = at
            while start and (text[start - 1].isalnum() or text[start - 1] in "_.+%-"):
                start -= 1
            while start < at and text[start] in "_.+%-":
                start += 1
            out.append((start, 0, at, kind))
        elif kind == "digits":
            before = text[at - 1] if at else " "
            if before in "+(":
                out.append((at - 1, 3, at, "digits"))
            elif at > 1 and before.isascii() and before.isupper() and text[at - 2].isupper():
                out.append((at - 2, 3, at, "digits"))
            if not (before.isalnum() or before == "_"):
                out.append((at, 4, at, "digits"))
            if ":" in text[max(0, at - 5) : at] or ":" in text[end : end + 5]:
                start = at
                while start and at - start < 40 and text[start - 1] in _HEX_COLON:
                    start -= 1
                out.append((start, 2, at, "ipv6"))
        else:
            out.append((at, 1, end, kind))
    out.sort()
    return out


def _names_at(text: str, at: int, after: int) -> list[tuple[int, int, str, str]]:
    """The given name and the surname that follow the title at ``at``, the last one of its row of titles."""
    if at and (text[at - 1].isalnum() or text[at - 1] == "_") or any(text.startswith(t + " ", after) for t in TITLE_GENDER):
        return []
    gender, first = TITLE_GENDER[text[at : after - 1]], at
    while not gender and (more := next((t for t in _BY_LENGTH if text.endswith(t + " ", max(0, first - len(t) - 1), first)), None)) is not None:
        gender, first = TITLE_GENDER[more], first - len(more) - 1
    parts = []
    while len(parts) < 2 and (m := _WORD_OF_NAME.match(text, after)) and not m["name"][0].islower():
        parts.append(m.span("name"))
        if text[m.end() : m.end() + 1] != " ":
            break
        after = m.end() + 1
    out = []
    for n, (a, b) in enumerate(parts):
        name = unicodedata.normalize("NFC", text[a:b]).lower()
        known = NAME_GENDER.get(name, "")
        given = len(parts) > 1 and n == 0 or len(parts) == 1 and known != ""
        # the parts of a double name are names of their own, as each may stand alone elsewhere
        for part in _JOINED.finditer(text, a, b):
            name = unicodedata.normalize("NFC", part[0]).lower()
            out.append((*part.span(), "given", f"{gender or known}|{name}") if given else (*part.span(), "surname", f"|{name}"))
    return out


def _found_at(text: str, start: int, cue: int, pattern: str) -> list[tuple[int, int, str, str]]:
    """The mention of a pattern at a place, if there is one; a name gives one for each part."""
    if pattern == "name":
        return _names_at(text, start, cue)
    if pattern == "email":
        m = _DOMAIN.match(text, cue) if start < cue else None
        return [(start, m.end(), "email", text[start : m.end()].lower())] if m else []
    if pattern == "digits":
        m = _NUMERIC.match(text, start)
        if not m:
            return []
        kind, surface = m.lastgroup or "phone", m[0]
        digits = re.sub(r"\D", "", surface.replace("(0)", ""))
        if kind == "card":
            return [(*m.span(), kind, digits)] if _luhn(digits) else []
        if kind == "iban":
            iban = surface.replace(" ", "")
            return [(*m.span(), kind, iban)] if _iban_rest(iban) == 1 or sum(c.isdigit() for c in iban) >= 10 else []
        if kind == "phone":
            if digits[0] == "0" and surface[0] != "+":
                return [(*m.span(), kind, digits)]
            american = len(digits) == 10 and surface[0] != "+" or len(digits) == 11 and digits[0] == "1"
            return [(*m.span(), kind, digits[-10:] if american else f"+{digits}")]
        return [(*m.span(), kind, digits if kind == "ssn" else surface)]
    if pattern == "ipv6":
        m = _IPV6.match(text, start)
        if not m or len(m[0].replace(":", "")) < (1 if "::" in m[0] else 4):
            return []
        try:
            return [(*m.span(), "ipv6", ipaddress.IPv6Address(m[0]).exploded)]
        except ValueError:
            return []
    m = {"secret": _SECRET, "bearer": _BEARER, "key": _KEY, "pem": _PEM}[pattern].match(text, start)
    if not m:
        return []
    if pattern == "key":
        return [(*m.span(), "key", m[0])]
    at, end = m.span("value")
    if pattern == "pem":
        return [(at, end, pattern, text[at:end])]
    out = []
    # an address or a key that begins the value is one, and what is left of the value another mention
    if begins := _BEGINS.match(text, at, end):
        email = "@" in begins[0]
        out.append((*begins.span(), "email" if email else "key", begins[0].lower() if email else begins[0]))
        at = begins.end()
    value = text[at:end]
    # one mark over and over is a mask, not a secret; so is what ends a sentence behind an address
    masked = not any(c.isalnum() for c in value) and (len(set(value)) <= 1 or bool(out))
    return out if masked else [*out, (at, end, "secret", value)]


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """``start, end, kind, entity`` of each mention, in order. Mentions of one entity have one form.

    A titled name gives two mentions, of the given name and of the surname. Both are then
    found wherever else they stand in the text, with a title or without one.
    """
    found, upto = [], 0
    for start, _, cue, pattern in _candidates(text):
        if start >= upto:
            for mention in _found_at(text, start, cue, pattern):
                found.append(mention)
                upto = mention[1]
    names = {}
    for start, end, kind, entity in found:
        if kind in ("given", "surname") and end - start > 1:
            names.setdefault(text[start:end].lower(), (kind, entity, text[start:end]))
    if not names:
        return found
    forms = {form: (kind, entity) for kind, entity, seen in names.values() for form in (seen, seen.upper(), _capital(seen.lower()))}
    out, at = [], 0
    places = iter([*_places(text, forms), (len(text), len(text))])
    place = next(places)
    for mention in [*found, (len(text), len(text), "", "")]:
        while place[1] <= mention[0] and place[0] < len(text):
            if place[0] >= at:
                out.append((*place, *forms[text[slice(*place)]]))
            place = next(places)
        out.append(mention)
        at = mention[1]
        while place[0] < at and place[0] < len(text):
            place = next(places)
    return out[:-1]


def _places(text: str, forms: dict[str, tuple[str, str]]) -> list[tuple[int, int]]:
    """Where names stand in a text, in order and apart: as words or parts of hyphenated ones.

    In scripts that put no blanks between words they may stand anywhere.
    """
    found = []
    for m in _WORD.finditer(text):
        if m[0] in forms:
            found.append(m.span())
        elif not m[0].isalpha():
            found += [(m.start() + p.start(), m.start() + p.end()) for p in _PART.finditer(m[0]) if p[0] in forms]
    dense = [f for f in forms if script_of(f) in _DENSE]
    if dense:
        import ahocorasick

        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for name in dense:
            automaton.add_word(name)
        automaton.make_automaton()
        found, others = [], sorted({*found, *((end - n + 1, end + 1) for end, n in automaton.iter_long(text))})
        for a, b in others:
            if not found or a >= found[-1][1]:
                found.append((a, b))
    return found


class _Draw:
    """A stream of keyed choices for one entity; ``attempt`` gives another stream."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        whole = f"{kind}\0{entity}\0{attempt}".encode("utf-8", "surrogatepass")
        self.seed, self.block, self.left = hashlib.blake2b(whole, key=key[:64]).digest(), 0, b""

    def below(self, n: int) -> int:
        if not self.left:
            self.left = hashlib.blake2b(self.block.to_bytes(8, "big") + self.seed).digest()
            self.block += 1
        taken, self.left = self.left[:4], self.left[4:]
        return int.from_bytes(taken, "big") % n

    def of(self, choices):
        return choices[self.below(len(choices))]

    def letter(self, c: str) -> str:
        """Another letter of the script and case of ``c``."""
        letters = next((own for _, first, last, own in SCRIPTS if first <= c <= last), None) or _row(c)
        new = self.of(letters)
        return new.upper() if c.isupper() else new

    def like(self, text: str, marks: bool = False) -> str:
        """Characters of the same classes; ``marks`` are drawn anew too."""
        if re.fullmatch(r"(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{8,}", text):
            return "".join(self.of("0123456789abcdef") for _ in text)
        return "".join(self.of("0123456789") if c.isdigit() else self.letter(c) if c.isalpha() else self.of(_PUNCTUATION) if marks and not c.isspace() else c for c in text)


@lru_cache(maxsize=10_000)
def _row(c: str) -> str:
    """Letters near ``c`` among the characters, of its category."""
    first, kind = ord(c) & ~31, unicodedata.category(c)
    return "".join(x for x in map(chr, range(first, first + 32)) if unicodedata.category(x) == kind).lower() or c


def _capital(name: str) -> str:
    """Each part of a name with a capital."""
    return re.sub(r"[^\W\d_]+", lambda m: m[0][0].upper() + m[0][1:], name)


def _name(d: _Draw, kind: str, gender: str, name: str, attempt: int) -> str:
    script = script_of(name)
    if kind == "given" and attempt == 0 and (script, gender) in GIVEN:
        return d.of(GIVEN[script, gender]).lower()
    parts = re.split(r"(['’-])", name)
    for n in range(0, len(parts), 2):
        if script not in SYLLABLES:
            parts[n] = d.like(parts[n] + parts[n][-1] * (attempt // 3))
        elif isinstance(SYLLABLES[script], str):
            parts[n] = "".join(d.of(SYLLABLES[script]) for _ in range(len(parts[n]) + attempt // 3))
        else:
            parts[n] = "".join(d.of(SYLLABLES[script]) for _ in range((3 if len(parts) == 1 else 2) + attempt // 3))
    ending = {"latin": "a", "cyrillic": "а", "greek": "α", "arabic": "ة"}.get(script, "")
    return "".join(parts) + (ending if kind == "given" and gender == "f" else "")


@lru_cache(maxsize=100_000)
def surrogate(kind: str, entity: str, attempt: int = 0, key: bytes = KEY) -> str:
    """The canonical surrogate of an entity: same kind, script, gender and format."""
    d = _Draw(key, kind, entity, attempt)
    if kind == "email":
        local, _, host = entity.partition("@")
        labels = host.split(".")
        keep = 2 if labels[-2:] in (["example", "com"], ["example", "org"], ["example", "net"], ["co", "uk"]) else 1
        local = d.like(local) + "".join(d.of("abcdefghijklmnopqrstuvwxyz") for _ in range(max(0, 6 - len(local))))
        return f"{local}@{'.'.join([*(d.like(x) for x in labels[:-keep]), *labels[-keep:]])}"
    if kind == "key":
        prefix = next(p for p, _ in KEYS if entity.startswith(p))
        rest = entity[len(prefix) :]
        return prefix + ("".join(d.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in rest) if prefix in ("AKIA", "ASIA") else d.like(rest))
    if kind == "phone":
        if entity[0] == "0":
            return "0" + d.of("123456789") + "".join(d.of("0123456789") for _ in entity[2:])
        if entity[0] != "+":
            rest = [d.of("0123456789") for _ in entity]
            rest[0], rest[3] = d.of("23456789"), d.of("23456789")
            return "".join(rest)
        return entity[1:3] + "".join(d.of("0123456789") for _ in entity[3:])
    if kind == "ssn":
        # numbers that are never given out come first; all others follow if those run short
        area = 900 + d.below(100) if attempt < 8 else d.below(900)
        return f"{area:03d}{10 + d.below(90)}{d.below(10000):04d}"
    if kind == "ipv4":
        first = entity.split(".") if attempt < 4 or not entity.startswith("192.168.") else ["10"]
        private = {"10": 1, "127": 1}.get(first[0], 2 if first[:2] == ["192", "168"] else 0)
        rest = [str(d.below(256)) for _ in range(3 - max(0, private - 1))]
        return ".".join([*first[:private], *rest]) if private else ".".join([str(d.of([n for n in range(11, 224) if n not in (127, 172, 192)])), *rest])
    if kind == "ipv6":
        local = entity[:4] if entity[:2] in ("fe", "fc", "fd") else "2001"
        return ":".join([local, *(f"{1 + d.below(65535):04x}" for _ in range(7))])
    if kind == "iban":
        body = "".join(d.of("0123456789") if c.isdigit() else d.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in entity[4:])
        return f"{entity[:2]}{98 - _iban_rest(f'{entity[:2]}00{body}'):02d}{body}"
    if kind == "card":
        body = entity[0] + "".join(d.of("0123456789") for _ in entity[2:])
        return next(body + c for c in "0123456789" if _luhn(body + c))
    if kind in ("given", "surname"):
        gender, _, name = entity.partition("|")
        return _name(d, kind, gender, name, attempt)
    return d.like(entity, marks=not any(c.isalnum() for c in entity))


def written(kind: str, surface: str, canonical: str) -> str:
    """The surrogate in the format of one mention: its separators and its case."""
    if kind == "phone" and "(0)" in surface:
        before, _, after = surface.partition("(0)")
        whole = written(kind, before + after, canonical)
        return f"{whole[: len(before)]}(0){whole[len(before) :]}"
    if kind in ("phone", "card", "ssn", "iban"):
        extra = sum(c.isalnum() for c in surface) - len(canonical)
        chars = iter([c for c in surface if c.isalnum()][: max(0, extra)] + list(canonical))
        return "".join(next(chars) if c.isalnum() else c for c in surface)
    if kind == "email" and surface != surface.lower():
        return canonical.upper() if surface.isupper() else "".join(c.upper() if n < len(surface) and surface[n].isupper() else c for n, c in enumerate(canonical))
    if kind in ("given", "surname"):
        return canonical.upper() if len(surface) > 1 and surface.isupper() else _capital(canonical)
    if kind == "ipv6":
        return canonical.upper() if any(c.isupper() for c in surface) else canonical
    return canonical


def rewrite(text: str, redrawn: dict[tuple[str, str], int], key: bytes = KEY) -> tuple[str, list[dict]]:
    """The text with every mention replaced, and where the replacements are."""
    out, spans, at, size = [], [], 0, 0
    for start, end, kind, entity in mentions(text):
        new = written(kind, text[start:end], surrogate(kind, entity, redrawn.get((kind, entity), 0), key))
        out += [text[at:start], new]
        size += start - at
        spans.append({"kind": kind, "start": size, "end": size + len(new)})
        size, at = size + len(new), end
    return "".join([*out, text[at:]]), spans


def redrawn_entities(docs: DataFrame, *, text_col: str = "text", key: bytes = KEY, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``kind, entity, attempt`` of the entities whose first surrogate is not free.

    Over all of ``docs``: no two entities of a kind may get the same surrogate, and none may
    get what is itself an entity there; given names and surnames count as one kind. Whoever
    loses draws again until all are distinct. Names, secrets and numbers grow or widen with
    the draws; if ``max_rounds`` rounds don't suffice, the job fails rather than repeat one.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = {(k, e) for t in batch["text"] if t for _, _, k, e in mentions(t)}
            yield pd.DataFrame([(k, e, 0) for k, e in found], columns=["kind", "entity", "attempt"])

    entities = docs.select(F.col(text_col).cast("string").alias("text")).mapInPandas(find, "kind string, entity string, attempt int").distinct()

    @F.pandas_udf("string")
    def drawn(kind: pd.Series, entity: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, e, a, key) for k, e, a in zip(kind, entity, attempt, strict=True)], dtype=object)

    bare = F.when(F.col("kind") == "phone", F.ltrim(F.lit("+"), "entity")).otherwise(F.regexp_replace("entity", r"^[fm]?\|", ""))
    group = F.when(F.col("kind").isin("given", "surname"), "name").otherwise(F.col("kind"))
    state = materialize(entities.withColumn("bare", bare).withColumn("group", group).withColumn("new", drawn("kind", "entity", "attempt")), "entities")
    for _ in range(max_rounds):
        real = state.select(F.col("group").alias("_group"), F.col("bare").alias("_new")).distinct()
        taken = state.groupBy("group", "new").agg(F.min(F.struct("attempt", "kind", "entity")).alias("first"), F.count(F.lit(1)).alias("n"))
        taken = taken.join(real, (F.col("group") == F.col("_group")) & (F.col("new") == F.col("_new")), "left")
        taken = taken.where("n > 1 or _new is not null").select(F.col("group").alias("_g"), F.col("new").alias("_n"), F.col("first.kind").alias("_kind"), F.col("first.entity").alias("_first"), F.col("_new").isNotNull().alias("_real"))
        taken = materialize(taken, "taken")
        if taken.isEmpty():
            discard(taken)
            return state.where("attempt > 0").select("kind", "entity", "attempt")
        again = state.join(taken, (F.col("group") == F.col("_g")) & (F.col("new") == F.col("_n")), "left")
        loses = F.col("_g").isNotNull() & (F.col("_real") | (F.col("entity") != F.col("_first")) | (F.col("kind") != F.col("_kind")))
        again = again.select("kind", "entity", (F.col("attempt") + F.when(loses, 1).otherwise(0)).alias("attempt"), "bare", "group")
        later = materialize(again.withColumn("new", drawn("kind", "entity", "attempt")), "entities")
        discard(state, taken)
        state = later
    raise RuntimeError(f"surrogates are not distinct after {max_rounds} rounds")


def replace_personal_data(docs: DataFrame, *, text_col: str = "text", key: bytes = KEY, max_shipped: int = MAX_SHIPPED, spans_col: str | None = None) -> DataFrame:
    """``docs`` with every mention of personal data replaced in ``text_col``; same columns.

    Found are e-mail addresses, access keys, private key blocks and secrets, phone, social
    security, card (with a right check digit) and bank account numbers, IPv4 and IPv6
    addresses, and names: those after a title, and the same names elsewhere in that text.
    Mentions have no greatest length. A value that is one mark over and over is a mask and stays.
    A surrogate depends on the key and the entity alone, so mentions of an entity agree in
    all documents, in any format; distinct entities keep distinct surrogates. Few entities
    need a second draw; beyond ``max_shipped`` of them they are joined by text, not shipped.

    Null text stays null and empty text empty; texts without mentions are unchanged, and so
    are other columns, the order of columns, and repeated rows. ``spans_col`` names an array
    of ``kind, start, end`` (characters of the new text) to add.
    """
    schema = "text string, spans array<struct<kind: string, start: int, end: int>>"
    found_again = redrawn_entities(docs, text_col=text_col, key=key)
    redrawn = materialize(found_again, "redrawn")
    shipped = {(r["kind"], r["entity"]): r["attempt"] for r in redrawn.limit(max_shipped + 1).collect()}
    new, text_hash, of, own = fresh([*docs.columns, spans_col or ""], "new", "text_hash", "of", "own")
    text = quoted(text_col).cast("string")

    def rows(texts: pd.Series, of) -> pd.DataFrame:
        found = [(None, None) if t is None else rewrite(t, of(n), key) for n, t in enumerate(texts)]
        return pd.DataFrame({"text": [t for t, _ in found], "spans": [s for _, s in found]}, dtype=object)

    if len(shipped) <= max_shipped:

        @F.pandas_udf(schema)
        def replaced(texts: pd.Series) -> pd.DataFrame:
            return rows(texts, lambda n: shipped)

        done = docs.withColumn(new, replaced(text))
    else:

        def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = [(h, k, e) for h, t in zip(batch["h"], batch["text"], strict=True) if t for _, _, k, e in mentions(t)]
                yield pd.DataFrame(out, columns=["h", "kind", "entity"])

        @F.pandas_udf(schema)
        def replaced_by(texts: pd.Series, own: pd.Series) -> pd.DataFrame:
            return rows(texts, lambda n: {(r["kind"], r["entity"]): r["attempt"] for r in (own[n] if own[n] is not None else [])})

        hashed = docs.withColumn(text_hash, F.xxhash64(text))
        owned = hashed.select(F.col(text_hash).alias("h"), text.alias("text")).mapInPandas(found, "h long, kind string, entity string")
        owned = owned.distinct().join(redrawn, ["kind", "entity"]).groupBy(F.col("h").alias(of)).agg(F.collect_list(F.struct("kind", "entity", "attempt")).alias(own))
        done = hashed.join(owned, F.col(text_hash) == F.col(of), "left").withColumn(new, replaced_by(text, own))
    keep = [F.col(f"{new}.text").alias(c) if c == text_col else quoted(c) for c in docs.columns]
    return done.select(*keep, *([F.col(f"{new}.spans").alias(spans_col)] if spans_col else []))
