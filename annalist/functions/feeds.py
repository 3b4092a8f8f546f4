"""Feeds and sitemaps as entries, in one pass over the text; packed bodies with limits."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

#: Elements that are entries, what of them is read, and the times' order of preference.
ENTRIES = {"item": "item", "entry": "item", "url": "url", "sitemap": "sitemap"}
TIMES = ("pubdate", "published", "updated", "lastmod", "date")
FIELDS = frozenset(("link", "loc", "title", "guid", "id", *TIMES))

_END_OR_QUOTE = re.compile(r"[>\"']")
_NAME = re.compile(r"/?([^\s/>\"'=]+)")
_ATTRIBUTE = re.compile(r"(?<![^\s/\"'])([^\s=/\"']++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)')")


def tokens(text: str) -> Iterator[tuple[str, str, str]]:
    """``kind, name, inside``: ``open``, ``empty`` and ``close`` tags by local name in small letters, and ``text``.

    Comments, declarations and instructions are left out, with a declaration's inner part; entities
    other than characters' are not known. CDATA is text as it stands. A tag without an end, and
    what follows it, is text.
    """
    at, end = 0, len(text)
    missing: set[str] = set()  # quotes that don't come again
    while at < end:
        tag = text.find("<", at)
        if tag < 0:
            tag = end
        if tag > at:
            yield "text", "", unescape(text[at:tag])
        if tag == end:
            return
        closing = next(((skip, mark) for begin, skip, mark in (("<!--", 4, "-->"), ("<![CDATA[", 9, "]]>"), ("<?", 2, "?>")) if text.startswith(begin, tag)), None)
        if closing:
            stop = text.find(closing[1], tag + closing[0])
            stop = end if stop < 0 else stop
            if closing[0] == 9:
                yield "text", "", text[tag + 9 : stop]
            at = stop + len(closing[1])
            continue
        stop, look = -1, tag + 1
        while (m := _END_OR_QUOTE.search(text, look)) is not None:
            if m[0] == ">":
                stop = m.start()
                break
            look = m.end()
            if m[0] not in missing:
                other = text.find(m[0], look)
                if other < 0:
                    missing.add(m[0])
                else:
                    look = other + 1
        if stop < 0:
            yield "text", "", unescape(text[tag:])
            return
        if text.startswith("<!", tag):
            inner = text.find("[", tag, stop)
            if inner >= 0:
                stop = text.find("]>", inner)
                stop = end if stop < 0 else stop + 1
        elif m := _NAME.match(text, tag + 1, stop):
            name = m[1].rpartition(":")[2].lower()
            yield ("close" if text[tag + 1] == "/" else "empty" if text[stop - 1] == "/" else "open"), name, text[m.end() : stop]
        at = stop + 1


@dataclass
class Entry:
    element: str
    found: dict[str, str] = field(default_factory=dict)
    links: list[tuple[str, str]] = field(default_factory=list)

    def row(self) -> tuple[str, str, str | None, str | None] | None:
        """``kind, url, title, published``; None without an address. Of several links the page itself counts."""
        alternate = [href for rel, href in self.links if rel in ("", "alternate")]
        url = self.found.get("loc") or self.found.get("link") or (alternate[0] if alternate else None)
        return (ENTRIES[self.element], url, self.found.get("title"), next((self.found[t] for t in TIMES if t in self.found), None)) if url else None


def entries(text: str | None) -> Iterator[tuple[str, str, str | None, str | None]]:
    """``kind, url, title, published`` of the entries of RSS, Atom and sitemap documents, in order.

    An entry ends where it is closed, where the next one of its name begins, or at the end. Of repeated fields
    the first that has text counts. Time is linear in the text, whatever it holds.
    """
    own: Entry | None = None
    reading, parts, nested = None, [], 0
    for kind, name, inside in tokens(text or ""):
        if kind == "text":
            if reading:
                parts.append(inside)
            continue
        if own is not None and name == own.element and kind != "empty":
            if (row := own.row()) is not None:
                yield row
            own, reading, nested = None, None, 0
        if kind == "open" and name in ENTRIES and own is None:
            own = Entry(name)
        elif own is None:
            continue
        elif kind in ("open", "empty") and reading is None:
            if name == "link":
                attributes = {a.lower(): unescape(x or y) for a, x, y in _ATTRIBUTE.findall(inside)}
                if "href" in attributes:
                    own.links.append((attributes.get("rel", "").lower(), attributes["href"].strip()))
            if kind == "open" and nested == 0 and name in FIELDS:
                reading, parts = name, []
            elif kind == "open":
                nested += 1
        elif kind == "close":
            if reading == name:
                value = "".join(parts).strip()
                if value:
                    own.found.setdefault(name, value)
                reading = None
            elif reading is None:
                nested = max(0, nested - 1)
    if own is not None and (row := own.row()) is not None:
        yield row


class Packed(ValueError):
    """A packed body that can't be read; the message is the code of the reason."""


def unpacked(content: bytes, max_bytes: int, max_ratio: int = 200) -> bytes:
    """A body without its gzip members, one after the other; one without gzip's mark is as it stands.

    No more than ``max_bytes`` are made, nor more than ``max_ratio`` times what is read.
    """
    if content[:2] != b"\x1f\x8b":
        if len(content) > max_bytes:
            raise Packed("body_too_large")
        return content
    out, size, rest = [], 0, content
    while rest:
        member = zlib.decompressobj(31)
        while not member.eof:
            try:
                piece = member.decompress(rest, 1 << 16)
            except zlib.error:
                raise Packed("content_decoding_error") from None
            rest = member.unconsumed_tail
            size += len(piece)
            if size > max_bytes:
                raise Packed("body_too_large")
            if size > max_ratio * len(content):
                raise Packed("decompression_bomb")
            out.append(piece)
            if not member.eof and not rest and not piece:
                raise Packed("content_decoding_error")
        rest = member.unused_data.lstrip(b"\0")
    return b"".join(out)
