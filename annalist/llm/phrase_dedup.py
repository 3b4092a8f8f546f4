"""Recurring passages of words, located with sharded Aho-Corasick automata.

Contexts of grams that occur again are dealt to shards. A shard confirms which windows of words
recur, makes the maximal recurring passages the patterns of automata of bounded size, and
streams its contexts through them to locate every occurrence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame

from annalist.llm.repeats import Kind, merged, prefix_hashes, read_run, repeated, stretch_hashes

WINDOW = 35
GRAM_SHARE = 0.34
#: Words in the patterns of one automaton.
WORDS_PER_AUTOMATON = 100_000
CONTEXTS_AT_ONCE = 1000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


def word_symbols(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text."""
    space = _SPACES[np.frombuffer(data, dtype=np.uint8)]
    edges = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    if not len(starts):
        return np.zeros(0, dtype="<u8")
    prefix = prefix_hashes(np.frombuffer(data, dtype=np.uint8))
    return stretch_hashes(prefix, starts, ends).astype("<u8")


def covered_stretches(runs: list[bytes], window: int) -> Iterator[tuple[bytes, int, int]]:
    """``key, start, end`` of what recurring windows cover, from a shard's runs.

    Windows of different anchor grams differ, so a few grams are taken at a time: patterns and
    automata stay small, and a context passes only the automata of its own gram.
    """
    found = [(text[:8], np.frombuffer(left + text[8:], dtype="<u8"), n, key, start, known) for run in runs for _, text, left, n, key, start, known in read_run(run)]
    found.sort(key=lambda x: x[0])
    at = 0
    while at < len(found):
        upto = min(at + CONTEXTS_AT_ONCE, len(found))
        while upto < len(found) and found[upto][0] == found[upto - 1][0]:
            upto += 1
        yield from _covered(found[at:upto], window)
        at = upto


def _covered(found: list[tuple], window: int) -> Iterator[tuple[bytes, int, int]]:
    """Words are numbered here. A window recurs if it is in two contexts, or in one that stands
    for several."""
    _, contexts, counts, keys, starts, settled = map(list, zip(*found, strict=True))
    sizes = np.array([len(c) for c in contexts])
    number = np.unique(np.concatenate(contexts), return_inverse=True)[1].astype(np.int32)
    first = np.cumsum(sizes) - sizes
    n = np.array(counts)
    at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    of = np.repeat(np.arange(len(contexts)), n)
    windows = np.lib.stride_tricks.sliding_window_view(number, window) if len(number) >= window else np.zeros((0, window), dtype=np.int32)
    hashes = stretch_hashes(prefix_hashes(number), at, at + window)
    order = np.lexsort((at, hashes))
    # equal hashes are held against each other word by word, a few at a time
    same = hashes[order][1:] == hashes[order][:-1]
    pairs = np.flatnonzero(same)
    for k in range(0, len(pairs), 16384):
        part = pairs[k : k + 16384]
        same[part] = (windows[at[order[part + 1]]] == windows[at[order[part]]]).all(axis=1)
    recurs = np.array(settled)[of]
    recurs[order[1:][same]] = True
    recurs[order[:-1][same]] = True
    step = np.flatnonzero(np.diff(np.concatenate([[0], recurs.astype(np.int8), [0]])) | np.concatenate([[0], np.diff(of) != 0, [0]]))
    patterns: dict[tuple[int, ...], None] = {}
    for a, b in zip(step[:-1].tolist(), step[1:].tolist(), strict=True):
        if recurs[a]:
            patterns[tuple(number[at[a] : at[b - 1] + window].tolist())] = None
    yield from _located(list(patterns), [number[f : f + s] for f, s in zip(first, sizes, strict=True)], keys, starts, settled)


def _located(patterns: list[tuple[int, ...]], contexts: list[np.ndarray], keys: list[bytes], starts: list[int], settled: list[bool]) -> Iterator[tuple[bytes, int, int]]:
    import ahocorasick

    at = 0
    while at < len(patterns):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        words = 0
        while at < len(patterns) and words < WORDS_PER_AUTOMATON:
            automaton.add_word(patterns[at], len(patterns[at]))
            words += len(patterns[at])
            at += 1
        automaton.make_automaton()
        for context, key, start, known in zip(contexts, keys, starts, settled, strict=True):
            if known:
                continue
            reached = -1
            for end, length in automaton.iter(tuple(context.tolist())):
                begin = end + 1 - length
                if reached >= 0 and begin <= reached:
                    low, reached = min(low, begin), end + 1
                    continue
                if reached >= 0:
                    yield key, start + low, start + reached
                low, reached = begin, end + 1
            if reached >= 0:
                yield key, start + low, start + reached


def remove_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``id_col, n_words, spans, kept`` for every row: what is removed, and the words that stay.

    Words are maximal runs of characters other than ASCII white space. Removed is each word
    that a window of ``window`` words covers whose words also start anywhere else in the table,
    in the same text or another; the input is what counts. ``spans`` are the maximal removed
    runs of words; ``kept`` joins the other words by one space.

    Null and empty texts, and texts of fewer words, lose nothing. Repeated rows are each
    other's copies. An empty table gives no rows; other columns are not looked at.
    """
    kind = Kind(word_symbols, window, max(1, round(window * GRAM_SHARE)))
    found = repeated(docs, kind, lambda runs: covered_stretches(runs, window), id_col=id_col, text_col=text_col)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for key, z, covers in zip(batch["id"], batch["z"], batch["covers"], strict=True):
                words, spans = _WORD.findall(expand(z)), merged(covers)
                edges = [0, *(x for s in spans for x in s), len(words)]
                kept = b" ".join(w for i in range(0, len(edges), 2) for w in words[edges[i] : edges[i + 1]])
                rows.append((key, len(words), [{"start": a, "end": b} for a, b in spans], kept.decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(rows, columns=["id", "n_words", "spans", "kept"])

    id_kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_kind}, n_words long, spans array<struct<start: long, end: long>>, kept string"
    return found.withColumnRenamed(id_col, "id").mapInPandas(cut, schema).withColumnRenamed("id", id_col)
