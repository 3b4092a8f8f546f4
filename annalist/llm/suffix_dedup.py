"""Repeated byte strings by a distributed merge sort of suffixes that knows common prefixes.

Tasks sort the suffixes at their anchors into front-coded runs and exchange those. Each shard
merges its runs with a loser tree that compares strings only beyond the prefix they are known
to share; the common prefixes that come out of the merge, with the bytes before the anchors,
say which windows occur again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.repeats import Kind, common, merged, mix, read_run, repeated

LENGTH = 200
#: A gram is about half a window: longer ones mean more anchors, shorter ones more candidates.
GRAM_SHARE = 0.52


def byte_symbols(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8)


def merge_runs(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs of ``(shared, string, ...)``; ``shared`` then is with the one before.

    A loser tree: an inner node keeps the run that lost there, with the prefix it shares with
    the winner. Of two heads the one that shares more with the last output is smaller; only at
    a tie are they compared, from there on.
    """
    heads = [next(r, None) for r in runs]
    width = 1 << max(0, len(runs) - 1).bit_length()
    heads += [None] * (width - len(runs))
    shared, losers = [0] * width, [0] * width

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared prefix becomes the one with the winner."""
        if heads[a] is None or heads[b] is None:
            return (b, a) if heads[a] is None else (a, b)
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        x, y = heads[a][1], heads[b][1]
        h = common(x, y, shared[a])
        if h < len(y) and (h == len(x) or x[h] < y[h]) or h == len(x) == len(y):
            shared[b] = h
            return a, b
        shared[a] = h
        return b, a

    def build(node: int) -> int:
        if node >= width:
            return node - width
        winner, loser = play(build(2 * node), build(2 * node + 1))
        losers[node] = loser
        return winner

    winner = build(1) if width > 1 else 0
    while heads[winner] is not None:
        yield (shared[winner], *heads[winner][1:])
        heads[winner] = next(runs[winner], None) if winner < len(runs) else None
        shared[winner] = heads[winner][0] if heads[winner] is not None else 0
        node = (winner + width) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def covered_stretches(runs: list[bytes], window: int) -> Iterator[tuple[bytes, int, int]]:
    """``key, start, end`` of what the windows that occur again cover, from a shard's runs.

    The window that starts o bytes before its anchor occurs again if another suffix shares its
    other bytes and the same o bytes stand before it. In sorted order suffixes that share a
    prefix are neighbours, so each o splits them where too little is shared.
    """
    shared, lefts, rights, windows, keys, starts, settled = [], [], [], [], [], [], []
    for lcp, text, left, n, key, start, known in merge_runs([read_run(r) for r in runs]):
        shared.append(lcp - 8)
        rights.append(len(text) - 8)
        lefts.append(left[::-1])
        windows.append(n)
        keys.append(key)
        starts.append(start)
        settled.append(known)
    if not shared:
        return
    common_right = np.array(shared)
    n, depth = len(shared), max(map(len, lefts)) + 1
    most = np.array([len(x) for x in lefts])
    least = most - np.array(windows) + 1
    before = np.zeros((n, depth), dtype=np.uint8)
    for row, left in enumerate(lefts):
        before[row, : len(left)] = np.frombuffer(left, dtype=np.uint8)
    hits = np.zeros((n, depth + 1), dtype=bool)
    running = np.zeros(n, dtype=np.uint64)
    for o in range(depth):
        if o:
            running = mix(running * np.uint64(0x9E3779B97F4A7C15) + before[:, o - 1].astype(np.uint64) + np.uint64(1))
        group = np.cumsum(common_right < window - o)
        rows = np.flatnonzero((least <= o) & (o <= most))
        if len(rows) < 2:
            continue
        order = rows[np.lexsort((running[rows], group[rows]))]
        same = (group[order][1:] == group[order][:-1]) & (running[order][1:] == running[order][:-1])
        hits[order[1:][same], o] = True
        hits[order[:-1][same], o] = True
    hits[np.array(settled)] = False
    step = np.diff(np.concatenate([np.zeros((n, 1), dtype=np.int8), hits.astype(np.int8)], axis=1), axis=1)
    row, low = np.nonzero(step == 1)
    _, high = np.nonzero(step == -1)
    for r, a, b in zip(row.tolist(), low.tolist(), high.tolist(), strict=True):
        place = starts[r] + int(most[r])
        yield keys[r], place - (b - 1), place - a + window


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``id_col, n_bytes, spans, kept`` for every row: what is removed, and the bytes that stay.

    Removed is each byte that a string of ``length`` bytes covers which also starts anywhere
    else in the table, in the same text or another; matches do not cross texts, and the input
    is what counts. ``spans`` are the maximal removed runs (``start``, ``end``).

    Null and empty texts, and texts shorter than ``length``, lose nothing. Repeated rows are
    each other's copies. An empty table gives no rows; other columns are not looked at.
    """
    kind = Kind(byte_symbols, length, max(1, round(length * GRAM_SHARE)))
    found = repeated(docs, kind, lambda runs: covered_stretches(runs, length), id_col=id_col, text_col=text_col)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for key, z, covers in zip(batch["id"], batch["z"], batch["covers"], strict=True):
                data, spans = expand(z), merged(covers)
                edges = [0, *(x for s in spans for x in s), len(data)]
                kept = b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                rows.append((key, len(data), [{"start": a, "end": b} for a, b in spans], kept))
            yield pd.DataFrame(rows, columns=["id", "n_bytes", "spans", "kept"])

    id_kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return found.withColumnRenamed(id_col, "id").mapInPandas(cut, schema).withColumnRenamed("id", id_col)


def digests(removed: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Counts and the hash of what stays, of the rows of ``remove_repeats``."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return removed.select(id_col, "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
