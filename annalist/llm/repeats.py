"""What exact removal of repeated stretches shares: anchors, contexts, and putting texts together.

A text is a sequence of symbols (bytes or words). A window is so many consecutive symbols. Each
window has one anchor: the position of the smallest hash among its grams (shorter runs of
symbols). Equal windows have their anchors at the same place and with the same gram, so only
anchors whose gram occurs again can be in a repeated window. An anchor's context is all
windows that have it.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.common import discard, id_text, materialize, shards_for

#: Anchors with a gram that occurs more often are compared window by window, so that no shard
#: gets all contexts of one gram.
HOT = 1000
#: Positions that fit into the lower bits of a gram's hash.
PLACES = 1 << 24
ENTRIES_PER_RUN = 50_000
ENTRIES_PER_SHARD = 10_000
#: Shards that a task takes one after the other; tasks grow with the entries, and are not put together again.
SHARDS_PER_TASK = 2
_R = 0x9E3779B97F4A7C15
_R_INVERSE = pow(_R, -1, 2**64)
_ALL = 2**64 - 1


@dataclass(frozen=True)
class Kind:
    """How texts are cut: the symbols of a text as an unsigned array, and the lengths."""

    symbols: Callable[[bytes], np.ndarray]
    window: int
    gram: int

    @property
    def reach(self) -> int:
        return self.window - self.gram + 1


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, base: int = _R) -> np.ndarray:
    return _powers(1 << max(16, n.bit_length()), base)[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_hashes(symbols: np.ndarray) -> np.ndarray:
    """Running polynomial hashes, from which the hash of any stretch follows."""
    out = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * powers(len(symbols)), out=out[1:])
    return out


def stretch_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((prefix[ends] - prefix[starts]) * powers(len(prefix), _R_INVERSE)[starts])


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    filled = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    filled[:n] = values
    blocks = filled.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(symbols: np.ndarray, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``gram hash, position, first window, last window`` of each anchor; windows by their start.

    The order of grams is by the upper bits of their hash, and then by position, which fills
    the lower ones; longer texts are taken in overlapping parts.
    """
    if len(symbols) < kind.window:
        none = np.zeros(0, dtype=np.int64)
        return none.view(np.uint64), none, none, none
    if len(symbols) > PLACES:
        step = PLACES - kind.window
        parts = [(c, anchors(symbols[c : c + step + kind.window - 1], kind)) for c in range(0, len(symbols), step)]
        return tuple(np.concatenate([p[k] if k == 0 else p[k] + c for c, p in parts]) for k in range(4))
    prefix = prefix_hashes(symbols)
    at = np.arange(len(symbols) - kind.gram + 1)
    grams = stretch_hashes(prefix, at, at + kind.gram)
    mask = np.uint64(PLACES - 1)
    place = (_window_minima((grams & ~mask) | at.astype(np.uint64), kind.reach) & mask).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    return grams[place[first]], place[first], first, last


@dataclass
class Entry:
    """A context: its symbols, where the anchor is in them, and where it starts in which row."""

    gram: int
    offset: int
    content: bytes
    key: bytes
    start: int
    windows: int
    settled: bool = False


def _collapse(entries: list[Entry], kind: Kind) -> tuple[list[Entry], list[tuple[bytes, int, int]]]:
    """One entry for equal contexts, and what thereby is known to be covered."""
    seen: dict[tuple[int, int, bytes], Entry] = {}
    covered = []
    for e in entries:
        first = seen.setdefault((e.gram, e.offset, e.content), e)
        if first is e:
            continue
        for one in (first, e):
            if not one.settled:
                covered.append((one.key, one.start, one.start + one.windows - 1 + kind.window))
        first.settled = True
    return list(seen.values()), covered


def _windows_of(e: Entry, kind: Kind, size: int) -> Iterator[Entry]:
    """A context as one entry for each of its windows, with the window's own hash as gram."""
    symbols = np.frombuffer(e.content, dtype=f"<u{size}")
    starts = np.arange(e.windows)
    hashes = stretch_hashes(prefix_hashes(symbols), starts, starts + kind.window)
    for at, h in zip(starts.tolist(), hashes.tolist(), strict=True):
        yield Entry(h, 0, e.content[at * size : (at + kind.window) * size], e.key, e.start + at, 1, e.settled)


def common(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, where ``at`` bytes are known to agree."""
    n = min(len(a), len(b))
    if a[at:n] == b[at:n]:
        return n
    differ = int.from_bytes(a[at:n], "big") ^ int.from_bytes(b[at:n], "big")
    return n - (differ.bit_length() + 7) // 8


def suffix(e: Entry, size: int) -> bytes:
    """What runs are sorted by: the gram's hash, and the symbols from the anchor on."""
    return struct.pack(">Q", e.gram) + e.content[e.offset * size :]


def pack_run(entries: list[Entry], size: int) -> bytes:
    """A sorted, front-coded run: of each suffix only what differs from the one before."""
    out, before = [], b""
    for own, e in sorted(((suffix(e, size), e) for e in entries), key=lambda x: x[0]):
        shared = common(before, own)
        left = e.content[: e.offset * size]
        out.append(struct.pack(_HEAD.format, shared, len(own) - shared, len(left), e.windows, e.key, e.start, e.settled) + own[shared:] + left)
        before = own
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


_HEAD = struct.Struct("<HHHH16sqB")


def read_run(run: bytes) -> Iterator[tuple[int, bytes, bytes, int, bytes, int, bool]]:
    """``shared, suffix, left, windows, key, start, settled`` in order; shared with the one before."""
    data, at, before = zstandard.ZstdDecompressor().decompress(run, max_output_size=2**31), 0, b""
    while at < len(data):
        shared, rest, left, windows, key, start, settled = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        before = before[:shared] + data[at : at + rest]
        yield shared, before, data[at + rest : at + rest + left], windows, key, start, bool(settled)
        at += rest + left


def _runs(entries: list[Entry], kind: Kind, size: int, shards: int, hot: set[int]) -> Iterator[tuple]:
    kept, covered = _collapse(entries, kind)
    split = [w for e in kept if e.gram in hot for w in _windows_of(e, kind, size)]
    split, more = _collapse(split, kind)
    by_shard: dict[int, list[Entry]] = {}
    for e in [*(e for e in kept if e.gram not in hot), *split]:
        # anchors have small hashes, as they are minima, so their order would fill the first shards alone
        by_shard.setdefault((e.gram * _R & _ALL) * shards >> 64, []).append(e)
    for shard, own in by_shard.items():
        yield shard, pack_run(own, size), None, None, None
    for key, start, end in [*covered, *more]:
        yield None, None, key, start, end


def repeated(docs: DataFrame, kind: Kind, solve: Callable[[list[bytes]], Iterator[tuple[bytes, int, int]]], *, id_col: str, text_col: str) -> DataFrame:
    """``id_col, z, covers`` for every row: the compressed text and the covered stretches.

    ``solve`` gets the runs of a shard and yields ``key, start, end`` of stretches, in symbols,
    whose windows all occur again. A row is known by a 128-bit hash of its id and text; rows
    that agree in both are each other's copies, and share what is covered. Grams find their
    rows by 64 bits; a chance meeting there only adds grams to look at.
    """
    size = kind.symbols(b"").dtype.itemsize
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    row = F.unhex(F.md5(F.concat(id_text("id"), F.lit("\0"), F.coalesce("text", F.lit(""))).cast("binary")))
    source = source.withColumn("key", F.xxhash64(F.lit("row"), id_text("id"), F.col("text"))).where("text is not null and text <> ''")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.unique(anchors(kind.symbols(t.encode("utf-8", "surrogatepass")), kind)[0], return_counts=True) for t in batch["text"]]
            if found:
                keys = np.repeat(batch["key"].to_numpy(), [len(g) for g, _ in found])
                yield pd.DataFrame({"gram": np.concatenate([g for g, _ in found]).view(np.int64), "key": keys, "n": np.concatenate([n for _, n in found])})

    def compressed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "row": batch["row"], "z": [squeeze(t.encode("utf-8", "surrogatepass")) for t in batch["text"]]})

    found = materialize(source.select("key", "text").mapInPandas(scan, "gram long, key long, n int"), "grams")
    again = found.groupBy(F.col("gram").alias("_gram")).agg(F.sum("n").alias("_n")).where(F.col("_n") > 1)
    wanted = found.join(again, F.col("gram") == F.col("_gram")).select("key", F.struct("gram", (F.col("_n") > HOT).alias("hot")).alias("g"))
    wanted = wanted.groupBy(F.col("key").alias("_key")).agg(F.collect_set("g").alias("grams"))
    wanted = materialize(wanted, "wanted")
    discard(found)
    shards = shards_for(int(wanted.agg(F.coalesce(F.sum(F.size("grams")), F.lit(0))).first()[0]), ENTRIES_PER_SHARD, docs.sparkSession)

    def contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        expand = zstandard.ZstdDecompressor().decompress
        columns = ["shard", "run", "row", "start", "end"]
        entries: list[Entry] = []
        hot: set[int] = set()
        for batch in batches:
            for key, z, grams in zip(batch["row"], batch["z"], batch["grams"], strict=True):
                symbols = kind.symbols(expand(z))
                own = np.array(sorted(g["gram"] & (2**64 - 1) for g in grams), dtype=np.uint64)
                hot.update(g["gram"] & (2**64 - 1) for g in grams if g["hot"])
                gram, place, first, last = anchors(symbols, kind)
                for i in np.flatnonzero(np.isin(gram, own)).tolist():
                    begin, end = int(first[i]), int(last[i]) + kind.window
                    entries.append(Entry(int(gram[i]), int(place[i]) - begin, symbols[begin:end].tobytes(), key, begin, int(last[i]) - begin + 1))
                if len(entries) >= ENTRIES_PER_RUN:
                    yield pd.DataFrame(list(_runs(entries, kind, size, shards, hot)), columns=columns, dtype=object)
                    entries = []
        if entries:
            yield pd.DataFrame(list(_runs(entries, kind, size, shards, hot)), columns=columns, dtype=object)

    texts = source.select("key", row.alias("row"), "text").mapInPandas(compressed, "key long, row binary, z binary")
    parts = texts.join(wanted, F.col("key") == F.col("_key")).select("row", "z", "grams").mapInPandas(contexts, "shard int, run binary, row binary, start int, end int")
    parts = materialize(parts, "runs")
    discard(wanted)

    def solved(shard: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(solve(list(shard["run"]))), columns=["row", "start", "end"], dtype=object)

    dealt = parts.where("shard is not null").select("shard", "run").repartition(-(-shards // SHARDS_PER_TASK), "shard")
    covers = dealt.groupBy("shard").applyInPandas(solved, "row binary, start int, end int")
    covers = covers.union(parts.where("shard is null").select("row", "start", "end"))
    covers = covers.groupBy(F.col("row").alias("_row")).agg(F.collect_set(F.struct("start", "end")).alias("covers"))
    kind_of_id = docs.schema[id_col].dataType.simpleString()

    def with_id(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "row": batch["row"], "z": [squeeze((t or "").encode("utf-8", "surrogatepass")) for t in batch["text"]]})

    everything = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("row", row)
    everything = everything.mapInPandas(with_id, f"id {kind_of_id}, row binary, z binary")
    return everything.join(covers, F.col("row") == F.col("_row"), "left").select(F.col("id").alias(id_col), "z", "covers")


def merged(covers) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching stretches, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((c["start"], c["end"]) for c in (covers if covers is not None else [])):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out
