"""Best-fit decreasing packing of tokenised documents into sequences of fixed capacity."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annalist.llm.common import fresh, materialize, quoted

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k"
#: Documents whose pieces are held in a task at a time.
DOCUMENTS_AT_ONCE = 256


@lru_cache(maxsize=4)
def encoder(vocabulary: str):
    """A function from a text to its ids, as numpy.

    ``tokenizers`` on the vocabulary's JSON file is the definition. The same vocabulary as
    ranks gives the same ids several times faster, so ``tiktoken`` runs; a text it refuses
    goes to ``tokenizers``. The vocabulary's marker strings give their own ids, as there.
    """
    import base64
    import json

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as f:
        markers = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=markers)

    def encode(text: str) -> np.ndarray:
        try:
            return np.array(fast.encode(text, allowed_special="all", disallowed_special=()), dtype="<u4")
        except Exception:  # noqa: BLE001  the splitting pattern's limit on very long runs
            return np.array(reference_encoder(vocabulary)(text), dtype="<u4")

    return encode


@lru_cache(maxsize=4)
def reference_encoder(vocabulary: str):
    """The defining, slower form of ``encoder``."""
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    return lambda text: own.encode(text, add_special_tokens=False).ids


def tokenize(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY, with_ids: bool = True) -> DataFrame:
    """Token pieces of whole documents: ``id_col, piece, start, length, ids_crc32[, ids]``.

    A document is its text's ids and then ``end_id``. One longer than ``capacity`` is cut
    into pieces of ``capacity`` tokens, where the first piece takes the remainder.
    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit numbers. Null and empty
    text give one piece, the end id alone; repeated rows give repeated pieces; an empty table
    gives none. Extra columns are ignored.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        for whole in batches:
            for at in range(0, len(whole), DOCUMENTS_AT_ONCE):
                batch, rows = whole.iloc[at : at + DOCUMENTS_AT_ONCE], []
                for doc, text in zip(batch["id"], batch["text"], strict=True):
                    ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                    first = len(ids) % capacity or capacity
                    for piece, start in enumerate([0, *range(first, len(ids), capacity)]):
                        part = ids[start : first if piece == 0 else start + capacity]
                        rows.append((doc, piece, start, len(part), zlib.crc32(part.tobytes()), part.astype(np.int32) if with_ids else None))
                out = pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32", "ids"])
                yield out if with_ids else out.drop(columns="ids")

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(cut, schema).withColumnRenamed("id", id_col)


class TightestBin:
    """Segment tree over remaining capacities: which capacities have open bins.

    ``first_from(n)`` finds the smallest capacity of at least ``n`` with a bin, in time
    logarithmic in the capacity.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.some = bytearray(2 * self.leaves)

    def put(self, at: int, some: bool) -> None:
        k = at + self.leaves
        self.some[k] = some
        while k > 1:
            k //= 2
            self.some[k] = self.some[2 * k] | self.some[2 * k + 1]

    def first_from(self, at: int) -> int | None:
        k = at + self.leaves
        if self.some[k]:
            return at
        while k > 1:
            if k % 2 == 0 and self.some[k + 1]:
                k += 1
                while k < self.leaves:
                    k = 2 * k if self.some[2 * k] else 2 * k + 1
                return k - self.leaves
            k //= 2
        return None


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over all items of a corpus, given how many there are of each length.

    Equal lengths are interchangeable and so are bins with the same space left, so whole runs
    of items are placed at once; the bins are those that placing one item after another would
    give. Returns runs ``(length, first, last, per_bin, sequence, offset)``: the items of
    that length ranked first..last-1 go, ``per_bin`` to a bin, to consecutive sequences from
    ``sequence``, at ``offset`` and after each other. The runs grow with the capacity, not
    with the items.
    """
    tree, bins, plan, opened = TightestBin(capacity), {}, [], 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        at, count = 0, counts[length]
        while at < count:
            space = tree.first_from(length)
            if space is None:
                per_bin, left = capacity // length, count - at
                begin, n, space = opened, -(-left // per_bin), capacity
                opened += n
            else:
                begin, n = bins[space].pop()
                if not bins[space]:
                    tree.put(space, False)
                per_bin, left = space // length, count - at
            full = min(n, left // per_bin)
            last = min(left - full * per_bin, per_bin) if full < n else 0
            parts = [(begin, full, per_bin), (begin + full, int(last > 0), last), (begin + full + (last > 0), n - full - (last > 0), 0)]
            for start, m, each in parts:
                if m and each:
                    plan.append((length, at, at + m * each, each, start, capacity - space))
                    at += m * each
                if m and (rest := space - each * length):
                    bins.setdefault(rest, []).append((start, m))
                    tree.put(rest, True)
    return plan


def pack(pieces: DataFrame, *, id_col: str = "doc_id", length_col: str = "length", order_cols: tuple[str, ...] = ("piece", "ids_crc32"), capacity: int = CAPACITY) -> DataFrame:
    """Place every piece: adds ``sequence_id`` and ``offset`` to the columns of ``pieces``.

    Best-fit decreasing over the whole table. The driver sees only how many pieces there are
    of each length (at most ``capacity`` numbers). The pieces are then ranked within their
    length: counts by slice give each slice's first rank, so that no length, however common,
    is sorted in one task; repeats of one id fall into slices by ``order_cols`` too. Ties follow ``id_col`` and ``order_cols``; identical rows are
    interchangeable. Lengths must lie in 1..``capacity``; another length fails the job. No
    rows give no rows.
    """
    pieces = materialize(pieces, "pieces")
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy(length_col).count().collect()}
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    slices = max(1, round(sum(counts.values()) ** 0.5))
    plan = pd.DataFrame(best_fit_plan(counts, capacity), columns=["length", "first", "last", "per_bin", "sequence", "offset"]).astype("int64").sort_values(["length", "first"])
    own, of, n_of, place, rank, at = fresh(pieces.columns, "slice", "of", "length_of", "place", "rank", "at")
    cut = pieces.withColumn(own, F.pmod(F.xxhash64(id_col, *order_cols), F.lit(slices)))
    sizes = cut.groupBy(F.col(length_col).alias(n_of), F.col(own).alias(of)).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(n_of).orderBy(of).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = materialize(sizes.select(n_of, of, before.alias(rank)), "slices")
    nth = F.row_number().over(Window.partitionBy(length_col, own).orderBy(id_col, *order_cols)) - 1
    ranked = cut.withColumn(place, nth.cast("long")).join(sizes, (F.col(length_col) == F.col(n_of)) & (F.col(own) == F.col(of)))
    ranked = ranked.select(*map(quoted, pieces.columns), (F.col(place) + F.col(rank)).alias(rank))
    span = int(max(counts.values(), default=0)) + 1
    starts = (plan["length"] * span + plan["first"]).to_numpy()
    table = plan[["first", "per_bin", "sequence", "offset"]].to_numpy()

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        run = table[np.searchsorted(starts, length.to_numpy() * span + rank.to_numpy(), side="right") - 1]
        nth = rank.to_numpy() - run[:, 0]
        return pd.DataFrame({"sequence_id": run[:, 2] + nth // run[:, 1], "offset": run[:, 3] + nth % run[:, 1] * length.to_numpy()})

    return ranked.withColumn(at, placed(F.col(length_col).cast("long"), rank)).select(*map(quoted, pieces.columns), f"{at}.sequence_id", f"{at}.offset")
