"""SimHash near-duplicates through a byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.llm.common import fresh, materialize, quoted, shards_for
from annalist.llm.components import connected_components, star_edges

#: Any two of 64 bits that differ in at most 3 share at least 5 of their 8 positional bytes.
MAX_BITS = 3
MIN_BYTES = 8 - MAX_BITS
#: Byte positions that are indexed together. Five positions of eight always hold three of one
#: half, so fingerprints that share five positional bytes share a posting.
TRIPLES = [t for half in (0, 4) for t in ((half, half + 1, half + 2), (half, half + 1, half + 3), (half, half + 2, half + 3), (half + 1, half + 2, half + 3))]
SHINGLE = 3
SEED = 42
#: A posting list longer than this is divided by two more positional bytes.
LONG_LIST = 4096
ROWS_PER_SHARD = 60_000


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a whole text, as an unsigned number."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    n = max(1, len(words) - shingle + 1)
    ends = (starts + lengths)[min(shingle, len(words)) - 1 :]
    h, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65536):
        part = zip(starts[at : min(n, at + 65536)].tolist(), ends[at : at + 65536].tolist(), strict=False)
        hashes = np.array([h(joined[a:b], seed) for a, b in part], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``id_col``, ``fp``, the 64-bit fingerprint as a signed long, and ``same``, a hash of the text, of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in batch["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"id": batch["id"], "fp": fps, "same": batch["same"]})

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("same", F.xxhash64("text"))
    return read.mapInPandas(run, f"id {kind}, fp long, same long").withColumnRenamed("id", id_col)


def _byte(position: int) -> Column:
    return F.shiftrightunsigned("fp", 56 - 8 * position).bitwiseAND(F.lit(255))


def postings(distinct: DataFrame) -> DataFrame:
    """The inverted index: rows ``key, fp, node`` for each triple of positional bytes.

    Long lists are divided: fingerprints that share three positional bytes and at least five
    in all share two of the other five positions, so the list is dealt by those pairs too.
    """
    keys = [F.concat_ws(":", F.lit(str(i)), *map(_byte, t)) for i, t in enumerate(TRIPLES)]
    rows = distinct.select("fp", "node", F.posexplode(F.array(*keys)).alias("triple", "key"))
    long_lists = rows.groupBy("key").count().where(F.col("count") > LONG_LIST).select("key")
    long_lists = materialize(long_lists, "long-lists")
    if long_lists.isEmpty():
        return rows.select("key", "fp", "node")
    short = rows.join(long_lists, "key", "left_anti").select("key", "fp", "node")
    pairs = [(i, a, b) for i, t in enumerate(TRIPLES) for a, b in combinations([p for p in range(8) if p not in t], 2)]
    divided = F.array(*[F.when(F.col("triple") == i, F.concat_ws(":", "key", F.lit(f"{a}-{b}"), _byte(a), _byte(b))) for i, a, b in pairs])
    divided = rows.join(long_lists, "key", "left_semi").select(F.explode(F.array_compact(divided)).alias("key"), "fp", "node")
    return short.union(divided)


def linked_pairs(keys: np.ndarray, fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs with the same key whose fingerprints differ in at most ``max_bits``.

    Both inputs are sorted by key. A pair is first held against the count of positional bytes
    that it must share, and then verified on all bits.
    """
    left, right = [], []
    at = np.arange(len(keys))
    for step in range(1, len(keys)):
        at = at[: np.searchsorted(at, len(keys) - step)]
        at = at[keys[at] == keys[at + step]]
        if not len(at):
            break
        differ = fps[at] ^ fps[at + step]
        shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = (shared >= 8 - max_bits) & (np.bitwise_count(differ) <= max_bits)
        left.append(at[near])
        right.append(at[near] + step)
    return (np.concatenate(left), np.concatenate(right)) if left else (at[:0], at[:0])


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fp, component_id`` for every row of ``docs``.

    Fingerprints that differ in at most three bits are linked; ``component_id`` is the
    smallest id reachable by links, the row's own included. Documents with one fingerprint
    are one node, so copies cost nothing however many there are. Each shard of the index sends
    on a spanning set of its links.

    A text without words (null, empty, white space) has fingerprint zero and is linked like
    any other. Ids must be integers; a row whose id is null gets its group's component, or
    null if no row of the group has an id. Repeated rows are returned as often as they come.
    An empty table gives no rows. Extra columns are ignored.
    """
    return _grouped(docs, id_col, text_col).select(id_col, "fp", "component_id")


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col, fp, same, class, component_id`` of every row; ``class`` is a group's number, also where no row has an id."""
    fps = materialize(fingerprints(docs, id_col=id_col, text_col=text_col), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min(F.col(id_col).cast("long")).alias("least")).withColumn("node", F.col("fp")), "distinct")
    index = postings(distinct)
    shards = shards_for(8 * distinct.count(), ROWS_PER_SHARD, docs.sparkSession)

    def links(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["key", "fp"])
        fp, nodes = np.unique(shard["fp"].to_numpy(), return_inverse=True)
        keys = pd.factorize(shard["key"])[0]
        i, j = linked_pairs(keys, shard["fp"].to_numpy().view(np.uint64))
        node, root = star_edges(nodes[i], nodes[j], len(fp))
        return pd.DataFrame({"a": fp[node], "b": fp[root]})

    edges = index.select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "key", "fp").groupBy("shard").applyInPandas(links, "a long, b long")
    found = connected_components(edges).withColumnRenamed("node", "fp")
    classes = distinct.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("class"))
    classes = materialize(classes, "classes")
    least = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    return fps.join(classes.join(least, "class").select("fp", "class", "component_id"), "fp", "left").select(id_col, "fp", "same", "class", "component_id")


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Of rows that repeat that id, one stays; of a group without ids, the row whose text has
    the smallest hash. Columns are those of ``docs``.
    """
    found = _grouped(docs, id_col, text_col)
    rows = found.groupBy("class", id_col, "same").agg(F.count(F.lit(1)).alias("rows"))
    first = rows.groupBy("class").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "same", "rows")).alias("f"))
    of, text_hash, repeats, row = fresh(docs.columns, "stay", "text_hash", "repeats", "row")
    first = materialize(first.select(F.col("f.id").alias(of), F.col("f.same").alias(text_hash), F.col("f.rows").alias(repeats)), "first")
    hashed = F.xxhash64(quoted(text_col).cast("string"))
    chosen = lambda some: quoted(id_col).eqNullSafe(some[of]) & (hashed == some[text_hash])
    once, several = first.where(F.col(repeats) == 1), first.where(F.col(repeats) > 1)
    kept = docs.join(once, chosen(once), "left_semi")
    if several.isEmpty():
        return kept
    # few rows: only those that repeat a kept id and text meet here, one from each task
    again = docs.join(several, chosen(several)).groupBy(of, text_hash).agg(F.first(F.struct(*map(quoted, docs.columns))).alias(row))
    return kept.union(again.select(*[F.col(f"{row}.`{c}`").alias(c) for c in docs.columns]))
