"""Quality by nearest labelled neighbours in a latent-semantic space.

A text's terms are its words and their shapes, in hashed TF-IDF weights; a singular value
decomposition of the labelled sample gives latent directions. The sample's latent vectors go to
all tasks as one bounded array, every document's exact cosines to all of them come from blocked
matrix products, and the nearest neighbours' labels vote by similarity.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.common import materialize, sample_order, text_batches

#: Bounds of the fit: labelled texts, and different terms in all of them together.
MAX_EXAMPLES, MAX_ENTRIES = 4_000, 8_000_000
#: Hashed terms, latent directions, neighbours.
BUCKETS, DIRECTIONS, NEIGHBOURS = 1 << 16, 64, 25
#: Documents whose cosines are computed at once; labelled vectors a block; shapes that a task remembers.
QUERIES, BLOCK, SHAPES = 256, 1_000, 20_000
#: The share of labels in the sample counts as a neighbour of this similarity.
PRIOR = 0.5
THRESHOLD = 0.5
SEED = "quality-1"
#: What may stand behind a plain word.
_MARKS = ".,;:!?)]}%$&*#|\"'"
_LETTERS = re.compile(r"[\W\d_]+")
_RUNS = re.compile(r"(.)\1+", re.DOTALL)


def shape(word: str) -> str:
    """The kinds of the first 64 characters, runs as one: ``Berlin!!`` gives ``Aa!``."""
    return _RUNS.sub(r"\1", "".join("0" if c.isdecimal() else "A" if c.isupper() else "a" if c.isalpha() else c for c in word[:64]))


def terms_of(word: str) -> tuple[str, str]:
    """A word's letters in lower case, and its ``shape`` or, for a plain word with marks behind it, that with the marks' runs in full."""
    core = word if word.isalpha() else word.rstrip(_MARKS)
    if not core.isalpha():
        return _LETTERS.sub("", word.lower()), shape(word)
    kind = "a" if core.islower() else "A" if core.isupper() else "Aa" if core[0].isupper() and core[1:].islower() else shape(core)
    return core.lower(), kind + word[len(core) : len(core) + 64]


def bucket(term: str) -> int:
    return crc32(term.encode("utf-8", "surrogatepass")) % BUCKETS


#: The terms of words that are the same as the one before, each from a share of such words on.
REPEATS = [(share, bucket(f"r {share}")) for share in (0.0, 0.25, 0.5, 0.75)]


class Shapes(dict):
    """Buckets of the shapes met so far."""

    def __missing__(self, kind: str) -> int:
        if len(self) >= SHAPES:
            self.clear()
        self[kind] = found = bucket("s " + _RUNS.sub(r"\1", kind))
        return found


def counts(text: str | None, shapes: Shapes) -> tuple[np.ndarray, np.ndarray]:
    """The whole text's buckets, and how often each is there. Words are often met once only, so they aren't remembered."""
    words = (text or "").split()
    found, kinds = {}, {}
    for word, n in Counter(words).items():
        letters, kind = terms_of(word)
        if letters:
            at = bucket(letters)
            found[at] = found.get(at, 0) + n
        kinds[kind] = kinds.get(kind, 0) + n
    for kind, n in kinds.items():
        at = shapes[kind]
        found[at] = found.get(at, 0) + n
    repeats = sum(map(eq, words, words[1:]))
    for share, at in REPEATS:
        if repeats > share * len(words):
            found[at] = found.get(at, 0) + repeats
    return np.fromiter(found, dtype=np.int64, count=len(found)), np.fromiter(found.values(), dtype=np.float64, count=len(found))


@dataclass
class Model:
    """What tasks need; its size is bounded by the parameters of the fit."""

    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    rate: float

    def latent(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The unit latent vector of a text's buckets; zero if there is none."""
        return unit(weights(at, n, self.idf) @ self.directions[at])

    def score(self, rows: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
        """For each latent row the share of label 1 among its ``k`` nearest, by similarity.

        Exact cosines, one block of labelled vectors after the other; ties go to the first
        ones. Rows of zeros, and rows with no similar neighbour, get the share of all labels.
        """
        best, who = np.full((len(rows), 0), 0.0), np.zeros((len(rows), 0), dtype=np.int64)
        for start in range(0, len(self.vectors), BLOCK):
            block = np.round(rows @ self.vectors[start : start + BLOCK].T, 9)
            best, who = np.hstack([best, block]), np.hstack([who, np.broadcast_to(np.arange(start, start + block.shape[1]), block.shape)])
            if best.shape[1] > k:
                # the k-th value splits; those equal to it are taken in order
                least = np.partition(best, -k, axis=1)[:, -k][:, None]
                rank = np.where(best > least, 0, np.where(best == least, 1, 2))
                at = np.argsort(rank, axis=1, kind="stable")[:, :k]
                at.sort(axis=1)
                best, who = np.take_along_axis(best, at, 1), np.take_along_axis(who, at, 1)
        vote = np.maximum(best, 0.0)
        return ((vote * self.labels[who]).sum(axis=1) + PRIOR * self.rate) / (vote.sum(axis=1) + PRIOR)


def unit(v: np.ndarray) -> np.ndarray:
    size = np.sqrt((v * v).sum(axis=-1, keepdims=True))
    return v / np.where(size > 1e-12, size, np.inf)


def weights(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit((1 + np.log(n)) * idf[at])


def singular_directions(rows: list[tuple[np.ndarray, np.ndarray]], width: int, many: int) -> np.ndarray:
    """The first right singular vectors of sparse rows, by subspace iteration from fixed random ones."""
    random = np.random.default_rng(1).standard_normal((width, min(many + 16, max(1, len(rows)))))
    for _ in range(4):
        left = np.linalg.qr(np.stack([w @ random[at] for at, w in rows]))[0]
        random = np.zeros((width, left.shape[1]))
        for (at, w), own in zip(rows, left, strict=True):
            random[at] += w[:, None] * own
    values, vectors = np.linalg.eigh(random.T @ random)
    order = np.argsort(-values)[:many]
    order = order[values[order] > 1e-9]
    return random @ vectors[:, order] / np.sqrt(values[order])


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """How many rows there are and how many of them have each bucket; whole texts of all rows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes, rows, found = Shapes(), 0, np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            rows += len(batch)
            for text in batch["text"]:
                found[counts(text, shapes)[0]] += 1
        at = np.flatnonzero(found)
        yield pd.DataFrame({"bucket": [-1, *at], "n": [rows, *found[at]]})

    text = docs.select(F.col(text_col).cast("string").alias("text"))
    found = text.mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(BUCKETS + 1, dtype=np.int64)
    df[found["bucket"]] = found["n"]
    return int(df[-1]), df[:-1]


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_examples: int = MAX_EXAMPLES, max_entries: int = MAX_ENTRIES) -> Model:
    """Learn from at most ``max_examples`` labelled texts with ``max_entries`` terms together.

    The examples come in the order of a hash of their ids; document frequencies are over all rows
    of ``docs``. Labels that are null or other than 0 and 1, and labels of ids that are null or
    have no text, aren't used; an id with several labels or texts is an example for each. Without
    examples every text scores 0.5.
    """
    own = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).where("_id is not null and label in (0, 1)")
    own = own.withColumn("draw", sample_order("_id", SEED)).orderBy("draw", "_id", "label").limit(max_examples)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    rows = texts.join(materialize(own, "quality-labels"), "_id")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes = Shapes()
        for batch in batches:
            found = [counts(text, shapes) for text in batch["text"]]
            packed = [at.astype("<u2").tobytes() + n.astype("<u4").tobytes() for at, n in found]
            yield pd.DataFrame({"draw": batch["draw"], "label": batch["label"], "vector": packed, "entries": [len(at) for at, _ in found]})

    examples = materialize(rows.select("draw", "label", "text").mapInPandas(count, "draw double, label int, vector binary, entries int"), "quality-examples")
    sizes = [tuple(r) for r in examples.select("draw", "entries").orderBy("draw", "entries").limit(max_examples).collect()]
    total, last = 0, -1.0
    for draw, entries in sizes:
        total += entries
        if total > max_entries:
            break
        last = draw
    found = examples.where(F.col("draw") <= last).orderBy("draw", "label", "vector").limit(max_examples).select("label", "vector").collect()
    n_docs, df = document_frequencies(docs, text_col)
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    vectors = []
    for r in found:
        m = len(r["vector"]) // 6
        at, n = np.frombuffer(r["vector"], "<u2", m).astype(np.int64), np.frombuffer(r["vector"], "<u4", m, 2 * m)
        vectors.append((at, weights(at, n.astype(np.float64), idf)))
    y = np.array([r["label"] for r in found], dtype=np.float64)
    if not len(y):
        return Model(idf, np.zeros((BUCKETS, 1), dtype=np.float32), np.zeros((0, 1)), y, 0.5)
    directions = singular_directions(vectors, BUCKETS, DIRECTIONS).astype(np.float32)
    latent = unit(np.stack([w @ directions[at] for at, w in vectors]))
    return Model(idf, directions, latent, y, float(y.mean()))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``id_col, score, predicted`` for every row; the whole text is read.

    Null and empty texts, and texts none of whose terms has a part in the latent directions, get
    the share of label 1 in the sample. Repeated rows are answered as often as they come, an empty
    table gives no rows, and other columns are not looked at.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes, known = Shapes(), shipped.value
        for batch in batches:
            for start in range(0, len(batch), QUERIES):
                part = batch.iloc[start : start + QUERIES]
                found = known.score(np.stack([known.latent(*counts(text, shapes)) for text in part["text"]]))
                yield pd.DataFrame({"id": part["id"], "score": found, "predicted": (found >= threshold).astype(np.int32)})

    kind = docs.schema[id_col].dataType.simpleString()
    return text_batches(docs, id_col, text_col).mapInPandas(run, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)
