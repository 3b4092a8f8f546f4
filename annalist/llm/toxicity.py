"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Texts become TF-IDF vectors over all terms of the labelled examples; terms that tell the labels
apart weigh more, none is left out. All examples are in an inverted index whose common terms are
blocks with known peaks; a text's nearest ones are found exactly, and their votes, weighted by
distance, give its score, calibrated on the examples themselves.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm.common import materialize, sample_order, shards_for, text_batches

#: Bound of the fit: labelled examples.
MAX_EXAMPLES = 4_000
#: A term whose chi-squared value reaches this, and that is commoner in toxic examples, weighs
#: the root of that value more.
MIN_CHI2 = 25.0
NEIGHBOURS = 15
BLOCK = 64
#: So many of the commonest terms are kept as dense blocks; queries answered side by side; blocks opened first for each.
COMMON = 1024
QUERIES = 128
FIRST_BLOCKS = 4
#: Above the error of a dot product of unit vectors in single precision.
SLACK = 1e-5
#: So many different words a task remembers the terms of.
WORDS = 200_000
STEMS = (4, 5)
THRESHOLD = 0.3
SEED = "tox-1"
_WORD = re.compile(r"[^\W\d_]+")


def _terms_of(word: str) -> list[str]:
    return [word, *(f"{word[:size]}-" for size in STEMS if len(word) > size)]


def terms(text: str | None) -> Counter:
    """How often each term is in a text: lower-case words, and their first 4 and 5 letters."""
    found = Counter()
    for word, n in Counter(_WORD.findall((text or "").lower())).items():
        for term in _terms_of(word):
            found[term] += n
    return found


class Vocabulary(dict):
    """Term numbers of the words met so far; a term's number is the place of its code in ``ids``."""

    def __init__(self, ids: np.ndarray):
        super().__init__()
        self.ids = ids

    def __reduce__(self):
        return Vocabulary, (self.ids,)

    @cached_property
    def number(self) -> dict[int, int]:
        return dict(zip(self.ids.tolist(), range(len(self.ids)), strict=True))

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= WORDS:
            self.clear()
        self[word] = numbers = tuple(self.number[c] for c in map(code, _terms_of(word)) if c in self.number)
        return numbers


def code(term: str) -> int:
    """A term as 64 bits of a hash, which bounds what the driver and the tasks hold of it."""
    return int.from_bytes(hashlib.blake2b(term.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


@dataclass
class Examples:
    """Inverted index over distinct example vectors, bounded by the number of examples.

    Only the vectors are shipped; postings and blocks are made where they are first used.
    Entry ``e`` is in block ``e // BLOCK``. The postings of term t, in the order of entries, are
    those from ``starts[t, 0]`` to ``starts[t, 1]``. ``idf`` holds the terms' weights: inverse
    document frequency times ``gains``.
    """

    idf: np.ndarray
    vectors: list[bytes]
    votes: np.ndarray
    toxic: np.ndarray
    example: list[int | None]
    none_rate: float
    rate: float

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k in Examples.__dataclass_fields__}

    @cached_property
    def place(self) -> dict[bytes, int]:
        return {v: e for e, v in enumerate(self.vectors)}

    @cached_property
    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``entries``, ``weights`` and ``starts``."""
        terms, weights, often = [np.array([], dtype=np.int32)], [np.array([], dtype=np.float32)], np.zeros(len(self.idf), dtype=np.int64)
        for vector in self.vectors:
            at, weight = self.query(vector)
            terms.append(at.astype(np.int32))
            weights.append(weight.astype(np.float32))
            often[at] += 1
        number = np.repeat(np.arange(len(self.vectors), dtype=np.int32), [len(at) for at in terms[1:]])
        by_term = np.argsort(np.concatenate(terms), kind="stable")
        ends = np.cumsum(often)
        return number[by_term], np.concatenate(weights)[by_term], np.stack([ends - often, ends], axis=1)

    entries = property(lambda self: self.postings[0])
    weights = property(lambda self: self.postings[1])
    starts = property(lambda self: self.postings[2])

    @cached_property
    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each term's row among the common ones or -1; their weights by block, row and entry; peaks by row and block.

        The largest weight of a term in a block bounds its part of every dot product there.
        """
        common = np.argsort(self.starts[:, 0] - self.starts[:, 1], kind="stable")[:COMMON]
        row = np.full(len(self.idf), -1)
        row[common] = np.arange(len(common))
        dense = np.zeros((-(-len(self.votes) // BLOCK), len(common), BLOCK), dtype=np.float32)
        for r, t in enumerate(common):
            own = slice(self.starts[t, 0], self.starts[t, 1])
            dense[self.entries[own] // BLOCK, r, self.entries[own] % BLOCK] = self.weights[own]
        return row, dense, np.ascontiguousarray(dense.max(axis=2).T)

    def query(self, vector: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and unit weights of a vector; empty if there are none."""
        at, counts = unpack(vector)
        weight = (1 + np.log(counts)) * self.idf[at]
        return at, weight / np.sqrt((weight**2).sum()) if len(at) else weight

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the exact ``k`` entries of largest cosine (ties: the first entries), and the cosines.

        Postings of the other terms are all added up. For the common terms, the blocks of the
        largest bounds are opened first, then all whose bound reaches the k-th best so far. A
        query is its term numbers and weights.
        """
        return [found for n in range(0, len(queries), QUERIES) for found in self._nearest(queries[n : n + QUERIES], k)]

    def _nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        row, dense, peaks = self.parts
        entries, weights, starts = self.postings
        blocks, size, number = len(dense), len(dense) * BLOCK, np.arange(len(queries))
        own, rare = np.zeros((len(queries), len(peaks))), np.zeros((len(queries), size))
        for q, (at, weight) in enumerate(queries):
            common = row[at] >= 0
            own[q, row[at[common]]] = weight[common]
            first = starts[at[~common], 0]
            n = starts[at[~common], 1] - first
            where = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
            rare[q] = np.bincount(entries[where], np.repeat(weight[~common], n) * weights[where], size)
        single, by_block = own.astype(np.float32), rare.reshape(len(queries), blocks, BLOCK)
        bounds = single @ peaks + by_block.max(axis=2) + SLACK
        dots = np.full((len(queries), blocks, BLOCK), -1, dtype=np.float32)

        def open_(which: np.ndarray) -> None:
            for b in np.flatnonzero(which.any(axis=0)):
                of = np.flatnonzero(which[:, b])
                dots[of, b] = single[of] @ dense[b] + by_block[of, b]

        first = np.argsort(-bounds, axis=1, kind="stable")[:, :FIRST_BLOCKS]
        opened = np.zeros(bounds.shape, dtype=bool)
        np.put_along_axis(opened, first, True, axis=1)
        open_(opened)
        least = _kth(dots[number[:, None], first].reshape(len(queries), -1), k) - SLACK
        open_(~opened & (bounds >= least[:, None]))
        dots = dots.reshape(len(queries), size)
        least = _kth(dots, k) - SLACK
        found = []
        for q in number:
            near = np.flatnonzero((dots[q] > 0) & (dots[q] >= least[q]))
            cosine = rare[q, near] + dense[near // BLOCK, :, near % BLOCK].astype(np.float64) @ own[q]
            order = np.lexsort((near, -np.round(cosine, 12)))[:k]
            found.append((near[order], cosine[order]))
        return found

    def vote(self, near: np.ndarray, cosines: np.ndarray, votes: np.ndarray, toxic: np.ndarray) -> float:
        """The toxic share of the nearest examples' votes.

        An entry's vote weighs 1 / (distance + 0.05) and the root of its examples; the share
        of labels among all examples counts as one more example at distance 1.
        """
        vote = np.sqrt(votes) / (1 - np.minimum(cosines, 1) + 0.05)
        return (float((vote * toxic).sum()) + self.rate / 1.05) / (float(vote.sum()) + 1 / 1.05)

    def score_vectors(self, vectors: list[bytes], knots: tuple[np.ndarray, np.ndarray]) -> list[tuple[float, list[tuple[int | None, float, float]]]]:
        """For each vector the score and the nearest examples as (example id, cosine, toxic share); ``knots`` map votes to scores."""
        scored: list = [(self.none_rate, [])] * len(vectors)
        known = [n for n, v in enumerate(vectors) if v and len(self.votes)]
        for a in range(0, len(known), QUERIES):
            part = known[a : a + QUERIES]
            for n, (near, cosines) in zip(part, self.nearest([self.query(vectors[n]) for n in part]), strict=True):
                score = float(np.interp(self.vote(near, cosines, self.votes[near], self.toxic[near]), *knots))
                scored[n] = score, [(self.example[e], float(c), float(self.toxic[e])) for e, c in zip(near[:3], cosines[:3], strict=True)]
        return scored

    def votes_without(self, vectors: list[bytes], labels: list[int]) -> list[float]:
        """For each entry's vector the share of votes that one of its examples, with this label, gets from all others."""
        out = []
        found = self.nearest([self.query(v) for v in vectors], NEIGHBOURS + 1)
        for vector, label, (near, cosines) in zip(vectors, labels, found, strict=True):
            votes, toxic = self.votes[near], self.toxic[near]
            mine = near == self.place[vector]
            left = votes[mine] - 1
            toxic[mine] = (toxic[mine] * votes[mine] - label) / np.maximum(1, left)
            votes[mine] = left
            kept = np.flatnonzero(votes > 0)[:NEIGHBOURS]
            out.append(self.vote(near[kept], cosines[kept], votes[kept], toxic[kept]))
        return out


class Index(Examples):
    """Examples with their vocabulary and calibration; tasks get the examples once, as a broadcast."""

    def __init__(self, spark: SparkSession, ids: np.ndarray, examples: Examples):
        super().__init__(**examples.__getstate__())
        self.ids, self.knots, self.shipped = ids, (np.array([0.0, 1.0]), np.array([0.0, 1.0])), spark.sparkContext.broadcast(examples)


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; -1 if there are fewer."""
    return np.partition(values, -k, axis=1)[:, -k] if values.shape[1] >= k else np.full(len(values), -1.0)


def calibration(votes: np.ndarray, labels: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step function nearest to the labels (pooled neighbours), joined by straight lines."""
    pools: list[list[float]] = []
    for v, label, many in sorted(zip(votes.tolist(), labels.tolist(), n.tolist(), strict=True)):
        pools.append([label * many, many, v, v])
        while len(pools) > 1 and (pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][3] == pools[-1][2]):
            more = pools.pop()
            pools[-1] = [pools[-1][0] + more[0], pools[-1][1] + more[1], pools[-1][2], more[3]]
    return np.array([x for p in pools for x in p[2:]]), np.array([p[0] / p[1] for p in pools for _ in (0, 1)])


def pack(at: np.ndarray, counts: np.ndarray) -> bytes:
    """Term numbers and counts as bytes, counts of 1 left away; lower and higher bytes stand apart, which compresses."""
    if not len(at):
        return b""
    more = counts > 1
    return np.concatenate([[more.sum()], at[more], counts[more], at[~more]]).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(vector: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and counts of ``pack``."""
    if not vector:
        return np.array([], dtype=np.int64), np.array([])
    found = np.ascontiguousarray(np.frombuffer(vector, dtype=np.uint8).reshape(4, -1).T).view("<u4")[:, 0].astype(np.int64)
    more = found[0]
    counts = np.ones(len(found) - 1 - more)
    counts[:more] = found[1 + more : 1 + 2 * more]
    return np.concatenate([found[1 : 1 + more], found[1 + 2 * more :]]), counts


def _term_counts(rows: DataFrame) -> DataFrame:
    """``term, n1, n0``: how many toxic and other examples have the term."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            by_label = (Counter(), Counter())
            for text, label in zip(batch["text"], batch["label"], strict=True):
                by_label[int(label)].update(terms(text).keys())
            for label, counts in enumerate(by_label):
                yield pd.DataFrame({"term": [code(t) for t in counts], "n": list(counts.values())}).assign(label=label)

    counted = rows.select("text", "label").mapInPandas(count, "term long, n long, label int")
    return counted.groupBy("term").agg(F.sum(F.expr("if(label = 1, n, 0)")).alias("n1"), F.sum(F.expr("if(label = 0, n, 0)")).alias("n0"))


def vectorize(docs: DataFrame, ids: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, vector`` of every row: how often each known term is in the whole text (see ``pack``).

    ``vector`` is empty if the text is null or has no known term.
    """

    shipped = docs.sparkSession.sparkContext.broadcast(Vocabulary(ids))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers_of = shipped.value.__getitem__
        for batch in batches:
            words = (_WORD.findall((text or "").lower()) for text in batch["text"])
            found = (np.fromiter(chain.from_iterable(map(numbers_of, own)), dtype=np.int64) for own in words)
            yield pd.DataFrame({"id": batch["id"], "vector": [pack(*np.unique(own, return_counts=True)) for own in found]})

    kind = docs.schema[id_col].dataType.simpleString()
    return text_batches(docs, id_col, text_col).mapInPandas(run, f"id {kind}, vector binary")


def document_frequencies(vectors: DataFrame, n_terms: int) -> tuple[int, np.ndarray]:
    """How many rows there are, and how many have each term."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, found = 0, np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            rows += len(batch)
            for vector in batch["vector"]:
                found[unpack(vector)[0]] += 1
        at = np.flatnonzero(found)
        yield pd.DataFrame({"term": [-1, *at], "n": [rows, *found[at]]})

    found = vectors.select("vector").mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(n_terms + 1, dtype=np.int64)
    df[found["term"]] = found["n"]
    return int(df[-1]), df[:-1]


def gains(n1: np.ndarray, n0: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """How much more each term weighs that ``n1`` of the toxic and ``n0`` of the clean examples have; 1 at least."""
    both, total = n1 + n0, float(toxic + clean)
    chi2 = total * (n1 * (clean - n0) - n0 * (toxic - n1)) ** 2 / np.maximum(1.0, both * (total - both) * max(1.0, toxic) * max(1.0, clean))
    return np.where((chi2 >= MIN_CHI2) & (n1 * clean > n0 * toxic), np.sqrt(chi2), 1.0)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_examples: int = MAX_EXAMPLES) -> Index:
    """Index about ``max_examples`` labelled texts; see ``fit_and_vectorize``."""
    return fit_and_vectorize(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, max_examples=max_examples)[0]


def fit_and_vectorize(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_examples: int = MAX_EXAMPLES) -> tuple[Index, DataFrame]:
    """Index about ``max_examples`` labelled texts, all or the share that a hash of the id draws.

    The terms are all of these examples; their document frequencies are over all of ``docs``,
    whose vectors come back as a table beside the index, so that texts are read once. The
    driver gets the examples' vectors, not their texts; equal vectors are one entry that counts
    its examples. Scores are calibrated by what each example gets from all others.
    Labels that are null, or other than 0 and 1, and labels of ids that are null or have no
    text, aren't used; an id with several labels or texts is an example for each.
    """
    own = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).where("_id is not null and label in (0, 1)")
    own = own.withColumn("draw", sample_order("_id", SEED))
    n = max(1, own.count())
    drawn = own.where(F.col("draw") < min(2.0, max_examples * 1.0 / n))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(drawn, F.col("id") == F.col("_id")).where("text is not null")
    rows = materialize(rows.select("id", "text", "label"), "examples")
    totals = {int(r["label"]): int(r["n"]) for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    counted = _term_counts(rows).toPandas().sort_values("term")
    ids = counted["term"].to_numpy()
    gain = gains(counted["n1"].to_numpy(dtype=np.float64), counted["n0"].to_numpy(dtype=np.float64), n1, n0)
    del counted
    vectors = materialize(vectorize(docs, ids, id_col=id_col, text_col=text_col), "toxic-vectors")
    n_docs, df = document_frequencies(vectors, len(ids))
    own = vectorize(rows.select(F.struct("id", "label").alias("of"), "text"), ids, id_col="of")
    grouped = own.groupBy("vector").agg(F.count(F.lit(1)).alias("n"), F.sum("id.label").alias("n1"), F.min("id.id").alias("id"))
    grouped = materialize(grouped.repartition(shards_for(n1 + n0, 500, docs.sparkSession)), "entries")
    entries = grouped.toPandas().sort_values("vector")
    none, rate = entries[entries["vector"] == b""], n1 / max(1, n1 + n0)
    none_rate = float((none["n1"].sum() + rate) / (none["n"].sum() + 1))
    examples = build((np.log((1 + n_docs) / (1 + df)) + 1) * gain, entries[entries["vector"] != b""], none_rate, rate)
    del entries, none
    index = Index(docs.sparkSession, ids, examples)
    calibrate(index, grouped)
    return index, vectors


def build(idf: np.ndarray, entries: pd.DataFrame, none_rate: float, rate: float) -> Examples:
    """The index of ``entries``: columns ``vector`` (see ``pack``), ``n``, ``n1``, ``id``."""
    often = np.zeros(len(idf), dtype=np.int64)
    for vector in entries["vector"]:
        often[unpack(vector)[0]] += 1
    # entries with the same leading term, of those that many have, stand together, which makes the blocks' bounds tight
    shared, leads = idf * (often >= 0.02 * len(entries)), []
    for vector in entries["vector"]:
        at, counts = unpack(vector)
        leads.append(int(at[((1 + np.log(counts)) * shared[at]).argmax()]))
    entries = entries.iloc[np.argsort(np.array(leads, dtype=np.int64), kind="stable")]
    votes = entries["n"].to_numpy(dtype=np.float64)
    return Examples(idf, list(entries["vector"]), votes, entries["n1"].to_numpy(dtype=np.float64) / votes, [None if pd.isna(i) else i for i in entries["id"]], none_rate, rate)


def calibrate(index: Index, entries: DataFrame) -> None:
    """Calibrate the index's scores: what each example gets from all others, against its label."""
    shipped = index.shipped

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            each = [(v, label, m) for v, n, n1 in zip(batch["vector"], batch["n"], batch["n1"], strict=True) for label, m in ((1, n1), (0, n - n1)) if v and m]
            vectors, labels, many = ([row[c] for row in each] for c in range(3))
            yield pd.DataFrame({"vote": shipped.value.votes_without(vectors, labels), "label": labels, "n": many})

    found = entries.mapInPandas(run, "vote double, label int, n long").toPandas()
    if len(found):
        index.knots = calibration(found["vote"], found["label"], found["n"])


def score(docs: DataFrame, index: Index, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``id_col, score, predicted, evidence`` for every row; the whole text is read.

    ``evidence`` holds the nearest examples: id, cosine, and the toxic share of the examples
    with that vector. Null and empty texts, and texts without any term of an example, get
    the share of toxic examples among such texts, and no evidence. Repeated rows are answered as often as
    they come, an empty table gives no rows, and other columns are not looked at.
    """

    return score_vectors(vectorize(docs, index.ids, id_col=id_col, text_col=text_col), index, threshold=threshold).withColumnRenamed("id", id_col)


def score_vectors(vectors: DataFrame, index: Index, *, threshold: float = THRESHOLD) -> DataFrame:
    """``id, score, predicted, evidence`` for every row of ``vectorize``; equal vectors of a batch are looked up once."""

    shipped, knots = index.shipped, index.knots

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            which, distinct = pd.factorize(batch["vector"])
            found = shipped.value.score_vectors(list(distinct), knots)
            scores = np.array([s for s, _ in found], dtype=np.float64)[which]
            evidence = [[{"id": None if e is None else str(e), "cosine": c, "toxic": t} for e, c, t in near] for _, near in found]
            yield pd.DataFrame({"id": batch["id"], "score": scores, "predicted": (scores >= threshold).astype(np.int32), "evidence": [evidence[w] for w in which]})

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInPandas(run, f"id {kind}, score double, predicted int, evidence array<struct<id: string, cosine: double, toxic: double>>")
