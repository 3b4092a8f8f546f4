"""A classifier of languages: which of those that labelled texts teach a text is in, with confidences.

A profile is how often each run of one to four bytes of a language's letters is met, by hashed
bucket. Profiles are counted over all labelled texts, kept as a table, and small enough for every
task. A text may hold one passage of another language: where that is clearly likelier than one
language throughout, the passage is set aside, and what is around it is ranked. Of two parts, that
which goes on with a small letter after the other has ended is the text's own, else the longer one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.sources.scratch import materialize

#: Buckets of each length of runs; a model of L languages is 4 * L * BUCKETS numbers.
BUCKETS, LENGTHS = 1 << 14, 4
#: Languages that a model may have.
MOST_LANGUAGES = 512
#: Runs count as much together as so many that are independent; more runs of a text add nothing to the confidence.
EVIDENCE = 40
#: Bytes of a text taken at once when runs are counted.
PIECE = 1 << 20
#: Rows, and numbers, that a text's places come to at most; places of a longer text share rows.
PLACES, NUMBERS = 1 << 16, 1 << 22
#: What a passage of another language has to be likelier by: in all, and for each of its runs, so that of two parts the shorter is the passage.
QUOTING, QUOTED = 150.0, 0.02
#: What speaks for a passage after which a sentence goes on with a small letter, and against one that begins so.
RESUMED = 60.0
#: Places whose best languages are the ones that may quote or be quoted, and how many languages of a text may.
STRETCH, MOST_QUOTED = 32, 8
RANKING = "array<struct<language: string, confidence: double>>"


#: Small ASCII letters and all bytes beyond ASCII stay, the rest becomes a blank.
_PRIME = 2_147_483_647
_LETTERS = bytes(c if c > 127 or chr(c).islower() else c | 32 if chr(c).isupper() else 32 for c in range(256))


def _buckets(text: str | None, piece: int | None = None) -> Iterator[list[np.ndarray]]:
    """Piece by piece of the whole text, for each length of runs: the bucket of the run that begins at each place, -1 if none does; blanks of any number are one."""
    words = b" ".join((text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())
    if not words:
        return
    data, piece = b" " + words + b" ", piece or PIECE
    for start in range(0, len(data), piece):
        # a piece sees as much of the next one as a run that begins in it needs
        letters = np.frombuffer(data[start : start + piece + LENGTHS - 1], dtype=np.uint8).astype(np.int64)
        code, kept, found = np.zeros(len(letters), dtype=np.int64), letters != 32, []
        for n in range(LENGTHS):
            code = code[: len(letters) - n] * 257 + letters[n:]
            if n == 3:  # modulo 2 ** 31 - 1, which shorter runs don't reach
                code = (code & _PRIME) + (code >> 31)
                code[code >= _PRIME] -= _PRIME
            # a run has a letter, and no blank but at its ends
            inside = kept.copy() if n == 0 else kept[:-1] | kept[1:] if n == 1 else np.ones(len(code), dtype=bool)
            for at in range(1, n):
                inside &= kept[at : at + len(code)]
            found.append(np.where(inside, ((code * 2_654_435_761 & 4_294_967_295) >> 18) + n * BUCKETS, -1)[:piece])
        yield found


def runs(text: str | None) -> np.ndarray:
    """How often each bucket is met in the whole text, for each length of runs."""
    found = np.zeros(LENGTHS * BUCKETS, dtype=np.int64)
    for piece in _buckets(text):
        for n, met in enumerate(piece):
            found[n * BUCKETS : (n + 1) * BUCKETS] += np.bincount(met[met >= 0] - n * BUCKETS, minlength=BUCKETS)
    return found


_WORD, _SENTENCE_END = re.compile(r"(?:[A-Za-z]|[^\x00-\x7F])+"), re.compile(r"[.!?…]+\s+")


def _resumed(text: str, step: int, rows: int) -> np.ndarray:
    """The rows, and one more, in which a word with a small letter begins after the end of a sentence: it goes on with what was broken off before."""
    found, place, last = np.zeros(rows + 1, dtype=bool), 0, None
    for m in _WORD.finditer(text):
        if last is not None and text[m.start()].islower() and _SENTENCE_END.fullmatch(text, last, m.start()):
            found[min(rows, place // step)] = True
        place, last = place + 1 + len(m[0].lower().encode("utf-8", "surrogatepass")), m.end()
    return found


def _quoted(said: np.ndarray, met: np.ndarray, step: int, text: str = "") -> slice:
    """The rows of the passage of another language that makes the text likeliest; none if one language throughout does.

    For a text in one language, the passage is the stretch of rows that gains most by another.
    """
    leads, often = np.unique(np.add.reduceat(said, np.arange(0, len(said), max(1, STRETCH // step))).argmax(axis=1), return_counts=True)
    some = np.union1d(leads[np.argsort(-often, kind="stable")[:MOST_QUOTED]], said.sum(axis=0).argmax())
    found = slice(0, 0)
    if len(some) < 2:
        return found
    sums = np.vstack([np.zeros(len(some)), np.cumsum(said[:, some], axis=0)])
    cost = (QUOTED * np.concatenate([[0], np.cumsum(met)]) - RESUMED * _resumed(text, step, len(said)))[:, None]
    best = sums[-1].max()
    for own in range(len(some)):
        likelier = sums - sums[:, [own]]
        ahead = likelier - cost
        gain = ahead - np.minimum.accumulate(ahead, axis=0)
        end, other = np.unravel_index(gain.argmax(), gain.shape)
        start = ahead[: end + 1, other].argmin()
        score = sums[-1, own] + gain[end, other] - QUOTING
        # sentences that go on make no passage by themselves
        if score > best and likelier[end, other] - likelier[start, other] > QUOTING:
            best, found = score, slice(int(start), int(end))
    return found


@dataclass
class Profiles:
    """Languages in order of their names, and the logarithms of their buckets' shares, with a last row of zeros for places where no run begins."""

    languages: list[str]
    weights: np.ndarray

    def _said(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """What the runs that begin at the places of each row say for each language, how many they are, and a row's places."""
        # a power of two, so that every piece is whole rows
        most = 1 << (min(PLACES, NUMBERS // len(self.languages)).bit_length() - 1)
        said, met, step = np.zeros((0, len(self.languages))), np.zeros(0, dtype=np.int64), 1
        for piece in _buckets(text, most):
            here, many = np.zeros((len(piece[0]), len(self.languages))), np.zeros(len(piece[0]), dtype=np.int64)
            for found in piece:
                here[: len(found)] += self.weights[found]
                many[: len(found)] += found >= 0
            starts = np.arange(0, len(here), step)
            said, met = np.concatenate([said, np.add.reduceat(here, starts)]), np.concatenate([met, np.add.reduceat(many, starts)])
            while len(said) > most:
                starts, step = np.arange(0, len(said), 2), step * 2
                said, met = np.add.reduceat(said, starts), np.add.reduceat(met, starts)
        return said, met, step

    def ranked(self, text: str | None) -> list[tuple[str, float]]:
        """The languages with their confidences, best first, ties by name; nothing for a text without letters."""
        if not text or not self.languages:
            return []
        said, met, step = self._said(text)
        if not met.any():
            return []
        passage = _quoted(said, met, step, text)
        total, many = said.sum(axis=0) - said[passage].sum(axis=0), int(met.sum() - met[passage].sum())
        mean = total / many
        score = (mean - mean.max()) * min(many, EVIDENCE)
        share = np.exp(score) / np.exp(score).sum()
        order = sorted(range(len(share)), key=lambda k: (-share[k], self.languages[k]))
        return [(self.languages[k], float(share[k])) for k in order if share[k] > 0]

    def ranking(self) -> Callable[[Column], Column]:
        """From a column of texts one of ``RANKING``; equal texts of a batch are read once."""
        own = self

        @F.pandas_udf(RANKING)
        def run(texts: pd.Series) -> pd.Series:
            which, distinct = pd.factorize(texts)
            answers = [[{"language": c, "confidence": v} for c, v in own.ranked(t)] for t in distinct]
            return pd.Series([answers[w] if w >= 0 else [] for w in which], dtype=object)

        return run


def profile_table(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``language, bucket, n`` over all rows of ``docs`` with a language and a text; tables of several sources can be added up."""
    rows = docs.select(F.col(lang_col).cast("string").alias("language"), F.col(text_col).cast("string").alias("text")).where("language is not null and text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(batch.column("language").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if language not in held and len(held) >= MOST_LANGUAGES:
                    raise ValueError(f"more than {MOST_LANGUAGES} languages")
                held[language] = held.get(language, 0) + runs(text)
        for language, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(at)), pa.array(at, pa.int32()), pa.array(counts[at])], ["language", "bucket", "n"])

    counted = rows.mapInArrow(count, "language string, bucket int, n long")
    return counted.groupBy("language", "bucket").agg(F.sum("n").alias("n"))


def profiles(table: DataFrame, languages: list[str] | None = None) -> Profiles:
    """The model of a table of ``profile_table``, of all its languages or of those that are named; the table is made once."""
    table = materialize(table, "profiles")
    wanted = table if languages is None else table.where(F.col("language").isin(*languages))
    names = sorted(r[0] for r in wanted.select("language").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros((LENGTHS * BUCKETS, len(names)))
    found = wanted.toPandas()
    counts[found["bucket"], found["language"].map({n: k for k, n in enumerate(names)})] = found["n"]
    lengths = counts.reshape(LENGTHS, BUCKETS, len(names)) + 0.5
    shares = np.log(lengths / lengths.sum(axis=1, keepdims=True)).reshape(LENGTHS * BUCKETS, len(names))
    return Profiles(names, np.vstack([shares, np.zeros(len(names))]))
