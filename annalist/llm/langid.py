"""Language identification with blended-spectrum string kernels.

The kernel of two texts counts the character n-grams (1 to 3 characters) that are present in
both, divided by the geometric mean of their counts. Nyström landmarks turn it into features,
one-versus-rest kernel ridge regression is fitted on them, and batches of texts are scored by
matrix products.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.common import materialize, sample_order, text_batches

#: Bounds of the fit: labelled texts of each language, and how many of those are landmarks.
TEXTS_PER_LANGUAGE = 400
LANDMARKS_PER_LANGUAGE = 60
RIDGE = 1e-2
UNDETERMINED = "und"
#: A text is foreign to every learned language if even the best one scores less than this, or if
#: less of its n-grams is known than in this share of the least known text of the fit.
MIN_SCORE = 0.3
KNOWN_SHARE = 0.8
BATCH = 128
SEED = "lang-1"
#: Characters that count as alphanumeric but are no letters and no decimal digits, such as ½ and ².
#: Those of the basic plane make a class that is looked up at once; others are rare.
_OTHER = re.compile("[" + "".join(c for c in map(chr, range(0x80, 0x10000)) if c.isalnum() and not c.isalpha() and not c.isdecimal()) + "]")
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
_SPACE = re.compile(r"[\W\d_]+")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def spectrum(text: str) -> np.ndarray:
    """The different 1-, 2- and 3-grams of a whole text, as sorted exact codes.

    Case is folded, and each run of characters that aren't letters counts as one blank, so
    that digits, marks and layout say nothing about the language.
    """
    folded = text.lower()
    if not folded.isascii():
        folded = _OTHER.sub(" ", folded)
        folded = _ASTRAL.sub(lambda m: m[0] if m[0].isalpha() else " ", folded)
    letters = f" {_SPACE.sub(' ', folded).strip()} "
    c = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    two = c[:-1] << np.uint64(21) | c[1:]
    three = two[:-1] << np.uint64(21) | c[2:]
    return np.unique(np.concatenate([np.unique(c), np.unique(two), np.unique(three)]))


@dataclass
class Model:
    """A fitted classifier; its size is bounded by the fit's parameters."""

    languages: list[str]
    grams: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray
    least_known: float = 0.0

    def kernel(self, spectra: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Kernels with the landmarks, and the share of each spectrum's n-grams that those hold."""
        present = np.zeros((len(spectra), len(self.grams)), dtype=np.float32)
        for row, own in enumerate(spectra):
            at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
            present[row, at[self.grams[at] == own]] = 1
        sizes = np.array([max(1, len(s)) for s in spectra], dtype=np.float64)
        return (present @ self.landmarks).astype(np.float64) / np.sqrt(sizes)[:, None], present.sum(axis=1) / sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return self.judge(texts)[:2]

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and known share of each text's n-grams."""
        names, scores, shares = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.languages else []
        for start in range(0, len(known), BATCH):
            rows = known[start : start + BATCH]
            spectra = [spectrum(texts[i]) for i in rows]
            kernel, shares[rows] = self.kernel(spectra)
            margins = kernel @ self.weights
            best = margins.argmax(axis=1)
            scores[rows] = np.clip((1 + margins[np.arange(len(rows)), best]) / 2, 0, 1)
            for i, b in zip(rows, best, strict=True):
                names[i] = self.languages[b]
        return names, scores, shares


def fit_spectra(labels: list[str], spectra: list[np.ndarray], *, landmarks_per_language: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> Model:
    """Nyström landmarks and one-versus-rest kernel ridge regression on labelled spectra.

    The first texts of each language are its landmarks. No texts give a model that answers
    ``und``; one language gives a model that knows only that one.
    """
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.array([], dtype=np.uint64), np.zeros((0, 0), dtype=np.float32), np.zeros((0, 0)))
    label = np.array(labels)
    marks = np.concatenate([np.flatnonzero(label == name)[:landmarks_per_language] for name in languages])
    grams = np.unique(np.concatenate([spectra[i] for i in marks]))
    matrix = np.zeros((len(grams), len(marks)), dtype=np.float32)
    for column, i in enumerate(marks):
        matrix[np.searchsorted(grams, spectra[i]), column] = 1 / np.sqrt(len(spectra[i]))
    model = Model(languages, grams, matrix, np.eye(len(marks)))
    kernel, known = model.kernel(spectra)
    values, vectors = np.linalg.eigh(kernel[marks])
    whiten = vectors[:, values > 1e-8] / np.sqrt(values[values > 1e-8])
    features = kernel @ whiten
    target = np.where(label[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # every language weighs the same, however many of its texts there are
    weight = (1 / np.unique(label, return_counts=True)[1])[np.searchsorted(languages, label)][:, None]
    gram = features.T @ (features * weight) + ridge / len(languages) * np.eye(features.shape[1])
    model.weights = whiten @ np.linalg.solve(gram, features.T @ (target * weight))
    # landmarks know all of themselves, so the other texts of the fit say what is usual
    model.least_known = KNOWN_SHARE * float(np.delete(known, marks).min()) if len(marks) < len(spectra) else 0.0
    return model


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", texts_per_language: int = TEXTS_PER_LANGUAGE, landmarks_per_language: int = LANDMARKS_PER_LANGUAGE) -> Model:
    """Fit on at most ``texts_per_language`` labelled texts of each language.

    The texts are drawn by a hash of the id. The driver gets their spectra, not the texts.
    Rows without a language, or whose text is null or has no letter, are not used.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), sample_order(id_col, SEED).alias("draw"))
    rows = rows.where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}"))
    counts = rows.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "languages")  # small, and seen to be so: the texts aren't shuffled
    drawn = rows.join(counts, rows["lang"] == counts["of"]).where(F.col("draw") * F.col("n") < 1.2 * texts_per_language + 20)

    def spectra(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"lang": batch["lang"], "draw": batch["draw"], "grams": [spectrum(t).view(np.int64) for t in batch["text"]]})

    found = drawn.select("lang", "draw", "text").mapInPandas(spectra, "lang string, draw double, grams array<long>").toPandas()
    found = found.sort_values(["lang", "draw"], kind="stable").groupby("lang").head(texts_per_language)
    return fit_spectra(list(found["lang"]), [np.array(g, dtype=np.int64).view(np.uint64) for g in found["grams"]], landmarks_per_language=landmarks_per_language)


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` for every row; the whole text is read.

    ``score`` is the best one-versus-rest margin, moved to 0..1. Null and empty texts and
    texts without a letter give ``und`` and 0. Repeated rows are answered as often as they
    come, an empty table gives no rows, and other columns are not looked at.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, scores = model.predict(list(batch["text"]))
            yield pd.DataFrame({"id": batch["id"], "lang_pred": names, "score": scores})

    kind = docs.schema[id_col].dataType.simpleString()
    return text_batches(docs, id_col, text_col).mapInPandas(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_known(docs: DataFrame, model: Model, *, text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is one of the learned, with the same columns.

    Rejected are texts that give ``und``, texts that score less than ``min_score``, and texts
    of whose n-grams the landmarks hold a smaller share than ``KNOWN_SHARE`` times the least
    share among the fit's other texts: a script or language that was not learned.
    """

    @F.pandas_udf("boolean")
    def known(text: pd.Series) -> pd.Series:
        found = zip(*model.judge(list(text)), strict=True)
        return pd.Series([n != UNDETERMINED and s >= min_score and share >= model.least_known for n, s, share in found], dtype=bool)

    return docs.where(known(F.col(text_col).cast("string")))
