"""Language ID and toxicity: held-out accuracy, exact neighbours, and odd inputs."""

import random

import numpy as np

from annalist.llm import langid, toxicity
from annalist.llm.common import held_out

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.where(~held_out()))
    found = docs.where(held_out()).join(langid.identify(docs, model), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) >= 0.97


def test_language_of_odd_texts(documents, nothing):
    docs = documents(["der die und das ist", "the and of was with", "", None, "12 34 !", "the " * 5000], ["de", "en", "en", None, "de", None])
    model = langid.fit(docs)
    rows = langid.identify(docs, model).collect()
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert len(rows) == docs.count()
    assert found[0][0] == "de" and found[1][0] == found[5][0] == "en"
    assert found[2] == found[3] == found[4] == ("und", 0.0)
    assert langid.keep_known(docs, model).columns == docs.columns
    assert langid.identify(nothing, langid.fit(nothing)).count() == 0


def test_language_of_texts_without_letters(documents):
    docs = documents(["der die und das ist", "½ ² ① ٣ 12", "the and of was with"], ["de", None, "en"])
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, langid.fit(docs)).collect()}
    assert found[0] == "de" and found[1] == "und"


def test_language_against_exact_kernels(spark):
    """The Nyström features of all fitted texts give what the plain kernel matrix gives."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null").limit(120).collect()
    labels, spectra = [r["lang"] for r in docs], [langid.spectrum(r["text"]) for r in docs]
    model = langid.fit_spectra(labels, spectra, landmarks_per_language=1000)
    kernel = np.array([[len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b)) for b in spectra] for a in spectra])
    np.testing.assert_allclose(model.kernel(spectra)[0], kernel[:, np.concatenate([np.flatnonzero(np.array(labels) == n) for n in model.languages])], atol=1e-5)
    plain = [labels[i] for i in (kernel - 2 * np.eye(len(labels))).argmax(axis=1)]
    assert np.mean([a == b for a, b in zip(model.predict([r["text"] for r in docs])[0], plain)]) >= 0.9


def test_unlearned_languages_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.where(~held_out()))
    foreign = ["Это просто русский текст о погоде и природе", "これは日本語の文章です", "zxq qzx jwk kqj xzz wqq vvk kkz jjq", "Tämä lyhyt kirjoitus käsittelee säätä ympäri vuoden hyvin yksityiskohtaisesti"]
    table = spark.createDataFrame([(t,) for t in foreign], "text string")
    assert langid.keep_known(table, model).count() == 0
    assert langid.keep_known(docs, model).count() >= 0.99 * docs.where("text is not null").count()


def test_toxicity_finds_exact_neighbours(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    index = toxicity.fit(docs, labels.where(~held_out()))
    dense = np.zeros((len(index.votes), len(index.idf)))
    term = np.repeat(np.arange(len(index.idf)), index.starts[:, -1] - index.starts[:, 0])
    dense[index.entries, term] = index.weights
    for row in toxicity.vectorize(docs, index.ids).limit(300).collect():
        at, weight = index.query(row["vector"])
        if not len(at):
            continue
        [(near, cosines)] = index.nearest([(at, weight)])
        brute = np.sort(dense[:, at] @ weight)[::-1][: toxicity.NEIGHBOURS]
        np.testing.assert_allclose(cosines, brute[brute > 0][: len(cosines)], atol=1e-9)
        assert len(cosines) == (brute > 0).sum()
    scored = toxicity.score(docs, index).join(labels, "doc_id").where(held_out()).collect()
    flagged = [r for r in scored if r["predicted"]]
    assert sum(r["toxic"] for r in flagged) >= 0.9 * len(flagged) > 0


def test_toxicity_without_examples(documents, nothing, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = documents(["a b", "", None, "idiot " * 1000])
    index = toxicity.fit(docs, none)
    assert [r["score"] for r in toxicity.score(docs, index).collect()] == [0.0] * docs.count()
    assert toxicity.score(nothing, toxicity.fit(nothing, none)).count() == 0


def test_toxicity_learns_a_word(documents, spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = [" ".join(word() for _ in range(20)) + (" vile" if i % 4 == 0 else "") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100)] + [(None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    rows = toxicity.score(documents(texts), toxicity.fit(documents(texts), labels)).collect()
    assert all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in rows if r["doc_id"] is not None)


def test_toxicity_compares_all_examples_by_all_terms(documents, spark):
    texts = ["alpha beta gamma", "delta epsilon zeta", "eta theta iota", "kappa alpha mu", "beta kappa"]
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "doc_id long, toxic int")
    index = toxicity.fit(documents(texts), labels)
    assert {toxicity.code(t) for t in ("alpha", "theta", "gamm-", "epsi-")} <= set(index.ids.tolist()) and index.votes.sum() >= 3
    found = {r["doc_id"]: r for r in toxicity.score(documents(texts), index).collect()}
    assert [found[i]["evidence"][0]["id"] for i in (0, 1, 2, 3, 4)] == ["0", "1", "2", "0", "0"]
    assert abs(found[1]["evidence"][0]["cosine"] - 1) < 1e-6


def test_toxicity_calibration_rises():
    x, y = toxicity.calibration(np.array([0.1, 0.2, 0.3, 0.9]), np.array([0, 1, 0, 1]), np.ones(4))
    assert list(np.interp([0.1, 0.2, 0.3, 0.9], x, y)) == [0, 0.5, 0.5, 1]
    counts = {5: 1, 700_000: 3, 7: 1, 80_000: 70_000}
    at, n = toxicity.unpack(toxicity.pack(np.array(list(counts)), np.array(list(counts.values()))))
    assert dict(zip(at.tolist(), n.tolist(), strict=True)) == counts
