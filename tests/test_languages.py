"""The classifier of languages: profiles, rankings, odd texts."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from annalist.functions import text
from annalist.operators import languages

TEXTS = {
    "de": "Der schnelle braune Fuchs springt über den faulen Hund, und die Kinder lachen, weil es nicht regnet. Wir gehen morgen in die Stadt.",
    "en": "The quick brown fox jumps over the lazy dog and the children laugh because it is not raining. We are going to the town tomorrow.",
    "fr": "Le rapide renard brun saute par-dessus le chien paresseux et les enfants rient parce qu'il ne pleut pas. Nous allons en ville demain.",
    "uk": "Швидка руда лисиця стрибає через ледачого пса, і діти сміються, бо не йде дощ. Завтра ми поїдемо до міста.",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(lang, t) for lang, t in TEXTS.items()] + [("de", TEXTS["de"]), (None, "nothing"), ("en", None), ("en", "")]
    return languages.profiles(languages.profile_table(spark.createDataFrame(rows, "lang string, text string").repartition(3)))


def test_rankings(spark, model):
    assert model.languages == sorted(TEXTS)
    asked = {"de": "Die Kinder gehen über die Straße", "en": "the children are going there", "fr": "les enfants vont en ville", "uk": "діти йдуть до міста"}
    rows = spark.createDataFrame([*asked.items(), ("none", "12 34 !"), ("none", ""), ("null", None)], "lang string, t string")
    for r in rows.select("lang", "t", model.ranking()("t").alias("r")).collect():
        if r["lang"] in ("none", "null"):
            assert r["r"] == []
            continue
        confidences = [x["confidence"] for x in r["r"]]
        assert r["r"][0]["language"] == r["lang"] and confidences == sorted(confidences, reverse=True) and sum(confidences) == pytest.approx(1)


def test_a_doubtful_text_is_doubtful(model):
    assert model.ranked("e")[0][1] < 0.9 < model.ranked(TEXTS["en"])[0][1]


@pytest.mark.parametrize("own", sorted(TEXTS))
@pytest.mark.parametrize("quoted", sorted(TEXTS))
def test_a_longer_passage_that_is_quoted_is_set_aside(monkeypatch, model, own, quoted):
    half = len(TEXTS[own]) // 2
    given = TEXTS[own][:half] + " " + 3 * TEXTS[quoted] + " " + TEXTS[own][half:]
    for places in (1 << 16, 64):
        monkeypatch.setattr(languages, "PLACES", places)
        (best, confidence), *_ = model.ranked(given)
        assert best == own and confidence > 0.6


def test_of_two_parts_the_longer_is_a_text_s_own(model):
    assert [model.ranked(t)[0][0] for t in (TEXTS["de"] + 2 * TEXTS["en"], 2 * TEXTS["de"] + TEXTS["en"])] == ["en", "de"]


@pytest.mark.parametrize("places", [1 << 16, 64])
def test_what_goes_on_after_a_passage_is_a_text_s_own(monkeypatch, model, places):
    monkeypatch.setattr(languages, "PLACES", places)
    first = TEXTS["fr"].split(". ")[0]
    assert [model.ranked(f"{2 * TEXTS['en']} {t}")[0][0] for t in (first[0].lower() + first[1:] + ".", first + ".")] == ["fr", "en"]


def test_where_sentences_go_on():
    given = "Das ist alt. und so weiter... éa! 3. Äh\na.b c? d"
    words = b" ".join(w.encode() for w in languages._WORD.findall(given.lower()))
    assert np.flatnonzero(languages._resumed(given, 1, 60)).tolist() == [words.index(w) for w in (b"und", "éa".encode(), b"d")[:2]] + [len(words) - 1]
    assert not languages._resumed("", 1, 5).any() and np.flatnonzero(languages._resumed(given, 64, 3)).tolist() == [0]


def test_no_passage_where_one_language_is_enough(model):
    for given in ("x", *TEXTS.values(), 500 * TEXTS["fr"]):
        assert languages._quoted(*model._said(given)) == slice(0, 0)


def plain_runs(given):
    data = b" " + b" ".join("".join(c if c.isalpha() or not c.isascii() else " " for c in given.lower()).encode().split()) + b" "
    out = collections.Counter()
    for n in range(1, 5):
        for a in range(len(data) - n + 1):
            run = data[a : a + n]
            if b" " not in run[1:-1] and run.strip():
                out[n] += 1
    return out


@pytest.mark.parametrize("piece", [5, 64, 1 << 20])
def test_pieces_of_a_long_text_are_the_whole(monkeypatch, piece):
    given = "Straße, d'été!  x 日本 " * 9
    whole = languages.runs(given)
    monkeypatch.setattr(languages, "PIECE", piece)
    assert (languages.runs(given) == whole).all()
    by_length = whole.reshape(languages.LENGTHS, -1).sum(axis=1)
    assert dict(enumerate(by_length.tolist(), 1)) == plain_runs(given)


def test_profiles_of_nothing(spark):
    none = languages.profiles(languages.profile_table(spark.createDataFrame([], "lang string, text string")))
    assert none.languages == [] and none.ranked("a text") == []


def test_profiles_add_up(spark):
    rows = spark.createDataFrame(list(TEXTS.items()), "lang string, text string")
    one = languages.profile_table(rows)
    both = languages.profile_table(rows.where("lang < 'f'")).union(languages.profile_table(rows.where("lang >= 'f'")))
    assert np.allclose(languages.profiles(one).weights, languages.profiles(both).weights)
    assert languages.profiles(one, ["de", "uk"]).languages == ["de", "uk"]


def test_article_language_with_rankings(spark, model):
    rows = spark.createDataFrame([(1, TEXTS["de"]), (2, "")], "n int, t string")
    found = rows.select("n", text.article_language(F.lit(None), F.lit(None), F.col("t"), model.ranking()("t"), ["en", "de"]).alias("d")).orderBy("n").collect()
    assert [(r["d"]["language"], r["d"]["basis"], r["d"]["uncertain"]) for r in found] == [("de", "classifier", False), (None, "none", True)]
