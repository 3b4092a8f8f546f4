"""Quality votes, Yinyang clusters and source divergence against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from annalist.llm import clustering, divergence, embedding_dedup, quality
from annalist.llm.common import held_out

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, nearest int, id string, v string"


def plain_clusters(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted((digest(i), v) for i, v in kept)[:k]]
    gap = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for left in range(rounds, -1, -1):
        nearest = [min(range(len(centroids)), key=lambda c: (gap(v, centroids[c]), c)) for _, v in kept]
        if left:
            for c in range(len(centroids)):
                own = [v for (_, v), n in zip(kept, nearest, strict=True) if n == c]
                if own:
                    centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    distance = [gap(v, centroids[n]) for (_, v), n in zip(kept, nearest, strict=True)]
    inertia = Counter()
    for n, d in zip(nearest, distance, strict=True):
        inertia[n] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, inertia[n], sum(distance), sha[n]) for (i, _), n, d in zip(kept, nearest, distance, strict=True)), key=repr)


@pytest.mark.parametrize("kind", ["even", "lumps", "ties", "few"])
def test_clusters_are_those_of_plain_rounds(spark, kind):
    draw = random.Random(kind)
    lumps = [[draw.gauss(0, 0.3) for _ in range(64)] for _ in range(5)]

    def vector():
        if kind == "ties":
            return [float(draw.randint(0, 1)) if n < 2 else 0.0 for n in range(64)]
        if kind == "lumps":
            return [x + draw.gauss(0, 0.02) for x in draw.choice(lumps)]
        return [draw.gauss(0, 0.1) for _ in range(64)]

    rows = [(i, [float(np.float32(x)) for x in vector()]) for i in range(9 if kind == "few" else 300)]
    rows += [rows[3], rows[3], (None, rows[4][1]), (900, None), (901, []), (902, [0.5] * 63), (903, [0.5] * 65), (904, [None] + [0.5] * 63), (905, [math.nan] * 64), (906, [math.inf] + [0.0] * 63), (907, [0.0] * 64)]
    table = spark.createDataFrame([(i, v, 7, "x", "y") for i, v in rows], VECTORS).repartition(5)
    assert sorted(map(tuple, clustering.cluster(table).collect()), key=repr) == plain_clusters(rows)


def test_no_vectors_give_no_clusters_and_huge_ones_are_named(spark):
    assert clustering.cluster(spark.createDataFrame([], VECTORS)).collect() == []
    huge = spark.createDataFrame([(77, [1e12] + [0.0] * 63, 0, "", "")], VECTORS)
    with pytest.raises(Exception, match="vector 77"):
        clustering.cluster(huge)


def test_bounds_spare_most_distances():
    draw = np.random.default_rng(2)
    middles = draw.integers(-60, 60, (16, 64))
    x = middles[draw.integers(0, 16, 4000)] + draw.integers(-3, 4, (4000, 64))
    group = clustering.groups_of(middles, 4)
    before = middles + draw.integers(-2, 3, middles.shape)
    found = clustering.first_assignment(x, before, group)
    *now, computed = clustering.next_assignment(x, *found, middles, np.sqrt(clustering.squared(middles, before)), group)
    assert computed < 0.2 * len(x) * 16
    assert (now[0] == clustering.first_assignment(x, middles, group)[0]).all()


@pytest.mark.parametrize("seed", range(3))
def test_bounds_stay_bounds_over_many_rounds(seed):
    draw = np.random.default_rng(seed)
    x, centroids = draw.integers(-9, 10, (500, 8)), draw.integers(-9, 10, (12, 8))
    group = np.unique(clustering.groups_of(centroids, 3), return_inverse=True)[1]
    state = clustering.first_assignment(x, centroids, group)
    for _ in range(8):
        after = centroids + draw.integers(-2, 3, centroids.shape)
        *state, _ = clustering.next_assignment(x, *state, after, np.sqrt(clustering.squared(after, centroids)), group)
        centroids = after
        every = np.sqrt(np.stack([clustering.squared(x, c) for c in centroids], axis=1))
        nearest, upper, lower = state
        assert (nearest == every.argmin(axis=1)).all() and (upper >= every.min(axis=1)).all()
        every[np.arange(len(x)), nearest] = np.inf
        assert all((lower[:, g] <= every[:, group == g].min(axis=1)).all() for g in range(group.max() + 1))


def test_embeddings_with_ids_of_text(spark):
    rows = [("7", [1.0, 0.0]), ("x", [1.0, 0.0]), ("12", [1.0, 0.01]), (None, [1.0, 0.0]), ("3", [0.0, 1.0])]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id string, embedding array<float>"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("7", 1, 7, True), ("12", 1, 7, False), ("3", 0, 3, True), ("x", 0, None, False), (None, 0, None, False)], key=str)


def plain_divergence(rows, top=200):
    pattern = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        found = [t.translate(lower) for t in pattern.findall(text or "")]
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
        groups[lang or ""].add(source or "")
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def shares(own, kept=kept):
            total = sum(own[t] for t in kept)
            return {t: 1 + 10**9 * (own[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources if o != s]
            over = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", over, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, n) for n, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def test_divergence_is_that_of_plain_counts(spark):
    draw = random.Random(5)
    words = ["Ab", "ab", "é", "É", "日本", "x1y", "don't", "Z", "😀a", "same", "t_u"]
    rows = [(" ".join(draw.choice(words) for _ in range(draw.randint(0, 30))), draw.choice(["en", "de", None, ""]), draw.choice(["a", "b", "c", None, ""])) for _ in range(150)]
    rows += [(None, "en", "a"), ("", "solo", "only"), ("word " * 50_000, "en", "b"), ("rare", "fr", "a"), ("12 34", "fr", "b"), rows[0], rows[0]]
    table = spark.createDataFrame([(n, *r, 3, "k", "t") for n, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n int, term string, salt string")
    got = sorted(tuple(r) for r in divergence.divergence(table.repartition(3), top=4).collect())
    assert got == plain_divergence(rows, top=4)


def test_no_documents_give_no_divergence(nothing):
    assert divergence.divergence(nothing).collect() == []


def test_shares_are_exact_beyond_64_bits(spark):
    cases = [(0, 0, 1), (5, 5, 1), (10**13, 3 * 10**15, 10**8), (2, 7, 3), (10**12 + 1, 10**12 + 1, 1), (123_456_789, 987_654_321_987, 4_000_000_000)]
    table = spark.createDataFrame(cases, "n long, total long, terms long")
    got = [r[0] for r in table.selectExpr(divergence.share("n", "total", "terms")).collect()]
    assert got == [1 + 10**9 * (n + 1) // (total + terms) for n, total, terms in cases]


def test_votes_are_those_of_all_cosines():
    draw = np.random.default_rng(4)
    vectors, labels = quality.unit(draw.standard_normal((2_500, 6))), draw.integers(0, 2, 2_500).astype(float)
    vectors[1_500:1_520] = vectors[0]
    rows = np.vstack([quality.unit(draw.standard_normal((40, 6))), vectors[:3], np.zeros((1, 6))])
    model = quality.Model(np.ones(1), np.zeros((1, 6)), vectors, labels, 0.8)
    for row, got in zip(rows, model.score(rows), strict=True):
        cosines = np.round(vectors @ row, 9)
        near = sorted(range(len(vectors)), key=lambda e: (-cosines[e], e))[: quality.NEIGHBOURS]
        vote = np.maximum(0, cosines[near])
        assert got == pytest.approx(((vote * labels[near]).sum() + 0.4) / (vote.sum() + 0.5), abs=1e-9)


def test_directions_are_singular_vectors():
    draw = np.random.default_rng(3)
    full = draw.standard_normal((60, 8)) @ np.diag([9, 7, 5, 3, 1, 0.5, 0.2, 0.1]) @ draw.standard_normal((8, 200))
    rows = [(np.arange(200), r) for r in full]
    found, want = quality.singular_directions(rows, 200, 3), np.linalg.svd(full)[2][:3]
    assert np.abs(np.abs(want @ found) - np.eye(3)).max() < 1e-3


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    aside = held_out(folds=3, fold=1)
    scored = quality.score(docs, quality.fit(docs, labels.where(~aside))).join(labels, "doc_id").where(aside).toPandas()
    assert (scored["predicted"] == scored["quality"]).mean() > 0.97
    assert scored["predicted"][scored["quality"] == 1].mean() > 0.98


def test_votes_with_odd_rows(spark, documents, nothing):
    docs = documents(["good words here"] * 6 + ["BAD!! BAD!! BAD!!"] * 6 + ["", "   ", "\n|", "x " * 200_000, "\U0001f600 日本"])
    labels = spark.createDataFrame([(i, int(i < 6)) for i in range(12)] + [(0, None), (1, 5), (None, 1), (99, 0), (2, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[3]["predicted"] == 1 and by[9]["predicted"] == 0
    assert by[12]["score"] == by[13]["score"] == by[None]["score"] == pytest.approx(model.rate)
    assert [r["score"] for r in got if r["doc_id"] == 0] == [by[1]["score"]] * 2
    assert quality.score(nothing, model).collect() == []
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, labels.where("false"))).collect()} == {0.5}


def test_the_sample_is_bounded(spark, documents):
    docs = documents([f"w{i} v{i} u{i}" for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    assert len(quality.fit(docs, labels, max_examples=10).labels) <= 10
    assert 0 < len(quality.fit(docs, labels, max_entries=30).labels) <= 30 // 4


def test_long_texts_in_pieces(monkeypatch):
    text = "Ab cd,éF ".encode() * 40
    whole = [w for words in divergence._words(text) for w in words]
    monkeypatch.setattr(divergence, "PIECE", 5)
    pieces = list(divergence._words(text))
    assert len(pieces) > 20 and [w for words in pieces for w in words] == whole == [b"ab", b"cd", "éf".encode().replace(b"F", b"f")] * 40
    assert list(divergence._words(b"")) == []
