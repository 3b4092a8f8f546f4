"""Scores, features and the whole pipeline against plain Python."""

import math
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from annalist.llm import embedding_dedup, gif, langid, mixing, packing, pii, toxicity
from annalist.llm.common import held_out
from test_others import one_by_one
from test_removal import plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_toxicity_scores_are_those_of_plain_vectors(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    index, vectors = toxicity.fit_and_vectorize(docs, labels)
    got = {r["id"]: r for r in toxicity.score_vectors(vectors, index).collect()}
    texts, label = {r["doc_id"]: r["text"] for r in docs.collect()}, {r["doc_id"]: r["toxic"] for r in labels.collect()}
    counts = {i: toxicity.terms(t) for i, t in texts.items()}
    known = {t for i in label for t in counts[i]}
    df = Counter(t for c in counts.values() for t in c if t in known)
    n1, n0 = sum(label.values()), sum(v == 0 for v in label.values())
    weight = {}
    for t in known:
        a, b = sum(t in counts[i] for i in label if label[i]), sum(t in counts[i] for i in label if not label[i])
        chi2 = (n1 + n0) * (a * (n0 - b) - b * (n1 - a)) ** 2 / max(1, (a + b) * (n1 + n0 - a - b) * n1 * n0)
        gain = math.sqrt(chi2) if chi2 >= toxicity.MIN_CHI2 and a * n0 > b * n1 else 1
        weight[t] = (math.log((1 + len(texts)) / (1 + df[t])) + 1) * gain

    def vector(c):
        v = {t: (1 + math.log(n)) * weight[t] for t, n in c.items() if t in weight}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    by_vector, units = {}, {i: vector(counts[i]) for i in texts}
    for i in label:
        by_vector.setdefault(frozenset(units[i].items()), []).append(i)
    groups = [(dict(v), len(ids), sum(label[i] for i in ids) / len(ids)) for v, ids in by_vector.items() if v]
    rate = n1 / (n1 + n0)
    for i in list(texts)[:60]:
        if not units[i]:
            continue
        near = sorted(((sum(x * v.get(t, 0) for t, x in units[i].items()), n, toxic) for v, n, toxic in groups), reverse=True)
        near = [x for x in near if x[0] > 1e-12]
        edge = near[toxicity.NEIGHBOURS - 1][0] if len(near) >= toxicity.NEIGHBOURS else 0
        if len(near) > toxicity.NEIGHBOURS and abs(near[toxicity.NEIGHBOURS][0] - edge) < 1e-9:
            continue  # a tie at the edge may fall either way here
        votes = [(math.sqrt(n) / (1 - min(1, c) + 0.05), toxic) for c, n, toxic in near[: toxicity.NEIGHBOURS]]
        share = (sum(v * t for v, t in votes) + rate / 1.05) / (sum(v for v, _ in votes) + 1 / 1.05)
        assert abs(got[i]["score"] - float(np.interp(share, *index.knots))) < 1e-6
        assert abs(got[i]["evidence"][0]["cosine"] - near[0][0]) < 1e-6


def test_toxicity_scores_are_calibrated_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    index, vectors = toxicity.fit_and_vectorize(docs, labels.where(~held_out()))
    held = {r["doc_id"]: r["toxic"] for r in labels.where(held_out()).collect()}
    pairs = [(r["score"], held[r["id"]]) for r in toxicity.score_vectors(vectors, index).collect() if r["id"] in held]
    assert len(pairs) > 500 and abs(np.mean([s for s, _ in pairs]) - np.mean([t for _, t in pairs])) < 0.03
    for low, high in ((0, 0.3), (0.7, 1.01)):
        some = [(s, t) for s, t in pairs if low <= s < high]
        assert abs(np.mean([s for s, _ in some]) - np.mean([t for _, t in some])) < 0.08


def test_gif_feature_is_the_payloads_histogram(documents):
    docs = documents(["abc", "", None, "é" * 3000, "many words " * 300])
    rows = docs.collect()
    got = {(r["doc_id"], r["n_bytes"]): r["feature"] for r in gif.digests(gif.media(docs)).collect()}
    for r in rows:
        raw = (r["text"] or "").encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        bins = [0] * 64
        for s in payload:
            red, green, blue = s, s * 7 % 256, 255 - s
            bins[(red // 64 * 4 + green // 64) * 4 + blue // 64] += 1
        assert got[r["doc_id"], len(raw)] == ",".join(map(str, bins))


@pytest.mark.parametrize(("n", "skewed"), [(600, False), (600, True), (2400, True)])
def test_embedding_recall_by_size_and_shape(spark, n, skewed):
    rng = np.random.default_rng(n + skewed)
    scale, centre = (np.geomspace(3, 0.3, 32), 4 * rng.standard_normal(32)) if skewed else (np.ones(32), np.zeros(32))
    base = rng.standard_normal((n // 2, 32)) * scale + centre
    x = np.concatenate([base, base + 0.12 * rng.standard_normal(base.shape) * scale]).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((units @ units.T) >= 0.95).sum() - n
    got = sum(r["n_links"] for r in embedding_dedup.near_duplicates(df).collect())
    assert want >= got >= 0.99 * want > 0


def test_pipeline_against_plain_stages(spark, tmp_path):
    source = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120)
    extra = spark.createDataFrame([(9001, "Это текст на другом языке", None, "s", 1), (9002, None, "de", "s", 0), (9003, "", "de", "s", 0), (9004, "½ 12", "en", "t", 4)], source.schema)
    copies = source.limit(5).selectExpr("doc_id + 10000 as doc_id", "text", "lang", "source", "n_chars")
    source.union(extra).union(copies).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()

    rows = {r["doc_id"]: r for r in docs.collect()}
    model = langid.fit(docs.where(~held_out()))
    ids = list(rows)
    judged = zip(ids, *model.judge([rows[i]["text"] for i in ids]), strict=True)
    known = [i for i, name, score, share in judged if name != "und" and score >= langid.MIN_SCORE and share >= model.least_known]
    assert not {9001, 9002, 9003, 9004} & set(known)
    prints, root = {i: plain_fingerprint(rows[i]["text"]) for i in known}, {i: i for i in known}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in known:
        for b in known:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    kept = [i for i in known if top(i) == i]
    redrawn = {(r["kind"], r["entity"]): r["attempt"] for r in pii.redrawn_entities(docs.where(docs["doc_id"].isin(kept))).collect()}
    clean = {i: pii.rewrite(rows[i]["text"], redrawn)[0] for i in kept}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, rows[i]["source"]) for i, t in clean.items()])
    times = {i: taken // size for i, size, taken in con.execute(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE_SQL})").fetchall() if taken}
    encode, pieces = packing.reference_encoder(packing.VOCABULARY), Counter()
    for i, n in times.items():
        length = len(encode(clean[i])) + 1
        first = length % 2048 or 2048
        for piece, start in enumerate([0, *range(first, length, 2048)]):
            pieces[i, piece, start, first if piece == 0 else 2048] += n
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in out) == pieces
    assert len({r["sequence_id"] for r in out}) == one_by_one([k[3] for k, n in pieces.items() for _ in range(n)], 2048)
