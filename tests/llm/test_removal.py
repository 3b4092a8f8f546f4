"""Repeated bytes and passages, and SimHash, against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from annalist.llm import phrase_dedup, repeats, simhash, suffix_dedup


def covered(sequences, window):
    seen = Counter(s[i : i + window] for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[s[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        out.append(gone)
    return out


def texts_with_repeats(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 5)))
    passage = [word() for _ in range(30)]
    texts = []
    for i in range(30):
        words = [word() for _ in range(rng.randint(0, 60))]
        a = rng.randint(0, 15)
        texts.append(" ".join(words + passage[a : a + rng.randint(4, 15)] * (i % 3) + words[: i % 5]))
    return [*texts, texts[3], texts[3], "", " \t\n", "ab " * 400, "x" * 3000, None]


@pytest.mark.parametrize("hot", [1000, 2])
def test_suffix_dedup_is_exact(spark, documents, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    texts = texts_with_repeats(1)
    docs = documents(texts)
    got = suffix_dedup.remove_repeats(docs, length=20).collect()
    rows = docs.collect()
    raw = [(r["text"] or "").encode() for r in rows]
    want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, len(b), bytes(c for c, g in zip(b, gone) if not g)) for r, b, gone in zip(rows, raw, covered(raw, 20)))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_bytes"], bytes(r["kept"])) for r in got) == want


@pytest.mark.parametrize("hot", [1000, 2])
def test_phrase_dedup_is_exact(spark, documents, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    docs = documents(texts_with_repeats(2))
    got = phrase_dedup.remove_passages(docs, window=6).collect()
    rows = docs.collect()
    words = [tuple(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows]
    want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, len(w), " ".join(x for x, g in zip(w, gone) if not g)) for r, w, gone in zip(rows, words, covered(words, 6)))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"], r["kept"]) for r in got) == want


def test_removal_of_nothing(nothing):
    assert suffix_dedup.remove_repeats(nothing).count() == 0
    assert phrase_dedup.remove_passages(nothing).count() == 0


def test_merge_knows_common_prefixes():
    rng = random.Random(4)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 20))) for _ in range(7)]
    coded = []
    for run in runs:
        coded.append(iter([(repeats.common(run[i - 1], s) if i else 0, s) for i, s in enumerate(run)]))
    merged = list(suffix_dedup.merge_runs(coded))
    assert [s for _, s in merged] == sorted(s for run in runs for s in run)
    assert all(h == repeats.common(a[1], b[1]) for a, b in zip(merged, merged[1:]) for h in [b[0]])


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("long_list", [4096, 3])
def test_simhash_is_exact(documents, monkeypatch, long_list):
    monkeypatch.setattr(simhash, "LONG_LIST", long_list)
    rng = random.Random(5)
    base = [" ".join(rng.choice("alpha Beta gamma delta É x y".split()) for _ in range(200)) for _ in range(12)]
    texts = [t + f" tail{n}" * (n % 2) for t in base for n in range(4)] + ["", None, " ", "one", "one two"]
    docs = documents(texts)
    got = simhash.near_duplicates(docs).collect()
    rows = docs.collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    assert Counter((r["doc_id"], r["fp"] & (2**64 - 1)) for r in got) == Counter((r["doc_id"], f) for r, f in zip(rows, prints))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(r["doc_id"])
    want = Counter((r["doc_id"], min((x for x in groups[root(i)] if x is not None), default=None)) for i, r in enumerate(rows))
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == want
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c in want if c is not None}


def test_one_document_of_each_group_stays(spark):
    text, other = "one two three four five", "six seven eight nine ten"
    rows = [(None, text, 1), (4, text, 2), (4, text, 3), (9, text, 4), (None, other, 5), (None, other, 6), (4, other + " eleven", 7), (1, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stay int")
    kept = simhash.keep_first(docs).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == [(0, other), (1, ""), (4, text), (4, other + " eleven")]


def test_texts_of_several_parts_keep_their_anchors(monkeypatch):
    """Beyond PLACES symbols a text is taken in parts; equal windows must still agree on gram and place."""
    import numpy as np

    monkeypatch.setattr(repeats, "PLACES", 1 << 9)
    rng = np.random.default_rng(3)
    symbols = np.concatenate([rng.integers(0, 3, 1500), np.zeros(200, dtype=int), rng.integers(0, 3, 40)] * 3).astype(np.uint8)
    kind = repeats.Kind(suffix_dedup.byte_symbols, 24, 12)
    grams, places, first, last = repeats.anchors(symbols, kind)
    seen, windows = {}, []
    for g, p, a, b in zip(grams.tolist(), places.tolist(), first.tolist(), last.tolist()):
        for w in range(a, b + 1):
            windows.append(w)
            assert w <= p <= w + kind.window - kind.gram
            assert seen.setdefault(symbols[w : w + kind.window].tobytes(), (g, p - w)) == (g, p - w)
    assert windows == list(range(len(symbols) - kind.window + 1))
