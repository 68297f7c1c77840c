"""Fingerprints, the Jaccard join and its components against plain Python."""

import hashlib
import re

import numpy as np
import pytest
from edge import TEXTS, documents, empty, shingles

from maskloom.llm import fingerprints, jaccard_join


def _components(texts):
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {i: shingles(t) for i, t in texts.items()}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in texts}, {i: len(s) for i, s in sets.items()}


OPTIONS = [{}, {"leaf": 4, "pivots": 2, "common": 2, "share": 3}, {"leaf": 2, "pivots": 1, "common": 99, "levels": 0}]


@pytest.mark.parametrize("options", OPTIONS)
def test_components(spark, options):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    base = list(rng.choice(words, 60))
    more = {}
    for i in range(60):  # near copies of one another in a chain, and of a base
        own = list(base)
        for j in rng.choice(60, i % 5, replace=False):
            own[j] = f"x{i}"
        more[100 + i] = " ".join(own)
        if i % 6 == 0:
            base[int(rng.integers(60))] = f"y{i}"
    docs = documents(spark, ids=set(TEXTS) - {5}, extra=[(i, t, "en", "s", 1, "k", "h", 1, "w") for i, t in more.items()])
    docs = docs.where("doc_id <> 5")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want, sizes = _components(texts)
    rows = jaccard_join.near_duplicates(docs, **options).collect()
    assert len(rows) == len(texts)
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == sizes


def test_stages_keep_one_of_each(spark):
    docs = documents(spark)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [0, 3, 4, 5, 5, 5, 6, 7, 8, 10, 11, 12, 13, 14, 16, None]))
    assert jaccard_join.keep_one(empty(spark)).count() == 0


def test_only_wanted_histograms_travel(spark, monkeypatch):
    """Every join of regions, even of none, shuffled the histograms of all sets."""
    sets = jaccard_join.shingle_sets(spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(40)) + f" {i}") for i in range(400)], "doc_id long, text string")).localCheckpoint()
    keys = [r.key for r in sets.orderBy("doc_id").select("key").collect()]
    regions = spark.createDataFrame([(1, keys[0]), (1, keys[1]), (2, keys[2])], "region long, key long")
    asked, held = [], jaccard_join._held
    monkeypatch.setattr(jaccard_join, "_held", lambda *args: asked.append((held(*args).count(), args[2:])) or held(*args))
    found = {frozenset(r) for r in jaccard_join._joined(regions, sets).collect()}
    assert found == {frozenset(keys[:2])}
    assert [column for _, column in asked] == [("sketch",), ()] and asked[0][0] < 10 and asked[1][0] < 10


def test_histograms_never_lose_a_partner():
    rng = np.random.default_rng(1)
    for n in (1, 4, 30, 37, 300, 1200, 5000):
        own = rng.integers(0, 2**64, n, dtype=np.uint64)
        other = np.concatenate([own[: n - n // 10], rng.integers(0, 2**64, n // 10, dtype=np.uint64)])
        sets = [np.unique(own), np.unique(other)]
        both = len(np.intersect1d(*sets))
        if 100 * both >= 80 * (len(sets[0]) + len(sets[1]) - both):
            assert jaccard_join.may_link(np.array([len(s) for s in sets]), [jaccard_join.sketch(s) for s in sets]).all()


def test_fingerprints(spark):
    docs = documents(spark, ids=set(TEXTS) - {5}).where("doc_id <> 5 or doc_id is null")
    rows = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(docs).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    order = sorted((i for i in texts if i is not None), reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    space = "[ \t-\r]+"
    for i, text in texts.items():
        r, k = rows[i], len(text) // 3
        edited = text[: len(text) - k] + (texts[following[i]][:k] if i is not None else "")
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if len(re.split(space, text)) > 50:
            a, b = shingles(text.lower()), shingles(edited.lower())
            assert abs(r["near_edited"] - len(a & b) / len(a | b)) < 0.2
    assert rows[0]["fingerprint"] == rows[1]["fingerprint"] and rows[1]["near_next"] == 1.0
    assert rows[3]["fingerprint"] == rows[4]["fingerprint"] == "" and rows[4]["near_next"] == 1.0 and rows[3]["near_next"] < 0.5
    assert all(len(r["fingerprint"]) == 256 for i, r in rows.items() if shingles(texts[i]))
    assert fingerprints.edited_fingerprints(empty(spark)).count() == 0
    one = fingerprints.edited_fingerprints(docs.where("doc_id = 2")).first()
    assert one["near_next"] == 1.0
    assert fingerprints.edited_fingerprints(documents(spark, ids={0})).count() == 4


def test_likeness_follows_jaccard(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    apart = []
    for r in fingerprints.edited_fingerprints(docs).collect():
        text = texts[r["doc_id"]]
        k = len(text) // 3
        a, b = shingles(text.lower()), shingles((text[: len(text) - k] + texts[following[r["doc_id"]]][:k]).lower())
        apart.append(abs(r["near_edited"] - len(a & b) / len(a | b)))
    assert sum(apart) / len(apart) < 0.05
