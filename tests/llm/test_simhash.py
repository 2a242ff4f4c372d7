import re

import numpy as np
import pytest
import xxhash

from sparkrec.llm import simhash
from sparkrec.llm.components import connected


def slow_fingerprint(text, words):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return 0
    parts = [" ".join(found[i:i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_roots(n, linked):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in linked:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def clustered(seed=1):
    rng = np.random.default_rng(seed)
    codes = list(map(int, rng.integers(0, 1 << 63, 150, dtype=np.uint64)))
    for x in codes[:20]:
        for _ in range(60):
            for b in rng.integers(0, 64, rng.integers(1, 6)):
                x ^= 1 << int(b)
            codes.append(x)
            x = codes[rng.integers(0, 20)] if rng.random() < 0.5 else x
    return np.unique(np.array(codes, np.uint64))


@pytest.mark.parametrize("words", [3, 5])
def test_fingerprints(words, odd_docs, small_docs):
    for r in [*odd_docs.filter("length(text) < 10000 OR text IS NULL").collect(), *small_docs.limit(40).collect()]:
        assert simhash.fingerprint(r.text, words) == slow_fingerprint(r.text, words)
        assert simhash.fingerprint(r.text, words, block=7) == simhash.fingerprint(r.text, words)


@pytest.mark.parametrize("chunk", [20_000, 37])
@pytest.mark.parametrize("masks", [None, simhash.band_masks(3)])
def test_links_connect_what_brute_force_connects(spark, chunk, masks):
    codes = clustered()
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 3
    want = slow_roots(len(codes), zip(*np.nonzero(np.triu(near, 1))))
    signed = [int(x) for x in codes.view(np.int64)]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    root = {r.node: r.root for r in connected(simhash.links(df, 3, chunk, masks)).collect()}
    groups, mine = {}, {}
    for i, x in enumerate(signed):
        groups.setdefault(want[i], set()).add(x)
        mine.setdefault(root.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 200)] + [(300, 300), (7, 7), (400, 401), (401, 400)]
    root = {r.node: r.root for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert root == {**{i: 0 for i in range(1, 51)}, **{i: 100 for i in range(101, 200)}, 401: 400}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_label_on_odd_rows(odd_docs, no_docs):
    got = simhash.label(odd_docs, words=3)
    rows = got.collect()
    assert len(rows) == odd_docs.count() and got.columns == ["doc_id", "fingerprint", "component_id"]
    of = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert of[2].fingerprint == of[3].fingerprint == "0" * 16 and of[2].component_id == of[4].component_id == 2
    assert of[8].component_id == 1
    assert simhash.label(no_docs).count() == 0


def test_near_copies_are_verified(spark, no_docs):
    words = [f"w{i}" for i in range(200)]
    near = words[:100] + ["other"] + words[101:]
    far = words[:100] + [f"v{i}" for i in range(100)]
    docs = spark.createDataFrame(
        [(3, " ".join(words)), (2, " ".join(near)), (4, " ".join(far)), (5, None), (6, ""), (2, " ".join(near))], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [2, 4, 5]
    assert simhash.keep_one(no_docs).count() == 0


def kept_by_force(docs, words=5, least=0.8):
    """Smallest ids of the groups that all pairs of texts make."""
    docs = sorted(docs)
    sets = [simhash.shingles(t or "", words) for _, t in docs]
    near = [(i, j) for i, s in enumerate(sets) for j, t in enumerate(sets[:i]) if len(s & t) / len(s | t) >= least]
    return [docs[i][0] for i, r in enumerate(slow_roots(len(docs), near)) if i == r]


def copies_at_the_edge(n=60, seed=3):
    """Texts of 40 to 400 words, each with a copy of similarity just above and just below 0.8."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        text = [f"t{i}w{j}" for j in range(rng.integers(40, 400))]
        size = len(text) - 4
        for over in (True, False):
            cut = int(size * 0.2)  # a shorter text: similarity is the share that is left
            end = len(text) - cut if over else len(text) - cut - max(2, size // 50)
            out.append((i * 10 + over + 1, " ".join(text[:end])))
        out.append((i * 10, " ".join(text)))
        other = list(text)
        for j in range(0, len(text), 50):  # about a fifth of the shingles of both goes
            other[j] = f"x{i}{j}"
        out.append((i * 10 + 3, " ".join(other)))
    return out


def test_near_copies_are_all_found(spark):
    docs = copies_at_the_edge()
    got = simhash.keep_one(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r.doc_id for r in got.collect()) == kept_by_force(docs)


@pytest.mark.parametrize("edges", [[], [(0, 1)]])
def test_failed_or_missing_candidates_lose_no_link(spark, monkeypatch, edges):
    """A tree whose only edge fails verification, or no tree at all, leaves the true links to the exact join."""
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base), " ".join(f"v{i}" for i in range(200)), " ".join(base[:100] + ["other"] + base[101:])]
    codes = [int(np.array([simhash.fingerprint(t)], np.uint64).view(np.int64)[0]) for t in texts]
    tree = spark.createDataFrame([(codes[i], codes[j]) for i, j in edges], "u long, v long")
    monkeypatch.setattr(simhash, "links", lambda *a, **b: tree)
    got = simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r.doc_id for r in got.collect()) == [0, 1]


def test_equal_fingerprints_are_verified(spark):
    texts = ["buy now and save today " * 100 + " ".join(f"{c}{i}" for i in range(60)) for c in "ab"]
    assert simhash.fingerprint(texts[0]) == simhash.fingerprint(texts[1])
    docs = [(0, texts[0]), (1, texts[1]), (2, texts[1].upper()), (3, texts[1].rsplit(" ", 2)[0])]
    got = simhash.keep_one(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r.doc_id for r in got.collect()) == kept_by_force(docs) == [0, 1]


def test_cells_never_part_sets_that_share_enough():
    rng = np.random.default_rng(3)
    sets = []
    for size in (1, 5, 40, 300, 3000):
        base = np.unique(rng.integers(0, 1 << 63, size, dtype=np.int64).view(np.uint64))
        for kept in (1.0, 0.95, 0.9, 0.5):
            other = rng.integers(0, 1 << 63, max(1, int(size * (1 - kept))), dtype=np.int64).view(np.uint64)
            sets.append(np.unique(np.concatenate([base[:max(1, int(size * kept))], other])))
    sets.append(np.arange(100_000, dtype=np.uint64))  # all in one full cell
    cells = np.frombuffer(b"".join(simhash.cell_counts(s) for s in sets), np.uint8).reshape(-1, simhash.CELLS)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    shared = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b)])
    assert simhash.may_share(cells, a, b, shared).all()
    assert not simhash.may_share(cells, np.array([15]), np.array([12]), np.array([280])).any()


def test_sets_that_share_a_token_put_out_no_square_of_pairs():
    import pandas as pd

    rng, out = np.random.default_rng(5), {}
    for n in (200, 400):
        sets = [np.unique(np.append(rng.integers(1, 1 << 63, 100, dtype=np.int64).view(np.uint64), np.uint64(7))) for _ in range(n)]
        rows = pd.DataFrame({"token": 7, "pair": 0, "sid": np.arange(n), "pos": 0, "size": [len(s) for s in sets],
                             "root": np.arange(n), "cells": [simhash.cell_counts(s) for s in sets]}).sort_values("size")
        out[n] = sum(len(p) for p in simhash._set_pairs(rows, 0.8))
    assert out[200] <= 200 and out[400] <= 400
