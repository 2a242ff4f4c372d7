import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrec.llm import exact, fuse


def slow_groups(rows):
    groups = defaultdict(list)
    for at, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, at))
    return groups


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 30_000])
def test_filters_hold_their_keys(n):
    keys = np.random.default_rng(n).integers(0, 1 << 62, n)
    made = fuse.build(np.concatenate([keys, keys[:5]]))
    assert made.contains(keys).all()
    others = np.random.default_rng(n + 1).integers(0, 1 << 62, 20_000) | (1 << 62)
    assert made.contains(others).mean() < 0.02
    assert n < 10_000 or len(made.slots) < 1.6 * n


@pytest.mark.parametrize("bits", [256, 8])
def test_label_equals_brute_force(spark, odd_docs, small_docs, bits):
    docs = odd_docs.select("doc_id", "text").union(small_docs.select("doc_id", "text"))
    got = exact.label(docs, bits=bits).collect()
    rows = [tuple(r) for r in docs.collect()]
    groups = slow_groups(rows)
    assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)
    want = sorted((rows[m[3]][0], rows[min(g)[3]][0], len(g)) for g in groups.values() for m in g if m[2] or not m[1])
    mine = [(r.doc_id, r.keep_id, r.group_size) for r in got]
    assert sorted(map(str, mine)) == sorted(str((rows[m[3]][0], rows[min(g)[3]][0], len(g))) for g in groups.values() for m in g)
    assert len(want) <= len(mine)
    if bits == 256:
        assert all(re.fullmatch("[0-9a-f]{64}", r.text_sha256) for r in got)


def test_keep_one_keeps_whole_rows(odd_docs):
    kept = exact.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert kept.count() == len(slow_groups(rows))
    assert kept.filter("doc_id = 8").count() == 1 and kept.filter("doc_id IN (1, 10)").count() == 0  # the longest stays


def test_all_snapshot_or_all_incoming(small_docs):
    def plain(df):
        return sorted(tuple(r) for r in df.collect())

    old, new = exact.label(small_docs, F.lit(True)), exact.label(small_docs, F.lit(False))
    assert plain(old) == plain(new) == plain(exact.label(small_docs))


def test_empty(no_docs):
    assert exact.label(no_docs).count() == 0 and exact.keep_one(no_docs).count() == 0
