import re
from collections import Counter

import pytest

import corpus_pipeline
from sparkrec.llm import simhash
from sparkrec.session import durable
from test_packing import check


@pytest.fixture(scope="module")
def stages(spark, small_docs):
    """Each stage's input and output, stored."""
    docs, out = durable(small_docs), {}
    for name, stage in corpus_pipeline.STAGES:
        made = durable(stage(spark, docs, "/root/testdata/sf0.001"))
        out[name] = (docs, made)
        docs = made
    return out


def test_order_and_columns(stages, small_docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "pack_sequences"]
    assert all(stages[n][1].columns == small_docs.columns for n in list(stages)[:-1])


def test_language_keeps_texts_with_letters(stages):
    before, after = stages["language_id"]
    assert after.count() == before.filter(r"text rlike '\\p{L}'").count()


def test_exact_leaves_one_of_each(stages):
    before, after = stages["exact_dedup"]

    def form(r):
        return re.sub(r"[\x20\x09-\x0D]", "", r.text or "")

    assert Counter(map(form, after.collect())) == Counter({f: 1 for f in map(form, before.collect())})


def test_near_drops_only_near_copies(stages):
    before, after = stages["near_dedup"]
    kept = {r.doc_id for r in after.collect()}
    sets = {r.doc_id: simhash.shingles(r.text, 5) for r in before.collect()}
    for gone in set(sets) - kept:
        best = max(len(sets[gone] & s) / len(sets[gone] | s) for i, s in sets.items() if i != gone)
        assert best >= 0.8


def test_mix_and_pack(stages):
    before, after = stages["mix_sources"]
    times = Counter(r.doc_id for r in after.collect())
    assert max(times.values()) <= 2 and set(times) <= {r.doc_id for r in before.select("doc_id").collect()}
    docs, packed = stages["pack_sequences"]
    used, least = check(packed.collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert used <= least + 2


def test_odd_rows_pass_all_stages(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        rows = docs.count()
        docs = durable(docs)
        for _, stage in corpus_pipeline.STAGES:
            docs = durable(stage(spark, docs, ""))
        assert (docs.count() > 0) == (rows > 0)
