from collections import Counter

from sparkrec.llm import mixing


def slow_targets(sizes, share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    open_, left, out = set(names), share * sum(sizes.values()), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > cap * sizes[s]]
        if not over:
            return out | {s: weight[s] * level for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def test_targets_and_copies(small_docs, odd_docs):
    for docs in (small_docs, odd_docs):
        got = mixing.label(docs).collect()
        assert len(got) == docs.count()
        of = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
        if docs is small_docs:
            sizes, taken = Counter(), Counter()
            for r in got:
                sizes[of[r.doc_id]] += r.size
                taken[of[r.doc_id]] += r.taken
            want = slow_targets(sizes)
            for r in got:
                assert r.source_size == sizes[of[r.doc_id]] and abs(r.target - want[of[r.doc_id]]) < 1e-6 * max(1, r.target)
            largest = max(r.size for r in got)
            assert all(abs(taken[s] - want[s]) <= largest for s in sizes)
        assert all(0 <= r.taken <= 2 * r.size for r in got)


def test_reruns_agree_in_any_order(small_docs):
    def plain(df):
        return sorted(tuple(r) for r in mixing.label(df).select("doc_id", "taken").collect())

    assert plain(small_docs) == plain(small_docs.repartition(5))


def test_mix_repeats_whole_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs)
    assert got.columns == odd_docs.columns
    assert mixing.mix(no_docs).count() == 0 and mixing.label(no_docs).count() == 0
