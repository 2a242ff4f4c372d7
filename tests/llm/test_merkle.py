import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sparkrec.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def lower(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def steps(levels, at):
    for now in levels[:-1]:
        low = at // 16 * 16
        yield "".join(now[low:at]), "".join(now[at + 1:low + 16])
        at //= 16


def slow(rows):
    """Rows (doc_id, source, lang, n_chars, text) as the contract tells them."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for place, (_, _, own, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            path = [*steps(trees[s], place), *steps(top, at)]
            changed = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0
            fold = leaf(r, lower(r[4])) if changed else own
            for a, b in path:
                fold = h(a, fold, b)
            out.append((r[0], own, trees[s][-1][0], top[-1][0], h(*[a + b for a, b in path]), fold, fold == top[-1][0]))
    return sorted(out, key=repr)


def got(docs, **more):
    return sorted((tuple(r) for r in merkle.label(docs, **more).collect()), key=repr)


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def test_odd_rows_equal_brute_force(odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select(*COLUMNS).collect()]
    assert got(odd_docs) == slow(rows)
    assert got(no_docs) == []


def test_only_leaf(spark):
    one = spark.createDataFrame([(7, None, "en", 2, "Ab")], "doc_id long, source string, lang string, n_chars int, text string")
    assert got(one) == slow([(7, None, "en", 2, "Ab")])
    assert merkle.label(one).first().proof_sha256 == h()


def test_many_chunks_and_sources_equal_brute_force(spark):
    # a hot source of three chunks, one of a full chunk, 300 small ones in three levels
    hot = [(i, "hot", "en", 3, f"Text {i}") for i in range(9000)]
    full = [(20_000 + i, "full", None, None, f"{i}") for i in range(merkle.CHUNK)]
    small = [(40_000 + i, f"s{i % 300}", "fr", i, "Ü" * (i % 3)) for i in range(700)]
    rows = hot + full + small
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string").repartition(7)
    want = slow(rows)
    assert got(docs, chunk_rows=1000) == want
    assert got(docs, chunk_rows=100_000) == want  # another number of blocks, the same proofs
    assert sum(not r[-1] for r in want) > 1000


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 5000])
def test_missing_nodes_are_enough_and_all_needed(n):
    rng = random.Random(n)
    levels = tree([h(str(i)) for i in range(n)])
    for held in [set(range(n)), {0}, {n - 1}, set(rng.sample(range(n), min(n, 40)))]:
        lacking = merkle.missing(held, n)
        nodes = merkle.Nodes()
        nodes.at.update({("t", 0, i): levels[0][i] for i in held} | {("t", k, i): levels[k][i] for k, i in lacking})
        assert nodes.derive("t", held, n) == levels[-1][0]
        for i in held:
            assert nodes.path("t", i, n) == list(steps(levels, i))
        derivable = {(k, i >> 4 * k) for i in held for k in range(len(levels))}
        assert len(set(lacking)) == len(lacking) and not derivable & set(lacking)
        for gone in lacking[:5]:
            less = merkle.Nodes()
            less.at.update({("t", 0, i): levels[0][i] for i in held} | {("t", k, i): levels[k][i] for k, i in lacking if (k, i) != gone})
            with pytest.raises(KeyError):
                less.derive("t", held, n)


def test_another_rule_for_tampering(small_docs):
    assert all(r.verified for r in merkle.label(small_docs, F.lit(False)).collect())
    changed = merkle.label(small_docs, F.lit(True)).filter("NOT verified").count()
    assert changed == small_docs.filter("text RLIKE '[A-Z]'").count()
