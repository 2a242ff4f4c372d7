import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparkrec.llm import variants


def one_edit(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow_words(rows, every=199):
    count = Counter()
    for doc_id, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def slow_near(words):
    """Near words by the letters that are left when one is taken out; every pair is looked at again."""
    holes = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for rest, group in holes.items():
        for a in group | ({rest} if rest in words else set()):
            near[a] |= {b for b in group | ({rest} if rest in words else set()) if one_edit(a, b)}
    return near


def slow(words, ratio=5):
    near, form = slow_near(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_given_and_odd_documents_equal_brute_force(small_docs, odd_docs, no_docs):
    for docs in (small_docs, odd_docs):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        assert plain(variants.group(docs)) == slow(slow_words(rows))
    assert plain(variants.group(no_docs)) == []


def made_words(seed):
    """Few letters, so that buckets are large, words repeat letters, and chains of forms are long."""
    rng, words = random.Random(seed), {}
    for _ in range(1500):
        words["".join(rng.choice("abÀé" if seed else "ab") for _ in range(rng.randint(6, 9)))] = rng.choice([5, 6, 30, 150, 900])
    base = "chain" * 4
    for i in range(9):
        words[base[:i] + "é" + base[i + 1:] if i else base] = 5 * 6 ** i
    words["z" * 3000], words["z" * 2999], words["z" * 1500 + "y" + "z" * 1499] = 40, 7, 8
    return words


@pytest.mark.parametrize("seed,bucket,block", [(0, 4000, 50_000), (0, 20, 300), (1, 3, 100_000), (1, 60, 1000)])
def test_buckets_of_any_size_lose_and_repeat_nothing(spark, seed, bucket, block):
    words = made_words(seed)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best, r.best_n) for r in variants.near_words(frame, bucket, block).collect()}
    near = slow_near(words)
    want = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda o: (-words[o], o))
            want[w] = (len(near[w]), best, words[best])
    assert got == want


def test_hot_buckets_are_split(spark):
    frame = spark.createDataFrame(list(made_words(0).items()), "word string, n long")
    frames = variants.buckets(frame, 10)
    assert len(frames) > 1
    for f in frames:
        large = f.groupBy("key", "ls", "p", "q").count().filter("count > 10")
        assert large.filter("ls - p - q > 1").count() == 0


def test_roots_follow_long_chains(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(40)] + [("v", "w3")]
    got = dict(tuple(r) for r in variants.roots(spark.createDataFrame(links, "word string, form string")).collect())
    assert got == {w: "w40" for w, _ in links}


def test_letters_taken_out_follow_the_checksum(spark):
    rows = [(i, "naïveté Street") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: r.n for r in docs.select("doc_id", F.explode(F.split("text", " ")).alias("run")).select(
        variants.thinned(F.col("doc_id"), F.lower("run"), 3).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    want = Counter()
    for i, text in rows:
        for run in text.lower().split():
            h = zlib.crc32(f"{i}:{run}".encode())
            want[run if h % 3 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    assert got == want
