"""Spelling variants: words one edit apart, by dynamic programming over sorted word lists.

The vocabulary is counted over all texts. Two words one edit apart share, of the shorter one's
letters, either the first half or the last half; so each word goes into the bucket of its first
and of its last half, for its own length and as the longer word of a pair. A bucket above
`BUCKET` words is split again by halves of what its words need not share, so that no bucket
grows with the vocabulary: at the end one letter is left open.

A block of buckets is one sorted list. All its words scan it together: the list is walked by
shared prefixes (adjacent words resume the edit-matrix row at their longest common prefix, so a
row is reckoned once per shared prefix), rows are banded to three columns, and a range of words
is skipped as soon as no entry of the row of its shared prefix is below two. A pair is reported
by one bucket only, so buckets put out one row per word: how many near words, and the best one.

Defined results: NULL and empty texts have no words; a NULL id counts as empty text in the
hash; repeated rows count each; ties of frequency go to the smaller word in code-point order;
texts and words of any length are read whole; an empty table gives an empty result; columns
other than doc_id and text, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.llm.common import lowered, text_of
from sparkrec.session import durable

RUN = r"[A-Za-zÀ-ÿ]+"  # fixed value: letters of the contract
THINNED = 199
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
BUCKET = 4_000
BLOCK = 50_000
QUERIES = 2_048  # words that scan a list at the same time
FAR = 2  # stands for every distance above one

BUCKET_ROWS = "key string, word string, n long, ls int, p int, q int, x int"


def thinned(doc_id: Column, run: Column, every: int = THINNED) -> Column:
    """The run, without one letter where `every` divides the checksum of id and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    short = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))
    return F.when(h % every == 0, short).otherwise(run)


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): every word of enough letters that occurs often enough."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lowered(text_of()), F.lit(RUN), 0)).alias("run"))
    words = runs.select(thinned(F.col("doc_id"), F.col("run")).alias("word")).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """`rows` with their bucket: length, and the first p and last q letters that its words share."""
    word, p, q = F.col("word"), F.col("p"), F.col("q")
    key = F.concat_ws(":", "ls", "p", "q", word.substr(F.lit(1), p), F.right(word, q))
    return rows.select(key.alias("key"), "word", "n", "ls", "p", "q", "x")


def _halved(rows: DataFrame) -> DataFrame:
    """Both halves of what the words of each bucket need not share.

    x: pairs that share the first x letters belong to a bucket of first halves.
    """
    open_letters = F.col("ls") - F.col("p") - F.col("q")
    half = F.shiftright(open_letters, 1)
    first = F.struct((F.col("p") + half).alias("p"), F.col("q").alias("q"), F.col("x").alias("x"))
    last = F.struct(F.col("p").alias("p"), (F.col("q") + open_letters - half).alias("q"), (F.col("p") + half).alias("x"))
    return _keyed(rows.select("word", "n", "ls", F.explode(F.array(first, last)).alias("s")).select("word", "n", "ls", "s.*"))


def buckets(words: DataFrame, limit: int = BUCKET) -> list[DataFrame]:
    """Frames of whole buckets of two words and more, split until they hold at most `limit`."""
    length = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("ls"), F.lit(0).alias("p"), F.lit(0).alias("q"))
    now, done = _halved(rows.withColumn("x", F.col("ls") + 2)), []
    while True:
        now = durable(now)
        sizes = durable(now.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"))
        sized = now.join(sizes, "key")
        split = (F.col("size") > limit) & (F.col("ls") - F.col("p") - F.col("q") > 1)
        done.append(sized.filter(~split).drop("size"))
        if sizes.filter(F.col("size") > limit).isEmpty():
            return done
        now = _halved(sized.filter(split).drop("size"))


class SortedList:
    """Strings of several buckets, sorted by bucket and string; scanned by all of them at once."""

    def __init__(self, keys: list[str], strings: list[str]) -> None:
        n = len(strings)
        self.lens = np.fromiter(map(len, strings), np.int64, n)
        self.offs = np.concatenate([[0], np.cumsum(self.lens)])[:-1]
        self.codes = np.frombuffer("".join(strings).encode("utf-32-le") + bytes(4), np.uint32).astype(np.int64)
        self.lcp = np.fromiter((self._shared(keys, strings, i) for i in range(n)), np.int64, n)
        first = np.flatnonzero(self.lcp < 0)
        self.low = np.repeat(first, np.diff(np.append(first, n)))
        self.high = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))

    @staticmethod
    def _shared(keys: list[str], strings: list[str], i: int) -> int:
        """Longest common prefix with the string before; -1 where a bucket begins."""
        if i == 0 or keys[i] != keys[i - 1]:
            return -1
        a, b = strings[i - 1], strings[i]
        for at, (x, y) in enumerate(zip(a, b)):
            if x != y:
                return at
        return min(len(a), len(b))

    def _letter(self, row: np.ndarray, at: int) -> np.ndarray:
        """Letter of each row at a place, -1 outside."""
        inside = (self.lens[row] > at) & (at >= 0)
        return np.where(inside, self.codes[np.where(inside, self.offs[row] + at, 0)], -1)

    def near(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query row, row) of one bucket that are exactly one edit apart."""
        q, lo, hi = query, self.low[query], self.high[query]
        # edit-matrix row of the shared prefix of length d, at columns d - 1, d and d + 1
        before, here, after = np.full(len(q), FAR), np.zeros(len(q), np.int64), np.where(self.lens[q] > 0, 1, FAR)
        rows, depth, found = np.arange(len(self.lens)), 0, []
        while len(q):
            rows = rows[self.lens[rows] >= depth]
            starts = rows[self.lcp[rows] <= depth]
            a, b = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
            parent = np.repeat(np.arange(len(q)), b - a)
            child = np.arange(len(parent)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[parent]
            low = starts[child]
            high = np.where(child + 1 < b[parent], starts[np.minimum(child + 1, len(starts) - 1)], hi[parent])
            q, before, here, after = q[parent], before[parent], here[parent], after[parent]
            size = self.lens[q]
            ended = self.lens[low] == depth
            at_end = np.select([size == depth - 1, size == depth, size == depth + 1], [before, here, after], FAR)
            hit = ended & (at_end < FAR) & (low != q)
            found.append((q[hit], low[hit]))
            letter = self._letter(low, depth)
            row0 = np.minimum(before + (letter != self._letter(q, depth - 1)), here + 1)
            row0 = np.where(depth <= size, row0, FAR)
            row1 = np.minimum(np.minimum(here + (letter != self._letter(q, depth)), after + 1), row0 + 1)
            row1 = np.where(depth + 1 <= size, row1, FAR)
            row2 = np.minimum(after + (letter != self._letter(q, depth + 1)), row1 + 1)
            row2 = np.where(depth + 2 <= size, row2, FAR)
            go = ~ended & (np.minimum(np.minimum(row0, row1), row2) < FAR)
            q, lo, hi, before, here, after = q[go], low[go], high[go], row0[go], row1[go], row2[go]
            depth += 1
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _best(block: pd.DataFrame) -> pd.DataFrame:
    """One row per bucket and word with near words: how many, and the most frequent (then smallest) one."""
    middles = [w[p:len(w) - q] for w, p, q in zip(block["word"], block["p"], block["q"])]
    order = [i for _, _, i in sorted(zip(block["key"], middles, range(len(block))))]
    block = block.iloc[order]
    words = block["word"].to_numpy()
    scanned = SortedList(block["key"].tolist(), [middles[i] for i in order])
    ids: dict[str, int] = {}
    heads = np.fromiter((ids.setdefault(w[:x], len(ids)) for w, x in zip(words, block["x"])), np.int64, len(words))
    longer = block["word"].str.len().to_numpy() > block["ls"].to_numpy()
    covered = block["x"].to_numpy() <= block["ls"].to_numpy()
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(words.astype(object), kind="stable")] = np.arange(len(words))
    n = block["n"].to_numpy()
    out = []
    for start in range(0, len(words), QUERIES):
        a, b = scanned.near(np.arange(start, min(start + QUERIES, len(words))))
        own = ~(longer[a] & longer[b]) & ~(covered[a] & (heads[a] == heads[b]))
        a, b = a[own], b[own]
        by = np.lexsort((rank[b], -n[b], a))
        a, b = a[by], b[by]
        first = np.flatnonzero(np.diff(a, prepend=-1))
        out.append(pd.DataFrame({"word": words[a[first]], "n_near": np.diff(np.append(first, len(a))),
                                 "best_n": n[b[first]], "best": words[b[first]]}))
    return pd.concat(out)


def near_words(words: DataFrame, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best, best_n) of every word with near words."""
    frames = buckets(words, bucket)
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    rows = durable(rows)
    blocks = 1 + rows.count() // block
    found = rows.groupBy(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block")).applyInPandas(
        _best, "word string, n_near long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top")).select(
        "word", "n_near", F.col("top.best").alias("best"), (-F.col("top.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last. forms: (word, form), unique by word, without circles.

    Every round doubles the steps that are taken at once.
    """
    now = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = durable(now.select("word", "root").join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def group(docs: DataFrame, ratio: int = RATIO, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = durable(vocabulary(docs))
    met = words.join(near_words(words, bucket, block), "word", "left")
    often = F.col("best_n") >= ratio * F.col("n")
    met = durable(met.select(
        "word", F.when(often, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("best_n")).alias("form_n")))
    ends = roots(met.filter("form IS NOT NULL"))
    return met.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
