"""Exact top-k by integer inner product, with a bit-sliced index.

Vectors become integers floor(scale * x). Rows are dealt into blocks by hash; a block keeps, for every
component, bitmaps over its rows: one per binary digit of the component's distance from
the block's least value, without the `DROP` lowest digits. A query adds these slices, once for
each binary digit of its own components, with carry-save bitmap arithmetic: three
bitmaps of one weight give a sum and a carry bitmap, for all rows at once. (Slices
of components with a negative factor are complemented.) The result is the score of all rows as
slices. The k best rows are selected from the most significant slice downward; the dropped
digits leave a known margin, and every row within it of the k-th row is a
boundary row, which the stored integers resolve exactly.

Queries are gathered in batches; batches and blocks meet by key, each pair in one bounded
group, and hand on k rows per query.

Defined results: vectors that are NULL or hold NULL or non-finite components, and rows without an id,
take no part; shorter vectors count as zero beyond their end; a row is never a candidate of
a query with its own id; equal scores go to the smaller id, then any; fewer candidates
than k give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sparkrec.session import durable

SCALE, DROP = 256, 2
BLOCK, BATCH = 16_384, 512  # rows in a block, queries in a batch
INDEX = "block long, dims int, low long, digits int, ids binary, ints binary, slices binary"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, ints, rid) of the vectors that take part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return durable(
        vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
        .select(F.col("vec_id").cast("long"), F.transform(x, lambda v: F.floor(scale * v.cast("double"))).alias("ints"),
                F.monotonically_increasing_id().alias("rid")))


def _matrix(lists, dims: int = 0) -> np.ndarray:
    dims = max([dims, *map(len, lists)])
    out = np.zeros((len(lists), dims), np.int64)
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    """Bitmaps over the last axis, as 64-bit words."""
    some = np.packbits(bits, axis=-1, bitorder="little")
    pad = -some.shape[-1] % 8
    return np.pad(some, [(0, 0)] * (some.ndim - 1) + [(0, pad)]).view(np.uint64)


def build_block(rows: pd.DataFrame, drop: int = DROP) -> pd.DataFrame:
    """The index of one block."""
    ints = _matrix(rows["ints"].tolist())
    low = int(ints.min()) if ints.size else 0
    above = (ints - low) >> drop
    digits = max(1, int(above.max()).bit_length()) if ints.size else 1
    slices = _packed(np.stack([(above >> s & 1).astype(bool).T for s in range(digits)], 1)) if ints.size else np.zeros(0, np.uint64)
    return pd.DataFrame([(rows["block"].iloc[0], ints.shape[1], low, digits, rows["vec_id"].to_numpy(np.int64).tobytes(),
                          ints.tobytes(), slices.tobytes())],
                        columns=["block", "dims", "low", "digits", "ids", "ints", "slices"])


def add_bitmaps(weighted: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Slices of the sum: weighted[w] holds stacks of bitmaps that count 2**w each."""
    out, w = [], 0
    piles = [[p for p in ps if len(p)] for ps in weighted]
    while w < len(piles):
        pile = np.concatenate(piles[w]) if len(piles[w]) > 1 else (piles[w][0] if piles[w] else None)
        if pile is None:
            out.append(None)
            w += 1
            continue
        while len(pile) > 1:
            if w + 1 == len(piles):
                piles.append([])
            if len(pile) == 2:
                piles[w + 1].append(pile[:1] & pile[1:])
                pile = pile[:1] ^ pile[1:]
                break
            n = len(pile) // 3
            a, b, c = pile[:n], pile[n:2 * n], pile[2 * n:3 * n]
            t = a ^ b
            piles[w + 1].append((a & b) | (t & c))
            pile = np.concatenate([t ^ c, pile[3 * n:]])
        out.append(pile[0])
        w += 1
    return out


def _rows_of(bitmap: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:n])


class Block:
    """A block of the index, opened for queries."""

    def __init__(self, row, drop: int = DROP):
        self.ids = np.frombuffer(row.ids, np.int64)
        n, self.drop = len(self.ids), drop
        self.ints = np.frombuffer(row.ints, np.int64).reshape(n, row.dims)
        self.low, self.digits = row.low, row.digits
        words = -(-n // 64)
        self.slices = np.frombuffer(row.slices, np.uint64).reshape(row.dims, row.digits, words)
        self.all = _packed(np.ones(n, bool))

    def score_slices(self, q: np.ndarray) -> list[np.ndarray]:
        """Bitmaps of sum |q_d| * v_d, v_d being the sliced component or, for q_d < 0, its complement."""
        size, neg = np.abs(q), q < 0
        top = int(size.max()).bit_length() if len(q) else 0
        piles: list[list[np.ndarray]] = [[] for _ in range(max(1, top + self.digits))]
        for j in range(top):
            on = size >> j & 1 == 1
            plus, minus = self.slices[on & ~neg], self.slices[on & neg]
            for s in range(self.digits):
                piles[j + s] += [plus[:, s], ~minus[:, s]]
        return add_bitmaps(piles)

    def candidates(self, q: np.ndarray, own: int, k: int) -> np.ndarray:
        """Rows that may be among the k best: the selected ones and the boundary."""
        q = np.concatenate([q, np.zeros(max(0, self.ints.shape[1] - len(q)), np.int64)])[:self.ints.shape[1]]
        mine = self.ids == own
        live = self.all & ~_packed(mine) if mine.any() else self.all
        n = len(self.ids)
        if n - mine.sum() <= k:
            return _rows_of(live, n)
        slices = self.score_slices(q)
        sure, tied, kth, count = np.zeros_like(live), live, 0, 0
        for w in range(len(slices) - 1, -1, -1):  # the k-th best value, digit by digit
            bits = slices[w] & tied if slices[w] is not None else np.zeros_like(tied)
            more = int(np.bitwise_count(bits).sum())
            if count + more >= k:
                tied, kth = bits, kth | 1 << w
            else:
                sure, count, tied = sure | bits, count + more, tied & ~bits
        # digits below the slices change a score by at most this many units of the last slice
        slack = (2 ** self.drop - 1) * int(np.abs(q).sum()) // 2 ** self.drop + 1
        return _rows_of(at_least(slices, max(0, kth - slack), live), n)

    def best(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows."""
        rows = self.candidates(q, own, k)
        width = min(len(q), self.ints.shape[1])
        scores = self.ints[rows, :width] @ q[:width]
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][order], scores[order]


def at_least(slices: list[np.ndarray], bound: int, live: np.ndarray) -> np.ndarray:
    """Rows whose sliced value is `bound` or more."""
    above, equal = np.zeros_like(live), live
    for w in range(max(len(slices), bound.bit_length()) - 1, -1, -1):
        bits = slices[w] if w < len(slices) and slices[w] is not None else np.zeros_like(live)
        if bound >> w & 1:
            equal = equal & bits
        else:
            above, equal = above | (equal & bits), equal & ~bits
    return above | equal


def build_index(rows: DataFrame, blocks: int, drop: int = DROP) -> DataFrame:
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "rid"), F.lit(blocks)))
    return durable(dealt.groupBy("block").applyInPandas(lambda g: build_block(g, drop), INDEX))


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: int = SCALE, drop: int = DROP, block: int = BLOCK,
          batch: int = BATCH) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best other rows."""
    rows = quantised(vectors, scale)
    asked = durable(rows.filter(is_query))
    blocks, batches = 1 + rows.count() // block, 1 + asked.count() // batch
    index = build_index(rows, blocks, drop).withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1)).cast("array<long>")))
    queries = asked.withColumn("batch", F.pmod(F.xxhash64("rid"), F.lit(batches))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))

    def search(asked: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in index.itertuples():
            opened = Block(row, drop)
            for q in asked.itertuples():
                ids, scores = opened.best(np.asarray(q.ints, np.int64), q.vec_id, k)
                out.append(pd.DataFrame({"query_id": q.vec_id, "rid": q.rid, "vec_id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "rid", "vec_id", "score")})

    found = queries.groupBy("batch", "block").cogroup(index.groupBy("batch", "block")).applyInPandas(
        search, "query_id long, rid long, vec_id long, score long")
    place = F.row_number().over(W.partitionBy("query_id", "rid").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
