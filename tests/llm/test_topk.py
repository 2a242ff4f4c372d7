import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrec.llm import topk


def slow(rows, k, every):
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in vectors:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("drop,block,batch", [(2, 64, 3), (0, 1000, 100), (5, 30, 2)])
def test_equals_brute_force(spark, drop, block, batch):
    rng = np.random.default_rng(drop)
    rows = [(i, rng.normal(0, 0.2, 8).round(2 if i % 3 else 1).tolist()) for i in range(200)]
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, None), (503, [None] * 8), (504, [float("nan")] * 8), (505, [float("inf")] * 8),
             (None, rows[0][1]), (510, [0.5, 0.5]), (520, []), (530, [3.7] * 8)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, block string, rid int")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k=5, drop=drop, block=block, batch=batch)
    assert sorted(tuple(r) for r in got.collect()) == slow(exact, 5, 10)


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (2, [0.5])], schema)
    assert sorted(tuple(r) for r in topk.top_k(one, F.col("vec_id") == 0, 5).collect()) == [(0, 1, 1, 32768), (0, 2, 2, 32768)]
    assert topk.top_k(spark.createDataFrame([], schema), F.col("vec_id") == 0, 5).count() == 0


def test_bitmap_sums():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 8, (20, 64))
    bitmaps = topk._packed(np.stack([(values >> s & 1).astype(bool) for s in range(3)], 1))
    slices = topk.add_bitmaps([[bitmaps[:, s]] for s in range(3)])
    bits = [np.unpackbits(s.view(np.uint8), bitorder="little") if s is not None else np.zeros(64, np.uint8) for s in slices]
    assert (sum(b.astype(int) << w for w, b in enumerate(bits)) == values.sum(0)).all()
