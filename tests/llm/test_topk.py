"""Exact top-k against all products."""

import math

import numpy as np
import pytest

from plumbline.llm import topk


def brute(rows, every, k):
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in x]) for i, x in rows
            if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = {}
    for i, x in kept:
        if i % every == 0:
            scored = [(-sum(a * b for a, b in zip(x, y, strict=True)), j) for j, y in kept if j != i and len(x) == len(y)]
            out.setdefault(i, set()).update(scored)
    return {(i, rank + 1, j, -s) for i, v in out.items() for rank, (s, j) in enumerate(sorted(v)[:k])}


def run(spark, rows, every=5, k=5):
    frame = spark.createDataFrame([(i, x, "x", 1.0) for i, x in rows], "vec_id bigint, embedding array<float>, score string, length double")
    vectors = topk.quantised(frame)
    return {tuple(r) for r in topk.top_k(vectors, vectors.where(f"vec_id % {every} = 0"), k).collect()}


@pytest.mark.parametrize("spread", ["unit", "skewed", "clustered"])
def test_all_products(spark, spread, monkeypatch):
    monkeypatch.setattr(topk, "BUCKET_ROWS", 37)
    monkeypatch.setattr(topk, "QUERY_ROWS", 30)
    monkeypatch.setattr(topk, "TILE_ROWS", 50)
    monkeypatch.setattr(topk, "STRIP", 7)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 8))
    if spread == "skewed":
        x *= rng.pareto(1.0, (600, 1)) + 0.1
    if spread == "clustered":
        x = x[rng.integers(0, 6, 600)] + 0.05 * rng.normal(size=x.shape)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    assert run(spark, rows) == brute(rows, 5, 5)


def test_odd_rows(spark):
    rows = [(0, [0.1, 0.2]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [0.0, 0.0]),
            (6, [0.1, 0.2]), (7, [0.1, 0.2]), (8, [-1.0, -3.0]), (None, [5.0, 5.0]), (10, [1.0, 2.0, 3.0]), (9, [0.1, 0.2]),
            (15, []), (16, []), (20, []), (25, [0.3, 0.1]), (25, [0.2, -0.1])]
    assert run(spark, rows) == brute(rows, 5, 5)
    assert run(spark, [(5, []), (1, [1.0])]) == set()
    assert run(spark, []) == set()
    assert run(spark, [(0, [1.0])]) == set()
