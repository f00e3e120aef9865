"""Joins with heavy keys and numbering."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.llm import common


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize(("rows", "keys"), [(1000, 5), (3, 100), (3, 2), (1, 1)])
def test_heavy_keys_join_like_others(spark, monkeypatch, how, rows, keys):
    monkeypatch.setattr(common, "HEAVY_KEYS", keys)
    random.seed(1)
    left = [(random.choice(["a"] * 9 + ["b"] * 5 + ["c", "d", "e", None]), i % 7, "t") for i in range(200)]
    counts = {k: sum(r[0] == k for r in left) for k in "abcz"}
    right = [(k, k * 2, n) for k, n in counts.items()]
    frame = spark.createDataFrame(left, "key string, v int, text string")
    facts = spark.createDataFrame(right, "key string, twice string, n bigint")
    got = common.join_with_heavy_keys(frame, facts, "key", "n", rows, how)
    assert got.columns == ["key", "v", "text", "twice"]
    want = [(k, v, t, k * 2 if k and k in "abc" else None) for k, v, t in left if how == "left" or (k and k in "abc")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_numbered(spark):
    rows = [(random.randrange(5), i) for i in range(300)] + [(2, 1)] * 50
    got = common.numbered(spark.createDataFrame(rows, "a int, b int"), F.desc("a"), F.asc("b")).collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.position)] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert sorted(r.position for r in got) == list(range(350))
    assert common.numbered(spark.createDataFrame([], "a int"), F.asc("a")).count() == 0
