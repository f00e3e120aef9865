import hashlib
import math

import pytest
from pyspark.sql import functions as F

from plumbline.operators import split as S


def keys(n, seed=42):
    return sorted(range(n), key=lambda i: hashlib.md5(f"{seed}-{i}".encode()).hexdigest())


def test_holdout_is_exact_and_stable(spark):
    df = spark.range(1003).withColumnRenamed("id", "row_id")
    want = set(keys(1003)[:math.ceil(0.2 * 1003)])
    for parts in (1, 7):
        out = S.holdout_split(df.repartition(parts))
        assert {r["row_id"] for r in out.where("is_test").collect()} == want


def test_cut_keys_by_prefix_rounds(spark):
    df = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 3).alias("g")).withColumn(
        "k", S.order_key("row_id", 1))
    sizes = {0: 1667, 1: 1667, 2: 1666}
    cuts = {0: [1, 700, 1667], 2: [5]}
    found = S.cut_keys(df, "k", cuts, sizes, group="g", cell_rows=3)
    assert found == S.cut_keys(df, "k", cuts, sizes, group="g")
    own = sorted(hashlib.md5(f"1-{i}".encode()).hexdigest() for i in range(0, 5000, 3))
    assert found[(0, 700)] == own[699]


def test_contiguous_folds(spark):
    df = spark.range(23).select(F.col("id").alias("row_id")).withColumn("order_key", S.order_key("row_id", 42))
    folds = {r["row_id"]: r["fold"] for r in S.contiguous_folds(df, 5).collect()}
    assert [folds[i] for i in keys(23)] == [0] * 5 + [1] * 5 + [2] * 5 + [3] * 4 + [4] * 4


def test_stratified_folds_are_balanced(spark):
    labels = [0.0] * 11 + [1.0] * 30 + [2.0] * 3 + [3.0]
    df = spark.createDataFrame(list(enumerate(labels)), "row_id bigint, label double").withColumn(
        "order_key", S.order_key("row_id", 42))
    out = S.stratified_folds(df, "label", 5).collect()
    assert len(out) == len(labels)
    sizes = [sum(r["fold"] == f for r in out) for f in range(5)]
    assert max(sizes) - min(sizes) <= 1
    for c in set(labels):
        per = [sum(r["fold"] == f and r["label"] == c for r in out) for f in range(5)]
        assert max(per) - min(per) <= 1


def test_bad_sizes(spark):
    df = spark.range(3).withColumnRenamed("id", "row_id")
    with pytest.raises(ValueError):
        S.holdout_split(df, 1.0)
    with pytest.raises(ValueError):
        S.contiguous_folds(df.withColumn("order_key", S.order_key("row_id", 1)), 5)


def test_many_classes_with_one_large(spark, monkeypatch):
    """Only the large class is counted by prefix, and no collect holds more rows than classes times folds."""
    small, large = 2000, 30_000
    df = spark.range(small * 3 + large).select(
        F.col("id").alias("row_id"), F.when(F.col("id") < small * 3, F.col("id") % small).otherwise(small).cast("double").alias("label"))
    df = df.withColumn("order_key", S.order_key("row_id", 42)).persist()
    monkeypatch.setattr(S, "CELL_ROWS", 500)
    seen, real = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: seen.append(real(self)) or seen[-1])
    monkeypatch.setattr(S.cut_keys, "__defaults__", (None, 500))
    out = S.stratified_folds(df, "label", 5)
    assert max(map(len, seen)) <= (small + 1) * 5
    monkeypatch.undo()
    per = out.groupBy("label", "fold").count().groupBy("label").agg(F.max("count") - F.min("count"), F.count(F.lit(1))).collect()
    assert all(r[1] <= 1 for r in per) and out.count() == small * 3 + large
    keys_of = out.where("label = 2000").groupBy("fold").agg(F.min("order_key").alias("a"), F.max("order_key").alias("b")).orderBy("fold").collect()
    assert all(x["b"] < y["a"] for x, y in zip(keys_of, keys_of[1:]))
