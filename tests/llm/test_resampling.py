"""Importance resampling: weights by hand, the exact top-k, and odd rows."""

import math
import random

import numpy as np
import pytest

from plumbline.llm import resampling


def corpus(n=400):
    random.seed(4)
    words = "this that there with from other which where about".split()
    rows, labels = [], []
    for i in range(n):
        body = random.choices(words, k=random.randint(20, 60))
        good = i % 4 > 0
        rows.append((i, " ".join(body) + "." if good else " ".join(w.upper() + "!!" for w in body)))
        labels.append((i, int(good)))
    return rows, labels


def test_weights_are_the_ratio_of_both_models(spark, make_docs):
    rows, labels = corpus(60)
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int")
    ratio = resampling.fit_ratio(make_docs(rows), frame)
    features, good = resampling.Features(), {i for i, q in labels if q}
    grams = {i: features.of([t])[1].tolist() for i, t in rows}
    raw, target = np.zeros(2 * resampling.BUCKETS), np.zeros(2 * resampling.BUCKETS)
    for i, g in grams.items():
        for b in g:
            raw[b] += 1
            target[b] += i in good
    for i, g in grams.items():
        want = 0.0
        for b in g:
            part = slice(0, resampling.BUCKETS) if b < resampling.BUCKETS else slice(resampling.BUCKETS, None)
            want += math.log((target[b] + 0.5) / (target[part] + 0.5).sum()) - math.log((raw[b] + 0.5) / (raw[part] + 0.5).sum())
        assert resampling.Weigher(ratio, 1).weights([dict(rows)[i]])[0] == pytest.approx(want)


def test_ngrams():
    owner, bucket = resampling.Features().of(["a b b", "", "a b"])
    assert owner.tolist().count(0) == 3 + 2 + 1 and owner.tolist().count(1) == 0 and owner.tolist().count(2) == 2 + 1
    assert (bucket[owner == 2][0] == bucket[owner == 0][0]) and bucket.max() < 2 * resampling.BUCKETS


def test_kth_largest(spark, monkeypatch):
    monkeypatch.setattr(resampling, "BINS", 4)
    random.seed(2)
    values = [random.gauss(0, 1) * 10 ** random.randint(-9, 9) for _ in range(300)] + [5.0] * 40
    frame = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 2, 17, 150, 339, 340):
        assert resampling.kth_largest(frame, "key", k) == sorted(values, reverse=True)[k - 1]


def test_draws(spark, make_docs):
    rows, labels = corpus()
    frame = spark.createDataFrame(labels[:300], "doc_id bigint, quality int")
    docs = make_docs(rows)
    drawn = {r.doc_id for r in resampling.resample(docs, frame).collect()}
    assert drawn == {i for i, q in labels if q}
    kept = resampling.keep_drawn(docs, frame)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == drawn
    one = sorted((r.doc_id, r.key) for r in resampling.resample(docs, frame).collect())
    assert one == sorted((r.doc_id, r.key) for r in resampling.resample(docs.repartition(7), frame).collect())
    assert one != sorted((r.doc_id, r.key) for r in resampling.resample(docs, frame, seed=99).collect())


def test_gumbel_keys_draw_in_proportion():
    """The first of the keys is a text with the chance that its weight has among all."""
    weigher = resampling.Weigher(np.zeros(2 * resampling.BUCKETS), 0)
    firsts = []
    for seed in range(4000):
        weigher.seed = seed
        _, keys = weigher.keys(["a", "b"], [1, 2])
        firsts.append(keys[0] + math.log(3) > keys[1])
    assert np.mean(firsts) == pytest.approx(0.75, abs=0.03)


def test_odd_rows(spark, make_docs):
    rows, labels = corpus(200)
    frame = spark.createDataFrame([*labels, (None, 1), (3, None), (3, 1)], "doc_id bigint, quality int")
    extra = [(900, None), (901, ""), (902, " \n"), (1, rows[1][1]), (None, rows[1][1]), (903, rows[1][1] * 3000)]
    docs = make_docs(rows + extra)
    kept = [r.doc_id for r in resampling.keep_drawn(docs, frame).collect()]
    assert sorted(map(str, kept)) == sorted(str(r.doc_id) for r in resampling.resample(docs, frame).collect())
    assert kept.count(1) == 2
    assert resampling.resample(docs.limit(0), frame).count() == 0 and resampling.keep_drawn(docs.limit(0), frame).count() == 0
    assert resampling.resample(docs, frame.limit(0)).count() == len(rows) + len(extra)
