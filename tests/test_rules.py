from itertools import combinations

import pytest

from plumbline.operators import rules as R

ROWS = [("a", "x", None), ("a", "x", "k"), ("b", "x", "k"), ("a", "y", "k"), ("a", "x", "k"), ("b", "y", None), ("a", "x", "k")]


def brute(baskets, min_support, min_confidence):
    n = len(baskets)
    items = sorted(set().union(*baskets))
    support = {}
    for size in range(1, 4):
        for c in combinations(items, size):
            s = sum(set(c) <= b for b in baskets) / n
            if s >= min_support:
                support[c] = s
    rules = {}
    for c, s in support.items():
        for size in range(1, len(c)):
            for a in combinations(c, size):
                rest = tuple(i for i in c if i not in a)
                if s / support[a] >= min_confidence:
                    rules[(a, rest)] = (s, s / support[a], s / support[a] / support[rest])
    return support, rules


@pytest.mark.parametrize("min_support,min_confidence", [(0.2, 0.5), (1 / 7, 0.1), (3 / 7, 0.9)])
def test_rules_equal_brute_force(spark, min_support, min_confidence):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "row_id bigint, p string, q string, r string")
    baskets = R.category_items(df, ["p", "q", "r"])
    sets = [{f"p_{a}", f"q_{b}", f"r_{c or 'missing'}"} for a, b, c in ROWS]
    support, rules = brute(sets, min_support, min_confidence)
    itemsets = R.frequent_itemsets(baskets, min_support, len(ROWS))
    assert {tuple(r["items"]): pytest.approx(r["support"]) for r in itemsets.collect()} == support
    got = {(tuple(r["antecedents"]), tuple(r["consequents"])): r for r in R.association_rules(itemsets, min_confidence).collect()}
    assert set(got) == set(rules)
    for key, (s, c, lift) in rules.items():
        assert (got[key]["support"], got[key]["confidence"], got[key]["lift"]) == pytest.approx((s, c, lift))
        assert (got[key]["conviction"] is None) == (c == 1.0)


def test_support_at_the_limit_survives(spark):
    df = spark.createDataFrame([(i, "hit" if i < 7 else f"v{i}") for i in range(100)], "row_id bigint, a string")
    items = R.category_items(df, ["a"])
    found = R.frequent_itemsets(items, 0.07, 100).collect()
    assert [(r["items"], r["freq"]) for r in found] == [(["a_hit"], 7)]


def test_nothing_frequent(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(10)], "row_id bigint, a string")
    none = R.frequent_itemsets(R.category_items(df, ["a"]), 0.2, 10)
    assert none.count() == 0 and R.association_rules(none, 0.5).count() == 0
    assert R.top_rules(R.association_rules(none, 0.5)).columns == ["antecedent", "consequent", "support", "confidence", "lift"]


def test_median_items(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 1.0)], "row_id bigint, a double, b double")
    got = {r["row_id"]: r["items"] for r in R.median_items(df, ["a", "b"]).collect()}
    assert got == {1: ["b_high"], 2: ["a_high", "b_high"], 3: ["a_high"]}
