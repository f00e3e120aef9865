import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.functions.columns import bias_corrected_skew, check_column_types, nan_to_null, pearson
from plumbline.functions.dictionary import attach_code, build_dictionary, ordered_codes, value_counts
from plumbline.functions.medians import exact_medians, medians_by_refinement


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 3.0, 4.0], [5.0], [2.0, 2.0, 2.0], [None, None], [-1e300, 1e300, 3.0, 1.5],
    [0.0, -0.0, 1e-320, 2e-320], [None, 7.0, 1.0, None, 7.0]])
def test_refined_median_of_small_lists(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    present = [v for v in values if v is not None]
    want = float(np.median(present)) if present else None
    got = medians_by_refinement(df, ["a"])["a"]
    assert got == (None if want is None else pytest.approx(want))


def test_refined_median_equals_builtin_on_many_columns(spark):
    rng = np.random.default_rng(3)
    n = 4001
    pdf = pd.DataFrame({"lognormal": rng.lognormal(0, 4, n), "hot": np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n)),
                        "whole": rng.integers(-50, 50, n).astype(float), "even": rng.normal(size=n)})
    pdf.loc[5, "even"] = np.nan
    df = nan_to_null(spark.createDataFrame(pdf))
    assert medians_by_refinement(df, list(pdf)) == pytest.approx(exact_medians(df, list(pdf)))
    assert exact_medians(df, list(pdf)) == pytest.approx({c: float(np.nanmedian(pdf[c])) for c in pdf})


def test_nan_counts_as_missing(spark):
    df = nan_to_null(spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "a double"))
    assert df.where("a is null").count() == 2


def test_skew_edges(spark):
    def skew(values):
        return spark.createDataFrame([(float(v),) for v in values], "a double").agg(
            bias_corrected_skew(F.col("a")).alias("s")).first()["s"]
    assert skew([1, 2]) is None
    assert skew([4, 4, 4, 4]) == 0.0
    values = [1.0, 2.0, 2.5, 9.0, 30.0]
    assert skew(values) == pytest.approx(pd.Series(values).skew())


def test_pearson_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert df.agg(pearson(F.col("a"), F.col("b")).alias("r")).first()["r"] is None


def test_timestamps_are_rejected(spark):
    with pytest.raises(TypeError, match="t: timestamp"):
        check_column_types(spark.sql("select timestamp'2020-01-01' as t, 1 as a"))


def test_codes_follow_code_points_and_modes_break_ties_low(spark):
    df = spark.createDataFrame([(v,) for v in ["é", "B", "a", "10", "9", "a", "B", None]], "v string")
    words = build_dictionary(df, ["v"])
    assert [r["value"] for r in words.table.orderBy("code").collect()] == ["10", "9", "B", "a", "é"]
    assert words.modes == {"v": "B"} and words.sizes == {"v": 5} and words.present == {"v": 7}


def test_large_dictionary_plan_gives_the_same_codes(spark):
    df = spark.range(3000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("a"),
                                  F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("b"))
    counts = value_counts(df, ["a", "b"])
    small = ordered_codes(counts, 1)
    large = ordered_codes(counts, 10, limit=1)
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
    codes = small.where("column = 'b'")
    joined = [attach_code(df, F.col("b"), codes, 2001, 3000, "c", limit=limit).select("id", "c") for limit in (10_000, 1)]
    assert joined[0].exceptAll(joined[1]).count() == 0
    assert joined[1].where("c is null").count() == 0 and joined[1].count() == 3000
