import numpy as np
import pandas as pd
import pytest

from plumbline.operators.prepare import fit_preparation


def scaled(v):
    s = np.std(v)
    return (v - np.mean(v)) / (s or 1.0)


def test_recipe_matches_numpy(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({
        "row_id": range(60), "skewed": rng.lognormal(0, 1.5, 60), "negative": -rng.lognormal(0, 1.5, 60),
        "plain": rng.normal(size=60), "word": [["b", "a", "é", None][i % 4] for i in range(60)],
        "flag": [i % 5 == 0 for i in range(60)]})
    pdf.loc[3, "plain"] = None
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    columns = ["skewed", "word", "negative", "plain", "flag"]
    prep = fit_preparation(df, columns)
    got = np.array([r["x"] for r in prep.transform(df, ["row_id"]).orderBy("row_id").collect()])
    words = pdf["word"].fillna("a").map({"a": 0, "b": 1, "é": 2}).to_numpy(float)
    want = np.stack([scaled(np.log1p(pdf["skewed"])), scaled(words), scaled(pdf["negative"]),
                     scaled(pdf["plain"].fillna(pdf["plain"].median())), scaled(pdf["flag"].astype(float))], axis=1)
    assert np.allclose(got, want)
    report = {r["column"]: r for r in prep.report(spark).collect()}
    assert report["skewed"]["log1p"] and not report["negative"]["log1p"] and not report["flag"]["log1p"]
    assert report["word"]["fill"] == "a"
    assert report["negative"]["skew"] == pytest.approx(pdf["negative"].skew())


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(i, 2.0, "a") for i in range(4)], "row_id bigint, a double, b string")
    out = fit_preparation(df, ["a", "b"]).transform(df, ["row_id"]).collect()
    assert {tuple(r["x"]) for r in out} == {(0.0, 0.0)}


def test_no_columns(spark):
    with pytest.raises(ValueError):
        fit_preparation(spark.range(2), [])
