import pytest

from plumbline.sources.text import NA_TOKENS, infer_types, normalise_missing, read_table, shape_report


def types(df):
    return dict(df.dtypes)


def test_csv_with_missing_tokens(spark, tmp_path):
    path = tmp_path / "a.CSV"
    path.write_text('id,temp,city,ok,note\n1,98,"Delhi, N",True,\n2,NA,n/a,False,\n3,101.5,"say ""hi""",True,null\n')
    df = read_table(spark, str(path))
    assert types(df) == {"id": "bigint", "temp": "double", "city": "string", "ok": "boolean", "note": "double"}
    rows = df.orderBy("id").collect()
    assert [r["temp"] for r in rows] == [98.0, None, 101.5]
    assert [r["city"] for r in rows] == ["Delhi, N", None, 'say "hi"']
    assert shape_report(df).first().asDict() == {"n_rows": 3, "n_columns": 5}


def test_every_token_is_missing(spark):
    df = spark.createDataFrame([(t,) for t in NA_TOKENS] + [("x",)], "v string")
    assert normalise_missing(df).where("v is not null").count() == 1


def test_whole_numbers_with_gaps_become_doubles(spark):
    df = spark.createDataFrame([("1", "7", "True"), (None, "+8", None)], "a string, b string, c string")
    assert types(infer_types(df)) == {"a": "double", "b": "bigint", "c": "string"}


def test_suffixes_and_words_stay_text(spark):
    df = spark.createDataFrame([("1d", "1L", "x1", "1e3"), ("2d", "2", "3", " 4 ")], "a string, b string, c string, d string")
    assert types(infer_types(df)) == {"a": "string", "b": "string", "c": "string", "d": "double"}


def test_unknown_extension(spark):
    with pytest.raises(ValueError):
        read_table(spark, "table.json")


def test_frames_pass_through(spark):
    df = spark.range(2)
    assert read_table(spark, df) is df
