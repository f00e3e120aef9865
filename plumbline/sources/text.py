"""Delimited text with a header: missing-value tokens and column types found from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import with_plain_names

# The tokens a default tabular text reader takes for missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(?i:inf|infinity)\s*$"
_TRUTH = r"^(True|TRUE|true|False|FALSE|false)$"


def normalise_missing(df: DataFrame) -> DataFrame:
    """Turn every missing-value token of the text columns into NULL."""
    return df.select([
        F.when(~F.col(f.name).isin(NA_TOKENS), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def infer_types(df: DataFrame) -> DataFrame:
    """Cast each text column to the narrowest type all its values allow, found in one scan.

    Whole numbers become bigint, or double when values are missing; other numbers
    double; truth words boolean when none is missing; the rest stays text.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(texts):
        v = F.col(c)
        whole = v.rlike(_WHOLE) & F.expr(f"try_cast(`{c}` AS bigint)").isNotNull()
        aggs += [F.count(v).alias(f"n{i}"), F.count_if(whole).alias(f"w{i}"),
                 F.count_if(v.rlike(_DECIMAL)).alias(f"d{i}"), F.count_if(v.rlike(_TRUTH)).alias(f"t{i}")]
    r = df.agg(*aggs).first()
    types = {}
    for i, c in enumerate(texts):
        n, missing = r[f"n{i}"], r["rows"] - r[f"n{i}"]
        if n == 0 or r[f"d{i}"] == n:
            types[c] = "bigint" if n and r[f"w{i}"] == n and not missing else "double"
        elif r[f"t{i}"] == n and not missing:
            types[c] = "boolean"
    return df.select([F.expr(f"try_cast(trim(`{c}`) AS {types[c]})").alias(c) if c in types else F.col(c)
                      for c in df.columns])


def read_table(spark: SparkSession, source: DataFrame | str, multiline: bool = False) -> DataFrame:
    """A DataFrame, a parquet folder, or a CSV file with a header row; dots in names become underscores.

    ``multiline`` allows line breaks inside quotes, at the price of one task per file.
    """
    if isinstance(source, DataFrame):
        return with_plain_names(source)
    name = source.lower().rstrip("/")
    if name.endswith(".parquet"):
        return with_plain_names(spark.read.parquet(source))
    if not name.endswith(".csv"):
        raise ValueError(f"cannot read {source}: a table is a DataFrame, a .csv file or a .parquet folder")
    raw = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
           .option("multiLine", multiline).csv(source))
    return infer_types(normalise_missing(with_plain_names(raw)))


def shape_report(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))
