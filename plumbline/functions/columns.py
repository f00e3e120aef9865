"""Column classes and small per-column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import cut_lineage


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def boolean_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.BooleanType) and f.name not in exclude]


def check_column_types(df: DataFrame, exclude: tuple[str, ...] = ()) -> None:
    """Reject columns that no later step can scale."""
    allowed = (T.NumericType, T.StringType, T.BooleanType)
    bad = [f"{f.name}: {f.dataType.simpleString()}" for f in df.schema.fields
           if f.name not in exclude and not isinstance(f.dataType, allowed)]
    if bad:
        raise TypeError("cast or drop these columns first: " + ", ".join(bad))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL so that every aggregate skips it."""
    floating = (T.DoubleType, T.FloatType)
    return df.select([
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, floating) else F.col(f.name)
        for f in df.schema.fields
    ])


def with_row_id(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Give every row a stable ``row_id``.

    Without a key column the id follows the input order. That order is not
    repeatable for every source, so the rows are written once with their id.
    """
    if id_col is not None:
        named = df.withColumnRenamed(id_col, "row_id").withColumn("row_id", F.col("row_id").cast("bigint"))
        check_ids(named)
        return named
    return cut_lineage(df.withColumn("row_id", F.monotonically_increasing_id()))


def check_ids(df: DataFrame) -> None:
    """Every step joins and splits by the id, so it has to be whole, present and unique."""
    r = df.agg(F.count(F.lit(1)).alias("rows"), F.count("row_id").alias("present"), F.count_distinct("row_id").alias("ids")).first()
    if r["present"] < r["rows"]:
        raise ValueError(f"{r['rows'] - r['present']} rows have no id, or one that is no whole number")
    if r["ids"] < r["rows"]:
        raise ValueError(f"ids repeat: {r['rows']} rows have {r['ids']} different ids")


def plain_name(name: str) -> str:
    """A column name that needs no quoting: dots and backticks become underscores."""
    return name.replace(".", "_").replace("`", "_")


def with_plain_names(df: DataFrame) -> DataFrame:
    """Rename columns whose names Spark would read as paths; a clash gets a further underscore."""
    if all(plain_name(c) == c for c in df.columns):
        return df
    taken = {c for c in df.columns if plain_name(c) == c}
    names = []
    for c in df.columns:
        name = plain_name(c)
        while name != c and name in taken:
            name += "_"
        taken.add(name)
        names.append(name)
    return df.toDF(*names)


def truth_as_text(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Turn truth columns with gaps into the texts True and False; they are then filled and coded like other text."""
    columns = boolean_columns(df, exclude)
    if not columns:
        return df
    r = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    gaps = {c for i, c in enumerate(columns) if r[f"n{i}"]}
    return df.withColumns({c: truth_text(c) for c in gaps}) if gaps else df


def truth_text(column: str) -> Column:
    return F.initcap(F.col(column).cast("string"))


def filled(column: str, value: float | str | None) -> Column:
    return F.col(column) if value is None else F.coalesce(F.col(column), F.lit(value))


def bias_corrected_skew(x: Column) -> Column:
    """Sample skewness G1 from the population skewness; null below three rows, 0 when constant."""
    n = F.count(x).cast("double")
    g1 = F.skewness(x) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n < 3, F.lit(None).cast("double")).otherwise(F.coalesce(g1, F.lit(0.0)))


def pearson(x: Column, y: Column) -> Column:
    """Pearson r that is NULL, not an error, when a side is constant."""
    return F.covar_samp(x, y) / F.nullif(F.stddev_samp(x) * F.stddev_samp(y), F.lit(0.0))


def unit(x: Column) -> Column:
    return F.when(x, F.lit(1.0)).otherwise(F.lit(0.0))
