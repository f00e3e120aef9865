"""Imputation, de-skewing, ordinal encoding and standard scaling.

Fitting needs three scans: medians, value counts of the text columns, and one
aggregation with the moments of every numeric column both as it is and after
``log1p``. Mean and deviation of an encoded text column follow from its value
counts alone. Applying the result is a row-wise projection plus one code lookup
per text column.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import (bias_corrected_skew, boolean_columns, filled, numeric_columns, text_columns, truth_text)
from plumbline.functions.dictionary import Dictionary, attach_code, build_dictionary
from plumbline.functions.medians import exact_medians

SKEW_LIMIT = 0.75

PREP_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("fill", T.StringType()),
    T.StructField("skew", T.DoubleType()),
    T.StructField("log1p", T.BooleanType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
])


@dataclass
class FeatureRecipe:
    column: str
    role: str
    fill: float | str | None
    skew: float | None
    log1p: bool
    mean: float
    std: float
    size: int = 0
    fill_code: int | None = None


@dataclass
class Preparation:
    """Fitted recipe per feature, in column order, and the code table of the text ones."""

    features: list[FeatureRecipe]
    codes: DataFrame | None
    rows: int

    @property
    def names(self) -> list[str]:
        return [f.column for f in self.features]

    def report(self, spark) -> DataFrame:
        rows = [(f.column, f.role, None if f.fill is None else str(f.fill), f.skew, f.log1p, f.mean, f.std)
                for f in self.features]
        return spark.createDataFrame(rows, PREP_SCHEMA)

    def summary(self, spark) -> DataFrame:
        """Counts that describe the prepared matrix."""
        log = [f.column for f in self.features if f.log1p]
        rows = [("rows", str(self.rows)), ("features", str(len(self.features))),
                ("numerical", ",".join(f.column for f in self.features if f.role == "numeric")),
                ("categorical", ",".join(f.column for f in self.features if f.role == "categorical")),
                ("log1p", ",".join(log))]
        return spark.createDataFrame(rows, "item string, value string")

    def unscaled(self, df: DataFrame) -> DataFrame:
        """Impute, de-skew and encode; feature columns become doubles."""
        for f in (f for f in self.features if f.role == "categorical"):
            own = self.codes.where(F.col("column") == f.column)
            truth = isinstance(df.schema[f.column].dataType, T.BooleanType)
            value = F.coalesce(truth_text(f.column) if truth else F.col(f.column), F.lit(f.fill))
            df = attach_code(df, value, own, f.size, self.rows, f"_code_{f.column}")
        exprs = {f.column: self._value(f) for f in self.features}
        kept = [c for c in df.columns if not c.startswith("_code_")]
        return df.select([exprs[c].alias(c) if c in exprs else F.col(c) for c in kept])

    def transform(self, df: DataFrame, keep: list[str], vector: bool = True) -> DataFrame:
        """``keep`` columns, the scaled row ``x array<double>`` and, if asked, ``features``."""
        ready = self.unscaled(df)
        scaled = [((F.col(f.column) - F.lit(f.mean)) / F.lit(f.std)).alias(f.column) for f in self.features]
        out = ready.select(*keep, F.array(*scaled).alias("x"))
        return out.withColumn("features", array_to_vector("x")) if vector else out

    @staticmethod
    def _value(f: FeatureRecipe) -> Column:
        if f.role == "categorical":  # a value that the fit has not seen counts as missing
            return F.coalesce(F.col(f"_code_{f.column}"), F.lit(f.fill_code)).cast("double")
        value = filled(f.column, f.fill).cast("double")
        return F.log1p(value) if f.log1p else value

    def to_records(self) -> list[dict]:
        return [asdict(f) for f in self.features]


def numeric_moments(df: DataFrame, columns: list[str], medians: dict, loggable: set[str]) -> dict[str, dict]:
    """Skew, minimum, mean and population deviation, plain and after log1p, in one scan.

    ``log1p`` is set for skewed, non-negative columns of ``loggable``; mean and
    deviation are those of the values that will be scaled.
    """
    if not columns:
        return {}
    aggs = []
    for i, c in enumerate(columns):
        x = filled(c, medians.get(c)).cast("double")
        logged = F.log1p(F.greatest(x, F.lit(0.0)))
        aggs += [bias_corrected_skew(x).alias(f"g{i}"), F.min(x).alias(f"lo{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_pop(x).alias(f"s{i}"), F.avg(logged).alias(f"lm{i}"), F.stddev_pop(logged).alias(f"ls{i}")]
    r = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(columns):
        skew = r[f"g{i}"]
        log = c in loggable and skew is not None and abs(skew) > SKEW_LIMIT and r[f"lo{i}"] >= 0
        out[c] = {"skew": skew, "log1p": log, "mean": r[f"lm{i}"] if log else r[f"m{i}"],
                  "std": r[f"ls{i}"] if log else r[f"s{i}"]}
    return out


def code_moments(words: Dictionary, rows: int) -> dict[str, tuple[float, float, int]]:
    """Mean and population deviation of each encoded, mode-filled column from its value counts, and the mode's code."""
    fill = F.create_map(*[F.lit(x) for pair in words.modes.items() for x in pair])
    n, code = F.col("n").cast("double"), F.col("code").cast("double")
    sums = words.table.groupBy("column").agg(
        F.sum(n * code).alias("s"), F.sum(n * code * code).alias("q"),
        F.max(F.when(F.col("value") == fill[F.col("column")], code)).alias("f")).collect()
    out = {}
    for r in sums:
        missing = rows - words.present[r["column"]]
        mean = (r["s"] + missing * r["f"]) / rows
        out[r["column"]] = mean, max((r["q"] + missing * r["f"] ** 2) / rows - mean * mean, 0.0) ** 0.5, int(r["f"])
    return out


def fit_preparation(df: DataFrame, columns: list[str], rows: int | None = None,
                    medians: dict[str, float | None] | None = None) -> Preparation:
    """Fit the recipe of ``columns`` on every row of ``df``; pass ``medians`` if already known."""
    if not columns:
        raise ValueError("no feature column is left to prepare")
    frame = df.select(*columns)
    nums, texts, bools = numeric_columns(frame), text_columns(frame), boolean_columns(frame)
    if rows is None:
        rows = df.count()
    if medians is None or any(c not in medians for c in nums):
        medians = exact_medians(frame, nums, rows)
    moments = numeric_moments(frame, nums + bools, medians, set(nums))
    words = build_dictionary(frame, texts)
    fills = words.modes if words else {}
    coded = code_moments(words, rows) if words else {}
    recipes = []
    for c in columns:
        if c in texts:
            mean, std, code = coded[c]
            recipes.append(FeatureRecipe(c, "categorical", fills[c], None, False, mean, std or 1.0, words.sizes[c], code))
        elif c in bools:
            m = moments[c]
            recipes.append(FeatureRecipe(c, "boolean", m["mean"] >= 0.5, m["skew"], False, m["mean"], m["std"] or 1.0))
        else:
            m = moments[c]
            recipes.append(FeatureRecipe(c, "numeric", medians[c], m["skew"], m["log1p"], m["mean"], m["std"] or 1.0))
    return Preparation(recipes, words.table if words else None, rows)

