"""The supervised run: filter, detect the task, prepare, search, rank, refit and save."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import check_column_types, nan_to_null, plain_name, truth_as_text, with_row_id
from plumbline.limits import BROADCAST_ROWS, ROWS_PER_TASK
from plumbline.operators import profile as P
from plumbline.operators import search as S
from plumbline.operators.learners import context, families
from plumbline.operators.prepare import Preparation, fit_preparation
from plumbline.operators.split import contiguous_folds, holdout_split, stratified_folds
from plumbline.sources.bundle import save_model_bundle
from plumbline.sources.text import read_table


@dataclass
class SupervisedResult:
    results: DataFrame
    best_name: str
    best_model: object
    task: str
    feature_report: DataFrame
    prep_report: DataFrame
    target_report: DataFrame
    preparation: Preparation
    classes: list = field(default_factory=list)
    rows: int = 0
    rows_without_target: int = 0
    notes: DataFrame | None = None
    bundle: str | None = None


def class_labels(df: DataFrame, target: str) -> list:
    """Sorted distinct classes; every learner holds a table of them."""
    return sorted(r[0] for r in df.select(target).distinct().collect())


def with_label(df: DataFrame, target: str, task: str, classes: list) -> DataFrame:
    """Add ``label``: the index of the class, or the target as a double."""
    if task == "regression":
        return df.withColumn("label", F.col(target).cast("double"))
    dtype = df.schema[target].dataType.simpleString()
    index = df.sparkSession.createDataFrame([(c, float(i)) for i, c in enumerate(classes)], f"_c {dtype}, label double")
    if len(classes) <= BROADCAST_ROWS:
        index = F.broadcast(index)
    return df.join(index, df[target] == index["_c"]).drop("_c")


def prepare_rows(df: DataFrame, target: str, columns: list[str], task: str, rows: int, medians: dict | None,
                 test_size: float, folds: int, seed: int, fit_on: str):
    """Prepared, labelled rows split into cached training (with folds) and test parts."""
    classes = class_labels(df, target) if task == "classification" else []
    split = holdout_split(with_label(df, target, task, classes), test_size, seed, rows=rows)
    if fit_on == "all":
        preparation = fit_preparation(df, columns, rows, medians)
    else:
        preparation = fit_preparation(split.where("NOT is_test"), columns)
    ready = preparation.transform(split, ["row_id", "label", "order_key", "is_test"])
    # iterative fits run one job per step, so a small table should not be many tasks
    ready = ready.coalesce(max(1, rows // ROWS_PER_TASK)).persist()
    train, test = ready.where("NOT is_test"), ready.where("is_test")
    if task == "classification":
        train = stratified_folds(train, "label", folds)
    else:
        train = contiguous_folds(train, folds)
    return preparation, classes, train.persist(), test


def run_supervised(spark: SparkSession, source: DataFrame | str, target: str, id_col: str | None = None,
                   variance_threshold: float = 0.0, corr_threshold: float = 0.05,
                   multicollinearity_threshold: float = 0.95, test_size: float = 0.2, cv: int = 5,
                   random_state: int = 42, grid: str = "full", fit_on: str = "all", parallelism: int = 4,
                   save_to: str | None = None, only: tuple[str, ...] | None = None) -> SupervisedResult:
    """Model ``target`` from the other columns of a table and keep the best family, of those named in ``only`` if given.

    ``fit_on`` chooses whether imputation and scaling see all rows or only the
    training rows. The winner is refitted on all rows; ``save_to`` also writes it.
    """
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on is all or train")
    df = read_table(spark, source)
    target, id_col = plain_name(target), id_col and plain_name(id_col)
    if target not in df.columns:
        raise ValueError(f"no column {target}")
    df = truth_as_text(with_row_id(nan_to_null(df), id_col), ("row_id", target))
    check_column_types(df, ("row_id", target))
    filtered = P.filter_supervised(df, target, variance_threshold, corr_threshold, multicollinearity_threshold,
                                   exclude=("row_id",))
    profile = P.target_profile(df, [target])
    task = profile.first()["task"]
    known = df.where(F.col(target).isNotNull())
    present = known.count()
    medians = filtered.medians if present == filtered.rows else None
    preparation, classes, train, test = prepare_rows(
        known, target, filtered.kept, task, present, medians, test_size, cv, random_state, fit_on)
    dims = len(preparation.features)
    tried = [f for f in families(task, grid) if only is None or f.name in only]
    if not tried:
        raise ValueError(f"no family of {only} is for {task}")
    found = S.search_all(tried, train, task, cv, dims, len(classes), random_state, parallelism)
    rows = S.compare(found, test, task, parallelism)
    best = found[S.choose(rows, task)]
    everything = train.drop("fold").unionByName(test)
    model = best.family.fit(everything, best.params, context(everything, dims, len(classes), random_state))
    result = SupervisedResult(
        S.comparison_table(spark, rows, task), best.family.name, model, task, filtered.report(spark),
        preparation.report(spark), profile, preparation, classes, present, filtered.rows - present,
        filtered.note_table(spark))
    if save_to:
        result.bundle = save_model_bundle(spark, save_to, result, target)
    return result
