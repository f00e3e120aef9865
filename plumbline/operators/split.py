"""Exact-size holdout and cross-validation folds without sorting the table.

Rows are ordered by ``md5(seed-row_id)``. A split needs only the keys found at a
few cut ranks of that order. Those keys come from counts per key prefix and a look
inside the few prefixes that hold a cut; membership is then a comparison of each
row's own key with literals, so the table is neither sorted nor shuffled.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.limits import BROADCAST_ROWS, CELL_ROWS


def order_key(row_id: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(row_id).cast("string")))


def cut_keys(df: DataFrame, key: str, cuts: dict, sizes: dict, group: str | None = None,
             cell_rows: int = CELL_ROWS) -> dict:
    """Key at each 1-based rank of the key order: ``cuts`` maps a group to its ranks.

    ``sizes`` has the rows of every group; without ``group`` the only group is 0.
    Returns ``{(group, rank): key}``. Each round counts the rows per longer key prefix inside the
    prefixes that hold a cut and are still large, and adds the counts up by a window per prefix: one
    row a cut comes back. Small prefixes are left as they are and ranked at the end.
    """
    spark = df.sparkSession
    keyed = df.select((F.col(group) if group else F.lit(0)).alias("g"), F.col(key).alias("k"))
    g_type = keyed.schema["g"].dataType.simpleString()
    # one entry per cut (groups x folds): its prefix, rank inside the prefix, rows of the prefix
    open_ = {(g, rank): ("", rank, sizes[g]) for g, ranks in cuts.items() for rank in ranks}

    def table(rows: list, schema: str) -> DataFrame:
        made = spark.createDataFrame(rows, f"g {g_type}, {schema}")
        return F.broadcast(made) if len(rows) <= BROADCAST_ROWS else made

    def inside(cells: list[tuple], digits: int) -> DataFrame:
        here = keyed.withColumn("p", F.substring("k", 1, digits) if digits else F.lit(""))
        return here.join(table(cells, "p string"), ["g", "p"], "left_semi")

    for digits in range(0, 30, 3):
        large = [(g, rank, p, pos) for (g, rank), (p, pos, n) in open_.items() if n > cell_rows]
        if not large:
            break
        counted = inside(sorted({(g, p) for g, _, p, _ in large}), digits).groupBy(
            "g", "p", F.substring("k", 1, digits + 3).alias("longer")).agg(F.count(F.lit(1)).alias("n"))
        ended = counted.withColumn("end", F.sum("n").over(W.partitionBy("g", "p").orderBy("longer")))
        held = ended.join(table([(g, p, pos, rank) for g, rank, p, pos in large], "p string, pos bigint, rank bigint"), ["g", "p"])
        for r in held.where("end - n < pos AND pos <= end").collect():
            open_[(r["g"], r["rank"])] = (r["longer"], r["pos"] - (r["end"] - r["n"]), r["n"])
    found = {}
    for digits in sorted({len(p) for p, _, _ in open_.values()}):
        mine = [(g, p, pos, rank) for (g, rank), (p, pos, _) in open_.items() if len(p) == digits]
        ranked = inside(sorted({(g, p) for g, p, _, _ in mine}), digits).withColumn(
            "pos", F.row_number().over(W.partitionBy("g", "p").orderBy("k")))
        need = table(mine, "p string, pos int, rank bigint")
        found |= {(r["g"], r["rank"]): r["k"] for r in ranked.join(need, ["g", "p", "pos"]).collect()}
    return found


def holdout_split(df: DataFrame, test_size: float = 0.2, seed: int = 42, row_id: str = "row_id",
                  rows: int | None = None) -> DataFrame:
    """Add ``order_key`` and ``is_test``: the first ceil(test_size * rows) rows of the key order."""
    keyed = df.withColumn("order_key", order_key(row_id, seed))
    if rows is None:
        rows = df.count()
    n_test = math.ceil(test_size * rows)
    if not 0 < n_test < rows:
        raise ValueError(f"test_size {test_size} leaves no rows on one side of {rows}")
    last = cut_keys(keyed.select("order_key"), "order_key", {0: [n_test]}, {0: rows})[(0, n_test)]
    return keyed.withColumn("is_test", F.col("order_key") <= F.lit(last))


def contiguous_folds(df: DataFrame, k: int = 5, key: str = "order_key", rows: int | None = None) -> DataFrame:
    """Add ``fold``: k contiguous parts of the key order, the first rows mod k one larger."""
    if rows is None:
        rows = df.count()
    if rows < k:
        raise ValueError(f"{k} folds need at least {k} rows")
    sizes = [rows // k + (1 if i < rows % k else 0) for i in range(k)]
    ends = list(accumulate(sizes))[:-1]
    keys = cut_keys(df.select(key), key, {0: ends}, {0: rows})
    return df.withColumn("fold", _fold_of(F.col(key), [keys[(0, e)] for e in ends]))


def stratified_folds(df: DataFrame, label: str, k: int = 5, key: str = "order_key") -> DataFrame:
    """Add ``fold``: per class, contiguous parts of the key order.

    Part sizes deal the rows, sorted by class, to the folds in turn, so fold sizes
    and the class counts inside folds differ by at most one.
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    ends: dict = {}
    start = 0
    for value in sorted(counts):
        n = counts[value]
        dealt = [len(range((f - start) % k, n, k)) for f in range(k)]
        ends[value] = list(accumulate(dealt))[:-1]
        start += n
    cuts = {v: sorted({e for e in es if 0 < e}) for v, es in ends.items()}
    keys = cut_keys(df.select(label, key), key, cuts, counts, group=label)
    bounds = [(v, [keys.get((v, e), "") for e in es]) for v, es in ends.items()]
    l_type = df.schema[label].dataType.simpleString()
    table = df.sparkSession.createDataFrame(bounds, f"_l {l_type}, _bounds array<string>")
    joined = df.join(F.broadcast(table) if len(ends) * k <= BROADCAST_ROWS else table, df[label] == table["_l"])
    passed = F.size(F.filter("_bounds", lambda b: b < F.col(key)))
    return joined.withColumn("fold", passed.cast("int")).drop("_l", "_bounds")


def _fold_of(key: Column, bounds: list[str]) -> Column:
    fold = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        fold = F.when(key <= bounds[i], F.lit(i)).otherwise(fold)
    return fold.cast("int")
