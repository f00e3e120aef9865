"""Exact interpolated medians for many columns at once."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.limits import MEDIAN_BUFFER_ROWS

_BUCKETS = 1024


def exact_medians(df: DataFrame, columns: list[str], rows: int | None = None) -> dict[str, float | None]:
    """Median of every column, ignoring nulls; ``None`` for an all-null column.

    ``rows`` is the row count when the caller already knows it. A frame of bounded
    size uses the built-in aggregate. Its buffer keeps every distinct value, so a
    larger frame narrows a histogram around the middle ranks instead: each round is
    one scan whose partial aggregation leaves at most ``columns x buckets`` rows.
    """
    if not columns:
        return {}
    if rows is None:
        rows = df.count()
    if rows <= MEDIAN_BUFFER_ROWS:
        row = df.agg(*[F.median(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
        return {c: row[f"m{i}"] for i, c in enumerate(columns)}
    return medians_by_refinement(df, columns)


def medians_by_refinement(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    values = [F.col(c).cast("double") for c in columns]
    first = df.agg(*[f(v).alias(f"{n}{i}") for i, v in enumerate(values)
                     for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    out: dict[str, float | None] = {}
    found: dict[tuple[int, int], float] = {}
    # one search per (column, middle rank): value range and rows below it
    open_: dict[tuple[int, int], tuple[float, float, int]] = {}
    ranks: dict[int, tuple[int, int]] = {}
    for i, c in enumerate(columns):
        n = first[f"n{i}"]
        if n == 0:
            out[c] = None
            continue
        ranks[i] = ((n - 1) // 2, n // 2)
        for r in set(ranks[i]):
            open_[(i, r)] = (first[f"lo{i}"], first[f"hi{i}"], 0)
    while open_:
        for key, (lo, hi, _) in list(open_.items()):
            if lo == hi:
                found[key] = lo
                del open_[key]
        if not open_:
            break
        keys = sorted(open_)
        cells = []
        for s, key in enumerate(keys):
            lo, hi, _ = open_[key]
            v = values[key[0]]
            # monotone in v, and lo and hi never share a bucket, so every round narrows
            half = 0.5 if math.isinf(hi - lo) else 1.0
            share = (v * half - lo * half) / (hi * half - lo * half)
            bucket = F.least(F.lit(_BUCKETS - 1), F.floor(share * _BUCKETS).cast("int"))
            cells.append(F.when(v.between(lo, hi), F.struct(F.lit(s).alias("s"), bucket.alias("b"), v.alias("v"))))
        hist = (df.select(F.explode(F.array(*cells)).alias("c")).where("c is not null").select("c.*")
                .groupBy("s", "b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                .orderBy("s", "b").collect())
        for s, key in enumerate(keys):
            below = open_[key][2]
            for h in (h for h in hist if h["s"] == s):
                if below + h["n"] > key[1]:
                    open_[key] = (h["lo"], h["hi"], below)
                    break
                below += h["n"]
    for i, (a, b) in ranks.items():
        out[columns[i]] = found[(i, a)] + (found[(i, b)] - found[(i, a)]) * 0.5
    return out
