"""Sorted value dictionaries for text columns: value, row count and ordinal code."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.limits import BROADCAST_ROWS
from plumbline.session import cut_lineage


@dataclass
class Dictionary:
    """``table(column, value, n, code)``; per column its number of values, non-null rows and mode."""

    table: DataFrame
    sizes: dict[str, int]
    present: dict[str, int]
    modes: dict[str, str]


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, n)`` for all columns from one scan; counted map-side first."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    return (df.select(F.explode(cells).alias("e")).select("e.column", "e.value").where("value is not null")
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def ordered_codes(counts: DataFrame, entries: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Zero-based position of every value among the sorted values of its column.

    A small dictionary is ranked by one window per column. A larger one is range
    partitioned by (column, value), ranked inside each range, and shifted by the
    number of values in the ranges before it, so no task sorts a whole column.
    """
    if entries <= limit:
        w = W.partitionBy("column").orderBy("value")
        return counts.withColumn("code", (F.row_number().over(w) - 1).cast("bigint"))
    ranged = cut_lineage(counts.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id()))
    sizes = ranged.groupBy("column", "part").agg(F.count(F.lit(1)).alias("size"))
    before = W.partitionBy("column").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select("column", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"))
    inside = W.partitionBy("column", "part").orderBy("value")
    # one row per (column, range): bounded by the number of shuffle partitions
    return (ranged.join(F.broadcast(shifts), ["column", "part"])
            .select("column", "value", "n",
                    (F.row_number().over(inside) - 1 + F.col("shift")).cast("bigint").alias("code")))


def build_dictionary(df: DataFrame, columns: list[str]) -> Dictionary | None:
    if not columns:
        return None
    counts = value_counts(df, columns).persist()
    # the most frequent value; the smallest on ties
    mode = F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value")))
    found = {r["column"]: r for r in counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("present"), mode.alias("mode")).collect()}
    sizes = {c: found[c]["size"] if c in found else 0 for c in columns}
    return Dictionary(ordered_codes(counts, sum(sizes.values())), sizes,
                      {c: found[c]["present"] if c in found else 0 for c in columns},
                      {c: r["mode"] for c, r in found.items()})


def attach_code(df: DataFrame, value: Column, codes: DataFrame, size: int, rows: int, out: str,
                limit: int = BROADCAST_ROWS) -> DataFrame:
    """Add ``out`` = the code of ``value``; ``codes(value, n, code)`` has ``size`` rows.

    A dictionary of bounded size is broadcast. Otherwise only its frequent values
    are (each holds over a thousandth of the rows, so there are at most a thousand)
    and the rest is a shuffle join in which no key is hot: rows already coded get a
    spread of keys that match nothing.
    """
    if size <= limit:
        small = codes.select(F.col("value").alias("_v"), F.col("code").alias(out))
        return df.withColumn("_v", value).join(F.broadcast(small), "_v", "left").drop("_v")
    cut = max(rows // 1000, 1)
    frequent = codes.where(F.col("n") > cut).select(F.col("value").alias("_v"), F.col("code").alias("_hot"))
    rare = codes.where(F.col("n") <= cut).select(F.col("value").alias("_v"), F.col("code").alias("_cold"))
    spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(65536)).cast("string"))
    return (df.withColumn("_v", value).join(F.broadcast(frequent), "_v", "left")
            .withColumn("_v", F.when(F.col("_hot").isNotNull() | F.col("_v").isNull(), spread).otherwise(F.col("_v")))
            .join(rare, "_v", "left")
            .withColumn(out, F.coalesce("_hot", "_cold")).drop("_v", "_hot", "_cold"))
