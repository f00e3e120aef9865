"""Frequent itemsets and association rules over the text columns of a table."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.medians import exact_medians
from plumbline.session import cut_lineage

ITEMSET_SCHEMA = "items array<string>, freq bigint, support double"


def category_items(df: DataFrame, columns: list[str]) -> DataFrame:
    """One item ``column_value`` per text column; a missing value is the item ``column_missing``."""
    items = [F.concat(F.lit(f"{c}_"), F.coalesce(F.col(c), F.lit("missing"))) for c in columns]
    return df.select("row_id", F.array_sort(F.array_distinct(F.array(*items))).alias("items"))


def median_items(df: DataFrame, columns: list[str], rows: int | None = None) -> DataFrame:
    """The item ``column_high`` for every column at or above its median."""
    medians = exact_medians(df, columns, rows)
    items = [F.when(F.col(c) >= medians[c], F.lit(f"{c}_high")) for c in columns]
    return df.select("row_id", F.array_sort(F.array_compact(F.array(*items))).alias("items"))


def frequent_itemsets(baskets: DataFrame, min_support: float, rows: int) -> DataFrame:
    """``(items, freq, support)``: every itemset held by at least ``min_support`` of the rows.

    The miner's own threshold is a hair lower, so a support exactly at the limit
    survives rounding; the exact comparison follows.
    """
    model = FPGrowth(itemsCol="items", minSupport=max(min_support - 1e-9, 0.0), minConfidence=0.0).fit(
        baskets.select("items"))
    found = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    support = F.col("freq") / F.lit(float(rows))
    return found.withColumn("support", support).where(F.col("support") >= min_support)


def association_rules(itemsets: DataFrame, min_confidence: float) -> DataFrame:
    """Every split of an itemset into two non-empty parts, with the usual measures.

    Consequents grow by one item a level. Moving an item from the antecedent to the
    consequent never raises the confidence, so only splits that reach it grow on, and
    nothing of the size of all subsets is made. Supports of both parts come back by
    equi-joins; both parts are frequent themselves.
    """
    known = itemsets.select("items", "support")
    left = known.select(F.col("items").alias("antecedents"), F.col("support").alias("_a"))
    right = known.select(F.col("items").alias("consequents"), F.col("support").alias("_c"))
    sized = known.where(F.size("items") > 1)
    grown = sized.select("items", "support", F.explode(F.transform("items", lambda v: F.array(v))).alias("consequents"))
    found = None
    while True:
        sides = grown.withColumn("antecedents", F.array_except("items", "consequents"))
        strong = cut_lineage(sides.join(left, "antecedents").withColumn("confidence", F.col("support") / F.col("_a"))
                             .where(F.col("confidence") >= min_confidence))
        found = strong if found is None else found.unionByName(strong)
        wider = strong.where(F.size("items") > F.size("consequents") + 1)
        if not wider.limit(1).count():
            break
        later = F.filter("items", lambda v: v > F.element_at("consequents", -1))
        grown = wider.select("items", "support", "consequents", F.explode(later).alias("_next")).select(
            "items", "support", F.concat("consequents", F.array("_next")).alias("consequents"))
    return found.join(right, "consequents").select(
        "antecedents", "consequents", "support", "confidence",
        (F.col("confidence") / F.col("_c")).alias("lift"),
        (F.col("support") - F.col("_a") * F.col("_c")).alias("leverage"),
        # infinite for a certain rule, shown as null
        ((1 - F.col("_c")) / F.nullif(1 - F.col("confidence"), F.lit(0.0))).alias("conviction"))


def rank_rules(rules: DataFrame) -> DataFrame:
    return rules.orderBy(F.desc("lift"), F.desc("confidence"), F.desc("support"), "antecedents", "consequents")


def _listed(c: str, width: int):
    shown = F.concat(F.lit("['"), F.concat_ws("', '", c), F.lit("']"))
    return F.substring(shown, 1, width) if width else shown


def top_rules(rules: DataFrame, n: int = 5) -> DataFrame:
    """Best rules by lift with both sides cut to display width."""
    return rank_rules(rules).limit(n).select(
        _listed("antecedents", 28).alias("antecedent"), _listed("consequents", 23).alias("consequent"),
        "support", "confidence", "lift")


def rule_chart(rules: DataFrame, n: int = 10) -> DataFrame:
    """Label and lift of the best rules."""
    label = F.concat(_listed("antecedents", 0), F.lit(" -> "), _listed("consequents", 0))
    return rank_rules(rules).limit(n).select(F.substring(label, 1, 50).alias("label"), "lift")
