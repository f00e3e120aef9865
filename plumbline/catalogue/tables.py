"""Derived tables shared by the reports, each with the SQL text of the same table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(x: Column | str, places: int = 6) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.round(x.cast("double"), places)


def orders_ds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with injected nulls and constant, tiny, collinear and identifier-like columns."""
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("row_id"),
        F.when(k % 7 != 0, F.col("o_totalprice")).alias("price"),
        (F.col("o_totalprice") * 2 + 1).alias("price_dup"),
        F.lit(1.0).alias("k_const"),
        (F.lit(0.001) * (k % 2)).alias("tiny"),
        F.when(k % 11 != 0, F.col("o_orderpriority")).alias("priority"),
        F.lit("x").alias("cat_const"),
        k.cast("string").alias("id_like"),
        F.col("o_orderstatus").alias("status"),
    )


ORDERS_DS = """orders_ds AS (
  SELECT o_orderkey AS row_id,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price,
         o_totalprice * 2 + 1 AS price_dup,
         CAST(1 AS DOUBLE) AS k_const,
         CAST(0.001 AS DOUBLE) * (o_orderkey % 2) AS tiny,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS priority,
         'x' AS cat_const,
         CAST(o_orderkey AS VARCHAR) AS id_like,
         o_orderstatus AS status
  FROM orders)"""


def docs_ds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with their size in characters, lines and words."""
    d = load(spark, sf_dir, "documents")
    sized = d.select(
        F.col("doc_id").alias("row_id"), "n_chars",
        (F.size(F.split("text", "\n"))).cast("bigint").alias("n_lines"),
        (F.size(F.split("text", " "))).cast("bigint").alias("n_words"),
        "lang", "source")
    return sized.join(load(spark, sf_dir, "labels").withColumnRenamed("doc_id", "row_id"), "row_id")


DOCS_DS = r"""docs_ds AS (
  SELECT d.doc_id AS row_id, d.n_chars,
         CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS n_lines,
         CAST(len(string_split(d.text, ' ')) AS BIGINT) AS n_words,
         d.lang, d.source, l.quality, l.toxic
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def users_ds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: number of events of each type and the mean event value."""
    e = load(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("row_id")).agg(
        *[F.count_if(F.col("event_type") == t).alias(f"n_{t}") for t in EVENT_TYPES],
        F.avg("value").alias("avg_value"))


USERS_DS = """users_ds AS (
  SELECT user_id AS row_id, """ + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{t}') AS n_{t}" for t in EVENT_TYPES) + """,
         avg(value) AS avg_value
  FROM events GROUP BY user_id)"""
USERS_FEATURES = [f"n_{t}" for t in EVENT_TYPES] + ["avg_value"]


def part_ds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_id"), "p_size", "p_brand", "p_type", "p_retailprice")


def emb_ds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("x"), "label")


EMB_DIMS = 64


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's segment; every column is an item source."""
    o, c = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"))


BASKETS = """baskets AS (
  SELECT o_orderkey AS row_id, o_orderstatus AS status, o_orderpriority AS priority, c_mktsegment AS segment
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
