"""Reports on column statistics, column filters, text ingestion and task detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalogue.registry import make_registry
from plumbline.catalogue.tables import DOCS_DS, ORDERS_DS, docs_ds, load, orders_ds, r6
from plumbline.functions.medians import exact_medians
from plumbline.operators import profile as P
from plumbline.session import scratch_folder
from plumbline.sources.text import NA_TOKENS, infer_types, normalise_missing, read_table, shape_report

REPORTS, SQL, report = make_registry()

_NUMS = ["price", "price_dup", "k_const", "tiny"]

_FILLED = f"""WITH {ORDERS_DS}, med AS (
  SELECT median(price) AS m1, median(price_dup) AS m2, median(k_const) AS m3, median(tiny) AS m4 FROM orders_ds),
codes AS (SELECT status, row_number() OVER (ORDER BY status) - 1 AS y FROM (SELECT DISTINCT status FROM orders_ds)),
long AS (
  SELECT 'price' AS col, coalesce(price, m1) AS x, m1 AS med, CAST(y AS DOUBLE) AS y
    FROM orders_ds JOIN codes USING (status), med
  UNION ALL SELECT 'price_dup', coalesce(price_dup, m2), m2, CAST(y AS DOUBLE)
    FROM orders_ds JOIN codes USING (status), med
  UNION ALL SELECT 'k_const', coalesce(k_const, m3), m3, CAST(y AS DOUBLE)
    FROM orders_ds JOIN codes USING (status), med
  UNION ALL SELECT 'tiny', coalesce(tiny, m4), m4, CAST(y AS DOUBLE)
    FROM orders_ds JOIN codes USING (status), med),
stats AS (
  SELECT col, max(med) AS med, var_samp(x) AS v, stddev_samp(x) AS s, covar_samp(x, y) AS cov,
         CASE WHEN stddev_samp(x) * stddev_samp(y) = 0 THEN NULL
              ELSE covar_samp(x, y) / (stddev_samp(x) * stddev_samp(y)) END AS r
  FROM long GROUP BY col)"""


@report(_FILLED + """
SELECT col AS "column", round(med, 4) AS median, round(v / 1e6, 6) AS variance_millions,
       round(cov, 4) + 0.0 AS covariance, round(r, 6) + 0.0 AS r
FROM stats""")
def numeric_profile(spark, sf_dir):
    df = orders_ds(spark, sf_dir)
    rows = df.count()
    medians = exact_medians(df, _NUMS, rows)
    stats = P.target_statistics(P.numeric_target(df, "status", "_y", rows), _NUMS, medians, "_y")
    out = spark.createDataFrame(
        [(c, medians[c], s["variance"], s["covariance"], s["r"]) for c, s in stats.items()],
        "column string, median double, variance double, covariance double, r double")
    return out.select("column", r6("median", 4).alias("median"),
                      r6(F.col("variance") / 1e6).alias("variance_millions"),
                      (r6("covariance", 4) + 0.0).alias("covariance"), (r6("r") + 0.0).alias("r"))


@report(_FILLED + """
SELECT col AS "column", CASE WHEN v <= 0.0 THEN 'drop' ELSE 'keep' END AS decision FROM stats""")
def variance_filter(spark, sf_dir):
    df = orders_ds(spark, sf_dir).select("row_id", *_NUMS, "status")
    result = P.filter_supervised(df, "status", corr_threshold=0.0, multicollinearity_threshold=2.0,
                                 exclude=("row_id",))
    return result.report(spark).select("column", "decision")


@report(_FILLED + """
SELECT col AS "column", CASE WHEN v <= 0.0 OR abs(r) < 0.05 THEN 'drop' ELSE 'keep' END AS decision,
       CASE WHEN v <= 0.0 THEN NULL ELSE round(abs(r), 6) END AS abs_corr
FROM stats""")
def corr_filter(spark, sf_dir):
    df = orders_ds(spark, sf_dir).select("row_id", *_NUMS, "status")
    result = P.filter_supervised(df, "status", exclude=("row_id",))
    return result.report(spark).select("column", "decision", r6("abs_corr").alias("abs_corr"))


_DOC_NUMS = ["n_chars", "n_lines", "n_words"]


@report(f"""WITH {DOCS_DS}
SELECT 'n_chars' AS a, 'n_lines' AS b, round(corr(n_chars, n_lines), 6) AS r FROM docs_ds
UNION ALL SELECT 'n_chars', 'n_words', round(corr(n_chars, n_words), 6) FROM docs_ds
UNION ALL SELECT 'n_lines', 'n_words', round(corr(n_lines, n_words), 6) FROM docs_ds""")
def pairwise_corr(spark, sf_dir):
    df = docs_ds(spark, sf_dir)
    m = P.pairwise_correlation(df, _DOC_NUMS, dict.fromkeys(_DOC_NUMS))
    pairs = [(_DOC_NUMS[i], _DOC_NUMS[j], float(m[i, j])) for i in range(3) for j in range(i + 1, 3)]
    return spark.createDataFrame(pairs, "a string, b string, r double").withColumn("r", r6("r"))


@report(f"""WITH {DOCS_DS}, t AS (
  SELECT abs(corr(n_chars, quality)) AS c, abs(corr(n_lines, quality)) AS l, abs(corr(n_words, quality)) AS w,
         abs(corr(n_chars, n_lines)) AS cl, abs(corr(n_chars, n_words)) AS cw, abs(corr(n_lines, n_words)) AS lw
  FROM docs_ds),
s1 AS (SELECT *, CASE WHEN cl < 0.95 THEN '' WHEN c >= l THEN 'n_lines' ELSE 'n_chars' END AS d1 FROM t),
s2 AS (SELECT *, CASE WHEN d1 = 'n_chars' OR cw < 0.95 THEN '' WHEN c >= w THEN 'n_words' ELSE 'n_chars' END AS d2
       FROM s1),
s3 AS (SELECT *, CASE WHEN d1 = 'n_lines' OR d2 = 'n_words' OR lw < 0.95 THEN ''
                      WHEN l >= w THEN 'n_words' ELSE 'n_lines' END AS d3 FROM s2)
SELECT u.col AS "column", CASE WHEN u.col IN (d1, d2, d3) THEN 'drop' ELSE 'keep' END AS decision
FROM s3, (VALUES ('n_chars'), ('n_lines'), ('n_words')) AS u(col)""")
def multicollinear_drops(spark, sf_dir):
    df = docs_ds(spark, sf_dir).select("row_id", *_DOC_NUMS, "quality")
    result = P.filter_supervised(df, "quality", corr_threshold=0.0, exclude=("row_id",))
    return result.report(spark).select("column", "decision")


@report("""SELECT 'c_name' AS "column", count(DISTINCT c_name) AS n_distinct, count(*) AS n_rows FROM customer
UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment), count(*) FROM customer""")
def categorical_profile(spark, sf_dir):
    df = load(spark, sf_dir, "customer")
    counts = P.distinct_counts(df, ["c_name", "c_mktsegment"])
    rows = df.count()
    return spark.createDataFrame([(c, n, rows) for c, n in counts.items()],
                                 "column string, n_distinct bigint, n_rows bigint")


@report(f"""WITH {ORDERS_DS}
SELECT 'priority' AS "column", count(DISTINCT priority) <= 1 AS is_constant FROM orders_ds
UNION ALL SELECT 'cat_const', count(DISTINCT cat_const) <= 1 FROM orders_ds
UNION ALL SELECT 'id_like', count(DISTINCT id_like) <= 1 FROM orders_ds""")
def constant_cat(spark, sf_dir):
    facts = P.column_facts(orders_ds(spark, sf_dir), ["priority", "cat_const", "id_like"])
    return spark.createDataFrame(list(facts.constant.items()), "column string, is_constant boolean")


@report(f"""WITH {ORDERS_DS}
SELECT 'priority' AS "column", count(DISTINCT priority) / count(*) > 0.95 AS is_id FROM orders_ds
UNION ALL SELECT 'id_like', count(DISTINCT id_like) / count(*) > 0.95 FROM orders_ds
UNION ALL SELECT 'status', count(DISTINCT status) / count(*) > 0.95 FROM orders_ds""")
def id_like(spark, sf_dir):
    df = orders_ds(spark, sf_dir).select("priority", "id_like", "status")
    dropped = P.filter_unsupervised(df).dropped
    return spark.createDataFrame([(c, c in dropped) for c in df.columns], "column string, is_id boolean")


@report(f"""WITH {ORDERS_DS}, m AS (SELECT median(price) AS m1 FROM orders_ds),
s AS (
  SELECT 'price' AS col, stddev_samp(coalesce(price, m1)) AS sd FROM orders_ds, m
  UNION ALL SELECT 'price_dup', stddev_samp(price_dup) FROM orders_ds
  UNION ALL SELECT 'k_const', stddev_samp(k_const) FROM orders_ds
  UNION ALL SELECT 'tiny', stddev_samp(tiny) FROM orders_ds)
SELECT col AS "column",
       CASE WHEN sd = 0 THEN 'variance' WHEN sd < 0.01 THEN 'low_spread' ELSE 'kept' END AS method FROM s""")
def low_spread_filter(spark, sf_dir):
    result = P.filter_unsupervised(orders_ds(spark, sf_dir).select(*_NUMS))
    return result.report(spark).select("column", F.coalesce("method", F.lit("kept")).alias("method"))


_REPORT_SQL = _FILLED + f"""
SELECT col AS "column", 'numeric' AS kind, round(v / 1e6, 6) AS variance_millions,
       CASE WHEN v <= 0 THEN NULL ELSE round(cov, 4) + 0.0 END AS covariance,
       CASE WHEN v <= 0 THEN NULL ELSE round(abs(r), 6) END AS abs_corr,
       CASE WHEN v <= 0 THEN 'drop' WHEN abs(r) < 0.05 THEN 'drop' ELSE 'keep' END AS decision,
       CASE WHEN v <= 0 THEN 'variance' WHEN abs(r) < 0.05 THEN 'target_correlation' END AS method
FROM stats
UNION ALL
SELECT c, 'categorical', NULL, NULL, NULL, CASE WHEN d <= 1 THEN 'drop' ELSE 'keep' END,
       CASE WHEN d <= 1 THEN 'constant_category' END
FROM (SELECT 'priority' AS c, count(DISTINCT priority) AS d FROM orders_ds
      UNION ALL SELECT 'cat_const', count(DISTINCT cat_const) FROM orders_ds
      UNION ALL SELECT 'id_like', count(DISTINCT id_like) FROM orders_ds)"""


@report(_REPORT_SQL)
def feature_report(spark, sf_dir):
    result = P.filter_supervised(orders_ds(spark, sf_dir), "status", exclude=("row_id",))
    return result.report(spark).select(
        "column", "kind", r6(F.col("variance") / 1e6).alias("variance_millions"),
        (r6("covariance", 4) + 0.0).alias("covariance"), r6("abs_corr").alias("abs_corr"), "decision", "method")


@report(f"""WITH {DOCS_DS}
SELECT column_name AS "column", CASE WHEN column_type = 'VARCHAR' THEN 'categorical' ELSE 'numeric' END AS kind
FROM (SUMMARIZE SELECT * EXCLUDE (row_id, quality, toxic) FROM docs_ds)
WHERE CASE WHEN column_type = 'VARCHAR' THEN approx_unique > 1 ELSE CAST(std AS DOUBLE) > 0 END""")
def remaining_features(spark, sf_dir):
    df = docs_ds(spark, sf_dir).drop("row_id", "quality")
    result = P.filter_supervised(df, "toxic", corr_threshold=0.0, multicollinearity_threshold=2.0)
    return P.remaining_features(df, result)


@report("""SELECT 'orders.o_orderstatus' AS target, count(DISTINCT o_orderstatus) AS n_distinct,
  'classification' AS task FROM orders
UNION ALL SELECT 'part.p_retailprice', count(DISTINCT p_retailprice),
  CASE WHEN count(DISTINCT p_retailprice) <= 20 THEN 'classification' ELSE 'regression' END FROM part
UNION ALL SELECT 'part.p_size', count(DISTINCT p_size),
  CASE WHEN count(DISTINCT p_size) <= 20 THEN 'classification' ELSE 'regression' END FROM part
UNION ALL SELECT 'part.p_brand', count(DISTINCT p_brand), 'classification' FROM part
UNION ALL SELECT 'lineitem.l_linenumber', count(DISTINCT l_linenumber),
  CASE WHEN count(DISTINCT l_linenumber) <= 20 THEN 'classification' ELSE 'regression' END FROM lineitem""")
def task_type(spark, sf_dir):
    found = None
    for table, cols in (("orders", ["o_orderstatus"]), ("part", ["p_retailprice", "p_size", "p_brand"]),
                        ("lineitem", ["l_linenumber"])):
        one = P.target_profile(load(spark, sf_dir, table), cols).select(
            F.concat(F.lit(table + "."), "target").alias("target"), "n_distinct", "task")
        found = one if found is None else found.unionByName(one)
    return found


def _raw_text(spark, sf_dir):
    """Event payloads as text columns with missing-value tokens and mixed types."""
    e = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    tokens = F.array(*[F.lit(t) for t in NA_TOKENS])
    return e.select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, F.element_at(tokens, (F.col("event_id") % len(NA_TOKENS) + 1).cast("int")))
        .otherwise(k).alias("k_missing"),
        k.alias("k_whole"),
        F.concat(k, F.lit(".5")).alias("k_half"),
        F.when(F.col("event_id") % 2 == 0, "True").otherwise("false").alias("flag"),
        "event_type")


_TOKENS_SQL = "[" + ", ".join(f"'{t}'" for t in NA_TOKENS) + "]"
_RAW_SQL = f"""WITH raw AS (
  SELECT event_id,
         CASE WHEN event_id % 5 = 0 THEN ({_TOKENS_SQL})[CAST(event_id % {len(NA_TOKENS)} + 1 AS INT)]
              ELSE json_extract_string(props, '$.k') END AS k_missing,
         json_extract_string(props, '$.k') AS k_whole,
         json_extract_string(props, '$.k') || '.5' AS k_half,
         CASE WHEN event_id % 2 = 0 THEN 'True' ELSE 'false' END AS flag, event_type
  FROM events), clean AS (
  SELECT * REPLACE (CASE WHEN k_missing IN (SELECT unnest({_TOKENS_SQL})) THEN NULL ELSE k_missing END AS k_missing)
  FROM raw)"""


@report(_RAW_SQL + " SELECT event_id, k_missing, k_whole, event_type FROM clean")
def na_normalise(spark, sf_dir):
    return normalise_missing(_raw_text(spark, sf_dir)).select("event_id", "k_missing", "k_whole", "event_type")


@report(_RAW_SQL + """
SELECT 'k_missing' AS "column", CASE WHEN count(k_missing) = count(TRY_CAST(k_missing AS BIGINT))
   THEN CASE WHEN count(k_missing) = count(*) THEN 'bigint' ELSE 'double' END ELSE 'string' END AS dtype FROM clean
UNION ALL SELECT 'k_whole', CASE WHEN count(k_whole) = count(TRY_CAST(k_whole AS BIGINT))
   THEN 'bigint' ELSE 'string' END FROM clean
UNION ALL SELECT 'k_half', CASE WHEN count(k_half) = count(TRY_CAST(k_half AS DOUBLE))
   THEN 'double' ELSE 'string' END FROM clean
UNION ALL SELECT 'flag', CASE WHEN count(*) = count(TRY_CAST(flag AS BOOLEAN)) THEN 'boolean' ELSE 'string' END
   FROM clean
UNION ALL SELECT 'event_type', CASE WHEN count(event_type) = count(TRY_CAST(event_type AS DOUBLE))
   THEN 'double' ELSE 'string' END FROM clean""")
def type_infer(spark, sf_dir):
    typed = infer_types(normalise_missing(_raw_text(spark, sf_dir).drop("event_id")))
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in typed.schema.fields],
                                 "column string, dtype string")


@report("SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM orders")
def shape(spark, sf_dir):
    return shape_report(read_table(spark, f"{sf_dir}/orders.parquet"))


@report("""SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def csv_scan(spark, sf_dir):
    path = scratch_folder(spark, "customer") + ".csv"
    load(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return read_table(spark, path)
