"""Reports on imputation, de-skewing, encoding, scaling, splits, folds and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalogue.registry import make_registry
from plumbline.catalogue.tables import DOCS_DS, ORDERS_DS, docs_ds, load, orders_ds, part_ds, r6
from plumbline.functions.columns import bias_corrected_skew, filled
from plumbline.functions.dictionary import build_dictionary
from plumbline.functions.medians import exact_medians
from plumbline.operators import metrics as M
from plumbline.operators import split as S
from plumbline.operators.prepare import fit_preparation
from plumbline.operators.profile import numeric_target

REPORTS, SQL, report = make_registry()


@report(f"""WITH {ORDERS_DS}, m AS (SELECT median(price) AS m FROM orders_ds)
SELECT row_id, round(coalesce(price, m), 4) AS price FROM orders_ds, m""")
def median_impute(spark, sf_dir):
    df = orders_ds(spark, sf_dir)
    m = exact_medians(df, ["price"])
    return df.select("row_id", r6(filled("price", m["price"]), 4).alias("price"))


@report(f"""WITH {ORDERS_DS}, m AS (
  SELECT priority AS m FROM orders_ds WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT row_id, coalesce(priority, m) AS priority FROM orders_ds, m""")
def mode_impute(spark, sf_dir):
    df = orders_ds(spark, sf_dir)
    m = build_dictionary(df, ["priority"]).modes
    return df.select("row_id", filled("priority", m["priority"]).alias("priority"))


@report("""SELECT 'events.value' AS "column", round(skewness(value), 5) AS skew FROM events
UNION ALL SELECT 'documents.n_chars', round(skewness(n_chars), 5) FROM documents
UNION ALL SELECT 'part.p_size', round(skewness(p_size), 5) + 0.0 FROM part
UNION ALL SELECT 'customer.c_acctbal', round(skewness(c_acctbal), 5) + 0.0 FROM customer""")
def skew_g1(spark, sf_dir):
    out = None
    for table, c in (("events", "value"), ("documents", "n_chars"), ("part", "p_size"), ("customer", "c_acctbal")):
        one = load(spark, sf_dir, table).agg(
            (r6(bias_corrected_skew(F.col(c).cast("double")), 5) + 0.0).alias("skew")).select(
            F.lit(f"{table}.{c}").alias("column"), "skew")
        out = one if out is None else out.unionByName(one)
    return out


@report("""WITH g AS (SELECT skewness(value) AS s, min(value) AS lo FROM events)
SELECT event_id, round(CASE WHEN abs(s) > 0.75 AND lo >= 0 THEN ln(1 + value) ELSE value END, 6) AS value
FROM events, g""")
def log1p_conditional(spark, sf_dir):
    df = load(spark, sf_dir, "events").select("event_id", "value")
    return fit_preparation(df, ["value"]).unscaled(df).select("event_id", r6("value").alias("value"))


@report("""SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS brand_code,
  dense_rank() OVER (ORDER BY p_type) - 1 AS type_code FROM part""")
def label_encode(spark, sf_dir):
    df = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    out = fit_preparation(df, ["p_brand", "p_type"]).unscaled(df)
    return out.select("p_partkey", F.col("p_brand").cast("bigint").alias("brand_code"),
                      F.col("p_type").cast("bigint").alias("type_code"))


_PREPARED = f"""WITH {ORDERS_DS},
m AS (SELECT median(price) AS m FROM orders_ds),
mo AS (SELECT priority AS p FROM orders_ds WHERE priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
f AS (SELECT row_id, status, coalesce(price, m) AS price, coalesce(priority, p) AS priority FROM orders_ds, m, mo),
c AS (SELECT row_id, status, price, CAST(dense_rank() OVER (ORDER BY priority) - 1 AS DOUBLE) AS priority FROM f),
t AS (SELECT avg(price) AS m1, stddev_pop(price) AS s1, skewness(price) AS g1, avg(priority) AS m2,
             stddev_pop(priority) AS s2 FROM c)"""


@report(_PREPARED + """
SELECT row_id, round((price - m1) / s1, 6) + 0.0 AS price, round((priority - m2) / s2, 6) + 0.0 AS priority
FROM c, t""")
def standard_scale(spark, sf_dir):
    df = orders_ds(spark, sf_dir)
    x = fit_preparation(df, ["price", "priority"]).transform(df, ["row_id"], vector=False)
    return x.select("row_id", (r6(F.col("x")[0]) + 0.0).alias("price"), (r6(F.col("x")[1]) + 0.0).alias("priority"))


@report(_PREPARED + """
SELECT row_id, CAST(dense_rank() OVER (ORDER BY status) - 1 AS DOUBLE) AS label,
       round((price - m1) / s1, 6) + 0.0 AS x0, round((priority - m2) / s2, 6) + 0.0 AS x1
FROM c, t""")
def assembled_features(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    df = orders_ds(spark, sf_dir)
    coded = numeric_target(df, "status", "label", df.count())
    v = fit_preparation(df, ["price", "priority"]).transform(coded, ["row_id", "label"])
    a = vector_to_array("features")
    return v.select("row_id", "label", (r6(a[0]) + 0.0).alias("x0"), (r6(a[1]) + 0.0).alias("x1"))


@report(_PREPARED + """
SELECT 'price' AS "column", 'numeric' AS role, round(g1, 5) + 0.0 AS skew, abs(g1) > 0.75 AS log1p,
       round(m1, 4) AS mean, round(s1, 4) AS std FROM t
UNION ALL SELECT 'priority', 'categorical', NULL, FALSE, round(m2, 4), round(s2, 4) FROM t""")
def prep_report(spark, sf_dir):
    df = orders_ds(spark, sf_dir)
    r = fit_preparation(df, ["price", "priority"]).report(spark)
    return r.select("column", "role", (r6("skew", 5) + 0.0).alias("skew"), "log1p", r6("mean", 4).alias("mean"),
                    r6("std", 4).alias("std"))


@report(f"""WITH {ORDERS_DS}
SELECT row_id, CAST(dense_rank() OVER (ORDER BY coalesce(priority, 'missing')) - 1 AS DOUBLE) AS target
FROM orders_ds""")
def target_encode(spark, sf_dir):
    df = orders_ds(spark, sf_dir)
    return numeric_target(df, "priority", "target", df.count()).select("row_id", "target")


@report("""SELECT o_orderkey AS row_id,
  row_number() OVER (ORDER BY md5('42-' || o_orderkey)) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM orders""")
def holdout_split(spark, sf_dir):
    df = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"))
    return S.holdout_split(df).select("row_id", "is_test")


@report("""SELECT o_orderkey AS row_id, CAST(ntile(5) OVER (ORDER BY md5('42-' || o_orderkey)) - 1 AS INT) AS fold
FROM orders""")
def kfold(spark, sf_dir):
    df = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"))
    return S.contiguous_folds(df.withColumn("order_key", S.order_key("row_id", 42))).select("row_id", "fold")


def _dealt(f: int) -> str:
    return f"(floor((s + n - 1 - {f}) / 5.0) - floor((s - 1 - {f}) / 5.0))"


@report(f"""WITH r AS (
  SELECT event_id AS row_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5('42-' || event_id)) AS rn
  FROM events),
c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1),
s AS (SELECT event_type, n, coalesce(sum(n) OVER (ORDER BY event_type ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS s FROM c),
e AS (SELECT event_type, {_dealt(0)} AS e0, {_dealt(0)} + {_dealt(1)} AS e1, {_dealt(0)} + {_dealt(1)} + {_dealt(2)} AS e2,
  {_dealt(0)} + {_dealt(1)} + {_dealt(2)} + {_dealt(3)} AS e3 FROM s)
SELECT row_id, CAST(CASE WHEN rn <= e0 THEN 0 WHEN rn <= e1 THEN 1 WHEN rn <= e2 THEN 2 WHEN rn <= e3 THEN 3 ELSE 4 END
  AS INT) AS fold FROM r JOIN e USING (event_type)""")
def stratified_kfold(spark, sf_dir):
    df = load(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), "event_type")
    keyed = df.withColumn("order_key", S.order_key("row_id", 42))
    return S.stratified_folds(keyed, "event_type").select("row_id", "fold")


def _price_predictions(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    means = li.groupBy("l_quantity").agg(F.avg("label").alias("prediction"))
    return li.join(means, "l_quantity")


@report("""WITH p AS (SELECT l_extendedprice AS y, avg(l_extendedprice) OVER (PARTITION BY l_quantity) AS p FROM lineitem)
SELECT round(1 - sum((y - p) * (y - p)) / (SELECT sum((y - a) * (y - a)) FROM p, (SELECT avg(y) AS a FROM p)), 6) AS r2,
       round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse FROM p""")
def regression_metrics(spark, sf_dir):
    m = M.regression_metrics(_price_predictions(spark, sf_dir))
    return m.select(r6("r2").alias("r2"), r6("mae", 4).alias("mae"), r6("rmse", 4).alias("rmse"))


def _event_predictions(spark, sf_dir):
    p = F.when(F.col("value") >= 50, "click").when(F.col("value") >= 10, "view").otherwise("error")
    return load(spark, sf_dir, "events").select(F.col("event_type").alias("label"), p.alias("prediction"))


_EVENTS_P = """WITH p AS (SELECT event_type AS y,
  CASE WHEN value >= 50 THEN 'click' WHEN value >= 10 THEN 'view' ELSE 'error' END AS p FROM events),
c AS (SELECT c, sum(s) AS support, sum(q) AS predicted, sum(h) AS hits FROM (
  SELECT y AS c, 1 AS s, 0 AS q, CASE WHEN y = p THEN 1 ELSE 0 END AS h FROM p
  UNION ALL SELECT p, 0, 1, 0 FROM p) GROUP BY c),
f AS (SELECT c, support, predicted, hits,
  CASE WHEN support + predicted = 0 THEN 0 ELSE 2.0 * hits / (support + predicted) END AS f1 FROM c)"""


@report(_EVENTS_P + """
SELECT round(sum(hits) / sum(support), 6) AS accuracy, round(sum(f1 * support) / sum(support), 6) AS f1 FROM f""")
def classification_metrics(spark, sf_dir):
    m = M.classification_metrics(_event_predictions(spark, sf_dir))
    return m.select(r6("accuracy").alias("accuracy"), r6("f1").alias("f1"))


@report(_EVENTS_P + """
SELECT c AS class, CAST(support AS BIGINT) AS support, round(f1, 6) AS f1 FROM f""")
def weighted_f1(spark, sf_dir):
    s = M.class_scores(_event_predictions(spark, sf_dir))
    return s.select(F.col("c").alias("class"), "support", r6("f1").alias("f1"))


@report(f"""WITH {DOCS_DS}, t AS (SELECT median(n_chars) AS m, skewness(n_chars) AS g, min(n_chars) AS lo FROM docs_ds),
v AS (SELECT row_id, CASE WHEN abs(g) > 0.75 AND lo >= 0 THEN ln(1 + n_chars) ELSE n_chars END AS c,
        CAST(dense_rank() OVER (ORDER BY lang) - 1 AS DOUBLE) AS l FROM docs_ds, t),
s AS (SELECT avg(c) AS mc, stddev_pop(c) AS sc, avg(l) AS ml, stddev_pop(l) AS sl FROM v)
SELECT row_id, round((c - mc) / sc, 6) + 0.0 AS n_chars, round((l - ml) / sl, 6) + 0.0 AS lang FROM v, s""")
def scaled_documents(spark, sf_dir):
    df = docs_ds(spark, sf_dir)
    x = fit_preparation(df, ["n_chars", "lang"]).transform(df, ["row_id"], vector=False)
    return x.select("row_id", (r6(F.col("x")[0]) + 0.0).alias("n_chars"), (r6(F.col("x")[1]) + 0.0).alias("lang"))


@report("""SELECT column_name AS "column", CASE WHEN column_type = 'VARCHAR' THEN 'categorical' ELSE 'numeric' END AS role
FROM (DESCRIBE SELECT p_size, p_brand, p_type FROM part)""")
def feature_roles(spark, sf_dir):
    df = part_ds(spark, sf_dir)
    return fit_preparation(df, ["p_size", "p_brand", "p_type"]).report(spark).select("column", "role")
