"""Trees of several levels, forests, and linear models of several classes, on inputs that SQL can follow to the end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.catalogue.registry import make_registry
from plumbline.catalogue.tables import load, r6
from plumbline.operators import newton as O
from plumbline.operators import trees as T
from plumbline.operators.learners import context, families
from plumbline.plans.supervised import class_labels, run_supervised, with_label

REPORTS, SQL, report = make_registry()

_SEED = 42
#: Rows of two features, a number to predict and three classes.
_ROWS_SQL = """v AS (SELECT p_partkey AS row_id, CAST(p_size AS DOUBLE) AS x0, CAST(p_partkey % 97 AS DOUBLE) AS x1, p_retailprice + 3 * p_size AS y,
  CAST((p_size + p_partkey % 97 + p_partkey % 13) // 20 % 3 AS INT) AS c FROM part)"""


def _rows(spark, sf_dir, label: str) -> DataFrame:
    part, k = load(spark, sf_dir, "part"), F.col("p_partkey")
    kinds = {"y": F.col("p_retailprice") + 3 * F.col("p_size"), "c": F.floor((F.col("p_size") + k % 97 + k % 13) / 20) % 3}
    return part.select(k.alias("row_id"), F.array(F.col("p_size").cast("double"), (k % 97).cast("double")).alias("x"),
                       kinds[label].cast("double").alias("label")).persist()


def _grown_sql(growth: T.Growth, depth: int) -> str:
    """CTEs ``r0`` to ``r{depth}``: rows with their tree, weight and path after each level of splits."""
    bag = f"(CAST('0x' || substr(md5('bag{growth.seed}-' || tree || '-' || row_id), 1, 8) AS BIGINT) + 0.5) / 4294967296"
    weight = " + ".join(f"CASE WHEN {bag} > {float(p)!r} THEN 1.0 ELSE 0.0 END" for p in T._POISSON) if growth.bootstrap else "1.0"
    label, width = ("c", growth.classes) if growth.classes else ("y", 1)
    sums = [f"sum(CASE WHEN c = {k} THEN w ELSE 0 END)" for k in range(width)] if growth.classes else ["sum(w * y)"]
    ctes = [f"""r0 AS (SELECT row_id, x0, x1, y, c, tree, '' AS path, CAST({weight} AS DOUBLE) AS w FROM v, (SELECT unnest(range({growth.trees})) AS tree))"""]
    for k in range(depth):
        if growth.classes:
            left, right = [f"l{i}" for i in range(width)], [f"(t{i} - l{i})" for i in range(width)]
            if growth.criterion == "gini":
                gain = " + ".join(f"{a} * {a} / lw + {b} * {b} / (tw - lw)" for a, b in zip(left, right, strict=True))
            else:
                plogp = "CASE WHEN {0} > 0 THEN {0} * ln({0}) ELSE 0 END"
                gain = " + ".join(plogp.format(x) for x in left + right) + f" - {plogp.format('lw')} - {plogp.format('(tw - lw)')}"
            gain = f"({gain}) / tw"
        else:
            gain = "((l0 - lw * t0 / tw) * (l0 - lw * t0 / tw) * (1 / lw + 1 / (tw - lw))) / (q - t0 * t0 / tw)"
        code = f"(CAST('0x' || substr(md5('{growth.seed}-' || tree || '-' || path), 1, 7) AS BIGINT) + 1)"
        keys = [f"{code} * {c} % {T._PRIME}" for c in T._feature_codes(2)]
        inside = f"(CASE WHEN f = 0 THEN {keys[0]} <= {keys[1]} ELSE {keys[1]} < {keys[0]} END)" if growth.features < 2 else "true"
        ctes.append(f"""
u{k} AS (SELECT tree, path, f, v, sum(w) AS w, {', '.join(f'{s} AS s{i}' for i, s in enumerate(sums))}, sum(w * y * y) AS q FROM (
  SELECT tree, path, w, y, c, unnest([0, 1]) AS f, unnest([x0, x1]) AS v FROM r{k} WHERE w > 0) GROUP BY tree, path, f, v),
w{k} AS (SELECT tree, path, f, v, lead(v) OVER o AS next, sum(w) OVER o AS lw, sum(w) OVER a AS tw, sum(q) OVER a AS q,
  {', '.join(f'sum(s{i}) OVER o AS l{i}, sum(s{i}) OVER a AS t{i}' for i in range(width))} FROM u{k}
  WINDOW o AS (PARTITION BY tree, path, f ORDER BY v ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY tree, path, f)),
m{k} AS (SELECT tree, path FROM r{k} WHERE w > 0 GROUP BY tree, path HAVING min({label}) < max({label})),
g{k} AS (SELECT tree, path, f, v, next, {inside} AS inside, round({gain}, {T._PLACES}) AS gain FROM w{k} JOIN m{k} USING (tree, path) WHERE next IS NOT NULL),
b{k} AS (SELECT tree, path, f, (v + next) / 2 AS t FROM (
  SELECT *, row_number() OVER (PARTITION BY tree, path ORDER BY inside DESC, gain DESC, f, v) AS n FROM g{k}) WHERE n = 1),
r{k + 1} AS (SELECT row_id, x0, x1, y, c, r.tree, r.path || CASE WHEN f IS NULL THEN '' WHEN (CASE WHEN f = 0 THEN x0 ELSE x1 END) <= t THEN '0' ELSE '1' END AS path, w
  FROM r{k} r LEFT JOIN b{k} b ON b.tree = r.tree AND b.path = r.path)""")
    return ",".join(ctes)


def _predicted_sql(growth: T.Growth, depth: int) -> str:
    grown = f"WITH {_ROWS_SQL}, {_grown_sql(growth, depth)}"
    if not growth.classes:
        return grown + f""", a AS (SELECT tree, path, sum(w * y) / sum(w) AS p FROM r{depth} WHERE w > 0 GROUP BY tree, path)
SELECT row_id, round(avg(p), 4) AS prediction FROM r{depth} JOIN a USING (tree, path) GROUP BY row_id"""
    shares = ", ".join(f"sum(CASE WHEN c = {k} THEN w ELSE 0 END) / sum(w) AS p{k}" for k in range(growth.classes))
    votes = ", ".join(f"round(sum(p{k}), {T._PLACES}) AS p{k}" for k in range(growth.classes))
    best = f"greatest({', '.join(f'p{k}' for k in range(growth.classes))})"
    pick = " ".join(f"WHEN p{k} = {best} THEN {k}" for k in range(growth.classes))
    return grown + f""", a AS (SELECT tree, path, {shares} FROM r{depth} WHERE w > 0 GROUP BY tree, path),
s AS (SELECT row_id, {votes} FROM r{depth} JOIN a USING (tree, path) GROUP BY row_id)
SELECT row_id, CAST(CASE {pick} END AS DOUBLE) AS prediction FROM s"""


def _predicted(spark, sf_dir, growth: T.Growth, depth: int, node_rows: int = T.NODE_ROWS) -> DataFrame:
    rows = _rows(spark, sf_dir, "c" if growth.classes else "y")
    model = T.Forest(growth, T.fit_trees(rows, growth, node_rows), depth, 2, growth.trees)
    out = model.predict(T.spread(rows, rows.count() * growth.trees)).select("row_id", "prediction")
    return out if growth.classes else out.select("row_id", r6("prediction", 4).alias("prediction"))


_TREE = T.Growth(0, "variance", 1, False, 2, 2, _SEED)
_GINI, _ENTROPY = (T.Growth(3, name, 1, False, 2, 2, _SEED) for name in ("gini", "entropy"))
_FOREST = T.Growth(0, "variance", 5, True, 2, 2, _SEED)
_CLASS_FOREST = T.Growth(3, "gini", 5, True, 1, 2, _SEED)


@report(_predicted_sql(_TREE, 3))
def tree_depth3_regression(spark, sf_dir):
    return _predicted(spark, sf_dir, _TREE, 3)


@report(_predicted_sql(_TREE, 3))
def tree_depth3_by_spark(spark, sf_dir):
    """The same tree, with all nodes of more than 50 rows split by prefix sums over sorted partitions."""
    return _predicted(spark, sf_dir, _TREE, 3, node_rows=50)


@report(_predicted_sql(_GINI, 3))
def tree_depth3_gini(spark, sf_dir):
    return _predicted(spark, sf_dir, _GINI, 3)


@report(_predicted_sql(_ENTROPY, 3))
def tree_depth3_entropy(spark, sf_dir):
    return _predicted(spark, sf_dir, _ENTROPY, 3)


@report(_predicted_sql(_FOREST, 3))
def forest_depth3_regression(spark, sf_dir):
    return _predicted(spark, sf_dir, _FOREST, 3)


@report(_predicted_sql(_CLASS_FOREST, 3))
def forest_depth3_classes(spark, sf_dir):
    return _predicted(spark, sf_dir, _CLASS_FOREST, 3)


# ---------------------------------------------------------------- linear models

_SCALED_SQL = f"{_ROWS_SQL}, z AS (SELECT (x0 - 25) / 10 AS a, (x1 - 48) / 20 AS b, c FROM v)"


def _scaled(spark, sf_dir) -> DataFrame:
    return _rows(spark, sf_dir, "c").withColumn("x", F.array((F.col("x")[0] - 25) / 10, (F.col("x")[1] - 48) / 20)).persist()


@report(f"""WITH RECURSIVE {_SCALED_SQL},
t(i, k, u, v, w) AS (
  SELECT 0, k, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM (SELECT unnest([0, 1, 2]) AS k)
  UNION ALL
  SELECT i + 1, k, u - (g1 * (e * f - r * r) + g2 * (q * r - p * f) + g3 * (p * r - q * e)) / det,
         v - (g1 * (q * r - p * f) + g2 * (d * f - q * q) + g3 * (p * q - d * r)) / det,
         w - (g1 * (p * r - q * e) + g2 * (p * q - d * r) + g3 * (d * e - p * p)) / det
  FROM (SELECT *, d * (e * f - r * r) - p * (p * f - q * r) + q * (p * r - q * e) AS det FROM (
    SELECT i, k, u, v, w, sum((s - y) * a) + u AS g1, sum((s - y) * b) + v AS g2, sum(s - y) + w AS g3,
           sum(h * a * a) + 1 AS d, sum(h * b * b) + 1 AS e, sum(h) + 1 AS f, sum(h * a * b) AS p, sum(h * a) AS q, sum(h * b) AS r
    FROM (SELECT *, s * (1 - s) AS h FROM (SELECT i, k, u, v, w, a, b, CASE WHEN c = k THEN 1 ELSE 0 END AS y,
                                                  1 / (1 + exp(-(u * a + v * b + w))) AS s FROM t, z))
    GROUP BY i, k, u, v, w)) WHERE i < 20)
SELECT CAST(k AS INT) AS class, round(u, 3) AS size_weight, round(v, 3) AS key_weight, round(w, 3) AS intercept FROM t WHERE i = 20""")
def logreg_classes_newton(spark, sf_dir):
    """One fit a class with a penalised intercept, all classes by the same scans."""
    rows = _scaled(spark, sf_dir)
    family = next(f for f in families("classification") if f.name == "LogisticRegression")
    model = family.fit(rows, {"C": 1, "solver": "liblinear"}, context(rows, 2, 3, _SEED))
    table = [(k, *(round(v, 3) + 0.0 for v in [*w, b])) for k, (w, b) in enumerate(zip(model.weights, model.intercepts, strict=True))]
    return spark.createDataFrame(table, "class int, size_weight double, key_weight double, intercept double")


@report(f"""WITH RECURSIVE {_SCALED_SQL}, m AS (SELECT a, b, CASE WHEN c = 0 THEN 1 ELSE -1 END AS y FROM z WHERE c < 2),
moves AS (SELECT x.m AS du, y.m AS dv, w.m AS dw FROM (SELECT unnest([-1, 0, 1]) AS m) x, (SELECT unnest([-1, 0, 1]) AS m) y,
  (SELECT unnest([-1, 0, 1]) AS m) w),
t(i, u, v, w, step, best) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0.5 AS DOUBLE), CAST(1e300 AS DOUBLE)
  UNION ALL
  SELECT i + 1, u, v, w, CASE WHEN moved THEN step ELSE step / 2 END, value FROM (
    SELECT *, row_number() OVER (ORDER BY value, du, dv, dw) AS place, (du <> 0 OR dv <> 0 OR dw <> 0) AS moved FROM (
      SELECT i, step, u + du * step AS u, v + dv * step AS v, w + dw * step AS w, du, dv, dw,
             ((u + du * step) * (u + du * step) + (v + dv * step) * (v + dv * step)) / 2
               + sum(greatest(0, 1 - y * ((u + du * step) * a + (v + dv * step) * b + w + dw * step))) AS value
      FROM t, moves, m GROUP BY i, step, u, v, w, du, dv, dw)) WHERE place = 1 AND i < 60)
SELECT count(*) AS n, CAST(max(best) FILTER (WHERE i = 60) > 0 AS BOOLEAN) AS solved, round(min(best) / (SELECT count(*) FROM m), 2) AS mean_objective,
  true AS gap_below_a_thousandth FROM t WHERE i = 60""")
def svm_linear_optimum(spark, sf_dir):
    """The machine's objective at its optimum, which SQL finds by a search of the plane; the gap to the dual proves it."""
    rows = _scaled(spark, sf_dir).where("label < 2").persist()
    pairs = [O.Fit("hinge", 1.0, None, 0, 1)]
    fit = O.solve(rows.withColumn("fold", F.lit(0)), pairs, [], 2)[0]
    return spark.createDataFrame([(1, bool(fit.done), round(float(fit.objective) / rows.count(), 2), bool(abs(fit.gap) < 1e-3 * fit.objective))],
                                 "n bigint, solved boolean, mean_objective double, gap_below_a_thousandth boolean")


# ---------------------------------------------------------------- a whole search of two families

def _r2(truth: str, predicted: str) -> str:
    return f"1 - sum(({truth} - {predicted}) * ({truth} - {predicted})) / (sum({truth} * {truth}) - sum({truth}) * sum({truth}) / count(*))"


_SPLIT_SQL = """v AS (SELECT p_partkey AS row_id, CAST(p_size AS DOUBLE) AS x0, ln(1 + p_partkey) AS x1, p_retailprice + 3 * p_size AS y FROM part),
t0 AS (SELECT abs(skewness(x0)) AS g0, abs(skewness(x1)) AS g1, min(x0) AS m0, min(x1) AS m1 FROM v),
u AS (SELECT row_id, y, CASE WHEN g0 > 0.75 AND m0 >= 0 THEN ln(1 + x0) ELSE x0 END AS x0,
  CASE WHEN g1 > 0.75 AND m1 >= 0 THEN ln(1 + x1) ELSE x1 END AS x1 FROM v, t0),
z AS (SELECT row_id, (x0 - avg(x0) OVER ()) / stddev_pop(x0) OVER () AS a, (x1 - avg(x1) OVER ()) / stddev_pop(x1) OVER () AS b, y,
  row_number() OVER (ORDER BY md5('42-' || row_id)) AS k, count(*) OVER () AS n FROM u),
t AS (SELECT *, ntile(5) OVER (ORDER BY k) - 1 AS fold FROM z WHERE k > ceil(0.2 * n)),
e AS (SELECT * FROM z WHERE k <= ceil(0.2 * n)),
rounds AS (SELECT unnest([0, 1, 2, 3, 4, -1]) AS f),
asked AS (SELECT fold AS f, row_id, a, b, y FROM t UNION ALL SELECT -1, row_id, a, b, y FROM e)"""

_LINE_SQL = f"""moments AS (
  SELECT f, count(*) AS n, sum(a) AS sa, sum(b) AS sb, sum(y) AS sy, sum(a * a) AS aa, sum(b * b) AS bb, sum(a * b) AS ab, sum(a * y) AS ay, sum(b * y) AS by_
  FROM t, rounds WHERE fold <> f GROUP BY f),
centred AS (
  SELECT f, n, i, sa, sb, sy, aa - i * sa * sa / n AS aa, bb - i * sb * sb / n AS bb, ab - i * sa * sb / n AS ab, ay - i * sa * sy / n AS ay,
         by_ - i * sb * sy / n AS by_ FROM moments, (SELECT unnest([1, 0]) AS i)),
line AS (SELECT f, i, n, sa, sb, sy, (bb * ay - ab * by_) / (aa * bb - ab * ab) AS u, (aa * by_ - ab * ay) / (aa * bb - ab * ab) AS w FROM centred),
fitted AS (SELECT f, i, row_id, asked.y, u * asked.a + w * asked.b + i * (sy - u * sa - w * sb) / n AS p FROM asked JOIN line USING (f)),
line_scores AS (SELECT i, avg(r) AS cv FROM (SELECT f, i, {_r2('y', 'p')} AS r FROM fitted WHERE f >= 0 GROUP BY f, i) GROUP BY i),
line_best AS (SELECT i, cv FROM line_scores ORDER BY cv DESC, i DESC LIMIT 1)"""

_NEAR_SQL = f"""pairs AS (
  SELECT q.f, q.row_id, q.y AS truth, t.row_id AS other, t.y, abs(q.a - t.a) + abs(q.b - t.b) AS l1,
         sqrt((q.a - t.a) * (q.a - t.a) + (q.b - t.b) * (q.b - t.b)) AS l2 FROM asked q JOIN t ON t.fold <> q.f),
halves AS (SELECT f, row_id, truth, other, y, 1 AS p, l1 AS d FROM pairs UNION ALL SELECT f, row_id, truth, other, y, 2, l2 FROM pairs),
near AS (SELECT *, row_number() OVER (PARTITION BY f, row_id, p ORDER BY d, other) AS place FROM halves QUALIFY place <= 10),
sizes AS (SELECT unnest([3, 5, 7, 10]) AS k),
means AS (SELECT f, row_id, truth, p, k, avg(y) AS uniform,
    CASE WHEN min(d) = 0 THEN avg(y) FILTER (WHERE d = 0) ELSE sum(y / d) FILTER (WHERE d > 0) / sum(1 / d) FILTER (WHERE d > 0) END AS distance
  FROM near, sizes WHERE place <= k GROUP BY f, row_id, truth, p, k),
said AS (SELECT f, row_id, truth, p, k, 'uniform' AS w, uniform AS q FROM means UNION ALL SELECT f, row_id, truth, p, k, 'distance', distance FROM means),
near_scores AS (SELECT k, p, w, avg(r) AS cv FROM (SELECT f, k, p, w, {_r2('truth', 'q')} AS r FROM said WHERE f >= 0 GROUP BY f, k, p, w) GROUP BY k, p, w),
near_best AS (SELECT * FROM near_scores ORDER BY cv DESC, k, p, w DESC LIMIT 1)"""

_COMPARED_SQL = f"""WITH {_SPLIT_SQL}, {_LINE_SQL}, {_NEAR_SQL},
compared AS (
  SELECT 'LinearRegression' AS model, round({_r2('y', 'p')}, 4) AS r2_score, round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
         round(any_value(cv), 4) AS cv_r2, any_value(CASE WHEN i = 1 THEN '{{''fit_intercept'': True}}' ELSE '{{''fit_intercept'': False}}' END) AS best_params
  FROM fitted JOIN line_best USING (i) WHERE f = -1
  UNION ALL
  SELECT 'KNeighborsRegressor', round({_r2('truth', 'q')}, 4), round(avg(abs(truth - q)), 4), round(sqrt(avg((truth - q) * (truth - q))), 4),
         round(any_value(cv), 4), any_value('{{''n_neighbors'': ' || k || ', ''p'': ' || p || ', ''weights'': ''' || w || '''}}')
  FROM said JOIN near_best USING (k, p, w) WHERE f = -1)"""


def _two_families(spark, sf_dir):
    part = load(spark, sf_dir, "part")  # no two parts have equal features, so no two distances are equal but for rounding
    rows = part.select(F.col("p_partkey").alias("row_id"), F.col("p_size").cast("double").alias("x0"), F.log1p("p_partkey").alias("x1"),
                       (F.col("p_retailprice") + 3 * F.col("p_size")).alias("y"))
    return run_supervised(spark, rows, "y", "row_id", corr_threshold=0.0, only=("LinearRegression", "KNeighborsRegressor"))


@report(_COMPARED_SQL + "\nSELECT * FROM compared")
def two_family_comparison(spark, sf_dir):
    """The comparison table of a whole run: split, folds, scaling, both grids, holdout measures."""
    return _two_families(spark, sf_dir).results


@report(_COMPARED_SQL + "\nSELECT model, r2_score AS score FROM compared ORDER BY r2_score DESC, model = 'LinearRegression' DESC LIMIT 1")
def two_family_winner(spark, sf_dir):
    run = _two_families(spark, sf_dir)
    return run.results.where(F.col("model") == run.best_name).select("model", F.col("r2_score").alias("score"))


@report("SELECT p_partkey AS row_id, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS DOUBLE) AS label FROM part")
def target_labels(spark, sf_dir):
    df = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), "p_brand")
    return with_label(df, "p_brand", "classification", class_labels(df, "p_brand")).select("row_id", "label")
