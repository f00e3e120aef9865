"""Reports on baskets, frequent itemsets and association rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.catalogue.registry import make_registry
from plumbline.catalogue.tables import BASKETS, USERS_DS, USERS_FEATURES, baskets, r6, users_ds
from plumbline.operators import rules as R

REPORTS, SQL, report = make_registry()

_COLUMNS = ["status", "priority", "segment"]
_SUPPORT, _CONFIDENCE = 0.05, 0.2


@report(f"""WITH {BASKETS}
SELECT row_id, unnest(['status_' || status, 'priority_' || priority, 'segment_' || segment]) AS item FROM baskets""")
def onehot_items(spark, sf_dir):
    items = R.category_items(baskets(spark, sf_dir), _COLUMNS)
    return items.select("row_id", F.explode("items").alias("item"))


@report(f"WITH {USERS_DS}, m AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in USERS_FEATURES)
        + " FROM users_ds)" + " UNION ALL ".join(
    f" SELECT row_id, '{c}_high' AS item FROM users_ds, m WHERE {c} >= m_{c}" for c in USERS_FEATURES))
def median_items(spark, sf_dir):
    items = R.median_items(users_ds(spark, sf_dir), USERS_FEATURES)
    return items.select("row_id", F.explode("items").alias("item"))


_SETS = f"""WITH {BASKETS}, i AS (
  SELECT row_id, unnest(['status_' || status, 'priority_' || priority, 'segment_' || segment]) AS item FROM baskets),
n AS (SELECT count(*) AS n FROM baskets),
s1 AS (SELECT item AS items, count(*) AS freq FROM i GROUP BY 1),
s2 AS (SELECT a.item || '|' || b.item AS items, count(*) AS freq FROM i a JOIN i b ON a.row_id = b.row_id AND a.item < b.item
       GROUP BY 1),
s3 AS (SELECT a.item || '|' || b.item || '|' || c.item AS items, count(*) AS freq FROM i a
       JOIN i b ON a.row_id = b.row_id AND a.item < b.item JOIN i c ON a.row_id = c.row_id AND b.item < c.item GROUP BY 1),
f AS (SELECT items, freq, freq / n AS support FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3), n
      WHERE freq / n >= SUPPORT)"""
_RULES = """, p AS (
  SELECT string_split(items, '|') AS l, support FROM f),
m AS (SELECT l, support, unnest(range(1, CAST(2 ** len(l) AS BIGINT) - 1)) AS mask FROM p WHERE len(l) > 1),
r AS (SELECT array_to_string([l[k] for k in range(1, len(l) + 1) if (mask >> (k - 1)) & 1 = 1], '|') AS antecedents,
             array_to_string([l[k] for k in range(1, len(l) + 1) if (mask >> (k - 1)) & 1 = 0], '|') AS consequents,
             support FROM m),
rules AS (SELECT antecedents, consequents, r.support, r.support / a.support AS confidence,
            r.support / a.support / c.support AS lift, r.support - a.support * c.support AS leverage,
            CASE WHEN r.support = a.support THEN NULL ELSE (1 - c.support) / (1 - r.support / a.support) END AS conviction
  FROM r JOIN f a ON a.items = antecedents JOIN f c ON c.items = consequents
  WHERE r.support / a.support >= CONFIDENCE)"""


def _text(sql: str, support: float, confidence: float) -> str:
    return sql.replace("SUPPORT", str(support)).replace("CONFIDENCE", str(confidence))


def _itemsets(spark, sf_dir, support):
    df = baskets(spark, sf_dir)
    return R.frequent_itemsets(R.category_items(df, _COLUMNS), support, df.count())


@report(_text(_SETS + " SELECT items, freq, round(support, 6) AS support FROM f", 0.01, 0))
def frequent_itemsets(spark, sf_dir):
    return _itemsets(spark, sf_dir, 0.01).select(F.array_join("items", "|").alias("items"), "freq",
                                                 r6("support").alias("support"))


@report(_text(_SETS + _RULES + """
SELECT antecedents, consequents, round(support, 6) AS support, round(confidence, 6) AS confidence,
       round(lift, 6) AS lift, round(leverage, 6) + 0.0 AS leverage, round(conviction, 6) AS conviction FROM rules""",
              0.01, 0))
def association_rules(spark, sf_dir):
    rules = R.association_rules(_itemsets(spark, sf_dir, 0.01), 0.0)
    return rules.select(F.array_join("antecedents", "|").alias("antecedents"),
                        F.array_join("consequents", "|").alias("consequents"),
                        *[(r6(c) + 0.0).alias(c) for c in ("support", "confidence", "lift", "leverage", "conviction")])


_ORDERED = " ORDER BY lift DESC, confidence DESC, support DESC, string_split(antecedents, '|'), string_split(consequents, '|')"
_SHOWN = "'[''' || replace({0}, '|', ''', ''') || ''']'"


@report(_text(_SETS + _RULES + f"""
SELECT substr({_SHOWN.format('antecedents')}, 1, 28) AS antecedent, substr({_SHOWN.format('consequents')}, 1, 23) AS consequent,
  round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift
FROM (SELECT * FROM rules {_ORDERED} LIMIT 5)""", _SUPPORT, _CONFIDENCE))
def top_rules(spark, sf_dir):
    top = R.top_rules(R.association_rules(_itemsets(spark, sf_dir, _SUPPORT), _CONFIDENCE))
    return top.select("antecedent", "consequent", *[r6(c).alias(c) for c in ("support", "confidence", "lift")])


@report(_text(_SETS + _RULES + f"""
SELECT substr({_SHOWN.format('antecedents')} || ' -> ' || {_SHOWN.format('consequents')}, 1, 50) AS label, round(lift, 6) AS lift
FROM (SELECT * FROM rules {_ORDERED} LIMIT 10)""", _SUPPORT, _CONFIDENCE))
def top10_rules(spark, sf_dir):
    chart = R.rule_chart(R.association_rules(_itemsets(spark, sf_dir, _SUPPORT), _CONFIDENCE))
    return chart.select("label", r6("lift").alias("lift"))
