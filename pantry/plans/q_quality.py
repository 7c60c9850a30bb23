"""Registered queries: data-quality suites (one aggregate pass per table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X

from ..operators import quality as Q
from ..sources.fixtures import Catalog
from . import sqlparts as S
from .common import split_training, TRAIN_OUT, pipeline
from .registry import register, with_views

V = ("interactions", "recipes")
SPLIT_TABLES = [("tr", "train"), ("va", "val"), ("te", "test")]


def _w(*extra):
    return with_views(*V, extra=S.training_ctes() + [S.split_cte()]
                      + [(a, f"SELECT * FROM splits WHERE split = '{n}'") for a, n in SPLIT_TABLES] + list(extra))


def _splits(spark, sf):
    p = pipeline(spark, sf)
    sp = split_training(p)
    return p, sp, {n: sp.filter(F.col("split") == n) for n in ("train", "val", "test")}


def _metric_sql(c: Q.Check, t: str) -> str:
    if c.metric == "row_count":
        return "count(*)"
    if c.metric == "missing_count":
        return f"count(*) FILTER (WHERE {c.column} IS NULL)"
    if c.metric == "dup_rows":
        return f"count(*) - count(DISTINCT {c.column})"
    if c.metric == "duplicate_count":
        return (f"(SELECT count(*) FROM (SELECT {c.column} FROM {t} WHERE {c.column} IS NOT NULL "
                f"GROUP BY {c.column} HAVING count(*) > 1) d)")
    return f"{c.metric}({c.column})"


def _cond_sql(c: Q.Check) -> str:
    if c.op == "between":
        return f"actual >= {c.lo} AND actual <= {c.hi}"
    if c.op == "between_excl":
        return f"actual > {c.lo} AND actual < {c.hi}"
    return f"actual {c.op} {c.lo}"


def checks_sql(checks: list[Q.Check], t: str, label: str) -> str:
    def src(c):
        frm = "" if c.metric == "duplicate_count" else f" FROM {t}"
        return f"SELECT CAST({_metric_sql(c, t)} AS DOUBLE) AS actual{frm}"
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, {S.q(c.name)} AS check_name, round(actual, 6) AS actual, "
        f"coalesce({_cond_sql(c)}, false) AS passed FROM ({src(c)}) x"
        for c in checks)


_ALIAS = {"enriched_recipes": "enriched", "train": "tr", "val": "va", "test": "te"}


@register("dq_rule_suite", sql=_w() + " UNION ALL ".join(
    checks_sql([Q.parse_rule(x) for x in texts], _ALIAS[t], t) for t, texts in Q.RULES_TEXT.items()))
def q_dq_rule_suite(spark, sf):
    p, tagged, _ = _splits(spark, sf)
    r = Q.run_rule_suite({"enriched_recipes": p.enriched}, tagged=tagged)
    return r.withColumn("actual", X.rnd("actual", 6))


@register("dq_builtin_suite", sql=_w() + checks_sql(Q.builtin_checks(None), "enriched", "enriched_recipes")
          + " UNION ALL " + " UNION ALL ".join(checks_sql(Q.builtin_checks(n), a, n) for a, n in SPLIT_TABLES)
          + """ UNION ALL SELECT 'splits', 'temporal', CAST(epoch(b) - epoch(a) AS DOUBLE), coalesce(a < b, false)
FROM (SELECT max(date) AS a FROM tr) x, (SELECT min(date) AS b FROM te) y""")
def q_dq_builtin_suite(spark, sf):
    p, tagged, _ = _splits(spark, sf)
    return Q.run_builtin_suite(p.enriched, tagged).withColumn("actual", X.rnd("actual", 6))


@register("dq_recipe_schema", sql=with_views("recipes") + """
SELECT 'recipes' AS table_name, 'missing_columns' AS check_name, CAST(0.0 AS DOUBLE) AS actual, true AS passed
UNION ALL SELECT 'recipes', 'recipe_id_nulls', CAST(count(*) FILTER (WHERE recipe_id IS NULL) AS DOUBLE),
  count(*) FILTER (WHERE recipe_id IS NULL) = 0 FROM recipes
UNION ALL SELECT 'recipes', 'recipe_id_duplicates', CAST(count(*) - count(DISTINCT recipe_id) AS DOUBLE),
  count(*) = count(DISTINCT recipe_id) FROM recipes""")
def q_dq_recipe_schema(spark, sf):
    return Q.schema_check(Catalog(spark, sf).recipes, Q.EXPECTED_RECIPE_COLS, "recipe_id", "recipes")


@register("dq_interaction_schema", sql=with_views("interactions") + """
SELECT 'interactions' AS table_name, 'missing_columns' AS check_name, CAST(0.0 AS DOUBLE) AS actual, true AS passed
UNION ALL SELECT 'interactions', 'user_id_nulls', CAST(count(*) FILTER (WHERE user_id IS NULL) AS DOUBLE),
  count(*) FILTER (WHERE user_id IS NULL) = 0 FROM interactions
UNION ALL SELECT 'interactions', 'recipe_id_nulls', CAST(count(*) FILTER (WHERE recipe_id IS NULL) AS DOUBLE),
  count(*) FILTER (WHERE recipe_id IS NULL) = 0 FROM interactions
UNION ALL SELECT 'interactions', 'rating_out_of_range', CAST(count(*) FILTER (WHERE rating < 0 OR rating > 5) AS DOUBLE),
  count(*) FILTER (WHERE rating < 0 OR rating > 5) = 0 FROM interactions""")
def q_dq_interaction_schema(spark, sf):
    return Q.interaction_checks(Catalog(spark, sf).interactions, Q.EXPECTED_INTER_COLS)


_RCOLS = ["recipe_id", "name", "minutes", "tags", "ingredients", "nutrition", "n_steps", "n_ingredients",
          "description"]
_ICOLS = ["user_id", "recipe_id", "date", "rating"]


def _null_sql(t, cols):
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) "
        f"AS null_rate, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.5 AS flagged, count(*) >= 100 AS enough_rows "
        f"FROM {t}" for c in cols)


@register("dq_null_rate", sql=with_views("recipes", "interactions") + _null_sql("recipes", _RCOLS)
          + " UNION ALL " + _null_sql("interactions", _ICOLS))
def q_dq_null_rate(spark, sf):
    c = Catalog(spark, sf)
    r = Q.null_profile(c.recipes.select(*_RCOLS), "recipes").unionByName(
        Q.null_profile(c.interactions.select(*_ICOLS), "interactions"))
    return r.withColumn("null_rate", X.rnd("null_rate", 6))


_NUMERIC = [c for c in TRAIN_OUT if c not in ("date", "name", "cuisine", "label")]


@register("dq_zero_variance", sql=_w() + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, "
    f"coalesce(stddev_samp(CAST({c} AS DOUBLE)) = 0, false) AS zero_variance FROM tr" for c in _NUMERIC))
def q_dq_zero_variance(spark, sf):
    _, _, sp = _splits(spark, sf)
    return Q.zero_variance(sp["train"].select(*_NUMERIC, "label")).withColumn("std", X.rnd("std", 6))


@register("dq_zero_variance_splits", sql=_w() + " UNION ALL ".join(
    f"SELECT split, '{c}' AS column_name, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, "
    f"coalesce(stddev_samp(CAST({c} AS DOUBLE)) = 0, false) AS zero_variance FROM splits GROUP BY split" for c in _NUMERIC))
def q_dq_zero_variance_splits(spark, sf):
    """``dq_zero_variance`` for train, val and test, as the reference checks them."""
    _, tagged, _ = _splits(spark, sf)
    return Q.zero_variance_by(tagged, _NUMERIC).withColumn("std", X.rnd("std", 6))


@register("dq_label_balance", sql=_w() + """
SELECT round(avg(CAST(label AS DOUBLE)), 6) AS positive_rate,
  avg(CAST(label AS DOUBLE)) >= 0.02 AND avg(CAST(label AS DOUBLE)) <= 0.98 AS passed FROM tr""")
def q_dq_label_balance(spark, sf):
    _, _, sp = _splits(spark, sf)
    r = Q.label_balance_check(sp["train"])
    return r.withColumn("positive_rate", X.rnd("positive_rate", 6))


@register("dq_negative_range", sql=_w() + " UNION ALL ".join(
    f"SELECT '{n}' AS split, count(*) FILTER (WHERE calories < 0) AS negative_rows, "
    f"count(*) FILTER (WHERE calories < 0) = 0 AS passed FROM {a}" for a, n in SPLIT_TABLES))
def q_dq_negative_range(spark, sf):
    _, tagged, _ = _splits(spark, sf)
    return Q.negative_range(tagged)


@register("dq_split_sanity", sql=_w() + """
SELECT train_rows, val_rows, test_rows, strftime(train_max, '%Y-%m-%d %H:%M:%S') AS train_max,
  strftime(test_min, '%Y-%m-%d %H:%M:%S') AS test_min, train_key_nulls,
  train_rows > 0 AND val_rows > 0 AND test_rows > 0 AS no_empty_split,
  coalesce(train_max < test_min, false) AS temporal_ok, coalesce(train_key_nulls, 0) = 0 AS keys_ok
FROM (SELECT count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'val') AS val_rows,
  count(*) FILTER (WHERE split = 'test') AS test_rows, max(date) FILTER (WHERE split = 'train') AS train_max,
  min(date) FILTER (WHERE split = 'test') AS test_min,
  CAST(sum(CASE WHEN split = 'train' THEN (user_id IS NULL)::INT + (recipe_id IS NULL)::INT + (label IS NULL)::INT END) AS BIGINT) AS train_key_nulls
  FROM splits) s""")
def q_dq_split_sanity(spark, sf):
    _, tagged, _ = _splits(spark, sf)
    r = Q.split_sanity(tagged)
    return (r.withColumn("train_max", F.date_format("train_max", "yyyy-MM-dd HH:mm:ss"))
            .withColumn("test_min", F.date_format("test_min", "yyyy-MM-dd HH:mm:ss")))


_LEAK = [c for c in TRAIN_OUT if c.startswith(("daily_", "user_"))]


@register("dq_leakage_corr", sql=_w() + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(corr(CAST({c} AS DOUBLE), CAST(label AS DOUBLE)), 6) AS corr, "
    f"coalesce(abs(corr(CAST({c} AS DOUBLE), CAST(label AS DOUBLE))) > 0.9, false) AS flagged FROM tr" for c in _LEAK))
def q_dq_leakage_corr(spark, sf):
    _, _, sp = _splits(spark, sf)
    return Q.leakage_corr(sp["train"].select(*_LEAK, "label")).withColumn("corr", X.rnd("corr", 6))
