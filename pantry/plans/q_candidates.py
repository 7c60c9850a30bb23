"""Registered queries: goals, meal candidates, rule candidates, serving joins,
per-request ranking windows, set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import exprs as X
from ..operators import candidates as C
from ..operators import evaluate as EV
from ..operators import ml as ML
from ..sources.fixtures import Catalog
from ..sources.io import output_root
from ..sources.snapshots import SnapshotTable, by_bucket
from . import sqlparts as S
from .common import pipeline
from .registry import register, with_views

RECENT_DAYS = 30
CACHE_BUCKETS = 8


def _stable_sql(expr: str) -> str:
    return f"(CAST(('0x' || substr(sha256(CAST({expr} AS VARCHAR)), 1, 8)) AS BIGINT) & 2147483647)"


_GOALS_SQL = ("goals", """SELECT user_id,
  coalesce(nullif(CAST(calories AS DOUBLE), 0), 2000.0) AS calories, coalesce(nullif(CAST(protein AS DOUBLE), 0), 50.0) AS protein,
  coalesce(nullif(CAST(carbs AS DOUBLE), 0), 250.0) AS carbs, coalesce(nullif(CAST(fat AS DOUBLE), 0), 65.0) AS fat
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC NULLS FIRST, created_at DESC NULLS FIRST) AS rn
      FROM user_goals) g WHERE rn = 1""")

_MEALS_SQL = ("meal_agg", """SELECT m.id AS meal_id, m.name AS meal_name, m.user_id, m.is_public,
  count(mf.variant_id) AS n_ingredients,
  CAST(sum(CAST(fv.calories * mf.quantity / nullif(CAST(fv.serving_size AS DOUBLE), 0) AS DECIMAL(38,12))) AS DOUBLE) AS calories,
  CAST(sum(CAST(fv.protein * mf.quantity / nullif(CAST(fv.serving_size AS DOUBLE), 0) AS DECIMAL(38,12))) AS DOUBLE) AS protein,
  CAST(sum(CAST(fv.carbs * mf.quantity / nullif(CAST(fv.serving_size AS DOUBLE), 0) AS DECIMAL(38,12))) AS DOUBLE) AS carbs,
  CAST(sum(CAST(fv.fat * mf.quantity / nullif(CAST(fv.serving_size AS DOUBLE), 0) AS DECIMAL(38,12))) AS DOUBLE) AS fat,
  CAST(NULL AS DOUBLE) AS saturated_fat, CAST(NULL AS DOUBLE) AS sugars,
  CAST(sum(CAST(fv.sodium * mf.quantity / nullif(CAST(fv.serving_size AS DOUBLE), 0) AS DECIMAL(38,12))) AS DOUBLE) AS sodium,
  CAST(NULL AS DOUBLE) AS dietary_fiber
FROM meals m LEFT JOIN meal_foods mf ON mf.meal_id = m.id LEFT JOIN food_variants fv ON fv.id = mf.variant_id
GROUP BY m.id, m.name, m.user_id, m.is_public""")

_MV = ("meals", "meal_foods", "food_variants", "user_goals")


def _goals(cat):
    return C.user_goal_defaults(cat.user_goals)


def _meal_agg(cat):
    return C.meal_nutrients(cat.meals, cat.meal_foods, cat.food_variants)


@register("user_goal_defaults", sql=with_views("user_goals", extra=[_GOALS_SQL]) + "SELECT * FROM goals")
def q_user_goal_defaults(spark, sf):
    return _goals(Catalog(spark, sf))


@register("latest_per_key", sql=with_views("food_variants") + """
SELECT food_id, id, serving_size, calories FROM (SELECT *, row_number() OVER (PARTITION BY food_id
  ORDER BY is_default DESC NULLS FIRST, updated_at DESC NULLS FIRST) AS rn FROM food_variants) v WHERE rn = 1""")
def q_latest_per_key(spark, sf):
    v = Catalog(spark, sf).food_variants
    return C.latest_per_key(v, "food_id", ["is_default", "updated_at"], ["id", "serving_size", "calories"])


_NUT_OUT = ["meal_id", "meal_name", "user_id", "is_public", "n_ingredients"] + C.NUTRIENTS


@register("candidate_meals", sql=with_views(*_MV[:3], extra=[_MEALS_SQL]) + "SELECT meal_id, meal_name, user_id, is_public, n_ingredients, "
          + ", ".join(f"round({n}, 6) AS {n}" for n in C.NUTRIENTS) + " FROM meal_agg")
def q_candidate_meals(spark, sf):
    m = _meal_agg(Catalog(spark, sf))
    return m.select(*[X.round6(c).alias(c) if c in C.NUTRIENTS else c for c in _NUT_OUT])


_RECENT_SQL = ("recent", f"""SELECT DISTINCT user_id, id AS meal_id FROM meals
WHERE id IS NOT NULL AND entry_date >= (SELECT max(entry_date) FROM meals) - INTERVAL {RECENT_DAYS} DAY""")


def _recent(cat):
    entries = cat.meals.select("user_id", F.col("id").alias("meal_template_id"), "entry_date")
    return C.recently_logged(entries, RECENT_DAYS)


@register("distinct_logged", sql=with_views("meals", extra=[_RECENT_SQL]) + "SELECT * FROM recent")
def q_distinct_logged(spark, sf):
    return _recent(Catalog(spark, sf))


@register("candidate_meals_sampled")  # seeded sample: rows-only check + tests/test_semantics.py
def q_candidate_meals_sampled(spark, sf):
    cat = Catalog(spark, sf)
    meals = _meal_agg(cat)
    users = cat.contexts.select("user_id")
    s = C.sample_candidates(users, meals, _recent(cat), k=200)
    return s.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_candidates"),
                                    F.countDistinct("meal_id").alias("n_distinct"))


@register("exclude_recent_meals", sql=with_views("meals", extra=[_RECENT_SQL]) + """
SELECT m.user_id, m.id AS meal_id FROM meals m
WHERE NOT EXISTS (SELECT 1 FROM recent r WHERE r.user_id = m.user_id AND r.meal_id = m.id)""")
def q_exclude_recent_meals(spark, sf):
    cat = Catalog(spark, sf)
    own = cat.meals.select("user_id", F.col("id").alias("meal_id"))
    return C.exclude_recent_meals(own, _recent(cat))


#: The recipe side of a request's features; of these, enrichment has no sodium in mg.
RECIPE_FEATURES = ["calories", "protein_g", "carbohydrate_g", "total_fat_g", "sugar_g", "sodium_g", "saturated_fat_g",
                   "n_ingredients", "n_steps", "minutes", "avg_rating", "n_reviews"]


def _rule_ctes():
    flags = ", ".join(f"CAST(coalesce(list_contains(allergens, {S.q(a)}), false) AS INTEGER) AS has_{a}" for a in vocab.ALLERGENS_SORTED)
    free = " ".join(f"AND NOT (coalesce(c.no_{a}, false) AND r.has_{a} = 1)" for a in vocab.ALLERGENS_SORTED)
    return [("rec", f"SELECT recipe_id, cuisine, {', '.join(RECIPE_FEATURES)}, {flags} FROM enriched"),
            ("cand", f"""SELECT c.request_id, r.* FROM contexts c JOIN rec r
  ON r.calories >= coalesce(c.calorie_target, 600) * 0.5 AND r.calories <= coalesce(c.calorie_target, 600) * 1.5
  AND r.minutes <= coalesce(c.time_limit, 120) {free}""")]


def _rule_sql():
    return with_views("interactions", "recipes", "contexts", extra=S.enriched_ctes() + _rule_ctes())


def _rule_spark(spark, sf):
    p = pipeline(spark, sf)
    return p, C.rule_candidates(p.cat.contexts, _rule_recipes(p))


def _rule_recipes(p):
    return p.enriched.select("recipe_id", "cuisine", *RECIPE_FEATURES, *[
        F.coalesce(F.array_contains("allergens", a).cast("int"), F.lit(0)).alias(f"has_{a}") for a in vocab.ALLERGENS_SORTED])


@register("rule_candidates", sql=_rule_sql() + """
SELECT request_id, count(*) AS n_candidates, CAST(sum(recipe_id) AS BIGINT) AS sum_recipe_id,
  round(min(calories), 6) AS min_calories, round(max(calories), 6) AS max_calories FROM cand GROUP BY request_id""")
def q_rule_candidates(spark, sf):
    _, c = _rule_spark(spark, sf)
    return c.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_candidates"),
                                       F.sum("recipe_id").cast("bigint").alias("sum_recipe_id"),
                                       X.rnd(F.min("calories"), 6).alias("min_calories"),
                                       X.rnd(F.max("calories"), 6).alias("max_calories"))


_MEALS_OF_DAY = ["breakfast", "lunch", "dinner", "snack", "dessert"]
_SUMMED = RECIPE_FEATURES + [f"has_{a}" for a in vocab.ALLERGENS_SORTED]


@register("candidate_features", sql=with_views("interactions", "recipes", "contexts",
                                               extra=S.training_ctes() + _rule_ctes()) + f"""
SELECT c.request_id, count(*) AS n_candidates, round(sum(coalesce(u.daily_calorie_target, 2000.0)), 6) AS sum_calorie_target,
  CAST(sum(coalesce(u.user_vegan, 0)) AS BIGINT) AS sum_user_vegan,
  CAST(sum(CASE WHEN c.cuisine = 'italian' THEN 1 ELSE 0 END) AS BIGINT) AS n_italian,
  {", ".join(f"CAST(sum(CASE WHEN coalesce(x.meal_type, 'dinner') = '{m}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{m}" for m in _MEALS_OF_DAY)},
  {", ".join(f"CAST(sum(CASE WHEN coalesce(x.time_of_day, 'evening') = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{t}" for t in ("morning", "evening"))},
  {", ".join(f"round(CAST(sum(CAST(coalesce(c.{f}, 0) AS DECIMAL(28,8))) AS DOUBLE) / count(*), 4) AS mean_{f}" for f in _SUMMED)}
FROM cand c JOIN contexts x ON c.request_id = x.request_id LEFT JOIN user_features u ON x.user_id = u.user_id GROUP BY c.request_id""")
def q_candidate_features(spark, sf):
    p = pipeline(spark, sf)
    rec = C.cuisine_one_hots(_rule_recipes(p))
    rec = rec.withColumns({k: v for f in _SUMMED for k, v in X.whole_parts(rec, f).items()})  # once a recipe, not once a pair
    c = C.rule_candidates(C.request_features(p.cat.contexts, p.user_features), rec)
    feats = C.candidate_features(c, None)
    return feats.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n_candidates"),
        X.rnd(F.sum("daily_calorie_target"), 6).alias("sum_calorie_target"),
        F.sum("user_vegan").cast("bigint").alias("sum_user_vegan"),
        F.sum("cuisine_italian").cast("bigint").alias("n_italian"),
        *[F.sum(f"meal_{m}").cast("bigint").alias(f"n_{m}") for m in _MEALS_OF_DAY],
        *[F.sum(f"time_{t}").cast("bigint").alias(f"n_{t}") for t in ("morning", "evening")],
        *[X.rnd(X.sum_of_parts(feats, f).cast("double") / F.count(F.lit(1)), 4).alias(f"mean_{f}") for f in _SUMMED])


_OWN_SQL = ("own", "SELECT a.*, " + ", ".join(f"coalesce(g.{c}, {vocab.GOAL_DEFAULTS[c]}) AS goal_{c}" for c in C.GOAL_COLS)
            + " FROM meal_agg a LEFT JOIN goals g ON a.user_id = g.user_id")


def _own(cat):
    g = _goals(cat)
    return _meal_agg(cat), g


@register("fallback_rank", sql=with_views(*_MV, extra=[_GOALS_SQL, _MEALS_SQL, _OWN_SQL]) + """
SELECT user_id, meal_id, round(greatest(0.0, 1.0 - _idx / count(*) OVER (PARTITION BY user_id)), 6) AS score,
  _idx + 1 AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY abs(coalesce(protein, 0.0) - goal_protein * 0.3), meal_id) - 1 AS _idx
      FROM own) t WHERE _idx < 10""")
def q_fallback_rank(spark, sf):
    meals, goals = _own(Catalog(spark, sf))
    r = C.fallback_rank(meals, goals, 10)
    return r.select("user_id", "meal_id", X.rnd("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


@register("recommendation_reason", sql=with_views(*_MV, extra=[_GOALS_SQL, _MEALS_SQL, _OWN_SQL]) + """
SELECT user_id, meal_id, CASE
  WHEN coalesce(protein, 0.0) >= 25 AND coalesce(protein, 0.0) >= goal_protein * 0.3
    THEN 'High protein (' || CAST(CAST(floor(coalesce(protein, 0.0) + 0.5) AS BIGINT) AS VARCHAR) || ' g) — fits your '
         || CASE WHEN goal_protein = floor(goal_protein) THEN CAST(CAST(goal_protein AS BIGINT) AS VARCHAR) ELSE CAST(goal_protein AS VARCHAR) END || ' g target'
  WHEN coalesce(calories, 0.0) > 0 AND floor(coalesce(calories, 0.0) / goal_calories * 100 + 0.5) BETWEEN 20 AND 35
    THEN 'Balanced meal — ~' || CAST(CAST(floor(coalesce(calories, 0.0) / goal_calories * 100 + 0.5) AS BIGINT) AS VARCHAR)
         || '% of your daily ' || CASE WHEN goal_calories = floor(goal_calories) THEN CAST(CAST(goal_calories AS BIGINT) AS VARCHAR) ELSE CAST(goal_calories AS VARCHAR) END || ' kcal goal'
  WHEN coalesce(calories, 0.0) > 0 AND coalesce(calories, 0.0) <= goal_calories * 0.2
    THEN 'Light option — only ' || CAST(CAST(floor(coalesce(calories, 0.0) + 0.5) AS BIGINT) AS VARCHAR) || ' kcal'
  ELSE 'Matches your nutritional profile' END AS reason
FROM own""")
def q_recommendation_reason(spark, sf):
    meals, goals = _own(Catalog(spark, sf))
    j = C.with_goals(meals, goals)
    return j.select("user_id", "meal_id", C.recommendation_reason(
        F.col("protein"), F.col("calories"), F.col("goal_protein"), F.col("goal_calories")).alias("reason"))


def _mfv_sql():
    z = lambda c: f"coalesce(CAST({c} AS DOUBLE), 0.0)"
    m = {
        "minutes": "30.0", "n_ingredients": "CAST(n_ingredients AS DOUBLE)", "n_steps": "5.0", "avg_rating": "0.0",
        "n_reviews": "0.0", "calories": f"{z('calories')} / 2000.0 * 100.0", "total_fat": f"{z('fat')} / 78.0 * 100.0",
        "sugar": f"{z('sugars')} / 50.0 * 100.0", "sodium": f"{z('sodium')} / 1000.0 / 2.3 * 100.0",
        "protein": f"{z('protein')} / 50.0 * 100.0", "saturated_fat": f"{z('saturated_fat')} / 20.0 * 100.0",
        "carbohydrate": f"{z('carbs')} / 275.0 * 100.0", "total_fat_g": z("fat"), "sugar_g": z("sugars"),
        "sodium_g": f"{z('sodium')} / 1000.0", "protein_g": z("protein"), "saturated_fat_g": z("saturated_fat"),
        "carbohydrate_g": z("carbs"), "daily_calorie_target": "goal_calories", "protein_target_g": "goal_protein",
        "carbs_target_g": "goal_carbs", "fat_target_g": "goal_fat"}
    cols = []
    for c in vocab.FEATURE_COLUMNS:
        if c == "rating":
            continue
        if c == "cuisine":
            cols.append("'unknown' AS cuisine")
        else:
            cols.append(f"round(CAST({m.get(c, '0.0')} AS DOUBLE), 6) AS {c}")
    return (with_views(*_MV, extra=[_GOALS_SQL, _MEALS_SQL, _OWN_SQL])
            + f"SELECT user_id, meal_id, {_stable_sql('user_id')} AS ml_user_id, {_stable_sql('meal_id')} AS ml_recipe_id, "
            + ", ".join(cols) + " FROM own")


@register("meal_feature_vector", sql=_mfv_sql())
def q_meal_feature_vector(spark, sf):
    meals, goals = _own(Catalog(spark, sf))
    v = C.meal_feature_vector(meals, goals)
    return v.select(*[X.round6(c).alias(c) if t == "double" else F.col(c) for c, t in v.dtypes])


def _pool(cat):
    """The candidates of all users with a request or a meal, with the users' goals.  The draw
    has no SQL; tests/test_semantics.py compares with brute force."""
    users = cat.contexts.select("user_id").unionByName(cat.meals.select("user_id")).filter("user_id IS NOT NULL")
    return C.pooled_meals(users, _meal_agg(cat), _recent(cat), k=200, goals=_goals(cat))


@register("fallback_rank_pool")
def q_fallback_rank_pool(spark, sf):
    r = C.fallback_rank(_pool(Catalog(spark, sf)), None, 10)
    return r.select("user_id", "meal_id", X.rnd("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


@register("recommendation_reason_pool")
def q_recommendation_reason_pool(spark, sf):
    return C.with_goals(_pool(Catalog(spark, sf)), None).select("user_id", "meal_id", C.recommendation_reason(
        F.col("protein"), F.col("calories"), F.col("goal_protein"), F.col("goal_calories")).alias("reason"))


@register("meal_feature_vector_pool")
def q_meal_feature_vector_pool(spark, sf):
    v = C.meal_feature_vector(_pool(Catalog(spark, sf)), None)
    return v.select(*[X.round6(c).alias(c) if t == "double" else F.col(c) for c, t in v.dtypes])


@register("product_normalise", sql=with_views("products") + """
SELECT code, coalesce(json_extract_string(doc, '$.product_name_en'), json_extract_string(doc, '$.product_name')) AS name,
  coalesce(trim(split_part(coalesce(json_extract_string(doc, '$.brands'), ''), ',', 1)), '') AS brand,
  CASE WHEN coalesce(CAST(json_extract(doc, '$.serving_quantity') AS DOUBLE), 0) > 0
       THEN CAST(json_extract(doc, '$.serving_quantity') AS DOUBLE) ELSE 100.0 END AS serving_size,
  floor(coalesce(CAST(json_extract(doc, '$.nutriments."energy-kcal_100g"') AS DOUBLE), 0) * s + 0.5) AS calories,
  floor(coalesce(CAST(json_extract(doc, '$.nutriments.proteins_100g') AS DOUBLE), 0) * s * 10 + 0.5) / 10 AS protein,
  CAST(0.0 AS DOUBLE) AS carbs, CAST(0.0 AS DOUBLE) AS fat, CAST(0.0 AS DOUBLE) AS saturated_fat,
  CASE WHEN coalesce(CAST(json_extract(doc, '$.nutriments.sodium_100g') AS DOUBLE), 0) <> 0
       THEN floor(CAST(json_extract(doc, '$.nutriments.sodium_100g') AS DOUBLE) * 1000 * s + 0.5) ELSE CAST(0.0 AS DOUBLE) END AS sodium,
  CAST(0.0 AS DOUBLE) AS dietary_fiber, CAST(0.0 AS DOUBLE) AS sugars
FROM (SELECT *, (CASE WHEN coalesce(CAST(json_extract(doc, '$.serving_quantity') AS DOUBLE), 0) > 0
       THEN CAST(json_extract(doc, '$.serving_quantity') AS DOUBLE) ELSE 100.0 END) / 100.0 AS s FROM products) p""")
def q_product_normalise(spark, sf):
    return C.product_normalise(Catalog(spark, sf).products)


_INST_SQL = """SELECT request_id, user_id, recipe_id, 'rec-' || CAST(request_id AS VARCHAR) AS recommendation_id, ts FROM request_log"""


@register("join_recommendation_id", sql=with_views("request_log", extra=[("inst", _INST_SQL)]) + """
SELECT p.request_id, p.user_id, p.recipe_id, l.recommendation_id FROM request_log p LEFT JOIN (
  SELECT user_id, recipe_id, recommendation_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, recipe_id
    ORDER BY ts DESC, request_id DESC) AS rn FROM inst) x WHERE rn = 1) l
  ON p.user_id = l.user_id AND p.recipe_id = l.recipe_id""")
def q_join_recommendation_id(spark, sf):
    log = Catalog(spark, sf).request_log
    inst = log.select("user_id", "recipe_id", F.concat(F.lit("rec-"), F.col("request_id").cast("string"))
                      .alias("recommendation_id"), F.struct("ts", "request_id").alias("position"))
    preds = log.select("request_id", "user_id", "recipe_id")
    return C.join_recommendation_id(preds, inst, batch_key="user_id")


_CACHE_SQL = ("cache", f"""SELECT request_id AS id, user_id,
  CASE WHEN status = 500 THEN NULL ELSE 'sf-' || CAST(user_id AS VARCHAR) || '-' || CAST(request_id AS VARCHAR) END AS request_id,
  {_stable_sql('user_id')} AS ml_user_id, recipe_id AS ml_recipe_id FROM request_log""")
_FEEDBACK_SQL = ("fb", "SELECT event_id, event_id - 1 AS recommendation_id, user_id, event_type AS action "
                       "FROM events WHERE event_type IN ('click', 'purchase')")


def _cache(cat):
    log = cat.request_log
    return log.select(F.col("request_id").alias("id"), "user_id",
                      F.when(F.col("status") == 500, F.lit(None).cast("string")).otherwise(
                          F.concat(F.lit("sf-"), F.col("user_id").cast("string"), F.lit("-"),
                                   F.col("request_id").cast("string"))).alias("request_id"),
                      X.stable_id(F.col("user_id")).alias("ml_user_id"), F.col("recipe_id").alias("ml_recipe_id"))


@register("join_feedback_context", sql=with_views("request_log", extra=[_CACHE_SQL, _FEEDBACK_SQL]) + """
SELECT f.event_id, f.recommendation_id, f.user_id, f.action, c.request_id, c.ml_user_id, c.ml_recipe_id,
  c.request_id IS NOT NULL AND c.ml_user_id IS NOT NULL AND c.ml_recipe_id IS NOT NULL AS forwarded
FROM fb f LEFT JOIN cache c ON f.recommendation_id = c.id AND f.user_id = c.user_id""")
def q_join_feedback_context(spark, sf):
    cat = Catalog(spark, sf)
    fb = cat.events.filter(F.col("event_type").isin("click", "purchase")).select(
        "event_id", (F.col("event_id") - 1).alias("recommendation_id"), "user_id", F.col("event_type").alias("action"))
    return C.join_feedback_context(fb, _cache(cat)).select(
        "event_id", "recommendation_id", "user_id", "action", "request_id", "ml_user_id", "ml_recipe_id", "forwarded")


@register("sink_upsert", sql=with_views("request_log") + """
, t AS (SELECT min(ts) AS t0, max(ts) AS now FROM request_log)
, cur AS (SELECT request_id AS id, CAST(user_id AS VARCHAR) AS request_ref, score, model_version,
          ts + INTERVAL 1 DAY AS expires_at, ts AS created_at FROM request_log, t WHERE ts < t0 + INTERVAL 20 DAY)
, inc AS (SELECT request_id AS id, 'r-' || CAST(request_id AS VARCHAR) AS request_ref, score * 2 AS score, 'v9' AS model_version
          FROM request_log, t WHERE ts >= t0 + INTERVAL 10 DAY)
SELECT coalesce(c.id, i.id) AS id,
  CASE WHEN i.id IS NOT NULL THEN i.request_ref ELSE c.request_ref END AS request_ref,
  round(CASE WHEN i.id IS NOT NULL THEN i.score ELSE c.score END, 6) AS score,
  CASE WHEN i.id IS NOT NULL THEN i.model_version ELSE c.model_version END AS model_version,
  strftime(CASE WHEN i.id IS NOT NULL THEN (SELECT now FROM t) + INTERVAL 1 DAY ELSE c.expires_at END, '%Y-%m-%d %H:%M:%S') AS expires_at,
  strftime(CASE WHEN c.id IS NULL THEN (SELECT now FROM t) ELSE c.created_at END, '%Y-%m-%d %H:%M:%S') AS created_at
FROM cur c FULL OUTER JOIN inc i ON c.id = i.id""")
def q_sink_upsert(spark, sf):
    """Current cache = the first 20 days of the log; incoming batch = everything
    from day 10 on, re-scored: the overlap updates, the rest inserts.  The cache is a
    table of snapshots; the query reads the version after the upsert."""
    log = Catalog(spark, sf).request_log
    t = log.agg(F.min("ts").alias("_t0"), F.max("ts").alias("_now"))  # one row
    lt = log.crossJoin(t)
    cur = lt.filter(F.col("ts") < F.col("_t0") + F.make_dt_interval(F.lit(20))).select(
        F.col("request_id").alias("id"), F.col("user_id").cast("string").alias("request_ref"), "score",
        "model_version", (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("expires_at"), F.col("ts").alias("created_at"))
    inc = lt.filter(F.col("ts") >= F.col("_t0") + F.make_dt_interval(F.lit(10))).select(
        F.col("request_id").alias("id"), F.concat(F.lit("r-"), F.col("request_id").cast("string")).alias("request_ref"),
        (F.col("score") * 2).alias("score"), F.lit("v9").alias("model_version"), "_now")
    cache = SnapshotTable(spark, output_root(spark, "recommendation-cache"), cur.schema, by_bucket("id", CACHE_BUCKETS))
    cache.append_new(cur)
    C.upsert_into(cache, inc, "id", ["request_ref", "score", "model_version"], F.col("_i__now"), CACHE_BUCKETS)
    return cache.read().select("id", "request_ref", X.rnd("score", 6).alias("score"), "model_version",
                         F.date_format("expires_at", "yyyy-MM-dd HH:mm:ss").alias("expires_at"),
                         F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


@register("rank_predictions", sql=with_views("scores") + """
SELECT user_id AS request_id, recipe_id, round(score, 4) AS score,
  row_number() OVER (PARTITION BY user_id ORDER BY score DESC, recipe_id) AS rank FROM scores""")
def q_rank_predictions(spark, sf):
    s = Catalog(spark, sf).scores
    # full ranking of every candidate of a request: skew-safe range-sorted rank
    r = ML.rank_within_group(s, ["user_id"], [F.desc("score"), F.asc("recipe_id")])
    return r.select(F.col("user_id").alias("request_id"), "recipe_id", X.rnd("score", 4).alias("score"), "rank")


@register("topn_scored", sql=with_views("scores", "recipes") + """
SELECT t.user_id, t.recipe_id, round(t.score, 6) AS score, r.name FROM
  (SELECT * FROM scores ORDER BY score DESC, user_id, recipe_id LIMIT 10) t LEFT JOIN recipes r ON t.recipe_id = r.recipe_id""")
def q_topn_scored(spark, sf):
    cat = Catalog(spark, sf)
    top = cat.scores.orderBy(F.desc("score"), "user_id", "recipe_id").limit(10)
    # k rows (the feature) joined to the name lookup; k is a literal bound.
    return top.join(F.broadcast(top.select("recipe_id").distinct().join(
        cat.recipes.select("recipe_id", "name"), "recipe_id")), "recipe_id", "left").select(
        "user_id", "recipe_id", X.rnd("score", 6).alias("score"), "name")


def _scored_sql():
    return with_views("interactions", "recipes", "scores", extra=S.scored_test_ctes())


@register("topk_per_user", sql=_scored_sql() + f"""
SELECT user_id, recipe_id, l_orderkey, l_linenumber, l_suppkey, _r AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, {S.TIE}) AS _r FROM scored WHERE user_vegan = 1) t
WHERE _r <= 5""")
def q_topk_per_user(spark, sf):
    from .q_eval import scored_test
    df = scored_test(spark, sf, ["user_vegan"]).filter(F.col("user_vegan") == 1)
    w = Window.partitionBy("user_id").orderBy(F.desc("score"), *EV.TIE_BREAK)
    return (df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= 5)
            .select("user_id", "recipe_id", "l_orderkey", "l_linenumber", "l_suppkey",
                    F.col("rank").cast("bigint").alias("rank")))
