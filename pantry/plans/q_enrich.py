"""Registered queries: enrichment, projections and recipe-level aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions import exprs as X
from ..operators import enrich as E
from ..sources.fixtures import Catalog
from . import sqlparts as S
from .registry import register, with_views

# Parameters for the "tight" filter run: the reference defaults remove nothing
# on the fixtures (FIXTURES.md), so queries also run with these.
TIGHT_Q, TIGHT_MIN_REVIEWS = 0.95, 20


def _enriched(cat: Catalog, q=vocab.MINUTES_QUANTILE, k=vocab.MIN_REVIEWS):
    return E.enrich_recipes(cat.recipes, cat.interactions, q, k)


@register("recipe_stats", sql=with_views("interactions") + """
SELECT recipe_id, round(avg(rating), 6) AS avg_rating, count(rating) AS n_reviews
FROM interactions GROUP BY recipe_id""")
def q_recipe_stats(spark, sf):
    return E.recipe_stats(Catalog(spark, sf).interactions).withColumn(
        "avg_rating", X.round6("avg_rating"))


@register("join_recipe_stats", sql=with_views("interactions", "recipes", extra=S.enriched_ctes()[:2]) + """
SELECT recipe_id, name, round(avg_rating, 6) AS avg_rating, n_reviews FROM r_joined""")
def q_join_recipe_stats(spark, sf):
    cat = Catalog(spark, sf)
    return (E.join_recipe_stats(cat.recipes, cat.interactions)
            .select("recipe_id", "name", X.round6("avg_rating").alias("avg_rating"), "n_reviews"))


def _filter_sql(qt, k):
    return with_views("interactions", "recipes", extra=S.enriched_ctes(qt, k)[:4]) + """
SELECT recipe_id, name, minutes, description, round(avg_rating, 6) AS avg_rating, n_reviews
FROM r_filtered"""


def _filter_spark(spark, sf, qt, k):
    cat = Catalog(spark, sf)
    base = E.join_recipe_stats(cat.recipes, cat.interactions)
    return (E.recipe_filter(base, qt, k)
            .select("recipe_id", "name", "minutes", "description",
                    X.round6("avg_rating").alias("avg_rating"), "n_reviews"))


@register("recipe_filter", sql=_filter_sql(vocab.MINUTES_QUANTILE, vocab.MIN_REVIEWS))
def q_recipe_filter(spark, sf):
    return _filter_spark(spark, sf, vocab.MINUTES_QUANTILE, vocab.MIN_REVIEWS)


@register("recipe_filter_tight", sql=_filter_sql(TIGHT_Q, TIGHT_MIN_REVIEWS))
def q_recipe_filter_tight(spark, sf):
    return _filter_spark(spark, sf, TIGHT_Q, TIGHT_MIN_REVIEWS)


@register("parse_list_columns", sql=with_views("recipes") + f"""
SELECT recipe_id, len({S.string_list('tags')}) AS n_tags,
  array_to_string({S.string_list('tags')}, '|') AS tag_text,
  len({S.string_list('ingredients')}) AS n_ingr,
  array_to_string({S.string_list('ingredients')}, '|') AS ingr_text
FROM recipes""")
def q_parse_list_columns(spark, sf):
    r = E.parse_list_columns(Catalog(spark, sf).recipes)
    return r.select("recipe_id", F.size("tags").cast("bigint").alias("n_tags"),
                    F.array_join("tags", "|").alias("tag_text"),
                    F.size("ingredients").cast("bigint").alias("n_ingr"),
                    F.array_join("ingredients", "|").alias("ingr_text"))


_MACRO_COLS = vocab.NUTRITION_FIELDS + [f"{c}_g" for c in vocab.PDV_TO_ABS]


@register("nutrition_macros", sql=with_views("recipes") + "SELECT recipe_id, " + ", ".join(
    [f"round(CASE WHEN len(TRY_CAST(nutrition AS DOUBLE[])) >= 7 THEN TRY_CAST(nutrition AS DOUBLE[])[{i + 1}] END, 6) AS {n}"
     for i, n in enumerate(vocab.NUTRITION_FIELDS)]
    + [f"round(CASE WHEN len(TRY_CAST(nutrition AS DOUBLE[])) >= 7 THEN TRY_CAST(nutrition AS DOUBLE[])"
       f"[{vocab.NUTRITION_FIELDS.index(c) + 1}] END / 100.0 * {f}.0, 6) AS {c}_g"
       for c, f in vocab.PDV_TO_ABS.items()]) + " FROM recipes")
def q_nutrition_macros(spark, sf):
    r = E.nutrition_macros(Catalog(spark, sf).recipes)
    return r.select("recipe_id", *[X.round6(c).alias(c) for c in _MACRO_COLS])


@register("cuisine_first_match", sql=with_views("recipes") + f"""
SELECT recipe_id, {S.cuisine_sql(S.string_list('tags'))} AS cuisine FROM recipes""")
def q_cuisine_first_match(spark, sf):
    r = E.add_cuisine(E.parse_list_columns(Catalog(spark, sf).recipes))
    return r.select("recipe_id", "cuisine")


@register("allergen_flags", sql=with_views("recipes") + "SELECT recipe_id, " + ", ".join(
    f"{S.allergen_sql(S.string_list('ingredients'), a)} AS has_{a}" for a in vocab.ALLERGENS_SORTED)
    + " FROM recipes")
def q_allergen_flags(spark, sf):
    r = E.allergen_flags(E.parse_list_columns(Catalog(spark, sf).recipes))
    return r.select("recipe_id", *[f"has_{a}" for a in vocab.ALLERGENS_SORTED])


_ENRICHED_OUT = ["recipe_id", "name", "minutes", "n_ingredients", "n_steps", "description",
                 "avg_rating", "n_reviews", "cuisine"] + _MACRO_COLS


def _enriched_sql(qt, k):
    cols = ", ".join(
        [f"round({c}, 6) AS {c}" if c in _MACRO_COLS or c == "avg_rating" else c
         for c in _ENRICHED_OUT]
        + ["array_to_string(tags, '|') AS tag_text", "array_to_string(allergens, '|') AS allergen_text"])
    return with_views("interactions", "recipes", extra=S.enriched_ctes(qt, k)) + \
        f"SELECT {cols} FROM enriched"


def _enriched_spark(spark, sf, qt, k):
    e = _enriched(Catalog(spark, sf), qt, k)
    return e.select(*[X.round6(c).alias(c) if c in _MACRO_COLS or c == "avg_rating" else c
                      for c in _ENRICHED_OUT],
                    F.array_join("tags", "|").alias("tag_text"),
                    F.array_join("allergens", "|").alias("allergen_text"))


@register("enrich_recipes", sql=_enriched_sql(vocab.MINUTES_QUANTILE, vocab.MIN_REVIEWS))
def q_enrich_recipes(spark, sf):
    return _enriched_spark(spark, sf, vocab.MINUTES_QUANTILE, vocab.MIN_REVIEWS)


@register("enrich_recipes_tight", sql=_enriched_sql(TIGHT_Q, TIGHT_MIN_REVIEWS))
def q_enrich_recipes_tight(spark, sf):
    return _enriched_spark(spark, sf, TIGHT_Q, TIGHT_MIN_REVIEWS)


@register("cuisine_topk", sql=with_views("interactions", "recipes", extra=S.enriched_ctes()) + """
SELECT cuisine, count(*) AS n FROM enriched GROUP BY cuisine ORDER BY n DESC, cuisine LIMIT 5""")
def q_cuisine_topk(spark, sf):
    return E.cuisine_topk(_enriched(Catalog(spark, sf)), 5)


@register("label_interactions", sql=with_views("interactions") + f"""
SELECT user_id, recipe_id, l_orderkey, l_linenumber, l_suppkey, rating,
  CAST(coalesce(rating >= {vocab.POSITIVE_RATING}, false) AS INTEGER) AS label FROM interactions""")
def q_label_interactions(spark, sf):
    i = Catalog(spark, sf).interactions
    return i.select("user_id", "recipe_id", "l_orderkey", "l_linenumber", "l_suppkey", "rating",
                    X.label_from_rating("rating").alias("label"))


@register("pseudonymise_ids", sql=with_views("recipes") + """
SELECT name, count(*) AS n_ids, min(recipe_id) AS first_id,
  CAST(('0x' || substr(sha256(name), 1, 8))::BIGINT & 2147483647 AS BIGINT) AS surrogate
FROM recipes WHERE name IS NOT NULL GROUP BY name""")
def q_pseudonymise_ids(spark, sf):
    r = Catalog(spark, sf).recipes.filter(F.col("name").isNotNull())
    return (r.groupBy("name").agg(F.count(F.lit(1)).alias("n_ids"),
                                  F.min("recipe_id").alias("first_id"))
            .withColumn("surrogate", X.stable_id("name")))


@register("pseudonymise_collisions", sql=with_views("interactions") + """
, i AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id FROM interactions)
, h AS (SELECT id, CAST(('0x' || substr(sha256(id), 1, 8))::BIGINT & 65535 AS BIGINT) AS surrogate FROM i)
SELECT surrogate, count(*) AS n_ids, min(id) AS first_id, max(id) AS last_id FROM h GROUP BY surrogate HAVING count(*) > 1""")
def q_pseudonymise_collisions(spark, sf):
    """Order ids under 16-bit surrogates, as many as collide at any size."""
    return X.id_collisions(Catalog(spark, sf).interactions, "l_orderkey", bits=16)
