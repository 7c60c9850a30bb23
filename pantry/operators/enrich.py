"""Recipe enrichment: review stats, filtering, list parsing, cuisine, allergens, macros.

Scale notes
* ``recipe_stats`` is a hash aggregate with map-side partial aggregation, so a
  recipe holding a third of all interactions costs one partial row per task.
* The minutes percentile is selected between bounds from a sketch (``quantiles``):
  exact, and no task holds all values.  ``approx=True`` takes the sketch's answer.
* The one-row threshold is joined with a ``crossJoin`` against a provably
  one-row frame; Spark broadcasts it (bounded by construction).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import exprs as X
from .quantiles import exact_quantiles


def recipe_stats(interactions: DataFrame) -> DataFrame:
    """(recipe_id, avg_rating, n_reviews): mean and count of non-NULL ratings."""
    return interactions.groupBy("recipe_id").agg(
        F.avg("rating").alias("avg_rating"),
        F.count("rating").alias("n_reviews"))


def join_recipe_stats(recipes: DataFrame, interactions: DataFrame) -> DataFrame:
    """recipes LEFT JOIN review stats; recipes without reviews get 0 / 0."""
    stats = recipe_stats(interactions)
    return (recipes.join(stats, "recipe_id", "left")
            .withColumn("avg_rating", F.coalesce(F.col("avg_rating"), F.lit(0.0)))
            .withColumn("n_reviews", F.coalesce(F.col("n_reviews"), F.lit(0)).cast("bigint")))


def minutes_upper_bound(recipes_named: DataFrame, q: float = vocab.MINUTES_QUANTILE,
                        approx: bool = False) -> DataFrame:
    """One-row frame with the q-quantile (linear interpolation) of minutes."""
    if approx:
        return recipes_named.agg(F.percentile_approx(F.col("minutes").cast("double"), q, 10000).alias("minutes_upper"))
    return exact_quantiles(recipes_named, [], "minutes", [q]).select(F.col("quantiles")[0].alias("minutes_upper"))


def recipe_filter(with_stats: DataFrame, q: float = vocab.MINUTES_QUANTILE,
                  min_reviews: int = vocab.MIN_REVIEWS, approx: bool = False) -> DataFrame:
    """name NOT NULL; description NULL -> ''; 0 < minutes <= q-quantile; n_reviews >= k.

    The quantile is taken after the name filter and before the minutes filter.
    """
    named = (with_stats.filter(F.col("name").isNotNull())
             .withColumn("description", F.coalesce(F.col("description"), F.lit(""))))
    upper = minutes_upper_bound(named, q, approx)
    return (named.crossJoin(upper)
            .filter((F.col("minutes") > 0) & (F.col("minutes") <= F.col("minutes_upper"))
                    & (F.col("n_reviews") >= min_reviews))
            .drop("minutes_upper"))


def parse_list_columns(recipes: DataFrame) -> DataFrame:
    """tags / ingredients list literals -> array<string> (malformed -> [])."""
    return recipes.withColumns({"tags": X.parse_string_list("tags"),
                                "ingredients": X.parse_string_list("ingredients")})


def nutrition_macros(recipes: DataFrame, source: str = "nutrition") -> DataFrame:
    """7 macro columns from the nutrition list (+ 6 absolute ``*_g`` columns).

    Lists with fewer than 7 numbers, malformed text or NULL give NULLs.
    ``sodium_g`` keeps the reference's factor (2300) and therefore holds mg.
    """
    arr = X.parse_double_list(source)
    out = recipes.withColumn("_nut", arr)
    cols = {name: X.nutrition_field(F.col("_nut"), i)
            for i, name in enumerate(vocab.NUTRITION_FIELDS)}
    out = out.withColumns(cols)
    out = out.withColumns({f"{c}_g": F.col(c) / F.lit(100.0) * F.lit(float(f))
                           for c, f in vocab.PDV_TO_ABS.items()})
    return out.drop("_nut", source)


def add_cuisine(recipes: DataFrame) -> DataFrame:
    """cuisine = first mapped tag (expects ``tags`` as array<string>)."""
    return recipes.withColumn("cuisine", X.cuisine_first_match("tags"))


def add_allergens(recipes: DataFrame, as_flags: bool = False) -> DataFrame:
    """allergens array (and optionally the 9 ``has_*`` 0/1 flags)."""
    out = recipes.withColumn("allergens", X.allergen_list("ingredients"))
    if as_flags:
        out = out.withColumns({f"has_{a}": F.array_contains("allergens", a).cast("int")
                               for a in vocab.ALLERGENS_SORTED})
    return out


def allergen_flags(recipes: DataFrame) -> DataFrame:
    """9 ``has_*`` flags straight from the ingredient list."""
    return recipes.withColumns({f"has_{a}": X.allergen_flag("ingredients", a)
                                for a in vocab.ALLERGENS_SORTED})


def enrich_recipes(recipes: DataFrame, interactions: DataFrame,
                   q: float = vocab.MINUTES_QUANTILE, min_reviews: int = vocab.MIN_REVIEWS,
                   approx: bool = False) -> DataFrame:
    """Full enrichment: stats join -> filter -> cuisine -> allergens -> macros."""
    base = recipes.select("recipe_id", "name", "minutes", "tags", "ingredients",
                          "n_ingredients", "n_steps", "nutrition", "description")
    out = recipe_filter(join_recipe_stats(base, interactions), q, min_reviews, approx)
    out = add_cuisine(parse_list_columns(out))
    out = add_allergens(out)
    return nutrition_macros(out)


def cuisine_topk(enriched: DataFrame, k: int = 5) -> DataFrame:
    """Most frequent cuisines (count desc, name asc) - the top-k is the feature."""
    return (enriched.groupBy("cuisine").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc("cuisine")).limit(k))
