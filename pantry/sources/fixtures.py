"""Logical tables of the recommender, derived from the driver's base tables.

The view texts are the ones in FIXTURES.md (they give the TPC-H-style tables the
shape of recipes, interactions, serving logs, meals ...).  Each text is written
once with ``{table}`` placeholders: Spark runs it through ``spark.sql(text,
table=DataFrame)`` (no global temp views), and the DuckDB oracle uses the same
text with bare table names as a CTE.  ``{{``/``}}`` are literal braces.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

VIEW_SQL: dict[str, str] = {
    "interactions": """
SELECT o.o_custkey AS user_id, l.l_partkey AS recipe_id, o.o_orderdate AS date,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(floor((l.l_quantity - 1) / 10) + 1 AS INT) END AS rating,
  l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_shipdate
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "recipes": """
SELECT p_partkey AS recipe_id,
  CASE WHEN p_partkey % 83 = 82 THEN NULL ELSE p_name END AS name,
  CASE WHEN p_partkey % 61 = 60 THEN 0 ELSE p_size END AS minutes,
  CASE WHEN p_partkey % 97 = 96 THEN 'garbage' ELSE concat('[''', CASE p_partkey % 12
     WHEN 0 THEN 'italian' WHEN 1 THEN 'north-american' WHEN 2 THEN 'Mexican' WHEN 3 THEN 'greek'
     WHEN 4 THEN 'thai' WHEN 5 THEN 'szechuan' WHEN 6 THEN 'indian' WHEN 7 THEN 'french'
     WHEN 8 THEN 'lebanese' WHEN 9 THEN 'cuban' WHEN 10 THEN 'hawaiian' ELSE '60-minutes-or-less' END, '''',
     CASE WHEN p_partkey % 10 <> 0 THEN ', ''vegetarian''' ELSE '' END,
     CASE WHEN p_partkey % 5 <> 0 THEN ', ''vegan''' ELSE '' END,
     CASE WHEN p_partkey % 4 <> 0 THEN ', ''gluten-free''' ELSE '' END,
     CASE WHEN p_partkey % 3 = 0 THEN ', ''dairy-free''' ELSE '' END,
     CASE WHEN p_size <= 42 THEN ', ''low-sodium''' ELSE '' END,
     CASE WHEN p_size > 10 THEN ', ''low-fat''' ELSE '' END, ']') END AS tags,
  concat('[', CASE p_partkey % 7 WHEN 0 THEN '''whole milk''' WHEN 1 THEN '''Egg Yolk''' WHEN 2 THEN '''soy sauce''' WHEN 3 THEN '"baker''s flour"'
     WHEN 4 THEN '''peanut butter''' WHEN 5 THEN '''tiger shrimp''' ELSE '''rice''' END,
     CASE WHEN p_partkey % 2 = 0 THEN ', ''cheddar cheese''' ELSE ', ''salt''' END,
     CASE WHEN p_partkey % 11 = 0 THEN ', ''tahini''' ELSE '' END,
     CASE WHEN p_partkey % 13 = 0 THEN ', ''smoked salmon''' ELSE '' END, ']') AS ingredients,
  CASE WHEN p_partkey % 101 = 100 THEN '[1.0, 2.0]' ELSE concat('[', 200 + (p_partkey * 37) % 600, '.0, ', (p_partkey * 7) % 60, '.0, ', (p_partkey * 11) % 90, '.0, ',
     (p_partkey * 13) % 50, '.0, ', (p_partkey * 17) % 80, '.0, ', (p_partkey * 19) % 70, '.0, ', (p_partkey * 23) % 40, '.0]') END AS nutrition,
  1 + p_partkey % 15 AS n_steps,
  2 + CASE WHEN p_partkey % 11 = 0 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 13 = 0 THEN 1 ELSE 0 END AS n_ingredients,
  CASE WHEN p_partkey % 50 = 49 THEN NULL ELSE concat(p_brand, ' ', p_type) END AS description
FROM {part}""",
    "scores": """
SELECT DISTINCT o.o_custkey AS user_id, l.l_partkey AS recipe_id,
  CAST((l.l_partkey * 7919 + o.o_custkey * 104729) % 10007 AS DOUBLE) / 10007 AS score
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "request_log": """
SELECT event_id AS request_id, ts, user_id, event_id % 2000 AS recipe_id,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
  value / 100 AS latency_s, value / 500 AS score,
  concat('v', CAST(event_id % 3 + 1 AS VARCHAR(10))) AS model_version,
  CAST(1 + event_id % 5 AS INT) AS rank_pos, props AS features FROM {events}""",
    "user_goals": """
SELECT c_custkey AS user_id, CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1800 + c_custkey % 700 END AS calories,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 40 + c_custkey % 60 END AS protein, 200 + c_custkey % 100 AS carbs, 50 + c_custkey % 40 AS fat,
  1 AS updated_at, 1 AS created_at FROM {customer}
UNION ALL SELECT c_custkey, 2500, 90, 300, 80, 2, 1 FROM {customer} WHERE c_custkey % 4 = 0""",
    "food_variants": """
SELECT p_partkey * 2 + v AS id, p_partkey AS food_id, CASE WHEN p_partkey % 40 = 0 THEN 0 ELSE p_size * 10 END AS serving_size,
  50 + (p_partkey * 37) % 400 AS calories, (p_partkey * 17) % 40 AS protein, (p_partkey * 23) % 60 AS carbs, (p_partkey * 7) % 30 AS fat,
  (p_partkey * 13) % 900 AS sodium, CASE WHEN v = 0 THEN p_partkey % 2 = 0 ELSE p_partkey % 2 = 1 END AS is_default, (p_partkey * 31 + v) % 97 AS updated_at
FROM {part} CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1) t""",
    "meals": """
SELECT o_orderkey AS id, concat('meal ', CAST(o_orderkey AS VARCHAR(20))) AS name, o_custkey AS user_id, o_orderkey % 3 = 0 AS is_public, o_orderdate AS entry_date FROM {orders}""",
    "meal_foods": """
SELECT l_orderkey AS meal_id, l_partkey * 2 AS variant_id, l_quantity AS quantity, l_linenumber FROM {lineitem}""",
    "contexts": """
SELECT c_custkey AS request_id, c_custkey AS user_id, 300 + c_custkey % 600 AS calorie_target, 10 + c_custkey % 60 AS time_limit,
  c_custkey % 2 = 0 AS no_milk, c_custkey % 3 = 0 AS no_egg, c_custkey % 5 = 0 AS no_wheat,
  c_custkey % 7 = 0 AS no_nuts, c_custkey % 11 = 0 AS no_peanut, c_custkey % 13 = 0 AS no_fish, c_custkey % 17 = 0 AS no_shellfish,
  c_custkey % 19 = 0 AS no_soy, CASE WHEN c_custkey % 23 > 1 THEN false WHEN c_custkey % 23 = 1 THEN true END AS no_sesame,
  CASE c_custkey % 6 WHEN 0 THEN 'breakfast' WHEN 1 THEN 'lunch' WHEN 2 THEN 'dinner' WHEN 3 THEN 'snack' WHEN 4 THEN 'dessert' END AS meal_type,
  CASE c_custkey % 4 WHEN 0 THEN 'morning' WHEN 1 THEN 'evening' WHEN 2 THEN 'noon' END AS time_of_day FROM {customer}""",
    "model_runs": """
SELECT n_nationkey AS run_id, CAST(50 + (n_nationkey * 37) % 40 AS DOUBLE) / 100 AS ndcg_at_10, n_nationkey % 5 <> 0 AS fairness_passed, n_nationkey % 6 = 3 AS is_production FROM {nation}""",
    "products": """
SELECT p_partkey AS code, concat('{{"product_name":"', p_name, '","brands":" ', p_brand, ' ,x","serving_quantity":', p_size % 4 * 25,
  ',"nutriments":{{"energy-kcal_100g":', 50 + (p_partkey * 37) % 400, ',"proteins_100g":', (p_partkey * 17) % 40, ',"sodium_100g":', CASE WHEN p_partkey % 3 = 0 THEN '0' ELSE '0.4' END, '}}}}') AS doc FROM {part}""",
}

_PLACEHOLDER = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def view_dependencies(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(VIEW_SQL[name])))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame of one logical view over the parquet tables in sf_dir."""
    deps = {t: read_table(spark, sf_dir, t) for t in view_dependencies(name)}
    return spark.sql(VIEW_SQL[name], **deps)


def scores_of(interactions: DataFrame) -> DataFrame:
    """The view ``scores`` over the rows of ``interactions``, which come from the same join:
    who holds them written need not join the tables again."""
    text = VIEW_SQL["scores"].replace("FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey", "FROM {interactions}")
    return interactions.sparkSession.sql(text.replace("o.o_custkey", "user_id").replace("l.l_partkey", "recipe_id"), interactions=interactions)


def duckdb_view_sql(name: str) -> str:
    """The same view text for DuckDB, where the base tables are named views."""
    return VIEW_SQL[name].format(**{t: t for t in view_dependencies(name)})


class Catalog:
    """Lazily built logical tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]

    def view(self, name: str) -> DataFrame:
        key = "view:" + name
        if key not in self._cache:
            self._cache[key] = view(self.spark, self.sf_dir, name)
        return self._cache[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in VIEW_SQL:
            return self.view(name)
        return self.table(name)


def production_split(interactions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(historical, production) halves of interactions: even / odd l_orderkey
    (FIXTURES.md section 3).  Production rows arrive without the ordering columns."""
    hist = interactions.filter(F.pmod(F.col("l_orderkey"), F.lit(2)) == 0)
    prod = interactions.filter(F.pmod(F.col("l_orderkey"), F.lit(2)) == 1)
    return hist, prod


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
