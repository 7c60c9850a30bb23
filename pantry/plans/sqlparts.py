"""DuckDB SQL fragments for the oracle side (independent re-statement of each
operator in plain SQL; the Spark side is DataFrame code in pantry.operators)."""

from __future__ import annotations

from .. import vocab


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def cuisine_case(expr: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in vocab.CUISINE_MAP.items())
    return f"(CASE {expr} {whens} END)"


def cuisine_sql(tag_list: str) -> str:
    mapped = f"list_transform({tag_list}, lambda t: {cuisine_case('lower(t)')})"
    return f"coalesce(list_filter({mapped}, lambda x: x IS NOT NULL)[1], 'unknown')"


def allergen_sql(ing_list: str, allergen: str) -> str:
    cond = " OR ".join(f"contains(lower(i), {q(k)})" for k in vocab.ALLERGEN_KEYWORDS[allergen])
    return f"CAST(len(list_filter({ing_list}, lambda i: {cond})) > 0 AS INTEGER)"


def string_list(col: str) -> str:
    return f"coalesce(TRY_CAST({col} AS VARCHAR[]), CAST([] AS VARCHAR[]))"


def enriched_ctes(qt: float = vocab.MINUTES_QUANTILE,
                  min_reviews: int = vocab.MIN_REVIEWS) -> list[tuple[str, str]]:
    """CTEs ending in ``enriched`` (needs views interactions, recipes)."""
    nut = [f"CASE WHEN len(nut) >= 7 THEN nut[{i + 1}] END AS {name}"
           for i, name in enumerate(vocab.NUTRITION_FIELDS)]
    grams = [f"{c} / 100.0 * {f}.0 AS {c}_g" for c, f in vocab.PDV_TO_ABS.items()]
    allergens = ", ".join(
        f"CASE WHEN {allergen_sql('ingredients', a)} = 1 THEN {q(a)} END"
        for a in vocab.ALLERGENS_SORTED)
    return [
        ("r_stats", "SELECT recipe_id, avg(rating) AS avg_rating, count(rating) AS n_reviews "
                    "FROM interactions GROUP BY recipe_id"),
        ("r_joined", "SELECT r.recipe_id, r.name, r.minutes, r.tags, r.ingredients, r.n_ingredients, "
                     "r.n_steps, r.nutrition, r.description, coalesce(s.avg_rating, 0.0) AS avg_rating, "
                     "CAST(coalesce(s.n_reviews, 0) AS BIGINT) AS n_reviews "
                     "FROM recipes r LEFT JOIN r_stats s ON r.recipe_id = s.recipe_id"),
        ("r_named", "SELECT * REPLACE (coalesce(description, '') AS description) "
                    "FROM r_joined WHERE name IS NOT NULL"),
        ("r_filtered", f"SELECT * FROM r_named WHERE minutes > 0 AND minutes <= "
                       f"(SELECT quantile_cont(minutes, {qt}) FROM r_named) "
                       f"AND n_reviews >= {min_reviews}"),
        ("r_parsed", f"SELECT * REPLACE ({string_list('tags')} AS tags, "
                     f"{string_list('ingredients')} AS ingredients), "
                     f"TRY_CAST(nutrition AS DOUBLE[]) AS nut FROM r_filtered"),
        ("r_macros", f"SELECT *, {cuisine_sql('tags')} AS cuisine, "
                     f"list_filter([{allergens}], lambda x: x IS NOT NULL) AS allergens, "
                     + ", ".join(nut) + " FROM r_parsed"),
        ("enriched", "SELECT * EXCLUDE (nut, nutrition), " + ", ".join(grams) + " FROM r_macros"),
    ]


def labeled_cte() -> tuple[str, str]:
    return ("labeled", f"SELECT *, CAST(coalesce(rating >= {vocab.POSITIVE_RATING}, false) "
                       "AS INTEGER) AS label FROM interactions")



def training_ctes(qt: float = vocab.MINUTES_QUANTILE, min_reviews: int = vocab.MIN_REVIEWS,
                  min_n: int = vocab.MIN_USER_INTERACTIONS) -> list[tuple[str, str]]:
    """enriched -> labeled -> valid -> history -> user features -> training."""
    diet = ", ".join(
        f"CAST(avg(CASE WHEN list_contains(list_transform(tags, lambda t: lower(t)), {q(t)}) "
        f"THEN 1 ELSE 0 END) >= CAST({vocab.DIET_FLAG_SHARE} AS DOUBLE) AS INTEGER) AS {c}"
        for c, t in vocab.DIET_TAGS.items())
    flags = ", ".join(f"CAST(coalesce(list_contains(allergens, {q(a)}), false) AS INTEGER) AS has_{a}"
                      for a in vocab.ALLERGENS_SORTED)
    return enriched_ctes(qt, min_reviews) + [
        labeled_cte(),
        ("valid", "SELECT * FROM labeled WHERE recipe_id IN (SELECT recipe_id FROM enriched)"),
        ("history", "SELECT v.*, e.calories, e.protein_g, e.carbohydrate_g, e.total_fat_g, e.cuisine, e.tags "
                    "FROM valid v LEFT JOIN enriched e ON v.recipe_id = e.recipe_id"),
        ("u_targets", "SELECT user_id, avg(calories) AS daily_calorie_target, avg(protein_g) AS protein_target_g, "
                      "avg(carbohydrate_g) AS carbs_target_g, avg(total_fat_g) AS fat_target_g "
                      "FROM history WHERE label = 1 GROUP BY user_id"),
        ("u_diet", f"SELECT user_id, {diet} FROM history WHERE label = 1 GROUP BY user_id"),
        ("u_active", f"SELECT user_id FROM valid GROUP BY user_id HAVING count(*) >= {min_n}"),
        ("user_features", "SELECT t.*, " + ", ".join(vocab.DIET_TAGS) +
         " FROM u_targets t LEFT JOIN u_diet d ON t.user_id = d.user_id "
         "WHERE t.user_id IN (SELECT user_id FROM u_active)"),
        ("recipe_feats", f"SELECT * EXCLUDE (tags, ingredients, description, allergens), {flags} FROM enriched"),
        ("training", "SELECT v.user_id, v.recipe_id, v.date, v.rating, v.label, v.l_orderkey, v.l_linenumber, "
                     "v.l_suppkey, v.l_shipdate, r.* EXCLUDE (recipe_id), u.* EXCLUDE (user_id) "
                     "FROM valid v JOIN recipe_feats r ON v.recipe_id = r.recipe_id "
                     "JOIN user_features u ON v.user_id = u.user_id"),
    ]


def split_cte(src: str = "training", name: str = "splits") -> tuple[str, str]:
    return (name, f"""SELECT *, CASE WHEN _pos < floor(_n * CAST(0.8 AS DOUBLE)) THEN 'train'
  WHEN _pos < floor(_n * (CAST(0.8 AS DOUBLE) + CAST(0.1 AS DOUBLE))) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY date, l_orderkey, l_linenumber, recipe_id, l_suppkey, l_shipdate) - 1 AS _pos,
  count(*) OVER () AS _n FROM {src}) s""")


def ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


TIE = "recipe_id, l_orderkey, l_linenumber, l_suppkey, l_shipdate"


def scored_test_ctes() -> list[tuple[str, str]]:
    """training -> splits -> test rows LEFT JOIN scores (needs view scores)."""
    return training_ctes() + [split_cte(), (
        "scored", "SELECT s.*, sc.score FROM splits s LEFT JOIN scores sc "
                  "ON s.user_id = sc.user_id AND s.recipe_id = sc.recipe_id WHERE s.split = 'test'")]


def ndcg_linear_cte(src: str = "scored", name: str = "lin") -> tuple[str, str]:
    return (name, f"""SELECT user_id, CASE WHEN sum(label / log2(_i + 1)) > 0
    THEN sum(label / log2(_r + 1)) / sum(label / log2(_i + 1)) ELSE 0.0 END AS ndcg
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY label DESC, _r) AS _i
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, {TIE}) AS _r FROM {src}) a
      WHERE _r <= 10) b
GROUP BY user_id""")


def ndcg_exp_cte(src: str = "scored", name: str = "expn") -> tuple[str, str]:
    return (name, f"""SELECT user_id, CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0.0 END AS ndcg FROM (
  SELECT user_id,
    sum(CASE WHEN _r <= 10 THEN (pow(2.0, label) - 1) / log2(_r + 1) ELSE 0 END) AS dcg,
    sum(CASE WHEN _i <= 10 THEN (pow(2.0, label) - 1) / log2(_i + 1) ELSE 0 END) AS idcg
  FROM (SELECT user_id, label,
      row_number() OVER (PARTITION BY user_id ORDER BY score DESC, {TIE}) AS _r,
      row_number() OVER (PARTITION BY user_id ORDER BY label DESC, {TIE}) AS _i FROM {src}) a
  GROUP BY user_id) b""")
