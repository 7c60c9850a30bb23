"""Candidate generation and serving-side table operators, for all users at once.

Scale notes
* ``rule_candidates`` is a range join (calories within [0.5, 1.5] x target).
  It is executed as a *bucketed* equi-join: each request is exploded into the
  calorie buckets its band overlaps (a bounded number: band width / bucket
  width + 1), recipes carry their single bucket, the join is a hash/sort-merge
  equi-join on the bucket, and the exact predicate is applied after it.  What is
  known of a request or of a recipe alone joins it before, so pairs never move.  No
  BroadcastNestedLoopJoin / Cartesian product is planned.  Requests are dealt
  out by their id first: a small table is few file parts, and the tasks that
  read them would list all pairs.
* Visibility ``is_public OR owner = user`` is never evaluated as a theta join;
  meal nutrients are aggregated once per meal, and per-user selections are
  equi-joins on the owner.
* "Latest row per key" uses ``max_by`` on a struct ordering key (partial
  aggregation, so a key with a third of the rows is pre-reduced per task).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import exprs as X
from ..sources.snapshots import SnapshotTable, by_bucket

GOAL_COLS = ["calories", "protein", "carbs", "fat"]
NUTRIENTS = ["calories", "protein", "carbs", "fat", "saturated_fat", "sugars", "sodium", "dietary_fiber"]


def _desc_nulls_first_key(*cols: str) -> Column:
    """Struct ordering key whose max() equals PostgreSQL's ORDER BY c DESC
    (NULLS FIRST) for each column in turn."""
    parts = []
    for c in cols:
        parts += [F.col(c).isNull().alias(f"_{c}_null"), F.col(c).alias(f"_{c}")]
    return F.struct(*parts)


def latest_per_key(df: DataFrame, key: str, order: list[str], value_cols: list[str]) -> DataFrame:
    """One row per key: the row first under ORDER BY order[0] DESC, order[1] DESC ...
    (PostgreSQL null order: NULLs first).  Equivalent to DISTINCT ON (key)."""
    v = F.max_by(F.struct(*[F.col(c) for c in value_cols]), _desc_nulls_first_key(*order))
    return df.groupBy(key).agg(v.alias("_v")).select(key, *[F.col(f"_v.{c}").alias(c) for c in value_cols])


def user_goal_defaults(goals: DataFrame) -> DataFrame:
    """Latest goals per user (updated_at DESC, created_at DESC); 0 or NULL -> defaults."""
    latest = latest_per_key(goals, "user_id", ["updated_at", "created_at"], GOAL_COLS)
    return latest.select("user_id", *[
        F.coalesce(F.nullif(F.col(c).cast("double"), F.lit(0.0)), F.lit(vocab.GOAL_DEFAULTS[c])).alias(c)
        for c in GOAL_COLS])


def meal_nutrients(meals: DataFrame, meal_foods: DataFrame, variants: DataFrame) -> DataFrame:
    """Per meal: n_ingredients and SUM(nutrient * quantity / NULLIF(serving_size, 0))
    over meals LEFT JOIN meal_foods LEFT JOIN food_variants.

    Foods meet their variants first: what moves is a food's numbers, and neither its
    meal's name nor, as the sums are taken where the meals are joined, sums of DECIMAL."""
    vcols = variants.columns
    mf = meal_foods.select("meal_id", "variant_id", "quantity")
    fv = variants.select(F.col("id").alias("variant_id"), "serving_size",
                         *[F.col(n) if n in vcols else F.lit(None).cast("double").alias(n) for n in NUTRIENTS])
    j = (meals.select(F.col("id").alias("meal_id"), F.col("name").alias("meal_name"), "user_id", "is_public")
         .join(mf.join(fv, "variant_id", "left"), "meal_id", "left"))
    per = F.col("quantity") / F.nullif(F.col("serving_size").cast("double"), F.lit(0.0))
    # Terms are summed as DECIMAL so the totals do not depend on partitioning /
    # summation order (double addition is not associative).
    return j.groupBy("meal_id", "meal_name", "user_id", "is_public").agg(
        F.count("variant_id").alias("n_ingredients"),
        *[F.sum((F.col(n).cast("double") * per).cast("decimal(38,12)")).cast("double").alias(n)
          for n in NUTRIENTS])


def visible_meals(users: DataFrame, meal_agg: DataFrame) -> DataFrame:
    """(user_id, meal) pairs a user may see: own meals (equi-join on owner).
    Public meals are one shared table (``is_public``), not replicated per user."""
    return users.select("user_id").join(meal_agg, "user_id", "inner")


def recently_logged(entries: DataFrame, days: int, date_col: str = "entry_date",
                    meal_col: str = "meal_template_id") -> DataFrame:
    """DISTINCT (user_id, meal) logged within ``days`` of the newest entry."""
    newest = entries.agg(F.max(date_col).alias("_now"))  # one row: the reference time
    start = X.scalar_of(newest, F.col("_now") - F.make_dt_interval(F.lit(days)), entries, date_col)
    recent = entries.filter(F.col(meal_col).isNotNull() & (F.col(date_col) >= start))
    return recent.select("user_id", F.col(meal_col).alias("meal_id")).distinct()


def exclude_recent_meals(candidates: DataFrame, recent: DataFrame) -> DataFrame:
    """Candidates NOT IN the recently logged meals (null-safe LEFT ANTI)."""
    return candidates.join(recent, ["user_id", "meal_id"], "left_anti")


#: Copies of a bucket of recipes that requests are dealt out over.
MOST_COPIES = 16


def rule_candidates(requests: DataFrame, recipes: DataFrame, bucket_width: float = 50.0,
                    allergen_flags: dict[str, str] | None = None,
                    low: float = 0.5, high: float = 1.5, block_rows: int = 50_000) -> DataFrame:
    """Per request: recipes with low*cal <= calories <= high*cal, minutes <= limit and
    none of the requested allergens.  Bucketed range join (see module notes).

    requests: request_id, calorie_target, time_limit and boolean exclusion
    columns named in ``allergen_flags`` (column -> has_* flag of the recipe; all nine
    allergens by default, as far as both sides have them).  The flags of a row are one
    mask, so the test in the join is one ``and``.  A request without a target or limit has the defaults of 600 kcal and 120 minutes.

    The planner picks the join by measured sizes for up to ``block_rows`` recipes.  More
    are joined by sort-merge, which holds the recipes of a key: a bucket is cut into blocks
    of about ``block_rows`` recipes, and its requests are dealt out over several copies of it,
    as the few buckets there are would be as few tasks.
    """
    requests = requests.withColumns({
        "calorie_target": F.coalesce(F.col("calorie_target").cast("double"), F.lit(vocab.DEFAULT_CALORIE_TARGET)),
        "time_limit": F.coalesce(F.col("time_limit").cast("double"), F.lit(vocab.DEFAULT_TIME_LIMIT))})
    allergen_flags = allergen_flags or {f"no_{a}": f"has_{a}" for a in vocab.ALLERGENS_SORTED}
    flags = [(no, has) for no, has in allergen_flags.items() if no in requests.columns and has in recipes.columns]

    def mask(bits: list[Column]) -> Column:
        return reduce(Column.__add__, [F.when(b, F.lit(1 << i)).otherwise(F.lit(0)) for i, b in enumerate(bits)], F.lit(0))

    lo = F.col("calorie_target") * F.lit(low)
    hi = F.col("calorie_target") * F.lit(high)
    parts = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if "request_id" in requests.columns:
        requests = requests.repartition(parts, "request_id")
    req = requests.withColumn("_no", mask([F.col(no) for no, _ in flags])).withColumn("_b", F.explode(F.sequence(F.floor(lo / bucket_width).cast("bigint"),
                                                         F.floor(hi / bucket_width).cast("bigint"))))
    rec = recipes.filter(F.col("calories").isNotNull()).withColumn("_has", mask([F.col(has) == 1 for _, has in flags])).withColumn(
        "_b", F.floor(F.col("calories") / bucket_width).cast("bigint"))
    most, n = rec.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()  # one row
    keys = ["_b"]
    if n and n > block_rows:
        copies = min(MOST_COPIES, max(1, parts // 4))
        blocks = -(-most // block_rows)
        every = lambda k: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint")))
        req = req.withColumn("_copy", F.pmod(F.xxhash64("request_id" if "request_id" in requests.columns else requests.columns[0]), F.lit(copies))).withColumn("_block", every(blocks))
        rec = rec.withColumn("_block", F.pmod(F.xxhash64(recipes.columns[0], "calories", "minutes"), F.lit(blocks))).withColumn("_copy", every(copies))
        keys += ["_copy", "_block"]
        # into a set number of parts: by their size, which says nothing of the pairs, few tasks would be made of them
        req, rec = req.repartition(parts, *keys), rec.repartition(parts, *keys).hint("merge")
    j = req.join(rec, keys, "inner").drop("_copy", "_block")
    cond = (F.col("calories") >= lo) & (F.col("calories") <= hi) & (F.col("minutes") <= F.col("time_limit"))
    return j.filter(cond & (F.col("_no").bitwiseAND(F.col("_has")) == 0)).drop("_b", "_no", "_has")


def request_features(requests: DataFrame, user_feats: DataFrame, meal_type: str = "dinner", time_of_day: str = "evening") -> DataFrame:
    """Requests with what features say of them alone: their user's features (an unknown user
    has the default targets) and the one-hots of meal and time (columns ``meal_type`` and
    ``time_of_day``; NULL or no such column: the given defaults)."""
    j = requests.join(user_feats, "user_id", "left")
    j = j.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(d)) for c, d in vocab.TARGET_DEFAULTS.items() if c in j.columns})
    meal, time = (F.coalesce(F.col(c), F.lit(d)) if c in requests.columns else F.lit(d)
                  for c, d in (("meal_type", meal_type), ("time_of_day", time_of_day)))
    extra = {f"meal_{m}": (meal == m).cast("int") for m in ["breakfast", "lunch", "dinner", "snack", "dessert"]}
    return j.withColumns(extra | {f"time_{t}": (time == t).cast("int") for t in ["morning", "evening"]})


def cuisine_one_hots(recipes: DataFrame) -> DataFrame:
    """One column for each cuisine of the fixed vocabulary (no dynamic pivot)."""
    return recipes.withColumns({f"cuisine_{c}": (F.col("cuisine") == F.lit(c)).cast("int") for c in vocab.CUISINES})


def candidate_features(cands: DataFrame, user_feats: DataFrame | None, meal_type: str = "dinner",
                       time_of_day: str = "evening") -> DataFrame:
    """Candidate rows + user features + meal/time one-hots + cuisine one-hots; any NULL -> 0
    (see ``request_features`` and ``cuisine_one_hots``).  ``user_feats`` None: the rows are of
    requests and recipes that had theirs before ``rule_candidates`` made pairs of them, so
    that a user is looked up once a request and pairs don't move for it."""
    if user_feats is not None:
        cands = cuisine_one_hots(request_features(cands, user_feats, meal_type, time_of_day))
    return cands.fillna(0)


def with_goals(cands: DataFrame, goals: DataFrame | None, prefix: str = "goal_") -> DataFrame:
    """Candidates with their user's goals; users without goals have the defaults.
    ``goals`` None: the candidates bring them along (``pooled_meals``)."""
    if goals is None:
        return cands.withColumnsRenamed({f"goal_{c}": f"{prefix}{c}" for c in GOAL_COLS})
    g = goals.select("user_id", *[F.col(c).alias(f"{prefix}{c}") for c in GOAL_COLS])
    return cands.join(g, "user_id", "left").withColumns({
        f"{prefix}{c}": F.coalesce(F.col(f"{prefix}{c}"), F.lit(vocab.GOAL_DEFAULTS[c])) for c in GOAL_COLS})


def fallback_rank(meal_cands: DataFrame, goals: DataFrame | None, limit: int = 10) -> DataFrame:
    """Heuristic ranking when the model is down: order each user's candidates by
    |protein - 0.3 * protein goal|; keep ``limit``; score = max(0, 1 - idx / len)."""
    j = with_goals(meal_cands, goals, "_goal_")
    dist = F.abs(F.coalesce(F.col("protein"), F.lit(0.0)) - F.col("_goal_protein") * F.lit(0.3))
    # the distance as a column, so that neither of the two it comes from travels to the ranking for it
    j = j.withColumn("_dist", dist).drop(*[f"_goal_{c}" for c in GOAL_COLS])
    w = Window.partitionBy("user_id").orderBy("_dist", F.col("meal_id"))
    # a rank bounded from above, so that Spark keeps only ``limit`` rows of each user before the shuffle
    top = j.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= limit).withColumn("_idx", F.col("_rank") - 1)
    n = F.count(F.lit(1)).over(Window.partitionBy("user_id"))
    return (top.withColumn("_len", n)
            .withColumn("score", F.greatest(F.lit(0.0), F.lit(1.0) - F.col("_idx") / F.col("_len")))
            .withColumn("rank", F.col("_idx") + 1)
            .drop("_dist", "_idx", "_rank", "_len"))


def recommendation_reason(protein, calories, goal_protein, goal_calories) -> Column:
    """4-way reason text from a meal's protein / kcal versus the user's goals."""
    p = F.coalesce(protein, F.lit(0.0))
    cal = F.coalesce(calories, F.lit(0.0))
    pct = F.when(goal_calories > 0, X.js_round(cal / goal_calories * 100)).otherwise(F.lit(0.0))
    gp = goal_protein
    num = lambda c: X.js_round(c).cast("bigint").cast("string")
    # goals are printed as they are: whole ones without a fraction
    raw = lambda c: F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))
    return (F.when((p >= 25) & (p >= gp * 0.3),
                   F.concat(F.lit("High protein ("), num(p), F.lit(" g) — fits your "),
                            raw(gp), F.lit(" g target")))
            .when((cal > 0) & (pct >= 20) & (pct <= 35),
                  F.concat(F.lit("Balanced meal — ~"), pct.cast("bigint").cast("string"),
                           F.lit("% of your daily "), raw(goal_calories), F.lit(" kcal goal")))
            .when((cal > 0) & (cal <= goal_calories * 0.2),
                  F.concat(F.lit("Light option — only "), num(cal), F.lit(" kcal")))
            .otherwise(F.lit("Matches your nutritional profile")))


# FIXED VALUES: reference daily values used by the web side (sodium in grams).
PDV_REF = {"calories": 2000.0, "fat": 78.0, "sugar": 50.0, "sodium": 2.3, "protein": 50.0,
           "saturated_fat": 20.0, "carbohydrate": 275.0}


def meal_feature_vector(meal_cands: DataFrame, goals: DataFrame | None) -> DataFrame:
    """Meals x goals -> the 45 model features as the web side builds them.

    Calories are sent as % of 2000 (not kcal, unlike training), sodium mg -> g,
    unknown fields get constants; all NULL nutrients count as 0.
    """
    j = with_goals(meal_cands, goals)
    z = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    pdv = lambda v, ref: v / F.lit(ref) * F.lit(100.0)
    sodium_g = z("sodium") / F.lit(1000.0)
    cols = {
        "minutes": F.lit(30.0), "n_ingredients": F.col("n_ingredients").cast("double"), "n_steps": F.lit(5.0),
        "avg_rating": F.lit(0.0), "n_reviews": F.lit(0.0), "cuisine": F.lit("unknown"),
        "calories": pdv(z("calories"), PDV_REF["calories"]), "total_fat": pdv(z("fat"), PDV_REF["fat"]),
        "sugar": pdv(z("sugars"), PDV_REF["sugar"]), "sodium": pdv(sodium_g, PDV_REF["sodium"]),
        "protein": pdv(z("protein"), PDV_REF["protein"]),
        "saturated_fat": pdv(z("saturated_fat"), PDV_REF["saturated_fat"]),
        "carbohydrate": pdv(z("carbs"), PDV_REF["carbohydrate"]),
        "total_fat_g": z("fat"), "sugar_g": z("sugars"), "sodium_g": sodium_g, "protein_g": z("protein"),
        "saturated_fat_g": z("saturated_fat"), "carbohydrate_g": z("carbs"),
        "daily_calorie_target": F.col("goal_calories"), "protein_target_g": F.col("goal_protein"),
        "carbs_target_g": F.col("goal_carbs"), "fat_target_g": F.col("goal_fat"),
    }
    return j.select("user_id", "meal_id", X.stable_id(F.col("user_id")).alias("ml_user_id"),
                    X.stable_id(F.col("meal_id")).alias("ml_recipe_id"),
                    *[(cols[c] if c in cols else F.lit(0.0)).alias(c)
                      for c in vocab.FEATURE_COLUMNS if c != "rating"])


def rule_explanation(df: DataFrame) -> DataFrame:
    """Rule-based reasons (rating >= 4, calories <= 1.1 x target, vegetarian and
    no meat) joined into one sentence with a default."""
    has_meat = F.col("has_meat") if "has_meat" in df.columns else F.lit(0)
    reasons = F.filter(F.array(
        F.when(F.coalesce(F.col("avg_rating"), F.lit(0.0)) >= 4.0, F.lit("high community rating")),
        F.when(F.coalesce(F.col("calories"), F.lit(9999.0))
               <= F.coalesce(F.col("daily_calorie_target"), F.lit(9999.0)) * 1.1, F.lit("fits your calorie target")),
        F.when((F.coalesce(F.col("user_vegetarian"), F.lit(0)) != 0) & (F.coalesce(has_meat, F.lit(0)) == 0),
               F.lit("matches your vegetarian preference"))), lambda x: x.isNotNull())
    text = F.concat(F.lit("This recipe was recommended because: "),
                    F.when(F.size(reasons) > 0, F.array_join(reasons, ", "))
                    .otherwise(F.lit("it matches your overall preferences.")))
    return df.withColumn("explanation", text)


PRODUCT_SCHEMA = ("struct<product_name:string, product_name_en:string, brands:string, "
                  "serving_quantity:string, nutriments:map<string,string>>")


def product_normalise(products: DataFrame, doc_col: str = "doc", auto_scale: bool = True) -> DataFrame:
    """Raw product JSON -> one per-serving nutrient row (serving = quantity if > 0
    else 100; per-100 g values x serving/100; mg / ug unit factors; rounding;
    language fallback for the name; first brand trimmed)."""
    p = F.from_json(F.col(doc_col), PRODUCT_SCHEMA)
    d = products.withColumn("_p", p)
    # values may be numbers or quoted ones; texts such as units are no values
    nut = lambda k: F.coalesce(F.try_element_at("_p.nutriments", F.lit(k)).try_cast("double"), F.lit(0.0))
    quantity = F.col("_p.serving_quantity").try_cast("double")
    serving = (F.when(F.coalesce(quantity, F.lit(0.0)) > 0, quantity)
               .otherwise(F.lit(100.0))) if auto_scale else F.lit(100.0)
    d = d.withColumn("serving_size", serving).withColumn("_s", F.col("serving_size") / 100.0)
    r0 = lambda c: X.js_round(c).cast("double")
    r1 = lambda k: X.js_round(nut(k) * F.col("_s") * 10).cast("double") / 10
    milli = lambda k, f: F.when(nut(k) != 0, r0(nut(k) * f * F.col("_s"))).otherwise(F.lit(0.0))
    brand = F.trim(F.split(F.coalesce(F.col("_p.brands"), F.lit("")), ",").getItem(0))
    return d.select(
        F.col("code"),
        F.coalesce(F.nullif(F.col("_p.product_name_en"), F.lit("")), F.col("_p.product_name")).alias("name"),
        F.coalesce(brand, F.lit("")).alias("brand"), "serving_size",
        r0(nut("energy-kcal_100g") * F.col("_s")).alias("calories"),
        r1("proteins_100g").alias("protein"), r1("carbohydrates_100g").alias("carbs"),
        r1("fat_100g").alias("fat"), r1("saturated-fat_100g").alias("saturated_fat"),
        milli("sodium_100g", 1000).alias("sodium"), r1("fiber_100g").alias("dietary_fiber"),
        r1("sugars_100g").alias("sugars"))


def join_recommendation_id(predictions: DataFrame, instances: DataFrame, batch_key: str = "request_id",
                           position: str = "position") -> DataFrame:
    """predictions LEFT JOIN the recommendation id of the same (batch, recipe);
    when a batch lists a recipe twice the LAST instance wins."""
    last = (instances.groupBy(batch_key, "recipe_id")
            .agg(F.max_by("recommendation_id", position).alias("recommendation_id")))
    return predictions.join(last, [batch_key, "recipe_id"], "left")


def join_feedback_context(feedback: DataFrame, cache: DataFrame) -> DataFrame:
    """feedback LEFT JOIN cache on (recommendation id, user); forwarded only when
    request_id, ml_user_id and ml_recipe_id are all present."""
    c = cache.select(F.col("id").alias("recommendation_id"), "user_id", "request_id",
                     "ml_user_id", "ml_recipe_id")
    j = feedback.join(c, ["recommendation_id", "user_id"], "left")
    ok = F.col("request_id").isNotNull() & F.col("ml_user_id").isNotNull() & F.col("ml_recipe_id").isNotNull()
    return j.withColumn("forwarded", ok)


def upsert(current: DataFrame, incoming: DataFrame, key: str, update_cols: list[str],
           now_col: Column, ttl_days: int = 1, order: str | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO UPDATE: incoming rows replace the listed
    columns and refresh expires_at = now + ttl; other columns keep the current
    value; rows without a match are inserted, with created_at = now unless they
    bring one.  Of incoming rows with one key the last by ``order`` counts (null
    first; without ``order``, or among equals, the largest row), as statements run
    one after the other.  Full outer join on the key; ``now_col`` may name a column
    of ``incoming`` with the prefix ``_i_``."""
    row = F.struct(*[F.col(c) for c in incoming.columns])
    last = F.struct(F.col(order).alias("_order"), row.alias("_row")) if order else F.struct(row.alias("_row"))
    incoming = incoming.groupBy(key).agg(F.max(last).alias("_r")).select("_r._row.*")
    cur = current.select([F.col(c).alias(f"_c_{c}") for c in current.columns])
    inc = incoming.select([F.col(c).alias(f"_i_{c}") for c in incoming.columns])
    j = cur.join(inc, F.col(f"_c_{key}") == F.col(f"_i_{key}"), "full_outer")
    hit = F.col(f"_i_{key}").isNotNull()
    new_row = F.col(f"_c_{key}").isNull() & hit
    out = []
    for c in current.columns:
        inc_c = F.col(f"_i_{c}") if c in incoming.columns else F.lit(None)
        if c == key:
            out.append(F.coalesce(F.col(f"_c_{c}"), F.col(f"_i_{c}")).alias(c))
        elif c == "expires_at":
            out.append(F.when(hit, now_col + F.make_dt_interval(F.lit(ttl_days)))
                       .otherwise(F.col(f"_c_{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(hit, inc_c).otherwise(F.col(f"_c_{c}")).alias(c))
        else:
            given = F.coalesce(inc_c, now_col) if c == "created_at" else inc_c
            out.append(F.when(new_row, given).otherwise(F.col(f"_c_{c}")).alias(c))
    return j.select(*out)


def upsert_into(table: SnapshotTable, incoming: DataFrame, key: str, update_cols: list[str], now_col: Column, n_buckets: int,
                ttl_days: int = 1, order: str | None = None) -> int:
    """``upsert`` into a table of ``n_buckets`` buckets by key: only buckets that hold
    an incoming key are read and rewritten; the new version's number.  Rows without a
    key are left out, as a primary key allows none."""
    incoming = incoming.where(F.col(key).isNotNull())
    buckets = [str(r[0]) for r in incoming.select(by_bucket(key, n_buckets)).distinct().collect()]  # n_buckets at most
    return table.change(lambda parts: [b for b in buckets if b in parts],
                        lambda rows: upsert(rows, incoming, key, update_cols, now_col, ttl_days, order))


def dedupe_keep_last(df: DataFrame, group_cols: list[str], key: str, order_cols: list[str], n: int) -> DataFrame:
    """Within each group drop duplicate ``key`` values keeping the LAST row in
    ``order_cols`` order, then keep the first ``n`` rows (head(n)).

    "Last" is ``max_by`` on the order key (partial aggregation) and the head is
    a top-n per group (WindowGroupLimit), so no window ever numbers all rows
    of a group."""
    ok = F.struct(*[F.col(c) for c in order_cols])
    last = df.groupBy(*group_cols, key).agg(F.max(ok).alias("_ok"))
    w = Window.partitionBy(*group_cols).orderBy("_ok")
    return (last.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
            .select(*group_cols, key, *[F.col(f"_ok.{c}").alias(c) for c in order_cols]))


def _modular(p: int):
    """(x * y) mod p of two columns of numbers from 0 to p - 1, as a function."""
    def product(x: Column, y: Column) -> Column:
        if p < 3_000_000_000:  # then a product is a long
            return x * y % F.lit(p)
        return (x.cast("decimal(19,0)") * y.cast("decimal(19,0)") % F.lit(p)).cast("bigint")
    return product


def _drawn_numbers(users: DataFrame, meal_agg: DataFrame, recent: DataFrame, k: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(``users``' columns, ``_n``, ``slot``) of the drawn meals, and the (``meal_id``, ``_n``)
    of all meals; see ``sample_candidates``.

    A user's draw is made in the user's row and by numbers alone: the walk's places that
    hold a recently logged meal are known without a walk, (number - b) / a mod p, and of the
    own private meals the first k places go in.  So no row for each draw moves before the
    meals are looked up.  Users are dealt out before they become k rows each, as a task with
    many users would make all their draws."""
    from .ml import dense_index, uniform

    private = ~F.coalesce("is_public", F.lit(False))
    numbered = dense_index(meal_agg.select("meal_id", "user_id", private.alias("_private")), ["_private", "meal_id"], "_n")
    public = numbered.where(~F.col("_private")).select("meal_id", "_n")
    n = public.count()
    p = next(q for q in range(max(n, 2), 2 * max(n, 2) + 1) if all(q % d for d in range(2, int(q ** 0.5) + 1)))
    mul = _modular(p)
    own = exclude_recent_meals(numbered.where("_private").select("user_id", "meal_id", "_n"), recent)
    own = own.withColumn("_place", uniform(seed + 2, F.col("user_id"), F.col("meal_id")))
    first = Window.partitionBy("user_id").orderBy("_place", "meal_id")
    own = (own.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k)
           .groupBy("user_id").agg(F.collect_list(F.struct("_place", "meal_id", "_n")).alias("_own")))
    # counted apart, as a meal that is listed twice has two numbers
    logged = recent.groupBy("user_id").agg(F.count(F.lit(1)).alias("_logged"))
    skipped = recent.join(public, "meal_id").groupBy("user_id").agg(F.collect_list("_n").alias("_skip"))
    us = users.join(logged, "user_id", "left").join(skipped, "user_id", "left").join(own, "user_id", "left")
    # by a hash of the key: by the key itself, rows lie so already and stay in the few tasks that hold them
    dealt = us.repartition(int(users.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("user_id"))
    dealt = dealt.withColumns({"_a": F.pmod(F.xxhash64(F.lit(seed), F.col("user_id")), F.lit(p - 1)) + 1,
                               "_b": F.pmod(F.xxhash64(F.lit(seed + 1), F.col("user_id")), F.lit(p)),
                               "_draws": F.least(F.lit(p), F.coalesce("_logged", F.lit(0)) + F.lit(k + p - n))})
    power = F.aggregate(F.lit([int(x) for x in f"{p - 2:b}"]), F.lit(1).cast("bigint"), lambda acc, bit: F.when(
        bit == 1, mul(mul(acc, acc), F.col("_a"))).otherwise(mul(acc, acc)))  # a^(p - 2), which is 1 / a
    steps = F.sequence(F.lit(0).cast("bigint"), F.col("_draws") - 1)
    dealt = dealt.withColumn("_inverse", F.when(F.col("_skip").isNotNull(), power))
    left = F.when(F.col("_skip").isNotNull(), F.array_except(steps, F.transform(
        "_skip", lambda m: mul(F.pmod(m - F.col("_b"), F.lit(p)), F.col("_inverse"))))).otherwise(steps)
    nothing = F.lit(None).cast(dict(numbered.dtypes)["meal_id"])
    walk = F.transform(left, lambda j: F.struct(((j + 0.5) / F.lit(float(p))).alias("_place"), nothing.alias("meal_id"),
                                                ((mul(F.col("_a"), j) + F.col("_b")) % F.lit(p)).alias("_n")))
    dealt = dealt.withColumn("_drawn", F.slice(F.filter(walk, lambda s: s["_n"] < F.lit(n)), 1, k))
    both = F.when(F.col("_own").isNull(), F.col("_drawn")).otherwise(F.slice(F.sort_array(F.concat("_drawn", "_own")), 1, k))
    pairs = dealt.select(*users.columns, F.explode(F.transform(both, lambda s, i: F.struct(s["_n"].alias("_n"), (i + 1).alias("slot")))).alias("_s"))
    return pairs.select(*users.columns, "_s._n", "_s.slot"), numbered.select("meal_id", "_n")


def sample_candidates(users: DataFrame, meal_agg: DataFrame, recent: DataFrame, k: int = 200,
                      seed: int = 17) -> DataFrame:
    """Per user: up to k meals drawn without replacement from all meals that the
    user may see (public ones, and own private ones), less the recently logged
    ones, in a seeded order (the reference's ORDER BY RANDOM() LIMIT k).

    Public meals have dense numbers 0..n-1.  A user's draw j is the number
    (a j + b) mod p, with p the least prime of at least n and a, b from a hash of
    the user: a walk over all numbers that meets none twice.  So k draws, and as
    many more as the user logged recently or as p exceeds n, are enough for k
    meals, and no user meets the whole table.  Own private meals join the draw
    with hashed places.

    The draws move once, to the meals' table, which is the side that is held: size
    estimates leave out that users become k rows each, so these would be taken for
    small and go through the driver."""
    drawn, numbered = _drawn_numbers(users.select("user_id").distinct(), meal_agg, recent, k, seed)
    return drawn.join(numbered.hint("shuffle_hash"), "_n").select("user_id", "meal_id", "slot")


def pooled_meals(users: DataFrame, meal_agg: DataFrame, recent: DataFrame, k: int = 200,
                 goals: DataFrame | None = None, seed: int = 17) -> DataFrame:
    """Each user's drawn candidates (``sample_candidates``: public or own meals, less
    those recently logged) with the meals' nutrients; user_id is the user's, not the owner's.
    With ``goals`` the rows have their user's goals, which join the users and not each row."""
    us = users.select("user_id").distinct()
    drawn, numbered = _drawn_numbers(us if goals is None else with_goals(us, goals), meal_agg, recent, k, seed)
    named = numbered.join(meal_agg.drop("user_id"), "meal_id")
    return drawn.drop("slot").join(named.hint("shuffle_hash"), "_n").drop("_n")
