"""Scalar expressions and the traps listed in SURVEY 7.3."""

from pyspark.sql import functions as F

from pantry.functions import exprs as X
from pantry.operators import candidates as C
from pantry.operators import enrich as E


def test_parse_lists_and_cuisine(spark):
    df = spark.createDataFrame(
        [(1, "['Mexican', 'vegan']"), (2, "garbage"), (3, None), (4, "['60-minutes-or-less', 'thai']"),
         (5, '["baker\'s flour", \'salt\']')], "id int, tags string")
    out = {r.id: r for r in df.select("id", X.parse_string_list("tags").alias("t"),
                                      X.cuisine_first_match(X.parse_string_list("tags")).alias("c")).collect()}
    assert out[1].t == ["Mexican", "vegan"] and out[1].c == "mexican"
    assert out[2].t == [] and out[2].c == "unknown"
    assert out[3].t == [] and out[3].c == "unknown"
    assert out[4].c == "thai"  # first *mapped* tag wins
    assert out[5].t == ["baker's flour", "salt"]


def test_allergen_substring_semantics(spark):
    df = spark.createDataFrame([(["eggplant"],), (["peanut butter"],), (["rice"],)], "ingredients array<string>")
    r = df.select(X.allergen_flag("ingredients", "egg").alias("egg"), X.allergen_flag("ingredients", "milk").alias("milk"),
                  X.allergen_flag("ingredients", "peanut").alias("peanut")).collect()
    assert r[0].egg == 1          # "egg" is a substring of "eggplant"
    assert r[1].milk == 1         # "butter" sets milk
    assert r[1].peanut == 1
    assert (r[2].egg, r[2].milk) == (0, 0)


def test_nutrition_short_list_is_null(spark):
    df = spark.createDataFrame([(1, "[1.0, 2.0]"), (2, "[100.0, 10.0, 20.0, 30.0, 40.0, 50.0, 60.0]"),
                                (3, "[1, None, 3, 4, 5, 6, 7]")], "recipe_id int, nutrition string")
    out = {r.recipe_id: r for r in E.nutrition_macros(df).collect()}
    assert out[1].calories is None and out[1].sodium_g is None
    assert out[2].calories == 100.0 and abs(out[2].sodium_g - 30.0 / 100 * 2300) < 1e-9
    assert out[3].calories == 1.0 and out[3].total_fat is None


def test_label_null_rating_is_negative(spark):
    df = spark.createDataFrame([(None,), (4,), (3,), (5,)], "rating int")
    assert [r.l for r in df.select(X.label_from_rating("rating").alias("l")).collect()] == [0, 1, 0, 1]


def test_stable_id_matches_sha256_prefix(spark):
    import hashlib
    v = "meal-123"
    expect = int.from_bytes(hashlib.sha256(v.encode()).digest()[:4], "big") & 0x7FFFFFFF
    got = spark.createDataFrame([(v,)], "s string").select(X.stable_id("s").alias("h")).first().h
    assert got == expect


def test_half_up_rounding_is_ieee(spark):
    df = spark.createDataFrame([(0.0050375,), (2.5,), (-2.5,), (1.23456789,)], "x double")
    got = [r.r for r in df.select(X.rnd("x", 6).alias("r")).collect()]
    import math
    assert got == [math.floor(v * 1e6 + 0.5) / 1e6 for v in (0.0050375, 2.5, -2.5, 1.23456789)]


def test_latest_per_key_postgres_null_order(spark):
    df = spark.createDataFrame([(1, None, 5, "a"), (1, 3, 9, "b"), (2, 1, 1, "c"), (2, 2, 0, "d")],
                               "k int, updated_at int, created_at int, v string")
    out = {r.k: r.v for r in C.latest_per_key(df, "k", ["updated_at", "created_at"], ["v"]).collect()}
    assert out == {1: "a", 2: "d"}  # DESC puts NULL first, as PostgreSQL does


def test_meal_context_bounds(spark):
    df = spark.createDataFrame([("2024-01-01 05:00:00",), ("2024-01-01 09:59:00",), ("2024-01-01 10:00:00",),
                                ("2024-01-01 14:00:00",), ("2024-01-01 21:30:00",), ("2024-01-01 22:00:00",)], "t string")
    got = [r.m for r in df.select(X.meal_context(F.to_timestamp("t")).alias("m")).collect()]
    assert got == ["breakfast", "breakfast", "lunch", "snack", "dinner", "snack"]
