"""What travels with each interaction, and how digests are summed."""

from pyspark.sql import functions as F

from pantry import vocab
from pantry.operators import manifest as M
from pantry.operators import users as U

RECIPE = "recipe_id long, calories double, protein_g double, carbohydrate_g double, total_fat_g double, cuisine string, tags array<string>"


def history(spark):
    recipes = spark.createDataFrame([(1, 100.0, 1.0, 1.0, 1.0, "thai", ["Vegan", "low-fat"]), (2, None, None, None, None, "greek", None),
                                     (None, 5.0, 5.0, 5.0, 5.0, "thai", ["vegan"]), (3, 7.0, 7.0, 7.0, 7.0, "thai", ["vegan"]), (3, 9.0, 9.0, 9.0, 9.0, "thai", [])], RECIPE)
    rows = [(u, r, y) for u in (1, 2, None) for r, y in [(1, 1)] * 4 + [(2, 1), (3, 0), (9, 1), (None, 1)]] + [(5, 1, 0)] * 9 + [(6, 2, 1)] * 9
    return spark.createDataFrame(rows, "user_id long, recipe_id long, label int"), recipes


def test_tags_are_read_once_for_each_recipe(spark):
    inter, recipes = history(spark)
    got = U.derive_user_features(inter, recipes, with_pca=False)
    lists = U.join_history(U.semi_valid_recipes(inter, recipes), recipes)
    old = U.user_aggregates(lists).filter("_n_pos > 0 AND _n_all >= 5").select(*got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, old.collect()))
    flags = {r["user_id"]: r for r in got.collect()}
    assert flags[1]["user_vegan"] == 1 and flags[6]["user_vegan"] == 0 and 5 not in flags
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    aggregate = plan.split("Join Inner")[0]
    assert "Join Inner" in plan and "exists" not in aggregate and "LeftSemi" not in plan
    assert set(vocab.DIET_TAGS) <= set(U.marked_recipes(recipes).columns)


def test_digests_are_summed_as_longs(spark):
    big = (1 << 60) - 1
    df = spark.createDataFrame([(i % 2, big - i) for i in range(1001)], "g int, d long")
    got = {r["g"]: r["s"] for r in df.groupBy("g").agg(M.digest_sum("d").alias("s")).collect()}
    assert got == {g: str(sum(big - i for i in range(1001) if i % 2 == g)) for g in (0, 1)}
    rows = spark.createDataFrame([(1, 2, "a|b", 0.1, "train"), (1, 2, None, None, "train")], "user_id long, recipe_id long, t string, x double, split string")
    text = M.row_text(sorted((c, t) for c, t in rows.dtypes if c != "split"))
    wide = rows.agg(F.sum(F.expr(f"CAST(conv(substr(md5({text}), 1, 15), 16, 10) AS DECIMAL(38,0))")).cast("string")).first()[0]
    told = M.bucket_digests(rows, ["user_id", "recipe_id"])
    assert [r["digest"] for r in told.collect()] == [wide]
    sums = told._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(38,0))) AS _" not in sums and "sum(cast(conv" not in sums.lower()
