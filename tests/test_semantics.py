"""Unit semantics of the smaller operators (hand-written frames)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pantry import vocab
from pantry.functions import exprs as X
from pantry.operators import users as U
from pantry.operators import candidates as C
from pantry.operators import monitor as M
from pantry.operators import quality as Q
from pantry.operators import training as T


def test_parse_rule_forms():
    c = Q.parse_rule("avg(calories) between 200 and 800")
    assert (c.metric, c.column, c.op, c.lo, c.hi) == ("avg", "calories", "between", 200.0, 800.0)
    c = Q.parse_rule("row_count > 50000")
    assert (c.metric, c.op, c.lo) == ("row_count", ">", 50000.0)
    with pytest.raises(ValueError):
        Q.parse_rule("median(x) > 1")


def test_checks_by_slice_reports_empty_slice(spark):
    df = spark.createDataFrame([("train", 1), ("train", None), ("val", 0)], "split string, label int")
    checks = {s: [Q.parse_rule("row_count > 1"), Q.parse_rule("missing_count(label) = 0")]
              for s in ("train", "val", "test")}
    got = {(r.table_name, r.check_name): (r.actual, r.passed) for r in Q.run_checks_by(df, "split", checks).collect()}
    assert got[("train", "row_count > 1")] == (2.0, True)
    assert got[("train", "missing_count(label) = 0")] == (1.0, False)
    assert got[("test", "row_count > 1")] == (0.0, False)   # empty split still reported


def test_duplicate_count_counts_values(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,), (3,), (None,)], "recipe_id int")
    r = Q.run_checks(df, [Q.parse_rule("duplicate_count(recipe_id) = 0")], "t").first()
    assert r.actual == 2.0 and not r.passed


def test_upsert_semantics(spark):
    cur = spark.createDataFrame([(1, "a", 0.1, "v1", "keep1"), (2, "b", 0.2, "v1", "keep2")],
                                "id int, ref string, score double, ver string, other string") \
        .withColumn("expires_at", F.to_timestamp(F.lit("2024-01-02 00:00:00")))
    inc = spark.createDataFrame([(2, "B", 0.9, "v2"), (3, "C", 0.3, "v2")], "id int, ref string, score double, ver string")
    now = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    out = {r.id: r for r in C.upsert(cur, inc, "id", ["ref", "score", "ver"], now).collect()}
    assert (out[1].ref, out[1].other, str(out[1].expires_at)) == ("a", "keep1", "2024-01-02 00:00:00")
    assert (out[2].ref, out[2].score, out[2].other, str(out[2].expires_at)) == ("B", 0.9, "keep2", "2024-02-02 00:00:00")
    assert (out[3].ref, out[3].other) == ("C", None)


def test_histogram_quantile_interpolates(spark):
    df = spark.createDataFrame([(0.02,), (0.03,), (0.2,), (0.3,), (20.0,)], "latency_s double")
    b = M.bucket_counts(df, "latency_s", M.LATENCY_BUCKETS, [F.lit(1).alias("g")])
    # rank 0.5 * 5 = 2.5: cumulative counts reach 2 at le=0.1 and 3 at le=0.25,
    # so q = 0.1 + (0.25 - 0.1) * (2.5 - 2) / (3 - 2) = 0.175
    q50 = b.select(M.histogram_quantile(0.5, M.LATENCY_BUCKETS).alias("q")).first().q
    assert abs(q50 - 0.175) < 1e-12
    q99 = b.select(M.histogram_quantile(0.99, M.LATENCY_BUCKETS).alias("q")).first().q
    assert q99 == M.LATENCY_BUCKETS[-1]  # +Inf bucket -> last finite bound


def test_label_encode_unseen_and_null(spark):
    df = spark.createDataFrame([("train", "thai"), ("train", None), ("train", "greek"), ("test", "cuban"),
                                ("test", None)], "split string, cuisine string")
    enc = {(r.split, r.cuisine) for r in T.label_encode_column(df, "cuisine", F.col("split") == "train").collect()}
    # vocabulary sorted: greek=0, thai=1, unknown=2 ; unseen -> -1
    assert enc == {("train", 1.0), ("train", 2.0), ("train", 0.0), ("test", -1.0), ("test", 2.0)}


def test_feature_contract_order_and_defaults(spark):
    df = spark.createDataFrame([("italian", None, 5)], "cuisine string, rating int, minutes int")
    fc = T.feature_contract(df)
    assert fc.columns == vocab.FEATURE_COLUMNS
    r = fc.first()
    assert r.cuisine == 0.0 and r.rating == 0.0 and r.minutes == 5.0 and r.history_pc6 == 0.0


def test_manifest_independent_of_partitioning(spark):
    rows = [(u, r, f"2020-01-{1 + (u + r) % 28:02d} 00:00:00", r % 5, (u + r) % 2, "train" if u < 30 else "test")
            for u in range(40) for r in range(5)]
    df = spark.createDataFrame(rows, "user_id int, recipe_id int, d string, rating int, label int, split string") \
        .withColumn("date", F.to_timestamp("d")).drop("d")
    a = T.dataset_manifest_tagged(df.repartition(1)).orderBy("split").collect()
    b = T.dataset_manifest_tagged(df.repartition(7, "recipe_id")).orderBy("split").collect()
    assert [tuple(x) for x in a] == [tuple(x) for x in b]


def test_sample_candidates_bounds(spark):
    from conftest import SF_SMALL
    from pantry.sources.fixtures import Catalog
    cat = Catalog(spark, SF_SMALL)
    meals = C.meal_nutrients(cat.meals, cat.meal_foods, cat.food_variants)
    recent = C.recently_logged(cat.meals.select("user_id", F.col("id").alias("meal_template_id"), "entry_date"), 30)
    s = C.sample_candidates(cat.contexts.select("user_id"), meals, recent, k=20)
    per = s.groupBy("user_id").agg(F.count(F.lit(1)).alias("c"), F.countDistinct("meal_id").alias("d"))
    assert per.filter((F.col("c") > 20) | (F.col("c") != F.col("d"))).count() == 0
    # visibility: every candidate is public or owned by the user; none recently logged
    j = s.join(meals.select("meal_id", F.col("user_id").alias("owner"), "is_public"), "meal_id")
    assert j.filter(~F.col("is_public") & (F.col("owner") != F.col("user_id"))).count() == 0
    assert s.join(recent, ["user_id", "meal_id"]).count() == 0
    # no one gets fewer than k while more are visible
    public = meals.filter("is_public").select("meal_id")
    visible = s.select("user_id").distinct().crossJoin(public).join(recent, ["user_id", "meal_id"], "left_anti").groupBy("user_id").count()
    short = per.join(visible, "user_id").filter(F.col("c") < F.least(F.lit(20), F.col("count")))
    assert short.count() == 0
    again = C.sample_candidates(cat.contexts.select("user_id"), meals, recent, k=20)
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, again.collect()))


def test_rule_candidates_equal_brute_force(spark):
    req = spark.createDataFrame([(1, 600, 60, True, False, False), (2, 300, 20, False, True, True)],
                                "request_id int, calorie_target int, time_limit int, no_milk boolean, "
                                "no_egg boolean, no_wheat boolean")
    rec = spark.createDataFrame([(10 + k, float(150 + 37 * k % 800), k % 70, k % 2, k % 3 == 0, k % 5 == 0)
                                 for k in range(300)],
                                "recipe_id int, calories double, minutes int, has_milk int, has_egg boolean, "
                                "has_wheat boolean").withColumn("has_egg", F.col("has_egg").cast("int")) \
        .withColumn("has_wheat", F.col("has_wheat").cast("int"))
    a = C.rule_candidates(req, rec).select("request_id", "recipe_id")
    # brute force
    r = rec.collect()
    exp = sorted((q.request_id, x.recipe_id) for q in req.collect() for x in r
                 if 0.5 * q.calorie_target <= x.calories <= 1.5 * q.calorie_target and x.minutes <= q.time_limit
                 and not (q.no_milk and x.has_milk == 1) and not (q.no_egg and x.has_egg == 1)
                 and not (q.no_wheat and x.has_wheat == 1))
    assert sorted(map(tuple, a.collect())) == exp


def test_vocabulary_index(spark):
    v = spark.createDataFrame([(f"w{k:04d}",) for k in range(300)], "_v string")
    a = sorted(map(tuple, T._index_vocabulary(v).collect()))
    assert a[0] == ("w0000", 0.0) and a[-1] == ("w0299", 299.0)


def test_manifest_sees_every_column(spark):
    rows = [("train", 1, 10, dt.datetime(2020, 1, 1), 1, 100.0, ["a"]), ("test", 2, 10, dt.datetime(2020, 1, 2), 0, 5.0, ["b"])]
    kind = "split string, user_id int, recipe_id int, date timestamp, label int, calories double, tags array<string>"
    a = T.dataset_manifest_tagged(spark.createDataFrame(rows, kind)).first()["version"]
    for at, value in ((5, 999.0), (6, ["c"]), (4, 0)):
        changed = [tuple(value if i == at else v for i, v in enumerate(rows[0])), rows[1]]
        assert T.dataset_manifest_tagged(spark.createDataFrame(changed, kind)).first()["version"] != a


def test_time_split_puts_undated_rows_last(spark):
    rows = [(dt.datetime(2020, 1, 1 + i % 20), i) for i in range(80)] + [(None, 80 + i) for i in range(20)]
    df = spark.createDataFrame(rows, "date timestamp, k int")
    for method in ("sort", "buckets"):
        out = T.time_split(df, ["date", "k"], method=method).collect()
        n = {s: sum(r["split"] == s for r in out) for s in ("train", "val", "test")}
        assert n == {"train": 80, "val": 10, "test": 10}
        assert all(r["date"] is not None for r in out if r["split"] == "train")


def test_lists_as_python_writes_them(spark):
    given = ["['a\\xa0b','vegan']", "['caf\\xe9']", "('a','b')", "['a',]", "[]", None, "[\"it's\", 'b']", "nonsense"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string")
    got = {r["i"]: list(r["x"]) for r in df.select("i", X.parse_string_list("t").alias("x")).collect()}
    assert [got[i] for i in range(8)] == [["a\xa0b", "vegan"], ["caf\xe9"], ["a", "b"], ["a"], [], [], ["it's", "b"], []]


def test_nan_is_no_rating_and_no_feature(spark):
    df = spark.createDataFrame([(float("nan"), "nan"), (5.0, "7"), (None, None)], "rating double, minutes string")
    assert [r[0] for r in df.select(X.label_from_rating("rating")).collect()] == [0, 1, 0]
    assert [r["minutes"] for r in T.feature_contract(df, ["minutes"]).collect()] == [0.0, 7.0, 0.0]


def test_products_with_units_and_quoted_numbers(spark):
    doc = ('{"product_name": "x", "product_name_en": "", "brands": "b, c", "serving_quantity": "50", '
           '"nutriments": {"energy-kcal_100g": "200", "energy-kcal_unit": "kcal", "proteins_100g": 10}}')
    r = C.product_normalise(spark.createDataFrame([("1", doc)], "code string, doc string")).first()
    assert (r["name"], r["brand"], r["serving_size"], r["calories"], r["protein"]) == ("x", "b", 50.0, 100.0, 5.0)


def test_users_without_goals_and_requests_without_limits(spark):
    meals = spark.createDataFrame([(1, i, f"m{i}", True, 3, *[float(10 * i)] * 8) for i in range(15)], (
        "user_id int, meal_id int, meal_name string, is_public boolean, n_ingredients int, calories double, protein double, carbs double, "
        "fat double, saturated_fat double, sugars double, sodium double, dietary_fiber double"))
    goals = spark.createDataFrame([], "user_id int, calories double, protein double, carbs double, fat double")
    ranked = C.fallback_rank(meals, goals, 10)
    assert ranked.count() == 10 and C.meal_feature_vector(meals, goals).count() == 15
    assert "WindowGroupLimit" in ranked._jdf.queryExecution().executedPlan().toString()
    req = spark.createDataFrame([(1, None, None, False, False, False)], (
        "request_id int, calorie_target int, time_limit int, no_milk boolean, no_egg boolean, no_wheat boolean"))
    rec = spark.createDataFrame([(1, 300.0, 120, 0, 0, 0), (2, 901.0, 10, 0, 0, 0), (3, 600.0, 121, 0, 0, 0)], (
        "recipe_id int, calories double, minutes int, has_milk int, has_egg int, has_wheat int"))
    assert [r["recipe_id"] for r in C.rule_candidates(req, rec).collect()] == [1]


def test_upsert_takes_one_of_equal_keys(spark):
    cur = spark.createDataFrame([(1, "old")], "id int, v string")
    inc = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c")], "id int, v string")
    got = sorted(map(tuple, C.upsert(cur, inc, "id", ["v"], F.current_timestamp()).collect()))
    assert got == [(1, "b"), (2, "c")]


def test_csv_files_with_columns_in_different_order(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    from pantry.sources import io as IO
    (tmp_path / "a.csv").write_text("user_id,Recipe_ID,name\n1,10,x\n")
    (tmp_path / "b.csv").write_text('id,user_id,name\n20,2,"two\nlines"\n')
    schema = StructType([StructField("user_id", IntegerType()), StructField("recipe_id", IntegerType()), StructField("name", StringType())])
    got = sorted(map(tuple, IO.read_csv(spark, str(tmp_path), schema, rename={"id": "recipe_id"}).collect()))
    assert got == [(1, 10, "x"), (2, 20, "two\nlines")]


def test_duplicate_count_on_slices(spark):
    df = spark.createDataFrame([("train", 1), ("train", 1), ("train", None), ("train", None), ("val", 2)], "split string, k int")
    checks = {s: [Q.parse_rule("duplicate_count(k) = 0")] for s in ("train", "val", "test")}
    got = {r["table_name"]: (r["actual"], r["passed"]) for r in Q.run_checks_by(df, "split", checks).collect()}
    assert got == {"train": (1.0, False), "val": (0.0, True), "test": (0.0, True)}


def test_zero_variance_of_every_split(spark):
    df = spark.createDataFrame([("train", 1, 1.0), ("train", 2, 2.0), ("val", 5, 1.0), ("val", 5, 2.0), ("test", 3, None), ("test", 4, None)],
                               "split string, k int, x double")
    got = {(r["split"], r["column_name"]): r["zero_variance"] for r in Q.zero_variance_by(df, ["k", "x"]).collect()}
    assert got == {(s, c): (s, c) == ("val", "k") for s in ("train", "val", "test") for c in ("k", "x")}


def test_zero_variance_splits_agrees_with_its_oracle(spark):
    import duckdb

    import __spark_entry__ as E
    from conftest import SF_SMALL
    from pantry.sources.tables import BASE_TABLES
    from tools.oracle_check import norm
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cols = ["split", "column_name", "std", "zero_variance"]
    got = [[norm(x) for x in r] for r in E.queries()["dq_zero_variance_splits"](spark, SF_SMALL).select(*cols).collect()]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({E.oracle_sql()['dq_zero_variance_splits']})").fetchall()
    assert {r[0] for r in want} == {"train", "val", "test"}
    assert sorted(map(repr, got)) == sorted(repr([norm(x) for x in r]) for r in want)


def test_pool_holds_public_and_own_meals(spark):
    """Where k is larger than the pool, the draw is all that brute force sees."""
    rows = [(1 + i % 3, i, f"m{i}", i % 4 != 0, 2, *[float(7 * i % 50)] * 8) for i in range(24)]
    meals = spark.createDataFrame(rows, (
        "user_id int, meal_id int, meal_name string, is_public boolean, n_ingredients int, calories double, protein double, carbs double, "
        "fat double, saturated_fat double, sugars double, sodium double, dietary_fiber double"))
    goals = spark.createDataFrame([(1, 2000.0, 100.0, 250.0, 65.0)], "user_id int, calories double, protein double, carbs double, fat double")
    recent = {(1, 1), (9, 2), (9, 3)}
    users = spark.createDataFrame([(1,), (2,), (9,)], "user_id int")  # 9 has no meal of its own
    pool = C.pooled_meals(users, meals, spark.createDataFrame(sorted(recent), "user_id int, meal_id int")).localCheckpoint()
    seen = {(u, r[1]) for u in (1, 2, 9) for r in rows if (r[3] or r[0] == u) and (u, r[1]) not in recent}
    got = [(r["user_id"], r["meal_id"]) for r in pool.collect()]
    assert set(got) == seen and len(got) == len(seen)
    protein = {r[1]: r[6] for r in rows}
    want = {}
    for u in (1, 2, 9):
        goal = 100.0 if u == 1 else 50.0
        order = sorted((m for x, m in seen if x == u), key=lambda m: (abs(protein[m] - goal * 0.3), m))
        want |= {(u, m): (i + 1, round(max(0.0, 1 - i / len(order[:10])), 6)) for i, m in enumerate(order[:10])}
    ranked = C.fallback_rank(pool, goals, 10).collect()
    assert {(r["user_id"], r["meal_id"]): (r["rank"], round(r["score"], 6)) for r in ranked} == want


def test_draws_do_not_go_through_the_driver(spark):
    """The draws are k rows a user, which size estimates of the users don't show."""
    rows = [(i % 50, i, f"m{i}", i % 4 != 0, 1, *[1.0] * 8) for i in range(400)]
    meals = spark.createDataFrame(rows, (
        "user_id int, meal_id int, meal_name string, is_public boolean, n_ingredients int, calories double, protein double, carbs double, "
        "fat double, saturated_fat double, sugars double, sodium double, dietary_fiber double"))
    recent = spark.createDataFrame([(1, 1)], "user_id int, meal_id int")
    drawn = C.sample_candidates(spark.range(50).select(F.col("id").cast("int").alias("user_id")), meals, recent, k=100)
    assert drawn.count() == 50 * 100 and drawn.collect()
    lines = drawn._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    depth = [len(x) - len(x.lstrip(" :+-*|")) for x in lines]
    for i, x in enumerate(lines):
        if "BroadcastExchange" in x:
            below = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            assert not any("Generate" in y for y in lines[i:below])
    generate = next(i for i, x in enumerate(lines) if "Generate explode" in x)
    assert any("xxhash64" in x and "Exchange hashpartitioning" in x for x in lines[generate:])  # users are dealt out before


def test_pool_queries_reach_other_users_meals(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    from pantry.sources.fixtures import Catalog
    cat = Catalog(spark, SF_SMALL)
    own = {r["id"]: (r["user_id"], r["is_public"]) for r in cat.meals.select("id", "user_id", "is_public").collect()}
    asking = {r[0] for r in cat.contexts.select("user_id").distinct().collect()} - {None}
    pairs = None
    for name in ("recommendation_reason_pool", "meal_feature_vector_pool", "fallback_rank_pool"):
        out = {(r["user_id"], r["meal_id"]) for r in E.queries()[name](spark, SF_SMALL).select("user_id", "meal_id").collect()}
        assert asking <= {u for u, _ in out}
        assert any(own[m][0] != u for u, m in out) and all(own[m][0] == u or own[m][1] for u, m in out)
        assert pairs is None or out <= pairs
        pairs = pairs or out


def test_rule_candidates_know_all_allergens(spark):
    from pantry import vocab
    names = vocab.ALLERGENS_SORTED
    assert len(names) == 9
    kinds = ", ".join(f"has_{a} int" for a in names)
    rec = spark.createDataFrame([(m, 600.0, 10, *[m >> i & 1 for i in range(9)]) for m in range(512)], f"recipe_id int, calories double, minutes int, {kinds}")
    asked = [0, 1, 256, 511, 0b101010101]
    req = spark.createDataFrame([(q, 600, 60, *[None if not q >> i & 1 and i % 2 else bool(q >> i & 1) for i in range(9)]) for q in asked],
                                "request_id int, calorie_target int, time_limit int, " + ", ".join(f"no_{a} boolean" for a in names))
    got = sorted((r["request_id"], r["recipe_id"]) for r in C.rule_candidates(req, rec).collect())
    assert got == sorted((q, m) for q in asked for m in range(512) if not q & m)


def test_candidate_features_take_each_requests_meal_and_time(spark):
    cands = spark.createDataFrame([(1, 7, "italian", "lunch", "morning"), (2, 7, "thai", None, None), (3, 8, None, "brunch", "noon")],
                                  "request_id int, user_id int, cuisine string, meal_type string, time_of_day string")
    users = spark.createDataFrame([(7, 1800.0)], "user_id int, daily_calorie_target double")
    got = {r["request_id"]: r for r in C.candidate_features(cands, users).collect()}
    assert [(got[i]["meal_lunch"], got[i]["meal_dinner"], got[i]["time_morning"], got[i]["time_evening"]) for i in (1, 2, 3)] == [
        (1, 0, 1, 0), (0, 1, 0, 1), (0, 0, 0, 0)]
    assert got[3]["daily_calorie_target"] == 2000.0 and got[1]["cuisine_italian"] == 1 and got[3]["cuisine_italian"] == 0
    assert C.candidate_features(cands.drop("meal_type", "time_of_day"), users).where("meal_dinner = 1 and time_evening = 1").count() == 3


def test_user_feature_lookup_gives_all_sixteen(spark):
    from pantry import vocab
    targets, pcs = [t for _, t in U.TARGETS], [f"history_pc{i}" for i in range(1, 7)]
    cached = spark.createDataFrame([(1, 1.0, None, 3.0, 4.0, *[1] * 6, *[0.5, None, 0.25, 0.0, 0.0, -1.0])],
                                   "user_id int, " + ", ".join([f"{t} double" for t in targets] + [f"{d} int" for d in vocab.DIET_TAGS] + [f"{p} double" for p in pcs]))
    recent = spark.createDataFrame([(1, 9.0, 9.0, 9.0, 9.0), (2, 5.0, 6.0, 7.0, 8.0)], "user_id int, " + ", ".join(f"{t} double" for t in targets))
    got = {r["user_id"]: r for r in U.user_feature_lookup(spark.createDataFrame([(1,), (2,), (3,)], "user_id int"), cached, recent).collect()}
    assert len(got[1]) == 18 and got[1]["source"] == "cache" and got[1][targets[1]] is None and got[1]["history_pc6"] == -1.0 and got[1]["user_vegan"] == 1
    assert got[2]["source"] == "history" and [got[2][t] for t in targets] == [5.0, 6.0, 7.0, 8.0]
    assert got[3]["source"] == "default" and [got[3][t] for t in targets] == [2000.0, 50.0, 275.0, 65.0]
    assert all(got[u][c] == 0 for u in (2, 3) for c in [*vocab.DIET_TAGS, *pcs])


def test_collisions_are_reported(spark):
    frame = spark.createDataFrame([(f"id{i}",) for i in range(400)] + [("id1",), (None,)], "id string")
    found = X.id_collisions(frame, "id", bits=8).collect()
    assert sum(r["n_ids"] for r in found) > 200 and all(r["n_ids"] > 1 and r["first_id"] < r["last_id"] for r in found)
    assert X.id_collisions(frame, "id").collect() == []


def test_pool_rows_move_once(spark):
    """A user's draw is made in the user's row and brings the goals along: the rows of the
    pool go to the meals' table and nowhere else, whatever their number."""
    rows = [(i % 50, i, f"m{i}", i % 4 != 0, 1, *[float(i)] * 8) for i in range(400)]
    meals = spark.createDataFrame(rows, (
        "user_id int, meal_id int, meal_name string, is_public boolean, n_ingredients int, calories double, protein double, carbs double, "
        "fat double, saturated_fat double, sugars double, sodium double, dietary_fiber double"))
    recent = spark.createDataFrame([(u, m) for u in range(50) for m in range(u, 400, 7)], "user_id int, meal_id int")
    users = spark.range(60).select(F.col("id").cast("int").alias("user_id"))
    goals = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 4.0)], "user_id int, calories double, protein double, carbs double, fat double")
    pool = C.pooled_meals(users, meals, recent, k=30, goals=goals)
    got = pool.collect()
    assert len(got) == 60 * 30 and len({(r["user_id"], r["meal_id"]) for r in got}) == 60 * 30
    assert not {(r["user_id"], r["meal_id"]) for r in got} & {tuple(r) for r in recent.collect()}
    assert all(rows[r["meal_id"]][3] or rows[r["meal_id"]][0] == r["user_id"] for r in got)
    plain = C.pooled_meals(users, meals, recent, k=30)
    for f in (C.with_goals, C.meal_feature_vector, C.fallback_rank):
        assert sorted(map(str, f(pool, None).collect())) == sorted(str(r) for r in f(plain, goals).select(f(pool, None).columns).collect())
    for f, moves in ((C.with_goals, 1), (C.meal_feature_vector, 1), (C.fallback_rank, 2)):
        lines = f(pool, None)._jdf.queryExecution().executedPlan().toString().splitlines()
        depth = [len(x) - len(x.lstrip(" :+-*|")) for x in lines]
        i = next(i for i, x in enumerate(lines) if "Generate explode" in x)
        above = [x for j, x in enumerate(lines[:i]) if depth[j] < depth[i] and all(depth[j] < d for d in depth[j + 1:i + 1])]
        assert sum("Exchange" in x for x in above) == moves


def test_walks_over_many_numbers_do_not_overflow(spark):
    p = 9_007_199_254_740_881
    got = spark.range(1).select(C._modular(p)(F.lit(p - 2), F.lit(p - 3)).alias("x"), C._modular(97)(F.lit(95), F.lit(94)).alias("y")).first()
    assert tuple(got) == (6, 6)


def test_pairs_do_not_move_for_features(spark):
    """Requests and recipes have their features before they meet, and many recipes meet in
    blocks: the pairs and their features are the same, and no exchange lies above the pairs' join."""
    from pantry.functions import exprs as X
    req = spark.createDataFrame([(i, i % 5 or None, 300 + i, 5 + i % 20, i % 2 == 0, "lunch" if i % 3 else None, None) for i in range(40)], (
        "request_id int, user_id int, calorie_target int, time_limit int, no_milk boolean, meal_type string, time_of_day string"))
    rec = spark.createDataFrame([(k, 100.0 + 13.1 * k % 700 if k % 9 else None, k % 25, k % 2, "italian" if k % 4 else None, float("nan") if k % 7 else k / 3)
                                 for k in range(90)], "recipe_id int, calories double, minutes int, has_milk int, cuisine string, protein_g double")
    users = spark.createDataFrame([(1, 1500.0, 1), (2, None, 0)], "user_id int, daily_calorie_target double, user_vegan int")
    old = C.candidate_features(C.rule_candidates(req, rec), users)
    parts = rec.withColumns(X.whole_parts(rec, "protein_g") | X.whole_parts(rec, "minutes"))
    new = C.candidate_features(C.rule_candidates(C.request_features(req, users), C.cuisine_one_hots(parts), block_rows=4), None)
    assert old.count() > 100 and sorted(map(str, old.collect())) == sorted(map(str, new.select(old.columns).collect()))
    sums = new.groupBy("request_id").agg(X.sum_of_parts(new, "protein_g").alias("a"), F.sum(F.col("protein_g").cast("decimal(28,8)")).alias("b"),
                                         X.sum_of_parts(new, "minutes").alias("c"), F.sum("minutes").alias("d"))
    assert sums.where("a = b and c = d").count() == sums.count() > 0
    lines = new._jdf.queryExecution().executedPlan().toString().splitlines()
    assert "SortMergeJoin" in "".join(lines)
    assert not any("Exchange" in x for x in lines[:next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)])


def test_parts_keep_large_and_negative_numbers_exact(spark):
    from pantry.functions import exprs as X
    df = spark.createDataFrame([(1e17,), (-3.5,), (0.12345678,), (-1e-8,), (None,), (float("nan"),), (123456789.987654,)], "v double")
    both = df.withColumns(X.whole_parts(df, "v"))
    got = both.agg(X.sum_of_parts(both, "v"), F.sum(F.coalesce(F.nanvl("v", F.lit(None)), F.lit(0.0)).cast("decimal(28,8)"))).first()
    assert got[0] == got[1]
