"""Manifests as trees: any changed value shows, and verifying names the bucket or block."""

import datetime as dt
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from pantry.operators import manifest as M
from pantry.operators import training as T
from pantry.plans import jobs
from pantry.sources import io as IO
from pantry.sources import raw as RAW
from pantry.sources import snapshots as S

KIND = "split string, user_id int, recipe_id int, date timestamp, label int, x double, a string, b string, l array<string>"


def rows():
    rng = random.Random(1)
    return [(["train", "val", "test"][i % 3], i % 37, i, dt.datetime(2020, 1, 1 + i % 20), i % 2, rng.random(), f"a{i}", "b|c", ["x"]) for i in range(200)]


def version(spark, data):
    return T.dataset_manifest_tagged(spark.createDataFrame(data, KIND)).first()["version"]


def test_any_changed_value_shows(spark):
    base = rows()
    one = list(base[5])
    pairs = [((1.0, "a|b", "c"), (math.nextafter(1.0, 2), "a|b", "c")), ((1.0, "a|b", "c"), (1.0, "a", "b|c")),
             ((None, "\\N", ""), (None, None, "")), ((None, "", None), (None, None, "")), ((1.0, "a\\", "b"), (1.0, "a", "\\b")), ((1.0, "~", ""), (1.0, None, "")), ((1.0, "\\p", ""), (1.0, "|", "")), ((1.0, "\\t", ""), (1.0, "~", "")),
             ((9e12, "", ""), (9e12 + 0.001953125, "", "")), ((0.0, "", ""), (5e-324, "", "")), ((math.nan, "", ""), (None, "", "")),
             ((math.inf, "", ""), (-math.inf, "", "")), ((1e300, "~", ""), (1e300, "~", None))]
    for left, right in pairs:
        got = [version(spark, [*base[:5], tuple(one[:5] + list(v) + one[8:]), *base[6:]]) for v in (left, right)]
        assert got[0] != got[1], (left, right)
    assert version(spark, base) == version(spark, random.Random(2).sample(base, len(base)))
    renamed = spark.createDataFrame(base, KIND).withColumnRenamed("a", "c")
    assert T.dataset_manifest_tagged(renamed).first()["version"] != version(spark, base)


def test_texts_of_doubles_are_exact(spark):
    rng = random.Random(3)
    values = [struct.unpack("d", rng.randbytes(8))[0] for _ in range(3000)] + [2.0 ** e for e in range(-1074, 1024, 3)]
    values += [math.nextafter(2.0 ** e, 0) for e in range(-1022, 1024, 7)] + [0.1, 1 / 3, -2.5]
    values = sorted({v for v in values if math.isfinite(v) and v})
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", F.expr(M.value_text("x", "double")).alias("t")).collect()
    assert all(float(r["t"]) == r["x"] for r in got) and len({r["t"] for r in got}) == len(values)


def test_verify_names_the_bucket_and_reads_it_alone(spark, tmp_path):
    keys, n = ("user_id", "recipe_id"), 16
    frame = spark.createDataFrame(rows(), KIND)
    table = S.SnapshotTable(spark, str(tmp_path / "t"), frame.schema, M.bucket_of(frame, keys, n))
    table.append_new(frame)
    recorded = M.bucket_digests(table.read(), keys, n)
    assert M.changed_buckets(recorded, M.bucket_digests(frame.repartition(5), keys, n)).collect() == []
    recorded = IO.materialize(recorded, "recorded")
    hit = frame.where("recipe_id = 77").select(M.bucket_of(frame, keys, n)).first()[0]
    one = (F.col("recipe_id") == 77)
    table.change(lambda parts: [str(hit)], lambda part: part.withColumn("x", F.when(one, F.col("x") + 1e-9).otherwise(F.col("x"))))
    found = M.changed_buckets(recorded, M.bucket_digests(table.read(), keys, n)).collect()
    assert [(r["split"], r["bucket"]) for r in found] == [(rows()[77][0], hit)]
    old, new = (table.read([str(hit)], v) for v in (1, 2))
    assert all(f"__part={hit}/" in f for f in new.inputFiles() + old.inputFiles())
    diff = M.changed_rows(old, new).collect()
    assert sorted((r["recipe_id"], r["side"], r["n"]) for r in diff) == [(77, "found", 1), (77, "recorded", 1)]


def test_manifest_of_nothing_and_one_split(spark):
    assert T.dataset_manifest_tagged(spark.createDataFrame([], KIND)).collect() == []
    got = T.dataset_manifest({"train": spark.createDataFrame(rows(), KIND).drop("split")}).collect()
    assert [(r["split"], r["rows"], r["label_mean"]) for r in got] == [("train", 200, 0.5)]


RECIPES = 'Name,ID,minutes,tags\n"soup, ""hot""",1,10,"[\'a\',\n\'b\']"\nbread,2,x,\n'
INTERACTIONS = "user_id,recipe_id,date,rating\n7,1,2020-01-01,5\n8,2,2020-01-02,\n"


def test_ingest_stops_and_verifies(spark, tmp_path):
    paths = {"recipes": str(tmp_path / "raw recipes.csv"), "interactions": str(tmp_path / "inter.csv")}
    (tmp_path / "raw recipes.csv").write_text(RECIPES)
    (tmp_path / "inter.csv").write_text(INTERACTIONS)
    done = jobs.ingest(spark, paths, str(tmp_path / "out"))
    got = IO.resolve_latest(spark, done["root"], "recipes").orderBy("recipe_id").collect()
    assert [(r["recipe_id"], r["name"], r["minutes"], r["tags"]) for r in got] == [(1, 'soup, "hot"', 10, "['a',\n'b']"), (2, "bread", None, None)]
    assert IO.resolve_latest(spark, done["root"], "interactions").count() == 2
    assert jobs.verify_ingest(spark, paths, done["root"]).collect() == []
    (tmp_path / "inter.csv").write_text(INTERACTIONS.replace("8,2", "8,1"))
    assert [r["file"].endswith("inter.csv") for r in jobs.verify_ingest(spark, paths, done["root"]).collect()] == [True]
    for recipes, inter, said in ((RECIPES + "twice,1,3,\n", INTERACTIONS, "occur twice"), (RECIPES + "none,,3,\n", INTERACTIONS, "without recipe_id"),
                                 (RECIPES, INTERACTIONS + ",1,2020-01-01,1\n", "without user_id")):
        (tmp_path / "raw recipes.csv").write_text(recipes)
        (tmp_path / "inter.csv").write_text(inter)
        with pytest.raises(ValueError, match=said):
            jobs.ingest(spark, paths, str(tmp_path / "stopped"))
    assert not (tmp_path / "stopped").exists()


def test_raw_blocks_name_the_changed_block(spark, tmp_path):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "1000")
        text = "".join(f"line {i:05d}\n" for i in range(1000))
        (tmp_path / "a.csv").write_text(text)
        recorded = RAW.raw_blocks(spark, str(tmp_path / "a.csv")).collect()
        recorded = spark.createDataFrame(recorded)
        assert recorded.agg(F.sum("lines")).first()[0] == 1000 and recorded.count() >= 10
        (tmp_path / "a.csv").write_text(text.replace("00500", "00x00"))
        found = RAW.changed_blocks(recorded, RAW.raw_blocks(spark, str(tmp_path / "a.csv"))).collect()
        assert [r["block"] for r in found] == [500 * 11 // 1000 * 1000]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
