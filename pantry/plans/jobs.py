"""End-to-end Spark applications for the reference's entry points:

* ``ingest`` (raw files): CSV to Parquet after stopping checks, with a manifest of the
  files' blocks; ``verify_ingest`` and ``verify_release`` name what has changed since.
* ``build_training_dataset`` (batch training data): union production rows,
  enrich, label, user features, training table, time split, quality suites,
  fingerprint, versioned publish with a ``latest`` pointer.
* ``retrain`` (retraining loop): read the latest release, train the ranker,
  score the test split, popularity baseline, fairness report, gates.
* ``drift_check`` (one check of the drift loop): baseline = oldest train rows, live
  window since the last trigger in the drift log, KS per feature, summary, append to
  the log.  ``pantry.streaming.drift`` is the loop as a stream.

Each writes its outputs as parquet under ``out_root`` (default: the shared
``spark.checkpoint.dir`` folder).  Usage:
``python -m pantry.plans.jobs dataset|retrain|drift --sf /path/to/sf``.
"""

from __future__ import annotations

import argparse
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import vocab
from ..operators import drift as D
from ..operators import enrich as E
from ..operators import evaluate as EV
from ..operators import manifest as MF
from ..operators import ml as ML
from ..operators import quality as Q
from ..operators import training as T
from ..operators import users as U
from ..session import build_session
from ..sources import io as IO
from ..sources import raw as RAW
from ..sources.fixtures import Catalog, production_split


def build_training_dataset(spark: SparkSession, sf_dir: str, out_root: str | None = None,
                           with_pca: bool = True) -> dict:
    root = out_root or IO.output_root(spark, "release")
    cat = Catalog(spark, sf_dir)
    hist, prod = production_split(cat.interactions)
    # production rows are unioned BEFORE enrichment (the documented intent)
    interactions = hist.unionByName(prod)
    enriched = IO.materialize(E.enrich_recipes(cat.recipes, interactions), "enriched_recipes")
    valid = U.semi_valid_recipes(U.label_interactions(interactions), enriched)
    uf = U.derive_user_features(valid, enriched, with_pca=with_pca)
    training = IO.materialize(T.training_table(valid, enriched, uf), "training_table")
    tagged = IO.materialize(T.time_split(training), "splits")
    quality = (Q.run_rule_suite({"enriched_recipes": enriched}, tagged=tagged)
               .unionByName(Q.run_builtin_suite(enriched, tagged)))
    sanity = Q.split_sanity(tagged).first()  # one row
    if not (sanity["no_empty_split"] and sanity["temporal_ok"] and sanity["keys_ok"]):
        raise ValueError(f"split validation failed: {sanity.asDict()}")
    tagged = tagged.withColumn("date", F.col("date").cast("timestamp"))
    buckets = IO.materialize(MF.bucket_digests(tagged, T.MANIFEST_KEYS, date_col="date", label_col="label"), "manifest-buckets")
    manifest = MF.manifest_of(buckets, [c for c in tagged.columns if c != "split"])
    version = manifest.select("version").first()[0]
    parts = {n: tagged.filter(F.col("split") == n).drop("split") for n in ("train", "val", "test")}
    parts["enriched_recipes"] = enriched
    parts["quality"] = quality
    parts["manifest"] = manifest
    parts["manifest_buckets"] = buckets
    base = IO.publish(spark, parts, root, version)
    return {"root": root, "version": version, "path": base}


RAW_TABLES = {  # table: (schema, header names that differ, key)
    "recipes": ("recipe_id long, name string, minutes int, tags string, nutrition string, n_steps int, n_ingredients int, ingredients string, "
                "description string", {"id": "recipe_id"}, "recipe_id"),
    "interactions": ("user_id long, recipe_id long, date timestamp, rating int", {}, None),
}


def ingest(spark: SparkSession, paths: dict[str, str], out_root: str) -> dict:
    """Raw CSV files -> Parquet tables and a manifest of the files' blocks.  Stops
    before anything is published if a recipe's id is null or not unique, or an
    interaction has no user or recipe."""
    tables, bad = {}, []
    for name, (schema, rename, key) in RAW_TABLES.items():
        df = IO.materialize(IO.read_csv(spark, paths[name], StructType.fromDDL(schema), rename), f"raw-{name}")
        needed = [key] if key else ["user_id", "recipe_id"]
        nulls = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in needed]).first()
        bad += [f"{name}: {nulls[c]} rows without {c}" for c in needed if nulls[c]]
        if key:
            twice = df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").count()
            bad += [f"{name}: {twice} values of {key} occur twice"] if twice else []
        tables[name] = df
    if bad:
        raise ValueError("; ".join(bad))
    blocks = reduce(DataFrame.unionByName, [RAW.raw_blocks(spark, paths[n]).withColumn("table", F.lit(n)) for n in RAW_TABLES])
    blocks = IO.materialize(blocks, "raw-blocks")
    files = RAW.raw_manifest(blocks)
    version = files.agg(F.substring(F.sha2(F.array_join(F.sort_array(F.collect_list("sha256")), ":"), 256), 1, 12)).first()[0]
    base = IO.publish(spark, tables | {"raw_blocks": blocks, "raw_files": files}, out_root, version)
    return {"root": out_root, "version": version, "path": base}


def verify_ingest(spark: SparkSession, paths: dict[str, str], root: str) -> DataFrame:
    """file, block of raw files that are no longer what the newest ingest read."""
    found = reduce(DataFrame.unionByName, [RAW.raw_blocks(spark, paths[n]) for n in RAW_TABLES])
    return RAW.changed_blocks(IO.resolve_latest(spark, root, "raw_blocks"), found)


def verify_release(spark: SparkSession, root: str) -> DataFrame:
    """split, bucket, rows of the newest release's buckets that differ from its manifest."""
    parts = [IO.resolve_latest(spark, root, n).withColumn("split", F.lit(n)) for n in ("train", "val", "test")]
    tagged = reduce(DataFrame.unionByName, parts)
    return MF.changed_buckets(IO.resolve_latest(spark, root, "manifest_buckets"), MF.bucket_digests(tagged, T.MANIFEST_KEYS))


def retrain(spark: SparkSession, release_root: str, production_ndcg: float | None = None,
            threshold: float = 0.55) -> DataFrame:
    train = IO.resolve_latest(spark, release_root, "train").withColumn("split", F.lit("train"))
    test = IO.resolve_latest(spark, release_root, "test").withColumn("split", F.lit("test"))
    keys = ["user_id", "recipe_id", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"]
    prep = IO.materialize(ML.prepare_features(train.unionByName(test), keep=keys + ["label", "split"]), "prepared")
    weights, _ = ML.train_ranker(prep.filter(F.col("split") == "train"))
    scored = ML.score_candidates(prep.filter(F.col("split") == "test"), weights, tie=keys[1:])
    ranker = EV.ndcg_exp(scored).first()["ndcg_at_10"]
    pop = EV.ndcg_exp(EV.score_popularity(prep.filter(F.col("split") == "train"),
                                          prep.filter(F.col("split") == "test"))).first()["ndcg_at_10"]
    fair_in = scored  # diet and allergen flags are contract features of the scored rows
    report = EV.fairness_report(EV.fairness_groups(fair_in), EV.allergen_safety(fair_in),
                                EV.ndcg_topk_linear_per_user(fair_in)).first()
    runs = spark.createDataFrame(
        [(1, float(ranker), bool(report["overall_passed"]), False)]
        + ([(0, float(production_ndcg), True, True)] if production_ndcg is not None else []),
        "run_id int, ndcg_at_10 double, fairness_passed boolean, is_production boolean")
    gates = EV.model_gates(runs, threshold).filter(F.col("run_id") == 1)
    return gates.withColumn("popularity_ndcg", F.lit(float(pop)))


def drift_check(spark: SparkSession, release_root: str, sf_dir: str, features: list[str] | None = None,
                log_root: str | None = None, full: bool = False, min_rows: int = 100) -> DataFrame:
    """One check of the loop: KS drift of the rows since the later of 24 h ago and the
    last trigger, against the oldest 5000 training rows (the reference's limit), or
    with ``full`` against all of them.  Below ``min_rows`` rows the check is skipped.
    Features and summary go to the drift log, whose newest triggered summary is where
    the next check's window starts."""
    features = features or vocab.DRIFT_FEATURES
    out = log_root or IO.output_root(spark, "drift-log")
    train = IO.resolve_latest(spark, release_root, "train")
    baseline = train if full else D.baseline_head(
        train, ["date", "l_orderkey", "l_linenumber", "recipe_id", "l_suppkey"], 5000)
    log = Catalog(spark, sf_dir).request_log
    before = IO.read_or_empty(spark, f"{out}/summary", DRIFT_SUMMARY).where("triggered").agg(F.max("check_at").alias("last_trigger_at"))
    now = log.agg(F.max("ts").cast("timestamp").alias("now"))
    live_rows = IO.materialize(D.lookback_window(log, now.crossJoin(before), min_rows=0), "live-rows")  # one row by one row
    n_rows, check_at = live_rows.count(), now.first()[0]
    names = [f for f in features if f in train.columns]
    ks = D.ks_drift(baseline, D.json_to_features(live_rows, "features", names), names).where(F.lit(n_rows >= min_rows))
    ks = IO.materialize(ks.withColumn("check_at", F.lit(check_at)), "drift-features")
    ks.write.mode("append").parquet(f"{out}/features")
    summary = D.drift_summary(ks).select(
        F.lit(check_at).alias("check_at"), F.lit(n_rows).cast("long").alias("n_rows"), F.lit(n_rows < min_rows).alias("skipped"),
        F.col("n_features_checked").cast("long"), F.col("n_drifted").cast("long"), "drift_rate",
        F.col("overall_drift_detected").alias("triggered"), "drifted_features")
    summary = IO.materialize(summary, "drift-summary")
    summary.write.mode("append").parquet(f"{out}/summary")
    return summary


DRIFT_SUMMARY = ("check_at timestamp, n_rows bigint, skipped boolean, n_features_checked bigint, n_drifted bigint, drift_rate double, "
                 "triggered boolean, drifted_features string")


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("job", choices=["dataset", "retrain", "drift"])
    ap.add_argument("--sf", required=True)
    ap.add_argument("--release", default=None)
    a = ap.parse_args()
    spark = build_session()
    if a.job == "dataset":
        print(json.dumps(build_training_dataset(spark, a.sf)))
    elif a.job == "retrain":
        print([r.asDict() for r in retrain(spark, a.release).collect()])
    else:
        print([r.asDict() for r in drift_check(spark, a.release, a.sf).collect()])


if __name__ == "__main__":
    main()
