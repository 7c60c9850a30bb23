"""Shared plan fragments for registered queries (the batch training pipeline)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions import exprs as X
from ..operators import enrich as E
from ..operators import training as T
from ..operators import users as U
from ..sources.fixtures import Catalog
from ..sources.io import materialize

MACROS = vocab.NUTRITION_FIELDS + [f"{c}_g" for c in vocab.PDV_TO_ABS]
TARGET_COLS = ["daily_calorie_target", "protein_target_g", "carbs_target_g", "fat_target_g"]
DIET_COLS = list(vocab.DIET_TAGS)
HAS_COLS = [f"has_{a}" for a in vocab.ALLERGENS_SORTED]
PC_COLS = [f"history_pc{i}" for i in range(1, 7)]
TRAIN_OUT = (["user_id", "recipe_id", "date", "rating", "label", "l_orderkey", "l_linenumber",
              "l_suppkey", "name", "minutes", "n_ingredients", "n_steps", "avg_rating",
              "n_reviews", "cuisine"] + MACROS + HAS_COLS + TARGET_COLS + DIET_COLS)
DOUBLE_OUT = set(MACROS + TARGET_COLS + ["avg_rating"] + PC_COLS)


@dataclass
class Pipeline:
    cat: Catalog
    enriched: DataFrame
    labeled: DataFrame
    valid: DataFrame
    history: DataFrame
    user_features: DataFrame
    training: DataFrame


def pipeline(spark, sf, with_pca: bool = False, qt: float = vocab.MINUTES_QUANTILE,
             k: int = vocab.MIN_REVIEWS) -> Pipeline:
    cat = Catalog(spark, sf)
    # The interactions are a join of two fact tables that recipe stats, user features and
    # the training table each read: it runs once, and they scan its narrow rows.
    labeled = materialize(U.label_interactions(cat.interactions), "interactions")
    # enriched is a dimension table consumed by 4 joins; materialise it once as
    # parquet in the shared folder.  The file scan carries size statistics, so
    # the planner broadcasts it when it is under the broadcast threshold (a
    # checked size) and sort-merge joins it otherwise.
    enriched = materialize(E.enrich_recipes(cat.recipes, labeled, qt, k), "enriched")
    valid = U.semi_valid_recipes(labeled, enriched)
    history = U.join_history(valid, enriched)
    uf = U.derive_user_features(labeled, enriched, with_pca=with_pca)
    training = T.training_table(labeled, enriched, uf)  # its join with the recipes keeps the valid rows
    return Pipeline(cat, enriched, labeled, valid, history, uf, training)


def out(df: DataFrame, cols: list[str]) -> DataFrame:
    """Project for comparison: doubles rounded to 6, timestamps as text."""
    types = dict(df.dtypes)
    sel = []
    for c in cols:
        t = types[c]
        if t in ("double", "float"):
            sel.append(X.round6(c).alias(c))
        elif t.startswith("timestamp") or t == "date":
            sel.append(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c))
        else:
            sel.append(F.col(c))
    return df.select(*sel)


def sql_out(cols: list[str], doubles: set[str], stamps: set[str] = frozenset({"date"})) -> str:
    parts = []
    for c in cols:
        if c in doubles:
            parts.append(f"round({c}, 6) AS {c}")
        elif c in stamps:
            parts.append(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}")
        else:
            parts.append(c)
    return ", ".join(parts)


#: What positions and ranks of rows need.
SPLIT_BASE = ["user_id", "label", *T.ORDER_KEYS]


def split_training(p: Pipeline, columns: list[str] | None = None) -> DataFrame:
    """train / val / test tagging of the materialised training table, of all its rows
    with all columns, or with ``columns`` beside those that split and rank them.

    The training table is written once to the shared folder; whatever evaluates,
    checks or fits its splits scans the columns it needs and never runs the joins
    again.  A row's split is looked up by its day, those of the boundary days are
    checkpointed by ``time_split``, so the tagged rows need no second copy."""
    training = p.training if columns is None else p.training.select(*dict.fromkeys([*SPLIT_BASE, *columns]))
    return T.time_split(materialize(training, "training"))


def split_rows(p: Pipeline, split: str, columns: list[str] | None = None) -> DataFrame:
    """``split_training`` for the rows of one split.  All rows of the training table are
    joined to count its days, with what the joins and the count read; the columns that
    order and rank rows travel with those of the split's days and of the boundary days."""
    wanted = list(dict.fromkeys([*SPLIT_BASE, *(columns or [])]))
    mine = [c for c in p.user_features.columns if c == "user_id" or c in wanted]
    users = materialize(p.user_features.select(*mine), "user_features")  # joined twice, aggregated once
    days = T.split_days(T.training_table(p.labeled, p.enriched, users))
    rows = T.training_table(T.rows_for_split(p.labeled, days, split), p.enriched, users).select(*wanted)
    return T.time_split(materialize(rows, "training"), days=days).filter(F.col("split") == split)
