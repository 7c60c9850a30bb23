"""User features: labels, history join, macro targets, diet flags, cuisine mix, PCA,
activity filter and the layered online lookup.

Scale notes
* Every per-user feature is one hash aggregate keyed by ``user_id`` with partial
  (map-side) aggregation, so a user with a third of all rows is pre-combined
  in every task before the shuffle; no group is ever collected.
* The per-user Python loop of the reference (diet flags) becomes
  ``avg(exists(tags, ...))`` inside the same aggregate.
* PCA fits on d x d moments (d = cuisine vocabulary, 22) from one scan; eight of
  them reach the driver.
"""

from __future__ import annotations

import operator
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import exprs as X

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package on their path

HISTORY_RECIPE_COLS = ["recipe_id", "calories", "protein_g", "carbohydrate_g",
                       "total_fat_g", "cuisine", "tags"]
TARGETS = [("calories", "daily_calorie_target"), ("protein_g", "protein_target_g"),
           ("carbohydrate_g", "carbs_target_g"), ("total_fat_g", "fat_target_g")]


def label_interactions(interactions: DataFrame) -> DataFrame:
    return interactions.withColumn("label", X.label_from_rating("rating"))


def semi_valid_recipes(labeled: DataFrame, enriched: DataFrame) -> DataFrame:
    """Interactions whose recipe survived enrichment (LEFT SEMI on recipe_id)."""
    return labeled.join(enriched.select("recipe_id"), "recipe_id", "left_semi")


def marked_recipes(enriched: DataFrame) -> DataFrame:
    """The recipe columns that user features read; a diet tag is looked up once for each
    recipe, so interactions carry six small marks and no list of tags."""
    cols = [c for c in HISTORY_RECIPE_COLS if c in enriched.columns and c != "tags"]
    return enriched.select(*cols, *[_has_tag(t).alias(c) for c, t in vocab.DIET_TAGS.items()])


def join_history(interactions: DataFrame, enriched: DataFrame) -> DataFrame:
    """interactions LEFT JOIN the pruned recipe columns used for user features."""
    cols = [c for c in HISTORY_RECIPE_COLS if c in enriched.columns]
    return interactions.join(enriched.select(*cols), "recipe_id", "left")


def user_targets(history: DataFrame) -> DataFrame:
    """Mean kcal / protein / carbs / fat over each user's positive interactions."""
    return (history.filter(F.col("label") == 1).groupBy("user_id")
            .agg(*[F.avg(s).alias(t) for s, t in TARGETS]))


def _has_tag(tag: str):
    return F.coalesce(F.exists("tags", lambda t: F.lower(t) == F.lit(tag)).cast("int"), F.lit(0))


def user_diet_flags(history: DataFrame, share: float = vocab.DIET_FLAG_SHARE) -> DataFrame:
    """Flag = 1 when >= share of the user's positive recipes carry the diet tag."""
    return (history.filter(F.col("label") == 1).groupBy("user_id")
            .agg(*[(F.avg(_has_tag(t)) >= F.lit(float(share))).cast("int").alias(c)
                   for c, t in vocab.DIET_TAGS.items()]))


def user_cuisine_mix(history: DataFrame, cuisines: list[str] | None = None) -> DataFrame:
    """Per-user share of positive interactions in each cuisine (fixed vocabulary)."""
    cuisines = cuisines or vocab.CUISINES
    return (history.filter(F.col("label") == 1).groupBy("user_id")
            .agg(*[F.avg((F.col("cuisine") == F.lit(c)).cast("double")).alias(f"cuisine_{c}")
                   for c in cuisines]))


def history_pca(mix: DataFrame, k: int = vocab.HISTORY_PCA_COMPONENTS) -> DataFrame:
    """(user_id, history_pc1..k): PCA of the centred cuisine mix.

    k = min(k, #cuisines that occur, #users).  Signs are canonical: the
    largest-magnitude loading of every component is positive.  Missing
    components (k < 6) are NULL columns, like the reference's left merge.

    One scan fits: tasks make moment matrices (count, means, products about the
    means), which merge exactly like their rows' would; a second, lazy pass projects.
    """
    feats = [c for c in mix.columns if c.startswith("cuisine_")]
    n_users, mean, products, most = merged_moments(mix, feats)
    used = [i for i in range(len(feats)) if most[i] > 0]
    kk = min(k, len(used), n_users)
    out_cols = [f"history_pc{i + 1}" for i in range(k)]
    if kk == 0:
        return mix.select("user_id", *[F.lit(None).cast("double").alias(c) for c in out_cols])
    _, vectors = np.linalg.eigh(products[np.ix_(used, used)])  # d x d, bounded by the vocabulary
    loadings = vectors[:, ::-1][:, :kk]
    loadings = loadings * np.where(loadings[np.abs(loadings).argmax(0), range(kk)] >= 0, 1.0, -1.0)

    def component(j: int) -> Column:
        if j >= kk:
            return F.lit(None).cast("double")
        return reduce(operator.add, [(F.col(feats[i]) - float(mean[i])) * float(w) for i, w in zip(used, loadings[:, j], strict=True)])

    return mix.select("user_id", *[component(j).alias(c) for j, c in enumerate(out_cols)])


def merged_moments(df: DataFrame, cols: list[str]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, means, sums of products about the means, greatest values) of ``cols`` over
    rows without NULL among them, in one scan.  Each task hands on one matrix; after one shuffle eight
    are left for the driver."""
    d = len(cols)
    names = ["n", "mean", "products", "most"]

    def merge(parts: list[tuple]) -> tuple:
        n, mean, products, most = 0, np.zeros(d), np.zeros((d, d)), np.full(d, -np.inf)
        for m, other, p, top in parts:
            if m:
                gap = other - mean
                products = products + p + np.outer(gap, gap) * (n * m / (n + m))
                mean = mean + gap * (m / (n + m))
                n, most = n + m, np.maximum(most, top)
        return n, mean, products, most

    def told(m: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([m[0]]), *(pa.array([x.ravel().tolist()], pa.list_(pa.float64())) for x in m[1:])], names=names)

    def read(batch: pa.RecordBatch) -> list[tuple]:
        return [(r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(d, d), np.array(r["most"])) for r in batch.to_pylist()]

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = merge([])
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            if len(x):
                about = x - x.mean(0)
                so_far = merge([so_far, (len(x), x.mean(0), about.T @ about, x.max(0))])
        yield told(so_far)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = merge([])
        for batch in batches:
            so_far = merge([so_far, *read(batch)])
        yield told(so_far)

    schema = "n long, mean array<double>, products array<double>, most array<double>"
    parts = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna().mapInArrow(own, schema)
    few = parts.repartition(8).mapInArrow(joined, schema)
    return merge([(r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(d, d), np.array(r["most"])) for r in few.collect()])


def active_users(interactions: DataFrame, min_n: int = vocab.MIN_USER_INTERACTIONS) -> DataFrame:
    """Users with >= min_n interactions of any label (for a LEFT SEMI join)."""
    return (interactions.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") >= min_n).select("user_id"))


def semi_active_users(df: DataFrame, interactions: DataFrame,
                      min_n: int = vocab.MIN_USER_INTERACTIONS) -> DataFrame:
    return df.join(active_users(interactions, min_n), "user_id", "left_semi")


def user_aggregates(history: DataFrame, with_mix: bool = False,
                    share: float = vocab.DIET_FLAG_SHARE) -> DataFrame:
    """Every per-user feature in ONE grouped pass over the history: activity
    count (all labels), positive count, macro targets and diet flags over the
    positive rows (``avg(when(label = 1, x))`` ignores the others), and
    optionally the cuisine mix used by the PCA.  Tags are read from the marks of
    ``marked_recipes`` where the history has them; every flag's share is over the
    positive count, which is counted once."""
    pos = F.col("label") == 1
    n_pos = F.count(F.when(pos, 1))
    aggs = [F.count(F.lit(1)).alias("_n_all"), n_pos.alias("_n_pos")]
    aggs += [F.avg(F.when(pos, F.col(s))).alias(t) for s, t in TARGETS]
    mark = {c: F.coalesce(F.col(c), F.lit(0)) if c in history.columns else _has_tag(t) for c, t in vocab.DIET_TAGS.items()}
    aggs += [(X.safe_div(F.sum(F.when(pos, m)), n_pos) >= F.lit(float(share))).cast("int").alias(c) for c, m in mark.items()]
    if with_mix:
        aggs += [F.avg(F.when(pos, (F.col("cuisine") == F.lit(c)).cast("double"))).alias(f"cuisine_{c}")
                 for c in vocab.CUISINES]
    return history.groupBy("user_id").agg(*aggs)


def derive_user_features(interactions: DataFrame, enriched: DataFrame, with_pca: bool = True,
                         min_n: int = vocab.MIN_USER_INTERACTIONS) -> DataFrame:
    """targets + diet flags (+ history PCA fitted on all users with a positive
    interaction), restricted to users with >= min_n interactions.  Interactions whose
    recipe is not in ``enriched`` don't count: one inner join gives the rows that
    ``semi_valid_recipes`` and ``join_history`` give."""
    history = interactions.join(marked_recipes(enriched), "recipe_id")
    agg = user_aggregates(history, with_mix=with_pca).filter(F.col("_n_pos") > 0)
    feats = agg.filter(F.col("_n_all") >= min_n).select(
        "user_id", *[t for _, t in TARGETS], *vocab.DIET_TAGS)
    if with_pca:
        mix = agg.select("user_id", *[f"cuisine_{c}" for c in vocab.CUISINES])
        feats = feats.join(history_pca(mix), "user_id", "left")
    return feats


def last_n_positive(interactions: DataFrame, enriched: DataFrame, n: int = 100,
                    min_rows: int = 3) -> DataFrame:
    """Averages of the last n positive interactions per user (users with >= min_rows).

    ``row_number`` per user is evaluated by Spark's WindowGroupLimit (top-n
    inside each sort run), so a hot user never materialises more than n rows
    per task before the final window.
    """
    w = Window.partitionBy("user_id").orderBy(F.desc("date"), F.desc("l_orderkey"),
                                              F.desc("l_linenumber"), F.desc("recipe_id"))
    joined = interactions.filter(F.col("label") == 1).join(
        enriched.select("recipe_id", "calories", "protein_g", "carbohydrate_g", "total_fat_g"),
        "recipe_id", "inner")
    recent = joined.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return (recent.groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n_recent"), *[F.avg(s).alias(t) for s, t in TARGETS])
            .filter(F.col("n_recent") >= min_rows))


def user_feature_lookup(users: DataFrame, cached: DataFrame, recent: DataFrame) -> DataFrame:
    """Layered lookup for a batch of users: cache -> recent history -> defaults, all 16
    user features (targets, diet flags, history components).

    The layer is chosen per row (``source``), not per column: a NULL inside a cached
    row stays NULL.  History knows the four targets; its other features, those of the
    defaults, and columns that the cache lacks are 0.  A user that is looked up twice
    has two rows.
    """
    targets = [t for _, t in TARGETS]
    others = [*vocab.DIET_TAGS, *(f"history_pc{i + 1}" for i in range(vocab.HISTORY_PCA_COMPONENTS))]
    held = [c for c in targets + others if c in cached.columns]
    c = cached.select("user_id", F.struct(*held).alias("_c"))
    r = recent.select("user_id", F.struct(*targets).alias("_r"))
    j = users.select("user_id").join(c, "user_id", "left").join(r, "user_id", "left")
    source = F.when(F.col("_c").isNotNull(), "cache").when(F.col("_r").isNotNull(), "history").otherwise("default")

    def value(t: str) -> Column:
        zero = F.lit(0 if t in vocab.DIET_TAGS else 0.0)
        known = F.col(f"_c.{t}") if t in held else zero
        rest = F.when(F.col("_r").isNotNull(), F.col(f"_r.{t}")).otherwise(F.lit(vocab.ONLINE_DEFAULT_TARGETS[t])) if t in targets else zero
        return F.when(F.col("_c").isNotNull(), known).otherwise(rest).alias(t)

    return j.select("user_id", source.alias("source"), *map(value, targets + others))
