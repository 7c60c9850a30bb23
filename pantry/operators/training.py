"""Training-table assembly, temporal splits, encoding, contract and fingerprints.

Scale notes
* ``training_table`` is two equi-joins; AQE picks broadcast for a small side at
  runtime (a checked size) and sort-merge otherwise, with skew-join splitting
  a hot user / recipe partition.  The user side comes first: its columns are a
  fraction of the recipe's, and what the first join adds travels to the second.
* ``time_split`` never puts a whole date, let alone the whole table, into one
  window partition.  A per-date count table (one row per distinct date) gives
  each date its starting offset; dates entirely inside one split are classified
  by a join against that small table, which is checkpointed and, bounded by the
  calendar, broadcast, so the rows don't travel.  Only the (at most two) dates that
  straddle a boundary need row positions; those rows are range-partitioned by
  the full sort key (so a hot date is spread over many tasks), numbered with
  per-partition offsets, and checkpointed so positions survive recomputation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions import exprs as X
from ..session import cut_lineage
from . import manifest as M

ORDER_KEYS = ["date", "l_orderkey", "l_linenumber", "recipe_id", "l_suppkey", "l_shipdate"]
TRAINING_DROP = ["tags", "ingredients", "description", "allergens"]


def recipe_features(enriched: DataFrame) -> DataFrame:
    """Recipe side of the training join: allergen list -> 9 flags, raw lists dropped."""
    flags = {f"has_{a}": F.coalesce(F.array_contains("allergens", a).cast("int"), F.lit(0))
             for a in vocab.ALLERGENS_SORTED}
    return enriched.withColumns(flags).drop(*[c for c in TRAINING_DROP if c in enriched.columns])


def column_prune_training(enriched: DataFrame) -> DataFrame:
    return enriched.drop(*[c for c in TRAINING_DROP if c in enriched.columns])


def training_table(valid: DataFrame, enriched: DataFrame, user_features: DataFrame,
                   keep: list[str] | None = None) -> DataFrame:
    """interactions JOIN recipe features JOIN user features (both inner)."""
    keep = keep if keep is not None else ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"]
    left = valid.select("user_id", "recipe_id", "date", "rating", "label",
                        *[c for c in keep if c in valid.columns])
    recipes = recipe_features(enriched)
    joined = left.join(user_features, "user_id", "inner").join(recipes, "recipe_id", "inner")
    rest = [c for df, key in ((left, "recipe_id"), (recipes, "recipe_id"), (user_features, "user_id")) for c in df.columns if c not in ("user_id", key)]
    return joined.select("user_id", "recipe_id", *rest)


def _day_key(df: DataFrame, date_col: str):
    """Order-preserving coarsening of the first sort key: its calendar day, so
    the per-key table stays bounded by the calendar even for fine timestamps."""
    t = dict(df.dtypes)[date_col]
    if t.startswith("timestamp") or t == "date":
        return F.date_trunc("day", F.col(date_col))
    return F.col(date_col)


def _undated_last(dated: Column, day: str = "_day") -> list[Column]:
    """Join and sort key of a day: rows without a date are a day of their own, after all others."""
    return [dated.isNull().alias("_undated"), dated.alias(day)]


def _date_offsets(df: DataFrame, train_frac: float, val_frac: float) -> DataFrame:
    """One row per day: count, rows before it, split thresholds."""
    counts = df.groupBy("_undated", "_day").agg(F.count(F.lit(1)).alias("_cnt"))
    # Windows over the per-day table only (one row per day, bounded by the calendar).
    w = Window.orderBy("_undated", "_day").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    n = F.sum("_cnt").over(whole)
    return (counts
            .withColumn("_start", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).cast("bigint"))
            .withColumn("_train_end", F.floor(n * F.lit(float(train_frac))).cast("bigint"))
            .withColumn("_val_end", F.floor(n * (F.lit(float(train_frac)) + F.lit(float(val_frac))))
                        .cast("bigint")))


def _split_of(pos, train_end, val_end):
    return (F.when(pos < train_end, F.lit("train"))
            .when(pos < val_end, F.lit("val")).otherwise(F.lit("test")))


def split_days(df: DataFrame, date_col: str = ORDER_KEYS[0], train_frac: float = 0.8, val_frac: float = 0.1) -> DataFrame:
    """One row per day of ``df``, written once: its rows, the rows before it, where the
    splits end, and whether one ends inside it (``_boundary``).  Reads the date alone."""
    offs = _date_offsets(df.select(*_undated_last(_day_key(df, date_col))), train_frac, val_frac)
    return cut_lineage(offs.withColumn(
        "_boundary",
        ~(((F.col("_start") + F.col("_cnt")) <= F.col("_train_end"))
          | ((F.col("_start") >= F.col("_train_end")) & ((F.col("_start") + F.col("_cnt")) <= F.col("_val_end")))
          | (F.col("_start") >= F.col("_val_end")))))


def _with_days(df: DataFrame, days: DataFrame, date_col: str, how: str = "inner") -> DataFrame:
    """``df`` with ``_undated`` and ``_day``, joined with ``split_days``' rows (or some of them)."""
    dd = df.select("*", *_undated_last(_day_key(df, date_col)))
    days = days.withColumnRenamed("_day", "_d").withColumnRenamed("_undated", "_u")
    if dict(dd.dtypes)["_day"].startswith(("timestamp", "date")):  # bounded by the calendar
        days = F.broadcast(days)
    return dd.join(days, (F.col("_undated") == F.col("_u")) & F.col("_day").eqNullSafe(F.col("_d")), how).drop("_d", "_u")


def rows_for_split(df: DataFrame, days: DataFrame, split: str, date_col: str = ORDER_KEYS[0]) -> DataFrame:
    """The rows of ``df`` that ``time_split`` with ``days`` needs to give out all rows of
    ``split``: those of its days and of the (at most two) days inside which a split ends."""
    kept = days.where(F.col("_boundary") | (_split_of(F.col("_start"), F.col("_train_end"), F.col("_val_end")) == split))
    return _with_days(df, kept.select("_undated", "_day"), date_col, "left_semi").drop("_undated", "_day")


def time_split(df: DataFrame, order_keys: list[str] | None = None,
               train_frac: float = 0.8, val_frac: float = 0.1,
               with_position: bool = False, method: str = "sort", n_buckets: int = 256,
               days: DataFrame | None = None) -> DataFrame:
    """Add ``split`` (train / val / test): first floor(n*0.8) rows by time, next
    up to floor(n*(0.8+0.1)), rest.  ``order_keys`` must be a total order whose
    first key is the date.

    ``method`` positions the rows of the (at most two) boundary days:
    "sort" (default) range-sorts them on the full key and checkpoints - robust
    to any hot value and measured faster; "buckets" is fully lazy (quantile
    buckets of the leading varying key) and avoids the extra job.

    ``days`` are the ``split_days`` of the whole table where ``df`` is what
    ``rows_for_split`` keeps of it; where it is None they are counted here."""
    keys = order_keys or ORDER_KEYS
    date_col = keys[0]
    # every later pass looks days up and counts none
    marked = split_days(df, date_col, train_frac, val_frac) if days is None else days
    joined = _with_days(df, marked, date_col)

    whole = joined.filter(~F.col("_boundary")).withColumn(
        "split", _split_of(F.col("_start"), F.col("_train_end"), F.col("_val_end")))
    edge = joined.filter(F.col("_boundary"))
    if method == "buckets":
        edge_out = _edge_positions_buckets(edge, keys, n_buckets)
    else:
        edge_out = _edge_positions_sorted(edge, keys, marked)
    cols = df.columns + ["split"]
    if with_position:
        # Positions for interior rows need the per-day row_number; only on request.
        iw = Window.partitionBy("_undated", "_day").orderBy(*keys)
        whole = whole.withColumn("_pos", F.col("_start") + F.row_number().over(iw) - 1)
        cols = cols + ["_pos"]
    return whole.select(*cols).unionByName(edge_out.select(*cols))


def _monotone_double(df: DataFrame, col: str):
    """Order-preserving double of a numeric / date / timestamp column."""
    t = dict(df.dtypes)[col]
    c = F.col(col)
    if t == "date" or t.startswith("timestamp"):
        return c.cast("timestamp").cast("double")
    return c.cast("double")


def _edge_positions_buckets(edge: DataFrame, keys: list[str], n_buckets: int) -> DataFrame:
    """Lazy positions for boundary-day rows.  Within a day rows are ordered by
    keys[0] then keys[1:]; the bucket column is keys[0] where it varies inside
    the day (exact min < max test) and keys[1] where keys[0] is constant, so
    buckets always follow the row order.  Order-preserving buckets come from
    approximate quantiles per day; prefix counts on the tiny (day, bucket)
    table; row_number inside each (day, bucket).  Exact; balanced unless one
    value of the bucket column holds most of a day."""
    k0 = _monotone_double(edge, keys[0])
    k1 = _monotone_double(edge, keys[1])
    e = edge.withColumn("_k0", k0).withColumn("_k1", k1)
    e = e.withColumn("_day", F.coalesce("_day", F.lit("9999-12-31").cast(dict(edge.dtypes)["_day"])))
    varies = e.groupBy("_day").agg((F.min("_k0") < F.max("_k0")).alias("_varies"))
    e = e.join(varies, "_day").withColumn("_bv", F.when(F.col("_varies"), F.col("_k0")).otherwise(F.col("_k1")))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = e.groupBy("_day").agg(F.percentile_approx(F.col("_bv"), probs, 10000).alias("_bounds"))
    b = (e.join(bounds, "_day")
         .withColumn("_bkt", F.size(F.filter("_bounds", lambda x: x < F.col("_bv")))).drop("_bounds"))
    cnt = b.groupBy("_day", "_bkt").agg(F.count(F.lit(1)).alias("_bc"))
    wb = Window.partitionBy("_day").orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    boff = cnt.select("_day", "_bkt", F.coalesce(F.sum("_bc").over(wb), F.lit(0)).alias("_boff"))
    wr = Window.partitionBy("_day", "_bkt").orderBy(*keys)
    pos = F.col("_start") + F.col("_boff") + F.row_number().over(wr) - 1
    return (b.join(boff, ["_day", "_bkt"]).withColumn("_pos", pos)
            .withColumn("split", _split_of(F.col("_pos"), F.col("_train_end"), F.col("_val_end"))))


def _edge_positions_sorted(edge: DataFrame, keys: list[str], marked: DataFrame) -> DataFrame:
    """Positions for boundary-day rows by a global range sort on the full key
    (robust to any hot value), numbered by partition offsets on a checkpoint."""
    ranked = cut_lineage(edge.orderBy("_undated", "_day", *keys).withColumn("_mid", F.monotonically_increasing_id()))
    ranked = ranked.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_idx", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    pcounts = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_pc"))
    pw = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    poffs = pcounts.withColumn("_poff", F.coalesce(F.sum("_pc").over(pw), F.lit(0)))
    # rank within the boundary subset -> rank within the day
    bdays = marked.filter(F.col("_boundary")).select("_undated", "_day", "_cnt")
    dw = Window.orderBy("_undated", "_day").rowsBetween(Window.unboundedPreceding, -1)  # <= 2 rows
    before = bdays.withColumn("_before", F.coalesce(F.sum("_cnt").over(dw), F.lit(0))).select(
        F.col("_undated").alias("_u"), F.col("_day").alias("_d"), "_before")
    pos = F.col("_start") + F.col("_poff") + F.col("_idx") - F.col("_before")
    return (ranked.join(poffs.select("_pid", "_poff"), "_pid")
            .join(before, (F.col("_undated") == F.col("_u")) & F.col("_day").eqNullSafe(F.col("_d")))
            .withColumn("_pos", pos)
            .withColumn("split", _split_of(F.col("_pos"), F.col("_train_end"), F.col("_val_end"))))


def split_by_days(df: DataFrame, date_col: str = "date", test_days: int = 14,
                  val_days: int = 7) -> DataFrame:
    """Documented day-window variant: TRAIN < T-14d <= TEST < T-7d <= VAL <= T."""
    t = df.agg(F.max(date_col).alias("_t"))  # one row
    j = df.crossJoin(t)
    return (j.withColumn("split",
                         F.when(F.col(date_col) < F.col("_t") - F.expr(f"INTERVAL {test_days} DAYS"), "train")
                         .when(F.col(date_col) < F.col("_t") - F.expr(f"INTERVAL {val_days} DAYS"), "test")
                         .otherwise("val"))
            .drop("_t"))


def _index_vocabulary(vocab_df: DataFrame) -> DataFrame:
    """0-based index of each distinct value in sorted order, by the range-sorted
    dense index: no task holds the vocabulary, whatever its size."""
    from .ml import dense_index
    return dense_index(vocab_df, ["_v"], "_i").select("_v", F.col("_i").cast("double").alias("_idx"))


def label_encode(train: DataFrame, frames: dict[str, DataFrame], column: str) -> dict[str, DataFrame]:
    """Sorted distinct train values (NULL -> 'unknown') -> 0..k-1; unseen -> -1.0."""
    vocab_df = (train.select(F.coalesce(F.col(column).cast("string"), F.lit("unknown")).alias("_v"))
                .distinct())
    idx = _index_vocabulary(vocab_df)
    out = {}
    for name, f in frames.items():
        j = f.withColumn("_v", F.coalesce(F.col(column).cast("string"), F.lit("unknown")))
        j = j.join(idx, "_v", "left")
        out[name] = j.withColumn(column, F.coalesce(F.col("_idx"), F.lit(-1.0))).drop("_v", "_idx")
    return out


def label_encode_column(df: DataFrame, column: str, fit_rows) -> DataFrame:
    """Single-frame form of ``label_encode``: vocabulary from rows where
    ``fit_rows`` holds (e.g. split = 'train'), applied to every row; one scan."""
    v = F.coalesce(F.col(column).cast("string"), F.lit("unknown"))
    vocab_df = df.filter(fit_rows).select(v.alias("_v")).distinct()
    idx = _index_vocabulary(vocab_df)
    j = df.withColumn("_v", v).join(idx, "_v", "left")
    return j.withColumn(column, F.coalesce(F.col("_idx"), F.lit(-1.0))).drop("_v", "_idx")


def feature_contract(df: DataFrame, features: list[str] | None = None,
                     keep: list[str] | None = None) -> DataFrame:
    """Exactly the contract features in order; missing / non-numeric / NULL -> 0.0."""
    features = features or vocab.FEATURE_COLUMNS
    keep = keep or []
    types = dict(df.dtypes)

    def num(c):
        if c not in types:
            return F.lit(0.0)
        x = F.col(c).try_cast("double") if types[c] == "string" else F.col(c).cast("double")
        return F.when(x.isNull() | F.isnan(x), F.lit(0.0)).otherwise(x)

    return df.select(*[F.col(k) for k in keep if k in types], *[num(c).alias(c) for c in features])


def infer_feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in vocab.NON_FEATURE_COLUMNS]


MANIFEST_KEYS = ("user_id", "recipe_id")


def dataset_manifest(splits: dict[str, DataFrame], date_col: str = "date", label_col: str = "label") -> DataFrame:
    """``dataset_manifest_tagged`` of named splits with equal columns."""
    parts = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    return dataset_manifest_tagged(reduce(DataFrame.unionByName, parts), date_col=date_col, label_col=label_col)


def dataset_manifest_tagged(tagged: DataFrame, split_col: str = "split", date_col: str = "date", label_col: str = "label",
                            keys: tuple[str, ...] = MANIFEST_KEYS, n_buckets: int = M.N_BUCKETS) -> DataFrame:
    """Per split: rows, min/max date, label mean and a content hash over the digests
    of its buckets, so any changed value of any column changes it and the layout of
    files doesn't.  ``version`` = first 12 hex of SHA-256 over the split hashes in
    split-name order.  One grouped pass; ``manifest.bucket_digests`` are the buckets."""
    buckets = M.bucket_digests(tagged, [k for k in keys if k in tagged.columns], n_buckets, split_col, date_col, label_col)
    return M.manifest_of(buckets, [c for c in tagged.columns if c != split_col]).select(
        "split", "rows", "min_date", "max_date", "label_mean", "content_hash", "version")


def replay_window(df: DataFrame, days: int, date_col: str = "date") -> DataFrame:
    """Rows of the last ``days`` days relative to the newest date, with a ``day``
    text column; without any date all rows are kept as day 'undated'."""
    newest = df.agg(F.max(date_col).alias("_mx"))  # one row
    start = X.scalar_of(newest, F.col("_mx") - F.make_dt_interval(F.lit(days)), df, date_col)
    dated = df.filter(F.col(date_col) >= start).withColumn("day", F.date_format(date_col, "yyyy-MM-dd"))
    none = newest.where(F.col("_mx").isNull()).select(F.lit("undated").alias("day"))  # a row if no date is known
    return dated.unionByName(df.filter(F.col(date_col).isNull()).crossJoin(none))
