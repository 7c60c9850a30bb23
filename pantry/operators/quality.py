"""Data-quality checks.  Every check set of a table compiles into ONE aggregate
pass over that table (plus one grouped pass per duplicate_count column); the
results are unpivoted to long form (table, check, actual, passed).

Nothing is collected: thresholds are literals inside the plan, and the result
is a small DataFrame with one row per check.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Check:
    name: str
    metric: str          # row_count | missing_count | duplicate_count | dup_rows | min | max | avg
    column: str | None
    op: str              # > >= < <= = between between_excl
    lo: float
    hi: float | None = None


# FIXED VALUES: the declarative rule file of the reference (table -> checks).
RULES_TEXT: dict[str, list[str]] = {
    "enriched_recipes": [
        "row_count > 50000", "missing_count(recipe_id) = 0", "missing_count(calories) = 0",
        "missing_count(cuisine) = 0", "duplicate_count(recipe_id) = 0", "min(calories) >= 0",
        "max(calories) < 500000", "avg(calories) between 200 and 800", "min(minutes) > 0",
        "min(n_ingredients) >= 1", "min(n_reviews) >= 3"],
    "train": ["row_count > 100000", "missing_count(user_id) = 0", "missing_count(recipe_id) = 0",
              "missing_count(label) = 0", "avg(label) between 0.1 and 0.98"],
    "val": ["row_count > 5", "missing_count(label) = 0"],
    "test": ["row_count > 5", "missing_count(label) = 0"],
}

_RULE = re.compile(r"^\s*(row_count|(missing_count|duplicate_count|min|max|avg)\((\w+)\))\s*"
                   r"(?:(>=|<=|>|<|=)\s*([-\d.]+)|between\s+([-\d.]+)\s+and\s+([-\d.]+))\s*$")


def parse_rule(text: str) -> Check:
    m = _RULE.match(text)
    if not m:
        raise ValueError(f"unsupported check: {text!r}")
    metric = "row_count" if m.group(1) == "row_count" else m.group(2)
    if m.group(4):
        return Check(text.strip(), metric, m.group(3), m.group(4), float(m.group(5)))
    return Check(text.strip(), metric, m.group(3), "between", float(m.group(6)), float(m.group(7)))


def _metric_expr(c: Check) -> Column | None:
    if c.metric == "row_count":
        return F.count(F.lit(1)).cast("double")
    if c.metric == "missing_count":
        return F.count_if(F.col(c.column).isNull()).cast("double")
    if c.metric == "dup_rows":
        return (F.count(F.lit(1)) - F.countDistinct(c.column)).cast("double")
    if c.metric in ("min", "max", "avg"):
        return getattr(F, c.metric)(F.col(c.column)).cast("double")
    return None  # duplicate_count: separate grouped pass


def _passed(actual: Column, c: Check) -> Column:
    lo = F.lit(c.lo)
    if c.op == "between":
        return (actual >= lo) & (actual <= F.lit(c.hi))
    if c.op == "between_excl":
        return (actual > lo) & (actual < F.lit(c.hi))
    return {">": actual > lo, ">=": actual >= lo, "<": actual < lo, "<=": actual <= lo,
            "=": actual == lo}[c.op]


def run_checks(df: DataFrame, checks: list[Check], table: str) -> DataFrame:
    """One aggregate over ``df`` for all checks -> (table, check, actual, passed)."""
    aggs = {f"_m{i}": e for i, c in enumerate(checks) if (e := _metric_expr(c)) is not None}
    base = df.agg(*[e.alias(k) for k, e in aggs.items()]) if aggs else None
    for i, c in enumerate(checks):
        if c.metric == "duplicate_count":
            d = (df.filter(F.col(c.column).isNotNull()).groupBy(c.column).agg(F.count(F.lit(1)).alias("_n"))
                 .agg(F.count_if(F.col("_n") > 1).cast("double").alias(f"_m{i}")))
            base = d if base is None else base.crossJoin(d)
    rows = [F.struct(F.lit(table).alias("table_name"), F.lit(c.name).alias("check_name"),
                     F.col(f"_m{i}").alias("actual"),
                     F.coalesce(_passed(F.col(f"_m{i}"), c), F.lit(False)).alias("passed"))
            for i, c in enumerate(checks)]
    return base.select(F.inline(F.array(*rows)))


def run_checks_by(df: DataFrame, group_col: str, checks_by_value: dict[str, list[Check]],
                  extra_aggs: list[Column] | None = None) -> DataFrame:
    """Checks for several slices of one table (e.g. train / val / test of the
    split-tagged table) in ONE grouped aggregate pass; each slice's checks are
    unpivoted from its row.  Slices without rows still report (row_count 0)."""
    keys: dict[tuple, str] = {}
    for checks in checks_by_value.values():
        for c in checks:
            keys.setdefault((c.metric, c.column), f"_m{len(keys)}")
    aggs = [e.alias(a) for (m, col), a in keys.items() if (e := _metric_expr(Check("", m, col, "=", 0))) is not None]
    base = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("_rows"), *aggs, *(extra_aggs or [])).drop("_rows")
    for (m, col), a in keys.items():
        if m == "duplicate_count":  # two levels of counts; the second has one row per slice
            d = (df.filter(F.col(col).isNotNull()).groupBy(group_col, col).agg(F.count(F.lit(1)).alias("_n"))
                 .groupBy(group_col).agg(F.count_if(F.col("_n") > 1).cast("double").alias(a)))
            base = base.join(d, group_col, "left")
    grid = df.sparkSession.createDataFrame([(v,) for v in checks_by_value], f"{group_col} string")
    base = grid.join(base, group_col, "left").fillna(0.0, subset=[a for (m, _), a in keys.items()
                                                                  if m in ("row_count", "missing_count", "duplicate_count")])
    arrays = None
    for v, checks in checks_by_value.items():
        arr = F.array(*[_row(v, c.name, F.col(keys[(c.metric, c.column)]),
                             F.coalesce(_passed(F.col(keys[(c.metric, c.column)]), c), F.lit(False)))
                        for c in checks])
        arrays = F.when(F.col(group_col) == v, arr) if arrays is None else arrays.when(F.col(group_col) == v, arr)
    return base.select(F.inline(arrays))


def run_rule_suite(tables: dict[str, DataFrame], rules: dict[str, list[str]] | None = None,
                   tagged: DataFrame | None = None, split_col: str = "split") -> DataFrame:
    """Rule file over named tables.  Slices of ``tagged`` (train / val / test)
    are checked together in one grouped pass instead of one pass each."""
    rules = rules or RULES_TEXT
    out = None
    sliced = {}
    for t, texts in rules.items():
        checks = [parse_rule(x) for x in texts]
        if tagged is not None and t in ("train", "val", "test"):
            sliced[t] = checks
            continue
        if t not in tables:
            continue
        r = run_checks(tables[t], checks, t)
        out = r if out is None else out.unionByName(r)
    if sliced:
        r = run_checks_by(tagged, split_col, sliced)
        out = r if out is None else out.unionByName(r)
    return out


def builtin_checks(split: str | None) -> list[Check]:
    """The hard-coded thresholds of the fallback checker."""
    if split is None:  # enriched recipes
        return [Check("row_count", "row_count", None, ">", 50000),
                Check("recipe_id_nulls", "missing_count", "recipe_id", "=", 0),
                Check("recipe_id_unique", "dup_rows", "recipe_id", "=", 0),
                Check("calories_nulls", "missing_count", "calories", "=", 0),
                Check("calories_min", "min", "calories", ">=", 0),
                Check("calories_max", "max", "calories", "<", 500000),
                Check("calories_avg", "avg", "calories", "between", 200, 800),
                Check("minutes_min", "min", "minutes", ">", 0),
                Check("ingredients_min", "min", "n_ingredients", ">=", 1),
                Check("reviews_min", "min", "n_reviews", ">=", 3),
                Check("cuisine_nulls", "missing_count", "cuisine", "=", 0)]
    min_rows = 100000 if split == "train" else 1000
    return ([Check(f"{split}_rows", "row_count", None, ">", min_rows)]
            + [Check(f"{split}_{c}_null", "missing_count", c, "=", 0) for c in ("user_id", "recipe_id", "label")]
            + [Check(f"{split}_balance", "avg", "label", "between_excl", 0.05, 0.95)])


def run_builtin_suite(enriched: DataFrame, tagged: DataFrame, split_col: str = "split",
                      date_col: str = "date") -> DataFrame:
    """Built-in thresholds: one pass over enriched recipes, one grouped pass over
    the split-tagged table (which also yields the temporal check's dates)."""
    out = run_checks(enriched, builtin_checks(None), "enriched_recipes")
    per = run_checks_by(tagged, split_col, {s: builtin_checks(s) for s in ("train", "val", "test")})
    dates = tagged.groupBy(split_col).agg(F.max(date_col).alias("_mx"), F.min(date_col).alias("_mn"))
    temporal = dates.agg(F.max(F.when(F.col(split_col) == "train", F.col("_mx"))).alias("_a"),
                         F.min(F.when(F.col(split_col) == "test", F.col("_mn"))).alias("_b")).select(
        F.lit("splits").alias("table_name"), F.lit("temporal").alias("check_name"),
        (F.unix_timestamp("_b") - F.unix_timestamp("_a")).cast("double").alias("actual"),
        F.coalesce(F.col("_a") < F.col("_b"), F.lit(False)).alias("passed"))
    return out.unionByName(per).unionByName(temporal)


def _row(table, check, actual, passed):
    return F.struct(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                    actual.cast("double").alias("actual"), passed.alias("passed"))


def schema_check(df: DataFrame, required: list[str], key: str, table: str) -> DataFrame:
    """Required columns present; key non-null and unique -> long form."""
    missing = [c for c in required if c not in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), F.count_if(F.col(key).isNull()).alias("_nulls"),
                 F.countDistinct(key).alias("_distinct"))
    return row.select(F.inline(F.array(
        _row(table, "missing_columns", F.lit(float(len(missing))), F.lit(not missing)),
        _row(table, f"{key}_nulls", F.col("_nulls"), F.col("_nulls") == 0),
        _row(table, f"{key}_duplicates", F.col("_rows") - F.col("_distinct"),
             F.col("_rows") == F.col("_distinct")))))


def interaction_checks(df: DataFrame, required: list[str], lo: int = 0, hi: int = 5) -> DataFrame:
    """Required columns; non-null user / recipe; ratings outside [lo, hi] (DB range)."""
    missing = [c for c in required if c not in df.columns]
    row = df.agg(F.count_if(F.col("user_id").isNull()).alias("_u"),
                 F.count_if(F.col("recipe_id").isNull()).alias("_r"),
                 F.count_if((F.col("rating") < lo) | (F.col("rating") > hi)).alias("_x"))
    t = "interactions"
    return row.select(F.inline(F.array(
        _row(t, "missing_columns", F.lit(float(len(missing))), F.lit(not missing)),
        _row(t, "user_id_nulls", F.col("_u"), F.col("_u") == 0),
        _row(t, "recipe_id_nulls", F.col("_r"), F.col("_r") == 0),
        _row(t, "rating_out_of_range", F.col("_x"), F.col("_x") == 0))))


def null_profile(df: DataFrame, table: str, threshold: float = 0.5, min_rows: int = 100,
                 sample_first: int | None = None, order_cols: list[str] | None = None) -> DataFrame:
    """Null rate of every column in one pass; flagged when > threshold; the
    table fails when it has fewer than min_rows rows.  ``sample_first`` reproduces
    the reference's "first n rows" mode with an explicit order (the limit is the
    feature); by default all rows are profiled."""
    cols = df.columns
    if sample_first is not None:
        df = df.orderBy(*(order_cols or cols[:1])).limit(sample_first)
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.avg(F.col(c).isNull().cast("double")).alias(f"_n{i}") for i, c in enumerate(cols)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                 F.col(f"_n{i}").alias("null_rate"), (F.col(f"_n{i}") > threshold).alias("flagged"),
                 (F.col("_rows") >= min_rows).alias("enough_rows")) for i, c in enumerate(cols)])))


def zero_variance(df: DataFrame, exclude: tuple[str, ...] = ("label",)) -> DataFrame:
    """Numeric columns with sample std = 0 (one row -> NULL std, not flagged)."""
    num = [c for c, t in df.dtypes if c not in exclude and t in
           ("int", "bigint", "double", "float", "smallint", "tinyint") or t.startswith("decimal")]
    num = [c for c in num if c not in exclude]
    row = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(f"_s{i}") for i, c in enumerate(num)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_s{i}").alias("std"),
                 F.coalesce(F.col(f"_s{i}") == 0, F.lit(False)).alias("zero_variance"))
        for i, c in enumerate(num)])))


def zero_variance_by(tagged: DataFrame, columns: list[str], split_col: str = "split") -> DataFrame:
    """``zero_variance`` for each split, in one grouped pass; a split without rows has none here."""
    per = tagged.groupBy(split_col).agg(*[F.stddev_samp(F.col(c).cast("double")).alias(f"_s{i}") for i, c in enumerate(columns)])
    return per.select(split_col, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_s{i}").alias("std"),
                 F.coalesce(F.col(f"_s{i}") == 0, F.lit(False)).alias("zero_variance"))
        for i, c in enumerate(columns)])))


def label_balance_check(train: DataFrame, lo: float = 0.02, hi: float = 0.98) -> DataFrame:
    return train.agg(F.avg(F.col("label").cast("double")).alias("positive_rate")).withColumn(
        "passed", (F.col("positive_rate") >= lo) & (F.col("positive_rate") <= hi))


def negative_range(tagged: DataFrame, column: str = "calories", split_col: str = "split") -> DataFrame:
    """Negative values per split, one grouped pass over the split-tagged table."""
    return (tagged.groupBy(split_col).agg(F.count_if(F.col(column) < 0).alias("negative_rows"))
            .withColumn("passed", F.col("negative_rows") == 0))


def split_sanity(tagged: DataFrame, split_col: str = "split", date_col: str = "date",
                 keys: tuple[str, ...] = ("user_id", "recipe_id", "label")) -> DataFrame:
    """One grouped pass over the tagged union of splits -> sanity row."""
    per = tagged.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("_n"), F.min(date_col).alias("_min"), F.max(date_col).alias("_max"),
        F.sum(sum(F.col(k).isNull().cast("int") for k in keys)).alias("_nulls"))
    return per.agg(
        F.coalesce(F.sum(F.when(F.col(split_col) == "train", F.col("_n"))), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum(F.when(F.col(split_col) == "val", F.col("_n"))), F.lit(0)).alias("val_rows"),
        F.coalesce(F.sum(F.when(F.col(split_col) == "test", F.col("_n"))), F.lit(0)).alias("test_rows"),
        F.max(F.when(F.col(split_col) == "train", F.col("_max"))).alias("train_max"),
        F.min(F.when(F.col(split_col) == "test", F.col("_min"))).alias("test_min"),
        F.sum(F.when(F.col(split_col) == "train", F.col("_nulls"))).alias("train_key_nulls"),
    ).select("*",
             ((F.col("train_rows") > 0) & (F.col("val_rows") > 0) & (F.col("test_rows") > 0)).alias("no_empty_split"),
             F.coalesce(F.col("train_max") < F.col("test_min"), F.lit(False)).alias("temporal_ok"),
             (F.coalesce(F.col("train_key_nulls"), F.lit(0)) == 0).alias("keys_ok"))


def leakage_corr(train: DataFrame, label_col: str = "label", threshold: float = 0.9,
                 prefixes: tuple[str, ...] = ("daily_", "user_")) -> DataFrame:
    """Pearson corr of every daily_* / user_* column with the label in one pass;
    flagged when |corr| > threshold (constant column -> NULL, not flagged)."""
    cols = [c for c in train.columns if c.startswith(prefixes)]
    row = train.agg(*[F.corr(F.col(c).cast("double"), F.col(label_col).cast("double")).alias(f"_c{i}")
                      for i, c in enumerate(cols)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("corr"),
                 F.coalesce(F.abs(F.col(f"_c{i}")) > threshold, F.lit(False)).alias("flagged"))
        for i, c in enumerate(cols)])))


EXPECTED_RECIPE_COLS = ["name", "recipe_id", "minutes", "tags", "nutrition", "n_steps", "n_ingredients",
                        "ingredients", "description"]
EXPECTED_INTER_COLS = ["user_id", "recipe_id", "date", "rating"]
