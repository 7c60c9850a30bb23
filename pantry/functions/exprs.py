"""Column expressions (JVM-side, inside whole-stage codegen; no Python UDFs).

Each function returns a ``Column`` built from ``pyspark.sql.functions`` so the
caller composes it into ``select``/``withColumn``/``agg``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_string_list(c) -> Column:
    """Python list literal text -> array<string>; malformed or NULL -> [].

    ``from_json`` accepts single-quoted items (allowSingleQuotes) and apostrophes
    inside double-quoted ones.  Tuples, a trailing comma and ``\\xNN`` escapes are
    put in JSON's form first.
    """
    text = F.regexp_replace(F.trim(_col(c)), r"^\((.*)\)$", "[$1]")
    text = F.regexp_replace(text, r",\s*\]$", "]")
    text = F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    parsed = F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})
    return F.coalesce(parsed, F.array().cast("array<string>"))


def parse_double_list(c) -> Column:
    """Python list literal of numbers -> array<double>; malformed -> NULL.

    Python's ``None`` is normalised to JSON ``null`` first.
    """
    text = F.regexp_replace(_col(c), r"\bNone\b", "null")
    return F.from_json(text, "array<double>", {"allowSingleQuotes": "true"})


def nutrition_field(arr: Column, i: int) -> Column:
    """i-th nutrition value; the whole row is NULL when the list has < 7 items."""
    return F.when(F.size(arr) >= len(vocab.NUTRITION_FIELDS), F.get(arr, i))


def cuisine_first_match(tags_array) -> Column:
    """First tag (list order, lower-cased) present in the cuisine map, else 'unknown'."""
    m = F.create_map(*[F.lit(x) for kv in vocab.CUISINE_MAP.items() for x in kv])
    mapped = F.transform(_col(tags_array), lambda t: F.try_element_at(m, F.lower(t)))
    hits = F.filter(mapped, lambda x: x.isNotNull())
    return F.coalesce(F.get(hits, 0), F.lit("unknown"))


def allergen_flag(ingredients_array, allergen: str) -> Column:
    """1 if any ingredient contains any keyword of ``allergen`` as a substring."""
    kws = vocab.ALLERGEN_KEYWORDS[allergen]

    def hit(i):
        li = F.lower(i)
        out = None
        for k in kws:
            cond = li.contains(k)
            out = cond if out is None else (out | cond)
        return out

    return F.exists(_col(ingredients_array), hit).cast("int")


def allergen_list(ingredients_array) -> Column:
    """Detected allergens as a sorted array<string> (the reference's list column)."""
    flags = [F.when(allergen_flag(ingredients_array, a) == 1, F.lit(a))
             for a in vocab.ALLERGENS_SORTED]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def label_from_rating(rating="rating", threshold: int = vocab.POSITIVE_RATING) -> Column:
    """int(rating >= threshold); a NULL or NaN rating is a negative (pandas semantics)."""
    r = _col(rating).cast("double")
    return F.when(F.isnan(r), F.lit(0)).otherwise(F.coalesce((r >= F.lit(float(threshold))).cast("int"), F.lit(0)))


def stable_id(c) -> Column:
    """Positive 31-bit surrogate of a string id: first 4 bytes of SHA-256, big-endian."""
    h = F.conv(F.substring(F.sha2(_col(c).cast("string"), 256), 1, 8), 16, 10)
    return h.cast("bigint").bitwiseAND(F.lit(2147483647)).cast("bigint")


def id_collisions(df: DataFrame, c: str, bits: int = 31) -> DataFrame:
    """surrogate, n_ids, first_id, last_id of surrogates (their lowest ``bits``) that
    more than one id shares: what a job must know before it joins on surrogates."""
    ids = df.select(F.col(c).cast("string").alias("id")).where("id is not null").distinct()
    surrogate = stable_id("id").bitwiseAND(F.lit((1 << bits) - 1)).alias("surrogate")
    return ids.groupBy(surrogate).agg(F.count(F.lit(1)).alias("n_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id")).where("n_ids > 1")


def meal_context(ts) -> Column:
    """Hour of day -> breakfast [5,10), lunch [10,14), dinner [18,22), else snack."""
    h = F.hour(_col(ts))
    return (F.when((h >= 5) & (h < 10), "breakfast")
            .when((h >= 10) & (h < 14), "lunch")
            .when((h >= 18) & (h < 22), "dinner")
            .otherwise("snack"))


def rnd(c, d: int = 0) -> Column:
    """Round half up with plain IEEE arithmetic: floor(x * 10^d + 0.5) / 10^d.

    Unlike ``round`` (which rounds the decimal text of the double), this gives
    bit-identical results on every engine.  |x| >= 1e12 falls back to round().
    """
    x = _col(c).cast("double")
    scale = float(10 ** d)
    return (F.when(F.abs(x) < F.lit(1e12), F.floor(x * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))
            .otherwise(F.round(x, d)))


def js_round(c) -> Column:
    """JavaScript Math.round: floor(x + 0.5)."""
    return F.floor(_col(c).cast("double") + F.lit(0.5))


def round6(c) -> Column:
    return rnd(c, 6)


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise)."""
    return _col(num) / F.nullif(_col(den), F.lit(0))


def scalar_of(one_row: DataFrame, value: Column, like: DataFrame, col: str) -> Column:
    """The single value of a one-row frame with the type of ``like``'s column, as a
    scalar subquery: a comparison of the bare column with it reaches the scan."""
    return one_row.select(value.cast(like.schema[col].dataType)).scalar()


#: Parts of a number: hundred-millionths are counted in thousand millions and what is left.
_PART = 1_000_000_000


def whole_parts(df: DataFrame, c: str) -> dict[str, Column]:
    """Columns ``_hi_c`` and ``_lo_c``, long, of the numeric column ``c`` as DECIMAL(28,8)
    (NULL and NaN: 0), for sums that are exact and, unlike those of wide decimals, cheap;
    none for a column of whole numbers, whose sum is exact as it is."""
    kind = dict(df.dtypes)[c]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return {}
    value = F.nanvl(F.col(c), F.lit(None).cast(kind)) if kind in ("double", "float") else F.col(c)
    units = (F.coalesce(value.cast("decimal(28,8)"), F.lit(0)) * F.lit(10 ** 8)).cast("decimal(28,0)")
    low = units % F.lit(_PART)
    return {f"_hi_{c}": ((units - low) / F.lit(_PART)).cast("bigint"), f"_lo_{c}": low.cast("bigint")}


def sum_of_parts(df: DataFrame, c: str) -> Column:
    """The sum of ``c`` over rows that hold its ``whole_parts``; it fails where a sum of parts is no long."""
    if f"_hi_{c}" not in df.columns:
        return F.sum(c)
    return (F.sum(f"_hi_{c}").cast("decimal(19,0)") * F.lit(_PART) + F.sum(f"_lo_{c}")).cast("decimal(29,0)") * F.lit("0.00000001").cast("decimal(8,8)")
