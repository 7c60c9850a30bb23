"""Registry of named queries: a Spark builder and (where SQL can say it) the
DuckDB oracle text that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixtures import duckdb_view_sql


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def _find_close(s: str, i: int) -> int:
    depth = 0
    while i < len(s):
        ch = s[i]
        if ch == "'":
            i = s.index("'", i + 1)
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0:
                return i
        i += 1
    raise ValueError("unbalanced parentheses")


def _split_last_arg(inner: str) -> tuple[str, str]:
    depth = 0
    for i in range(len(inner) - 1, -1, -1):
        ch = inner[i]
        if ch == ")":
            depth += 1
        elif ch == "(":
            depth -= 1
        elif ch == "," and depth == 0:
            return inner[:i], inner[i + 1:]
    return inner, ""


def half_up_rounding(sql: str) -> str:
    """Rewrite every ``round(e, d)`` of the oracle text to the same IEEE
    half-up form the Spark side uses (``pantry.functions.exprs.rnd``)."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        k = _find_close(sql, j + 5)
        expr, digits = _split_last_arg(sql[j + 6:k])
        expr = half_up_rounding(expr)
        d = int(digits.strip()) if digits.strip() else 0
        scale = f"{10 ** d}.0"
        out.append(sql[i:j])
        out.append(f"(CASE WHEN abs(CAST({expr} AS DOUBLE)) < 1e12 THEN floor(CAST({expr} AS DOUBLE) * {scale} + 0.5) "
                   f"/ {scale} ELSE round(CAST({expr} AS DOUBLE), {d}) END)")
        i = k + 1


def register(name: str, sql: str | None = None):
    """Decorator: ``@register("recipe_stats", sql=...)`` on ``f(spark, sf_dir)``."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, half_up_rounding(sql) if sql else None)
        return fn

    return deco


def with_views(*views: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH v1 AS (...), v2 AS (...), extra...`` prefix for the oracle SQL."""
    parts = [f"{v} AS ({duckdb_view_sql(v)})" for v in views]
    parts += [f"{n} AS ({s})" for n, s in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"
