"""Driver contract, oracle agreement on the small fixture, streaming = batch."""

import duckdb
import pytest

from conftest import SF_SMALL
from pantry.sources.tables import BASE_TABLES

ORACLE_SAMPLE = ["recipe_stats", "recipe_filter_tight", "enrich_recipes", "training_table", "time_split",
                 "ndcg_exp_per_user", "fairness_groups", "dq_rule_suite", "rule_candidates", "ks_drift",
                 "error_rate_5m", "alert_sustained", "sink_upsert", "user_feature_lookup"]


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 100


def _norm_rows(cols, rows):
    from tools.oracle_check import norm
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr([norm(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", ORACLE_SAMPLE)
def test_oracle_agreement(spark, duck, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm_rows(df.columns, [tuple(r) for r in df.collect()]) == _norm_rows(dcols, cur.fetchall())


def test_streaming_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    a = q["error_rate_5m_stream"](spark, SF_SMALL)
    b = q["error_rate_5m"](spark, SF_SMALL)
    assert sorted(map(tuple, a.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))
