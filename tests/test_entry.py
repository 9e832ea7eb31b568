"""The driver contract: entry() and every registered query at sf0.001, and
the DuckDB oracle agreement for every query that has one."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
# Minutes of small tree fits whatever the data; test_model_checks runs the same job with small grids
# (and test_jobs the taste clusters).
SLOW = {"boost_search", "classifier_report", "taste_clusters"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else float(f"{v:.9g}"))
    return v


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_type", "host", "n_requests", "rank", "pct"]


def test_every_query_has_a_contract():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 30


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql())))
def test_oracle_agreement(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    ours = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = {c: i for i, c in enumerate(rel.columns)}
    theirs = sorted(repr(tuple(_norm(r[idx[c]]) for c in cols)) for r in rel.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - SLOW))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() > 0


@pytest.mark.parametrize("name", ["log_parse", "calendar_parts", "dense_grid", "temporal_split"])
def test_results_do_not_depend_on_session_time_zone(spark, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        test_oracle_agreement(spark, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
