"""Registration, and a sample of queries against DuckDB on the smallest tables (tools/check.py runs them all)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from veriloom import catalog

# SQL cannot express these: seeded hashes and what rests on them
ROWS_ONLY = {"iforest_fit", "iforest_score", "permutation_importance"}
SAMPLE = ["validate_reference_range", "delta_check", "daily_quality_metrics", "unified_patient_view", "kpi_percentiles", "fraud_pipeline", "series_volatility",
          "consensus_trimmed", "queue_health", "recon_status", "cdc_apply", "lab_features", "phi_excessive_access", "recon_differing_rows"]


def test_every_query_is_checked_or_listed():
    own = catalog.QUERIES.keys()
    assert set(own) - set(entry.oracle_sql()) == ROWS_ONLY
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf}/{f}'")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_agrees_with_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    want = sorted(repr(tuple(r)) for r in cur.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*cols).collect()) == want


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
