"""Registered queries against their DuckDB oracles on the smallest tables
(the driver's gate runs the full set at sf0.01)."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from plover.plans.tables import TABLES

SF = "/root/testdata/sf0.001"
CHECKED = ["latest_file", "reference_sample", "top2_checkpoints", "best_checkpoint_trial",
           "halving_survivors", "run_records_flat", "load_split_counts",
           "retrain_metric_prefixes", "dated_export", "decision_sidecar", "latest_metadata",
           "batch_score", "continue_boosting", "successive_halving", "weekly_job",
           "catalog_fallback", "source_builders", "run_log", "full_refit"]


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _lines(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols, rows = df.columns, df.collect()
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    assert _lines(cols, rows) == _lines(dcols, res.fetchall())
