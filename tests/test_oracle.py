"""Every query with an SQL oracle matches DuckDB on the same tables (values, rows, types)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ["events", "documents", "conversations", "orders", "lineitem", "customer", "supplier", "part", "nation", "region"]
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    return str(v).replace("T", " ")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(sdf.columns) == sorted(rel.columns)
    st = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    dt = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    assert st == dt
    cols = sorted(sdf.columns)
    srows = sorted(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    idx = [rel.columns.index(c) for c in cols]
    drows = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert srows == drows


def test_every_query_has_entry_or_reason():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    rows_only = {q for q in set(qs) - set(orc) if q != "pipeline" and not q.startswith("op")}   # those have tests of their own
    # numeric fits and the tables built on them have no SQL form
    assert rows_only <= {"seasonal_grid_search", "seasonal_forecast", "seasonal_residuals", "sequence_regressor",
                         "residual_corrector", "recursive_forecast", "hybrid_forecast", "union_metrics",
                         "leaderboard", "metric_winners", "overall_winner", "model_grades", "improvement_pct",
                         "seasonal_grid_search_by_type", "hybrid_forecast_by_type",
                         "seasonal_forecast_recursive", "hybrid_forecast_sample"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["hour_timestamp", "request_count", "total_bytes", "prev_count"]
