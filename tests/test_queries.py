"""Every registered query against its DuckDB oracle on sf0.001, plus the entry
smoke check and the shape of the model-fit queries."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from rateprofile.queries import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["user_id", "label", "exposure_min", "days_seen"]
    rows = df.collect()
    assert len(rows) > 10 and len({r.user_id for r in rows}) == len(rows)
    rates = [c for c in df.columns if c not in ("user_id", "label", "days_seen")]
    assert all(r[c] is not None and r[c] >= 0 for r in rows for c in rates)
    assert all(any(r[c] > 0 for r in rows) for c in rates)


def test_every_query_is_registered():
    assert len(QUERIES) >= 45
    assert set(ORACLE) <= set(QUERIES)
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"global_clusters", "gmm_assign", "models_side_by_side", "model_compare", "saved_mixture_assign"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _canon(df.columns, s_rows) == _canon(d_cols, d_rows)
    d_types = dict(zip(d_cols, [t[1] for t in duck.execute(f"describe {ORACLE[name]}").fetchall()]))
    for f in df.schema.fields:
        assert DUCK_TYPE[f.dataType.simpleString()] == d_types[f.name], (f.name, f.dataType, d_types[f.name])


@pytest.mark.parametrize("name", ["gmm_assign", "saved_mixture_assign"])
def test_model_queries_shape(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0 and df.filter(" or ".join(f"{c} is null" for c in df.columns)).count() == 0


def test_entry_without_a_package_of_the_training_data_queries(monkeypatch):
    import sys

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("rateprofile.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    assert entry._training_data() == ({}, {})
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLE)
