"""The SQL of the registered queries of ``llm`` against the queries, on the small tables."""

import math
import sys

import duckdb
import pytest
from llm_fixtures import SF_SMALL, llm  # noqa: F401 (fixture)

from rateprofile.llm.queries import ORACLE, QUERIES


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted(repr(tuple(value(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(llm, name):  # noqa: F811
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](llm, SF_SMALL)
    got = con.execute(ORACLE[name])
    columns = [d[0] for d in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(columns, got.fetchall())


def test_each_operator_is_registered_once(llm):  # noqa: F811
    import __spark_entry__ as entry

    names = list(entry.queries())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_library_does_not_import_llm():
    from pathlib import Path

    root = Path(sys.modules["rateprofile"].__file__).parent
    for f in root.rglob("*.py"):
        if "llm" not in f.parts:
            assert "llm" not in f.read_text(), f
