"""Plan-level guards over every registered query: no cross or nested-loop joins,
no Python UDF operators, column pruning into the scans, top-k operators where
expected."""

import contextlib
import io

import pytest

from conftest import SF_SMALL
from rateprofile.queries import QUERIES, ev

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
    "PythonUDF",
)
PLANS = {}


def _plan(spark, name):
    if name not in PLANS:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, SF_SMALL).explain(mode="formatted")
        PLANS[name] = buf.getvalue()
    return PLANS[name]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_or_python_operator(spark, name):
    plan = _plan(spark, name)
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"


def _text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _scans(plan):
    return [line for line in plan.splitlines() if line.startswith("ReadSchema")]


def test_flagship_reads_the_events_once(spark):
    summary = _text(ev.summarise(ev.ev_events(spark, SF_SMALL)))
    schemas = _scans(summary)
    assert len(schemas) == 1 and "props" not in schemas[0] and "event_id" not in schemas[0]
    assert summary.count("Exchange hashpartitioning") <= 1
    # all that follows reads the materialised summary
    for name in ("entity_features", "cohort_intensity", "profile_drift"):
        assert not _scans(_plan(spark, name)), name
    assert "WindowGroupLimit" in _plan(spark, "entity_features")


@pytest.mark.parametrize("name, scans", [("session_end", 1), ("segments_explode", 2), ("exposure_span", 2), ("exposure_sum_segments", 2), ("event_counters", 1)])
def test_scan_counts(spark, name, scans):
    assert len(_scans(_plan(spark, name))) == scans


def test_no_raw_rows_cross_an_exchange(spark):
    """With static broadcasts off, each exchange of these queries is fed by a partial aggregation."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("exposure_span", "exposure_with_role", "session_end"):
            buf = io.StringIO()
            with contextlib.redirect_stdout(buf):
                QUERIES[name](spark, SF_SMALL).explain()
            lines = buf.getvalue().splitlines()
            for i, line in enumerate(lines):
                if "Exchange hashpartitioning" in line:
                    assert "HashAggregate" in lines[i + 1] or "WindowGroupLimit" in lines[i + 1], (name, lines[i + 1])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_k_operators(spark):
    assert "WindowGroupLimit" in _plan(spark, "cluster_samples")
    assert "TakeOrderedAndProject" in _plan(spark, "most_blended")
