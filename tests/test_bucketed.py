"""Bucketed tables: no shuffle above them, and the same rows from another declaration."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from rateprofile.operators import counts, exposure
from rateprofile.queries import ev
from rateprofile.sources import open_bucketed, write_bucketed


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture
def large(spark):
    """Tables too large to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_exposure_and_features_without_exchange(large):
    for make, plain in ((ev.bucketed_exposure, lambda s, d: ev.ev_exposure(ev.ev_events(s, d))), (ev.bucketed_features, ev.ev_features)):
        df = make(large, SF_SMALL)
        plan = _plan(df)
        assert "Exchange" not in plan and "Bucketed: true" in plan, plan
        assert "Exchange" in _plan(plain(large, SF_SMALL))
        assert rows(df.select(*[F.round(c, 6) if t == "double" else F.col(c) for c, t in df.dtypes])) == rows(
            plain(large, SF_SMALL).select(*[F.round(c, 6) if t == "double" else F.col(c) for c, t in df.dtypes])
        )


def test_counts_on_more_keys_than_the_bucket(large, scratch):
    e = ev.ev_events(large, SF_SMALL)
    by_day = write_bucketed(e, f"{scratch}/b", ["day"], 4, sort=["day", "user_id"])
    got = counts.conditional_counts(by_day, ["day", "user_id"], ev.ev_counters())
    assert "Exchange" not in _plan(got)
    assert rows(got) == rows(ev.ev_counts(e))
    # one file per bucket at most
    assert len(set(r[0] for r in by_day.select(F.input_file_name()).distinct().collect())) <= 4


def test_opened_again(large, scratch):
    e = ev.ev_events(large, SF_SMALL).select("day", "user_id", "value")
    first = write_bucketed(e, f"{scratch}/b", ["day"], 4)
    again = open_bucketed(large, f"{scratch}/b", first.schema, ["day"], 4)
    both = again.groupBy("day").agg(F.sum("value").alias("a")).join(first.groupBy("day").agg(F.count("*").alias("n")), "day")
    assert "Exchange" not in _plan(both)
    assert both.agg(F.sum("n")).first()[0] == e.count() and rows(again) == rows(e)


def test_session_ends_of_both_tables_meet_without_exchange(large, scratch):
    e = ev.ev_events(large, SF_SMALL)
    segments = write_bucketed(ev.ev_segments(e), f"{scratch}/s", ["day"], 4)
    clocks = write_bucketed(e.select("day", "minute", "second"), f"{scratch}/c", ["day"], 4)
    filled = exposure.fill_open_ends(segments, ev.ev_session_end(clocks), "day")
    assert "Exchange" not in _plan(filled)
    assert filled.filter("to_min is null").count() == 0
