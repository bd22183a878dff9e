from pyspark.sql import functions as F

from rateprofile.functions.columns import (
    array_head,
    clamp_min,
    clock_to_minutes,
    contains_any,
    label_family,
    minutes_to_clock,
    safe_ratio,
)
from rateprofile.functions.predicates import POSITION_FAMILY_RULES


def test_clock_parse_is_ansi_safe(spark):
    df = spark.createDataFrame(
        [("45:30",), ("00:00",), ("95:06",), ("4500",), (None,), ("ab:cd",), ("47:01",)], "c string"
    )
    got = [r[0] for r in df.select(clock_to_minutes("c")).collect()]
    assert got[0] == 45.5 and got[1] == 0.0 and abs(got[2] - 95.1) < 1e-12
    assert got[3] is None and got[4] is None and got[5] is None
    assert abs(got[6] - (47 + 1 / 60)) < 1e-12


def test_clock_format_round_trip(spark):
    df = spark.createDataFrame([(125, 7), (0, 0), (9, 59)], "m int, s int")
    out = df.select(minutes_to_clock("m", "s").alias("c")).select("c", clock_to_minutes("c").alias("x")).collect()
    assert [r.c for r in out] == ["125:07", "0:00", "9:59"]
    assert abs(out[0].x - (125 + 7 / 60)) < 1e-12


def test_safe_ratio_and_clamp(spark):
    df = spark.createDataFrame([(3, 4), (1, 0), (1, -2), (2, None)], "n long, d long")
    got = [r[0] for r in df.select(safe_ratio("n", "d")).collect()]
    assert got == [0.75, None, None, None]
    assert [r[0] for r in spark.createDataFrame([(-1.5,), (2.0,)], "x double").select(clamp_min("x")).collect()] == [
        0.0,
        2.0,
    ]


def test_contains_any_case(spark):
    df = spark.createDataFrame([("Ana Quill",), ("quill jr",), ("Other",)], "n string")
    assert df.filter(contains_any("n", ["Quill"])).count() == 1
    assert df.filter(contains_any("n", ["Quill"], ignore_case=True)).count() == 2
    assert df.filter(contains_any("n", [])).count() == 0


def test_position_family_rule_order(spark):
    cases = [
        ("Goalkeeper", "GK"),
        ("Left Wing Back", "DEF"),
        ("Center Back", "DEF"),
        ("Right Wing", "FWD"),
        ("Center Attacking Midfield", "FWD"),
        ("Center Forward", "FWD"),
        ("Left Midfield", "MID"),
        ("Center Defensive Midfield", "MID"),
        (None, "OTHER"),
        ("Substitute", "OTHER"),
    ]
    df = spark.createDataFrame(cases, "label string, expected string")
    got = df.select("expected", label_family("label", POSITION_FAMILY_RULES).alias("f")).collect()
    assert all(r.expected == r.f for r in got)


def test_array_head_null_safe(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([],), (None,)], "a array<double>")
    assert [r[0] for r in df.select(array_head("a", 0)).collect()] == [1.0, None, None]
    assert [r[0] for r in df.select(array_head(F.col("a"), 5)).collect()] == [None, None, None]
