from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rateprofile.operators.exposure import exposure, session_end

SEG_SCHEMA = "match_id long, player_id long, role string, from_min double, to_min double"


def _segs(spark, rows):
    return spark.createDataFrame(rows, SEG_SCHEMA)


def _ends(spark, rows):
    return spark.createDataFrame(rows, "match_id long, session_end double")


def test_session_end_modes(spark):
    ev = spark.createDataFrame([(1, 47, 10), (1, 46, 59), (2, 90, 0)], "match_id long, minute int, second int")
    ref = {r.match_id: r.session_end for r in session_end(ev, "match_id").collect()}
    exact = {r.match_id: r.session_end for r in session_end(ev, "match_id", mode="exact").collect()}
    assert abs(ref[1] - (47 + 59 / 60)) < 1e-12  # two independent maxima
    assert abs(exact[1] - (47 + 10 / 60)) < 1e-12
    assert ref[2] == exact[2] == 90.0


def test_exposure_cases(spark):
    segs = _segs(
        spark,
        [
            (1, 10, "GK", 0.0, None),  # open end -> session end 95
            (1, 11, "CB", 0.0, 45.0),  # closed end
            (1, 12, "LB", 0.0, 30.0),  # role change, contiguous
            (1, 12, "LW", 30.0, None),
            (1, 13, "CM", 0.0, 45.98),  # gap: span counts the time off
            (1, 13, "CM", 47.0, 47.02),
            (1, 14, "RB", 10.0, 20.0),  # equal time in two roles: smaller label wins
            (1, 14, "CB", 20.0, 30.0),
            (1, 15, "ST", 50.0, 40.0),  # to before from: clamped
            (1, 16, None, None, None),  # unused substitute: dropped
        ],
    )
    out = {
        r.player_id: r
        for r in exposure(segs, "match_id", "player_id", ends=_ends(spark, [(1, 95.0)])).collect()
    }
    assert set(out) == {10, 11, 12, 13, 14, 15}
    assert out[10].exposure == 95.0 and out[10].primary_role == "GK"
    assert out[11].exposure == 45.0
    assert out[12].exposure == 95.0 and out[12].primary_role == "LW"
    assert abs(out[13].exposure - 47.02) < 1e-9
    assert out[14].primary_role == "CB"
    assert out[15].exposure == 0.0
    summed = {
        r.player_id: r.exposure
        for r in exposure(segs, "match_id", "player_id", ends=_ends(spark, [(1, 95.0)]), mode="sum_segments").collect()
    }
    assert abs(summed[13] - (45.98 + 0.02)) < 1e-9
    assert summed[15] == 0.0


def _brute(rows, ends):
    by = defaultdict(list)
    for m, p, role, f, t in rows:
        if role is not None:
            by[(m, p)].append((role, f, ends.get(m) if t is None else t))
    out = {}
    for key, segs in by.items():
        tos = [t for _, _, t in segs if t is not None]
        froms = [f for _, f, _ in segs if f is not None]
        span = max(max(tos) - min(froms), 0.0) if tos and froms else 0.0
        w = defaultdict(lambda: None)
        for role, f, t in segs:
            if t is not None and f is not None:
                w[role] = (w[role] or 0.0) + (t - f)
        roles = sorted({r for r, _, _ in segs}, key=lambda r: (-(w[r] if w[r] is not None else float("-inf")), r))
        out[key] = (round(span, 6), roles[0])
    return out


SEG = st.tuples(
    st.integers(1, 3),  # session 3 has no known end
    st.integers(1, 4),
    st.sampled_from(["A", "B", "C"]),
    st.one_of(st.integers(0, 90).map(float), st.just(None)),  # None: a malformed start clock
    st.one_of(st.none(), st.integers(0, 95).map(float)),
)


@settings(max_examples=25, deadline=None)
@given(st.lists(SEG, min_size=1, max_size=25))
def test_pushed_down_open_end_fill_matches_row_level(spark, rows):
    ends = {1: 93.0, 2: 96.5}
    segs = _segs(spark, rows)
    fast = exposure(segs, "match_id", "player_id", ends=_ends(spark, list(ends.items())))
    # an explicit weight forces the row-level fill (join first, aggregate after)
    slow = exposure(
        segs,
        "match_id",
        "player_id",
        ends=_ends(spark, list(ends.items())),
        role_weight=F.col("to_min") - F.col("from_min"),
    )
    f = {(r.match_id, r.player_id): (round(r.exposure, 6), r.primary_role) for r in fast.collect()}
    s = {(r.match_id, r.player_id): (round(r.exposure, 6), r.primary_role) for r in slow.collect()}
    assert f == s == _brute(rows, ends)
