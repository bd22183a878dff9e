from rateprofile.operators.features import Rate, Ratio, entity_features, majority_label

CNT = "match_id long, player_id long, shots long, goals long"
EXP = "match_id long, player_id long, minutes double, role string"
OUT = [Rate("shots"), Rate("goals"), Ratio("conversion", "goals", "shots")]


def test_rates_ratios_threshold_and_label(spark):
    counts = spark.createDataFrame(
        [(1, 1, 2, 1), (2, 1, 1, 0), (3, 1, 0, 0), (1, 2, 0, 0), (2, 2, 0, 0), (1, 3, 5, 5)], CNT
    )
    expo = spark.createDataFrame(
        [
            (1, 1, 90.0, "FW"),
            (2, 1, 90.0, "MF"),
            (3, 1, 90.0, "MF"),  # player 1: exactly 270 -> kept
            (1, 2, 135.0, "DF"),
            (2, 2, 134.99, "DF"),  # player 2: just below 270 -> dropped
            (1, 3, 300.0, "FW"),
            (1, 4, 400.0, "GK"),  # player 4: exposure but no counts -> dropped (inner join)
        ],
        EXP,
    )
    out = {
        r.player_id: r
        for r in entity_features(counts, expo, "player_id", OUT, exposure_col="minutes", label_col="role").collect()
    }
    assert set(out) == {1, 3}
    p1 = out[1]
    assert p1.total_exposure == 270.0 and p1.sessions == 3 and p1.label == "MF"
    assert abs(p1.shots_p90 - 1.0) < 1e-12 and abs(p1.conversion - 1 / 3) < 1e-12
    assert out[3].conversion == 1.0 and abs(out[3].goals_p90 - 1.5) < 1e-12


def test_zero_denominator_fill(spark):
    counts = spark.createDataFrame([(1, 1, 0, 0)], CNT)
    expo = spark.createDataFrame([(1, 1, 300.0, "X")], EXP)
    filled = entity_features(counts, expo, "player_id", OUT, exposure_col="minutes", label_col="role").first()
    raw = entity_features(counts, expo, "player_id", OUT, exposure_col="minutes", label_col="role", fill=None).first()
    assert filled.conversion == 0.0 and raw.conversion is None


def test_majority_label_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([(1, "MF"), (1, "DF"), (2, "FW"), (2, "FW"), (2, "DF")], "player_id long, role string")
    got = {r.player_id: r.label for r in majority_label(df, ["player_id"], "role").collect()}
    assert got == {1: "DF", 2: "FW"}


def test_split_as_grouping_key(spark):
    counts = spark.createDataFrame([(1, 1, 3, 1), (2, 1, 1, 1)], CNT).selectExpr(
        "*", "case when match_id = 1 then 'train' else 'test' end as split"
    )
    expo = spark.createDataFrame([(1, 1, 300.0, "A"), (2, 1, 300.0, "B")], EXP).selectExpr(
        "*", "case when match_id = 1 then 'train' else 'test' end as split"
    )
    out = {
        r.split: r
        for r in entity_features(
            counts, expo, "player_id", OUT, exposure_col="minutes", label_col="role", by=("split",)
        ).collect()
    }
    assert out["train"].shots_p90 == 3 / 300 * 90 and out["test"].label == "B"


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

SESSION = st.tuples(st.integers(1, 3), st.integers(0, 6), st.integers(0, 6), st.sampled_from(["A", "B", "C"]))


@settings(max_examples=10, deadline=None)
@given(st.lists(SESSION, min_size=1, max_size=12, unique_by=lambda t: t[0]), st.sampled_from([2.0, 3.0]))
def test_rate_properties(spark, sessions, factor):
    counts = spark.createDataFrame([(m, 1, s, g) for m, s, g, _ in sessions], CNT)
    expo = spark.createDataFrame([(m, 1, 100.0, r) for m, _, _, r in sessions], EXP)
    scaled = spark.createDataFrame([(m, 1, 100.0 * factor, r) for m, _, _, r in sessions], EXP)
    kw = dict(exposure_col="minutes", label_col="role", min_exposure=0.0)
    a = entity_features(counts, expo, "player_id", OUT, **kw).first()
    b = entity_features(counts, scaled, "player_id", OUT, **kw).first()
    total_shots = sum(s for _, s, _, _ in sessions)
    # totals are the sums of the session counters; rates scale inversely with exposure
    assert abs(a.shots_p90 - total_shots / (100.0 * len(sessions)) * 90) < 1e-9
    assert abs(a.shots_p90 - factor * b.shots_p90) < 1e-9
    # the label is one of the session labels, with the largest vote, smallest on ties
    votes = {}
    for _, _, _, r in sessions:
        votes[r] = votes.get(r, 0) + 1
    assert a.label == min(votes, key=lambda r: (-votes[r], r))
    assert a.sessions == len(sessions)


def test_cohort_intensity_denominator_modes(spark):
    from rateprofile.operators.assess import cohort_intensity

    sessions = spark.createDataFrame([(1, "C", 2022), (2, "C", 2023), (3, "D", 2023)], "m long, cohort string, year long")
    events = spark.createDataFrame([(1,), (1,), (2,), (3,)], "m long")
    expo = spark.createDataFrame([(1, 90.0), (1, 90.0), (2, 180.0), (3, 45.0)], "m long, exposure double")
    ref = {(r.cohort, r.year): r for r in cohort_intensity(events, expo, sessions, "m", "cohort", "year").collect()}
    # default rule: per (cohort, year) numerator over the whole cohort's exposure
    assert ref[("C", 2022)].n_events == 2 and ref[("C", 2022)].total_exposure == 360.0
    assert abs(ref[("C", 2022)].events_per_90 - 0.5) < 1e-12
    per = {
        (r.cohort, r.year): r
        for r in cohort_intensity(events, expo, sessions, "m", "cohort", "year", per_period_denominator=True).collect()
    }
    assert per[("C", 2022)].total_exposure == 180.0 and per[("C", 2023)].total_exposure == 180.0
    assert abs(per[("D", 2023)].events_per_90 - 2.0) < 1e-12


def test_zero_exposure_gives_null_rate_not_an_error(spark):
    counts = spark.createDataFrame([(1, 1, 2, 1)], CNT)
    expo = spark.createDataFrame([(1, 1, 0.0, "X")], EXP)
    r = entity_features(
        counts, expo, "player_id", OUT, exposure_col="minutes", label_col="role", min_exposure=0.0, fill=None
    ).first()
    assert r.shots_p90 is None and r.conversion == 0.5
