import json

from pyspark.sql import functions as F

from rateprofile.functions.predicates import event_counters
from rateprofile.operators.counts import conditional_counts
from rateprofile.sources.json_sources import flatten_events
from rateprofile.sources.schemas import EVENT_SCHEMA

P = {"id": 7, "name": "Seven"}


def _events(spark, records):
    lines = [json.dumps(r) for r in records]
    raw = spark.read.schema(EVENT_SCHEMA).json(spark.sparkContext.parallelize(lines)).withColumn(
        "match_id", F.lit(1).cast("long")
    )
    return flatten_events(raw)


def _ev(t, **kw):
    base = {"id": "x", "period": 1, "minute": 1, "second": 0, "type": {"name": t}, "player": P}
    base.update(kw)
    return base


RECORDS = [
    _ev("Half Start", player=None),  # no player: not counted at all
    _ev("Pass", location=[70.0, 10.0], **{"pass": {"end_location": [80.0, 10.0]}}),  # advance exactly 10
    _ev("Pass", location=[10.0, 10.0], **{"pass": {"end_location": [30.0, 10.0], "outcome": {"name": "Incomplete"}}}),
    _ev("Pass", location=[50.0, 10.0], **{"pass": {"end_location": [55.0, 10.0], "shot_assist": True}}),
    _ev("Pass", location=[50.0, 10.0], **{"pass": {"end_location": [45.0, 10.0], "goal_assist": True, "aerial_won": True}}),
    _ev("Pass"),  # no location at all
    _ev("Shot", location=[80.0, 40.0], shot={"outcome": {"name": "Goal"}, "aerial_won": True}),  # x exactly 80
    _ev("Shot", location=[100.0, 40.0], shot={"outcome": {"name": "Saved"}}),
    _ev("Dribble", dribble={"outcome": {"name": "Complete"}}),
    _ev("Dribble", dribble={"outcome": {"name": "Incomplete"}}),
    _ev("Duel", duel={"type": {"name": "Tackle"}, "outcome": {"name": "Success In Play"}}),
    _ev("Duel", duel={"type": {"name": "Tackle"}, "outcome": {"name": "Lost In Play"}}),
    _ev("Duel", duel={"type": {"name": "Aerial Lost"}}),
    _ev("Interception", interception={"outcome": {"name": "Lost"}}),
    _ev("Clearance", clearance={"aerial_won": True}),
    _ev("Miscontrol", miscontrol={"aerial_won": True}),
    _ev("Pressure", location=[90.0, 5.0]),
    _ev("Goal Keeper", goalkeeper={"type": {"name": "Shot Faced"}}),
    _ev("Goal Keeper", goalkeeper={"type": {"name": "Shot Saved to Post"}}),
    _ev("Goal Keeper", goalkeeper={"type": {"name": "Punch"}}),
    _ev("Goal Keeper", goalkeeper={"type": {"name": "Collected"}}),
    _ev("Goal Keeper", goalkeeper={"type": {"name": "Keeper Sweeper"}}),
]


def test_event_counters_on_edge_rows(spark):
    ev = _events(spark, RECORDS)
    out = conditional_counts(ev, ["match_id", "player_id"], event_counters(), require_not_null=["player_id"]).collect()
    assert len(out) == 1
    r = out[0].asDict()
    assert r["total_events"] == len(RECORDS) - 1
    assert r["passes_attempted"] == 5
    assert r["passes_completed"] == 4
    assert r["progressive_passes"] == 1  # exactly 10 counts; the incomplete +20 does not
    assert r["key_passes"] == 2
    assert r["shots"] == 2 and r["goals"] == 1
    assert r["dribble_attempts"] == 2 and r["dribbles_completed"] == 1
    assert r["tackles_won"] == 1
    assert r["interceptions"] == 1  # outcome ignored
    assert r["aerial_duels_won"] == 4  # one flag on each of the four carriers
    assert r["pressures"] == 1
    assert r["attacking_third_touches"] == 3  # shots at x == 80 and x == 100, the pressure at 90
    assert r["gk_shots_faced"] == 1 and r["gk_shots_saved"] == 1
    assert r["gk_claims"] == 2 and r["gk_sweeper_actions"] == 1


def test_counters_are_zero_not_null_when_flags_absent(spark):
    ev = _events(spark, [_ev("Pass", location=[1.0, 1.0], **{"pass": {"end_location": [2.0, 1.0]}})])
    r = conditional_counts(ev, ["player_id"], event_counters()).first().asDict()
    assert r["key_passes"] == 0 and r["aerial_duels_won"] == 0


def test_zone_event_types_parameter(spark):
    ev = _events(spark, [_ev("Pressure", location=[95.0, 1.0]), _ev("Pass", location=[95.0, 1.0])])
    r = conditional_counts(ev, ["player_id"], event_counters(zone_event_types=["Pass"])).first()
    assert r["attacking_third_touches"] == 1


def test_aerial_balance_invariant(spark, football_dir):
    """Won aerials are flags on four carrier event types; the loser of each one
    is a Duel of type "Aerial Lost". Over a whole fixture the two counts agree."""
    from rateprofile.sources.json_sources import load_events

    ev = load_events(spark, f"{football_dir}/events/*.json")
    won = conditional_counts(ev, ["match_id"], event_counters(), require_not_null=["player_id"])
    total_won = won.agg(F.sum("aerial_duels_won")).first()[0]
    lost = ev.filter((F.col("type_name") == "Duel") & (F.col("duel_type_name") == "Aerial Lost")).count()
    assert total_won == lost > 0
