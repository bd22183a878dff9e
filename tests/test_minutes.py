"""Minutes played and primary position from lineup-shaped JSON (FIXTURES F1)."""

import json
import os

from rateprofile.plans.common import player_minutes
from rateprofile.sources.json_sources import load_events, load_lineups

END = 93 + 59 / 60  # max(minute) + max(second) / 60 of the events below


def _seg(pos, frm, to, period=1):
    return {"position_id": 1, "position": pos, "from": frm, "to": to, "from_period": period,
            "to_period": None, "start_reason": "x", "end_reason": "y"}


def _player(pid, segs):
    return {"player_id": pid, "player_name": f"P{pid}", "player_nickname": None, "jersey_number": pid,
            "country": {"id": 1, "name": "C"}, "cards": [], "positions": segs}


LINEUP = [
    {
        "team_id": 1,
        "team_name": "One",
        "lineup": [
            _player(1, []),  # bench: no exposure row
            _player(2, [_seg("Goalkeeper", "00:00", None)]),  # open end -> match end
            _player(3, [_seg("Center Back", "00:00", "45:00")]),  # closed at a substitution
            _player(4, [_seg("Left Back", "00:00", "30:00"), _seg("Left Wing", "30:00", None)]),  # role change
            _player(5, [_seg("Right Back", "00:00", "45:59"), _seg("Right Back", "47:00", "47:01")]),  # gap
            _player(6, [_seg("Left Midfield", "00:00", "47:33"), _seg("Right Midfield", "45:00", None, 2)]),  # overlap
            _player(7, [_seg("Center Forward", "10:00", "20:00"), _seg("Center Back", "20:00", "30:00")]),  # tie
            _player(8, [_seg("Right Wing", "50:00", "40:00")]),  # to before from: clamp
            _player(9, [_seg("Center Midfield", "4500", "60:00"), _seg("Center Midfield", "50:00", "55:00")]),
        ],
    }
]
EVENTS = [
    {"id": "a", "period": 2, "minute": 93, "second": 10, "type": {"name": "Pass"}},
    {"id": "b", "period": 2, "minute": 92, "second": 59, "type": {"name": "Pass"}},
]


def test_player_minutes_edge_cases(spark, scratch):
    for sub, payload in (("lineups", LINEUP), ("events", EVENTS)):
        os.makedirs(f"{scratch}/{sub}")
        with open(f"{scratch}/{sub}/777.json", "w") as f:
            json.dump(payload, f)
    events = load_events(spark, f"{scratch}/events/*.json")
    lineups = load_lineups(spark, f"{scratch}/lineups/*.json")
    got = {r.player_id: r for r in player_minutes(events, lineups).collect()}
    assert set(got) == {2, 3, 4, 5, 6, 7, 8, 9}
    assert abs(got[2].minutes_played - END) < 1e-9 and got[2].primary_position == "Goalkeeper"
    assert got[3].minutes_played == 45.0
    assert abs(got[4].minutes_played - END) < 1e-9 and got[4].primary_position == "Left Wing"
    assert abs(got[5].minutes_played - (47 + 1 / 60)) < 1e-9  # span counts the time off the pitch
    assert abs(got[6].minutes_played - END) < 1e-9
    assert got[6].primary_position == "Right Midfield"  # END - 45 > 47.55
    assert got[7].primary_position == "Center Back"  # equal time: smaller label
    assert got[8].minutes_played == 0.0
    assert got[9].minutes_played == 60.0 - 50.0  # malformed start ignored, not an error
    assert all(r.match_id == 777 and r.team_name == "One" for r in got.values())
