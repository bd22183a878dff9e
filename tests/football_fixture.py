"""Invented football data in the input shapes of the event-log model.

Writes ``events/{match_id}.json``, ``lineups/{match_id}.json`` (JSON arrays)
and ``matches/{competition_id}/{season_id}.json``. Everything is generated from
a fixed seed; names and ids are made up.
"""

from __future__ import annotations

import json
import os
import random

COHORTS = {  # (competition_id, season_id): (teams, year)
    (901, 1): ((1, 2, 3, 4), 2022),
    (902, 1): ((5, 6, 7, 8), 2023),
    (903, 2): ((1, 2, 3, 4), 2023),
    (904, 2): ((5, 6, 7, 8), 2024),
}
TRAIN = [(901, 1), (902, 1)]
TEST = [(903, 2), (904, 2)]

STARTERS = [
    "Goalkeeper",
    "Center Back",
    "Center Back",
    "Left Back",
    "Right Wing Back",
    "Center Defensive Midfield",
    "Left Midfield",
    "Right Midfield",
    "Center Forward",
    "Right Wing",
    "Center Attacking Midfield",
]
BENCH = ["Goalkeeper", "Left Center Back", "Center Midfield", "Left Wing", "Center Forward"]

TYPE_WEIGHTS = [
    ("Pass", 45),
    ("Pressure", 14),
    ("Ball Receipt*", 10),
    ("Duel", 5),
    ("Dribble", 4),
    ("Shot", 3),
    ("Interception", 3),
    ("Clearance", 3),
    ("Miscontrol", 2),
]


def _clock(m: float) -> str:
    return f"{int(m):02d}:{int(round((m - int(m)) * 60)) % 60:02d}"


def _players(team: int):
    roster = STARTERS + BENCH
    return [
        {
            "player_id": team * 100 + i,
            "player_name": f"Player {team}-{i:02d}" + (" Star" if (team, i) in ((1, 8), (5, 9)) else ""),
            "position": pos,
        }
        for i, pos in enumerate(roster)
    ]


def _lineup(team: int, rng: random.Random):
    players = _players(team)
    lineup = []
    sub_minute = rng.choice([55, 60, 65, 70])
    for i, p in enumerate(players):
        if i < 11:
            if i == 10:  # replaced by a bench forward
                segs = [(p["position"], "00:00", _clock(sub_minute))]
            elif i == 7:  # role change, contiguous
                segs = [(p["position"], "00:00", "30:00"), ("Left Wing", "30:00", None)]
            else:
                segs = [(p["position"], "00:00", None)]
        elif i == 14:
            segs = [(p["position"], _clock(sub_minute), None)]
        else:
            segs = []  # unused substitute
        lineup.append(
            {
                "player_id": p["player_id"],
                "player_name": p["player_name"],
                "player_nickname": None,
                "jersey_number": i + 1,
                "country": {"id": 1, "name": "Nowhere"},
                "cards": [],
                "positions": [
                    {
                        "position_id": k + 1,
                        "position": pos,
                        "from": frm,
                        "to": to,
                        "from_period": 1,
                        "to_period": None if to is None else 2,
                        "start_reason": "Starting XI",
                        "end_reason": "Final Whistle",
                    }
                    for k, (pos, frm, to) in enumerate(segs)
                ],
            }
        )
    return {"team_id": team, "team_name": f"Team {team}", "lineup": lineup}, sub_minute


def _on_pitch(team: int, minute: int, sub_minute: int):
    players = _players(team)
    out = []
    for i, p in enumerate(players[:11]):
        if i == 10 and minute >= sub_minute:
            continue
        out.append((p, "Left Wing" if i == 7 and minute >= 30 else p["position"]))
    if minute >= sub_minute:
        out.append((players[14], players[14]["position"]))
    return out


def _event(rng, idx, minute, team, player, position):
    types, weights = zip(*TYPE_WEIGHTS)
    etype = "Goal Keeper" if position == "Goalkeeper" and rng.random() < 0.5 else rng.choices(types, weights)[0]
    x = round(rng.uniform(0, 120), 1)
    ev = {
        "id": f"e{idx}",
        "period": 1 if minute < 45 else 2,
        "minute": minute,
        "second": rng.randrange(60),
        "type": {"name": etype},
        "team": {"id": team, "name": f"Team {team}"},
        "player": {"id": player["player_id"], "name": player["player_name"]},
        "position": {"name": position},
        "location": [x, round(rng.uniform(0, 80), 1)],
    }
    if etype == "Pass":
        end_x = round(min(120.0, max(0.0, x + rng.uniform(-15, 30))), 1)
        ev["pass"] = {"recipient": {"id": 1}, "length": 10.0, "end_location": [end_x, 40.0]}
        if rng.random() < 0.2:
            ev["pass"]["outcome"] = {"name": "Incomplete"}
        if rng.random() < 0.05:
            ev["pass"]["shot_assist"] = True
        if rng.random() < 0.05:
            ev["pass"]["aerial_won"] = True
    elif etype == "Shot":
        ev["shot"] = {"outcome": {"name": rng.choice(["Goal", "Saved", "Off T"])}, "statsbomb_xg": 0.1}
    elif etype == "Dribble":
        ev["dribble"] = {"outcome": {"name": rng.choice(["Complete", "Incomplete"])}}
    elif etype == "Duel":
        kind = "Tackle"  # "Aerial Lost" duels are emitted opposite every won aerial
        ev["duel"] = {"type": {"name": kind}}
        if kind == "Tackle":
            ev["duel"]["outcome"] = {"name": rng.choice(["Won", "Lost In Play", "Success In Play"])}
    elif etype == "Interception":
        ev["interception"] = {"outcome": {"name": "Won"}}
    elif etype == "Clearance":
        ev["clearance"] = {"aerial_won": rng.random() < 0.3}
    elif etype == "Goal Keeper":
        ev["goalkeeper"] = {
            "type": {"name": rng.choice(["Shot Faced", "Shot Saved", "Collected", "Punch", "Keeper Sweeper"])}
        }
    return ev


def write_football_fixture(root: str, seed: int = 7, events_per_minute: int = 4) -> dict:
    rng = random.Random(seed)
    for sub in ("events", "lineups", "matches"):
        os.makedirs(os.path.join(root, sub), exist_ok=True)
    match_id = 3000
    matches_by_cohort = {}
    for (comp, season), (teams, year) in COHORTS.items():
        matches = []
        for a in range(len(teams)):
            for b in range(a + 1, len(teams)):
                match_id += 1
                home, away = teams[a], teams[b]
                matches.append({"match_id": match_id, "match_date": f"{year}-0{1 + len(matches) % 9}-15"})
                lineups, subs = [], {}
                for t in (home, away):
                    lu, subs[t] = _lineup(t, rng)
                    lineups.append(lu)
                events = [{"id": "start", "period": 1, "minute": 0, "second": 0, "type": {"name": "Half Start"},
                           "team": {"id": home, "name": f"Team {home}"}}]
                idx = 0
                last_minute = 90 + rng.randrange(3, 7)
                for minute in range(0, last_minute + 1):
                    for _ in range(events_per_minute):
                        team = rng.choice((home, away))
                        player, position = rng.choice(_on_pitch(team, minute, subs[team]))
                        idx += 1
                        ev = _event(rng, idx, minute, team, player, position)
                        events.append(ev)
                        if any((ev.get(k) or {}).get("aerial_won") for k in ("pass", "shot", "clearance", "miscontrol")):
                            # the losing side of the same aerial: a Duel of type "Aerial Lost"
                            opp = away if team == home else home
                            loser, loser_pos = rng.choice(_on_pitch(opp, minute, subs[opp]))
                            idx += 1
                            events.append(
                                {
                                    "id": f"e{idx}",
                                    "period": ev["period"],
                                    "minute": minute,
                                    "second": ev["second"],
                                    "type": {"name": "Duel"},
                                    "team": {"id": opp, "name": f"Team {opp}"},
                                    "player": {"id": loser["player_id"], "name": loser["player_name"]},
                                    "position": {"name": loser_pos},
                                    "location": [120.0 - ev["location"][0], 80.0 - ev["location"][1]],
                                    "duel": {"type": {"name": "Aerial Lost"}},
                                }
                            )
                with open(os.path.join(root, "events", f"{match_id}.json"), "w") as f:
                    json.dump(events, f)
                with open(os.path.join(root, "lineups", f"{match_id}.json"), "w") as f:
                    json.dump(lineups, f)
        os.makedirs(os.path.join(root, "matches", str(comp)), exist_ok=True)
        with open(os.path.join(root, "matches", str(comp), f"{season}.json"), "w") as f:
            json.dump(matches, f)
        matches_by_cohort[(comp, season)] = [m["match_id"] for m in matches]
    return matches_by_cohort
