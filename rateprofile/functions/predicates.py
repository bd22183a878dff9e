"""Event predicates for the football event model (conditional counters E1-E17).

Each counter is a boolean Column over the flat event table produced by
``sources.json_sources.load_events``; ``operators.counts.conditional_counts``
turns a ``{name: predicate}`` map into one aggregation with ``count_if``.
A NULL predicate (missing flag, missing location) counts as false.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import LabelRule, array_head

# --- Fixed values: event vocabulary, thresholds and feature lists ------------------
# These must equal the event data's own names for the counters to be right.
PASS = "Pass"
SHOT = "Shot"
DRIBBLE = "Dribble"
DUEL = "Duel"
INTERCEPTION = "Interception"
PRESSURE = "Pressure"
GOAL = "Goal"
DRIBBLE_COMPLETE = "Complete"
TACKLE = "Tackle"
TACKLE_WON_OUTCOMES = ("Won", "Success", "Success In Play", "Success Out")
GK_SHOT_FACED = "Shot Faced"
GK_SHOT_SAVED = ("Shot Saved", "Shot Saved to Post", "Shot Saved Off Target")
GK_CLAIM = ("Collected", "Punch")
GK_SWEEPER = "Keeper Sweeper"
AERIAL_WON_FLAGS = ("pass_aerial_won", "shot_aerial_won", "clearance_aerial_won", "miscontrol_aerial_won")
PROGRESSIVE_MIN_ADVANCE = 10.0
ATTACKING_THIRD_X = 80.0
MIN_EXPOSURE_MINUTES = 270.0

GENERAL_FEATURES = (
    "passes_attempted_p90",
    "pass_completion_pct",
    "progressive_passes_p90",
    "key_passes_p90",
    "shots_p90",
    "shot_conversion_pct",
    "dribbles_completed_p90",
    "dribble_success_pct",
    "tackles_won_p90",
    "interceptions_p90",
    "aerial_duels_won_p90",
    "pressures_p90",
    "attacking_third_touches_p90",
)
GOALKEEPER_FEATURES = (
    "gk_shots_faced_p90",
    "gk_save_pct",
    "gk_claims_p90",
    "gk_sweeper_actions_p90",
    "passes_attempted_p90",
    "pass_completion_pct",
    "progressive_passes_p90",
)

# Position label -> family, tried in this order (so wing backs are DEF and
# attacking midfielders FWD); NULL or unmatched -> OTHER.
POSITION_FAMILY_RULES = (
    LabelRule("GK", equals=("Goalkeeper",)),
    LabelRule("DEF", contains=("Back",)),
    LabelRule("FWD", contains=("Forward", "Wing", "Attacking Midfield")),
    LabelRule("MID", contains=("Midfield",)),
)
# --- end of fixed values ------------------------------------------------------------


def _is(col: str, value: str) -> Column:
    return F.col(col) == value


def _flag(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(False))


def event_counters(
    progressive_min_advance: float = PROGRESSIVE_MIN_ADVANCE,
    zone_min_x: float = ATTACKING_THIRD_X,
    zone_event_types: Sequence[str] | None = None,
) -> dict[str, Column]:
    """The 17 conditional counters of the per-(session, entity) stats table.

    ``zone_event_types=None`` counts every event type whose start x reaches
    ``zone_min_x`` as a touch (pressures included), as the source model does.
    """
    start_x = array_head("location", 0)
    end_x = array_head("pass_end_location", 0)
    is_pass = _is("type_name", PASS)
    complete = is_pass & F.col("pass_outcome_name").isNull()
    is_shot = _is("type_name", SHOT)
    is_dribble = _is("type_name", DRIBBLE)
    zone = start_x >= zone_min_x
    if zone_event_types is not None:
        zone = zone & F.col("type_name").isin(*zone_event_types)
    aerial = None
    for flag in AERIAL_WON_FLAGS:
        aerial = _flag(flag) if aerial is None else (aerial | _flag(flag))
    return {
        "passes_attempted": is_pass,
        "passes_completed": complete,
        "progressive_passes": complete & ((end_x - start_x) >= progressive_min_advance),
        "key_passes": is_pass & (_flag("pass_shot_assist") | _flag("pass_goal_assist")),
        "shots": is_shot,
        "goals": is_shot & _is("shot_outcome_name", GOAL),
        "dribble_attempts": is_dribble,
        "dribbles_completed": is_dribble & _is("dribble_outcome_name", DRIBBLE_COMPLETE),
        "tackles_won": _is("type_name", DUEL)
        & _is("duel_type_name", TACKLE)
        & F.col("duel_outcome_name").isin(*TACKLE_WON_OUTCOMES),
        "interceptions": _is("type_name", INTERCEPTION),
        "aerial_duels_won": aerial,
        "pressures": _is("type_name", PRESSURE),
        "attacking_third_touches": zone,
        "gk_shots_faced": _is("goalkeeper_type_name", GK_SHOT_FACED),
        "gk_shots_saved": F.col("goalkeeper_type_name").isin(*GK_SHOT_SAVED),
        "gk_claims": F.col("goalkeeper_type_name").isin(*GK_CLAIM),
        "gk_sweeper_actions": _is("goalkeeper_type_name", GK_SWEEPER),
    }


# --- Fixed values: output schema of the player feature table ------------------------
# In the order in which the table lists them: per-90 rates of counters, and ratios
# (name, numerator, denominator).
FEATURE_TABLE = (
    ("passes_attempted",),
    ("pass_completion_pct", "passes_completed", "passes_attempted"),
    ("progressive_passes",),
    ("key_passes",),
    ("shots",),
    ("shot_conversion_pct", "goals", "shots"),
    ("dribbles_completed",),
    ("dribble_success_pct", "dribbles_completed", "dribble_attempts"),
    ("tackles_won",),
    ("interceptions",),
    ("aerial_duels_won",),
    ("pressures",),
    ("attacking_third_touches",),
    ("gk_shots_faced",),
    ("gk_save_pct", "gk_shots_saved", "gk_shots_faced"),
    ("gk_claims",),
    ("gk_sweeper_actions",),
)
# --- end of fixed values ------------------------------------------------------------


def event_feature_specs():
    """Output specs (rates and ratios) of ``FEATURE_TABLE``."""
    from ..operators.features import Rate, Ratio

    return [Ratio(*f) if len(f) == 3 else Rate(*f) for f in FEATURE_TABLE]
