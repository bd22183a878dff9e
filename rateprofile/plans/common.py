"""Building blocks shared by the two pipelines (football event model)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clock_to_minutes
from ..functions.predicates import event_counters, event_feature_specs
from ..operators import counts, exposure, features


CLOCK_MAXIMA = ("last_minute", "last_second", "last_clock")


def player_match_summary(events: DataFrame, keys: Sequence[str] = ("match_id", "player_id"), **counter_args) -> DataFrame:
    """One row per (match, player), or per ``keys``, NULL players included: ``total_events``, the 17 counters and the
    maxima of the clock. One pass over the events serves counters, session ends and intensity."""
    clock = F.col("minute") + F.col("second") / 60.0
    aggs = [F.count_if(p).alias(name) for name, p in event_counters(**counter_args).items()]
    maxima = [F.max(c).alias(name) for name, c in zip(CLOCK_MAXIMA, (F.col("minute"), F.col("second"), clock))]
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_events"), *aggs, *maxima)


def match_ends(events: DataFrame, end_mode: str, summarised: bool) -> DataFrame:
    """Session ends from events, or from a summary that has their clock maxima."""
    out = "match_end_minute"
    if not summarised:
        return exposure.session_end(events, "match_id", "minute", "second", mode=end_mode, out=out)
    if end_mode == "exact":
        return events.groupBy("match_id").agg(F.max("last_clock").alias(out))
    return exposure.session_end(events, "match_id", "last_minute", "last_second", mode=end_mode, out=out)


def player_minutes(
    events: DataFrame, segments: DataFrame, end_mode: str = "reference", mode: str = "span", summarised: bool = False
) -> DataFrame:
    """Minutes on the pitch and primary position per (match, player) from lineup
    segments (A1-A3, J1-J2, W1, P2-P5): ``mm:ss`` clocks parsed to minutes, an
    open ``to`` filled with the match end taken from the events, segments with
    no position (unused substitutes) dropped. ``summarised``: ``events`` is a ``player_match_summary``."""
    ends = match_ends(events, end_mode, summarised)
    segs = segments.select(
        "match_id",
        "player_id",
        "player_name",
        "team_id",
        "team_name",
        "positions_position",
        clock_to_minutes("positions_from").alias("from_min"),
        clock_to_minutes("positions_to").alias("to_min"),
    )
    return exposure.exposure(
        segs,
        "match_id",
        "player_id",
        role="positions_position",
        ends=ends,
        end_col="match_end_minute",
        mode=mode,
        carry=("player_name", "team_id", "team_name"),
        out="minutes_played",
        role_out="primary_position",
    )


def player_match_stats(events: DataFrame, **counter_args) -> DataFrame:
    """The 17 counters plus ``total_events`` per (match, player)."""
    return counts.conditional_counts(
        events, ["match_id", "player_id"], event_counters(**counter_args), require_not_null=["player_id"]
    )


def player_features(
    stats: DataFrame,
    minutes: DataFrame,
    min_minutes: float = 270.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """Per-90 feature table per player (A8): player_id, player_name,
    position_label, total_minutes, matches_played, 13 rates and 4 ratios."""
    return features.entity_features(
        stats,
        minutes,
        "player_id",
        event_feature_specs(),
        exposure_col="minutes_played",
        label_col="primary_position",
        by=by,
        carry=("player_name",),
        min_exposure=min_minutes,
        label_out="position_label",
        exposure_out="total_minutes",
        sessions_out="matches_played",
    )


def with_split(df: DataFrame, splits: DataFrame) -> DataFrame:
    """Attach the ``split`` of each row's match (rows of unlisted matches drop)."""
    return df.join(splits.select("match_id", "split"), "match_id", "inner")


def split_sessions(
    sessions: DataFrame,
    train: Sequence[tuple[int, int]],
    test: Sequence[tuple[int, int]],
) -> DataFrame:
    """match_id -> 'train' / 'test' by (competition_id, season_id) membership
    (P14, J3): a two-column join with a keys table as long as the two lists."""
    spark = sessions.sparkSession
    keys = spark.createDataFrame(
        [(int(c), int(s), "train") for c, s in train] + [(int(c), int(s), "test") for c, s in test],
        "competition_id long, season_id long, split string",
    )
    return sessions.join(F.broadcast(keys), ["competition_id", "season_id"], "inner")
