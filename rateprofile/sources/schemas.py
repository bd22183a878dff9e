"""Explicit schemas for the nested JSON inputs.

Declaring them removes the JSON schema-inference pass (a full extra scan), and
a nested field that never occurs in a file set is simply NULL instead of an
analysis error. Only fields some operator reads are declared; JSON parsing
skips the rest.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _named() -> StructType:
    return StructType([StructField("name", StringType())])


def _id_name() -> StructType:
    return StructType([StructField("id", LongType()), StructField("name", StringType())])


def _aerial() -> StructType:
    return StructType([StructField("aerial_won", BooleanType())])


COORDS = ArrayType(DoubleType())

EVENT_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("period", LongType()),
        StructField("minute", LongType()),
        StructField("second", LongType()),
        StructField("type", _named()),
        StructField("team", _id_name()),
        StructField("player", _id_name()),
        StructField("position", _named()),
        StructField("location", COORDS),
        StructField("under_pressure", BooleanType()),
        StructField("duration", DoubleType()),
        StructField(
            "pass",
            StructType(
                [
                    StructField("recipient", StructType([StructField("id", LongType())])),
                    StructField("length", DoubleType()),
                    StructField("end_location", COORDS),
                    StructField("outcome", _named()),
                    StructField("goal_assist", BooleanType()),
                    StructField("shot_assist", BooleanType()),
                    StructField("aerial_won", BooleanType()),
                ]
            ),
        ),
        StructField(
            "shot",
            StructType(
                [
                    StructField("outcome", _named()),
                    StructField("statsbomb_xg", DoubleType()),
                    StructField("aerial_won", BooleanType()),
                ]
            ),
        ),
        StructField("dribble", StructType([StructField("outcome", _named())])),
        StructField("duel", StructType([StructField("type", _named()), StructField("outcome", _named())])),
        StructField("clearance", _aerial()),
        StructField("miscontrol", _aerial()),
        StructField("interception", StructType([StructField("outcome", _named())])),
        StructField("substitution", StructType([StructField("replacement", StructType([StructField("id", LongType())]))])),
        StructField("goalkeeper", StructType([StructField("type", _named()), StructField("outcome", _named())])),
    ]
)

POSITION_SEGMENT = StructType(
    [
        StructField("position_id", LongType()),
        StructField("position", StringType()),
        StructField("from", StringType()),
        StructField("to", StringType()),
        StructField("from_period", LongType()),
        StructField("to_period", LongType()),
        StructField("start_reason", StringType()),
        StructField("end_reason", StringType()),
    ]
)

LINEUP_SCHEMA = StructType(
    [
        StructField("team_id", LongType()),
        StructField("team_name", StringType()),
        StructField(
            "lineup",
            ArrayType(
                StructType(
                    [
                        StructField("player_id", LongType()),
                        StructField("player_name", StringType()),
                        StructField("player_nickname", StringType()),
                        StructField("jersey_number", LongType()),
                        StructField("positions", ArrayType(POSITION_SEGMENT)),
                    ]
                )
            ),
        ),
    ]
)

MATCH_SCHEMA = StructType(
    [
        StructField("match_id", LongType()),
        StructField("match_date", StringType()),
    ]
)
