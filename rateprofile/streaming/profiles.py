"""Entity tables that follow the landing.

Landing writes, with each batch of files, the partial aggregates of its sessions: per (session, player) the
counters and clock maxima, per (session, player, position) the segment summary. ``update_entities`` then finds the
sessions whose files changed since the last update, and rebuilds only the players who occur in
these, from the partial aggregates; events are not read again, and of the entity table only the buckets
with such players are written. The result is what a computation from all files would give.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import clock_to_minutes
from ..functions.predicates import MIN_EXPOSURE_MINUTES, event_feature_specs
from ..operators import exposure, features
from ..operators.deliveries import changed_sessions, refresh
from ..plans.common import match_ends, player_match_summary
from ..session import cut_lineage
from ..sources.published import publish, read_published
from .landing import COHORT_COLUMNS, Landed, current_deliveries, land_events, land_lineups, read_landed

#: Parts of the entity table: an update writes those with a touched player.
BUCKETS = 64
CARRY = ("player_name", "team_id", "team_name")
SESSIONS = "match_id long, events long, lineups long"


def summarise_events(rows: DataFrame) -> DataFrame:
    return player_match_summary(rows, keys=("match_id", "delivery", "player_id"))


def summarise_segments(rows: DataFrame) -> DataFrame:
    """Segment summary per (session, player, position), what ``exposure.exposure_of_summary`` reads."""
    segments = rows.filter(F.col("positions_position").isNotNull()).withColumns(
        {"from_min": clock_to_minutes("positions_from"), "to_min": clock_to_minutes("positions_to")}
    )
    keys = ("match_id", "delivery", "player_id", "positions_position")
    return segments.groupBy(*keys).agg(*exposure.segment_summary("from_min", "to_min"), *[F.max(c).alias(c) for c in CARRY])


def land(
    spark: SparkSession, data: str, out: str, sessions: DataFrame | None = None, partition_cols: Sequence[str] = COHORT_COLUMNS, max_files: int = 256
) -> dict[str, Landed]:
    """Land ``events`` and ``lineups`` under ``data`` with their partial aggregates."""
    done = {}
    for what, run, summary in (("events", land_events, summarise_events), ("lineups", land_lineups, summarise_segments)):
        done[what] = run(spark, f"{data}/{what}", f"{out}/{what}", f"{out}/_checkpoints/{what}", max_files, sessions, partition_cols, summary)
    return done


@dataclass
class Updated:
    """Sessions that changed, players rebuilt, parts of the entity table written."""

    sessions: int = 0
    players: int = 0
    parts: int = 0


def _current(spark: SparkSession, out: str) -> DataFrame:
    """(match_id, events, lineups): the deliveries that count; a file landed anew is another batch, not another delivery."""
    of = lambda what: current_deliveries(spark, f"{out}/{what}").filter("match_id is not null").select("match_id", F.col("delivery").alias(what))
    return of("events").join(of("lineups"), "match_id", "full")


def entity_table(summary: DataFrame, roles: DataFrame, ends: DataFrame) -> DataFrame:
    """Per player the totals of all counters (A5), and the minutes, matches and majority position (A6, W2), from
    partial aggregates. A player with only one of the two has NULL in the other's columns."""
    specs = event_feature_specs()
    needed = {c for o in specs for c in ((o.counter,) if isinstance(o, features.Rate) else (o.numerator, o.denominator))}
    stats = summary.filter(F.col("player_id").isNotNull())
    totals = features.entity_totals(stats, ["player_id"], [c for c in summary.columns if c in needed])
    minutes = exposure.exposure_of_summary(
        roles, ends, "match_id", "player_id", "positions_position", "match_end_minute", CARRY, "minutes_played", "primary_position"
    )
    expo = features.exposure_and_label(
        minutes, ["player_id"], "minutes_played", "primary_position", "total_minutes", "matches_played", "position_label", ("player_name",)
    )
    return expo.join(totals, "player_id", "full")


def update_entities(spark: SparkSession, out: str, end_mode: str = "reference", buckets: int = BUCKETS) -> Updated:
    """Bring ``{out}/entities`` up to date with what is landed under ``out``; nothing is written where nothing changed.
    An update that stops is repeated by the next: the sessions count as merged only when the entity table is published."""
    out = out.rstrip("/")
    now = cut_lineage(_current(spark, out))
    merged = read_published(spark, f"{out}/entities_sessions", SESSIONS)
    changed = cut_lineage(changed_sessions(now, merged, "match_id", ("events", "lineups")))
    n = changed.count()
    if not n:
        return Updated()
    everything = [spark.read.parquet(f"{out}/{what}_summary") for what in ("events", "lineups")]
    # whoever occurs in any delivery of a changed session
    players = [t.join(changed, "match_id", "left_semi").select("player_id") for t in everything]
    touched = cut_lineage(players[0].unionByName(players[1]).filter("player_id is not null").distinct())
    summary, roles = read_landed(spark, f"{out}/events", "_summary"), read_landed(spark, f"{out}/lineups", "_summary")
    own_roles = roles.join(touched, "player_id", "left_semi")
    ends = match_ends(summary.join(own_roles.select("match_id").distinct(), "match_id", "left_semi"), end_mode, summarised=True)
    bucket = F.pmod(F.xxhash64("player_id"), F.lit(buckets)).cast("string")
    rebuilt = entity_table(summary.join(touched, "player_id", "left_semi"), own_roles, ends).withColumn("bucket", bucket)
    parts = [r["b"] for r in touched.select(bucket.alias("b")).distinct().collect()]
    old = read_published(spark, f"{out}/entities", rebuilt.schema, parts)
    publish(refresh(old, touched, rebuilt, ["player_id"]), f"{out}/entities", "bucket", parts)
    publish(now, f"{out}/entities_sessions")
    return Updated(n, touched.count(), len(parts))


def read_entities(spark: SparkSession, out: str) -> DataFrame:
    return read_published(spark, f"{out.rstrip('/')}/entities").drop("bucket")


def entity_profiles(entities: DataFrame, min_minutes: float = MIN_EXPOSURE_MINUTES) -> DataFrame:
    """The feature table of ``plans.player_features`` from the entity table: players with minutes and events."""
    specs = event_feature_specs()
    some = next(o.counter for o in specs if isinstance(o, features.Rate))
    both = entities.filter(F.col("total_minutes").isNotNull() & F.col(some).isNotNull() & (F.col("total_minutes") >= min_minutes))
    return features.rates(both, ["player_id", "player_name", "position_label", "total_minutes", "matches_played"], specs, "total_minutes")
