"""Entity feature table.

Session-level counts and session-level exposure are rolled up per entity and
turned into exposure-normalised rates and guarded ratios, with a majority
label attached:

    counts(session, entity)          --sum-->            totals(entity)
    exposure + role(session, entity) --(entity, role) agg, one window-->
                                     exposure, sessions, majority label(entity)
    exposure JOIN totals (inner), exposure >= minimum

Extra grouping keys (``by``, e.g. a train/test split) compute several
populations in the same pass instead of once per population.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import per_exposure, safe_ratio
from .exposure import top_label


@dataclass(frozen=True)
class Rate:
    """``counter / exposure * per`` named ``{counter}{suffix}``."""

    counter: str
    suffix: str = "_p90"

    @property
    def name(self) -> str:
        return f"{self.counter}{self.suffix}"


@dataclass(frozen=True)
class Ratio:
    """``numerator / denominator``, NULL when the denominator is not positive."""

    name: str
    numerator: str
    denominator: str


def entity_totals(counts: DataFrame, keys: Sequence[str], counters: Sequence[str]) -> DataFrame:
    """Sum of the session counters per entity (A5)."""
    return counts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters])


def entity_exposure(
    exposure: DataFrame,
    keys: Sequence[str],
    exposure_col: str = "exposure",
    out: str = "total_exposure",
    sessions_out: str = "sessions",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Total exposure and number of sessions per entity."""
    return exposure.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in carry],
        F.sum(exposure_col).alias(out),
        F.count(F.lit(1)).alias(sessions_out),
    )


def majority_label(
    per_session: DataFrame, keys: Sequence[str], label: str, out: str = "label"
) -> DataFrame:
    """Most frequent per-session label per entity; ties to the smallest label
    (W2 via A7). The vote counts are aggregated before the window, so the
    window sees one row per (entity, label)."""
    votes = per_session.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_votes"))
    return top_label(votes, keys, label, "_votes", out)


def exposure_and_label(
    exposure: DataFrame,
    keys: Sequence[str],
    exposure_col: str,
    label_col: str,
    out: str = "total_exposure",
    sessions_out: str = "sessions",
    label_out: str = "label",
    carry: Sequence[str] = (),
) -> DataFrame:
    """A6 and W2 from one aggregation: per (entity, label) the number of sessions
    and their exposure, then one window per entity gives the totals (sums over
    its label rows) and the majority label (top row; ties to the smallest
    label). The window sees at most one row per label of an entity."""
    votes = exposure.groupBy(*keys, label_col).agg(
        F.count(F.lit(1)).alias("_votes"),
        F.sum(exposure_col).alias("_exposure"),
        *[F.max(c).alias(c) for c in carry],
    )
    whole = Window.partitionBy(*keys)
    ranked = whole.orderBy(F.desc("_votes"), F.asc_nulls_last(label_col))
    return (
        votes.select(
            *keys,
            *[F.max(c).over(whole).alias(c) for c in carry],
            F.sum("_exposure").over(whole).alias(out),
            F.sum("_votes").over(whole).alias(sessions_out),
            F.col(label_col).alias(label_out),
            F.row_number().over(ranked).alias("_rank"),
        )
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def entity_features(
    counts: DataFrame,
    exposure: DataFrame,
    entity: str,
    outputs: Sequence[Rate | Ratio],
    exposure_col: str = "exposure",
    label_col: str | None = "primary_role",
    by: Sequence[str] = (),
    carry: Sequence[str] = (),
    min_exposure: float = 270.0,
    per: float = 90.0,
    fill: float | None = 0.0,
    label_out: str = "label",
    exposure_out: str = "total_exposure",
    sessions_out: str = "sessions",
) -> DataFrame:
    """Per-entity rates and ratios.

    ``counts``: one row per (by..., session, entity) with counter columns.
    ``exposure``: one row per (by..., session, entity) with ``exposure_col`` and
    optionally ``label_col`` (the session's dominant role) and ``carry`` columns.

    Entities with exposure but no counts drop out (inner join); the label is a
    left join. ``fill`` replaces NULL rates/ratios (a zero denominator) with a
    number; ``fill=None`` keeps them NULL.
    """
    keys = [*by, entity]
    needed = set()
    for o in outputs:
        if isinstance(o, Rate):
            needed.add(o.counter)
        else:
            needed.update((o.numerator, o.denominator))
    counters = [c for c in counts.columns if c in needed]
    totals = entity_totals(counts, keys, counters)
    if label_col:
        expo = exposure_and_label(exposure, keys, exposure_col, label_col, exposure_out, sessions_out, label_out, carry)
    else:
        expo = entity_exposure(exposure, keys, exposure_col, exposure_out, sessions_out, carry)
    joined = expo.join(totals, keys, "inner").filter(F.col(exposure_out) >= min_exposure)

    head = [*keys, *carry] + ([label_out] if label_col else []) + [exposure_out, sessions_out]
    return rates(joined, head, outputs, exposure_out, per, fill)


def rates(
    totals: DataFrame, head: Sequence[str], outputs: Sequence[Rate | Ratio], exposure_col: str, per: float = 90.0, fill: float | None = 0.0
) -> DataFrame:
    """``head`` columns with the rates and ratios of an entity's totals."""
    metrics = []
    for o in outputs:
        if isinstance(o, Rate):
            metrics.append(per_exposure(o.counter, exposure_col, per).alias(o.name))
        else:
            metrics.append(safe_ratio(o.numerator, o.denominator).alias(o.name))
    out = totals.select(*head, *metrics)
    if fill is not None:
        out = out.na.fill(float(fill), subset=[o.name for o in outputs])
    return out


def feature_names(outputs: Sequence[Rate | Ratio]) -> list[str]:
    return [o.name for o in outputs]
