"""Exposure time per (session, entity) and the dominant role in each session.

Input is a *segment* table: one row per stretch an entity spent in one role
during a session, with ``from``/``to`` times in minutes; ``to`` may be NULL
(open until the session ends). Segments with a NULL role (an entity listed
but never present) are dropped first.

Plan shape: two hash aggregations on (session, entity[, role]) with map-side
partial aggregation, then a left equi-join on (session, entity) whose sides
are already partitioned on those keys. The top-1 role uses ``row_number`` on
the *aggregated* role totals, which Spark plans as a WindowGroupLimit, so a hot
entity contributes at most one row per role to the window, never its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ColumnOrName, as_col, clamp_min


def session_end(
    events: DataFrame,
    session: str,
    minute: ColumnOrName = "minute",
    second: ColumnOrName = "second",
    mode: str = "reference",
    out: str = "session_end",
) -> DataFrame:
    """Last observed clock time per session, in minutes (A1).

    ``mode="reference"``: ``max(minute) + max(second) / 60`` (two independent
    maxima, as the source model computes it). ``mode="exact"``:
    ``max(minute + second / 60)``.
    """
    m, s = as_col(minute), as_col(second)
    if mode == "reference":
        end = F.max(m) + F.max(s) / 60.0
    elif mode == "exact":
        end = F.max(m + s / 60.0)
    else:
        raise ValueError(f"unknown session_end mode {mode!r}")
    return events.groupBy(session).agg(end.alias(out))


def session_ends(
    events: DataFrame, session: str, minute: ColumnOrName = "minute", second: ColumnOrName = "second", out: str = "session_end"
) -> DataFrame:
    """Both session ends in one pass: ``out`` (mode "reference") and ``{out}_exact``."""
    m, s = as_col(minute), as_col(second)
    return events.groupBy(session).agg(
        (F.max(m) + F.max(s) / 60.0).alias(out), F.max(m + s / 60.0).alias(f"{out}_exact")
    )


def fill_open_ends(
    segments: DataFrame,
    ends: DataFrame,
    session: str,
    to_col: str = "to_min",
    end_col: str = "session_end",
) -> DataFrame:
    """Replace a NULL segment end by its session's end (J1 + P3).

    A left join on the session key; the session-end table has one row per
    session, so AQE broadcasts it when its measured size is small and falls back
    to a sort-merge join otherwise.
    """
    return segments.join(ends, session, "left").withColumn(
        to_col, F.coalesce(F.col(to_col), F.col(end_col))
    )


def role_time(
    segments: DataFrame,
    keys: Sequence[str],
    role: str,
    weight: Column,
    out: str = "role_time",
) -> DataFrame:
    """Total weight (segment time by default) per (keys, role) (A2)."""
    return segments.groupBy(*keys, role).agg(F.sum(weight).alias(out))


def top_label(
    totals: DataFrame,
    keys: Sequence[str],
    label: str,
    weight: str,
    out: str,
) -> DataFrame:
    """The label with the largest weight per ``keys``; ties go to the smallest
    label, NULL labels last (W1 / W2). Deterministic, unlike an unordered tie."""
    w = Window.partitionBy(*keys).orderBy(F.desc(weight), F.asc_nulls_last(label))
    return (
        totals.withColumn("_rank", F.row_number().over(w))
        .filter(F.col("_rank") == 1)
        .select(*keys, F.col(label).alias(out))
    )


def dominant_role(
    segments: DataFrame,
    keys: Sequence[str],
    role: str,
    weight: Column,
    out: str = "primary_role",
) -> DataFrame:
    """Role with the most weight per ``keys``."""
    return top_label(role_time(segments, keys, role, weight), keys, role, "role_time", out)


def _null_safe_sum(a: Column, b: Column) -> Column:
    """a + b treating one NULL side as 0, NULL when both are NULL (like SUM)."""
    return F.when(a.isNull() & b.isNull(), F.lit(None).cast("double")).otherwise(
        F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))
    )


def _exposure_open_ends(
    segs: DataFrame,
    ends: DataFrame,
    session: str,
    entity: str,
    from_col: str,
    to_col: str,
    role: str,
    end_col: str,
    carry: Sequence[str],
    out: str,
    role_out: str,
) -> DataFrame:
    """Span exposure and dominant role when open segment ends are filled from
    the session end, with the aggregation pushed below the join.

    Per (session, entity, role) the closed segments are summarised (min start,
    max end, total length) and the open ones counted (with the sum of their
    starts); only these aggregated rows are joined to the session ends. An open
    segment contributes ``end - from`` (nothing when its start is unknown), so
    the open part of a role's time is ``n_open_timed * end - sum(open starts)``. A session holding a large share of all
    segments therefore reaches the join as one row per (entity, role), not as
    its raw segments.
    """
    per_role = segs.groupBy(session, entity, role).agg(*segment_summary(from_col, to_col), *[F.max(c).alias(c) for c in carry])
    return exposure_of_summary(per_role, ends, session, entity, role, end_col, carry, out, role_out)


def segment_summary(from_col: str, to_col: str) -> list[Column]:
    """Aggregates of a group of segments that determine its exposure once the session end is known."""
    frm, to = F.col(from_col), F.col(to_col)
    is_open = to.isNull()
    return [
        F.min(frm).alias("_from"),
        F.max(to).alias("_to_closed"),
        F.sum(F.when(~is_open, to - frm)).alias("_w_closed"),
        F.count_if(is_open).alias("_n_open"),
        F.count_if(is_open & frm.isNotNull()).alias("_n_open_timed"),
        F.sum(F.when(is_open, frm)).alias("_from_open"),
    ]


def exposure_of_summary(
    per_role: DataFrame,
    ends: DataFrame,
    session: str,
    entity: str,
    role: str,
    end_col: str = "session_end",
    carry: Sequence[str] = (),
    out: str = "exposure",
    role_out: str = "primary_role",
) -> DataFrame:
    """Span exposure and dominant role from one ``segment_summary`` row per (session, entity, role)."""
    keys = [session, entity]
    end = F.col(end_col)
    has_open = F.col("_n_open") > 0
    filled = per_role.join(ends.select(session, end_col), session, "left").select(
        *keys,
        role,
        *carry,
        "_from",
        F.greatest(F.col("_to_closed"), F.when(has_open, end)).alias("_to"),
        _null_safe_sum(
            F.col("_w_closed"),
            F.when(F.col("_n_open_timed") > 0, F.col("_n_open_timed") * end - F.col("_from_open")),
        ).alias("_weight"),
    )
    whole = Window.partitionBy(*keys)
    ranked = whole.orderBy(F.desc("_weight"), F.asc_nulls_last(role))
    return (
        filled.select(
            *keys,
            *[F.max(c).over(whole).alias(c) for c in carry],
            clamp_min(F.max("_to").over(whole) - F.min("_from").over(whole)).alias(out),
            F.col(role).alias(role_out),
            F.row_number().over(ranked).alias("_rank"),
        )
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def _span_open_ends(
    segs: DataFrame,
    ends: DataFrame,
    session: str,
    entity: str,
    from_col: str,
    to_col: str,
    end_col: str,
    carry: Sequence[str],
    out: str,
) -> DataFrame:
    """Span exposure without roles: one aggregated row per (session, entity) meets the session ends."""
    frm, to = F.col(from_col), F.col(to_col)
    per = segs.groupBy(session, entity).agg(
        F.min(frm).alias("_from"),
        F.max(to).alias("_to"),
        F.count_if(to.isNull()).alias("_n_open"),
        *[F.max(c).alias(c) for c in carry],
    )
    last = F.greatest("_to", F.when(F.col("_n_open") > 0, F.col(end_col)))
    joined = per.join(ends.select(session, end_col), session, "left")
    return joined.select(session, entity, *carry, clamp_min(last - F.col("_from")).alias(out))


def _lengths_open_ends(
    segs: DataFrame, ends: DataFrame, session: str, entity: str, from_col: str, to_col: str, end_col: str, out: str
) -> DataFrame:
    """Sum of the clamped segment lengths per (session, entity). Closed segments are summed, and
    open ones counted per start, before the session ends are joined: each open start is clamped by itself."""
    frm, to = F.col(from_col), F.col(to_col)
    keys = [session, entity]
    start = F.when(to.isNull(), frm)
    per = segs.groupBy(*keys, to.isNull().alias("_open"), start.alias("_start")).agg(
        F.sum(clamp_min(to - frm)).alias("_closed"), F.count(F.lit(1)).alias("_n")
    )
    joined = per.join(ends.select(session, end_col), session, "left")
    length = F.when(F.col("_open"), F.col("_n") * clamp_min(F.col(end_col) - F.col("_start"))).otherwise(F.col("_closed"))
    return joined.groupBy(*keys).agg(F.sum(length).alias(out))


def exposure(
    segments: DataFrame,
    session: str,
    entity: str,
    from_col: str = "from_min",
    to_col: str = "to_min",
    role: str | None = "role",
    ends: DataFrame | None = None,
    end_col: str = "session_end",
    role_weight: Column | None = None,
    mode: str = "span",
    carry: Sequence[str] = (),
    out: str = "exposure",
    role_out: str = "primary_role",
) -> DataFrame:
    """Exposure per (session, entity) plus the dominant role (A3 + J2).

    ``mode="span"``: ``max(to) - min(from)`` clamped at 0, so time away between
    two segments counts (the source model's definition). ``mode="sum_segments"``:
    the sum of the clamped segment lengths.

    ``carry`` columns (e.g. a display name) are kept with a deterministic
    ``max``; the grouping is on the ids only.
    """
    if mode not in ("span", "sum_segments"):
        raise ValueError(f"unknown exposure mode {mode!r}")
    segs = segments.filter(F.col(role).isNotNull()) if role else segments
    keys = [session, entity]
    if ends is not None and role and role_weight is None and mode == "span":
        return _exposure_open_ends(segs, ends, session, entity, from_col, to_col, role, end_col, carry, out, role_out)
    if ends is not None and role_weight is None:
        if mode == "span":
            return _span_open_ends(segs, ends, session, entity, from_col, to_col, end_col, carry, out)
        lengths = _lengths_open_ends(segs, ends, session, entity, from_col, to_col, end_col, out)
        if not role:
            names = segs.groupBy(*keys).agg(*[F.max(c).alias(c) for c in carry]) if carry else None
            return names.join(lengths, keys) if carry else lengths
        roles = _exposure_open_ends(segs, ends, session, entity, from_col, to_col, role, end_col, carry, "_span", role_out)
        return roles.join(lengths, keys).select(*keys, *carry, out, role_out)
    if ends is not None:
        segs = fill_open_ends(segs, ends, session, to_col, end_col)
    frm, to = F.col(from_col), F.col(to_col)
    if not role:
        measure = clamp_min(F.max(to) - F.min(frm)) if mode == "span" else F.sum(clamp_min(to - frm))
        return segs.groupBy(*keys).agg(*[F.max(c).alias(c) for c in carry], measure.alias(out))

    # One aggregation at (session, entity, role) grain feeds both outputs: the
    # span is the min/max over the role rows and the dominant role is the top
    # role row, so the segments are scanned and shuffled once. The window then
    # sees at most one row per role of an entity, never its raw segments.
    weight = role_weight if role_weight is not None else (to - frm)
    per_role = segs.groupBy(*keys, role).agg(
        F.min(frm).alias("_from"),
        F.max(to).alias("_to"),
        F.sum(clamp_min(to - frm)).alias("_len"),
        F.sum(weight).alias("_weight"),
        *[F.max(c).alias(c) for c in carry],
    )
    whole = Window.partitionBy(*keys)
    ranked = whole.orderBy(F.desc("_weight"), F.asc_nulls_last(role))
    measure = (
        clamp_min(F.max("_to").over(whole) - F.min("_from").over(whole))
        if mode == "span"
        else F.sum("_len").over(whole)
    )
    return (
        per_role.select(
            *keys,
            *[F.max(c).over(whole).alias(c) for c in carry],
            measure.alias(out),
            F.col(role).alias(role_out),
            F.row_number().over(ranked).alias("_rank"),
        )
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
