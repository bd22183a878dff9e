"""Conditional counts per group (A4): one hash aggregation, one ``count_if`` per
named predicate. Spark computes all counters in a single partial + final
aggregation, so the raw events are read and shuffled once (and only the
aggregated rows cross the shuffle)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_counts(
    events: DataFrame,
    keys: Sequence[str],
    counters: Mapping[str, Column],
    total: str | None = "total_events",
    require_not_null: Sequence[str] = (),
) -> DataFrame:
    """``groupBy(keys)`` with ``count(*)`` (as ``total``) and ``count_if`` of each
    predicate. A NULL predicate is not counted, so every counter is a non-NULL
    long (0 when nothing matched)."""
    df = events
    for c in require_not_null:
        df = df.filter(F.col(c).isNotNull())
    aggs = [F.count(F.lit(1)).alias(total)] if total else []
    aggs += [F.count_if(pred).alias(name) for name, pred in counters.items()]
    return df.groupBy(*keys).agg(*aggs)
