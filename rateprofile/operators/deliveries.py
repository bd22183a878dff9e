"""Sessions that are delivered more than once, and tables kept up to date from what changed.

A delivery is one file of one session. A corrected file is a later delivery of a
session that is already there; its rows replace those of the earlier one. Which delivery counts is decided on the
table of deliveries, a row per file, never on the rows themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Deliveries up to which their keys are broadcast to the rows; more are joined by a shuffle.
BROADCAST_DELIVERIES = 200_000


def last_deliveries(deliveries: DataFrame, session: str, order: Sequence[str]) -> DataFrame:
    """One row per session: the delivery that is last by ``order`` (largest values; NULL comes first). Rows without a session stay, each for itself."""
    keys = [c for c in deliveries.columns if c != session]
    rest = [c for c in keys if c not in order]
    known = deliveries.filter(F.col(session).isNotNull())
    last = known.groupBy(session).agg(F.max(F.struct(*order, *rest)).alias("_last")).select(session, "_last.*")
    return last.select(*deliveries.columns).unionByName(deliveries.filter(F.col(session).isNull()))


def current_rows(rows: DataFrame, last: DataFrame, keys: Sequence[str], broadcast_rows: int = BROADCAST_DELIVERIES) -> DataFrame:
    """The rows that belong to the deliveries in ``last``, by null-safe equality of ``keys``. ``last`` is counted: a
    list that is not small is joined by a shuffle."""
    wanted = last.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    small = wanted.count() <= broadcast_rows
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return rows.join(F.broadcast(wanted) if small else wanted, on, "left_semi")


def refresh(old: DataFrame | None, touched: DataFrame, rebuilt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A table after some of its entities were rebuilt: the rows of the others, and the new rows of ``touched``."""
    if old is None:
        return rebuilt
    return old.join(touched.select(*keys).distinct(), list(keys), "left_anti").unionByName(rebuilt)


def changed_sessions(last: DataFrame, merged: DataFrame, session: str, versions: Sequence[str]) -> DataFrame:
    """Sessions whose current deliveries are not those that were merged last (new, corrected or gone)."""
    a = last.select(session, F.struct(*versions).alias("_now"))
    b = merged.select(session, F.struct(*versions).alias("_was"))
    both = a.join(b, session, "full")
    return both.filter(~F.col("_now").eqNullSafe(F.col("_was"))).select(session)


def merged_partials(partials: DataFrame, keys: Sequence[str], sums: Sequence[str] = (), maxima: Sequence[str] = (), minima: Sequence[str] = ()) -> DataFrame:
    """Partial aggregates of several batches as one per key."""
    aggs: list[Callable] = [(F.sum, sums), (F.max, maxima), (F.min, minima)]
    return partials.groupBy(*keys).agg(*[f(c).alias(c) for f, cols in aggs for c in cols])
