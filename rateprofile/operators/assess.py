"""Assessment of a clustering and descriptive cohort reports (A9-A13, J6-J7,
M7, M14, P12, W3, G2). All are grouped aggregations or top-k plans over the
clustered entity table; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import contains_any, per_exposure


def cluster_profile(
    df: DataFrame,
    cluster_col: str | Sequence[str],
    feature_cols: Sequence[str],
    count_out: str = "n",
    prefix: str = "mean_",
) -> DataFrame:
    """Size and mean of every feature per cluster (A9), or per several key columns."""
    keys = [cluster_col] if isinstance(cluster_col, str) else list(cluster_col)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_out), *[F.avg(c).alias(f"{prefix}{c}") for c in feature_cols]
    )


def vector_profile(
    df: DataFrame, cluster_col: str, vector_col: str, names: Sequence[str], count_out: str = "n", prefix: str = "mean_"
) -> DataFrame:
    """``cluster_profile`` of a vector column: one mean vector per cluster, then unpacked."""
    means = df.groupBy(cluster_col).agg(
        F.count(F.lit(1)).alias(count_out), vector_to_array(Summarizer.mean(F.col(vector_col))).alias("_m")
    )
    return means.select(cluster_col, count_out, *[F.get("_m", i).alias(f"{prefix}{c}") for i, c in enumerate(names)])


def cross_tab(df: DataFrame, a: str, b: str, out: str = "n") -> DataFrame:
    """Counts per (a, b) pair, e.g. cluster x label."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias(out))


def cluster_sizes(df: DataFrame, cluster_col: str, out: str = "n", min_out: str = "min_size") -> DataFrame:
    """Size of each cluster and the smallest size (A12), a scalar subquery over the sizes."""
    sizes = df.groupBy(cluster_col).agg(F.count(F.lit(1)).alias(out))
    return sizes.withColumn(min_out, sizes.agg(F.min(out)).scalar())


def first_members(df: DataFrame, cluster_col: str, order_col: str, n: int = 8, rank_out: str = "rank") -> DataFrame:
    """The first ``n`` members of each cluster by ``order_col`` (W3). Spark plans
    ``row_number <= n`` as a partial WindowGroupLimit before the shuffle, so each
    map task forwards at most ``n`` rows per cluster even for a huge cluster."""
    w = Window.partitionBy(cluster_col).orderBy(F.asc(order_col))
    return df.withColumn(rank_out, F.row_number().over(w)).filter(F.col(rank_out) <= n)


def lowest(df: DataFrame, order_cols: Sequence[str], k: int = 15) -> DataFrame:
    """The k rows with the smallest ``order_cols`` (G2): TakeOrderedAndProject,
    a per-partition top-k merged on one task (k rows each)."""
    return df.orderBy(*[F.asc(c) for c in order_cols]).limit(k)


def spot_check(df: DataFrame, name_col: str, substrings: Sequence[str], ignore_case: bool = False) -> DataFrame:
    """Rows whose name contains any of ``substrings``."""
    return df.filter(contains_any(name_col, substrings, ignore_case))


def profile_drift(
    reference: DataFrame,
    other: DataFrame,
    cluster_col: str,
    feature_cols: Sequence[str],
    count_col: str = "n",
    prefix: str = "mean_",
) -> DataFrame:
    """Compare two cluster profiles (e.g. train vs held-out): per cluster the two
    sizes and the absolute difference of each feature mean (M14). A cluster that only
    one of the two has stays, with size 0 on the other side and NULL differences."""
    a = reference.select(
        cluster_col, F.col(count_col).alias(f"{count_col}_a"), *[F.col(f"{prefix}{c}").alias(f"_a_{c}") for c in feature_cols]
    )
    b = other.select(
        cluster_col, F.col(count_col).alias(f"{count_col}_b"), *[F.col(f"{prefix}{c}").alias(f"_b_{c}") for c in feature_cols]
    )
    return a.join(b, cluster_col, "full").select(
        cluster_col,
        *[F.coalesce(F.col(f"{count_col}_{x}"), F.lit(0)).alias(f"{count_col}_{x}") for x in "ab"],
        *[F.abs(F.col(f"_a_{c}") - F.col(f"_b_{c}")).alias(f"diff_{c}") for c in feature_cols],
    )


def split_drift(
    df: DataFrame,
    cluster_col: str,
    split_col: str,
    feature_cols: Sequence[str],
    a: str,
    b: str,
) -> DataFrame:
    """``profile_drift`` between two splits of one table: the profiles of both come from a single
    grouped pass, and only their rows are compared."""
    per = cluster_profile(df.filter(F.col(split_col).isin(a, b)), [cluster_col, split_col], feature_cols, "n", "mean_")
    only = lambda c, v: F.max(F.when(F.col(split_col) == v, F.col(c)))
    return per.groupBy(cluster_col).agg(
        F.coalesce(only("n", a), F.lit(0)).alias("n_a"),
        F.coalesce(only("n", b), F.lit(0)).alias("n_b"),
        *[F.abs(only(f"mean_{c}", a) - only(f"mean_{c}", b)).alias(f"diff_{c}") for c in feature_cols],
    )


def cohort_intensity(
    events: DataFrame,
    exposure: DataFrame,
    sessions: DataFrame,
    session_col: str,
    cohort_col: str,
    period_col: str,
    exposure_col: str = "exposure",
    per: float = 90.0,
    per_period_denominator: bool = False,
    count_col: str | None = None,
) -> DataFrame:
    """Events per ``per`` exposure units per cohort.

    ``events`` are already filtered to the event kind being measured (or, with
    ``count_col``, hold counts of such events, any number of rows per session). Numerator
    is grouped by (cohort, period); the denominator by cohort only (the source
    model's choice: a cohort spanning two periods gets its whole exposure
    twice), or by (cohort, period) with ``per_period_denominator=True``.
    ``sessions`` maps each session to its cohort and period.
    """
    dim = sessions.select(session_col, cohort_col, period_col)
    # Both sides are reduced to one row per session before they meet the
    # session dimension, so a session holding a large share of all events
    # reaches the join as a single row.
    n = F.sum(count_col) if count_col else F.count(F.lit(1))
    per_session_n = events.groupBy(session_col).agg(n.alias("_n")).filter(F.col("_n") > 0)
    num = per_session_n.join(dim, session_col, "inner").groupBy(cohort_col, period_col).agg(
        F.sum("_n").alias("n_events")
    )
    den_keys = [cohort_col, period_col] if per_period_denominator else [cohort_col]
    per_session_x = exposure.groupBy(session_col).agg(F.sum(exposure_col).alias("_x"))
    den = per_session_x.join(dim, session_col, "inner").groupBy(*den_keys).agg(
        F.sum("_x").alias("total_exposure")
    )
    return num.join(den, den_keys, "inner").withColumn(
        "events_per_90", per_exposure("n_events", "total_exposure", per)
    )
