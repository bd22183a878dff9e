"""Feature vectors and standardisation (M1, M7's scaler half, M9's per-family scaler).

Two forms of the same z-score:

* ``standardise``: Spark ML ``VectorAssembler`` + ``StandardScaler(withMean,
  withStd)``. The fitted scaler is a model that can be applied to a held-out
  population (``apply_scaler``). Fitting is one distributed summariser pass.
* ``grouped_standardise``: one z-score per group (e.g. per label family) in a
  single pass for all groups: a grouped mean / sample-std aggregation joined
  back on the group key. No window, so a hot group is never pulled into one
  task; the joined statistics table has one row per group.

Both give 0 for a zero-variance feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

BROADCAST_GROUPS = 10_000


def assemble(df: DataFrame, features: Sequence[str] | str, out: str = "features_raw") -> DataFrame:
    """Build a dense vector column from numeric columns, or from one array column."""
    if isinstance(features, str):
        return df.withColumn(out, array_to_vector(F.col(features).cast("array<double>")))
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def fit_scaler(assembled: DataFrame, raw_col: str = "features_raw", out: str = "features") -> StandardScalerModel:
    return StandardScaler(inputCol=raw_col, outputCol=out, withMean=True, withStd=True).fit(assembled)


def standardise(
    df: DataFrame,
    features: Sequence[str] | str,
    raw_col: str = "features_raw",
    out: str = "features",
) -> tuple[DataFrame, StandardScalerModel]:
    """Assemble and z-score (mean 0, sample std 1). Returns (scaled, fitted scaler)."""
    assembled = assemble(df, features, raw_col)
    model = fit_scaler(assembled, raw_col, out)
    return model.transform(assembled), model


def apply_scaler(
    df: DataFrame,
    features: Sequence[str] | str,
    scaler: StandardScalerModel,
    raw_col: str = "features_raw",
) -> DataFrame:
    """Apply a scaler fitted on another population (M7)."""
    return scaler.transform(assemble(df, features, raw_col))


def vector_long(df: DataFrame, keys: Sequence[str], vector_col: str, pos: str = "pos", value: str = "z") -> DataFrame:
    """One row per vector component: (keys..., pos, value), pos (long) from 0."""
    exploded = df.select(*keys, F.posexplode(vector_to_array(F.col(vector_col))).alias(pos, value))
    return exploded.withColumn(pos, F.col(pos).cast("long"))


def grouped_standardise(
    df: DataFrame,
    group_col: str,
    feature_cols: Sequence[str],
    prefix: str = "z_",
    broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """Add ``{prefix}{feature}`` = (x - group mean) / group sample std (0 when the
    std is 0 or undefined) for every feature, with statistics per ``group_col``.

    The statistics (one row per group) are materialised and counted: up to
    ``broadcast_groups`` rows are broadcast, so entities are not shuffled on a
    key with few values; more are joined."""
    stats = df.groupBy(group_col).agg(
        *[F.avg(c).alias(f"_mu_{c}") for c in feature_cols],
        *[F.stddev_samp(c).alias(f"_sd_{c}") for c in feature_cols],
    )
    stats = cut_lineage(stats)
    joined = df.join(F.broadcast(stats) if stats.count() <= broadcast_groups else stats, group_col, "inner")
    zs = []
    for c in feature_cols:
        sd = F.col(f"_sd_{c}")
        zs.append(
            F.when(sd > 0, (F.col(c) - F.col(f"_mu_{c}")) / sd).otherwise(F.lit(0.0)).alias(f"{prefix}{c}")
        )
    return joined.select(*df.columns, *zs)
