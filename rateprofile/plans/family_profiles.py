"""Pipeline L2: clustering within label families.

Pooled per-90 features -> family by ordered label rules -> per-family scaling,
k sweep, override guard and fit (``operators.families``) -> report tables, each
with a ``family`` column: sizes and k choice, sweep, profiles, cross-tab, first
members per cluster, spot check. ``write_family_outputs`` writes the assigned
entities once, partitioned by family.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import LabelRule, contains_any, label_family
from ..functions.predicates import GENERAL_FEATURES, GOALKEEPER_FEATURES, MIN_EXPOSURE_MINUTES, POSITION_FAMILY_RULES
from ..operators import families
from ..session import cut_lineage
from ..sources.published import publish
from ..sources.sinks import write_parquet
from .common import player_features, player_match_stats, player_minutes

# --- Fixed values: pipeline defaults ---------------------------------------------------
FAMILY_FEATURES = {"GK": GOALKEEPER_FEATURES}
FAMILY_OVERRIDES = {"GK": None, "DEF": 3, "MID": None, "FWD": None}
SAMPLE_N = 8
SEED = 42
# --- end of fixed values ----------------------------------------------------------------


def family_profiles(
    events: DataFrame,
    segments: DataFrame,
    rules: Sequence[LabelRule] = POSITION_FAMILY_RULES,
    feature_sets: Mapping[str, Sequence[str]] = FAMILY_FEATURES,
    default_features: Sequence[str] = GENERAL_FEATURES,
    overrides: Mapping[str, int | None] = FAMILY_OVERRIDES,
    min_minutes: float = MIN_EXPOSURE_MINUTES,
    seed: int = SEED,
    sample_n: int = SAMPLE_N,
    spot_names: Sequence[str] = (),
    ignore_case: bool = False,
    min_per_cluster: int = families.MIN_PER_CLUSTER,
    end_mode: str = "reference",
    exposure_mode: str = "span",
) -> dict[str, DataFrame]:
    """Run L2. Only the families that ``overrides`` lists are clustered (a NULL override keeps the
    silhouette's choice); labels outside the rules stay in the feature table alone. ``end_mode`` and
    ``exposure_mode`` as in L1."""
    feats = player_features(player_match_stats(events), player_minutes(events, segments, end_mode, exposure_mode), min_minutes)
    feats = cut_lineage(feats.withColumn("family", label_family("position_label", rules)))
    res = families.cluster_families(
        feats,
        "player_id",
        "family",
        feature_sets,
        default_features,
        overrides,
        seed=seed,
        min_per_cluster=min_per_cluster,
        only=tuple(overrides),
        input_materialised=True,
    )
    clustered = res["assignments"]
    all_cols = sorted({c for cols in [default_features, *feature_sets.values()] for c in cols})
    # a family reports its own columns; the others are NULL there
    own = [_own(c, feature_sets, default_features) for c in all_cols]
    reported = clustered.select(*[c for c in clustered.columns if c not in all_cols], *own)
    profiles = reported.groupBy("family", "cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in all_cols]
    )
    samples = family_samples(reported, "player_id", sample_n).select("family", "cluster", "rank", "player_id", "player_name", "position_label", *all_cols)
    spot = clustered.filter(contains_any("player_name", spot_names, ignore_case)).select(
        "family", "cluster", "player_id", "player_name", "position_label"
    )
    return {
        "features": feats,
        "sizes": families.family_k_ranges(feats, "family", min_per_cluster),
        "choice": res["choice"].withColumn("features_used", features_used(feature_sets, default_features)),
        "sweep": res["sweep"],
        "assignments": clustered,
        "profiles": profiles.orderBy("family", "cluster"),
        "cross_tab": family_cross_tab(clustered, "position_label").orderBy("family", "cluster", F.desc("n")),
        "samples": samples,
        "spot_check": spot,
    }


def features_used(feature_sets: Mapping[str, Sequence[str]], default_features: Sequence[str]) -> Column:
    """The names of the features a row's family is fitted on."""
    return F.coalesce(
        *[F.when(F.col("family") == f, F.lit(", ".join(cols))) for f, cols in feature_sets.items()],
        F.lit(", ".join(default_features)),
    )


def family_cross_tab(clustered: DataFrame, label_col: str) -> DataFrame:
    return clustered.groupBy("family", "cluster", label_col).agg(F.count(F.lit(1)).alias("n"))


def family_samples(clustered: DataFrame, id_col: str, n: int = SAMPLE_N) -> DataFrame:
    """The first ``n`` members of every cluster of every family, with their ``rank``."""
    w = Window.partitionBy("family", "cluster").orderBy(id_col)
    return clustered.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def _own(column: str, feature_sets: Mapping[str, Sequence[str]], default_features: Sequence[str]) -> Column:
    """``column`` where it is one of the features of the row's family."""
    special = [f for f in feature_sets]
    has = [f for f in special if column in feature_sets[f]]
    fits = F.col("family").isin(*has) if has else F.lit(False)
    if column in default_features:
        fits = fits | (~F.col("family").isin(*special) if special else F.lit(True))
    return F.when(fits, F.col(column)).alias(column)


def write_family_outputs(results: dict[str, DataFrame], out_dir: str, published: bool = False) -> None:
    """One write, one folder per family. ``published``: behind a manifest (``sources.published``), so that readers never see
    half a write, and the families of this run alone are replaced."""
    path = f"{out_dir.rstrip('/')}/families"
    if published:
        ran = [r["family"] for r in results["sizes"].select("family").collect()]
        publish(results["assignments"], path, "family", replace=ran)
    else:
        write_parquet(results["assignments"], path, partition_by=("family",))
