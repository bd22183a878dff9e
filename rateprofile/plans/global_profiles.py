"""Pipeline L1: global profiles, fitted on training cohorts, checked on held-out ones.

events + lineups + sessions
  -> minutes per (match, player) and per-(match, player) counters (one pass each)
  -> per-90 features for train and test in one pass (split is a grouping key)
  -> standardise on train -> k sweep -> K-Means (chosen k) and Gaussian mixture
  -> profiles, cross-tab, spot check, most blended, holdout transfer + drift,
     cohort pressing intensity
Every result is a DataFrame; ``write_global_outputs`` writes the two entity
tables as Parquet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import GENERAL_FEATURES, MIN_EXPOSURE_MINUTES
from ..operators import assess, clustering, models, scaling, sweep
from ..session import cut_lineage
from ..sources.published import publish
from ..sources.sinks import drop_vectors, write_parquet
from .common import (
    CLOCK_MAXIMA,
    player_features,
    player_match_summary,
    player_minutes,
    split_sessions,
    with_split,
)

# --- Fixed values: pipeline defaults ---------------------------------------------------
K_RANGE = tuple(range(3, 11))
SEED = 42
BLENDED_N = 15
# --- end of fixed values ----------------------------------------------------------------


def cluster_and_assess(
    feats: DataFrame,
    feature_cols: Sequence[str],
    id_col: str,
    name_col: str | None,
    label_col: str,
    split_col: str = "split",
    train_value: str = "train",
    test_value: str = "test",
    k_range: Sequence[int] = K_RANGE,
    k_override: int | None = None,
    seed: int = SEED,
    spot_names: Sequence[str] = (),
    ignore_case: bool = False,
    partitions: int | None = None,
    input_materialised: bool = False,
    max_steps: int = sweep.MAX_STEPS,
) -> dict[str, DataFrame | models.ProfileModel]:
    """The model half of L1 on any entity feature table with a split column:
    standardise on the train rows, k sweep, K-Means at the chosen k and a
    Gaussian mixture, then profiles, cross-tab, spot check, model comparison,
    most blended entities, and transfer of the fitted scaler + model to the
    held-out rows with per-cluster drift. ``model`` is the fitted model itself (``models.save_model``).

    The entity table is read several times (scaler fit, fit layout, holdout,
    reports), so it is materialised first unless the caller already did
    (``input_materialised=True``)."""
    spark = feats.sparkSession
    feature_cols = list(feature_cols)
    if not input_materialised:
        feats = cut_lineage(feats)
    train = feats.filter(F.col(split_col) == train_value).drop(split_col)
    test = feats.filter(F.col(split_col) == test_value).drop(split_col)
    if train.limit(1).count() == 0:
        raise ValueError(f"no entities in the {train_value!r} split meet the exposure minimum")

    scaled, scaler = scaling.standardise(train, feature_cols)
    ks = {*k_range, *([int(k_override)] if k_override is not None else [])}
    by_k = {t.k: t for t in sweep.sweep_kmeans(scaled, id_col, ks, seed=seed, max_steps=max_steps)[""]}
    sweep_rows = [clustering.score_row(by_k[k]) for k in sorted(set(k_range))]
    silhouette_k = clustering.choose_k(sweep_rows)
    best_k = clustering.choose_k(sweep_rows, k_override)
    km = by_k[best_k]
    compare_rows = [("kmeans", best_k, km.silhouette)]
    with clustering.fitting(scaled, id_col, partitions) as fit_input:
        gmm_model, _ = clustering.fit_gmm(fit_input, best_k, seed, prediction_col="cluster_gmm")
        # Both fitted models applied in one chain over the rows: no join of their outputs.
        both = gmm_model.transform(sweep.assign(fit_input, [km], cluster_out="cluster_kmeans"))
        train_out = cut_lineage(both.withColumn("gmm_max_prob", F.array_max(vector_to_array("probability"))).drop("probability"))
        compare_rows.append(("gmm", best_k, clustering.silhouette(train_out, "cluster_gmm")))
        if silhouette_k != best_k:
            # An override moved k: compare the two models at the silhouette-best k too.
            _, gmm_at_sil = clustering.fit_gmm(fit_input, silhouette_k, seed, prediction_col="cluster_gmm")
            compare_rows += [
                ("kmeans", silhouette_k, by_k[silhouette_k].silhouette),
                ("gmm", silhouette_k, clustering.silhouette(gmm_at_sil, "cluster_gmm")),
            ]

    test_pred = sweep.assign(scaling.apply_scaler(test, feature_cols, scaler), [km], cluster_out="cluster_kmeans")
    train_profile = assess.cluster_profile(train_out, "cluster_kmeans", feature_cols)
    test_profile = assess.cluster_profile(test_pred, "cluster_kmeans", feature_cols)
    compare = spark.createDataFrame(compare_rows, "model string, k int, silhouette double")
    settings = {"feature_cols": feature_cols, "id_col": id_col, "k": best_k, "seed": seed}
    return {
        "sweep": clustering.sweep_table(spark, sweep_rows, best_k).withColumn(
            "silhouette_max", F.col("k") == F.lit(silhouette_k)
        ),
        "train_clusters": drop_vectors(train_out),
        "test_clusters": drop_vectors(test_pred),
        # G1: the small report tables are ordered as they are read (k rows each).
        "train_profile": train_profile.orderBy("cluster_kmeans"),
        "gmm_profile": assess.cluster_profile(train_out, "cluster_gmm", feature_cols).orderBy("cluster_gmm"),
        "test_profile": test_profile.orderBy("cluster_kmeans"),
        "profile_drift": assess.profile_drift(train_profile, test_profile, "cluster_kmeans", feature_cols),
        "cross_tab": assess.cross_tab(train_out, "cluster_kmeans", label_col).orderBy("cluster_kmeans", F.desc("n")),
        "spot_check": assess.spot_check(drop_vectors(train_out), name_col, spot_names, ignore_case)
        if name_col
        else drop_vectors(train_out).limit(0),
        "model_compare": compare,
        "model": models.profile_model(scaler, km, gmm_model, feature_cols, settings, train_profile),
        "most_blended": assess.lowest(
            train_out.select(id_col, *([name_col] if name_col else []), label_col, "cluster_gmm", "gmm_max_prob"),
            ["gmm_max_prob", id_col],
            BLENDED_N,
        ),
    }


def global_profiles(
    events: DataFrame,
    segments: DataFrame,
    sessions: DataFrame,
    train_cohorts: Sequence[tuple[int, int]],
    test_cohorts: Sequence[tuple[int, int]],
    feature_cols: Sequence[str] = GENERAL_FEATURES,
    min_minutes: float = MIN_EXPOSURE_MINUTES,
    k_range: Sequence[int] = K_RANGE,
    k_override: int | None = None,
    seed: int = SEED,
    spot_names: Sequence[str] = (),
    ignore_case: bool = False,
    partitions: int | None = None,
    end_mode: str = "reference",
    exposure_mode: str = "span",
    per_period_denominator: bool = False,
) -> dict[str, DataFrame]:
    """Run L1. ``sessions`` has match_id, competition_id, season_id, season_year
    (and optionally competition_name); cohorts are (competition_id, season_id).

    ``end_mode`` ("reference" | "exact") picks the session-end rule,
    ``exposure_mode`` ("span" | "sum_segments") the minutes rule, and
    ``per_period_denominator`` the intensity denominator (see the operators)."""
    splits = split_sessions(sessions, train_cohorts, test_cohorts)
    # The events are read once: counters, clock maxima and pressures all come from one summary per
    # (match, player), NULL players included.
    summary = cut_lineage(player_match_summary(events))
    # Minutes feed both the features and the intensity denominator.
    minutes = cut_lineage(player_minutes(summary, segments, end_mode=end_mode, mode=exposure_mode, summarised=True))
    stats = summary.filter(F.col("player_id").isNotNull()).drop(*CLOCK_MAXIMA)
    feats = player_features(with_split(stats, splits), with_split(minutes, splits), min_minutes, by=("split",))
    # The entity table is small next to the events it summarises: materialise it
    # once (reliable checkpoint) so every later report reads it, not the events.
    feats = cut_lineage(feats)
    res = cluster_and_assess(
        feats,
        feature_cols,
        "player_id",
        "player_name",
        "position_label",
        k_range=k_range,
        k_override=k_override,
        seed=seed,
        spot_names=spot_names,
        ignore_case=ignore_case,
        partitions=partitions,
        input_materialised=True,
    )
    cohort_cols = ["competition_name"] if "competition_name" in sessions.columns else ["competition_id", "season_id"]
    cohort_dim = sessions.select(
        "match_id", F.concat_ws("/", *[F.col(c).cast("string") for c in cohort_cols]).alias("cohort"), "season_year"
    )
    intensity = assess.cohort_intensity(
        summary,
        minutes,
        cohort_dim,
        "match_id",
        "cohort",
        "season_year",
        exposure_col="minutes_played",
        per_period_denominator=per_period_denominator,
        count_col="pressures",
    )
    res["features"] = feats
    res["model"].settings.update(min_minutes=min_minutes, end_mode=end_mode, exposure_mode=exposure_mode)
    res["cohort_intensity"] = intensity.orderBy("season_year", "cohort")
    return res


def apply_profiles(model: models.ProfileModel, events: DataFrame, segments: DataFrame, sessions: DataFrame | None = None, cohorts: Sequence[tuple[int, int]] = ()) -> dict[str, DataFrame]:
    """A saved model (M7) on other matches: their features, made with the settings of the fit, the clusters of every
    player, the profile of these and its drift from the training profile. ``cohorts`` of ``sessions`` limit the matches."""
    settings = model.settings
    if cohorts:
        wanted = split_sessions(sessions, cohorts, ()).select("match_id")
        events, segments = events.join(wanted, "match_id", "left_semi"), segments.join(wanted, "match_id", "left_semi")
    summary = cut_lineage(player_match_summary(events))
    minutes = player_minutes(summary, segments, end_mode=settings["end_mode"], mode=settings["exposure_mode"], summarised=True)
    stats = summary.filter(F.col("player_id").isNotNull()).drop(*CLOCK_MAXIMA)
    assigned = cut_lineage(model.apply(player_features(stats, minutes, settings["min_minutes"])))
    profile = assess.cluster_profile(assigned, models.KMEANS_COL, settings["feature_cols"])
    out = {"assigned": assigned, "profile": profile.orderBy(models.KMEANS_COL), "cross_tab": assess.cross_tab(assigned, models.KMEANS_COL, "position_label")}
    if model.profile is not None:
        out["profile_drift"] = assess.profile_drift(model.profile, profile, models.KMEANS_COL, settings["feature_cols"])
    return out


def write_global_outputs(results: dict[str, DataFrame], out_dir: str, published: bool = False) -> None:
    """The train and test entity tables as Parquet (vectors dropped). ``published``: behind a manifest
    (``sources.published``): readers see the old tables until the new ones are whole."""
    for name, table in (("train", results["train_clusters"]), ("test", results["test_clusters"])):
        path = f"{out_dir.rstrip('/')}/player_features_{name}"
        publish(table, path) if published else write_parquet(table, path)
