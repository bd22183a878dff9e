"""Fitted profile models that outlive their run.

A model is a Spark ML ``PipelineModel`` (assembler, scaler, nearest K-Means centre, Gaussian mixture) with
the settings its features were made with and the profile of its training clusters. Saved by one run, it is
loaded by another and applied to entities that the fit never saw.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.clustering import GaussianMixtureModel
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
import numpy as np

from . import sweep

KMEANS_COL, GMM_COL, MAX_PROB_COL = "cluster_kmeans", "cluster_gmm", "gmm_max_prob"
PROBABILITY_COL = "probability"


class NearestCentre(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The centres of a sweep's fit as a pipeline stage. ``centres``: rows of whole numbers, on the grid."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "cluster column", TypeConverters.toString)
    centres = Param(Params._dummy(), "centres", "k rows of grid values", TypeConverters.identity)
    grid = Param(Params._dummy(), "grid", "grid steps per unit", TypeConverters.toInt)

    def __init__(self, fit: sweep.Fit | None = None, features_col: str = "features", prediction_col: str = KMEANS_COL):
        super().__init__()
        self._setDefault(featuresCol=features_col, predictionCol=prediction_col, grid=sweep.GRID)
        self._set(featuresCol=features_col, predictionCol=prediction_col, grid=sweep.GRID)
        if fit is not None:
            self._set(centres=[[int(v) for v in row] for row in fit.centres])

    @property
    def fit_(self) -> sweep.Fit:
        centres = np.array(self.getOrDefault(self.centres), float)
        return sweep.Fit("", len(centres), centres)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return sweep.assign(dataset, [self.fit_], self.getOrDefault(self.featuresCol), None, self.getOrDefault(self.predictionCol), self.getOrDefault(self.grid))


@dataclass
class ProfileModel:
    """``pipeline`` from feature columns to clusters; ``settings`` (plain values) of the run that fitted it;
    ``profile``: size and means of the training clusters, if known."""

    pipeline: PipelineModel
    settings: dict = field(default_factory=dict)
    profile: DataFrame | None = None

    def apply(self, feats: DataFrame) -> DataFrame:
        """``feats`` with ``cluster_kmeans`` and, if the model has a mixture, ``cluster_gmm`` and ``gmm_max_prob``."""
        out = self.pipeline.transform(feats)
        added = [KMEANS_COL]
        if PROBABILITY_COL in out.columns:
            out = out.withColumn(MAX_PROB_COL, F.array_max(vector_to_array(PROBABILITY_COL)))
            added += [GMM_COL, MAX_PROB_COL]
        return out.select(*feats.columns, *added)


def profile_model(
    scaler: StandardScalerModel,
    fit: sweep.Fit,
    gmm: GaussianMixtureModel | None = None,
    feature_cols: Sequence[str] | None = None,
    settings: Mapping | None = None,
    profile: DataFrame | None = None,
) -> ProfileModel:
    """Fitted parts as one model. With ``feature_cols`` it starts from these columns, else from the scaler's input vector."""
    stages: list = [VectorAssembler(inputCols=list(feature_cols), outputCol=scaler.getInputCol(), handleInvalid="error")] if feature_cols else []
    stages += [scaler, NearestCentre(fit, scaler.getOutputCol())] + ([gmm] if gmm is not None else [])
    return ProfileModel(PipelineModel(stages), dict(settings or {}), profile)


def save_model(model: ProfileModel, path: str) -> None:
    """Write the model to a new folder of storage that all runs share. ``settings`` is written last: a
    folder without it holds no complete model, and ``load_model`` says so."""
    spark = SparkSession.active()
    path = path.rstrip("/")
    model.pipeline.write().save(f"{path}/pipeline")
    if model.profile is not None:
        model.profile.write.parquet(f"{path}/profile")
    settings = {**model.settings, "has_profile": model.profile is not None}
    spark.createDataFrame([(json.dumps(settings, sort_keys=True),)], "value string").coalesce(1).write.text(f"{path}/settings")


def load_model(spark: SparkSession, path: str) -> ProfileModel:
    path = path.rstrip("/")
    try:
        rows = spark.read.text(f"{path}/settings").collect()
    except Exception as e:
        raise ValueError(f"{path} holds no complete model") from e
    if len(rows) != 1:
        raise ValueError(f"{path} holds no complete model")
    settings = json.loads(rows[0]["value"])
    profile = spark.read.parquet(f"{path}/profile") if settings.pop("has_profile") else None
    return ProfileModel(PipelineModel.load(f"{path}/pipeline"), settings, profile)
