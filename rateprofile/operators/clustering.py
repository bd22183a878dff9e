"""Clustering operators (M3-M6, M8, M13) on Spark ML; sweeps over k are in ``operators.sweep``.

Determinism: the fits of Spark ML depend on the row layout even
with a fixed seed, so every one goes through ``fit_layout`` first (hash
partition on the entity id into a fixed number of partitions, then sort within
partitions), and the laid-out vectors are persisted once for all fits that
read them, and released after these.

Silhouette uses ``ClusteringEvaluator`` (squared Euclidean), which is one pass
with per-cluster sums, never pairwise; a labelling with fewer than two clusters
has no silhouette and gives ``None``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel, KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from ..functions.columns import vector_max
from ..session import cut_lineage
from .sweep import Fit

#: Layout of every fit input: a parameter, not a function of the data, since the layout is
#: part of what a seeded fit depends on.
DEFAULT_FIT_PARTITIONS = 32
DEFAULT_SEED = 42
#: Centroids that enter one broadcast row, times their dimension.
CENTROID_VALUES = 1_000_000


def fit_layout(df: DataFrame, id_col: str, partitions: int = DEFAULT_FIT_PARTITIONS) -> DataFrame:
    """Fixed row layout for reproducible fits."""
    return df.repartition(partitions, id_col).sortWithinPartitions(id_col)


def prepare_for_fit(df: DataFrame, id_col: str, partitions: int | None = None) -> DataFrame:
    """Lay out and persist the vectors that several fits will read. The fits share this one copy
    (Spark ML caches a copy of its own for an input that is not persisted); the caller releases it
    with ``unpersist``, or uses ``fitting``."""
    laid = fit_layout(df, id_col, partitions or DEFAULT_FIT_PARTITIONS).persist(StorageLevel.MEMORY_AND_DISK)
    laid.count()
    return laid


@contextmanager
def fitting(df: DataFrame, id_col: str, partitions: int | None = None) -> Iterator[DataFrame]:
    """``prepare_for_fit`` for the time of a ``with`` block. What was derived from it stays valid
    and is computed from ``df`` after that."""
    laid = prepare_for_fit(df, id_col, partitions)
    try:
        yield laid
    finally:
        laid.unpersist()


def fit_kmeans(
    df: DataFrame,
    k: int,
    seed: int = DEFAULT_SEED,
    features_col: str = "features",
    prediction_col: str = "cluster",
    max_iter: int = 20,
) -> tuple[KMeansModel, DataFrame]:
    model = KMeans(
        featuresCol=features_col, predictionCol=prediction_col, k=k, seed=seed, maxIter=max_iter
    ).fit(df)
    return model, model.transform(df)


def fit_gmm(
    df: DataFrame,
    k: int,
    seed: int = DEFAULT_SEED,
    features_col: str = "features",
    prediction_col: str = "cluster",
    probability_col: str = "probability",
    max_prob_col: str = "max_prob",
) -> tuple[GaussianMixtureModel, DataFrame]:
    """Gaussian mixture with soft assignment; adds the largest component
    probability as ``max_prob_col`` (P18)."""
    model = GaussianMixture(
        featuresCol=features_col, predictionCol=prediction_col, probabilityCol=probability_col, k=k, seed=seed
    ).fit(df)
    preds = model.transform(df).withColumn(max_prob_col, vector_max(probability_col))
    return model, preds


def silhouette(
    preds: DataFrame,
    prediction_col: str = "cluster",
    features_col: str = "features",
    n_clusters: int | None = None,
) -> float | None:
    """Mean silhouette (squared Euclidean) of any labelling; ``None`` for < 2
    clusters. Pass ``n_clusters`` (non-empty clusters) when it is already known,
    e.g. from a K-Means summary, to skip the distinct-count job."""
    if n_clusters is None:
        n_clusters = preds.select(prediction_col).distinct().limit(2).count()
    if n_clusters < 2:
        return None
    evaluator = ClusteringEvaluator(
        featuresCol=features_col,
        predictionCol=prediction_col,
        metricName="silhouette",
        distanceMeasure="squaredEuclidean",
    )
    return float(evaluator.evaluate(preds.withColumn(prediction_col, F.col(prediction_col).cast("double"))))


def score_row(fit: Fit) -> dict:
    """What a sweep reports of one fit."""
    return {"k": fit.k, "training_cost": fit.training_cost, "silhouette": fit.silhouette}


def choose_k(rows: Sequence[dict], override: int | None = None) -> int:
    """Largest silhouette, smallest k on ties (M6); an override wins unchecked."""
    if override is not None:
        return int(override)
    scored = [r for r in rows if r["silhouette"] is not None]
    if not scored:
        return int(min(r["k"] for r in rows))
    best = max(r["silhouette"] for r in scored)
    return int(min(r["k"] for r in scored if r["silhouette"] == best))


SWEEP_SCHEMA = StructType(
    [
        StructField("k", IntegerType(), False),
        StructField("training_cost", DoubleType(), True),
        StructField("silhouette", DoubleType(), True),
        StructField("chosen", BooleanType(), False),
    ]
)


def sweep_table(spark: SparkSession, rows: Sequence[dict], chosen_k: int) -> DataFrame:
    """The sweep as a DataFrame (k rows), with the chosen k flagged."""
    data = [(r["k"], r["training_cost"], r["silhouette"], r["k"] == chosen_k) for r in rows]
    return spark.createDataFrame(data, SWEEP_SCHEMA)


def score_labelling(df: DataFrame, label_col: str, features_col: str = "features") -> dict:
    """Cost (sum of squared distances to the cluster means) and silhouette of any labelling, as a sweep
    scores its fits: one pass of sums per cluster, and the silhouette."""
    x = F.col(features_col)
    sums = df.groupBy(label_col).agg(
        F.count(F.lit(1)).alias("n"),
        vector_to_array(Summarizer.mean(x)).alias("m"),
        F.sum(F.aggregate(vector_to_array(x), F.lit(0.0), lambda a, v: a + v * v)).alias("q"),
    )
    own = F.col("q") - F.col("n") * F.aggregate("m", F.lit(0.0), lambda a, v: a + v * v)
    cost, k = sums.agg(F.sum(own), F.count(F.lit(1))).first()
    return {"training_cost": float(cost), "silhouette": silhouette(df, label_col, features_col, n_clusters=k)}


def sum_of_squares(df: DataFrame, label_col: str, features_col: str = "features") -> DataFrame:
    """One row (n, within, between): the sum of squares about the overall mean, split by a labelling."""
    x = F.col(features_col)
    norm = lambda v: F.aggregate(v, F.lit(0.0), lambda a, e: a + e * e)
    per = df.groupBy(label_col).agg(
        F.count(F.lit(1)).alias("n"),
        vector_to_array(Summarizer.mean(x)).alias("m"),
        F.sum(norm(vector_to_array(x))).alias("q"),
    )
    weighted = F.transform("m", lambda e: e * F.col("n"))
    total = per.agg(
        F.sum("n").alias("rows"),
        F.sum(F.col("q") - F.col("n") * norm(F.col("m"))).alias("within"),
        F.sum(F.col("n") * norm(F.col("m"))).alias("b"),
        vector_to_array(Summarizer.sum(array_to_vector(weighted))).alias("s"),
    )
    return total.select(F.col("rows").alias("n"), "within", (F.col("b") - norm(F.col("s")) / F.col("rows")).alias("between"))


def label_centroids(df: DataFrame, label_col: str, features_col: str = "features") -> DataFrame:
    """(label, centroid): mean vector per label, one distributed aggregation."""
    return df.groupBy(label_col).agg(vector_to_array(Summarizer.mean(F.col(features_col))).alias("centroid"))


def nearest_centroid(
    df: DataFrame,
    array_col: str,
    centroids: DataFrame,
    cluster_out: str = "cluster",
    distance_out: str = "distance",
    digits: int = 9,
    block_values: int = CENTROID_VALUES,
) -> DataFrame:
    """Assign each row to its nearest centroid by squared Euclidean distance (M8).

    ``centroids`` has an id and a vector column, in this order. They are materialised and measured, and
    meet the rows as one broadcast row per block of at most ``block_values`` numbers; the best of the blocks
    wins, so there is no limit on their number. Distances are rounded to ``digits`` before ranking and
    ties go to the smallest id. Rows are compared with centroids of their own dimension.
    """
    id_col, vec_col = centroids.columns[:2]
    given = cut_lineage(centroids.select(F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("_c")))
    values = given.agg(F.sum(F.size("_c"))).first()[0] or 0
    blocks = max(1, math.ceil(values / block_values))
    x = F.col(array_col).cast("array<double>")

    def sqdist(c: Column) -> Column:
        diffs = F.zip_with(x, c["_c"], lambda a, b: (a - b) * (a - b))
        d = F.round(F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v), digits)
        return F.struct(d.alias("d"), c["_id"].alias("id"))

    out = df.withColumn("_dim", F.size(array_col)).withColumn("_best", F.lit(None).cast(f"struct<d:double,id:{given.schema['_id'].dataType.simpleString()}>"))
    for b in range(blocks):
        part = given.filter(F.pmod(F.xxhash64("_id"), F.lit(blocks)) == b)
        row = part.groupBy(F.size("_c").alias("_dim")).agg(F.collect_list(F.struct("_id", "_c")).alias("_cents"))
        best = F.array_min(F.transform("_cents", sqdist))
        # a NULL side loses
        out = out.join(F.broadcast(row), "_dim", "left").withColumn("_best", F.least("_best", best)).drop("_cents")
    return out.select(*df.columns, F.col("_best.id").alias(cluster_out), F.col("_best.d").alias(distance_out))
