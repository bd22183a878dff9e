"""Many labellings of the same rows compared at once.

One pass gives the moments of every cluster of every labelling: size, sum of the vectors, sum of their squared
lengths. They determine the cost of each labelling and the mean squared distance of any row to any cluster, so a
second pass gives all silhouettes. The number of passes does not depend on the number of labellings or clusters.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Numbers of the moments that enter one broadcast.
MOMENT_VALUES = 1_000_000


def _norm(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, e: s + e * e)


def _labelled(df: DataFrame, labellings: Mapping[str, Column], features_col: str) -> DataFrame:
    """(labelling, cluster, x): a row per labelling in which the row has a label."""
    x = F.col(features_col) if isinstance(df.schema[features_col].dataType, VectorUDT) else None
    array = vector_to_array(x) if x is not None else F.col(features_col).cast("array<double>")
    pairs = F.array(*[F.struct(F.lit(name).alias("labelling"), label.cast("string").alias("cluster")) for name, label in labellings.items()])
    rows = df.select(array.alias("x"), F.explode(F.filter(pairs, lambda p: p["cluster"].isNotNull())).alias("p"))
    return rows.select("p.labelling", "p.cluster", "x")


def moments(df: DataFrame, labellings: Mapping[str, Column], features_col: str = "features") -> DataFrame:
    """(labelling, cluster, n, q, s): size, sum of squared lengths and sum vector of every cluster."""
    rows = _labelled(df, labellings, features_col)
    return rows.groupBy("labelling", "cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(_norm(F.col("x"))).alias("q"), vector_to_array(Summarizer.sum(array_to_vector(F.col("x")))).alias("s")
    )


def score_labellings(df: DataFrame, labellings: Mapping[str, Column], features_col: str = "features", block_values: int = MOMENT_VALUES) -> DataFrame:
    """(labelling, n, clusters, training_cost, silhouette) of each labelling (name -> label column).

    Cost: sum of squared distances to the cluster means; silhouette: mean by squared Euclidean distances, 0 for the only
    member of a cluster, NULL where a labelling has fewer than two clusters. A NULL label takes the row out of that
    labelling. ``df`` is read twice; the moments are materialised and enter as one broadcast per block of at most
    ``block_values`` numbers, so their number has no limit."""
    found = cut_lineage(moments(df, labellings, features_col))
    values = found.agg(F.sum(F.size("s") + 3)).first()[0] or 0
    blocks = max(1, math.ceil(values / block_values))
    per = found.groupBy("labelling").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("clusters"),
        F.sum(F.col("q") - _norm(F.col("s")) / F.col("n")).alias("training_cost"),
    )
    x, size = F.col("x"), lambda m: m["n"].cast("double")
    rows = _labelled(df, labellings, features_col).withColumns({"_a": F.lit(None).cast("double"), "_b": F.lit(None).cast("double")})
    mean = lambda m: _norm(x) + m["q"] / size(m) - F.lit(2.0) * F.aggregate(F.zip_with(x, m["s"], lambda a, b: a * b), F.lit(0.0), lambda t, e: t + e) / size(m)
    for b in range(blocks):
        part = found.filter(F.pmod(F.xxhash64("labelling", "cluster"), F.lit(blocks)) == b)
        table = part.groupBy("labelling").agg(F.collect_list(F.struct("cluster", "n", "q", "s")).alias("_m"))
        own = F.filter("_m", lambda m: m["cluster"] == F.col("cluster"))
        others = F.filter("_m", lambda m: m["cluster"] != F.col("cluster"))
        # the only member has no distance to others of its own: silhouette 0
        alone = lambda m: F.when(m["n"] > 1, mean(m) * size(m) / (size(m) - 1))
        a, near = F.element_at(F.transform(own, alone), 1), F.array_min(F.transform(others, mean))
        a = F.when(F.size(own) > 0, a)
        rows = rows.join(F.broadcast(table), "labelling", "left").withColumns({"_a": F.coalesce("_a", a), "_b": F.least("_b", near)}).drop("_m")
    top = F.greatest("_a", "_b")
    value = F.when(F.col("_b").isNull(), None).when(F.col("_a").isNull(), 0.0).when(top > 0, (F.col("_b") - F.col("_a")) / top).otherwise(0.0)
    scores = rows.groupBy("labelling").agg(F.avg(value).alias("silhouette"))
    return per.join(scores, "labelling", "left")
