"""Clustering within label families.

One grouped count gives every family's size and its k range (no per-family
count job). Every family is z-scored by its own mean and std in one pass for
all families (``grouped_standardise``); one sweep then fits every k of every family in
shared passes (``sweep_kmeans``), so the number of passes does not grow with families or k.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..session import cut_lineage
from .clustering import DEFAULT_SEED, choose_k, score_row
from .scaling import grouped_standardise
from .sweep import MAX_STEPS, assign, sweep_kmeans

# --- Fixed values: family k-range rule ---------------------------------------------
MIN_PER_CLUSTER = 12
K_MIN = 2
K_CAP = 6
# --- end of fixed values ------------------------------------------------------------


def family_k_ranges(
    features: DataFrame,
    family_col: str,
    min_per_cluster: int = MIN_PER_CLUSTER,
    k_min: int = K_MIN,
    k_cap: int = K_CAP,
) -> DataFrame:
    """Per family: n, the k range ``k_min..max(k_min, min(k_cap, n // min_per_cluster))``
    (M10) and whether the family is large enough to cluster (n >= 2 * min_per_cluster, M11)."""
    sizes = features.groupBy(family_col).agg(F.count(F.lit(1)).alias("n"))
    return sizes.select(
        family_col,
        "n",
        F.lit(k_min).alias("k_min"),
        F.greatest(F.lit(k_min), F.least(F.lit(k_cap), F.floor(F.col("n") / min_per_cluster))).cast("int").alias("k_max"),
        (F.col("n") >= 2 * min_per_cluster).alias("eligible"),
    )


def override_accepted(min_size, min_per_cluster: int = MIN_PER_CLUSTER):
    """The rule of M12, on a number or a column."""
    return min_size >= min_per_cluster


def override_guard(members: DataFrame, family_col: str, cluster_col: str, min_per_cluster: int = MIN_PER_CLUSTER) -> DataFrame:
    """(family, min_size, accepted): whether a proposed clustering of each family may replace the
    chosen one (M12), from its members."""
    sizes = members.groupBy(family_col, cluster_col).agg(F.count(F.lit(1)).alias("n"))
    smallest = sizes.groupBy(family_col).agg(F.min("n").alias("min_size"))
    return smallest.withColumn("accepted", override_accepted(F.col("min_size"), min_per_cluster))


FAMILY_SWEEP_SCHEMA = StructType(
    [
        StructField("family", StringType(), False),
        StructField("k", IntegerType(), False),
        StructField("training_cost", DoubleType(), True),
        StructField("silhouette", DoubleType(), True),
    ]
)
FAMILY_CHOICE_SCHEMA = StructType(
    [
        StructField("family", StringType(), False),
        StructField("n", LongType(), False),
        StructField("silhouette_k", IntegerType(), False),
        StructField("override_k", IntegerType(), True),
        StructField("override_min_size", LongType(), True),
        StructField("chosen_k", IntegerType(), False),
        StructField("chosen_silhouette", DoubleType(), True),
        StructField("overridden", BooleanType(), False),
    ]
)


def cluster_families(
    features: DataFrame,
    id_col: str,
    family_col: str,
    feature_sets: Mapping[str, Sequence[str]],
    default_features: Sequence[str],
    overrides: Mapping[str, int | None] | None = None,
    seed: int = DEFAULT_SEED,
    min_per_cluster: int = MIN_PER_CLUSTER,
    cluster_col: str = "cluster",
    only: Sequence[str] | None = None,
    max_steps: int = MAX_STEPS,
    input_materialised: bool = False,
) -> dict[str, DataFrame]:
    """Per-family scaling, k sweep, override guard (M12) and final assignment.

    Returns ``assignments`` (input columns + ``cluster``; ineligible families are
    not clustered and do not appear), ``sweep`` and ``choice`` tables.
    ``only`` lists the families to cluster (default: all that occur; the driver holds the centres of each, so
    list them where labels are many). An override k is accepted only when its smallest
    cluster has at least ``min_per_cluster`` members (``override_guard``); otherwise the
    silhouette-best k is kept.
    """
    spark = features.sparkSession
    overrides = dict(overrides or {})
    if not input_materialised:  # read twice below: sizes, then scaling
        features = cut_lineage(features)
    wanted = features if only is None else features.filter(F.col(family_col).isin(*only))
    ranges = family_k_ranges(wanted, family_col, min_per_cluster).filter("eligible").collect()
    eligible = {r[family_col]: (int(r["n"]), int(r["k_min"]), int(r["k_max"])) for r in ranges}

    if not eligible:
        return {
            "assignments": features.limit(0).withColumn(cluster_col, F.lit(None).cast("int")),
            "sweep": spark.createDataFrame([], FAMILY_SWEEP_SCHEMA),
            "choice": spark.createDataFrame([], FAMILY_CHOICE_SCHEMA),
        }
    all_cols = sorted({c for cols in [default_features, *feature_sets.values()] for c in cols})
    # one pass z-scores every eligible family, each on its own features
    scaled = grouped_standardise(features.filter(F.col(family_col).isin(*eligible.keys())), family_col, all_cols)
    own = [(fam, F.array(*[F.col(f"z_{c}") for c in feature_sets.get(fam, default_features)])) for fam in sorted(eligible)]
    x = F.coalesce(*[F.when(F.col(family_col) == fam, cols) for fam, cols in own])
    scaled = scaled.select(*features.columns, x.alias("_scaled"))
    ks = {fam: {*range(lo, hi + 1), *([int(overrides[fam])] if overrides.get(fam) is not None else [])} for fam, (_, lo, hi) in eligible.items()}
    fits = sweep_kmeans(scaled, id_col, ks, "_scaled", family_col, seed, max_steps)

    chosen_fits, sweep_rows, choice_rows = [], [], []
    for family in sorted(eligible):
        n, k_lo, k_hi = eligible[family]
        by_k = {t.k: t for t in fits[family]}
        rows = [score_row(by_k[k]) for k in range(k_lo, k_hi + 1)]
        sweep_rows += [(family, r["k"], r["training_cost"], r["silhouette"]) for r in rows]
        best_k = choose_k(rows)
        chosen = by_k[best_k]
        override, override_min = overrides.get(family), None
        if override is not None and int(override) != best_k:
            override_min = by_k[int(override)].min_size
            if override_accepted(override_min, min_per_cluster):
                chosen = by_k[int(override)]
        chosen_fits.append(chosen)
        choice_rows.append((family, n, best_k, override, override_min, chosen.k, chosen.silhouette, chosen.k != best_k))
    out = assign(scaled, chosen_fits, "_scaled", family_col, cluster_col).drop("_scaled")
    out = cut_lineage(out)
    return {
        "assignments": out,
        "sweep": spark.createDataFrame(sweep_rows, FAMILY_SWEEP_SCHEMA),
        "choice": spark.createDataFrame(choice_rows, FAMILY_CHOICE_SCHEMA),
    }
