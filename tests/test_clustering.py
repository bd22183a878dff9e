import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rateprofile.operators import clustering, families, scaling


@pytest.fixture(scope="module")
def emb(spark):
    return spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label")


@pytest.fixture(scope="module")
def emb_np(emb):
    rs = emb.orderBy("vec_id").collect()
    return (
        np.array([r.vec_id for r in rs]),
        np.array([list(r.embedding) for r in rs], dtype=np.float64),
        np.array([r.label for r in rs]),
    )


@pytest.fixture(scope="module")
def fit_input(emb):
    scaled, _ = scaling.standardise(emb, "embedding")
    return clustering.prepare_for_fit(scaled.select("vec_id", "label", "features"), "vec_id")


def _z(x):
    sd = x.std(axis=0, ddof=1)
    return np.where(sd > 0, (x - x.mean(axis=0)) / np.where(sd > 0, sd, 1), 0.0)


def test_standardise_matches_sample_zscore(emb, emb_np):
    ids, x, _ = emb_np
    scaled, _ = scaling.standardise(emb, "embedding")
    got = {r.vec_id: r.z for r in scaled.select("vec_id", vector_to_array("features").alias("z")).collect()}
    z = _z(x)
    assert np.allclose(np.array([got[i] for i in ids]), z, atol=1e-9)


def test_zero_variance_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 2.0), (3, 5.0, 4.0)], "id long, a double, b double")
    scaled, _ = scaling.standardise(df, ["a", "b"])
    assert all(r[0][0] == 0.0 for r in scaled.select(vector_to_array("features")).collect())
    grouped = scaling.grouped_standardise(df.withColumn("g", F.lit("x")), "g", ["a", "b"])
    assert {r.z_a for r in grouped.collect()} == {0.0}


def test_silhouette_matches_brute_force(emb, emb_np):
    ids, x, labels = emb_np
    scaled, _ = scaling.standardise(emb, "embedding")
    got = clustering.silhouette(scaled, "label")
    z = _z(x)
    d = ((z[:, None, :] - z[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(z)):
        own = labels == labels[i]
        a = d[i, own].sum() / (own.sum() - 1) if own.sum() > 1 else 0.0
        b = min(d[i, labels == k].mean() for k in set(labels) if k != labels[i])
        s.append(0.0 if own.sum() == 1 else (b - a) / max(a, b))
    assert abs(got - float(np.mean(s))) < 1e-9


def test_silhouette_single_cluster_is_none(fit_input):
    assert clustering.silhouette(fit_input.withColumn("c", F.lit(0)), "c") is None


def test_kmeans_cost_sizes_and_determinism(fit_input):
    model, preds = clustering.fit_kmeans(fit_input, 4, 42)
    rows = preds.select(vector_to_array("features").alias("x"), "cluster").collect()
    centers = model.clusterCenters()
    sse = sum(float(((np.array(r.x) - centers[r.cluster]) ** 2).sum()) for r in rows)
    assert abs(sse - model.summary.trainingCost) < 1e-6 * max(1.0, sse)
    assert sum(model.summary.clusterSizes) == len(rows)
    again = clustering.fit_kmeans(fit_input, 4, 42)[1]
    a = {r.vec_id: r.cluster for r in preds.select("vec_id", "cluster").collect()}
    b = {r.vec_id: r.cluster for r in again.select("vec_id", "cluster").collect()}
    assert a == b


def test_gmm_probabilities_sum_to_one(fit_input):
    _, preds = clustering.fit_gmm(fit_input, 3, 42)
    for r in preds.select(vector_to_array("probability").alias("p"), "max_prob").collect():
        assert abs(sum(r.p) - 1.0) < 1e-6 and abs(max(r.p) - r.max_prob) < 1e-12


def test_choose_k():
    rows = [{"k": 3, "silhouette": 0.3}, {"k": 4, "silhouette": 0.31}, {"k": 5, "silhouette": 0.31}]
    assert clustering.choose_k(rows) == 4
    assert clustering.choose_k(rows, override=5) == 5
    assert clustering.choose_k([{"k": 2, "silhouette": None}, {"k": 3, "silhouette": None}]) == 2


def test_nearest_centroid_matches_brute_force(emb, emb_np):
    ids, x, labels = emb_np
    cents = clustering.label_centroids(scaling.assemble(emb, "embedding", "v"), "label", "v")
    found = clustering.nearest_centroid(emb, "embedding", cents)
    out = {r.vec_id: (r.cluster, r.distance) for r in found.collect()}
    # in blocks of a few centroids the same
    blocks = clustering.nearest_centroid(emb, "embedding", cents, block_values=150)
    assert {r.vec_id: (r.cluster, r.distance) for r in blocks.collect()} == out
    cents = sorted((r[0], list(r[1])) for r in cents.collect())
    cm = np.array([c[1] for c in cents])
    d = np.round(((x[:, None, :] - cm[None, :, :]) ** 2).sum(-1), 9)
    for i, vid in enumerate(ids):
        j = int(np.argmin(d[i]))
        assert out[vid][0] == cents[j][0]
        assert abs(out[vid][1] - d[i, j]) < 1e-8


def test_family_override_guard(spark, emb):
    wide = emb.select(
        "vec_id",
        F.when(F.col("label") < 5, "LOW").otherwise("HIGH").alias("family"),
        *[F.get("embedding", i).cast("double").alias(f"f{i}") for i in range(6)],
    )
    cols = [f"f{i}" for i in range(6)]
    strict = families.cluster_families(wide, "vec_id", "family", {}, cols, {"LOW": 6}, min_per_cluster=1000)
    assert strict["choice"].count() == 0  # nobody is eligible under a floor of 1000
    n_low = wide.filter("family = 'LOW'").count()
    # k clusters of a family of n leave one with at most n / k members: a floor above that must reject
    floor = n_low // 6 + 1
    rejected = families.cluster_families(wide, "vec_id", "family", {}, cols, {"LOW": 6}, min_per_cluster=floor)
    low = {r.family: r for r in rejected["choice"].collect()}["LOW"]
    assert low.override_k == 6 and low.override_min_size < floor
    assert low.chosen_k == low.silhouette_k != 6 and not low.overridden
    accepted = families.cluster_families(wide, "vec_id", "family", {}, cols, {"LOW": 4}, min_per_cluster=1, only=("LOW",))
    choice = {r.family: r for r in accepted["choice"].collect()}
    assert set(choice) == {"LOW"}  # only the listed family
    low = choice["LOW"]
    assert low.chosen_k == 4 and low.overridden == (low.silhouette_k != 4)
    assert accepted["assignments"].count() == n_low
    guard = {r.family: r for r in families.override_guard(accepted["assignments"], "family", "cluster", 12).collect()}
    sizes = [r["count"] for r in accepted["assignments"].groupBy("cluster").count().collect()]
    assert guard["LOW"].min_size == min(sizes) and guard["LOW"].accepted == (min(sizes) >= 12)
    ranges = {r.family: r for r in families.family_k_ranges(wide, "family").collect()}
    n = ranges["LOW"].n
    assert ranges["LOW"].k_max == max(2, min(6, n // 12))


def test_fit_is_independent_of_upstream_layout(emb):
    """The same rows arriving in different partitionings give the same model:
    prepare_for_fit derives the layout from the data alone."""
    scaled, _ = scaling.standardise(emb, "embedding")
    base = scaled.select("vec_id", "features")
    out = []
    for n in (1, 3, 7):
        data = clustering.prepare_for_fit(base.repartition(n), "vec_id")
        km, preds = clustering.fit_kmeans(data, 4, 42)
        gm, gpreds = clustering.fit_gmm(data, 3, 42)
        out.append(
            (
                round(km.summary.trainingCost, 9),
                {r.vec_id: r.cluster for r in preds.select("vec_id", "cluster").collect()},
                {r.vec_id: r.cluster for r in gpreds.select("vec_id", "cluster").collect()},
            )
        )
    assert out[0] == out[1] == out[2]


def test_family_specific_feature_set(spark, emb):
    """A family with its own feature list (as goalkeepers have) is scaled and
    clustered on exactly those columns."""
    wide = emb.select(
        "vec_id",
        F.when(F.col("label") < 5, "LOW").otherwise("HIGH").alias("family"),
        *[F.get("embedding", i).cast("double").alias(f"f{i}") for i in range(6)],
    )
    res = families.cluster_families(
        wide, "vec_id", "family", {"LOW": ["f0", "f1"]}, [f"f{i}" for i in range(6)], min_per_cluster=3
    )
    out = res["assignments"]
    assert out.count() == wide.count()
    low = out.filter(F.col("family") == "LOW").select("cluster").collect()
    k = {r.family: r.chosen_k for r in res["choice"].collect()}["LOW"]
    assert len({r.cluster for r in low}) <= k
    assert {r.family for r in res["sweep"].collect()} == {"LOW", "HIGH"}


def test_sums_of_squares_and_scores(emb, emb_np):
    ids, x, labels = emb_np
    df = scaling.assemble(emb, "embedding", "features")
    r = clustering.sum_of_squares(df, "label").first()
    within = sum(((x[labels == k] - x[labels == k].mean(axis=0)) ** 2).sum() for k in set(labels))
    assert r.n == len(x) and abs(r.within - within) < 1e-6
    assert abs(r.within + r.between - ((x - x.mean(axis=0)) ** 2).sum()) < 1e-6
    assert abs(clustering.score_labelling(df, "label")["training_cost"] - within) < 1e-6


def test_fits_share_one_copy_and_release_it(spark, emb):
    """A sweep keeps about one copy of its input cached, and nothing is left afterwards."""
    store = spark.sparkContext._jsc
    before = store.getPersistentRDDs().size()
    scaled, _ = scaling.standardise(emb, "embedding")
    with clustering.fitting(scaled.select("vec_id", "features"), "vec_id", 4) as data:
        for k in (3, 4, 5):
            clustering.fit_kmeans(data, k)
        assert store.getPersistentRDDs().size() == before + 1
    assert store.getPersistentRDDs().size() == before
