"""The keyed K-Means sweep against plain numpy, and saved models."""

import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rateprofile.operators import clustering, families, models, scaling, sweep

G = sweep.GRID


@pytest.fixture(scope="module")
def blobs(spark):
    """Two families of three and two heaps, another with fewer different rows than clusters, ids as text."""
    rng = np.random.default_rng(3)
    rows = []
    for family, heaps, n in (("A", 3, 150), ("B", 2, 80)):
        for i in range(n):
            rows.append((f"{family}{i}", family, [float(v) for v in rng.normal(4 * (i % heaps), 0.6, 5 if family == "A" else 3)]))
    rows += [(f"C{i}", "C", [1.0, float(i % 2)]) for i in range(9)]
    return rows, spark.createDataFrame(rows, "id string, family string, x array<double>")


def u(seed, step, i):
    return (int(hashlib.md5(f"{seed}:{step}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def lloyd(rows, k, seed, steps):
    rows = sorted(rows, key=lambda r: (hashlib.md5(f"{seed}:0:{r[0]}".encode()).hexdigest(), r[0]))
    x = np.array([[math.floor(v * G + 0.5) for v in r[1]] for r in rows], float)
    centres = [x[0]]
    while len(centres) < k:
        d = np.min([((x - c) ** 2).sum(1) for c in centres], axis=0)
        if d.max() == 0:
            break
        centres.append(x[min(range(len(x)), key=lambda i: (-math.log(u(seed, len(centres), rows[i][0])) / d[i] if d[i] else math.inf, i))])
    centres = np.array(centres)
    distance = lambda: ((x[:, None, :] - centres[None]) ** 2).sum(-1)
    for _ in range(steps):
        own = distance().argmin(1)
        centres = np.array([np.floor((2 * x[own == c].sum(0) + (own == c).sum()) / (2 * (own == c).sum())) if (own == c).any() else centres[c] for c in range(len(centres))])
    own = distance().argmin(1)
    return centres, {r[0]: int(c) for r, c in zip(rows, own)}, float(distance().min(1).sum()) / G**2, x / G, own


def silhouette(x, own):
    if len(set(own)) < 2:
        return None
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    s = []
    for i, c in enumerate(own):
        mates = (own == c).sum() - 1
        if not mates:
            s.append(0.0)
            continue
        a, b = d[i, own == c].sum() / mates, min(d[i, own == o].mean() for o in set(own) if o != c)
        s.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(s))


def test_matches_numpy(blobs):
    rows, df = blobs
    ks = {"A": [2, 3, 6], "B": [2], "C": [1, 4], "missing": [3]}
    fits = sweep.sweep_kmeans(df, "id", ks, "x", "family", seed=7)
    assert set(fits) == {"A", "B", "C"}
    for family in fits:
        assert [t.k for t in fits[family]] == sorted(ks[family])
        for t in fits[family]:
            centres, own, cost, x, labels = lloyd([(i, v) for i, f, v in rows if f == family], t.k, 7, sweep.MAX_STEPS)
            assert np.array_equal(t.centres, centres)
            assert math.isclose(t.training_cost, cost, rel_tol=1e-12, abs_tol=1e-12)
            want = silhouette(x, labels)
            assert (t.silhouette is None) == (want is None) and (want is None or abs(t.silhouette - want) < 1e-8)
            assert t.sizes == tuple(np.bincount(labels, minlength=len(centres)))
            got = sweep.assign(df, [t], "x", "family").filter(F.col("family") == family).collect()
            assert {r["id"]: r["cluster"] for r in got} == own
    # the heaps are found, and a family with two different rows has two centres at most
    assert max(fits["A"], key=lambda t: t.silhouette).k == 3
    assert len(fits["C"][1].centres) == 2 and fits["C"][0].silhouette is None
    # rows of families without a fit have no cluster
    assert sweep.assign(df, fits["B"], "x", "family").filter("family <> 'B' and cluster is not null").count() == 0


def test_same_result_for_any_layout(blobs):
    _, df = blobs
    seen = []
    for laid in (df.coalesce(1), df.repartition(13), df.orderBy(F.desc("id")).repartition(4, "family")):
        fits = sweep.sweep_kmeans(laid, "id", {"A": range(2, 7), "B": [2, 3]}, "x", "family")
        seen.append({(f, t.k): (t.centres.tolist(), t.training_cost, t.silhouette, t.sizes) for f, ts in fits.items() for t in ts})
    assert seen[0] == seen[1] == seen[2]


def test_ends_early_and_small_inputs(spark, blobs):
    _, df = blobs
    zero = sweep.sweep_kmeans(df, "id", {"A": [3]}, "x", "family", max_steps=0)["A"][0]
    more = [sweep.sweep_kmeans(df, "id", {"A": [3]}, "x", "family", max_steps=n)["A"][0] for n in (30, 60)]
    assert np.array_equal(more[0].centres, more[1].centres) and more[0].training_cost < zero.training_cost
    # few start rows are still rows of the family
    few = sweep.sweep_kmeans(df, "id", {"A": [4]}, "x", "family", start_rows=4)["A"][0]
    assert len(few.centres) == 4 and sum(few.sizes) == 150
    none = spark.createDataFrame([], df.schema)
    assert sweep.sweep_kmeans(none, "id", {"A": [2]}, "x", "family") == {}
    assert sweep.assign(none, [], "x").columns == [*df.columns, "cluster"]
    one = spark.createDataFrame([("a", "A", [1.0])], df.schema)
    fit = sweep.sweep_kmeans(one, "id", [1, 3], "x")[""]
    assert [len(t.centres) for t in fit] == [1, 1] and fit[0].training_cost == 0.0


def test_ties_go_to_the_smaller_cluster(spark):
    df = spark.createDataFrame([(1, [0.0])], "id long, x array<double>")
    fit = sweep.Fit("", 3, np.array([[2.0 * G], [-1.0 * G], [1.0 * G]]))
    assert sweep.assign(df, [fit], "x").first()["cluster"] == 1


def test_silhouette_as_spark_has_it(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    scaled, _ = scaling.standardise(emb, "embedding")
    fit = sweep.sweep_kmeans(scaled, "vec_id", [5])[""][0]
    spark_value = clustering.silhouette(sweep.assign(scaled, [fit]), "cluster")
    assert abs(fit.silhouette - spark_value) < 1e-3  # the grid's rounding
    cost = clustering.score_labelling(sweep.assign(scaled, [fit]), "cluster")["training_cost"]
    assert abs(fit.training_cost - cost) < 1e-2 * cost


def test_families_take_no_more_passes_than_one(spark, blobs):
    """Jobs of a sweep over many families and k: about those of one fit."""
    _, df = blobs
    tracker = spark.sparkContext.statusTracker()

    def jobs(ks, family):
        spark.sparkContext.setJobGroup(f"sweep {ks}", "")
        sweep.sweep_kmeans(df, "id", ks, "x", family, max_steps=4)
        n = len(tracker.getJobIdsForGroup(f"sweep {ks}"))
        spark.sparkContext.setJobGroup("", "")
        return n

    assert jobs({"A": [2, 3, 4, 5, 6], "B": [2, 3, 4, 5]}, "family") <= jobs({"A": [3]}, "family") + 12


# ---- saved models


@pytest.fixture(scope="module")
def fitted(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    wide = emb.select("vec_id", "label", *[F.get("embedding", i).cast("double").alias(f"f{i}") for i in range(6)])
    train, test = wide.filter("label < 5"), wide.filter("label >= 5")
    cols = [f"f{i}" for i in range(6)]
    scaled, scaler = scaling.standardise(train, cols)
    fit = sweep.sweep_kmeans(scaled, "vec_id", [3])[""][0]
    with clustering.fitting(scaled, "vec_id", 2) as laid:
        gmm, _ = clustering.fit_gmm(laid, 3, prediction_col=models.GMM_COL)
    profile = scaled.groupBy("label").count()
    return models.profile_model(scaler, fit, gmm, cols, {"k": 3, "name": "ü"}, profile), scaler, fit, gmm, test, cols


def test_saved_model_equals_the_fitted_one(spark, fitted, scratch):
    model, scaler, fit, gmm, test, cols = fitted
    models.save_model(model, f"{scratch}/m")
    loaded = models.load_model(spark, f"{scratch}/m/")
    assert loaded.settings == {"k": 3, "name": "ü"}
    assert sorted(map(tuple, loaded.profile.collect())) == sorted(map(tuple, model.profile.collect()))
    got, want = (sorted(map(tuple, m.apply(test).collect())) for m in (loaded, model))
    assert got == want and loaded.apply(test).columns == [*test.columns, "cluster_kmeans", "cluster_gmm", "gmm_max_prob"]
    # and the parts, applied one by one
    scaled = scaling.apply_scaler(test, cols, scaler)
    parts = gmm.transform(sweep.assign(scaled, [fit], cluster_out="cluster_kmeans"))
    by_id = {r.vec_id: (r.cluster_kmeans, r.cluster_gmm, max(r.p)) for r in parts.withColumn("p", vector_to_array("probability")).collect()}
    assert {r[0]: tuple(r[-3:]) for r in got} == by_id


def test_model_without_mixture_or_settings(spark, fitted, scratch):
    _, scaler, fit, _, test, cols = fitted
    models.save_model(models.profile_model(scaler, fit, None, cols), f"{scratch}/m")
    loaded = models.load_model(spark, f"{scratch}/m")
    assert loaded.apply(test).columns == [*test.columns, "cluster_kmeans"] and loaded.profile is None and loaded.settings == {}
    # a folder without the settings is no model, nor is one that is not there
    models.profile_model(scaler, fit, None, cols).pipeline.write().save(f"{scratch}/half/pipeline")
    for path in (f"{scratch}/half", f"{scratch}/none"):
        with pytest.raises(ValueError, match="no complete model"):
            models.load_model(spark, path)
    # a model is not written over another
    with pytest.raises(Exception):
        models.save_model(models.profile_model(scaler, fit, None, cols), f"{scratch}/m")


def test_family_columns_and_override_outside_the_range(spark, blobs):
    rows, _ = blobs
    wide = spark.createDataFrame([(i, f, *(v + [0.0] * 5)[:3]) for i, f, v in rows], "id string, family string, a double, b double, c double")
    res = families.cluster_families(wide, "id", "family", {"B": ["a"]}, ["a", "b", "c"], {"A": 9, "B": None}, only=("A", "B"), min_per_cluster=1)
    choice = {r.family: r for r in res["choice"].collect()}
    assert choice["A"].chosen_k == 9 and choice["A"].silhouette_k == 3 and choice["A"].overridden and not choice["B"].overridden
    assert sorted(r.k for r in res["sweep"].collect() if r.family == "A") == [2, 3, 4, 5, 6]
    assert {r.family for r in res["assignments"].select("family").distinct().collect()} == {"A", "B"}
    assert res["assignments"].columns == [*wide.columns, "cluster"]


def test_cli_saves_and_applies_a_model(spark, football_dir, scratch, capsys):
    from rateprofile.cli import main

    common = ["--data", football_dir]
    main(["global", *common, "--out", f"{scratch}/fit", "--train", "901:1", "902:1", "--test", "903:2", "904:2", "--k", "3", "--k-range", "3", "4", "--fit-partitions", "2", "--seed", "5"])
    main(["apply", *common, "--out", f"{scratch}/other", "--model", f"{scratch}/fit/model", "--cohorts", "903:2", "904:2"])
    held, later = (spark.read.parquet(p) for p in (f"{scratch}/fit/player_features_test", f"{scratch}/other/assigned"))
    key = lambda df: {r.player_id: r.cluster_kmeans for r in df.select("player_id", "cluster_kmeans").collect()}
    assert key(held) == key(later) and len(key(held)) > 10
    want, got = (sorted(map(str, spark.read.parquet(p).collect())) for p in (f"{scratch}/fit/report/profile_drift", f"{scratch}/other/profile_drift"))
    assert len(want) == len(got)
    main(["apply", *common, "--out", f"{scratch}/all", "--model", f"{scratch}/fit/model"])
    assert spark.read.parquet(f"{scratch}/all/assigned").count() > len(key(held)) / 2
    # options of other commands are refused
    for wrong in (["families", *common, "--out", scratch, "--k", "3"], ["families", *common, "--out", scratch, "--k-range", "2", "3"], ["land", *common, "--out", scratch, "--seed", "1"]):
        with pytest.raises(SystemExit):
            main(wrong)


def test_cli_preset_and_rejected_match_files(spark, football_dir, scratch, capsys):
    import os
    import shutil

    from rateprofile import cli, presets

    data = f"{scratch}/data"
    shutil.copytree(football_dir, data)
    os.makedirs(f"{data}/matches/905")
    with open(f"{data}/matches/905/1.json", "w") as f:
        f.write('[{"match_id": 1, "match_date"')
    small = presets.Preset(((901, 1, "One"), (902, 1, "Two"), (903, 2, "Three"), (904, 2, "Four")), ((901, 1), (902, 1)), ((903, 2), (904, 2)), 4)
    presets.PRESETS["small"] = small
    try:
        cli.main(["global", "--data", data, "--out", f"{scratch}/out", "--preset", "small", "--k-range", "3", "4"])
    finally:
        del presets.PRESETS["small"]
    assert [r.k for r in spark.read.parquet(f"{scratch}/out/report/sweep").collect() if r.chosen] == [4]
    assert {r.cohort for r in spark.read.parquet(f"{scratch}/out/report/cohort_intensity").collect()} == {"One", "Two", "Three", "Four"}
    bad = spark.read.parquet(f"{scratch}/out/report/rejected_matches").collect()
    assert len(bad) == 1 and bad[0].source_file.endswith("905/1.json")
    assert "matches: 1 records rejected" in capsys.readouterr().out
    assert json.dumps(presets.TRAIN) and set(presets.TRAIN) | set(presets.TEST) == {c[:2] for c in presets.COHORTS}
