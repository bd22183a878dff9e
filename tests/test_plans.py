import os

from pyspark.sql import functions as F

from football_fixture import TEST, TRAIN
from rateprofile.plans import family_profiles, global_profiles, write_family_outputs, write_global_outputs
from rateprofile.sources.json_sources import load_events, load_lineups, load_sessions


def _inputs(spark, d):
    return (
        load_events(spark, f"{d}/events/*.json"),
        load_lineups(spark, f"{d}/lineups/*.json"),
        load_sessions(spark, f"{d}/matches/*/*.json"),
    )


def test_global_profiles_end_to_end(spark, football_dir, scratch):
    events, segments, sessions = _inputs(spark, football_dir)
    res = global_profiles(
        events, segments, sessions, TRAIN, TEST, k_range=(3, 4, 5), k_override=4, spot_names=["Star"]
    )
    feats = res["features"]
    by_split = {r.split: r["count"] for r in feats.groupBy("split").count().collect()}
    assert by_split["train"] > 0 and by_split["test"] > 0
    assert feats.filter(F.col("total_minutes") < 270).count() == 0
    sweep = res["sweep"].collect()
    assert [r.k for r in sorted(sweep, key=lambda r: r.k)] == [3, 4, 5]
    assert [r.k for r in sweep if r.chosen] == [4]
    train = res["train_clusters"]
    assert train.count() == by_split["train"]
    assert {r.cluster_kmeans for r in train.select("cluster_kmeans").distinct().collect()} <= {0, 1, 2, 3}
    assert res["test_clusters"].count() == by_split["test"]
    assert res["train_profile"].agg(F.sum("n")).first()[0] == by_split["train"]
    assert res["most_blended"].count() == min(15, by_split["train"])
    assert res["spot_check"].count() == 2  # one "Star" per split-side team in the train cohorts
    assert res["cohort_intensity"].count() == 4
    silhouette_k = [r.k for r in sweep if r.silhouette_max][0]
    assert res["model_compare"].count() == (2 if silhouette_k == 4 else 4)
    write_global_outputs(res, scratch)
    assert spark.read.parquet(f"{scratch}/player_features_train").count() == by_split["train"]


def test_family_profiles_end_to_end(spark, football_dir, scratch):
    events, segments, _ = _inputs(spark, football_dir)
    res = family_profiles(events, segments, spot_names=["Star"])
    sizes = {r.family: r for r in res["sizes"].collect()}
    assert not sizes["GK"].eligible  # 8 teams x 1 goalkeeper < 24
    choice = {r.family: r for r in res["choice"].collect()}
    assert "GK" not in choice and set(choice) <= {"DEF", "MID", "FWD"}
    assert res["assignments"].count() == sum(s.n for f, s in sizes.items() if s.eligible)
    assert all("shots_p90" in r.features_used for r in choice.values())
    # a family lists its own columns only
    assert res["profiles"].filter("gk_claims_p90 is not null").count() == 0
    assert res["profiles"].filter("shots_p90 is null").count() == 0
    samples = res["samples"]
    assert samples.groupBy("family", "cluster").count().agg(F.max("count")).first()[0] <= 8
    write_family_outputs(res, scratch)
    parts = sorted(p for p in os.listdir(f"{scratch}/families") if p.startswith("family="))
    assert parts == sorted(f"family={f}" for f in choice)


def test_cli_families(spark, football_dir, scratch):
    from rateprofile.cli import main

    main(["families", "--data", football_dir, "--out", scratch, "--spot", "Star"])
    assert spark.read.parquet(f"{scratch}/report/choice").count() >= 1
    assert spark.read.parquet(f"{scratch}/families").count() > 0


def test_cli_land_then_global_on_parquet(spark, football_dir, scratch):
    import shutil

    from rateprofile.cli import main

    main(["land", "--data", football_dir, "--out", f"{scratch}/bronze", "--matches", f"{football_dir}/matches/*/*.json"])
    with open(f"{scratch}/names.csv", "w") as f:
        f.write("competition_id,season_id,competition_name\n901,1,First Cup\n902,1,Second Cup\n903,2,Third Cup\n904,2,Fourth Cup\n")
    shutil.copytree(f"{football_dir}/matches", f"{scratch}/bronze/matches")
    main(
        ["global", "--data", f"{scratch}/bronze", "--out", f"{scratch}/out", "--parquet", "--k", "3",
         "--names", f"{scratch}/names.csv", "--k-range", "3", "5", "--train", "901:1", "902:1", "--test", "903:2", "904:2", "--spot", "Star"]
    )
    sweep = spark.read.parquet(f"{scratch}/out/report/sweep").collect()
    assert [r.k for r in sweep if r.chosen] == [3]
    assert spark.read.parquet(f"{scratch}/out/player_features_train").count() > 0
    assert spark.read.parquet(f"{scratch}/out/report/cohort_intensity").count() == 4
    assert {r.cohort for r in spark.read.parquet(f"{scratch}/out/report/cohort_intensity").collect()} == {"First Cup", "Second Cup", "Third Cup", "Fourth Cup"}
    assert spark.read.parquet(f"{scratch}/out/report/gmm_profile").count() == 3
