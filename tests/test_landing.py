"""Deliveries, incremental entity tables and published tables."""

import glob
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rateprofile.operators import deliveries
from rateprofile.plans.common import player_features, player_match_stats, player_minutes
from rateprofile.sources import load_events, load_lineups, load_sessions
from rateprofile.sources.published import parts_of, publish, read_published
from rateprofile.streaming import entity_profiles, land, land_events, read_deliveries, read_entities, read_landed, update_entities


def _copy(src, dst, names=None):
    os.makedirs(dst, exist_ok=True)
    for p in sorted(glob.glob(f"{src}/*.json")):
        if names is None or os.path.basename(p) in names:
            shutil.copy(p, dst)


def _later(path, seconds):
    t = os.path.getmtime(path) + seconds
    os.utime(path, (t, t))


# ---- deliveries


def test_last_delivery(spark):
    d = spark.createDataFrame(
        [(1, 10, 1, "a"), (1, 11, 2, "a"), (2, 12, 5, "b"), (2, 13, 5, "c"), (3, 14, None, "d"), (3, 15, 0, "a"), (None, 16, 1, "x"), (None, 17, 2, "x")],
        "s long, delivery long, t int, file string",
    )
    last = deliveries.last_deliveries(d, "s", ("t", "file"))
    assert last.columns == d.columns
    assert sorted(r.delivery for r in last.collect()) == [11, 13, 15, 16, 17]
    data = spark.createDataFrame([(1, 10, "old"), (1, 11, "new"), (2, 12, "old"), (None, 16, "kept"), (9, 99, "unknown")], "s long, delivery long, v string")
    for limit in (100, 0):
        got = deliveries.current_rows(data, last, ["s", "delivery"], broadcast_rows=limit)
        assert got.columns == data.columns and sorted(r.v for r in got.collect()) == ["kept", "new"]


def test_changed_sessions_and_refresh(spark):
    schema = "s long, e long, l long"
    now = spark.createDataFrame([(1, 1, 1), (2, 2, None), (3, 3, 3), (5, 5, 5)], schema)
    was = spark.createDataFrame([(1, 1, 1), (2, 2, None), (3, 3, 4), (4, 4, 4)], schema)
    assert sorted(r.s for r in deliveries.changed_sessions(now, was, "s", ["e", "l"]).collect()) == [3, 4, 5]
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c")], "k long, v string")
    touched = spark.createDataFrame([(2,), (2,), (3,)], "k long")
    assert rows(deliveries.refresh(old, touched, new, ["k"])) == [(1, "a"), (2, "c")]
    assert rows(deliveries.refresh(None, touched, new, ["k"])) == [(2, "c")]
    gone = spark.createDataFrame([], "k long, v string")
    assert rows(deliveries.refresh(old, touched, gone, ["k"])) == [(1, "a")]


def test_file_landed_twice_under_two_names(spark, football_dir, scratch):
    src = f"{scratch}/events"
    _copy(f"{football_dir}/events", src)
    first = sorted(glob.glob(f"{src}/*.json"))[0]
    match = int(os.path.basename(first)[:-5])
    land_events(spark, src, f"{scratch}/out", f"{scratch}/ck")
    before = rows(read_landed(spark, f"{scratch}/out").groupBy("match_id").count())
    # the same file again, then a corrected one with an event less
    again = f"{src}/again-{match}.json"
    shutil.copy(first, again)
    land_events(spark, src, f"{scratch}/out", f"{scratch}/ck")
    assert rows(read_landed(spark, f"{scratch}/out").groupBy("match_id").count()) == before
    events = json.load(open(first))
    fixed = f"{src}/fixed-{match}.json"
    json.dump(events[:-1], open(fixed, "w"))
    _later(fixed, 60)
    late = f"{src}/late-{match}.json"  # arrives last, but is older than what is there
    json.dump(events[:5], open(late, "w"))
    _later(late, -3600)
    land_events(spark, src, f"{scratch}/out", f"{scratch}/ck", max_files=1)
    got = dict(rows(read_landed(spark, f"{scratch}/out").groupBy("match_id").count()))
    assert got == {**dict(before), match: len(events) - 1}
    assert read_deliveries(spark, f"{scratch}/out").filter(F.col("match_id") == match).count() == 4
    # a correction that cannot be parsed leaves what is there
    broken = f"{src}/broken-{match}.json"
    open(broken, "w").write(json.dumps(events)[:500])
    _later(broken, 600)
    assert land_events(spark, src, f"{scratch}/out", f"{scratch}/ck").rejected == 1
    assert dict(rows(read_landed(spark, f"{scratch}/out").groupBy("match_id").count())) == got


def test_lost_checkpoint_and_unfinished_batch(spark, football_dir, scratch):
    names = [os.path.basename(p) for p in sorted(glob.glob(f"{football_dir}/events/*.json"))[:3]]
    _copy(f"{football_dir}/events", f"{scratch}/events", names)
    land_events(spark, f"{scratch}/events", f"{scratch}/out", f"{scratch}/ck", max_files=1)
    want = rows(read_landed(spark, f"{scratch}/out").select("match_id", "id"))
    batches = glob.glob(f"{scratch}/out/batch_id=*")
    # landed again under a new checkpoint: nothing is overwritten, nothing counts twice
    land_events(spark, f"{scratch}/events", f"{scratch}/out", f"{scratch}/ck2", max_files=2)
    assert set(batches) < set(glob.glob(f"{scratch}/out/batch_id=*"))
    assert rows(read_landed(spark, f"{scratch}/out").select("match_id", "id")) == want
    # rows of a batch that did not finish are not read
    spark.read.parquet(batches[0]).write.parquet(f"{scratch}/out/batch_id=stopped-00000000")
    assert rows(read_landed(spark, f"{scratch}/out").select("match_id", "id")) == want
    kept = read_landed(spark, f"{scratch}/out", keep_delivery=True)
    assert {"delivery", "batch_id"} <= set(kept.columns) and kept.count() == len(want)


# ---- entity tables


def _full(spark, data):
    events, segments = load_events(spark, f"{data}/events/*.json"), load_lineups(spark, f"{data}/lineups/*.json")
    return player_features(player_match_stats(events), player_minutes(events, segments), 0.0)


def _same(a, b):
    cols = sorted(b.columns)
    tidy = lambda df: rows(df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.select(*cols).dtypes]))
    assert sorted(a.columns) == cols and tidy(a) == tidy(b)


def test_entities_follow_the_files(spark, football_dir, scratch):
    data, out = f"{scratch}/data", f"{scratch}/out"
    names = [os.path.basename(p) for p in sorted(glob.glob(f"{football_dir}/events/*.json"))]
    for what in ("events", "lineups"):
        _copy(f"{football_dir}/{what}", f"{data}/{what}", names[:-1])
    land(spark, data, out)
    done = update_entities(spark, out)
    assert done.sessions == len(names) - 1
    _same(entity_profiles(read_entities(spark, out), 0.0), _full(spark, data))
    versions = {r.part: r.version for r in parts_of(spark, f"{out}/entities").collect()}
    assert update_entities(spark, out).sessions == 0 and {r.part: r.version for r in parts_of(spark, f"{out}/entities").collect()} == versions

    # one more match: its players alone are rebuilt, other parts stay as they are
    for what in ("events", "lineups"):
        _copy(f"{football_dir}/{what}", f"{data}/{what}", names[-1:])
    land(spark, data, out)
    done = update_entities(spark, out)
    lineup = json.load(open(f"{data}/lineups/{names[-1]}"))
    players = {p["player_id"] for t in lineup for p in t["lineup"] if p["positions"]} | {e["player"]["id"] for e in json.load(open(f"{data}/events/{names[-1]}")) if e.get("player")}
    assert done.sessions == 1 and done.players == len(players)
    after = {r.part: r.version for r in parts_of(spark, f"{out}/entities").collect()}
    assert sum(after[p] != versions.get(p) for p in after) == done.parts < len(after)
    _same(entity_profiles(read_entities(spark, out), 0.0), _full(spark, data))

    # a corrected match without one of its players, who has no other
    events, match = json.load(open(f"{data}/events/{names[0]}")), names[0]
    gone = events[0].get("player") or next(e["player"] for e in events if e.get("player"))
    fixed = [e for e in events if (e.get("player") or {}).get("id") != gone["id"]]
    json.dump(fixed, open(f"{data}/events/fixed-{match}", "w"))
    _later(f"{data}/events/fixed-{match}", 60)
    land(spark, data, out)
    assert update_entities(spark, out).sessions == 1
    plain = f"{scratch}/plain"
    for what in ("events", "lineups"):
        _copy(f"{data}/{what}", f"{plain}/{what}", names)
    json.dump(fixed, open(f"{plain}/events/{match}", "w"))
    _same(entity_profiles(read_entities(spark, out), 0.0), _full(spark, plain))


def test_update_reads_partial_aggregates_only(spark, football_dir, scratch):
    data, out = f"{scratch}/data", f"{scratch}/out"
    names = [os.path.basename(p) for p in sorted(glob.glob(f"{football_dir}/events/*.json"))[:2]]
    for what in ("events", "lineups"):
        _copy(f"{football_dir}/{what}", f"{data}/{what}", names)
    land(spark, data, out)
    # tables without the landed rows: an update has all it needs
    for t in ("events_summary", "events_deliveries", "lineups_summary", "lineups_deliveries"):
        shutil.copytree(f"{out}/{t}", f"{scratch}/only/{t}")
    assert update_entities(spark, f"{scratch}/only").sessions == 2
    update_entities(spark, out)
    assert rows(read_entities(spark, f"{scratch}/only")) == rows(read_entities(spark, out))


def test_cli_land_with_entities(spark, football_dir, scratch, capsys):
    from rateprofile.cli import main

    args = ["land", "--data", football_dir, "--out", scratch, "--entities", "--matches", f"{football_dir}/matches/*/*.json"]
    main(args)
    assert "players rebuilt" in capsys.readouterr().out
    want = _full(spark, football_dir).filter("total_minutes >= 270")
    _same(spark.read.parquet(f"{scratch}/player_features"), want)
    main(args)
    assert "entities: 0 sessions changed" in capsys.readouterr().out
    assert load_sessions(spark, f"{football_dir}/matches/*/*.json").count() > 0


# ---- published tables

T = "family string, v long"


def test_publish_parts(spark, scratch):
    path = f"{scratch}/t"
    both = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), (None, 4)], T)
    assert publish(both, path, "family") == 1
    assert rows(read_published(spark, path).na.fill("-")) == [("-", 4), ("A", 1), ("A", 2), ("B", 3)]
    folders = {r.part: r.folder for r in parts_of(spark, path).collect()}
    # a rerun of one family touches its folder only
    assert publish(spark.createDataFrame([("A", 9)], T), path, "family") == 2
    now = {r.part: r for r in parts_of(spark, path).collect()}
    assert now["B"].folder == folders["B"] and now["A"].folder != folders["A"] and now["A"].rows == 1
    assert rows(read_published(spark, path, parts=["A", "B"])) == [("A", 9), ("B", 3)]
    # a part can become empty, and the whole table
    publish(spark.createDataFrame([("A", 5)], T), path, "family", replace=["A", "B", ""])
    assert rows(read_published(spark, path)) == [("A", 5)]
    whole = f"{scratch}/whole"
    publish(both, whole)
    publish(both.filter("v > 2"), whole)
    assert sorted(r.v for r in read_published(spark, whole).collect()) == [3, 4]
    publish(both.limit(0), whole)
    assert read_published(spark, whole).count() == 0 and read_published(spark, whole).columns == ["family", "v"]


def test_stopped_write_leaves_the_old_table(spark, scratch):
    path = f"{scratch}/t"
    publish(spark.createDataFrame([("A", 1), ("B", 2)], T), path, "family")
    bad = spark.createDataFrame([("A", 5), ("B", 0)], T).withColumn("v", F.when(F.col("v") == 0, F.raise_error(F.lit("stopped"))).otherwise(F.col("v")).cast("long"))
    with pytest.raises(Exception, match="stopped"):
        publish(bad, path, "family")
    assert rows(read_published(spark, path)) == [("A", 1), ("B", 2)]
    # also one that wrote its data and stopped before the manifest
    spark.createDataFrame([("A", 7)], T).write.partitionBy("family").parquet(f"{path}/data/00000002-x")
    assert rows(read_published(spark, path)) == [("A", 1), ("B", 2)]
    assert publish(spark.createDataFrame([("B", 3)], T), path, "family") == 2
    assert rows(read_published(spark, path)) == [("A", 1), ("B", 3)]


def test_missing_table(spark, scratch):
    with pytest.raises(ValueError):
        read_published(spark, f"{scratch}/none")
    assert rows(read_published(spark, f"{scratch}/none", T)) == []
    assert parts_of(spark, f"{scratch}/none").count() == 0
