import contextlib
import glob
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rateprofile.sources.json_sources import (
    explode_path,
    flatten,
    load_events,
    load_lineups,
    load_rejected,
    load_sessions,
    missing_sessions,
    optional_field,
    path_key,
)
from rateprofile.sources.schemas import EVENT_SCHEMA, LINEUP_SCHEMA
from rateprofile.sources.sinks import write_parquet
from rateprofile.streaming import Landed, land_events, land_lineups


def test_load_events_keys_and_shape(spark, football_dir):
    ev = load_events(spark, f"{football_dir}/events/*.json")
    assert {"match_id", "id", "type_name", "player_id", "location", "pass_outcome_name", "goalkeeper_type_name"} <= set(ev.columns)
    assert len(ev.columns) == len(set(ev.columns)) and all("." not in c for c in ev.columns)
    files = sorted(glob.glob(f"{football_dir}/events/*.json"))
    expected = {int(os.path.basename(p)[:-5]): len(json.load(open(p))) for p in files}
    got = {r.match_id: r["count"] for r in ev.groupBy("match_id").count().collect()}
    assert got == expected
    # miscontrol flags occur; a field never present in the data is NULL, not an error
    assert ev.filter(F.col("player_id").isNull()).count() == len(files)  # one "Half Start" per match
    assert ev.select("shot_aerial_won").distinct().collect() == [(None,)]


def test_load_lineups_explode_outer(spark, football_dir):
    lu = load_lineups(spark, f"{football_dir}/lineups/*.json")
    one = lu.filter(F.col("match_id") == 3001)
    # 2 teams x 16 players; player 7 has two segments; unused substitutes keep one NULL row
    assert one.count() == 2 * 17
    assert one.filter(F.col("positions_position").isNull()).count() == 2 * 4
    assert one.filter(F.col("positions_to").isNull() & F.col("positions_position").isNotNull()).count() == 2 * 11


def test_sessions_from_paths(spark, football_dir):
    s = load_sessions(spark, f"{football_dir}/matches/*/*.json")
    got = rows(s.groupBy("competition_id", "season_id", "season_year").count())
    assert got == [(901, 1, 2022, 6), (902, 1, 2023, 6), (903, 2, 2023, 6), (904, 2, 2024, 6)]


def test_missing_sessions_anti_join(spark):
    manifest = spark.createDataFrame([(1,), (2,), (3,)], "match_id long")
    landed = spark.createDataFrame([(1,), (1,), (3,)], "match_id long")
    assert rows(missing_sessions(manifest, landed, "match_id")) == [(2,)]


def test_optional_field_and_path_key(spark, scratch):
    df = spark.createDataFrame([((1,),)], "s struct<a:long>")
    out = df.select(optional_field(df, "s.a", "long", "a"), optional_field(df, "s.b", "boolean", "b")).first()
    assert out.a == 1 and out.b is None
    p = f"{scratch}/notakey.parquet"
    spark.range(2).write.parquet(p)
    assert [r.k for r in spark.read.parquet(p).select(path_key().alias("k")).collect()] == [None, None]


def test_parquet_round_trip(spark, scratch):
    df = spark.createDataFrame([(1, "a", 0.5), (2, "b", None)], "id long, family string, x double")
    write_parquet(df, f"{scratch}/t", partition_by=("family",))
    back = spark.read.parquet(f"{scratch}/t")
    assert rows(back, "id", "family", "x") == [(1, "a", 0.5), (2, "b", None)]
    assert sorted(p for p in os.listdir(f"{scratch}/t") if p.startswith("family=")) == ["family=a", "family=b"]


def test_streaming_landing_matches_batch_scan(spark, football_dir, scratch):
    n = land_events(spark, f"{football_dir}/events", f"{scratch}/events", f"{scratch}/ck_events", max_files=2).records
    batch = load_events(spark, f"{football_dir}/events/*.json")
    assert n == batch.count()
    landed = spark.read.parquet(f"{scratch}/events")
    assert landed.count() == n
    assert rows(landed.groupBy("match_id").count()) == rows(batch.groupBy("match_id").count())
    # a second run finds nothing new
    assert land_events(spark, f"{football_dir}/events", f"{scratch}/events", f"{scratch}/ck_events") == Landed(0, 0)
    teams = land_lineups(spark, f"{football_dir}/lineups", f"{scratch}/lineups", f"{scratch}/ck_lineups").records
    assert teams == 2 * len(os.listdir(f"{football_dir}/lineups"))
    batch_lu = load_lineups(spark, f"{football_dir}/lineups/*.json")
    assert rows(spark.read.parquet(f"{scratch}/lineups").select(*batch_lu.columns)) == rows(batch_lu)


def test_json_lines_input_matches_arrays(spark, football_dir, scratch):
    """The same events as JSON Lines (splittable) load to the same rows."""
    os.makedirs(f"{scratch}/jl")
    for p in sorted(glob.glob(f"{football_dir}/events/*.json"))[:3]:
        with open(p) as f, open(f"{scratch}/jl/{os.path.basename(p)}", "w") as g:
            for rec in json.load(f):
                g.write(json.dumps(rec) + "\n")
    jl = load_events(spark, f"{scratch}/jl/*.json", multi_line=False)
    arr = load_events(spark, f"{football_dir}/events/*.json").filter(F.col("match_id").isin(*[
        int(os.path.basename(p)[:-5]) for p in glob.glob(f"{scratch}/jl/*.json")
    ]))
    cols = ["match_id", "id", "type_name", "player_id", "minute", "second"]
    assert rows(jl, *cols) == rows(arr, *cols)


def test_landing_partitioned_by_cohort(spark, football_dir, scratch):
    sessions = load_sessions(spark, f"{football_dir}/matches/*/*.json")
    land_events(spark, f"{football_dir}/events", f"{scratch}/ev", f"{scratch}/ck", sessions=sessions)
    parts = sorted(p for p in os.listdir(glob.glob(f"{scratch}/ev/batch_id=*")[0]) if p.startswith("competition_id="))
    assert parts == ["competition_id=901", "competition_id=902", "competition_id=903", "competition_id=904"]
    landed = spark.read.parquet(f"{scratch}/ev")
    one = landed.filter((F.col("competition_id") == 901) & (F.col("season_id") == 1))
    batch = load_events(spark, f"{football_dir}/events/*.json").join(
        sessions.filter("competition_id = 901").select("match_id"), "match_id", "left_semi"
    )
    assert one.count() == batch.count() > 0
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        one.explain(mode="formatted")
    pruning = [line for line in buf.getvalue().splitlines() if line.startswith("PartitionFilters")][0]
    assert "competition_id" in pruning and "901" in pruning and "season_id" in pruning


def _broken(football_dir, scratch):
    """A copy of two sessions, one of them truncated in the middle of its array."""
    files = sorted(glob.glob(f"{football_dir}/events/*.json"))[:2]
    os.makedirs(f"{scratch}/events")
    for i, p in enumerate(files):
        text = open(p).read()
        with open(f"{scratch}/events/{os.path.basename(p)}", "w") as f:
            f.write(text if i else text[: len(text) // 2])
    return [int(os.path.basename(p)[:-5]) for p in files], len(json.load(open(files[1])))


def test_truncated_file_is_rejected_not_lost(spark, football_dir, scratch):
    (bad, good), n = _broken(football_dir, scratch)
    ev = load_events(spark, f"{scratch}/events/*.json")
    assert rows(ev.groupBy("match_id").count()) == [(good, n)]
    reject = load_rejected(spark, f"{scratch}/events/*.json", EVENT_SCHEMA).collect()
    assert [os.path.basename(r.source_file) for r in reject] == [f"{bad}.json"] and reject[0].record
    assert load_rejected(spark, f"{scratch}/events/*.json", EVENT_SCHEMA).count() == 1
    assert load_rejected(spark, f"{football_dir}/lineups/*.json", LINEUP_SCHEMA).count() == 0
    # the session counts as missing, not as landed
    manifest = spark.createDataFrame([(bad,), (good,)], "match_id long")
    assert rows(missing_sessions(manifest, ev, "match_id")) == [(bad,)]
    # and the landing reports it and keeps its text
    landed = land_events(spark, f"{scratch}/events", f"{scratch}/out", f"{scratch}/ck")
    assert landed == Landed(n, 1)
    assert spark.read.parquet(f"{scratch}/out").count() == n
    assert [os.path.basename(r.source_file) for r in spark.read.parquet(f"{scratch}/out_rejected").collect()] == [f"{bad}.json"]


def test_landing_counts_all_batches(spark, football_dir, scratch):
    """More batches than the progress history of a query keeps."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        landed = land_events(spark, f"{football_dir}/events", f"{scratch}/ev", f"{scratch}/ck", max_files=4)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert landed.records == spark.read.parquet(f"{scratch}/ev").count() > 0
    assert len(glob.glob(f"{scratch}/ev/batch_id=*")) > 2


def test_unreadable_date_is_null(spark, scratch):
    os.makedirs(f"{scratch}/9")
    with open(f"{scratch}/9/1.json", "w") as f:
        json.dump([{"match_id": 1, "match_date": "TBC"}, {"match_id": 2, "match_date": "2024-02-03"}], f)
    names = spark.createDataFrame([(9, 1, "Cup")], "competition_id long, season_id long, competition_name string")
    s = load_sessions(spark, f"{scratch}/*/*.json", names)
    assert rows(s, "match_id", "season_year", "competition_name") == [(1, None, "Cup"), (2, 2024, "Cup")]


def test_flatten_and_explode_path(spark):
    df = spark.createDataFrame([(1, ({"a": 1}, [(2, [(3, "x"), (4, "y")]), (5, [])]))], "k long, s struct<m:map<string,int>,l:array<struct<p:int,q:array<struct<r:int,t:string>>>>>")
    assert flatten(df).columns == ["k", "s_m", "s_l"]
    outer = explode_path(explode_path(df.select("k", "s.l"), "l"), "l.q", keep_empty=True)
    assert rows(flatten(outer, plain=("l",)), "k", "p", "q_r", "q_t") == [(1, 2, 3, "x"), (1, 2, 4, "y"), (1, 5, None, None)]
    inner = explode_path(explode_path(df.select("k", "s.l"), "l"), "l.q")
    assert inner.count() == 2
    clash = spark.createDataFrame([(1, (2,))], "a_b int, a struct<b:int>")
    with pytest.raises(ValueError):
        flatten(clash)
