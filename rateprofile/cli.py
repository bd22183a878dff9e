"""Command line: run a pipeline on a folder of session JSON files.

    python -m rateprofile global   --data DATA --out OUT [--preset tournaments | --train C:S ... --test C:S ...] [--k 5]
    python -m rateprofile families --data DATA --out OUT
    python -m rateprofile apply    --data DATA --out OUT --model OUT_OF_GLOBAL/model [--cohorts C:S ...]
    python -m rateprofile land     --data DATA --out OUT   (JSON -> Parquet, incremental)

DATA holds ``events/*.json``, ``lineups/*.json`` and ``matches/{cohort}/{season}.json``.
The session comes from ``spark-submit`` / the environment; nothing here sets
cluster resources. An option that a command does not know is an error, not ignored.
"""

from __future__ import annotations

import argparse

import contextlib

from pyspark.sql import DataFrame, SparkSession

from .functions.predicates import MIN_EXPOSURE_MINUTES
from .operators.families import MIN_PER_CLUSTER
from .operators.models import load_model, save_model
from .plans import apply_profiles, family_profiles, global_profiles, write_family_outputs, write_global_outputs
from .plans.family_profiles import FAMILY_OVERRIDES, SEED
from .plans.global_profiles import K_RANGE
from .presets import PRESETS
from .sources.json_sources import explode_segments, flatten_events, json_input, load_sessions, session_dimension, session_keys
from .sources.schemas import EVENT_SCHEMA, LINEUP_SCHEMA, MATCH_SCHEMA
from .sources.sinks import write_parquet
from .streaming import entity_profiles, land, read_entities, read_landed, update_entities

NAMES_SCHEMA = "competition_id long, season_id long, competition_name string"
GLOBAL_REPORTS = ("sweep", "train_profile", "gmm_profile", "test_profile", "profile_drift", "cross_tab", "model_compare", "most_blended", "cohort_intensity", "spot_check")
FAMILY_REPORTS = ("sizes", "choice", "sweep", "profiles", "cross_tab", "samples", "spot_check")


def _pairs(values):
    return [tuple(int(p) for p in v.split(":")) for v in values or []]


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="rateprofile")
    commands = ap.add_subparsers(dest="command", required=True)
    everywhere = argparse.ArgumentParser(add_help=False)
    everywhere.add_argument("--data", required=True, help="folder with events/, lineups/ and matches/ (or landed Parquet)")
    everywhere.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    everywhere.add_argument("--matches", help="match files ({cohort}/{season}.json, a glob); default: DATA/matches/*/*.json; "
                            "given to land, the landed tables are partitioned by cohort")
    reads = argparse.ArgumentParser(add_help=False)
    reads.add_argument("--parquet", action="store_true", help="read events/lineups landed as Parquet under --data")
    fits = argparse.ArgumentParser(add_help=False)
    fits.add_argument("--spot", nargs="*", default=[], help="name substrings to spot-check")
    fits.add_argument("--ignore-case", action="store_true", help="spot checks ignore case")
    fits.add_argument("--min-minutes", type=float, default=MIN_EXPOSURE_MINUTES, help="least minutes of a profiled entity")
    fits.add_argument("--end-mode", choices=["reference", "exact"], default="reference")
    fits.add_argument("--exposure-mode", choices=["span", "sum_segments"], default="span")
    fits.add_argument("--seed", type=int, default=SEED)
    fits.add_argument("--published", action="store_true", help="entity tables behind a manifest: readers never see half a write")

    one = commands.add_parser("global", parents=[everywhere, reads, fits], help="pipeline L1")
    one.add_argument("--preset", choices=sorted(PRESETS), help="cohorts, their names, train and test lists and k, unless given")
    one.add_argument("--train", nargs="*", help="competition:season pairs fitted on")
    one.add_argument("--test", nargs="*", help="competition:season pairs held out")
    one.add_argument("--k", type=int, help="override the silhouette-chosen k")
    one.add_argument("--k-range", type=int, nargs=2, metavar=("FIRST", "LAST"), default=(K_RANGE[0], K_RANGE[-1]))
    one.add_argument("--names", help="CSV with header: competition_id,season_id,competition_name, shown in the reports")
    one.add_argument("--per-period-denominator", action="store_true", help="intensity per cohort and year over the minutes of that year")
    one.add_argument("--model-name", default="model", help="folder under OUT for the fitted model; it must not hold one already")
    one.add_argument("--fit-partitions", type=int, help="partitions of the mixture's input (its fit depends on them)")

    two = commands.add_parser("families", parents=[everywhere, reads, fits], help="pipeline L2")
    two.add_argument("--family-k", nargs="*", default=[], metavar="FAMILY=K", help="override the k of a family (FAMILY= for none)")
    two.add_argument("--min-cluster-size", type=int, default=MIN_PER_CLUSTER, help="least members of a cluster of an override")

    three = commands.add_parser("apply", parents=[everywhere, reads], help="a model saved by global, on other matches")
    three.add_argument("--model", required=True, help="folder of the model: OUT/model of a global run")
    three.add_argument("--cohorts", nargs="*", help="competition:season pairs (default: all matches)")

    four = commands.add_parser("land", parents=[everywhere], help="JSON to Parquet, incremental")
    four.add_argument("--entities", action="store_true", help="keep the totals and features of all players up to date, too")
    four.add_argument("--end-mode", choices=["reference", "exact"], default="reference")
    return ap


def main(argv=None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"rateprofile-{args.command}").getOrCreate()
    data, out = args.data.rstrip("/"), args.out.rstrip("/")
    with contextlib.ExitStack() as stack:
        if args.command == "land":
            _land(spark, args, data, out)
            return
        events, segments = _inputs(spark, args, data, out, stack)
        if args.command == "global":
            _global(spark, args, data, out, stack, events, segments)
        elif args.command == "families":
            _families(args, out, events, segments)
        else:
            sessions = _sessions(spark, args, data, out, stack, None) if args.cohorts else None
            res = apply_profiles(load_model(spark, args.model), events, segments, sessions, _pairs(args.cohorts))
            for name, table in res.items():
                write_parquet(table, f"{out}/{name}")


def _rejects(bad: DataFrame, what: str, out: str) -> None:
    write_parquet(bad, f"{out}/report/rejected_{what}")
    n = bad.count()
    if n:
        print(f"{what}: {n} records rejected, see {out}/report/rejected_{what}")


def _inputs(spark, args, data, out, stack) -> tuple[DataFrame, DataFrame]:
    if args.parquet:
        return read_landed(spark, f"{data}/events"), read_landed(spark, f"{data}/lineups")
    tables = []
    for what, schema, flat in (("events", EVENT_SCHEMA, flatten_events), ("lineups", LINEUP_SCHEMA, explode_segments)):
        rows, bad = stack.enter_context(json_input(spark, f"{data}/{what}/*.json", schema, flat))
        _rejects(bad, what, out)
        tables.append(rows)
    return tables[0], tables[1]


def _sessions(spark, args, data, out, stack, names) -> DataFrame:
    path = args.matches or f"{data}/matches/*/*.json"
    rows, bad = stack.enter_context(json_input(spark, path, MATCH_SCHEMA, lambda raw: session_dimension(raw, names), session_keys()))
    _rejects(bad, "matches", out)
    return rows


def _global(spark, args, data, out, stack, events, segments) -> None:
    preset = PRESETS.get(args.preset)
    names = spark.read.schema(NAMES_SCHEMA).option("header", True).csv(args.names) if args.names else None
    if names is None and preset:
        names = spark.createDataFrame(list(preset.cohorts), NAMES_SCHEMA)
    given = lambda value, name: value if value is not None else getattr(preset, name) if preset else None
    train, test = (_pairs(v) if v is not None else list(getattr(preset, n)) if preset else [] for v, n in ((args.train, "train"), (args.test, "test")))
    res = global_profiles(
        events,
        segments,
        _sessions(spark, args, data, out, stack, names),
        train,
        test,
        min_minutes=args.min_minutes,
        k_range=range(args.k_range[0], args.k_range[1] + 1),
        k_override=given(args.k, "k"),
        seed=args.seed,
        spot_names=args.spot,
        ignore_case=args.ignore_case,
        partitions=args.fit_partitions,
        end_mode=args.end_mode,
        exposure_mode=args.exposure_mode,
        per_period_denominator=args.per_period_denominator,
    )
    write_global_outputs(res, out, args.published)
    save_model(res["model"], f"{out}/{args.model_name}")
    for name in GLOBAL_REPORTS:
        write_parquet(res[name], f"{out}/report/{name}")


def _families(args, out, events, segments) -> None:
    overrides = {**FAMILY_OVERRIDES, **{f: int(k) if k else None for f, k in (x.split("=") for x in args.family_k)}}
    res = family_profiles(
        events,
        segments,
        overrides=overrides,
        min_minutes=args.min_minutes,
        seed=args.seed,
        spot_names=args.spot,
        ignore_case=args.ignore_case,
        min_per_cluster=args.min_cluster_size,
        end_mode=args.end_mode,
        exposure_mode=args.exposure_mode,
    )
    write_family_outputs(res, out, args.published)
    for name in FAMILY_REPORTS:
        write_parquet(res[name], f"{out}/report/{name}")


def _land(spark, args, data, out) -> None:
    sessions = load_sessions(spark, args.matches) if args.matches else None
    for what, done in land(spark, data, out, sessions).items():
        print(f"{what}: {done.records} records landed, {done.rejected} rejected")
    if args.entities:
        done = update_entities(spark, out, args.end_mode)
        print(f"entities: {done.sessions} sessions changed, {done.players} players rebuilt, {done.parts} parts written")
        write_parquet(entity_profiles(read_entities(spark, out)), f"{out}/player_features")


if __name__ == "__main__":
    main()
