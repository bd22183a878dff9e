"""Scale-and-skew rehearsal for the event-log queries.

Builds, once per run in a fresh scratch folder, an N-times larger copy of the
driver's ``events`` table (replica i shifts user and event ids, so users stay
distinct) and a skewed variant of it in which one user holds a third of all
rows. Runs the event-log queries on both and reports wall time plus, from
Spark's event log in the scratch folder, the longest task against the median
task of every stage, so a hot key that lands in one task shows up as a large
max/median ratio.

    python tools/scale_rehearsal.py [--src /root/testdata/sf0.1] [--copies 20] [--tables events|lineitem]
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rateprofile.queries import QUERIES  # noqa: E402

EVENT_QUERIES = ("entity_features", "exposure_with_role", "session_entity_counts", "cohort_intensity", "profile_drift")
LINE_QUERIES = (
    "role_totals",
    "dominant_role",
    "cross_tab",
    "segments_explode",
    "missing_sessions",
    "split_filter",
    "cohort_intensity_per_year",
)


def build(spark: SparkSession, src: str, out: str, copies: int, skewed: bool) -> None:
    ev = spark.read.parquet(f"{src}/events.parquet")
    reps = spark.range(copies).withColumnRenamed("id", "rep")
    big = ev.join(F.broadcast(reps))  # the replica table has `copies` rows
    user = F.col("user_id") + F.col("rep") * 1_000_000
    if skewed:
        # a third of all rows (by a hash of the event, not by any id range) move to user 0
        user = F.when(F.pmod(F.xxhash64("event_id", "rep"), F.lit(3)) == 0, F.lit(0)).otherwise(user)
    big.select(
        (F.col("event_id") + F.col("rep") * 10_000_000).alias("event_id"),
        "ts",
        user.cast("long").alias("user_id"),
        "event_type",
        "value",
        "props",
    ).repartition(16).write.parquet(f"{out}/events.parquet")


def build_lines(spark: SparkSession, src: str, out: str, copies: int, skewed: bool) -> None:
    """lineitem and orders, N copies with shifted order keys; in the skewed
    variant a third of all lines (by a hash of the line) belong to order 0."""
    reps = F.broadcast(spark.range(copies).withColumnRenamed("id", "rep"))
    li = spark.read.parquet(f"{src}/lineitem.parquet").join(reps)
    key = F.col("l_orderkey") + F.col("rep") * 10_000_000
    if skewed:
        key = F.when(F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "rep"), F.lit(3)) == 0, F.lit(0)).otherwise(key)
    li.withColumn("l_orderkey", key.cast("long")).drop("rep").repartition(16).write.parquet(f"{out}/lineitem.parquet")
    od = spark.read.parquet(f"{src}/orders.parquet").join(reps)
    od.withColumn("o_orderkey", (F.col("o_orderkey") + F.col("rep") * 10_000_000).cast("long")).drop("rep").repartition(
        8
    ).write.parquet(f"{out}/orders.parquet")


def stage_skew(log_dir: str) -> list[tuple[int, int, float, float, str]]:
    """(stage, tasks, median s, max s, job description) of every stage with more
    than one task."""
    tasks: dict[int, list[float]] = {}
    owner: dict[int, str] = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path):
            continue
        if path.endswith(".zstd"):
            import zstandard

            with open(path, "rb") as fb:  # one zstd frame per flush
                text = zstandard.ZstdDecompressor().stream_reader(fb, read_across_frames=True).read().decode()
        else:
            with open(path) as f:
                text = f.read()
        for line in text.splitlines():
            if '"SparkListenerJobStart"' in line:
                e = json.loads(line)
                desc = (e.get("Properties") or {}).get("spark.job.description", "")
                for sid in e.get("Stage IDs", []):
                    owner[sid] = desc
                continue
            if '"SparkListenerTaskEnd"' not in line:
                continue
            e = json.loads(line)
            info = e["Task Info"]
            tasks.setdefault(e["Stage ID"], []).append((info["Finish Time"] - info["Launch Time"]) / 1000.0)
    return [
        (sid, len(d), statistics.median(d), max(d), owner.get(sid, ""))
        for sid, d in sorted(tasks.items())
        if len(d) > 1
    ]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--src", default="/root/testdata/sf0.1")
    ap.add_argument("--copies", type=int, default=20)
    ap.add_argument("--tables", choices=["events", "lineitem"], default="events")
    args = ap.parse_args()
    builder, names = (build, EVENT_QUERIES) if args.tables == "events" else (build_lines, LINE_QUERIES)
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    logs = f"{scratch}/eventlog"
    os.makedirs(logs)
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("rateprofile-rehearsal")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", logs)
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    report = {"copies": args.copies, "scratch": scratch, "runs": {}}
    for variant in ("uniform", "skewed"):
        data = f"{scratch}/{variant}"
        spark.sparkContext.setJobDescription(f"build {variant}")
        builder(spark, args.src, data, args.copies, variant == "skewed")
        rows = spark.read.parquet(f"{data}/{args.tables}.parquet").count()
        times = {}
        for name in names:
            spark.sparkContext.setJobDescription(f"query {name} {variant}")
            t0 = time.perf_counter()
            QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 2)
        report["runs"][variant] = {"rows": rows, "seconds": times}
    spark.stop()
    print(json.dumps(report["runs"]), flush=True)
    skew = [s for s in stage_skew(logs) if s[4].startswith("query ")]
    worst = sorted(skew, key=lambda s: -s[3])[:8]
    report["longest_query_tasks"] = [
        {"stage": s, "job": j, "tasks": n, "median_s": round(m, 3), "max_s": round(x, 3)} for s, n, m, x, j in worst
    ]
    wide = [s for s in skew if s[1] >= 8]
    report["max_over_median_8plus_task_query_stages"] = round(
        max((x / max(m, 1e-3) for _, _, m, x, _ in wide), default=0.0), 2
    )
    print(json.dumps(report, indent=1))


if __name__ == "__main__":
    main()
