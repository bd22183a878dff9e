"""Land nested JSON session files as Parquet with Structured Streaming.

The source model re-parses every multi-line JSON file on each run (and infers
its schema with an extra pass). Here the files are parsed once, with the
explicit schema, by a file-source streaming query with an ``availableNow``
trigger: it processes every file not yet landed and stops. The checkpoint
records which files are done, so re-running after new session files arrive
only parses the new ones.

Each micro-batch is written to folders of its own, ``batch_id={query id}-{n}``. The query id lives in the
checkpoint: a repeated batch overwrites its folders, while a new or lost checkpoint starts folders of its own and
overwrites nothing. Records that cannot be parsed go to ``{out_path}_rejected``, partial aggregates (``summarise``) to
``{out_path}_summary``. Last of all the batch lists its files in ``{out_path}_deliveries``; a batch that is not listed there
did not finish and is not read. ``read_landed`` gives the rows of the last delivery of
each session, so that a corrected file, or one that is landed again, replaces the rows of the earlier one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from threading import Event

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.deliveries import current_rows, last_deliveries
from ..sources.json_sources import CORRUPT, accepted, explode_segments, flatten_events, path_key, with_corrupt
from ..sources.schemas import EVENT_SCHEMA, LINEUP_SCHEMA

COHORT_COLUMNS = ("competition_id", "season_id")
#: A file of a session: ``delivery`` numbers it, the later ``modified`` counts (then the larger path, then the later batch).
DELIVERIES = "match_id long, delivery long, modified timestamp, source_file string, records long, batch_id string"
DELIVERY_ORDER = ("modified", "source_file", "batch_id")
DELIVERY_KEYS = ("match_id", "delivery", "batch_id")


@dataclass
class Landed:
    """What a run read: source records that were parsed, and those rejected."""

    records: int = 0
    rejected: int = 0


def _stream(spark: SparkSession, src_dir: str, schema: StructType, max_files: int) -> DataFrame:
    return (
        spark.readStream.schema(with_corrupt(schema))
        .option("multiLine", True)
        .option("maxFilesPerTrigger", max_files)
        .json(src_dir)
        .withColumns({"match_id": path_key(), "_source_file": F.col("_metadata.file_path"), "_modified": F.col("_metadata.file_modification_time")})
        .withColumn("delivery", F.xxhash64("_source_file", "_modified"))
    )


def _with_cohort(df: DataFrame, sessions: DataFrame | None, partition_cols: Sequence[str]) -> DataFrame:
    """Left join adding the cohort columns of each session (one row per session on the static side)."""
    if sessions is None:
        return df
    return df.join(sessions.select("match_id", *partition_cols), "match_id", "left")


def _land(
    stream: DataFrame,
    flat: Callable[[DataFrame], DataFrame],
    out_path: str,
    checkpoint: str,
    sessions: DataFrame | None,
    partition_cols: Sequence[str],
    summarise: Callable[[DataFrame], DataFrame] | None,
) -> Landed:
    out, landed = out_path.rstrip("/"), Landed()
    started, run = Event(), []

    def write(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        folder = f"batch_id={run[0]}-{batch_id:08d}"
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # parsed once for all tables and the counts
        try:
            bad = batch.filter(F.col(CORRUPT).isNotNull())
            total, n_bad = batch.count(), bad.count()
            good = accepted(batch)
            rows = flat(good.drop("_source_file", "_modified"))
            writer = _with_cohort(rows, sessions, partition_cols).write.mode("overwrite")
            if sessions is not None:
                writer = writer.partitionBy(*partition_cols)
            writer.parquet(f"{out}/{folder}")
            if summarise is not None:
                summarise(rows).write.mode("overwrite").parquet(f"{out}_summary/{folder}")
            if n_bad:
                bad.select(F.col("_source_file").alias("source_file"), F.col(CORRUPT).alias("record")).write.mode(
                    "overwrite"
                ).parquet(f"{out}_rejected/{folder}")
            # the files of the batch, once all else is there
            files = good.groupBy("match_id", "delivery", F.col("_modified").alias("modified"), F.col("_source_file").alias("source_file"))
            files.agg(F.count(F.lit(1)).alias("records")).coalesce(1).write.mode("overwrite").parquet(f"{out}_deliveries/{folder}")
            landed.records += total - n_bad
            landed.rejected += n_bad
        finally:
            batch.unpersist()

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    run.append(query.id)
    started.set()
    query.awaitTermination()
    return landed


def _exists(e: Exception) -> bool:
    return "PATH_NOT_FOUND" not in str(e)


def read_deliveries(spark: SparkSession, out_path: str) -> DataFrame:
    """All files of all finished batches."""
    try:
        return spark.read.schema(DELIVERIES).parquet(f"{out_path.rstrip('/')}_deliveries")
    except Exception as e:  # noqa: BLE001 - told apart by its condition
        if _exists(e):
            raise
        return spark.createDataFrame([], DELIVERIES)


def current_deliveries(spark: SparkSession, out_path: str) -> DataFrame:
    """The delivery that counts of every session (rows of files without a session number count each)."""
    return last_deliveries(read_deliveries(spark, out_path), "match_id", DELIVERY_ORDER)


def read_landed(spark: SparkSession, out_path: str, table: str = "", keep_delivery: bool = False) -> DataFrame:
    """The landed rows of the last delivery of each session; ``table`` "_summary" for its partial aggregates."""
    out = out_path.rstrip("/")
    rows = spark.read.parquet(f"{out}{table}").withColumn("batch_id", F.col("batch_id").cast("string"))
    rows = current_rows(rows, current_deliveries(spark, out), DELIVERY_KEYS)
    return rows if keep_delivery else rows.drop("delivery", "batch_id")


def land_events(
    spark: SparkSession,
    src_dir: str,
    out_path: str,
    checkpoint: str,
    max_files: int = 256,
    sessions: DataFrame | None = None,
    partition_cols: Sequence[str] = COHORT_COLUMNS,
    summarise: Callable[[DataFrame], DataFrame] | None = None,
) -> Landed:
    """Flat events of every new file under ``src_dir`` added to ``out_path``.
    With a ``sessions`` dimension the landed table is partitioned by cohort
    (a few large folders rather than one per session), so reads of some cohorts
    prune the rest. ``summarise`` makes the partial aggregates of a batch from its rows (with ``match_id`` and ``delivery``
    among its keys). Returns the number of source records (events) landed and rejected by this run."""
    return _land(_stream(spark, src_dir, EVENT_SCHEMA, max_files), flatten_events, out_path, checkpoint, sessions, partition_cols, summarise)


def land_lineups(
    spark: SparkSession,
    src_dir: str,
    out_path: str,
    checkpoint: str,
    max_files: int = 256,
    sessions: DataFrame | None = None,
    partition_cols: Sequence[str] = COHORT_COLUMNS,
    summarise: Callable[[DataFrame], DataFrame] | None = None,
) -> Landed:
    """Flat presence segments of every new lineup file added to ``out_path``,
    partitioned by cohort when ``sessions`` is given. Returns the number of
    source records (team rows) landed and rejected by this run."""
    return _land(_stream(spark, src_dir, LINEUP_SCHEMA, max_files), explode_segments, out_path, checkpoint, sessions, partition_cols, summarise)
