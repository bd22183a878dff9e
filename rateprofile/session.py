"""Session-level helpers: lineage cuts.

Library code never builds or configures the session it is given; the only
session setting it reads is ``spark.checkpoint.dir`` (the shared folder a
cluster names for reliable checkpoints).
"""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The reliable checkpoint folder of this session, if one is configured."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no SparkContext
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    return None


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` so later jobs (e.g. the iterations of a k sweep) do not
    recompute its whole lineage, and survive the loss of an executor.

    With a reliable checkpoint folder this is ``df.checkpoint()`` (files in the
    shared folder). Without one it falls back to ``MEMORY_AND_DISK`` persistence,
    which Spark can still recompute from lineage if an executor is lost.
    """
    spark = df.sparkSession
    if checkpoint_dir(spark):
        return df.checkpoint(eager=True)
    log.warning("spark.checkpoint.dir is not set; persisting instead of checkpointing")
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out


def describe_jobs(spark: SparkSession, text: str) -> None:
    """Label the Spark jobs this thread submits next (visible in the event log),
    e.g. which family and k a parallel fit belongs to."""
    try:
        spark.sparkContext.setJobDescription(text)
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no SparkContext
        pass
