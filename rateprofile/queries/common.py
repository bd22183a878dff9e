"""Shared helpers for the test-table queries."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import round_all
from ..session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One test table; selecting ``columns`` up front keeps the scan pruned."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles so exact checks compare values, not summation order."""
    return round_all(df, digits)


def sql_round(expr: str, alias: str, digits: int = 6) -> str:
    return f"round(cast({expr} as double), {digits}) as {alias}"


def shared_folder(spark: SparkSession) -> str:
    """Where queries that test a sink write: the folder that the session shares."""
    found = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    if found is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="rateprofile-")
    return found.rstrip("/")
