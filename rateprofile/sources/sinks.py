"""Parquet sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame


def drop_vectors(df: DataFrame) -> DataFrame:
    """Drop ML vector columns before writing a plain table."""
    keep = [f.name for f in df.schema.fields if not isinstance(f.dataType, VectorUDT)]
    return df.select(*keep)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write ``df`` as Parquet. With ``partition_by`` it is one write with one
    folder per value (e.g. one per family) instead of one write per value."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)

