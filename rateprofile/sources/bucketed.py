"""Tables bucketed on a key, so that what is grouped or joined on it is not shuffled.

Landing shuffles the rows once, by the key; every later aggregation, window or join on the key (or on more columns than
the key) starts from that layout. The bucket layout is a property of the table definition, not of
the files: ``open_bucketed`` declares it again where no shared metastore keeps it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BUCKETS = 64


def table_name(prefix: str = "bucketed") -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS, sort: Sequence[str] | None = None, name: str | None = None, dealt: bool = False) -> DataFrame:
    """Write ``df`` to a new folder ``path``, one file per bucket of ``keys`` sorted by ``sort`` (default: the keys), and return
    it as a bucketed table. Rows are dealt to the buckets before they are written: a task writes whole buckets, not a
    small file for each of them. ``dealt``: they are already partitioned by the keys into ``buckets``."""
    name = name or table_name()
    rows = df if dealt else df.repartition(buckets, *keys)
    writer = rows.write.format("parquet").option("path", path).bucketBy(buckets, *keys)
    writer.sortBy(*(sort or keys)).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int = BUCKETS, sort: Sequence[str] | None = None, name: str | None = None
) -> DataFrame:
    """The table that ``write_bucketed`` wrote to ``path``, in another session. Keys, number and order must be those it was written with."""
    name = name or table_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    quoted = lambda cols: ", ".join(f"`{c}`" for c in cols)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({quoted(keys)}) "
        f"SORTED BY ({quoted(sort or keys)}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
