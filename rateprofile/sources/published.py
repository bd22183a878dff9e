"""Tables that are replaced part by part without readers noticing.

A published table is a folder with ``data/{version}/part=.../`` and a ``manifest``: one row per part and version with
the folder of its rows. A write first puts new data into folders that no reader knows, then appends
its manifest rows in one file; that append is the moment at which readers see it, all of its parts
at once. A write that stops before it leaves every reader the old table. Only the parts that a write brings get new folders: a
rerun of one family does not touch the others. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "part string, version long, folder string, rows long, written string"
#: The part of a table that is not divided.
WHOLE = "__all__"


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """All manifest rows, or None if there is no such table."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/manifest")
    except Exception as e:  # noqa: BLE001 - told apart by its condition
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def parts_of(spark: SparkSession, path: str) -> DataFrame:
    """(part, version, folder, rows, written): the current state of every part."""
    manifest = _manifest(spark, path)
    if manifest is None:
        return spark.createDataFrame([], MANIFEST)
    last = Window.partitionBy("part").orderBy(F.desc("version"))
    return manifest.withColumn("r", F.row_number().over(last)).filter("r = 1").drop("r")


def publish(df: DataFrame, path: str, part_col: str | None = None, replace: Sequence[str] | None = None) -> int:
    """Make ``df`` the new content of its parts (the values of ``part_col``; without one, of the whole table), and
    return the version. Parts that ``df`` does not bring stay as they are, unless ``replace`` lists them: those become empty
    (``replace`` may name parts that ``df`` brings, too). An empty ``df`` without ``part_col`` empties the table."""
    spark = df.sparkSession
    path = path.rstrip("/")
    old = _manifest(spark, path)
    version = (old.agg(F.max("version")).first()[0] or 0) + 1 if old is not None else 1
    folder = f"{path}/data/{version:08d}-{uuid.uuid4().hex}"
    if part_col is None:
        df.write.parquet(folder)
        found = {WHOLE: spark.read.schema(df.schema).parquet(folder).count()}
        where = {WHOLE: folder}
    else:
        part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
        df.withColumn("part", part).write.partitionBy("part").parquet(folder)
        schema = StructType([*df.schema.fields]).add("part", "string")
        written = spark.read.schema(schema).parquet(folder).groupBy(F.coalesce("part", F.lit("")).alias("part")).count()
        found = {r["part"]: r["count"] for r in written.collect()}
        where = {p: folder for p in found}
    gone = [p for p in replace or () if p not in found]
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("written")
    rows = [(p, version, where[p], n) for p, n in found.items()] + [(p, version, None, 0) for p in gone]
    if rows:
        added = spark.createDataFrame(rows, "part string, version long, folder string, rows long")
        added.select("*", stamp).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def read_published(spark: SparkSession, path: str, schema: StructType | str | None = None, parts: Sequence[str] | None = None) -> DataFrame:
    """The current rows of a published table, or of some of its parts. ``schema`` is needed where the table may be
    missing or empty; without it that is an error. Each folder is read once, for the parts that are current in it."""
    now = parts_of(spark, path).filter("folder is not null")
    if parts is not None:
        now = now.filter(F.col("part").isin(*parts))
    # parts are few by intent (families, buckets of entities)
    by_folder: dict[str, list[str]] = {}
    for r in now.collect():
        by_folder.setdefault(r["folder"], []).append(r["part"])
    if not by_folder:
        if schema is None:
            raise ValueError(f"nothing is published at {path}")
        return spark.createDataFrame([], schema)
    out = None
    for folder, which in sorted(by_folder.items()):
        got = spark.read.parquet(folder)
        if which != [WHOLE]:
            got = spark.read.schema(StructType([f for f in got.schema.fields if f.name != "part"]).add("part", "string")).parquet(folder)
            got = got.filter(F.coalesce("part", F.lit("")).isin(*which)).drop("part")
        out = got if out is None else out.unionByName(got, allowMissingColumns=True)
    return out
