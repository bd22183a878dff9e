"""Large JSON array files read by many tasks.

Spark reads a multi-line JSON file in one task. Here the file is read as lines, which split at any byte
range, and put together again at record borders:

1. Each split adds up how many brackets its lines open and close. (A line break cannot stand inside a JSON string, so
   a line can be judged without what precedes it.) Running sums over the splits of a file, a row each, tell every
   split how deep its first line lies.
2. Each split cuts its lines where a record of the array ends. Whole records leave as they are; the pieces of the
   records that reach into the split or out of it, at most two, are joined with those of its neighbours.

The records are parsed with the schema afterwards. A file that is one single line cannot be split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage
from .json_sources import CORRUPT, with_corrupt

_STRING = r'"(?:[^"\\]|\\.)*"'
_MARKS = re.compile(_STRING + r"|[\[\]{},]")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the lines of each split, in order within it."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _depths(lines: DataFrame) -> DataFrame:
    """(file, block, depth): the brackets open where the split begins."""
    bare = F.regexp_replace("value", _STRING, "")
    count = lambda marks: F.length(bare) - F.length(F.translate(bare, marks, ""))
    per = lines.groupBy("file", "block").agg(F.sum((count("[{") - count("]}")).cast("long")).alias("d"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("file", "block", F.coalesce(F.sum("d").over(before), F.lit(0).cast("long")).alias("depth"))


_PIECES = "file string, block long, place int, kind string, text string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with the depth of their split -> records (``whole``) and pieces: ``head`` ends a record that began in an
    earlier split, ``tail`` begins one that ends in a later, ``middle`` does neither."""
    names = ["file", "block", "place", "kind", "text"]
    rows: list[tuple] = []
    key, depth, place, ended, text = None, 0, 0, False, []

    def finish():
        # also where nothing is left: a tail says that the next head begins here, not further back
        if key is not None:
            rows.append((*key, place, "tail" if ended else "middle", "".join(text)))

    for batch in batches:
        for file, block, start, value in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "depth", "value"))):
            if (file, block) != key:
                finish()
                key, depth, place, ended, text = (file, block), start, 0, False, []
            at = 0
            for m in _MARKS.finditer(value):
                c = m[0]
                if c in "{[":
                    depth += 1
                    if depth == 1:  # the array begins: what precedes is no record
                        at, text, ended = m.end(), [], True
                elif c in "]}":
                    depth -= 1
                border = depth == 1 and c == "," or depth == 0 and c == "]"
                if border:
                    text.append(value[at : m.start()])
                    rows.append((*key, place, "whole" if ended else "head", "".join(text)))
                    place, ended, text, at = place + 1, True, [], m.end()
            text.append(value[at:] + "\n")
        if len(rows) > 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
            rows = []
    finish()
    if rows:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record): the text of every element of the JSON arrays under ``path``, from as many tasks as their bytes
    have splits (``spark.sql.files.maxPartitionBytes``)."""
    lines = _lines(spark, path)
    # a row per split: read by every task that cuts one
    depths = cut_lineage(_depths(lines))
    joined = lines.join(F.broadcast(depths) if depths.count() <= 200_000 else depths, ["file", "block"])
    pieces = cut_lineage(joined.select("file", "block", "depth", "value").mapInArrow(_cut, _PIECES))
    whole = pieces.filter("kind = 'whole'").select("file", F.col("text").alias("record"))
    # a record over several splits: its tail, middles and head share the block where it begins
    order = Window.partitionBy("file").orderBy("block", "place")
    parts = pieces.filter("kind <> 'whole'").withColumn("begin", F.last(F.when(F.col("kind") == "tail", F.col("block")), ignorenulls=True).over(order))
    joined_parts = parts.groupBy("file", "begin").agg(F.sort_array(F.collect_list(F.struct("block", "place", "text"))).alias("p"))
    spanning = joined_parts.select("file", F.concat_ws("", F.transform("p", lambda p: p["text"])).alias("record"))
    return whole.unionByName(spanning).filter(~F.col("record").rlike(r"^\s*$"))


def read_array_files(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What ``read_json_arrays`` reads, by many tasks per file: the columns of ``schema``, ``_corrupt_record`` for an element that
    cannot be parsed, and ``source_file``. (A file that is cut off loses its last element here, not all of them.)"""
    parsed = F.from_json("record", with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return array_records(spark, path).select("file", parsed.alias("r")).select("r.*", F.col("file").alias("source_file"))
