"""Helpers shared by the training-data operators: shared scratch tables and
byte-level views of Arrow text batches."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Texts are worked on in slices of about this many bytes, so that the numpy
#: temporaries of a task stay small whatever the size of an Arrow batch.
SLICE_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``). Only a local
    session without one gets a temporary folder; elsewhere its absence is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rateprofile-llm-"))
    return checkpoint_dir(spark).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table written to the shared folder: later jobs read
    it again instead of recomputing it, also after the loss of an executor."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct ``row``, out of the way of any other name."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def rows_with_text(df: DataFrame, text_col: str, keep: list[str] | None) -> list[Column]:
    """``row`` with the columns ``keep`` (None: all) and, where it lacks the text, ``text``: the
    text goes to the tasks once and comes back only as a kept column."""
    kept = df.columns if keep is None else keep
    row = whole_row(df.select(*[F.col(f"`{c}`") for c in kept])) if kept else F.struct(F.lit(0).alias("none")).alias("row")
    return [row] if text_col in kept else [row, F.col(f"`{text_col}`").alias("text")]


def text_of(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    """The texts of a batch of ``rows_with_text``."""
    return batch.column("text") if "text" in batch.schema.names else batch.column("row").field(text_col)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def byte_table(is_word: Callable[[int], bool]) -> tuple[bytes, np.ndarray]:
    """(translation that lower-cases A-Z and turns every non-word byte into a
    space, word-byte flags). Word classes here hold every byte of a non-ASCII
    character, so UTF-8 bytes and code points give the same words."""
    low = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
    flags = np.array([bool(is_word(b)) for b in low])
    return bytes(b if f else 32 for b, f in zip(low, flags)), flags


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of a string array, offsets of its rows in them); null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES, rows: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes and at most ``rows`` rows; a longer text is a range of its own."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), i + rows, n)
        yield i, j
        i = j


class Words:
    """The words of some texts as positions in one normalised buffer, in which
    the words of a text follow each other with one space after each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, translation: bytes, flags: np.ndarray):
        n = len(offsets) - 1
        # one separator after every text: a word never runs into the next text
        apart = np.insert(data, offsets[1:], 32) if n else np.zeros(0, np.uint8)
        ends_at = offsets[1:] + np.arange(1, n + 1)
        mask = flags[apart]
        edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
        if len(mask) and mask[0]:
            edge = np.concatenate(([0], edge))
        first, last = edge[0::2], edge[1::2]
        keep = mask
        keep[last] = True
        self.norm = np.frombuffer(apart.tobytes().translate(translation), np.uint8)[keep].tobytes()
        size = last - first
        self.end = np.cumsum(size + 1) - 1
        self.start = self.end - size
        #: words of text i: bounds[i] .. bounds[i + 1]
        self.bounds = np.concatenate(([0], np.searchsorted(first, ends_at))).astype(np.int64)

    def __len__(self) -> int:
        return len(self.start)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] values each, concatenated."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before - starts, counts)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit values (wraps around)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers (as ``--py-files`` would), once
    per application, so that callers need not install it on the executors."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    fd, path = tempfile.mkstemp(prefix=f"{package.name}-", suffix=".zip")
    with os.fdopen(fd, "wb") as out, zipfile.ZipFile(out, "w") as archive:
        for f in sorted(package.rglob("*.py")):
            archive.write(f, f.relative_to(package.parent))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
