"""Hard-negative mining with a secondary-sort shuffle.

Every anchor is scored against every row, anchors in blocks of bounded size. The
scores that can still matter are packed into keys (anchor, falling score, kind,
id), dealt out by anchor and sorted within the partitions by that key; an iterator
then reads each anchor's scores in order. A positive opens a window of scores, each
negative is given to the open windows it lies in, and a window closes when it is full
or passed, so that no anchor's scores are ever held together. (``repartition`` and
``sortWithinPartitions`` on the key are the DataFrame form of
``repartitionAndSortWithinPartitions``; the sort spills in the JVM.)

What can still matter is known before the shuffle: a first pass finds each anchor's
positives, which fix its windows; in the second each task keeps, per window, only as many
of its rows as the window takes, as a partial aggregation does. No score that could be in the result is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative has between these percentages of the positive's score.
LOW, HIGH = 30, 90
#: A block holds at most so many anchors, and so many bytes of their vectors.
BLOCK_ROWS = 4096
BLOCK_BYTES = 1 << 25
#: Products computed at a time.
PRODUCTS = 1 << 20
_NO_ID = np.iinfo(np.int64).max
_NONE = np.iinfo(np.int64).min


def scaled_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(uid, id, label, v) of the rows that take part; ``v`` holds whole numbers as doubles."""
    v, label = F.col(f"`{vector_col}`"), F.col(f"`{label_col}`")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    whole = vectors.filter(v.isNotNull() & label.isNotNull() & F.forall(v, finite)).select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        label.cast("string").alias("label"),
        F.transform(v, lambda x: _floor(x.cast("double") * F.lit(float(scale)))).alias("v"),
    )
    return whole.filter(F.forall("v", finite))


def _floor(x: Column) -> Column:
    """The floor as a double; doubles of 2^52 and more are whole already."""
    return F.when(F.abs(x) < F.lit(float(1 << 52)), F.floor(x).cast("double")).otherwise(x)


def windows(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and largest integer score s with low * score <= 100 s <= high * score."""
    return -((-low * score) // 100), (high * score) // 100


def width(m: np.ndarray) -> np.ndarray:
    """Per row, how its products can be computed: 0 as doubles, 1 as longs, 2 as Python integers."""
    dim = max(1, m.shape[1])
    top = np.abs(m).max(axis=1, initial=0)
    return (top > np.sqrt(2.0**52 / dim)).astype(np.int8) + (top > np.sqrt(2.0**62 / dim))


def products(v: np.ndarray, a: np.ndarray, kind: int) -> np.ndarray:
    """Exact inner products as longs (rows x anchors); the least long stands for one that no long holds."""
    if kind == 0:
        return (v @ a.T).astype(np.int64)
    if kind == 1:
        return v.astype(np.int64) @ a.astype(np.int64).T
    exact = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    got = exact(v) @ exact(a).T if v.shape[1] else np.zeros((len(v), len(a)), object)
    fits = lambda x: x if -_NO_ID <= x <= _NO_ID else _NONE
    return np.array([fits(x) for x in got.ravel()], np.int64).reshape(got.shape)


class Best:
    """The k highest scores of each slot so far, ties to the smaller id; a slot takes none under its floor."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k = floor.copy(), k
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # slot, score, id, uid

    def offer(self, score: np.ndarray, fits: np.ndarray, slots: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> None:
        """Scores (rows x slots given) where ``fits``."""
        fits = fits & (score >= self.floor[slots])
        if len(score) > self.k:
            kept = np.where(fits, score, _NONE)
            fits &= score >= np.partition(kept, len(score) - self.k, axis=0)[len(score) - self.k]
        row, col = np.nonzero(fits)
        if not len(row):
            return
        new = (slots[col], score[row, col], ids[row], uids[row])
        slot, got, ids, uids = (np.concatenate(x) for x in zip(self.rows, new))
        order = np.lexsort((uids, ids, -got, slot))
        slot, got, ids, uids = slot[order], got[order], ids[order], uids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        keep = place < self.k
        full = place == self.k - 1
        self.floor[slot[full]] = np.maximum(self.floor[slot[full]], got[full])
        self.rows = [slot[keep], got[keep], ids[keep], uids[keep]]


@dataclass
class Block:
    """Anchors of one dimension: ``wide`` as of :func:`width`, ``low`` and ``high`` the windows (anchors x positives)."""

    uid: np.ndarray
    id: np.ndarray
    label: np.ndarray
    m: np.ndarray
    wide: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def _blocks(rows, codes: dict[str, int]) -> dict[int, Block]:
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(len(r["v"]), []).append(r)
    out = {}
    for d, rs in by_dim.items():
        m = np.array([r["v"] for r in rs], np.float64).reshape(len(rs), d)
        label = np.array([codes.setdefault(r["label"], len(codes)) for r in rs], np.int64)
        out[d] = Block(np.array([r["uid"] for r in rs], np.int64), np.array([r["id"] for r in rs], np.int64), label, m, width(m))
    return out


def _by_dimension(batch: pa.RecordBatch, codes: dict[str, int], dims) -> Iterator[tuple]:
    """(dimension, uid, id, label code, matrix) of a batch; labels of no anchor are -1."""
    lists = batch.column("v")
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    first = np.cumsum(size) - size
    uid = batch.column("uid").to_numpy(zero_copy_only=False)
    ids = batch.column("id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
    label = np.array([codes.get(x, -1) for x in batch.column("label").to_pylist()], np.int64)
    for d in np.unique(size).tolist():
        if d in dims:
            at = np.flatnonzero(size == d)
            m = flat[(first[at][:, None] + np.arange(d)[None, :])] if d else np.zeros((len(at), 0))
            yield d, uid[at], ids[at], label[at], m


def _tiles(n_rows: int, n_anchors: int) -> Iterator[slice]:
    step = max(1, PRODUCTS // max(1, n_anchors))
    for i in range(0, n_rows, step):
        yield slice(i, i + step)


def _find_positives(seed, k: int):
    """Each task's k best rows of the same label per anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, codes = seed.value
        best = {d: Best(np.full(len(b.uid), _NONE + 1), k) for d, b in blocks.items()}
        for batch in batches:
            for d, uid, ids, label, m in _by_dimension(batch, codes, blocks):
                b, wide = blocks[d], width(m)
                for c in np.intersect1d(label, b.label).tolist():
                    for x in range(3):
                        a = np.flatnonzero((b.label == c) & (b.wide == x))
                        for y in range(3) if len(a) else ():
                            r = np.flatnonzero((label == c) & (wide == y))
                            for t in _tiles(len(r), len(a)):
                                s = products(m[r[t]], b.m[a], max(x, y))
                                best[d].offer(s, uid[r[t]][:, None] != b.uid[a][None, :], a, ids[r[t]], uid[r[t]])
        for d, b in blocks.items():
            slot, score, ids, _ = best[d].rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.uid[slot]), pa.array(b.id[slot]), pa.array(score), pa.array(ids, mask=ids == _NO_ID)], names=["anchor", "anchor_id", "score", "id"]
            )

    return run


def _find_negatives(seed, k: int):
    """Each task's k best rows of another label per anchor and window, each row once per anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, codes = seed.value
        best = {d: Best(b.low.ravel(), k) for d, b in blocks.items()}
        for batch in batches:
            for d, uid, ids, label, m in _by_dimension(batch, codes, blocks):
                b, wide = blocks[d], width(m)
                n = b.low.shape[1]
                for x in range(3):
                    a = np.flatnonzero(b.wide == x)
                    for y in range(3) if len(a) else ():
                        r = np.flatnonzero(wide == y)
                        for t in _tiles(len(r), len(a)):
                            s = products(m[r[t]], b.m[a], max(x, y))
                            other = (label[r[t]][:, None] != b.label[a][None, :]) & (s != _NONE)
                            for w in range(n):
                                best[d].offer(s, other & (s <= b.high[a, w][None, :]), a * n + w, ids[r[t]], uid[r[t]])
        for d, b in blocks.items():
            slot, score, ids, uids = best[d].rows
            anchor = slot // b.low.shape[1]
            _, once = np.unique(np.stack([anchor, uids]), axis=1, return_index=True)
            anchor, score, ids = anchor[once], score[once], ids[once]
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.uid[anchor]), pa.array(b.id[anchor]), pa.array(score), pa.array(ids, mask=ids == _NO_ID)], names=["anchor", "anchor_id", "score", "id"]
            )

    return run


def _open_windows(negatives: int, low: int, high: int):
    """Sorted scores of many anchors -> negatives. Holds one anchor's open windows, never its scores."""
    schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()), ("positive_score", pa.int64()), ("negative_score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, open_ = None, []  # [positive id, positive score, low, high, given]
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("anchor", "anchor_id", "score", "kind", "id")]
            for at, anchor_id, score, kind, i in zip(*columns):
                if at != anchor:
                    anchor, open_ = at, []
                if kind == 0:
                    open_.append([i, score, *windows(score, low, high), 0])
                    continue
                over = False
                for w in open_:
                    if w[2] <= score <= w[3] and w[4] < negatives:
                        w[4] += 1
                        out.append((anchor_id, w[0], w[4], i, w[1], score))
                    over = over or w[4] >= negatives or score < w[2]
                if over:
                    open_ = [w for w in open_ if w[4] < negatives and score >= w[2]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows that satisfy ``is_anchor`` (a condition on ``id``). An anchor's positives are its
    ``positives`` highest-scoring other rows of its label; for each of them come the first
    ``negatives`` rows of other labels with a score between ``low`` and ``high`` percent of the positive's.
    Order: score descending, then id (null last). Scores are exact integers.

    A null label or vector, or a null or non-finite component (also after scaling) takes a row out; vectors
    are compared with those of their own dimension; every repeated row counts, as an anchor, a
    positive or a negative, and only an anchor's own row is left out; a pair whose score no long
    holds is left out, as the result could not state it; an empty table gives an empty
    result. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = materialise(scaled_vectors(vectors, id_col, vector_col, label_col, scale), "vectors")
    asked = rows.filter(is_anchor)
    size = asked.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(1)).alias("dim")).first()
    per_block = max(1, min(block_rows, block_bytes // (8 * max(1, size["dim"]))))
    n_blocks = max(1, -(-size["n"] // per_block))
    schema = "anchor long, anchor_id long, score long, id long"
    first = Window.partitionBy("anchor").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    scored = None
    for i in range(n_blocks):
        codes: dict[str, int] = {}
        blocks = _blocks(asked.filter(F.pmod(F.xxhash64("uid"), F.lit(n_blocks)) == i).select("uid", "id", "label", "v").collect(), codes)
        seed = spark.sparkContext.broadcast((blocks, codes))
        found = rows.mapInArrow(_find_positives(seed, positives), schema).withColumn("r", F.row_number().over(first)).filter(F.col("r") <= positives).drop("r")
        found = materialise(found, "positives")
        _set_windows(blocks, found.select("anchor", "score").collect(), positives, low, high)
        seed.destroy()
        seed = spark.sparkContext.broadcast((blocks, codes))
        others = materialise(rows.mapInArrow(_find_negatives(seed, negatives), schema), "negatives")
        seed.destroy()
        both = found.withColumn("kind", F.lit(0)).unionByName(others.withColumn("kind", F.lit(1)))
        scored = both if scored is None else scored.unionByName(both)
    # a positive comes before negatives of its score: its window is open when they are read
    key = [F.col("anchor"), F.col("score").desc(), F.col("kind"), F.col("id").asc_nulls_last()]
    return (
        scored.repartition("anchor")
        .sortWithinPartitions(*key)
        .mapInArrow(_open_windows(negatives, low, high), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    )


def _set_windows(blocks: dict[int, Block], found, positives: int, low: int, high: int) -> None:
    """Windows of each anchor: one per distinct positive score, the rest empty."""
    scores: dict[int, set[int]] = {}
    for r in found:
        scores.setdefault(r["anchor"], set()).add(r["score"])
    for b in blocks.values():
        b.low, b.high = np.full((len(b.uid), positives), _NO_ID), np.full((len(b.uid), positives), _NONE)
        for i, u in enumerate(b.uid.tolist()):
            for w, s in enumerate(scores.get(u, ())):
                b.low[i, w], b.high[i, w] = windows(s, low, high)
