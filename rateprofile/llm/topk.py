"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are ordered by length and cut into buckets of vectors of similar length.
For a query with k-th best score t so far, a bucket with longest vector m asks
for a cosine of at least t / (|q| m), its local threshold. Above 1 nothing in the
bucket can qualify. A high threshold prunes by coordinate: on the query's largest
coordinates a qualifying direction must lie within a narrow range. A low one
prunes by length: only the vectors of at least t / |q| remain. What remains is
verified by exact integer products.

The queries are the stated set; they are broadcast in blocks of at most
``query_block``, each against all buckets. The longest bucket runs first, alone,
so that all others start from its thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .mining import _NONE, _floor, products, width

SCALE = 1024
BUCKET_ROWS = 2048
QUERY_BLOCK = 2048
#: Local thresholds (cosines) from which coordinates prune better than length.
COORDINATE_FROM = 0.6
FOCUS = 4
_SLACK = 1e-9
_NO_ID = np.iinfo(np.int64).max


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(uid, id, v, dim, norm) of the vectors that take part; ``v`` holds whole numbers as doubles."""
    v = F.col(vector_col)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    whole = lambda x: _floor(x.cast("double") * F.lit(float(scale)))
    out = vectors.filter(v.isNotNull() & F.forall(v, finite)).select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"), F.transform(v, whole).alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    return out.filter(F.forall("v", finite)).select("uid", "id", "v", F.size("v").alias("dim"), F.sqrt(square).alias("norm"))


def _pack(bucket_rows: int):
    """Rows in order of dimension and falling length -> buckets."""

    def emit(rows: dict[str, list]) -> pa.RecordBatch:
        m = np.array(rows["v"], np.float64).reshape(len(rows["v"]), -1)
        ids = np.array([_NO_ID if i is None else i for i in rows["id"]], np.int64)
        cols = [
            pa.array([m.shape[1]], pa.int32()),
            pa.array([max(rows["norm"])], pa.float64()),
            *(pa.array([x.tobytes()], pa.binary()) for x in (np.array(rows["uid"], np.int64), ids, m, np.array(rows["norm"], np.float64))),
        ]
        return pa.RecordBatch.from_arrays(cols, names=["dim", "longest", "uids", "ids", "matrix", "norms"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[str, list] = {"uid": [], "id": [], "v": [], "norm": []}
        dim = None
        for batch in batches:
            got = batch.to_pydict()
            for i, d in enumerate(got["dim"]):
                if rows["uid"] and (d != dim or len(rows["uid"]) >= bucket_rows):
                    yield emit(rows)
                    rows = {k: [] for k in rows}
                dim = d
                for k in rows:
                    rows[k].append(got[k][i])
        if rows["uid"]:
            yield emit(rows)

    return run


class _Queries:
    """A block of queries of one dimension, with their best scores so far."""

    def __init__(self, uid, ids, m, norm, floor, k):
        self.uid, self.ids, self.m, self.norm, self.k = uid, ids, m, norm, k
        self.floor = floor
        self.wide = width(m)
        self.best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def take(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """New candidates (query, score, id); keeps the k best of each query."""
        old = self.best
        parts = [np.concatenate(x) for x in zip(*old, (q, score, ids))] if old else [q, score, ids]
        order = np.lexsort((parts[2], -parts[1], parts[0]))
        q, score, ids = (x[order] for x in parts)
        start = np.searchsorted(q, np.arange(len(self.uid)))
        place = np.arange(len(q)) - start[q]
        keep = place < self.k
        self.best = [(q[keep], score[keep], ids[keep])]
        full = place == self.k - 1
        self.floor[q[full]] = np.maximum(self.floor[q[full]], score[full])

    def visit(self, uids, ids, m, norms, longest, coordinate_from, focus) -> None:
        widths = width(m)
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(self.floor > 0, self.floor / (self.norm * longest), -1.0)
        local = np.where(np.isnan(local), -1.0, local) - _SLACK
        open_ = local <= 1
        by_length = np.flatnonzero(open_ & (local < coordinate_from))
        by_coordinate = np.flatnonzero(open_ & (local >= coordinate_from))
        if len(by_length):
            need = np.where(self.floor[by_length] > 0, self.floor[by_length] / np.maximum(self.norm[by_length], 1e-300), -1.0) * (1 - _SLACK)
            upto = np.searchsorted(-norms, -need, side="right")
            n = int(upto.max())
            self._verify(by_length, self._products(m[:n], widths[:n], by_length), ids[:n], uids[:n])
        if len(by_coordinate):
            unit = m / np.maximum(norms, 1e-300)[:, None]
            for q in by_coordinate.tolist():
                u = self.m[q] / self.norm[q]
                t = max(min(local[q], 1.0), 0.0)
                near = np.ones(len(m), bool)
                for f in np.argsort(-np.abs(u))[:focus]:
                    wide = np.sqrt(max(0.0, (1 - t * t) * (1 - u[f] * u[f]))) + 1e-7
                    # cosine >= t: the coordinate is within t u +- wide, or beyond it towards u
                    if u[f] >= 0:
                        near &= unit[:, f] >= u[f] * t - wide
                    else:
                        near &= unit[:, f] <= u[f] * t + wide
                at = np.flatnonzero(near)
                if len(at):
                    self._verify(np.array([q]), self._products(m[at], widths[at], np.array([q])), ids[at], uids[at])

    def _products(self, m: np.ndarray, wide: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact scores (rows x queries); what no long holds is the least long."""
        if not wide.any() and not self.wide[q].any():
            return products(m, self.m[q], 0)
        out = np.empty((len(m), len(q)), np.int64)
        for x in range(3):
            for y in range(3):
                rows, columns = np.flatnonzero(wide == x), np.flatnonzero(self.wide[q] == y)
                if len(rows) and len(columns):
                    out[np.ix_(rows, columns)] = products(m[rows], self.m[q[columns]], max(x, y))
        return out

    def _verify(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> None:
        if not len(score):
            return
        fits = (uids[:, None] != self.uid[q][None, :]) & (score != _NONE)
        # a floor is a double: beyond 2^53 it is compared as such, which keeps scores that round to it
        some = fits & (score >= self.floor[q][None, :])
        if len(score) > self.k:
            some &= score >= np.partition(np.where(fits, score, _NONE), len(score) - self.k, axis=0)[len(score) - self.k]
        row, col = np.nonzero(some)
        if len(row):
            self.take(q[col], score[row, col], ids[row])


def _search(queries, k: int, coordinate_from: float, focus: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {d: _Queries(*(x.copy() for x in q), k) for d, q in queries.value.items()}
        for batch in batches:
            for i in range(batch.num_rows):
                dim, longest = batch.column("dim")[i].as_py(), batch.column("longest")[i].as_py()
                if dim not in blocks:
                    continue
                get = lambda c, t: np.frombuffer(batch.column(c)[i].as_buffer(), t)  # noqa: B023, E731
                uids, ids, norms = get("uids", np.int64), get("ids", np.int64), get("norms", np.float64)
                m = get("matrix", np.float64).reshape(len(uids), dim)
                blocks[dim].visit(uids, ids, m, norms, longest, coordinate_from, focus)
        for b in blocks.values():
            for q, score, ids in b.best:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.uid[q]), pa.array(b.ids[q]), pa.array(ids, mask=ids == _NO_ID), pa.array(score.astype(np.int64))], names=["quid", "query_id", "vec_id", "score"]
                )

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    bucket_rows: int = BUCKET_ROWS,
    query_block: int = QUERY_BLOCK,
    coordinate_from: float = COORDINATE_FROM,
    focus: int = FOCUS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for every vector that satisfies
    ``is_query`` (a condition on ``id``) the k highest integer inner products with
    other rows, ties to the smaller id (null last).

    Null vectors and vectors with null or non-finite components take no part;
    vectors are compared with those of their own dimension; repeated rows count
    one by one, and only a query's own row is left out; an empty table gives an
    empty result. Scores are exact; a pair whose score no long holds is left out, as the result could not state it.
    """
    spark = vectors.sparkSession
    rows = materialise(integer_vectors(vectors, id_col, vector_col, scale), "vectors")
    n = rows.count()
    parts = max(1, -(-n // bucket_rows))
    order = [F.col("dim"), F.col("norm").desc(), F.col("uid")]
    buckets = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_pack(bucket_rows), "dim int, longest double, uids binary, ids binary, matrix binary, norms binary")
    buckets = materialise(buckets, "buckets")
    heads = buckets.groupBy("dim").agg(F.max("longest").alias("longest"))
    first = buckets.join(heads, ["dim", "longest"], "left_semi")
    asked = rows.filter(is_query)
    n_blocks = max(1, -(-asked.count() // query_block))
    schema = "quid long, query_id long, vec_id long, score long"
    best = Window.partitionBy("quid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    out = None
    for b in range(n_blocks):
        got = asked.filter(F.pmod(F.xxhash64("uid"), F.lit(n_blocks)) == b).select("uid", "id", "v", "dim", "norm").collect()
        block = _query_arrays(got)
        seed = spark.sparkContext.broadcast(block)
        # the longest vectors first: at most one bucket per dimension and partition
        seen = first.mapInArrow(_search(seed, k, coordinate_from, focus), schema).withColumn("r", F.row_number().over(best)).filter(F.col("r") == k).select("quid", "score")
        floors = dict(seen.collect())
        for uid, _, _, _, floor in block.values():
            floor[:] = [floors.get(u, -np.inf) for u in uid.tolist()]
        seed.destroy()
        found = buckets.mapInArrow(_search(spark.sparkContext.broadcast(block), k, coordinate_from, focus), schema)
        ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        ranked = materialise(ranked, "top") if n_blocks > 1 else ranked
        out = ranked if out is None else out.unionByName(ranked)
    return out


def _query_arrays(rows) -> dict[int, tuple]:
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(r["dim"], []).append(r)
    return {
        d: (
            np.array([r["uid"] for r in rs], np.int64),
            np.array([r["id"] for r in rs], np.int64),
            np.array([r["v"] for r in rs], np.float64).reshape(len(rs), d),
            np.array([r["norm"] for r in rs], np.float64),
            np.full(len(rs), -np.inf),
        )
        for d, rs in by_dim.items()
    }
