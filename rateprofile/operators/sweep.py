"""K-Means of many populations and many k together (M2, M3, M9).

All families and all k share every pass over the rows: a pass assigns each row to
its nearest centre once per k, sums up per (family, k, cluster) inside the tasks and adds up the sums of the
tasks. A sweep thus costs as many passes as the slowest of its fits, not one chain of passes per fit.

The result depends on the rows and the seed alone, not on how the rows are
partitioned or ordered. Features are held on a grid of 1 / ``GRID`` (of a standard deviation, for
scaled features) as whole numbers, so that sums and squared distances are exact and add up to the same whatever
their order (doubles hold them exactly while dimensions times the largest squared grid value is
below 2^53). Starts are drawn by the k-means++ rule with a keyed hash of the entity id in place of a random
generator, among at most ``START_ROWS`` rows of each family, those with the smallest hash; the start for k is the first
k of the draw. Ties go to the smaller cluster or id.

The driver holds centres, sizes and scores (families x k x cluster x dimension numbers) and the start rows, never
the table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# --- Fixed values: defaults of the sweep ----------------------------------------------
GRID = 4096
SEED = 42
MAX_STEPS = 20
START_ROWS = 2000
# --- end of fixed values ----------------------------------------------------------------

#: Rows whose distances are held at a time, times the number of centres.
TILE = 1 << 21


@dataclass(frozen=True)
class Fit:
    """A fitted clustering of one family: centres in grid units (k x dimension), and what the sweep knows of it."""

    family: str
    k: int
    centres: np.ndarray
    sizes: tuple[int, ...] = ()
    training_cost: float = 0.0
    silhouette: float | None = None

    @property
    def min_size(self) -> int:
        return min((n for n in self.sizes if n > 0), default=0)

    @property
    def points(self) -> list[list[float]]:
        """The centres in the units of the features."""
        return (self.centres / GRID).tolist()


def on_grid(features: Column, grid: int = GRID) -> Column:
    """An array column on the grid, as whole doubles."""
    return F.transform(features, lambda v: F.floor(v * F.lit(float(grid)) + F.lit(0.5)).cast("double"))


def grid_rows(df: DataFrame, id_col: str, features_col: str, family_col: str | None) -> DataFrame:
    """(id, family, x): what the passes read. The id as text, as the draws use it."""
    vector = isinstance(df.schema[features_col].dataType, VectorUDT)
    x = vector_to_array(F.col(features_col)) if vector else F.col(features_col).cast("array<double>")
    family = F.col(family_col).cast("string") if family_col else F.lit("")
    return df.select(F.col(id_col).cast("string").alias("id"), family.alias("family"), on_grid(x).alias("x"))


# ---- starts


def draw(seed: int, step: int, entity: str) -> float:
    """A keyed number in (0, 1), the same for the same entity everywhere."""
    return (int(hashlib.md5(f"{seed}:{step}:{entity}".encode()).hexdigest()[:13], 16) + 0.5) / 2.0**52


def start_order(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:0:"), F.col("id")).cast("binary"))


def starts(ids: Sequence[str], x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Up to k different rows: the first of all, then each time one drawn with a weight of its squared
    distance to the nearest so far (the least of -ln(u) / distance)."""
    chosen, nearest = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < k and nearest.max() > 0:
        wait = np.array([-math.log(draw(seed, len(chosen), i)) / d if d > 0 else np.inf for i, d in zip(ids, nearest)])
        chosen.append(int(wait.argmin()))
        nearest = np.minimum(nearest, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def _start_rows(rows: DataFrame, seed: int, start_rows: int) -> dict[str, tuple[list[str], np.ndarray]]:
    order = Window.partitionBy("family").orderBy("o", "id")
    first = rows.withColumn("o", start_order(seed)).withColumn("r", F.row_number().over(order)).filter(F.col("r") <= start_rows)
    found: dict[str, list] = {}
    for r in first.select("family", "r", "id", "x").collect():
        found.setdefault(r["family"], []).append((r["r"], r["id"], r["x"]))
    return {f: ([i for _, i, _ in sorted(rs)], np.array([x for _, _, x in sorted(rs)])) for f, rs in found.items()}


# ---- passes


def _by_family(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    coded = batch.column("family").dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    values, dims = batch.column("x").flatten().to_numpy(zero_copy_only=False), batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
    first = np.cumsum(dims) - dims
    for c, family in enumerate(coded.dictionary.to_pylist()):
        at = np.flatnonzero(code == c)
        yield family, values[first[at][:, None] + np.arange(dims[at[0]])[None, :]]


def _tiles(x: np.ndarray, centres: int) -> Iterator[np.ndarray]:
    step = max(1, TILE // max(1, centres))
    for i in range(0, len(x), step):
        yield x[i : i + step]


def _distances(x: np.ndarray, fits: Sequence[Fit]) -> tuple[np.ndarray, list[slice]]:
    """Squared distances (rows x centres of all fits) and the columns of each fit."""
    c = np.concatenate([f.centres for f in fits])
    ends = np.cumsum([len(f.centres) for f in fits])
    d = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    return d, [slice(e - len(f.centres), e) for e, f in zip(ends, fits)]


def _step(shared):
    """Per (family, k, cluster): rows, sum of squared distances, sum of squared lengths, sums of the components."""
    names = ["family", "k", "cluster", "n", "cost", "norm", "sums"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits: dict[str, list[Fit]] = shared.value
        got = {f: [np.zeros((len(t.centres), t.centres.shape[1] + 3)) for t in ts] for f, ts in fits.items()}
        for batch in batches:
            for family, rows in _by_family(batch):
                for x in _tiles(rows, sum(len(t.centres) for t in fits.get(family, ()))) if family in fits else ():
                    d, columns = _distances(x, fits[family])
                    for sums, at in zip(got[family], columns):
                        own = d[:, at].argmin(axis=1)
                        member = np.zeros((len(x), at.stop - at.start))
                        member[np.arange(len(x)), own] = 1.0
                        row = np.column_stack([np.ones(len(x)), d[:, at].min(axis=1), (x * x).sum(axis=1), x])
                        sums += member.T @ row
        for family, parts in got.items():
            for t, sums in zip(fits[family], parts):
                for c in np.flatnonzero(sums[:, 0]):
                    head = [pa.array([family]), pa.array([t.k], pa.int32()), pa.array([c], pa.int32())]
                    counts = [pa.array([int(v)], pa.int64()) for v in sums[c, :3]]
                    yield pa.RecordBatch.from_arrays([*head, *counts, pa.array([sums[c, 3:].astype(np.int64).tolist()], pa.list_(pa.int64()))], names=names)

    return run


def _silhouettes(shared):
    """Per (family, k): the sum of the rows' silhouettes, from the clusters' sizes, sums and squared lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[tuple]] = shared.value  # fit, sizes, squared lengths, sums
        total = {f: [0.0] * len(ts) for f, ts in known.items()}
        for batch in batches:
            for family, rows in _by_family(batch):
                parts = known.get(family, [])
                for x in _tiles(rows, sum(len(t[1]) for t in parts)) if parts else ():
                    d, columns = _distances(x, [t[0] for t in parts])
                    norm = (x * x).sum(axis=1)
                    for i, ((_, n, q, s), at) in enumerate(zip(parts, columns)):
                        total[family][i] += float(_row_silhouettes(x, norm, d[:, at].argmin(axis=1), n, q, s).sum())
        for family, values in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([family] * len(values)), pa.array([t[0].k for t in known[family]], pa.int32()), pa.array(values, pa.float64())], names=["family", "k", "s"]
            )

    return run


def _row_silhouettes(x: np.ndarray, norm: np.ndarray, own: np.ndarray, n: np.ndarray, q: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Silhouette by mean squared distances: 0 for the only member of a cluster."""
    size = np.maximum(n, 1)
    mean = norm[:, None] + (q / size)[None, :] - 2 * (x @ s.T) / size[None, :]
    mean[:, n == 0] = np.inf
    rows = np.arange(len(x))
    a = mean[rows, own] * size[own] / np.maximum(size[own] - 1, 1)
    mean[rows, own] = np.inf
    b = mean.min(axis=1)
    top = np.maximum(a, b)
    return np.where((n[own] > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1), 0.0)


def _sums(rows: DataFrame, fits: Mapping[str, Sequence[Fit]]) -> dict[tuple[str, int, int], tuple]:
    """One pass: (family, k, cluster) -> (rows, cost, squared lengths, sums). Sums of the tasks meet component by component."""
    shared = rows.sparkSession.sparkContext.broadcast(dict(fits))
    try:
        parts = rows.mapInArrow(_step(shared), "family string, k int, cluster int, n long, cost long, norm long, sums array<long>")
        keys = ["family", "k", "cluster"]
        flat = parts.select(*keys, "n", "cost", "norm", F.posexplode("sums").alias("pos", "v"))
        # a row of n, cost and norm per component; all are summed alike
        added = flat.groupBy(*keys, "pos").agg(*[F.sum(c).alias(c) for c in ("n", "cost", "norm", "v")])
        found: dict[tuple, dict] = {}
        for r in added.collect():
            found.setdefault((r["family"], r["k"], r["cluster"]), {})[r["pos"]] = r
        return {key: (got[0]["n"], got[0]["cost"], got[0]["norm"], np.array([got[p]["v"] for p in range(len(got))], float)) for key, got in found.items()}
    finally:
        shared.destroy()


def _moved(fit: Fit, got: Mapping[tuple, tuple]) -> Fit:
    """Centres to the rounded means of their members; one without members stays."""
    centres = fit.centres.copy()
    for c in range(len(centres)):
        if (fit.family, fit.k, c) in got:
            n, _, _, sums = got[fit.family, fit.k, c]
            centres[c] = np.floor((2.0 * sums + n) / (2.0 * n))
    return replace(fit, centres=centres)


def sweep_kmeans(
    df: DataFrame,
    id_col: str,
    ks: Mapping[str, Iterable[int]] | Iterable[int],
    features_col: str = "features",
    family_col: str | None = None,
    seed: int = SEED,
    max_steps: int = MAX_STEPS,
    start_rows: int = START_ROWS,
    materialised: bool = False,
) -> dict[str, list[Fit]]:
    """Family -> its fits in order of k, each with its centres, sizes, cost (sum of squared distances to the
    centres) and silhouette (None where fewer than two clusters have members).

    ``ks``: the values of k, per family (families not listed are left out) or for all rows as
    one population (``family_col`` None, reported under ''). The vectors of a family have one length. A family with
    fewer different start rows than k gets as many centres as it has. ``max_steps`` bounds the steps; a fit whose
    centres no longer move takes no part in the next pass. ``materialised``: the input is persisted or written already.
    """
    plan = {str(f): sorted(set(v)) for f, v in ks.items()} if isinstance(ks, Mapping) else {"": sorted(set(ks))}
    rows = grid_rows(df, id_col, features_col, family_col)
    rows = rows.filter(F.col("family").isin(*plan)) if family_col else rows
    rows = rows if materialised else cut_lineage(rows)
    fits: dict[str, list[Fit]] = {}
    for family, (ids, x) in _start_rows(rows, seed, start_rows).items():
        first = starts(ids, x, max(plan[family]), seed)
        fits[family] = [Fit(family, k, first[:k]) for k in plan[family]]
    moving = fits
    for _ in range(max_steps):
        got = _sums(rows, moving) if moving else {}
        new = {(t.family, t.k): _moved(t, got) for ts in moving.values() for t in ts}
        still = {key for key, t in new.items() if not np.array_equal(t.centres, next(o for o in fits[key[0]] if o.k == key[1]).centres)}
        fits = {f: [new.get((f, t.k), t) for t in ts] for f, ts in fits.items()}
        moving = {f: [t for t in ts if (f, t.k) in still] for f, ts in fits.items()}
        moving = {f: ts for f, ts in moving.items() if ts}
        if not moving:
            break
    return _scored(rows, fits)


def _scored(rows: DataFrame, fits: dict[str, list[Fit]]) -> dict[str, list[Fit]]:
    """Sizes, cost and silhouette of the final centres: two passes for all fits."""
    if not fits:
        return fits
    got = _sums(rows, fits)
    known, out = {}, {}
    for family, ts in fits.items():
        dim = ts[0].centres.shape[1]
        empty = (0, 0, 0, np.zeros(dim))
        tables = [[got.get((family, t.k, c), empty) for c in range(len(t.centres))] for t in ts]
        known[family] = [(t, np.array([g[0] for g in tab], float), np.array([g[2] for g in tab], float), np.array([g[3] for g in tab])) for t, tab in zip(ts, tables)]
        out[family] = [replace(t, sizes=tuple(int(g[0]) for g in tab), training_cost=sum(g[1] for g in tab) / GRID**2) for t, tab in zip(ts, tables)]
    shared = rows.sparkSession.sparkContext.broadcast(known)
    parts = rows.mapInArrow(_silhouettes(shared), "family string, k int, s double").groupBy("family", "k").agg(F.sum("s").alias("s"))
    total = {(r["family"], r["k"]): r["s"] for r in parts.collect()}
    shared.destroy()
    # the last digits of a sum of doubles follow its order: not part of the result
    score = lambda t: round(total[t.family, t.k] / sum(t.sizes), 9) if sum(n > 0 for n in t.sizes) > 1 else None
    return {f: [replace(t, silhouette=score(t)) for t in ts] for f, ts in out.items()}


def assign(df: DataFrame, fits: Sequence[Fit], features_col: str = "features", family_col: str | None = None, cluster_out: str = "cluster", grid: int = GRID) -> DataFrame:
    """``df`` with the nearest centre of each row's family as ``cluster_out`` (int): exact distances on
    the grid, ties to the smaller cluster. Rows of other families have none (NULL). The centres (one fit per family) are a
    column of the plan; nothing is shuffled."""
    if not fits:
        return df.withColumn(cluster_out, F.lit(None).cast("int"))
    vector = isinstance(df.schema[features_col].dataType, VectorUDT)
    x = on_grid(vector_to_array(F.col(features_col)) if vector else F.col(features_col).cast("array<double>"), grid)
    # without families the one fit is found by the length of the vectors: a join needs a key
    key = lambda t: t.family if family_col else str(t.centres.shape[1])
    table = df.sparkSession.createDataFrame(
        [(key(t), [(c, [float(v) for v in row]) for c, row in enumerate(t.centres)]) for t in fits], "_family string, _centres array<struct<c:int,v:array<double>>>"
    )
    family = F.col(family_col).cast("string") if family_col else F.size(x).cast("string")
    distance = lambda v: F.aggregate(F.zip_with("_x", v, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, e: s + e)
    nearest = F.array_min(F.transform("_centres", lambda c: F.struct(distance(c["v"]).alias("d"), c["c"].alias("c"))))
    # model state: as many numbers as the fits have
    with_centres = df.withColumns({"_family": family, "_x": x}).join(F.broadcast(table), "_family", "left")
    return with_centres.select(*df.columns, nearest["c"].alias(cluster_out))
