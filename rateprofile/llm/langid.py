"""Language identification by nearest centroid over normalised TF-IDF n-gram vectors.

A text is the vector of its hashed letter n-grams (1 to 3 bytes of lower-cased text in
which everything but letters is a space), damped counts times inverse document frequency,
at unit length. Each language has a few centroids, from spherical k-means over
its labelled texts. A text goes to the language of the
centroid with the highest cosine; it is rejected if that cosine is too far below
what the texts of that language show.

Everything is learned from all labelled texts: document frequencies count every row; the
centroids, the sizes of the clusters and the limits every different text of a language once.
The texts' counts are written once; each round of k-means is a job over them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, rows_with_text, slices, text_bytes, text_of

DIMS = 4096
CLUSTERS = 3
ITERATIONS = 12
#: A cluster with less than this share of the texts, or of a single text, gives no centroid.
LEAST_CLUSTER = 0.02
#: A cosine below this share of the lowest percentile of the language's texts, each held against
#: centroids without itself, is rejected. The percentile is that of pieces with a like number of n-grams.
REJECT_SHARE = 0.8
#: Bands of n-gram numbers, two to a doubling; the last holds all longer texts.
BANDS = 30
#: For the percentile, cosines are rounded down to multiples of 1 / COSINE_STEPS.
COSINE_STEPS = 1 << 16
#: Sums of vectors are added up as multiples of 1 / FIXED, so that their order does not matter.
FIXED = 1 << 20
UNKNOWN = "und"
#: Texts whose count vectors are held at a time: few enough for a core's cache.
SLICE_ROWS = 64

_LOW = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256)], np.uint8)


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' letters and single spaces, one after each text, and the text of each."""
    n = len(offsets) - 1
    apart = _LOW[np.insert(data, offsets[1:], 32)] if n else np.zeros(0, np.uint8)
    text = np.repeat(np.arange(n), np.diff(offsets) + 1)
    space = apart == 32
    keep = ~(space & np.concatenate(([True], space[:-1])))
    return apart[keep].astype(np.uint32), text[keep]


def gram_hash(parts: list[np.ndarray], dims: int) -> np.ndarray:
    """Hash of n-grams, given their first letters, their second ones and so on."""
    code = np.full(len(parts[0]), len(parts), np.uint32)
    for b in parts:
        code = code * np.uint32(0x01000193) ^ b
    code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (code ^ (code >> np.uint32(12))) % np.uint32(dims)


def grams(b: np.ndarray, text: np.ndarray, dims: int = DIMS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the last letter, hash) of the n-grams of each size in ``letters``."""
    for size in (1, 2, 3):
        if len(b) < size:
            break
        m = len(b) - size + 1
        code = gram_hash([b[k : k + m] for k in range(size)], dims)
        # n-grams within one text, none that is a lone space
        fine = np.flatnonzero((text[:m] == text[size - 1 :]) & ((b[:m] != 32) | (size > 1)))
        yield fine + (size - 1), code[fine]


def gram_counts(data: np.ndarray, offsets: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """Hashed n-gram counts, a row per text."""
    n = len(offsets) - 1
    out = np.zeros(n * dims, np.float32)
    b, text = letters(data, offsets)
    for last, code in grams(b, text, dims):
        out += np.bincount(text[last] * dims + code, minlength=n * dims).astype(np.float32)
    return out.reshape(n, dims)


def band(grams: np.ndarray) -> np.ndarray:
    return np.minimum((2 * np.log2(np.maximum(grams, 1))).astype(np.int64), BANDS - 1)


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(length > 0, length, 1)


@dataclass
class Model:
    """idf, and centroids with their language and, per band, the cosine below which a text is rejected."""

    idf: np.ndarray
    langs: list[str]
    centroids: np.ndarray
    low: np.ndarray


def packed(counts: np.ndarray) -> list[bytes]:
    """Each row of counts in the narrowest integers that hold it."""
    return [row.astype(np.min_scalar_type(int(most)).newbyteorder("<")).tobytes() for row, most in zip(counts, counts.max(axis=1, initial=0))]


def unpacked(rows: pa.Array, dims: int) -> np.ndarray:
    data, offsets = text_bytes(rows)
    out = np.empty((len(rows), dims), np.float32)
    for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        out[k] = data[a:b].view(f"<u{(b - a) // dims}")
    return out


def _counts(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets, rows=SLICE_ROWS):
                counts = gram_counts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], dims)
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(packed(counts), pa.binary())], names=[*part.schema.names, "counts"])

    return run


def _frequencies(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(dims, np.int64), 0
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS)
                copies = part.column("copies").to_numpy()
                rows += int(copies.sum())
                total += copies @ (unpacked(part.column("counts"), dims) > 0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, dims, dtype=np.int32)), pa.array(np.concatenate(([rows], total)))], names=["gram", "n"])

    return run


def _languages(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The rows of a batch by language."""
    for lang in batch.column("lang").unique().to_pylist():
        yield lang, batch.filter(pc.equal(batch.column("lang"), lang))


@dataclass
class Clusters:
    """Clusters of a language: the directions by which texts are dealt to them (of length 0: of no text), the number of
    texts that each got, and the sum of these."""

    centers: np.ndarray
    size: np.ndarray
    sums: np.ndarray

    def nearest(self, x: np.ndarray) -> np.ndarray:
        cosine = x @ self.centers.T
        cosine[:, ~self.centers.any(axis=1)] = -1
        return cosine.argmax(axis=1)

    def moved(self) -> np.ndarray:
        """Directions of the sums; a cluster that lost its texts stays where it was."""
        length = np.linalg.norm(self.sums, axis=1, keepdims=True)
        return np.where(length > 0, self.sums / np.maximum(length, 1e-12), self.centers).astype(np.float32)

    def large(self) -> np.ndarray:
        """Which clusters give a centroid: those that are not too small, or else all."""
        enough = self.size >= max(2, int(np.ceil(LEAST_CLUSTER * self.size.sum())))
        return enough if enough.any() else self.size > 0


@dataclass
class Closeness:
    """Deals texts of a language by their cosine with its mean, at the ``cuts``."""

    mean: np.ndarray
    cuts: np.ndarray

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, x @ self.mean)


def _cluster_sums(shared, langs: list[str], clusters: int):
    """Number and sum of each cluster's texts, dealt by ``shared``: idf and how each language's are dealt. Cells are
    numbered by language, cluster and n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, deal = shared.value
        dims = len(idf)
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, rows in _languages(batch):
                here = total.setdefault(lang, np.zeros((clusters, dims + 1)))
                for i in range(0, rows.num_rows, SLICE_ROWS):
                    x = unit(unpacked(rows.column("counts").slice(i, SLICE_ROWS), dims), idf)
                    own = deal[lang].nearest(x) if deal else np.zeros(len(x), np.int64)
                    member = (own == np.arange(clusters)[:, None]).astype(np.float32)
                    here[:, :dims] += member @ x
                    here[:, dims] += member.sum(axis=1)
        for lang, sums in total.items():
            cell = np.flatnonzero(sums)
            value = np.rint(sums.ravel()[cell] * FIXED).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell + langs.index(lang) * sums.size), pa.array(value)], names=["cell", "value"])

    return run


def _round(texts: DataFrame, langs: list[str], idf: np.ndarray, deal: dict[str, Clusters] | dict[str, Closeness] | None, clusters: int) -> dict[str, Clusters]:
    """Deal all texts (None: to one cluster a language) and add them up."""
    dims = len(idf)
    shared = texts.sparkSession.sparkContext.broadcast((idf, deal))
    part = texts.select("lang", "counts").mapInArrow(_cluster_sums(shared, langs, clusters), "cell long, value long")
    got = part.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    shared.destroy()
    sums = np.zeros((len(langs), clusters, dims + 1))
    sums.ravel()[got.column("cell").to_numpy()] = got.column("value").to_numpy() / FIXED
    out = {}
    for lang, of in zip(langs, sums):
        centers = deal[lang].centers if deal and isinstance(deal[lang], Clusters) else np.zeros((clusters, dims), np.float32)
        out[lang] = Clusters(centers, np.rint(of[:, dims]).astype(np.int64), of[:, :dims])
    return out


def _tally(lang: str, bands: np.ndarray, cosines: np.ndarray) -> pa.RecordBatch:
    """Numbers of equal cosines, in steps, per band."""
    steps = np.floor(np.clip(cosines, 0, 1) * COSINE_STEPS).astype(np.int64)
    key, n = np.unique(bands * (COSINE_STEPS + 1) + steps, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key // (COSINE_STEPS + 1)), pa.array(key % (COSINE_STEPS + 1) / COSINE_STEPS), pa.array(n)], names=["lang", "band", "cosine", "n"])


_TALLY = "lang string, band long, cosine double, n long"


def _mean_cosines(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean = shared.value
        for batch in batches:
            for lang, rows in _languages(batch):
                counts = (rows.column("counts").slice(i, SLICE_ROWS) for i in range(0, rows.num_rows, SLICE_ROWS))
                cosines = np.concatenate([unit(unpacked(c, len(idf)), idf) @ mean[lang] for c in counts])
                yield _tally(lang, np.zeros(len(cosines), np.int64), cosines)

    return run


def kmeans(texts: DataFrame, langs: list[str], idf: np.ndarray, clusters: int, iterations: int = ITERATIONS) -> dict[str, Clusters]:
    """Spherical k-means over all texts of each language, until no sum changes. Starts from parts with
    equally many texts, dealt by the cosine with the language's mean."""
    whole = _round(texts, langs, idf, None, 1)
    if clusters == 1:
        return whole
    mean = {lang: c.moved()[0] for lang, c in whole.items()}
    shared = texts.sparkSession.sparkContext.broadcast((idf, mean))
    near = texts.select("lang", "counts").mapInArrow(_mean_cosines(shared), _TALLY).groupBy("lang")
    cuts = near.agg(F.percentile("cosine", F.array(*[F.lit(k / clusters) for k in range(1, clusters)]).cast("array<double>"), F.col("n"))).collect()
    shared.destroy()
    found = _round(texts, langs, idf, {lang: Closeness(mean[lang], np.array(c)) for lang, c in cuts}, clusters)
    for _ in range(iterations):
        before = found
        found = _round(texts, langs, idf, {lang: Clusters(c.moved(), c.size, c.sums) for lang, c in before.items()}, clusters)
        if all(np.array_equal(c.sums, before[lang].sums) for lang, c in found.items()):
            break
    return found


def piece_cosines(data: np.ndarray, offsets: np.ndarray, idf: np.ndarray, found: Clusters) -> tuple[np.ndarray, np.ndarray]:
    """(band, highest cosine with the centroids) of the pieces of some texts of one language, as if the text were not
    in its cluster. Pieces are a text's first 2 ** (half / 2) letters for every half, up to the whole text."""
    dims, n = len(idf), len(offsets) - 1
    b, text = letters(data, offsets)
    first = np.searchsorted(text, np.arange(n))
    size = np.bincount(text, minlength=n) - 1  # without the space after it
    half_of = lambda letters: np.maximum(np.ceil(2 * np.log2(np.maximum(letters, 1))), 2).astype(np.uint8)
    halves = np.where(size > 0, half_of(size), 0)
    # the longest first: half by half fewer rows go on
    order = np.argsort(-halves.astype(np.int64), kind="stable")
    first, halves = first[order], halves[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    row = rank[text]
    half = np.minimum(half_of(np.arange(1, len(b) + 1) - first[row]), halves[row])
    place = row * dims
    parts = list(grams(b, text, dims))
    by_half = np.concatenate([half[last] for last, _ in parts])
    key = np.concatenate([place[last] + code for last, code in parts])
    starts = np.concatenate(([0], np.cumsum(np.bincount(by_half, minlength=int(halves.max(initial=0)) + 1))))
    key = key[np.argsort(by_half, kind="stable")]

    large = found.large()
    length = np.linalg.norm(found.sums[large], axis=1)
    centers = (found.sums[large] / length[:, None]).astype(np.float32)
    whole = unit(np.bincount(key, minlength=n * dims).reshape(n, dims).astype(np.float32), idf)
    own = np.where(large, np.cumsum(large) - 1, -1)[found.nearest(whole)]
    inside = np.flatnonzero(own >= 0)
    dot = (whole[inside] * centers[own[inside]]).sum(axis=1) * length[own[inside]]
    # length of the own cluster's sum without the text; nothing is left of a single text's
    rest = np.full(n, np.inf)
    rest[inside] = np.where(found.size[large][own[inside]] > 1, np.sqrt(np.maximum(length[own[inside]] ** 2 - 2 * dot + 1, 1e-12)), np.inf)

    counts, total = np.zeros(n * dims, np.float32), np.zeros(n)
    square, along, with_whole = np.zeros(n), np.zeros((len(centers), n)), np.zeros(n)
    flat = whole.ravel()

    def add(keys: np.ndarray, more: np.ndarray | int) -> None:
        """More n-grams in some places of ``counts``: their part in the pieces' squared length and products changes."""
        before = counts[keys]
        after = before + np.float32(more)
        counts[keys] = after
        r, gram = keys // dims, keys % dims
        weight = idf[gram]
        old, new = np.log1p(before) * weight, np.log1p(after) * weight
        gain = new - old
        sums = lambda v: np.bincount(r, v, minlength=n)
        total[:] += sums(after - before)
        square[:] += sums(gain * (new + old))
        with_whole[:] += sums(gain * flat[keys])
        for k in range(len(centers)):
            along[k] += sums(gain * centers[k][gram])

    bands, cosines = [np.zeros(0, np.int64)], [np.zeros(0)]
    for h in range(2, len(starts) - 1):
        m, cut = int((halves >= h).sum()), np.flatnonzero(halves > h)
        new = key[starts[h] : starts[h + 1]]
        if len(new) * 8 < m * dims:
            add(*np.unique(new, return_counts=True))
        else:
            more = np.bincount(new, minlength=m * dims)
            some = np.flatnonzero(more)
            add(some, more[some])
        # a piece that is cut ends in a space too
        at = first[cut] + int(2 ** (h / 2)) - 1
        cut, at = cut[b[at] != 32], at[b[at] != 32]
        space = np.full(len(at), 32, np.uint32)
        ends = [cut * dims + gram_hash([b[at], space], dims), cut * dims + gram_hash([b[at - 1], b[at], space], dims)]
        for e in ends:
            add(e, 1)
        got = along[:, :m] / np.sqrt(square[:m])
        at = inside[inside < m]
        got[own[at], at] = (got[own[at], at] * length[own[at]] - with_whole[at] / np.sqrt(square[at])) / rest[at]
        bands.append(band(total[:m]))
        cosines.append(got.max(axis=0))
        for e in ends:
            add(e, -1)
    return np.concatenate(bands), np.concatenate(cosines)


def _pieces(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, found = shared.value
        for batch in batches:
            for lang, rows in _languages(batch):
                data, offsets = text_bytes(rows.column("text"))
                got = [piece_cosines(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], idf, found[lang]) for i, j in slices(offsets, rows=SLICE_ROWS)]
                yield _tally(lang, *(np.concatenate(x) for x in zip(*got)))

    return run


def _piece_limits(texts: DataFrame, idf: np.ndarray, found: dict[str, Clusters]) -> dict[str, np.ndarray]:
    """Lowest percentile, per band, of the cosines of pieces of all texts of a language. A band
    with too few pieces for a percentile has the limit of the one below."""
    shared = texts.sparkSession.sparkContext.broadcast((idf, found))
    pieces = texts.select("lang", "text").mapInArrow(_pieces(shared), _TALLY)
    got = pieces.groupBy("lang", "band").agg(F.percentile("cosine", 0.01, F.col("n")), F.sum("n")).collect()
    shared.destroy()
    limit = {(lang, b): (low, n) for lang, b, low, n in got}
    out = {}
    for lang, c in found.items():
        least = max(1, min(50, int(c.size.sum()) // 4))
        out[lang] = low = np.zeros(BANDS)
        for b in range(BANDS):
            value, n = limit.get((lang, b), (0.0, 0))
            low[b] = value if n >= least else low[max(b - 1, 0)]
    return out


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dims: int = DIMS, clusters: int = CLUSTERS, reject_share: float = REJECT_SHARE) -> Model:
    """Learn from the rows with a text that has letters and a language. The driver
    gets ``dims`` sums and, per language and round, those of ``clusters`` clusters, whatever the size of the table."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & has_letter(F.col(text_col))).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    different = rows.groupBy("lang", "text").agg(F.count("*").alias("copies"))
    texts = materialise(different.mapInArrow(_counts(dims), "lang string, text string, copies long, counts binary"), "language-texts")
    sums = texts.select("copies", "counts").mapInArrow(_frequencies(dims), "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    got = dict(sums.collect())
    n = got.pop(-1, 0)
    idf = np.array([np.log((1 + n) / (1 + got.get(g, 0))) + 0.05 for g in range(dims)], np.float32)
    if not n:
        return Model(idf, [], np.zeros((0, dims)), np.zeros((0, BANDS)))
    langs = sorted(r["lang"] for r in texts.select("lang").distinct().collect())
    found = kmeans(texts, langs, idf, clusters)
    limits = _piece_limits(texts, idf, found)
    of = [lang for lang in langs for _ in range(int(found[lang].large().sum()))]
    return Model(idf, of, np.concatenate([found[lang].moved()[found[lang].large()] for lang in langs]), np.array([reject_share * limits[lang] for lang in of]))


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``row`` (struct of the input columns ``keep``, all by default, whatever their
    names), ``lang_pred``, ``score`` (cosine, 0 to 1), ``rejected``.

    Null texts and texts without a letter are ``und``, score 0 and rejected, and so is
    everything if no language was learned. Ties go to the first language by name. Repeated rows are
    judged one by one; memory follows the longest text.
    """
    out = docs.select(*rows_with_text(docs, text_col, keep), has_letter(F.col(text_col)).alias("letters"))
    schema = out.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("rejected")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        langs = np.array([*m.langs, UNKNOWN], object)
        for batch in batches:
            data, offsets = text_bytes(text_of(batch, text_col))
            known = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool) & (len(m.langs) > 0)
            best, score, grams = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0)]
            for i, j in slices(offsets, rows=SLICE_ROWS):
                counts = gram_counts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], len(m.idf))
                cosine = unit(counts, m.idf) @ m.centroids.T if len(m.langs) else np.zeros((j - i, 1))
                best.append(cosine.argmax(axis=1))
                score.append(cosine.max(axis=1))
                grams.append(counts.sum(axis=1))
            best_, score_, grams_ = (np.concatenate(x) for x in (best, score, grams))
            low = np.vstack((m.low, np.zeros((1, BANDS))))[np.minimum(best_, len(m.low)), band(grams_)]
            rejected = ~known | (score_ < low)
            pred = np.where(known, langs[np.minimum(best_, len(langs) - 1)], UNKNOWN)
            score_ = np.where(known, np.clip(score_, 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(pred.tolist(), pa.string()), pa.array(score_.astype(np.float64)), pa.array(rejected)], names=["row", "lang_pred", "score", "rejected"])

    return out.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """The third of the documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


# ---- in memory; `fit` clusters whole tables by `kmeans`


def spherical_kmeans(x: np.ndarray, k: int, iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """(centroids of unit length, cluster of each row). Starts far apart, from the first row."""
    centers = x[:1]
    while len(centers) < min(k, len(x)):
        nearest = (x @ centers.T).max(axis=1)
        if nearest.min() > 1 - 1e-6:
            break
        centers = np.vstack((centers, x[int(nearest.argmin())]))
    for _ in range(iterations):
        own = (x @ centers.T).argmax(axis=1)
        sums = np.stack([x[own == c].sum(axis=0) if (own == c).any() else centers[c] for c in range(len(centers))])
        centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centers, (x @ centers.T).argmax(axis=1)


def large_clusters(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums, cluster or -1 of each row). Rows of clusters that are too small are set aside and the others
    clustered again; a language with nothing else keeps them as one cluster."""
    least = max(2, int(np.ceil(LEAST_CLUSTER * len(x))))
    own, rows = np.full(len(x), -1), np.arange(len(x))
    while len(rows) >= least:
        found = spherical_kmeans(x[rows], k)[1]
        size = np.bincount(found)
        if size[size > 0].min() >= least:
            own[rows] = np.unique(found, return_inverse=True)[1]
            break
        rows = rows[size[found] >= least]
    if own.max() < 0:
        own[:] = 0
    return np.stack([x[own == c].sum(axis=0) for c in range(own.max() + 1)]), own
