"""Document quality from a linear-chain conditional random field over lines.

Every line that holds a word is labelled good or bad. Its potential is linear in its own
features and in those of the line before and after it; four weights rate the step from
one label to the next. Forward and backward sums give each line's probability of being good, and
the document's quality is the mean of those, weighted by the lines' lengths.

The weights maximise the likelihood of a bounded sample of labelled documents, in which each line
carries the label of its document: at most ``sample`` documents per label, those with the smallest hash,
leaving out documents of more than ``FIT_LINES`` lines. Each label weighs what it weighs among all
labelled rows. Scoring reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, slices, text_bytes

SAMPLE = 2000
FIT_LINES = 500
ITERATIONS = 250
RATE = 0.1
PENALTY = 1e-3
#: Documents with a score from here on are predicted good.
THRESHOLD = 0.3
#: Documents, and bytes of text, whose features are held at a time.
SLICE_ROWS, SLICE_SIZE = 1024, 1 << 19

# ---- features of lines

_SPACE, _LOWER, _UPPER, _DIGIT, _WIDE, _MARK = range(6)
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
#: Byte -> class; every ASCII mark has a class of its own.
_CLASS = np.array([_LOWER if 97 <= b <= 122 else _UPPER if 65 <= b <= 90 else _DIGIT if 48 <= b <= 57 else _WIDE if b >= 0x80 else _MARK + _MARKS.index(b) if b in _MARKS else _SPACE for b in range(256)], np.int64)
_CLASSES = _MARK + len(_MARKS)
_IN_WORD = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
#: Marks that end words of ordinary prose.
_PROSE = np.isin(np.arange(256), [ord(c) for c in ".,;:?!'\")]}"])
_OWN = _CLASSES + 13
#: Own, previous and next line, no previous line, no next line, constant.
FEATURES = 3 * _OWN + 3


def _hashes(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes."""
    if not len(first):
        return np.zeros(0, np.uint64)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    part = (data[np.repeat(first, size) + place].astype(np.uint64) + np.uint64(1)) * mix64(place.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return mix64(np.add.reduceat(part, np.cumsum(size) - size))


def _seen_before(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether an equal value stands earlier in the same group (rows in order)."""
    order = np.lexsort((np.arange(len(group)), value, group))
    g, v = group[order], value[order]
    out = np.zeros(len(group), bool)
    out[order[1:]] = (g[1:] == g[:-1]) & (v[1:] == v[:-1])
    return out


@dataclass
class Lines:
    """Lines with a word: ``doc`` they are of, bytes ``start`` to ``end`` in it, own features ``x``."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    x: np.ndarray


def line_features(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Lines of some texts, in order. Features are square roots of shares, so that rare marks count too."""
    n_docs = len(offsets) - 1
    apart = np.insert(data, offsets[1:], 10)
    doc_end = offsets[1:] + np.arange(n_docs)
    end = np.flatnonzero(apart == 10)
    first = np.concatenate(([0], end[:-1] + 1)) if len(end) else end
    size = end - first
    doc = np.searchsorted(doc_end, end)
    n = len(end)
    line = np.repeat(np.arange(n), size + 1)
    by_class = np.bincount(line * _CLASSES + _CLASS[apart], minlength=n * _CLASSES).reshape(n, _CLASSES).astype(np.float64)
    by_class[:, _SPACE] -= 1  # the line's own end
    mask = _IN_WORD[apart]
    edge = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0))
    w_first, w_end = edge[0::2], edge[1::2]
    w_size, w_line = w_end - w_first, line[w_first]
    value = _hashes(apart, w_first, w_size)
    words = np.bincount(w_line, minlength=n).astype(np.float64)
    count = lambda flags: np.bincount(w_line[flags], minlength=n).astype(np.float64)
    again = np.zeros(len(value), bool)
    again[1:] = (value[1:] == value[:-1]) & (w_line[1:] == w_line[:-1])
    last, lead = apart[w_end - 1], apart[w_first]
    letters = np.concatenate(([0], np.cumsum(np.isin(_CLASS[apart], (_LOWER, _UPPER, _WIDE)))))
    upper = np.concatenate(([0], np.cumsum(_CLASS[apart] == _UPPER)))
    lower = np.concatenate(([0], np.cumsum(_CLASS[apart] == _LOWER)))
    w_letters, w_upper, w_lower = (c[w_end] - c[w_first] for c in (letters, upper, lower))
    repeated = np.zeros(len(apart), bool)
    repeated[1:] = (apart[1:] == apart[:-1]) & (_CLASS[apart[1:]] >= _MARK)
    whole = _hashes(apart, first, size + 1)
    same = np.zeros(n, bool)
    same[1:] = (whole[1:] == whole[:-1]) & (doc[1:] == doc[:-1])
    per = lambda a, b: a / np.maximum(b, 1)
    own = np.column_stack(
        [
            np.sqrt(per(by_class, size[:, None])),
            np.sqrt(per(count(again), words)),
            np.sqrt(per(count(_seen_before(w_line, value)), words)),
            np.sqrt(per(count((w_upper > 1) & (w_lower == 0)), words)),
            np.sqrt(per(count(_CLASS[lead] == _UPPER), words)),
            np.sqrt(per(count(w_letters == 0), words)),
            np.sqrt(per(count((_CLASS[last] >= _MARK) & ~_PROSE[last]), words)),
            np.sqrt(per(count(_CLASS[last] >= _MARK), words)),
            np.sqrt(per(np.bincount(line[repeated], minlength=n), size)),
            np.log1p(per(size - by_class[:, _SPACE], words)),
            np.log1p(words),
            np.log1p(words) ** 2 / 8,
            same,
            _seen_before(doc, whole),
        ]
    )
    keep = words > 0
    at = np.concatenate(([0], doc_end[:-1] + 1))[doc] if n else doc
    return Lines(doc[keep], (first - at)[keep], (end - at)[keep], own[keep].astype(np.float32))


def chain_features(x: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Features of each line with those of its neighbours in the document."""
    n = len(x)
    inside = np.zeros(n + 1, bool)
    inside[1:n] = doc[1:] == doc[:-1]
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:][inside[1:n]] = x[:-1][inside[1:n]]
    after[:-1][inside[1:n]] = x[1:][inside[1:n]]
    return np.column_stack([x, before, after, ~inside[:n], ~inside[1:], np.ones(n, bool)]).astype(np.float32)


# ---- the chain


class Chains:
    """Chains of lines side by side, the longest first, so that step t works on those that are longer than t."""

    def __init__(self, doc: np.ndarray):
        first = np.flatnonzero(np.diff(doc, prepend=-1)) if len(doc) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(doc)))
        order = np.argsort(-size, kind="stable")
        self.first, self.size = first[order], size[order]
        self.longest = int(size.max(initial=0))
        self.active = [int(np.searchsorted(-self.size, -t, side="left")) for t in range(self.longest)]

    def sums(self, good: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(forward, backward) log sums per line and label, and each chain's log total. ``good``: each line's log-odds;
        ``step[i, j]``: weight of label j after label i."""
        n = len(good)
        emit = np.column_stack([np.zeros(n), good])
        forward, backward = emit.copy(), np.zeros((n, 2))
        for t in range(1, self.longest):
            at = self.first[: self.active[t]] + t
            for j in (0, 1):
                forward[at, j] += np.logaddexp(forward[at - 1, 0] + step[0, j], forward[at - 1, 1] + step[1, j])
        for t in range(self.longest - 2, -1, -1):
            at = self.first[: self.active[t + 1]] + t
            nxt = emit[at + 1] + backward[at + 1]
            for i in (0, 1):
                backward[at, i] = np.logaddexp(step[i, 0] + nxt[:, 0], step[i, 1] + nxt[:, 1])
        ends = self.first + self.size - 1
        return forward, backward, np.logaddexp(forward[ends, 0], forward[ends, 1])

    def marginals(self, good: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Probability of each line to be good."""
        forward, backward, _ = self.sums(good, step)
        a = forward + backward
        return 1.0 / (1.0 + np.exp(np.clip(a[:, 0] - a[:, 1], -700, 700)))


def likelihood(w: np.ndarray, step: np.ndarray, x: np.ndarray, doc: np.ndarray, chains: Chains, label: np.ndarray, weight: np.ndarray):
    """(weighted mean log-likelihood per line of each document, its gradient in w and step). ``label`` and ``weight`` by line."""
    good = x @ w
    forward, backward, total = chains.sums(good, step)
    per_chain = weight[chains.first] / chains.size
    log_total = np.zeros(len(good))
    for t in range(chains.longest):
        log_total[chains.first[: chains.active[t]] + t] = total[: chains.active[t]]
    scale = weight / np.bincount(doc)[doc]
    p = np.exp(np.clip(forward[:, 1] + backward[:, 1] - log_total, -700, 0))
    value = float((good * label * scale).sum() - (total * per_chain).sum())
    to = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    g_step = np.zeros((2, 2))
    for i in (0, 1):
        for j in (0, 1):
            joint = forward[to - 1, i] + step[i, j] + (good[to] if j else 0) + backward[to, j] - log_total[to]
            here = (label[to - 1] == i) & (label[to] == j)
            value += step[i, j] * float((here * scale[to]).sum())
            g_step[i, j] = ((here - np.exp(np.clip(joint, -700, 0))) * scale[to]).sum()
    return value, x.T @ ((label - p) * scale), g_step


@dataclass
class Model:
    """Weights of the standardised features, of the steps, and the share of good documents (the score of a text without lines)."""

    w: np.ndarray
    step: np.ndarray
    prior: float


def train(x: np.ndarray, doc: np.ndarray, label: np.ndarray, weight: np.ndarray, iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """(w, step) by Adam on the penalised likelihood, the same for the same rows."""
    mean, sd = x.mean(axis=0), x.std(axis=0)
    flat = sd < 1e-6
    mean[flat], sd[flat] = 0.0, 1.0
    z = ((x - mean) / sd).astype(np.float64)
    chains = Chains(doc)
    weight = weight / weight[chains.first].sum()
    theta = np.zeros(z.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, iterations + 1):
        _, g, gs = likelihood(theta[:-4], theta[-4:].reshape(2, 2), z, doc, chains, label, weight)
        g = np.concatenate((g, gs.ravel())) - PENALTY * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + RATE * (1 - (i - 1) / iterations) * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    w = theta[:-4] / sd
    w[-1] -= float((w * mean).sum())  # the constant feature takes up the means
    return w, theta[-4:].reshape(2, 2)


# ---- Spark


def held_out(id_col: str = "doc_id") -> Column:
    """The fifth of the rows that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _features():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets, SLICE_SIZE, SLICE_ROWS):
                got = line_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                n = np.bincount(got.doc, minlength=j - i)
                some = np.flatnonzero((n > 0) & (n <= FIT_LINES))
                cut = np.concatenate(([0], np.cumsum(n)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(i, j - i).take(pa.array(some)), batch.column("order").slice(i, j - i).take(pa.array(some)), pa.array([got.x[cut[d] : cut[d + 1]].astype("<f4").tobytes() for d in some], pa.binary())],
                    names=["label", "order", "x"],
                )

    return run


def _fit_sample(rows_of: dict[int, int], iterations: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "label", "x"])
        parts = [np.frombuffer(b, "<f4").reshape(-1, _OWN) for b in pdf["x"]]
        size = np.array([len(p) for p in parts])
        doc = np.repeat(np.arange(len(parts)), size)
        per_doc = pdf["label"].to_numpy()
        share = {k: n / max(1, int((per_doc == k).sum())) for k, n in rows_of.items()}
        weight = np.array([share[k] for k in per_doc.tolist()])
        label = np.repeat(per_doc, size).astype(np.float64)
        w, step = train(chain_features(np.concatenate(parts), doc), doc, label, np.repeat(weight, size), iterations)
        return pd.DataFrame({"w": [w.tolist()], "step": [step.ravel().tolist()]})

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, iterations: int = ITERATIONS) -> Model:
    """Learn from the labelled rows (``label_col`` 0 or 1, others and null are not labels) of both tables.

    The driver gets two counts, at most twice ``sample`` hashes and the weights, whatever the size of the tables.
    Labels of one kind only, or none, give a model without weights: every text scores the share of label 1, or 1/2.
    """
    marked = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    rows_of = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = rows_of.get(1, 0) / sum(rows_of.values()) if rows_of else 0.5
    empty = Model(np.zeros(FEATURES), np.zeros((2, 2)), prior)
    if len(rows_of) < 2:
        return empty
    order = F.xxhash64(F.lit(12), "id")
    ranked = marked.distinct().withColumn("order", order).withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("order", "id")))
    # at most 2 * sample rows: a bound for the broadcast
    chosen = F.broadcast(ranked.filter(F.col("r") <= sample).select("id", "label", "order"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id").select("label", "order", "text")
    # rows that repeat an id are learned once
    seen = texts.mapInArrow(_features(), "label int, order long, x binary").groupBy("label", "order").agg(F.min("x").alias("x"))
    got = seen.groupBy(F.lit(1).alias("one")).applyInPandas(_fit_sample(rows_of, iterations), "w array<double>, step array<double>").collect()
    if not got:
        return empty
    return Model(np.array(got[0]["w"]), np.array(got[0]["step"]).reshape(2, 2), prior)


_LINES = "array<struct<start:int,end:int,good:double>>"


def score(docs: DataFrame, model: Model, keys: list[str], text_col: str = "text") -> DataFrame:
    """One row per document: its ``keys``, ``score`` (0 to 1) and ``lines`` (code points ``start`` to ``end`` of every
    line with a word, and its probability of being ``good``).

    A null text, or one without a word, has no lines and scores the share of good documents among the
    labels. Repeated rows are judged one by one and alike. Only the keys and the text go
    through Python, and the text does not come back; other columns are not read. Memory follows the longest text.
    """
    plain = docs.select(F.struct(*[F.col(f"`{k}`") for k in keys]).alias("keys"), F.col(f"`{text_col}`").alias("text"))
    schema = plain.select("keys", F.lit(0.0).alias("score"), F.lit(None).cast(_LINES).alias("lines")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("good", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = shared.value
        w, step = model_.w.astype(np.float32), model_.step
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets, SLICE_SIZE, SLICE_ROWS):
                part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                got = line_features(part, off)
                good = (chain_features(got.x, got.doc) @ w).astype(np.float64)
                p = Chains(got.doc).marginals(good, step) if model_.w.any() else np.full(len(good), model_.prior)
                size = (got.end - got.start).astype(np.float64)
                mass = np.bincount(got.doc, weights=size, minlength=j - i)
                total = np.bincount(got.doc, weights=size * p, minlength=j - i)
                value = np.where(mass > 0, np.clip(total / np.maximum(mass, 1), 0, 1), model_.prior)
                # code points up to a byte: those that start before it
                points = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
                place = lambda at: (points[off[got.doc] + at] - points[off[got.doc]]).astype(np.int32)  # noqa: B023, E731
                spans = pa.StructArray.from_arrays([pa.array(place(got.start)), pa.array(place(got.end)), pa.array(p)], fields=list(span))
                cut = np.concatenate(([0], np.cumsum(np.bincount(got.doc, minlength=j - i)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("keys").slice(i, j - i), pa.array(value), pa.ListArray.from_arrays(pa.array(cut), spans)], names=["keys", "score", "lines"])

    return plain.mapInArrow(run, schema).select("keys.*", "score", "lines")
