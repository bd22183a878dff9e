"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the word windows of the benchmark items; the alphabet is whole
words. For each pattern length m there is a shift table over blocks of two
words: the scan of a text looks at the block that ends at its cursor and jumps
as far as no pattern could end; only a shift of zero opens the bucket of
patterns with that last block, whose members are then compared directly, byte
for byte. All cursors of a batch of texts move together (numpy), so the scan has
no per-word Python.

The windows are the stated query set. They are counted first: up to
``max_windows`` they are compiled and broadcast at once; beyond that the texts
are scanned in rounds, one block of windows each, with the hits found so far
written to the shared folder between rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, ascii_lower, byte_table, materialise, mix64, rows_with_text, slices, spread, text_bytes, text_of

WINDOW_WORDS = 10
MAX_WINDOWS = 500_000
#: Word characters after lower-casing: digits, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TRANSLATION, _FLAGS = byte_table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
_TABLE_BITS = 18
_STRETCH = 256


def item_windows(benchmark: DataFrame, window_words: int = WINDOW_WORDS, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, window): the distinct windows of every item, words joined by one
    space. Items of fewer words are one window; items without words have none."""
    words = benchmark.select(
        F.col(id_col).cast("string").alias("item"),
        F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(WORD), F.lit(0)).alias("w"),
    ).filter(F.size("w") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window_words + 1))
    return words.select("item", "w", F.explode(at).alias("i")).select("item", F.array_join(F.slice("w", F.col("i"), F.lit(window_words)), " ").alias("window")).distinct()


class Patterns:
    """Wu-Manber tables for the windows of one length (in words)."""

    def __init__(self, windows: list[bytes], length: int):
        self.length, self.block = length, min(2, length)
        w = _words_of(windows)
        ids = _word_ids(w).reshape(len(windows), length)
        self.text = windows
        top = length - self.block + 1
        self.shift = np.full(1 << _TABLE_BITS, top, np.uint16)
        for q in range(self.block - 1, length):
            np.minimum.at(self.shift, _block(ids, q, self.block), np.uint16(length - 1 - q))
        last = _block(ids, length - 1, self.block)
        # suffix buckets: patterns sorted by the hash of their last block
        order = np.argsort(last, kind="stable")
        self.members = order.astype(np.int64)
        self.opens = np.searchsorted(last[order], np.arange((1 << _TABLE_BITS) + 1)).astype(np.int64)
        #: hash of the first block, compared before the bytes are
        self.prefix = _block(ids, self.block - 1, self.block)

    def search(self, w: Words, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of every occurrence in the texts of ``w``."""
        m = self.length
        counts = np.maximum(np.diff(w.bounds) - m + 1, 0)
        # stretches of at most _STRETCH possible ends each, so that the cursors
        # of long and short texts finish about together
        parts = -(-counts // _STRETCH)
        text = np.repeat(np.arange(len(counts)), parts)
        begin = (np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)) * _STRETCH
        cursor = w.bounds[:-1][text] + begin + m - 1
        stop = np.minimum(cursor + _STRETCH, w.bounds[1:][text])
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(cursor):
            key = _block_at(ids, cursor, self.block)
            step = self.shift[key].astype(np.int64)
            hit = step == 0
            if hit.any():
                found.append((cursor[hit], key[hit]))
            cursor = cursor + np.maximum(step, 1)
            alive = cursor < stop
            cursor, stop = cursor[alive], stop[alive]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        end, key = (np.concatenate(x) for x in zip(*found))
        size = self.opens[key + 1] - self.opens[key]
        first = np.repeat(end - m + 1, size)
        member = self.members[spread(self.opens[key], size)]
        same = _block_at(ids, first + self.block - 1, self.block) == self.prefix[member]
        first, member = first[same], member[same]
        norm, text = w.norm, self.text
        a, b = w.start[first].tolist(), w.end[first + m - 1].tolist()
        equal = np.fromiter((norm[x:y] == text[p] for x, y, p in zip(a, b, member.tolist())), bool, len(a))
        return first[equal], member[equal]


def _words_of(texts: list[bytes]) -> Words:
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    return Words(np.frombuffer(b"".join(texts), np.uint8), off, _TRANSLATION, _FLAGS)


def _word_ids(w: Words) -> np.ndarray:
    """A 64-bit id per word: differences of a running polynomial, brought back to
    a common power. Equal words have equal ids; others may rarely share one,
    which only costs a comparison."""
    data = np.frombuffer(w.norm, np.uint8)
    base = np.uint64(0x9E3779B97F4A7C15)
    up = _powers(int(base), len(data) + 1)
    down = _powers(pow(int(base), -1, 1 << 64), len(data) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)))
    return mix64((total[w.end] - total[w.start]) * down[w.start])


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept per process."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, np.uint64)
        while len(have) < n:
            have = np.concatenate((have, have * np.uint64(pow(base, len(have), 1 << 64))))
        if n <= 1 << 23:
            _POWERS[base] = have
    return have[:n]


def _fold(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def _block(ids: np.ndarray, q: int, block: int) -> np.ndarray:
    if block == 1:
        return _fold(ids[:, q])
    return _fold(mix64(ids[:, q - 1] * np.uint64(3) + ids[:, q]))


def _block_at(ids: np.ndarray, at: np.ndarray, block: int) -> np.ndarray:
    if block == 1:
        return _fold(ids[at])
    return _fold(mix64(ids[at - 1] * np.uint64(3) + ids[at]))


def compile_windows(rows: list[tuple[str, str]]) -> tuple[list[Patterns], list[list[list[str]]]]:
    """Tables per window length, and the items of each pattern."""
    items: dict[bytes, list[str]] = {}
    for item, window in rows:
        items.setdefault(window.encode(), []).append(item)
    by_length: dict[int, list[bytes]] = {}
    for window in sorted(items):
        by_length.setdefault(window.count(b" ") + 1, []).append(window)
    groups = [Patterns(v, k) for k, v in sorted(by_length.items())]
    return groups, [[items[p] for p in g.text] for g in groups]


def find_hits(data: np.ndarray, offsets: np.ndarray, groups: list[Patterns], owners: list[list[list[str]]]) -> Iterator[tuple[int, list[list[int]], list[str]]]:
    """Per text: number of words, merged hit runs [first word, end), items."""
    for i, j in slices(offsets):
        w = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], _TRANSLATION, _FLAGS)
        ids = _word_ids(w)
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for g, own in zip(groups, owners):
            first, pattern = g.search(w, ids)
            texts = np.searchsorted(w.bounds, first, side="right") - 1
            for f, p, t in zip((first - w.bounds[texts]).tolist(), pattern.tolist(), texts.tolist()):
                spans.setdefault(t, []).append((f, f + g.length))
                items.setdefault(t, set()).update(own[p])
        sizes = np.diff(w.bounds).tolist()
        for t, n in enumerate(sizes):
            yield n, merge(spans.get(t, [])), sorted(items.get(t, ()))


def merge(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


_RUNS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    max_windows: int = MAX_WINDOWS,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``row`` (struct of the input columns ``keep``, all by default, whatever their
    names), ``n_words``, ``hits`` (merged runs of hit words), ``items`` (ids of the
    items with an occurring window, as strings in order).

    Null and empty texts have no words; an empty benchmark hits nothing; items
    with null id or text have no window; repeated rows are judged one by one.
    Memory per task follows the longest text and ``max_windows``.
    """
    windows = materialise(item_windows(benchmark.filter(F.col(item_col).isNotNull()), window_words, item_col, item_text_col), "windows")
    n = windows.count()
    rounds = max(1, -(-n // max_windows))
    out = docs.select(
        *rows_with_text(docs, text_col, keep),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_RUNS).alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    sc = docs.sparkSession.sparkContext
    for k in range(rounds):
        block = windows.filter(F.pmod(F.xxhash64("item", "window"), F.lit(rounds)) == k) if rounds > 1 else windows
        tables = sc.broadcast(compile_windows([(r[0], r[1]) for r in block.collect()]))
        if k < rounds - 1:
            out = materialise(out.mapInArrow(_scan(tables, text_col, out.columns), out.schema), "hits")
        else:
            result = ["row", "n_words", "hits", "items"]
            out = out.mapInArrow(_scan(tables, text_col, result), out.select(*result).schema)
    return out


def _scan(tables, text_col: str, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, owners = tables.value
        for batch in batches:
            data, offsets = text_bytes(text_of(batch, text_col))
            n_words, hits, items = [], [], []
            for (n, h, own), old_h, old_own in zip(find_hits(data, offsets, groups, owners), batch.column("hits").to_pylist(), batch.column("items").to_pylist()):
                if old_h:
                    h = merge([*h, *([x["first"], x["end"]] for x in old_h)])
                if old_own:
                    own = sorted({*own, *old_own})
                n_words.append(n)
                hits.append([{"first": a, "end": b} for a, b in h])
                items.append(own)
            s = batch.schema
            new = {"n_words": pa.array(n_words, pa.int64()), "hits": pa.array(hits, s.field("hits").type), "items": pa.array(items, s.field("items").type)}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in columns], names=columns)

    return run


def hit_words(hits: str = "hits"):
    """Number of words that the merged runs cover."""
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["first"])
