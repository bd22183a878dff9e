"""Removal of byte strings that occur more than once, by bucket refinement of a
sparse suffix array.

Suffixes: only the suffixes at anchors are kept. The anchor of a window of ``length`` bytes is the position in it with
the smallest q-gram bucket number (ties to the left); equal windows hold it at the same place. An anchor stands
for the windows it is the anchor of, a run of neighbouring ones; their union is its context.
About one suffix per 80 bytes stands for all of them.

Buckets: the initial bucket of a position is its q-gram. A bucket number is a 64-bit hash of
what it stands for, so numbers need no renumbering between tasks. Deeper
numbers come from pairs of earlier ones, (bucket of p, bucket of p + q), and these are reused for
the next depth: q, 2q, 4q. Grouping by a number is the sort of that round.

Rounds: (1) anchors alone in their q-gram bucket are done. (2) Buckets are refined by the numbers at all later
(and earlier) offsets of the anchor's context: where a context occurs again, each of its bytes is covered.
(3) One context of each kind is kept with its bytes, if some of its bucket occur once. Its windows are taken in stretches of
``WIDTHS``[0], then those that stay open in stretches of ``WIDTHS``[1], and so on down to single windows. In each of these
rounds the core that all windows of a stretch share refines the bucket: alone in it, none of the windows occurs again; if what
the windows cover is the same in the whole bucket, all of them do; else the stretch stays open. Every bucket goes
this way, whatever its size. Rounds move numbers and places, not bytes: the contexts are written once, in buckets of
documents, and each round brings the open stretches to them. All joins are on bucket numbers with one row per number on the
other side; numbers that hold more than a thousandth of the rows are dealt over ``SALTS`` parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.bucketed import write_bucketed
from .common import materialise, mix64, new_path, slices, text_bytes

LENGTH = 200
GRAM = 40
#: Windows in a stretch, round by round: each width a multiple of the next, the last 1.
WIDTHS = (25, 5, 1)
#: Contexts in a file of theirs.
FILE_CONTEXTS = 50_000
#: Parts over which the rows of a number are dealt that holds more than 1 / HOT of all rows (fewer than HOT numbers do).
SALTS, HOT = 64, 1000
_BASE = 0xD6E8FEB86659FD93


def _doubled(a: np.ndarray, step: int) -> np.ndarray:
    """Bucket numbers of twice the depth: a[p] and a[p + step] as one polynomial value."""
    return a[: len(a) - step] * np.uint64(pow(_BASE, step, 1 << 64)) + a[step:]


def gram_buckets(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """The bucket number of the q-gram at every position."""
    if len(data) < gram:
        return np.zeros(0, np.uint64)
    one, depth = data.astype(np.uint64) + np.uint64(1), 1
    got, have = None, 0
    left = gram
    while left:
        if left & 1:
            got = one if got is None else _append(got, have, one, depth)
            have += depth
        left >>= 1
        if left:
            one = _doubled(one, depth)
            depth *= 2
    return mix64(got)


def _append(got: np.ndarray, have: int, more: np.ndarray, depth: int) -> np.ndarray:
    """Numbers of depth have + depth from those of the two depths."""
    n = min(len(got), len(more) - have)
    return got[:n] * np.uint64(pow(_BASE, depth, 1 << 64)) + more[have : have + n]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * np.uint64(0x9E3779B97F4A7C15) + mix64(b + np.uint64(0xA0761D6478BD642F)))


def anchors(buckets: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions (in the buffer) of the anchors of all texts, with the first and the last of the windows they are the anchor of."""
    w = length - gram + 1
    n = len(buckets) - w + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none
    bits = max(1, int(len(buckets)).bit_length())
    key = (buckets >> np.uint64(bits) << np.uint64(bits)) | np.arange(len(buckets), dtype=np.uint64)
    low, depth = key, 1
    while depth * 2 <= w:
        low = np.minimum(low[: len(low) - depth], low[depth:])
        depth *= 2
    low = np.minimum(low[:n], low[w - depth : w - depth + n])
    # windows that lie within one text
    text_of_end = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    window = np.flatnonzero(text_of_end[:n] == text_of_end[length - 1 : length - 1 + n])
    at = (low[window] & np.uint64((1 << bits) - 1)).astype(np.int64)
    p, first, times = np.unique(at, return_index=True, return_counts=True)
    # the windows with one smallest position are neighbours
    return p, window[first], window[first + times - 1]


def context_numbers(buckets: np.ndarray, lo: np.ndarray, hi: np.ndarray, before: np.ndarray, longest: int, gram: int) -> np.ndarray:
    """One number per context [lo, hi): its q-gram buckets at all later offsets, with
    its length and the anchor's place in it."""
    number = mix64((before * 100_003 + (hi - lo)).astype(np.uint64))
    for step in range(0, longest, gram):
        at = np.minimum(lo + step, hi - gram)
        number = _pair(number, buckets[at])
    return number


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            keys, checks = batch.column("key"), batch.column("check")
            for i, j in slices(offsets):
                off = offsets[i : j + 1] - offsets[i]
                buckets = gram_buckets(data[offsets[i] : offsets[j]], gram)
                p, lo, last = anchors(buckets, off, length, gram)
                if not len(p):
                    continue
                text = np.searchsorted(off, p, side="right") - 1
                hi = last + length
                c = context_numbers(buckets, lo, hi, p - lo, 2 * length - gram, gram)
                rows = pa.array(text + i)
                places = [pa.array((x - off[text]).astype(np.int32)) for x in (p, lo, hi)]
                yield pa.RecordBatch.from_arrays([pa.array(buckets[p].view(np.int64)), pa.array(c.view(np.int64)), keys.take(rows), checks.take(rows), *places], names=["bucket", "context", "key", "check", "pos", "lo", "hi"])

    return run


def _contexts():
    """Documents with the places of contexts -> these with their bytes."""
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            out: dict[str, list] = {c: [] for c in ("bucket", "key", "check", "pos", "before", "bytes", "single")}
            for i, marks in enumerate(batch.column("marks").to_pylist()):
                a, key, check = int(offsets[i]), batch.column("key")[i].as_py(), batch.column("check")[i].as_py()
                for m in marks:
                    for c, v in zip(out, (m["bucket"], key, check, m["pos"], m["pos"] - m["lo"], raw[a + m["lo"] : a + m["hi"]], m["single"])):
                        out[c].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    return run


def _joined(batch: pa.RecordBatch, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(q-gram buckets, start, length, anchor) of the contexts of a batch, in one buffer."""
    data, off = text_bytes(batch.column("bytes"))
    before = batch.column("before").to_numpy(zero_copy_only=False).astype(np.int64)
    return gram_buckets(data, gram), off[:-1], np.diff(off), off[:-1] + before


def _string_numbers(buckets: np.ndarray, at: np.ndarray, size: np.ndarray, most: int, gram: int) -> np.ndarray:
    """Numbers of the strings of ``size`` bytes at ``at``: depths doubled where two q-grams
    suffice for the next depth, the last one overlapping."""
    number = mix64(size.astype(np.uint64))
    for step in range(0, most, gram):
        number = _pair(number, buckets[at + np.minimum(step, size - gram)])
    return number


def _stretches(length: int, gram: int, width: int, within: int):
    """Contexts -> a row per stretch of ``width`` windows, a .. b their distances from the anchor (as far as the context
    has them). Stretches lie on a grid within those of ``within``: the whole range in the first round, then the
    ``open`` ones. ``number``: the bucket refined by the core that all windows of the stretch share; ``span``: the number of
    all that they cover."""
    names = ["number", "span", "key", "check", "pos", "a", "b", "single"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, off = text_bytes(batch.column("bytes"))
            for i, j in slices(off):
                yield stretch(batch.slice(i, j - i))

    def stretch(batch: pa.RecordBatch) -> pa.RecordBatch:
        buckets, start, size, anchor = _joined(batch, gram)
        before = anchor - start
        if "open" in batch.schema.names:
            lists = batch.column("open")
            row = np.repeat(np.arange(len(start)), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            outer = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) // within * within
        else:
            row, outer = np.arange(len(start)), np.zeros(len(start), np.int64)
        steps = -(-within // width)
        row, a = np.repeat(row, steps), np.repeat(outer, steps) + np.tile(np.arange(steps) * width, len(outer))
        # the last stretch of an outer one, or of all windows, is shorter
        b = np.minimum(np.minimum(a + width - 1, a // within * within + within - 1), length - gram)
        first, last = np.maximum(a, length - (size[row] - before[row])), np.minimum(b, before[row])
        some = first <= last
        row, a, b, first, last = row[some], a[some], b[some], first[some], last[some]
        at = anchor[row]
        core = _string_numbers(buckets, at - a, length - (b - a), length, gram)
        span = _string_numbers(buckets, at - last, length + last - first, 2 * length, gram)
        span = _pair(span, (first * 100_003 + last).astype(np.uint64))
        own = batch.column("bucket").to_numpy(zero_copy_only=False).view(np.uint64)[row]
        number = _pair(_pair(own, core), (a * 100_003 + b).astype(np.uint64))
        take = pa.array(row)
        columns = [batch.column(c).take(take) for c in ("key", "check", "pos")]
        return pa.RecordBatch.from_arrays(
            [pa.array(number.view(np.int64)), pa.array(span.view(np.int64)), *columns, pa.array(first.astype(np.int16)), pa.array(last.astype(np.int16)), batch.column("single").take(take)],
            names=names,
        )

    return run


def _cut():
    """Documents with covered runs -> what is left of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            sizes, spans, kept = [], [], []
            for i, runs in enumerate(batch.column("runs").to_pylist()):
                text = raw[offsets[i] : offsets[i + 1]]
                merged: list[list[int]] = []
                for r in sorted((r["lo"], r["hi"]) for r in runs or ()):
                    if merged and r[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r[1])
                    else:
                        merged.append([*r])
                edges = [0, *(x for m in merged for x in m), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2])))
                sizes.append(len(text))
                spans.append([{"start": a, "end": b} for a, b in merged])
            schema = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(spans, schema), pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    return run


def _matched(rows: DataFrame, groups: DataFrame, keys: list[str], row_id: list[str]) -> DataFrame:
    """``rows`` that have their group in ``groups`` (one row per key, with its number of rows ``n``), with the other columns of
    it. A group with more than 1 / HOT of all rows is dealt over SALTS parts; there are fewer than HOT of these, listed in the plan."""
    total = groups.agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in groups.filter(F.col("n") * HOT > total).select(F.xxhash64(*keys)).distinct().collect()]
    if not hot:
        return rows.join(groups.drop("n"), keys)
    heavy, none = F.xxhash64(*keys).isin(hot), F.lit(0).cast("long")
    left = rows.withColumn("salt", F.when(heavy, F.pmod(F.xxhash64(*row_id), F.lit(SALTS))).otherwise(none))
    parts = F.when(heavy, F.sequence(none, F.lit(SALTS - 1).cast("long"))).otherwise(F.array(none))
    right = groups.withColumn("salt", F.explode(parts)).drop("n")
    return left.join(right, [*keys, "salt"]).drop("salt")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """One row per document: ``id_col``, ``n_bytes``, ``spans`` (maximal runs of bytes covered by a
    string of ``length`` bytes that starts anywhere else too), ``kept`` (the other bytes).

    Null is an empty text; texts shorter than ``length`` stay whole; repeated rows
    are repeats of each other, so both lose all they share; ids may be null or
    repeated (rows are told apart by id and a hash of the text). An empty table
    gives an empty result; other columns play no part. Memory per task follows
    the longest text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(id_col, text_col).alias("key"), F.xxhash64(F.lit(7), text_col, id_col).alias("check"), text.alias("text")
    )
    at = ["key", "check"]
    long_enough = base.filter(F.octet_length("text") >= length).select(*at, "text")
    suffixes = long_enough.mapInArrow(_anchor_rows(length, gram), "bucket long, context long, key long, check long, pos int, lo int, hi int")
    # round 1: buckets with more than one anchor
    per_bucket = suffixes.groupBy("bucket").agg(F.count("*").alias("n"), (F.min("context") == F.max("context")).alias("same"))
    again = materialise(per_bucket.filter("n > 1"), "buckets")
    shared = materialise(_matched(suffixes, again, ["bucket"], [*at, "pos"]), "shared-anchors")
    # round 2: contexts that occur again
    mixed = shared.filter("not same")
    counted = materialise(mixed.groupBy("bucket", "context").agg(F.count("*").alias("n"), F.min(F.struct(*at, "pos", "lo", "hi")).alias("one")), "contexts")
    repeated = materialise(counted.filter("n > 1").select("bucket", "context", "n"), "repeated-contexts")
    whole = shared.filter("same").select(*at, "lo", "hi").unionByName(_matched(mixed, repeated, ["bucket", "context"], [*at, "pos"]).select(*at, "lo", "hi"))
    runs = whole.select(*at, F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"))
    # round 3: one context of each kind, in the buckets where some occur once, taken from the texts once
    some = materialise(counted.groupBy("bucket").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter("least = 1"), "kinds")
    kinds = _matched(counted, some.select("bucket", F.col("kinds").alias("n")), ["bucket"], ["context"])
    n = int(some.agg(F.sum("kinds")).first()[0] or 0)
    if n:
        files = max(8, -(-n // FILE_CONTEXTS))
        contexts = _written_contexts(base, kinds, at, files)
        within, open_ = length - gram + 1, None
        for width in widths:
            found, open_ = _round(contexts, open_, at, files, length, gram, width, within)
            runs, within = runs.unionByName(found), width
    runs = runs.groupBy(*at).agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))
    done = base.join(runs, at, "left")
    out = done.mapInArrow(_cut(), "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return out.select(F.col("id").alias(id_col), "n_bytes", "spans", "kept")


def _written_contexts(base: DataFrame, kinds: DataFrame, at: list[str], files: int) -> DataFrame:
    """The contexts with their bytes, dealt by document into the files of a bucketed table."""
    mark = F.struct("one.pos", "one.lo", "one.hi", "bucket", (F.col("n") == 1).alias("single")).alias("m")
    marks = kinds.select("one.key", "one.check", mark).groupBy(*at).agg(F.collect_list("m").alias("marks"))
    both = base.repartition(files, *at).join(marks.repartition(files, *at), at).select(*at, "text", "marks")
    rows = both.mapInArrow(_contexts(), "bucket long, key long, check long, pos int, before int, bytes binary, single boolean")
    return write_bucketed(rows, new_path(base.sparkSession, "contexts"), at, files, [*at, "pos"], dealt=True)


def _round(contexts: DataFrame, open_: DataFrame | None, at: list[str], files: int, length: int, gram: int, width: int, within: int) -> tuple[DataFrame, DataFrame]:
    """(runs of windows that occur again, the stretches that stay open) of one round; ``open_``: those of the round before."""
    if open_ is not None:
        # the open stretches come to the contexts, whose bytes stay where they are
        marks = open_.groupBy(*at, "pos").agg(F.collect_list("a").alias("open"))
        contexts = contexts.join(marks.repartition(files, *at), [*at, "pos"])
    rows = contexts.mapInArrow(_stretches(length, gram, width, within), "number long, span long, key long, check long, pos int, a short, b short, single boolean")
    groups = rows.groupBy("number").agg(F.count("*").alias("n"), (F.min("span") == F.max("span")).alias("same"), F.max("single").alias("any"))
    # alone: does not occur again; without a single context among them: nothing to find out
    groups = materialise(groups.filter("n > 1 and any").drop("any"), "stretches")
    found = materialise(_matched(rows, groups, ["number"], [*at, "pos"]).drop("number", "span"), "found")
    place = F.col("pos").cast("long")
    runs = found.filter("same and single").select(*at, (place - F.col("b")).alias("lo"), (place - F.col("a") + length).alias("hi"))
    return runs, found.filter("not same").select(*at, "pos", "a")
