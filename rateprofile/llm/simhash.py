"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: 64-bit SimHash over word shingles (XXH64, seed 42). Equal
fingerprints are grouped first, so a group of copies is one value from there on.

Candidates: every bit position i gets a non-zero code c(i) of r + 1 bits, and for
each of the 2^(r+1) - 1 non-zero vectors v the mask of v has the bits i with odd
parity of c(i) & v. If two values differ in at most r positions, the codes of these
span at most r dimensions, so some v is orthogonal to all of them: both agree
on the mask of that v and share its bucket. No pair within the radius is missed.

Buckets: one with up to ``bucket_limit`` values is compared in one piece, and
yields a spanning forest of its links (never all pairs). A larger one is
covered again on the bits outside its mask; after ``LEVELS`` covers only about
a dozen bits are free, so a bucket is bounded by construction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_table, materialise, slices, text_bytes, whole_row, Words

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
BUCKET_LIMIT = 512
LEVELS = 3
#: Words are runs of anything but space and the controls 9 to 13.
_TRANSLATION, _FLAGS = byte_table(lambda b: b != 32 and not 9 <= b <= 13)
#: byte -> its 8 bits in 8 lanes of a 64-bit counter
_LANES = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def fingerprint_texts(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """SimHash of every text; a text without words has 0."""
    out = [np.zeros(0, np.uint64)]
    for i, j in slices(offsets):
        w = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], _TRANSLATION, _FLAGS)
        words = np.diff(w.bounds)
        counts = np.where(words == 0, 0, np.maximum(words - shingle + 1, 1))
        text = np.repeat(np.arange(len(counts)), counts)
        first = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + w.bounds[:-1][text]
        last = np.minimum(first + shingle, w.bounds[1:][text]) - 1
        norm, one = w.norm, xxhash.xxh64_intdigest
        h = np.fromiter((one(norm[a:b], SEED) for a, b in zip(w.start[first].tolist(), w.end[last].tolist())), np.uint64, len(first))
        out.append(_majority(h, counts))
    return np.concatenate(out)


def _majority(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text, the bits set in over half of its hashes."""
    full = np.flatnonzero(counts)
    ones = np.zeros((len(counts), 64), np.int64)
    if len(full):
        begin = (np.cumsum(counts) - counts)[full]
        # 8-bit lanes hold up to 255 hashes: add in runs of 255
        runs = -(-counts[full] // 255)
        owner = np.repeat(np.arange(len(full)), runs)
        at = np.repeat(begin, runs) + 255 * (np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs))
        opens = np.cumsum(runs) - runs
        octets = h.astype("<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            lanes = np.add.reduceat(_LANES[octets[:, k]], at)
            each = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
            ones[full, 8 * k : 8 * k + 8] = np.add.reduceat(each, opens, axis=0)
    bits = ones * 2 > counts[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Input rows as struct ``row`` and their ``fingerprint`` (long, as raw bits)."""
    out = docs.select(whole_row(docs), F.lit(0).cast("long").alias("fingerprint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            fp = fingerprint_texts(*text_bytes(row.field(text_col)), shingle)
            yield pa.RecordBatch.from_arrays([row, pa.array(fp.view(np.int64))], names=["row", "fingerprint"])

    return out.mapInArrow(run, out.schema)


def masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """The covering masks over the given bit positions."""
    codes = (1 << (radius + 1)) - 1
    return [sum(1 << b for i, b in enumerate(bits) if bin((1 + i % codes) & v).count("1") % 2) for v in range(1, codes + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _mask_table(spark, level: int, radius: int) -> DataFrame:
    """The masks of a level, one row per path (the masks chosen so far, as one
    number): (radius-dependent constant) ** level rows, whatever the data."""
    paths = {1: list(range(64))}
    for _ in range(level):
        paths = {p * 256 + v: [b for b in free if not m >> b & 1] for p, free in paths.items() for v, m in enumerate(masks(free, radius))}
    rows = []
    for p, free in paths.items():
        fixed = sum(1 << b for b in range(64) if b not in set(free))
        rows.append((p, [(p * 256 + v, _signed(fixed | m)) for v, m in enumerate(masks(free, radius))]))
    return spark.createDataFrame(rows, "path long, covers array<struct<path:long,mask:long>>")


def links(fingerprints: DataFrame, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(a, b), a < b as signed longs: links within ``radius`` that connect whatever
    is connected. ``fingerprints``: one distinct long column ``fp``."""
    spark = fingerprints.sparkSession
    rows = fingerprints.select("fp", F.lit(1).cast("long").alias("path"))
    found = None
    for level in range(LEVELS):
        covers = F.broadcast(_mask_table(spark, level, radius))
        rows = rows.join(covers, "path").select("fp", F.explode("covers").alias("c"))
        rows = rows.select("fp", "c.path", F.col("fp").bitwiseAND(F.col("c.mask")).alias("key"))
        last = level == LEVELS - 1
        sizes = rows.groupBy("path", "key").agg(F.count("*").alias("n")).filter("n > 1")
        small = rows.join(sizes if last else sizes.filter(F.col("n") <= bucket_limit), ["path", "key"])
        packed = small.groupBy("path", "key").agg(F.collect_list("fp").alias("fps")).select("fps")
        part = packed.mapInArrow(_forest(radius), "a long, b long")
        found = part if found is None else found.unionByName(part)
        if not last:
            large = materialise(sizes.filter(F.col("n") > bucket_limit).select("path", "key"), "large-buckets")
            if large.isEmpty():
                break
            rows = materialise(rows.join(large, ["path", "key"]).select("fp", "path").distinct(), "large-values")
    return found.distinct()


def _forest(radius: int):
    """Spanning forests of the values within the radius, bucket by bucket. Values
    are compared with a block of others at a time; linked ones are not again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            for fps in batch.column(0):
                v = np.unique(np.asarray(fps.values))
                for x, y in _span(v, radius):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _span(v: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Breadth-first: each value is met once, with the values not yet met."""
    left = v
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count((left ^ x).view(np.uint64)) <= radius
            if near.any():
                for y in left[near].tolist():
                    yield (min(int(x), y), max(int(x), y))
                    queue.append(np.int64(y))
                left = left[~near]


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components by alternating large-star and small-star
    steps; the root is the smallest node. Each step's links are written to the
    shared folder. Joins and grouped minima only, so a hub is no single group."""
    edges = materialise(edges.select("a", "b"), "links")
    if edges.isEmpty():
        return edges.selectExpr("a as node", "b as root")
    state = None
    while True:
        both = edges.unionByName(edges.selectExpr("b as a", "a as b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours of a go to the smallest of a's star
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("x"), F.col("m").alias("y")).filter("x > y").distinct()
        large = materialise(large, "stars")
        # small star: smaller neighbours of x, and x, go to the smallest of them
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        moved = large.join(least, "x")
        small = moved.select(F.col("y").alias("b"), F.col("m").alias("a")).unionByName(moved.select(F.col("x").alias("b"), F.col("m").alias("a"))).filter("a < b").distinct()
        edges = materialise(small.select("a", "b"), "links")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if now == state:
            return edges.selectExpr("b as node", "a as root").unionByName(edges.selectExpr("a as node", "a as root").distinct())
        state = now


def label(ids: DataFrame, radius: int = RADIUS, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """(fingerprint, group, component_id) for rows (id, fingerprint): ``group`` is a
    number per component, ``component_id`` its smallest id (null if all are)."""
    values = materialise(ids.groupBy("fingerprint").agg(F.min("id").alias("low")), "fingerprints")
    roots = components(links(values.select(F.col("fingerprint").alias("fp")), radius, bucket_limit))
    tagged = values.join(roots, values["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "low", F.coalesce("root", "fingerprint").alias("group")
    )
    smallest = tagged.groupBy("group").agg(F.min("low").alias("component_id"))
    return tagged.join(smallest, "group").select("fingerprint", "group", "component_id")


def hex_fingerprint(col: str = "fingerprint") -> Column:
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (long), ``group``,
    ``component_id``.

    Null, empty and wordless texts have fingerprint 0 and are linked like any
    other; repeated rows and tied ids stay, each with its group; an empty table gives
    an empty result. Other columns of the input play no part, whatever their names.
    """
    prints = with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", shingle)
    ids = materialise(prints.select("row.id", "fingerprint"), "prints")
    return ids.join(label(ids, radius), "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "group", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The document with the smallest id (null last) of every group, in its input columns. Ties
    of id within a group are broken by a hash of the row; exact copies of that row
    leave one."""
    row_hash = F.xxhash64(whole_row(docs))
    keyed = docs.select(whole_row(docs), F.col(id_col).alias("id"), row_hash.alias("key"))
    prints = with_fingerprint(keyed.select("id", "key", F.col(f"row.{text_col}").alias("text")), "text", shingle)
    ids = materialise(prints.select("row.id", "row.key", "fingerprint"), "prints")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
    tagged = ids.groupBy("fingerprint").agg(best.alias("best")).join(label(ids, radius), "fingerprint")
    kept = tagged.groupBy("group").agg(F.min("best").alias("best")).select(F.col("best.id").alias("id"), F.col("best.key").alias("key")).distinct()
    alone = keyed.alias("d").join(kept.alias("k"), F.col("d.id").eqNullSafe(F.col("k.id")) & (F.col("d.key") == F.col("k.key")), "left_semi")
    # rows that are equal in every column share id and key
    return alone.groupBy("id", "key").agg(F.first("row").alias("row")).select("row.*")
