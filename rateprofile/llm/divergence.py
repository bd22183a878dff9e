"""Source divergence audit over hash-consed segment trees.

The counts of a (lang, source) group are the leaves of a segment tree over the kept
terms of its language. Equal subtrees, of one group or of several, are one
shared node. Two groups are compared by walking their trees together; a pair of nodes that was met
before is not walked again, it only counts once more, and so a pair of
equal counts is priced once however many terms have it. The sums add up over disjoint ranges of
terms: each task takes one range of one language, with the trees of all its groups.

All arithmetic is on integers. A term of a group with ``count`` occurrences has
p = 1 + floor(unit * (count + 1) / (N + V)), N being the group's occurrences of the language's
V kept terms; the price of p against q is floor((p - q)^2 / q).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES, byte_table, materialise, text_bytes

UNIT = 1_000_000_000
LEAST_DOCS = 3
TOP_TERMS = 200
#: Leaves of all trees of one range of terms; more cut the language into more ranges.
RANGE_LEAVES = 1 << 19
#: Node pairs walked at a time.
WALK = 1 << 19
#: (group, term) entries a task counts up before it hands them on.
ENTRIES = 400_000
#: Languages up to which their few numbers are broadcast; more are joined by a shuffle.
BROADCAST_LANGS = 10_000

_TABLE, _ = byte_table(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 0x80)


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a slice of it at a time."""
    text = text.translate(_TABLE)
    i = 0
    while i < len(text):
        j = text.find(b" ", i + SLICE_BYTES)
        j = len(text) if j < 0 else j
        yield text[i:j].split()
        i = j


def _count(entries: int):
    """(lang, source, term, occurrences, documents) of a task's rows, summed up as far as ``entries`` allows;
    a null term stands for the group itself."""
    names = ["lang", "source", "term", "n", "docs"]

    def emit(groups):
        for (lang, source), (n, docs) in groups.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(terms) + 1), pa.string()),
                    pa.array([source] * (len(terms) + 1), pa.string()),
                    pa.array([*terms, None], pa.binary()).cast(pa.string()),
                    pa.array([*n.values(), 0], pa.int64()),
                    pa.array([*(docs[t] for t in terms), 0], pa.int64()),
                ],
                names=names,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for key, a, b in zip(keys, offsets[:-1], offsets[1:]):
                n, docs = groups.setdefault(key, (Counter(), Counter()))
                held -= len(n)
                seen: set[bytes] = set()
                for part in _terms(data[a:b].tobytes()):
                    n.update(part)
                    seen.update(part)
                docs.update(seen)
                held += len(n)
                if held > entries:
                    yield from emit(groups)
                    groups, held = {}, 0
        yield from emit(groups)

    return run


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", entries: int = ENTRIES) -> DataFrame:
    """``lang``, ``term``, ``docs`` (documents of the language with the term) and ``cells`` (source, n of each
    group with the term); the null term lists the groups of the language."""
    plain = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    parts = plain.mapInArrow(_count(entries), "lang string, source string, term string, n long, docs long")
    # dealt by (lang, term) once: both sums below need no other shuffle
    cells = parts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return cells.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("cells"))


def shares(counts: np.ndarray, total: np.ndarray, unit: int = UNIT) -> np.ndarray:
    """1 + floor(unit * (count + 1) / total), exactly."""
    if counts.max(initial=0) + 1 < (1 << 62) // unit:
        return 1 + unit * (counts + 1) // total
    return np.array([1 + unit * (int(c) + 1) // int(t) for c, t in zip(counts.tolist(), np.broadcast_to(total, counts.shape).tolist())], np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Forest:
    """Segment trees over the same leaves, a row of counts per tree, in which equal subtrees are one node.

    ``nodes[h]`` has the node of each tree and position at height h, ``children[h]`` the two nodes of
    height h - 1 under each node of height h, ``values`` the count of each leaf node. Leaves that
    fill up to a power of two hold -1 and are worth nothing.
    """

    def __init__(self, counts: np.ndarray):
        trees, n = counts.shape
        size = 1 << max(0, int(n - 1).bit_length())
        full = np.full((trees, size), -1, np.int64)
        full[:, :n] = counts
        self.values, at = np.unique(full, return_inverse=True)
        self.nodes, self.children = [at.reshape(full.shape)], [np.zeros((0, 2), np.int64)]
        while self.nodes[-1].shape[1] > 1:
            below = self.nodes[-1]
            n_below = int(below.max()) + 1
            pairs, at = np.unique(below[:, 0::2] * n_below + below[:, 1::2], return_inverse=True)
            self.children.append(np.stack([pairs // n_below, pairs % n_below], axis=1))
            self.nodes.append(at.reshape(trees, -1))

    def leaf_pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the pairs of trees a[i], b[i]: (i, count of a, count of b, leaves where both occur together),
        from a walk down both trees that goes through each pair of nodes once."""
        which = np.arange(len(a))
        x, y, times = self.nodes[-1][a, 0], self.nodes[-1][b, 0], np.ones(len(a), np.int64)
        for h in range(len(self.nodes) - 1, 0, -1):
            n = int(self.nodes[h - 1].max()) + 1
            l, r = self.children[h][x], self.children[h][y]
            key = ((which[:, None] * n + l) * n + r).ravel()
            key, at = np.unique(key, return_inverse=True)
            times = np.bincount(at, weights=np.repeat(times, 2).astype(np.float64), minlength=len(key)).astype(np.int64)
            which, x, y = key // (n * n), key // n % n, key % n
        u, v = self.values[x], self.values[y]
        real = u >= 0
        return which[real], u[real], v[real], times[real]

    def occupied(self, trees: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tree, leaf) of all counts above 0 of the given trees, from a walk past the empty subtrees."""
        empty = self.values <= 0
        marks = [empty]
        for h in range(1, len(self.nodes)):
            empty = empty[self.children[h]].all(axis=1)
            marks.append(empty)
        tree, place = trees, np.zeros(len(trees), np.int64)
        for h in range(len(self.nodes) - 1, -1, -1):
            keep = ~marks[h][self.nodes[h][tree, place]]
            tree, place = tree[keep], place[keep]
            if h:
                tree, place = np.repeat(tree, 2), np.stack([2 * place, 2 * place + 1], axis=1).ravel()
        return tree, place


_OUT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _compare(unit: int, top: int, walk: int):
    """One range of a language's terms: the sums of all pairs of its groups, and each group's best terms."""

    def run(terms: pa.Table, groups: pa.Table) -> pa.Table:
        lang = groups.column("lang")[0].as_py()
        own = groups.column("source").to_pylist()
        total = groups.column("total").to_numpy()
        order = sorted(range(len(own)), key=lambda i: (own[i] is None, own[i] or ""))
        names, total = [own[i] for i in order][:-1], total[order]  # the language itself, without a source, is last
        s, n = len(names), terms.num_rows
        number = {x: i for i, x in enumerate(names)}
        cells = terms.column("cells").combine_chunks()
        cells = cells.chunk(0) if isinstance(cells, pa.ChunkedArray) and cells.num_chunks else cells
        counts = np.zeros((s + 1, n), np.int64)
        if n:
            flat = cells.flatten()
            column = np.repeat(np.arange(n), cells.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            coded = flat.field("source").dictionary_encode()
            row = np.array([number[x] for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
            np.add.at(counts, (row, column), flat.field("n").to_numpy(zero_copy_only=False))
            counts[s] = counts[:s].sum(axis=0)
        text = terms.column("term").to_pylist()
        # terms with like counts stand side by side, which lets more subtrees be equal
        by_size = sorted(range(n), key=lambda i: (-counts[s, i], text[i].encode()))
        counts, text = counts[:, by_size], [text[i] for i in by_size]
        a, b = np.triu_indices(s, 1)
        forward, back = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        out = []
        if n:
            forest = Forest(counts)
            step = max(1, min(4096, walk // n))
            for i in range(0, len(a), step):
                x, y = a[i : i + step], b[i : i + step]
                which, u, v, times = forest.leaf_pairs(x, y)
                p, q = shares(u, total[x[which]], unit), shares(v, total[y[which]], unit)
                np.add.at(forward, i + which, price(p, q) * times)
                np.add.at(back, i + which, price(q, p) * times)
            tree, place = forest.occupied(np.arange(s))
            # a group's counts are priced against the language's, equal pairs once
            pairs, at = np.unique(np.stack([tree, counts[tree, place], counts[s, place]], axis=1), axis=0, return_inverse=True)
            p, q = shares(pairs[:, 1], total[pairs[:, 0]], unit), shares(pairs[:, 2], total[s : s + 1], unit)
            worth, above = price(p, q)[at.ravel()], (p > q)[at.ravel()]
            tree, place, worth = tree[above], place[above], worth[above]
            alphabetic = np.empty(n, np.int64)
            alphabetic[sorted(range(n), key=lambda i: text[i].encode())] = np.arange(n)
            ranked = np.lexsort((alphabetic[place], -worth, tree))
            tree, place, worth = tree[ranked], place[ranked], worth[ranked]
            first = np.arange(len(tree)) - np.searchsorted(tree, tree) < top
            out.append((tree[first], ["term"] * int(first.sum()), [text[i] for i in place[first]], worth[first]))
        out.append((a, ["pair"] * len(a), [names[i] for i in b], forward))
        out.append((b, ["pair"] * len(b), [names[i] for i in a], back))
        rows = [pa.array([names[i] for i in x], pa.string()) for x, _, _, _ in out]
        return pa.concat_tables(
            pa.table([pa.array([lang] * len(x), pa.string()), r, pa.array(part, pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64())], schema=_OUT)
            for r, (x, part, item, value) in zip(rows, out)
        )

    return run


def audit(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_docs: int = LEAST_DOCS,
    top: int = TOP_TERMS,
    unit: int = UNIT,
    range_leaves: int = RANGE_LEAVES,
    walk: int = WALK,
    entries: int = ENTRIES,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` for every (lang, source) group of ``docs``.

    Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased; a language keeps those in at
    least ``least_docs`` of its documents. Part ``pair``: every other source of the language with the price of
    the group's shares against its shares, summed over all kept terms. Part ``term``: the ``top`` kept terms that the
    group has and uses more than its language does, priced against the language's shares.

    A null text, language or source is ''. Repeated rows are documents of their own; ties go to the smaller
    item; a group without terms, and a language without kept terms, take part with sums as the formula
    gives them; an empty table gives an empty result. Other columns are not read.
    """
    by_lang = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    counted = materialise(term_counts(docs, lang_col, source_col, text_col, entries).filter(F.col("term").isNull() | (F.col("docs") >= least_docs)), "terms")
    flat = counted.select("lang", "term", F.explode("cells").alias("cell")).select("lang", "term", "cell.source", "cell.n")
    groups = flat.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sizes = counted.groupBy("lang").agg(
        F.count("term").alias("kept"),
        F.sum(F.when(F.col("term").isNotNull(), F.aggregate("cells", F.lit(0).cast("long"), lambda t, c: t + c["n"])).otherwise(0)).alias("all"),
        F.max(F.when(F.col("term").isNull(), F.size("cells"))).alias("sources"),
    )
    ranges = F.greatest(F.lit(1), F.least("kept", F.ceil(F.col("kept") * (F.col("sources") + 1) / range_leaves))).cast("long")
    langs = materialise(sizes.select("lang", "kept", "all", ranges.alias("ranges")), "langs")
    langs = F.broadcast(langs) if langs.count() <= BROADCAST_LANGS else langs
    of_group = groups.join(langs, "lang").select("lang", "source", (F.col("n") + F.col("kept")).alias("total"), "ranges")
    of_lang = langs.select("lang", F.lit(None).cast("string").alias("source"), (F.col("all") + F.col("kept")).alias("total"), "ranges")
    right = of_group.unionByName(of_lang).select("lang", "source", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ranges") - 1)).alias("range"))
    left = counted.filter("term is not null").join(langs.select("lang", "ranges"), "lang").select("lang", F.pmod(F.xxhash64("term"), "ranges").alias("range"), "term", "cells")
    # both sides come from one table; columns of their own keep them apart
    right = right.toDF(*right.columns)
    found = left.groupBy("lang", "range").cogroup(right.groupBy("lang", "range")).applyInArrow(_compare(unit, top, walk), "lang string, source string, part string, item string, value long")
    found = materialise(found, "divergence")
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(by_lang))
    terms = found.filter("part = 'term'").withColumn("rank", F.row_number().over(by_lang)).filter(F.col("rank") <= top)
    return pairs.unionByName(terms)
