"""Mixing sources to target weights, with DataFrame functions only.

The words of a source are packed into blocks of a fixed number of words (a
document covers one or more blocks, in part or in whole). Output shards draw how many blocks they
take from each source as multinomial counts. All draws together are as many as all quotas, so
what a source is drawn beyond its quota, evenly over its shards, goes one for one to the sources
that were drawn too little: the mix meets its targets, repeats no block more than ``max_repeats``
times, and each shard keeps the number of its slots. The slots of
a source run through a keyed permutation of its block numbers, once per
repetition (a swap-or-not shuffle: a bijection for any number of blocks), and
slots and blocks are joined by (source, block number), which spreads a hot
source over all partitions. The last block that a source gives is cut to the words that its target still
lacks: a source's taken words differ from its target by less than one word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 20240229
ROUNDS = 12
#: Documents per stretch of the running word count of a source.
STRETCH_DOCS = 1000
#: Shards per stretch of the running count of a source's draws.
STRETCH_SHARDS = 1000
#: Slots that one task generates.
TASK_SLOTS = 100_000
#: Up to this many sources the per-source table is broadcast, else joined.
BROADCAST_SOURCES = 20_000
_LEAST_CELLS = 2048
_WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))


def size_of(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.size(words_of(F.coalesce(text, F.lit("")))), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """(sid, source, source_size, target, n_blocks, quota, last_words) from (source, size) rows.

    Sources in code-point order, null last, take the weights in turn and share
    the sum of all sizes; a target stops at ``max_repeats`` times the size of its source, and the
    excess is shared again by weight. The shares end at a common level per
    unit of weight, which is found by filling sources up in the order in which
    they reach their limit. One row per source: the windows here run over
    sums, not over documents.

    ``quota`` blocks hold the target's words: whole repetitions of the source, then the first blocks
    of a permutation of it. Of the last one only ``last_words`` are taken (null: all).
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = per.withColumn("sid", F.row_number().over(by_name)).withColumn("weight", F.element_at(turn, ((F.col("sid") - 1) % len(weights) + 1).cast("int")))
    capped = ranked.withColumn("cap", F.col("source_size").cast("double") * max_repeats).withColumn("full_at", F.col("cap") / F.col("weight"))
    filling = Window.orderBy("full_at", "sid")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    lines = capped.withColumn(
        "level",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    ).withColumn("place", F.row_number().over(filling))
    open_ = F.when(F.col("level") <= F.col("full_at"), F.struct("place", "level"))
    leveled = lines.withColumn("final", F.min(open_).over(every)["level"])
    target = F.least(F.col("cap"), F.col("final") * F.col("weight"))
    length = F.lit(block_words).cast("long")
    blocks = F.ceil(F.col("source_size") / length).cast("long")
    wanted = leveled.withColumn("target", target).filter("source_size > 0").withColumn("n_blocks", blocks)
    wanted = wanted.withColumn("words", F.least(F.round("target").cast("long"), F.col("source_size") * max_repeats))
    wanted = wanted.withColumn("round", F.floor(F.col("words") / F.col("source_size"))).withColumn("rest", F.pmod("words", "source_size"))
    # the source's last block can be short: where it comes in the last repetition tells how many blocks hold the rest
    wanted = wanted.withColumn("short_at", permuted(F.col("n_blocks") - 1, F.col("n_blocks"), ["sid", "round"], seed, inverse=True))
    missing = F.col("n_blocks") * length - F.col("source_size")
    held = lambda m: m * length - F.when(F.col("short_at") < m, missing).otherwise(0)
    wanted = wanted.withColumn("m", F.ceil(F.col("rest") / length).cast("long"))
    wanted = wanted.withColumn("m", F.when(held(F.col("m")) < F.col("rest"), F.col("m") + 1).otherwise(F.col("m")))
    cut = F.when(F.col("rest") > 0, F.col("rest") - held(F.col("m") - 1))
    quotas = wanted.select("sid", "n_blocks", (F.col("round") * F.col("n_blocks") + F.col("m")).alias("quota"), cut.alias("last_words"))
    none = F.lit(0).cast("long")
    out = leveled.withColumn("target", target).join(quotas, "sid", "left")
    return out.select("sid", "source", "source_size", "target", F.coalesce("n_blocks", none).alias("n_blocks"), F.coalesce("quota", none).alias("quota"), "last_words")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def running(rows: DataFrame, by: str, stretch: Column, order: str, value: str, name: str) -> DataFrame:
    """``rows`` with ``name``, the sum of ``value`` over the rows before in the order of (stretch,
    ``order``) among those of the same ``by``. Sums go over stretches, then within each: no window
    holds more than the rows of a stretch or the stretches of a ``by``."""
    rows = rows.withColumn("_stretch", stretch)
    sums = rows.groupBy(by, "_stretch").agg(F.sum(value).alias("_n"))
    up_to = Window.partitionBy(by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(by, "_stretch", F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_base"))
    within = Window.partitionBy(by, "_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.withColumn("_inner", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return counted.join(base, [by, "_stretch"]).withColumn(name, F.col("_base") + F.col("_inner")).drop("_stretch", "_base", "_inner")


def pack(docs: DataFrame, sources: DataFrame, n_sources: int, n_docs: int) -> DataFrame:
    """``docs`` (key, source, size, more) with ``sid`` and ``start``, the number of
    words of the source before the document."""
    stretches = max(1, -(-n_docs // STRETCH_DOCS))
    own = sources.select("sid", F.col("source").alias("s_source"))
    placed = docs.join(_small(own, n_sources), F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
    return running(placed, "sid", F.pmod("key", F.lit(stretches)), "key", "size", "start")


def permuted(x: Column, n: Column, keys: list[str], seed: int = SEED, rounds: int = ROUNDS, inverse: bool = False) -> Column:
    """x (0 <= x < n) sent through a keyed bijection of 0 .. n - 1: in each round
    x and its mirror about a round key may change places. Backwards, the rounds undo it."""

    def one(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit(seed), r, *keys), n) - x, n)
        swap = F.xxhash64(F.lit(seed + 1), r, *keys, F.greatest(x, mirror)).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, mirror).otherwise(x)

    turns = F.sequence(F.lit(rounds), F.lit(1)) if inverse else F.sequence(F.lit(1), F.lit(rounds))
    return F.aggregate(turns, x, one)


def _in_shares(points: DataFrame, at: str, total: int, shares: DataFrame, n_sources: int) -> DataFrame:
    """``points`` with the columns of the share (lo <= ``at`` < hi, in 0 .. total - 1) that each falls
    into. Equal cells make it an equi-join; there are at least as many as shares, so that a point
    meets about two shares."""
    n_cells = max(_LEAST_CELLS, n_sources)
    cell = lambda x: F.floor(x / F.lit(float(max(total, 1))) * n_cells)
    cells = shares.filter("hi > lo").select("*", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - 1))).alias("cell"))
    return points.withColumn("cell", cell(F.col(at))).join(_small(cells, n_sources), "cell").filter((F.col(at) >= F.col("lo")) & (F.col(at) < F.col("hi"))).drop("cell", "lo", "hi")


def _shares(sources: DataFrame, value: Column) -> DataFrame:
    """(sid, lo, hi): the sources' values laid end to end. A window over one row per source."""
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    return sources.select("sid", value.alias("_v")).withColumn("hi", F.sum("_v").over(upto)).select("sid", (F.col("hi") - F.col("_v")).alias("lo"), "hi")


def shard_counts(sources: DataFrame, n_sources: int, n_slots: int, n_shards: int, seed: int = SEED) -> DataFrame:
    """(sid, shard, count, first): blocks that a shard takes from a source, where it takes any,
    and how many the shards before it take. The counts are multinomial draws,
    corrected to the quota: the surplus of a source, spread evenly over its draws, goes to sources with too few."""
    spark = sources.sparkSession
    stretch = F.floor(F.col("shard") / STRETCH_SHARDS)
    slots = spark.range(n_slots).select((F.col("id") % n_shards).alias("shard"), F.pmod(F.xxhash64(F.lit(seed + 2), "id"), F.lit(max(n_slots, 1)).cast("long")).alias("u"))
    drawn = _in_shares(slots, "u", n_slots, _shares(sources, F.col("quota")), n_sources).groupBy("sid", "shard").agg(F.count("*").alias("n"))
    drawn = materialise(drawn, "drawn")
    totals = drawn.groupBy("sid").agg(F.sum("n").alias("total"))
    each = materialise(sources.select("sid", "quota").join(totals, "sid", "left").withColumn("total", F.coalesce("total", F.lit(0).cast("long"))), "totals")
    n_freed = int(each.agg(F.sum(F.greatest(F.col("total") - F.col("quota"), F.lit(0)))).first()[0] or 0)
    before = running(drawn, "sid", stretch, "shard", "n", "prior")
    surplus = F.greatest(F.col("total") - F.col("quota"), F.lit(0))
    freed_from = _shares(each, surplus).select("sid", F.col("lo").alias("freed_lo"))
    before = before.join(_small(each.withColumn("surplus", surplus).join(freed_from, "sid"), n_sources), "sid")
    # the product of two counts can pass 2^63
    given = lambda i: F.expr(f"cast(surplus as decimal(19, 0)) * cast({i} as decimal(19, 0)) div total")
    before = before.withColumn("freed_first", given("prior")).withColumn("freed", given("(prior + n)") - F.col("freed_first"))
    before = materialise(before.select("sid", "shard", "n", "freed_lo", "freed_first", "freed"), "freed")
    freed = before.filter("freed > 0").select("shard", F.explode(F.sequence(F.col("freed_lo") + F.col("freed_first"), F.col("freed_lo") + F.col("freed_first") + F.col("freed") - 1)).alias("x"))
    total = F.lit(max(n_freed, 1)).cast("long")
    freed = freed.select("shard", permuted(F.col("x"), total, [], seed + 4).alias("x"))
    lack = _shares(each, F.greatest(F.col("quota") - F.col("total"), F.lit(0)))
    moved = _in_shares(freed, "x", n_freed, lack, n_sources).select("sid", "shard", F.lit(1).cast("long").alias("count"))
    kept = before.select("sid", "shard", (F.col("n") - F.col("freed")).alias("count"))
    counts = materialise(kept.unionByName(moved).groupBy("sid", "shard").agg(F.sum("count").alias("count")).filter("count > 0"), "counts")
    return running(counts, "sid", stretch, "shard", "count", "first")


def slots(sources: DataFrame, n_sources: int, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, sid, place, block, last_words): every block that the mix takes. ``place`` orders a
    shard at random; of the last block of a source only ``last_words`` are taken."""
    n_slots = int(sources.agg(F.sum("quota")).first()[0] or 0)
    n_shards = max(1, -(-n_slots // shard_slots))
    counts = shard_counts(sources, n_sources, n_slots, n_shards, seed)
    counts = materialise(counts.join(_small(sources.select("sid", "n_blocks", "quota", "last_words"), n_sources), "sid"), "shard-counts")
    # few rows that become many: spread them first, by a number that follows what they become
    counts = counts.repartition(max(1, -(-n_slots // TASK_SLOTS)), "sid", "shard")
    each = counts.select("sid", "n_blocks", "quota", "last_words", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("rank"))
    each = each.withColumn("round", F.floor(F.col("rank") / F.col("n_blocks")))
    block = permuted(F.col("rank") % F.col("n_blocks"), F.col("n_blocks"), ["sid", "round"], seed)
    last = F.when(F.col("rank") == F.col("quota") - 1, F.col("last_words"))
    return each.select("shard", "sid", F.xxhash64(F.lit(seed + 3), "sid", "rank").alias("place"), block.alias("block"), last.alias("last_words"))


def pieces(packed: DataFrame, block_words: int = BLOCK_WORDS, text_col: str | None = None) -> DataFrame:
    """One row per document and block that it covers: ``block``, ``first`` (its first
    word there), ``n_words`` and, if ``text_col`` is given, their ``text``."""
    length = F.lit(block_words).cast("long")
    lo = lambda b: F.greatest(F.col("start"), b * length) - F.col("start")
    hi = lambda b: F.least(F.col("start") + F.col("size"), (b + 1) * length) - F.col("start")
    blocks = F.sequence(F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("size") - 1) / length))
    full = packed.filter("size > 0")
    if text_col:
        full = full.withColumn("_words", words_of(F.col(text_col))).drop(text_col)
    fields = lambda b: [b.alias("block"), lo(b).alias("first"), (hi(b) - lo(b)).alias("n_words")]
    if text_col:
        piece = lambda b: F.struct(*fields(b), F.array_join(F.slice("_words", (lo(b) + 1).cast("int"), (hi(b) - lo(b)).cast("int")), " ").alias("text"))
    else:
        piece = lambda b: F.struct(*fields(b))
    kept = [c for c in full.columns if c != "_words"]
    return full.select(*kept, F.explode(F.transform(blocks, piece)).alias("_p")).select(*kept, "_p.*")


class Mix:
    """A mix of ``docs``: ``sources`` (targets per source), ``docs`` (id, source, size, sid,
    start and, with ``keep_text``, text) and ``mixed()``.

    Null text has size 0; a null source is a source of its own; documents of
    size 0 are in no block; equal rows are packed one after the other; an empty table
    gives an empty mix. Reruns agree: every draw is a hash of ``seed`` and an
    index. Other columns play no part, whatever their names.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED, keep_text: bool = False):
        self.block_words, self.shard_slots, self.seed, self.keep_text = block_words, shard_slots, seed, keep_text
        text = F.col(text_col)
        sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size_of(text).alias("size"), F.xxhash64(id_col, text_col).alias("key"), *([text.alias("text")] if keep_text else []))
        if not keep_text:
            sized = materialise(sized, "sizes")
        self.sources = materialise(source_targets(sized.select("source", "size"), weights, max_repeats, block_words, seed), "sources")
        self.n_sources = self.sources.count()
        self.docs = pack(sized, self.sources, self.n_sources, sized.count())

    def mixed(self) -> DataFrame:
        """One row per block taken and document in it: ``shard``, ``place``, ``sid``, ``block``,
        ``id``, ``start``, ``first``, ``n_words`` and ``text`` if it was kept."""
        parts = pieces(self.docs, self.block_words, "text" if self.keep_text else None).drop("source", "size", "key")
        # sizes before the slots are generated say nothing about after: never broadcast them
        rows = slots(self.sources, self.n_sources, self.shard_slots, self.seed).hint("merge").join(parts, ["sid", "block"])
        at = F.col("start") + F.col("first") - F.col("block") * self.block_words
        rows = rows.withColumn("left", F.coalesce(F.col("last_words") - at, F.col("n_words"))).filter("left > 0")
        if self.keep_text:
            rows = rows.withColumn("text", F.when(F.col("left") < F.col("n_words"), F.expr("substring_index(text, ' ', cast(left as int))")).otherwise(F.col("text")))
        return rows.withColumn("n_words", F.least("left", "n_words")).drop("left", "last_words")

    def taken(self) -> DataFrame:
        """The documents with ``source_size``, ``target`` and ``taken``, the words that the mix takes."""
        words = self.mixed().groupBy("sid", "start").agg(F.sum("n_words").alias("taken"))
        at = F.when(F.col("size") > 0, F.col("start"))
        targets = _small(self.sources.select("sid", "source_size", "target"), self.n_sources)
        docs = self.docs.withColumn("at", at).join(words.withColumnRenamed("start", "at"), ["sid", "at"], "left")
        return docs.join(targets, "sid").select("id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def blocks(self) -> DataFrame:
        """The mix as training blocks, one row each: ``shard``, ``place``, ``source``, ``block``,
        ``doc_ids`` (in the order of the text), ``n_words``, ``text``. A block holds at most
        ``block_words`` documents."""
        part = F.struct("start", F.col("id").alias("doc_id"), "n_words", "text")
        rows = self.mixed().groupBy("shard", "place", "sid", "block").agg(F.array_sort(F.collect_list(part)).alias("p"))
        names = _small(self.sources.select("sid", "source"), self.n_sources)
        total = F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["n_words"])
        return rows.join(names, "sid").select("shard", "place", "source", "block", F.col("p.doc_id").alias("doc_ids"), total.alias("n_words"), F.array_join("p.text", " ").alias("text"))
