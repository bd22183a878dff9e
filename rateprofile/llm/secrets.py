"""Secret scan with DataFrame functions only: pattern matches with their
positions, and sliding-window entropy over candidate strings.

Positions: matches are fenced in with a control character that the text itself
cannot hold at that time (its own are replaced one for one first), the text is
split at the fences, and the lengths of the parts are summed up.

Entropy: for each character class, runs of its characters are candidates. A
window slides over a candidate; per step one count goes up and one goes down,
and the sum of n log2 n is changed by these two counts only. Windows at or above
the entropy of the class make spans, those that overlap or touch one span together.

Allow-list: a stretch of letters and digits that holds a marker word (an example, a ruler) is no part of any
candidate, what stands beside it, behind a separator, still is; a candidate that is a word, a number or the
like as a whole makes no span. Runs shorter than the window of their class are no candidates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_row

_FENCE, _OTHER = "\x01", "\x02"
_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_FOUND = "array<struct<start:bigint,value:string>>"

#: Kinds in the order in which they are listed, pattern, and the
#: shortest accepted length of the group that is measured. The last two match greedy runs, so their
#: least length can stand in the pattern: a shorter run is dropped either way, and nothing else starts
#: inside it. An assignment that is too short can hold the next key word, which it uses up.
KINDS: tuple[tuple[str, str, int, int], ...] = (
    ("assign", _ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)


@dataclass(frozen=True)
class CharClass:
    """Candidates of a character class: runs of at least ``window`` characters."""

    name: str
    chars: str
    window: int
    bits: float


CLASSES = (CharClass("hex", "0-9A-Fa-f", 24, 3.0), CharClass("base64", "A-Za-z0-9+/_=-", 24, 3.9))

#: Candidates that are no secrets as a whole: words, numbers, UUIDs, rulers.
ALLOW = (
    r"^[A-Za-z]+$",
    r"^[0-9]+$",
    r"^[A-Za-z]+([-_/=][A-Za-z]+)*[-_/=]*$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[-_=+/]+$",
)
#: What marks the letters and digits around it as no secret.
MARKERS = r"example|placeholder|changeme|0123456789|abcdefghij"
_MARKED = rf"(?i)(?<![A-Za-z0-9])[A-Za-z0-9]*?(?:{MARKERS})[A-Za-z0-9]*"


def _without_marked(text: Column) -> Column:
    """The text with a character of no class in place of every character of a marked stretch."""
    fenced = F.regexp_replace(F.translate(text, _FENCE, _OTHER), _MARKED, f"{_FENCE}$0{_FENCE}")
    parts = F.transform(F.split(fenced, _FENCE, -1), lambda x, i: F.when(i % 2 == 1, F.repeat(F.lit(_OTHER), F.length(x))).otherwise(x))
    return F.when(text.rlike(f"(?i){MARKERS}"), F.array_join(parts, "")).otherwise(text)


def _found(text: Column, pattern: str, keep) -> Column:
    """Leftmost non-overlapping matches as (start, value), those that ``keep`` accepts."""
    fenced = F.regexp_replace(F.translate(text, _FENCE, _OTHER), pattern, f"{_FENCE}$0{_FENCE}")
    parts = F.transform(F.split(fenced, _FENCE, -1), lambda x, i: F.struct(x.alias("value"), (i % 2 == 1).alias("match")))

    def add(acc: Column, part: Column) -> Column:
        one = F.array(F.struct(acc["at"].alias("start"), part["value"].alias("value")))
        out = F.when(part["match"] & keep(part["value"]), F.concat(acc["out"], one)).otherwise(acc["out"])
        return F.struct((acc["at"] + F.length(part["value"])).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_FOUND).alias("out"))
    return F.aggregate(parts, start, add)["out"]


def _allowed(value: Column, allow: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for pattern in allow:
        hit = hit | value.rlike(pattern)
    return hit


def window_entropy(value: Column, window: int, bits: float) -> Column:
    """Array of struct(first, last): end positions (from 1) of the first and the last window of each stretch of
    overlapping or touching windows of ``value`` (ASCII) with an entropy of ``bits`` or more."""
    nlogn = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 1)])
    f = lambda n: F.element_at(nlogn, (n + 1).cast("int"))

    def slide(codes: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            incoming = F.element_at(codes, i)
            outgoing = F.when(i > window, F.element_at(codes, F.greatest(i - window, F.lit(1)))).otherwise(F.lit(-1))
            went = F.when(outgoing >= 0, F.element_at(acc["counts"], F.greatest(outgoing, F.lit(0)) + 1)).otherwise(F.lit(0))
            less = F.when(went > 0, f(went) - f(went - 1)).otherwise(F.lit(0.0))
            had = F.element_at(acc["counts"], incoming + 1) - F.when(incoming == outgoing, 1).otherwise(0)
            total = acc["total"] - less + f(had + 1) - f(had)
            hot = (i >= window) & (F.lit(math.log2(window)) - total / window >= F.lit(bits - 1e-9))
            apart = hot & (acc["last"] > 0) & (i - window > acc["last"])
            counts = F.transform(acc["counts"], lambda n, k: n + F.when(k == incoming, 1).otherwise(0) - F.when(k == outgoing, 1).otherwise(0))
            return F.struct(
                counts.alias("counts"),
                total.alias("total"),
                F.when(apart | hot & (acc["first"] == 0), i).otherwise(acc["first"]).alias("first"),
                F.when(hot, i).otherwise(acc["last"]).alias("last"),
                F.when(apart, F.concat(acc["done"], stretch(acc))).otherwise(acc["done"]).alias("done"),
            )

        stretch = lambda acc: F.array(F.struct(acc["first"].alias("first"), acc["last"].alias("last")))
        none = F.array().cast("array<struct<first:int,last:int>>")
        zero = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("total"), F.lit(0).alias("first"), F.lit(0).alias("last"), none.alias("done"))
        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), zero, step, lambda acc: F.when(acc["last"] > 0, F.concat(acc["done"], stretch(acc))).otherwise(none))

    codes = F.transform(F.split(value, "", F.length(value)), lambda c: F.ascii(c))
    # bound as a lambda variable, so that the codes are made once per candidate
    return F.element_at(F.transform(F.array(codes), slide), 1)


def _span(start: Column, end: Column, order: int, kind: str) -> Column:
    return F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(kind).alias("kind"))


def _pattern_spans(text: Column, order: int, kind: str, pattern: str, group: int, least: int) -> Column:
    def long_enough(v: Column) -> Column:
        return F.length(F.regexp_extract(v, pattern, group) if group else v) >= least

    return F.transform(_found(text, pattern, long_enough), lambda x: _span(x["start"], x["start"] + F.length(x["value"]), order, kind))


def _entropy_spans(text: Column, order: int, c: CharClass, allow: tuple[str, ...]) -> Column:
    found = _found(text, f"[{c.chars}]{{{c.window},}}", lambda v: ~_allowed(v, allow))
    place = lambda x, w: _span(x["start"] + w["first"] - c.window, x["start"] + w["last"], order, f"entropy_{c.name}")
    return F.flatten(F.transform(found, lambda x: F.transform(window_entropy(x["value"], c.window, c.bits), lambda w: place(x, w))))


def scan(docs: DataFrame, text_col: str = "text", classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """One row per document: ``row`` (struct of all input columns, whatever their
    names) and ``spans``, an array of (start, order, end, kind) in code points, sorted
    by start and kind. Kinds: those of ``KINDS``, then one ``entropy_<class>`` per class.

    Null is an empty text and has no spans; repeated rows are scanned one by one.
    What the allow-list matches adds no entropy span; pattern spans
    always stay. Work grows linearly with a text, but for the spans found in it.
    """
    out = docs.select(whole_row(docs))
    text = F.coalesce(F.col(f"row.{text_col}"), F.lit(""))
    lists = [_pattern_spans(text, order, *k) for order, k in enumerate(KINDS)]
    plain = _without_marked(text)
    lists += [_entropy_spans(plain, order, c, allow) for order, c in enumerate(classes, len(KINDS))]
    return out.withColumn("spans", F.array_sort(F.concat(*lists)))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["order"] < len(KINDS))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
