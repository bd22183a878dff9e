"""Scalar column expressions.

All of these are built-in Catalyst expressions (no Python UDFs), so they stay
inside whole-stage codegen. They are ANSI-safe: malformed input gives NULL
instead of failing the job (``get`` instead of ``[]``, ``try_cast`` instead of
``cast``, a guarded denominator instead of ``/``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- P1: element of a coordinate / feature array -----------------------------
def array_head(c: ColumnOrName, index: int = 0) -> Column:
    """Element ``index`` (0-based) of an array; NULL for a NULL or short array."""
    return F.get(as_col(c), index)


# --- P2: "mm:ss" clock strings ------------------------------------------------
def clock_to_minutes(c: ColumnOrName) -> Column:
    """Parse a continuous ``"mm:ss"`` clock (minutes may exceed 59) to minutes
    as a double. Malformed strings such as ``"4500"`` give NULL."""
    parts = F.split(as_col(c), ":")
    return F.get(parts, 0).try_cast("double") + F.get(parts, 1).try_cast("double") / 60.0


def minutes_to_clock(minute: ColumnOrName, second: ColumnOrName) -> Column:
    """Format whole minutes and seconds as ``"m:ss"``."""
    return F.format_string("%d:%02d", as_col(minute), as_col(second))


# --- P5, P6, P7: arithmetic ----------------------------------------------------
def clamp_min(c: ColumnOrName, floor: float = 0.0) -> Column:
    return F.greatest(as_col(c), F.lit(floor))


def per_exposure(count: ColumnOrName, exposure: ColumnOrName, per: float = 90.0) -> Column:
    """Rate per ``per`` units of exposure (per 90 minutes by default); NULL for
    zero exposure instead of an ANSI division error."""
    e = as_col(exposure)
    return as_col(count) / F.when(e > 0, e) * per


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den``; NULL when the denominator is NULL or not positive."""
    d = as_col(den)
    return as_col(num) / F.when(d > 0, d)


# --- P12: any-substring match --------------------------------------------------
#: More substrings than this are matched by one pattern instead of a chain of ``contains``.
CHAIN_SUBSTRINGS = 16


def substring_pattern(substrings: Sequence[str]) -> str:
    """A pattern found in a string exactly when the string holds one of ``substrings``: their prefix tree, so that
    a position is tried along one path and not against every substring. What follows a whole substring is cut off."""
    root: dict = {}
    for s in sorted(set(substrings), key=len):
        node = root
        for c in s:
            if node.get("") is not None:
                break
            node = node.setdefault(c, {})
        else:
            node.clear()
            node[""] = {}

    def escape(c: str) -> str:
        return c if c.isalnum() and c.isascii() else f"\\x{{{ord(c):x}}}"

    def branch(node: dict) -> str:
        # chains of single children in a loop: a long substring is no deep recursion
        out = []
        while True:
            if "" in node:
                return "".join(out)
            if len(node) > 1:
                return "".join(out) + "(?:" + "|".join(escape(c) + branch(n) for c, n in sorted(node.items())) + ")"
            ((c, node),) = node.items()
            out.append(escape(c))

    return branch(root)


def contains_any(c: ColumnOrName, substrings: Sequence[str], ignore_case: bool = False) -> Column:
    """True when the string contains any of ``substrings`` (case-sensitive by default). Many substrings are one
    expression: the pattern of their prefix tree."""
    if not substrings:
        return F.lit(False)
    target = F.lower(as_col(c)) if ignore_case else as_col(c)
    subs = [s.lower() for s in substrings] if ignore_case else list(substrings)
    if len(subs) > CHAIN_SUBSTRINGS and "" not in subs:
        return target.rlike(substring_pattern(subs))
    return reduce(lambda a, b: a | b, [target.contains(s) for s in subs])


# --- P13: ordered label -> family rules ---------------------------------------
@dataclass(frozen=True)
class LabelRule:
    """A label belongs to ``family`` when it equals one of ``equals`` or contains
    one of ``contains``. Rules are tried in order; the first match wins."""

    family: str
    equals: tuple[str, ...] = field(default_factory=tuple)
    contains: tuple[str, ...] = field(default_factory=tuple)

    def predicate(self, c: Column) -> Column:
        conds = [c == v for v in self.equals] + [c.contains(v) for v in self.contains]
        return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def label_family(c: ColumnOrName, rules: Sequence[LabelRule], default: str = "OTHER") -> Column:
    """Map a label to its family with an ordered CASE WHEN chain; NULL labels and
    labels no rule matches get ``default``."""
    label = as_col(c)
    expr = None
    for rule in rules:
        cond = rule.predicate(label)
        expr = F.when(cond, rule.family) if expr is None else expr.when(cond, rule.family)
    return F.lit(default) if expr is None else expr.otherwise(default)


# --- P18: largest component of an ML vector -------------------------------------
def vector_max(c: ColumnOrName) -> Column:
    from pyspark.ml.functions import vector_to_array

    return F.array_max(vector_to_array(as_col(c)))


def round_all(df, digits: int = 6):
    """Round every double/float column of ``df`` (presentation and exact checks)."""
    from pyspark.sql.types import DoubleType, FloatType

    return df.select(
        *[
            F.round(F.col(f.name).cast("double"), digits).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
