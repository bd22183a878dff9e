"""Hard-negative mining against a version that scores all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import llm  # noqa: F401 (fixture)
from pyspark.sql import functions as F

from rateprofile.llm import mining

SCHEMA = "vec_id long, embedding array<double>, label string, uid long, kind int, anchor string, score long"


def floor(x, scale):
    y = x * scale
    return int(math.floor(y))


def brute(rows, positives=5, negatives=10, low=30, high=90, scale=256):
    """Rows are (id, vector, label)."""
    good = [
        (n, i, [floor(x, scale) for x in v], c)
        for n, (i, v, c) in enumerate(rows)
        if v is not None and c is not None and all(x is not None and math.isfinite(x) and math.isfinite(x * scale) for x in v)
    ]
    key = lambda r: (-r[1], r[0] is None, r[0] or 0)
    out = []
    for n, a, x, c in good:
        if a is None or a % 100:
            continue
        got = [(i, s, d == c) for m, i, y, d in good if m != n and len(y) == len(x) for s in [sum(p * q for p, q in zip(x, y))] if abs(s) < 2**63]
        mine = sorted(((i, s) for i, s, same in got if same), key=key)[:positives]
        for p, ps in mine:
            fit = sorted(((i, s) for i, s, same in got if not same and low * ps <= 100 * s <= high * ps), key=key)[:negatives]
            out += [(a, p, r + 1, i, ps, s) for r, (i, s) in enumerate(fit)]
    return Counter(out)


def mined(llm, rows, **kw):  # noqa: F811
    df = llm.createDataFrame([(i, v, c, 1, 2, "x", 3) for i, v, c in rows], SCHEMA)
    got = mining.hard_negatives(df, F.col("id") % 100 == 0, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in got.collect())


def random_rows(rng, n, dim=6):
    rows = [(i, [rng.gauss(0.4, 1) for _ in range(dim)], rng.choice("aab")) for i in range(n)]
    # ties, repeated rows and ids, no id, no label, no vector, nulls and non-finite parts, other dimensions
    rows += [(n + i, [1.0] * dim, "ab"[i % 2]) for i in range(30)] + [(100, [1.0] * dim, "a"), (100, [1.0] * dim, "b"), (100, [1.0] * dim, "b")]
    rows += [(None, [1.0] * dim, "a"), (None, [0.5] * dim, "b"), (500, [1.0] * dim, None), (501, None, "a"), (502, [None] + [1.0] * (dim - 1), "a")]
    rows += [(600, [float("nan")] * dim, "a"), (601, [float("inf")] * dim, "a"), (700, [1.0, 2.0], "a"), (701, [2.0, 1.0], "a"), (702, [0.5, 1.0], "b"), (800, [], "a"), (801, [], "a"), (802, [], "b")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(llm, seed):  # noqa: F811
    rows = random_rows(random.Random(seed), 420)
    expected = brute(rows)
    assert len(expected) > 50
    assert mined(llm, rows) == expected
    assert mined(llm, rows, block_rows=2) == expected


def test_other_parameters(llm):  # noqa: F811
    rows = random_rows(random.Random(3), 250)
    kw = dict(positives=2, negatives=3, low=0, high=100, scale=4)
    assert mined(llm, rows, **kw) == brute(rows, **kw)


def test_zero_and_negative_scores(llm):  # noqa: F811
    # a positive score of 0 opens the window 0 .. 0, a negative one none
    rows = [(0, [1.0, 0.0], "a"), (9, [0.0, 1.0], "a"), (10, [-1.0, 0.0], "a"), (3, [0.0, 2.0], "b"), (11, [0.0, 2.0], "b"), (4, [-0.5, 0.0], "b")]
    got = mined(llm, rows)
    assert got == brute(rows) == Counter([(0, 9, 1, 3, 0, 0), (0, 9, 2, 11, 0, 0)])


def test_wide_values_stay_exact(llm):  # noqa: F811
    # scores beyond 2^53, and one that no long holds, which takes no part
    rows = [(0, [1.0, 2.0**20], "a"), (1, [2.0**15 + 0.5, 2.0**16], "a"), (2, [3.0, 2.0**16 - 2.0**-8], "a"), (3, [1.0, 2.0**15], "b")]
    rows += [(4, [1.0, 2.0**15 + 2.0**-8], "b"), (5, [0.0, 1e300], "a"), (6, [1e307, 1.0], "b"), (7, [0.0, 2.0**26], "a"), (8, [0.0, 2.0**25], "b")]
    assert mined(llm, rows) == brute(rows)
    assert {k[4] for k in mined(llm, rows)} >= {2**20 * 256 * (2**16 * 256) + 256 * (2**15 * 256 + 128)}


def test_products_of_all_widths():
    rng = np.random.default_rng(0)
    for bits, kind in ((20, 0), (28, 1), (40, 2)):
        v, a = (rng.integers(-(1 << bits), 1 << bits, (5, 3)).astype(float) for _ in range(2))
        assert set(mining.width(v)) <= set(range(kind + 1))
        want = [[sum(int(x) * int(y) for x, y in zip(r, q)) for q in a] for r in v]
        got = mining.products(v, a, kind)
        assert all(g == w or (abs(w) >= 2**63 and g == mining._NONE) for gr, wr in zip(got.tolist(), want) for g, w in zip(gr, wr))


def test_windows():
    for s in range(-40, 200):
        low, high = mining.windows(s)
        assert [x for x in range(-100, 300) if 30 * s <= 100 * x <= 90 * s] == list(range(low, high + 1))


def test_few_rows(llm):  # noqa: F811
    assert not mined(llm, [])
    assert not mined(llm, [(0, [1.0], "a")])
    assert not mined(llm, [(0, [1.0], "a"), (1, [1.0], "a")])
    assert not mined(llm, [(1, [1.0], "a"), (2, [1.0], "b")])
    assert mined(llm, [(0, [1.0], "a"), (1, [1.0], "a"), (2, [0.5], "b")]) == Counter([(0, 1, 1, 2, 65536, 32768)])
