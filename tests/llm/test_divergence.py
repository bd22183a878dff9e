"""Source divergence against plain dictionaries, and the trees against plain arrays."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import DOCS, edge_docs, llm, no_docs  # noqa: F401 (fixtures)

from rateprofile.llm import divergence

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute(docs, least_docs=3, top=200, unit=10**9):
    """Rows (text, lang, source) -> the result as a set."""
    low = {c: c + 32 for c in range(65, 91)}
    rows = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(low)), lang or "", s or "") for t, lang, s in docs]
    of, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for w, lang, s in rows:
        groups[lang].add(s)
        of[lang, s].update(w)
        df[lang].update(set(w))
    out = []
    rank = lambda xs: sorted(xs, key=lambda x: (-x[1], x[0].encode()))
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least_docs]
        total = {s: sum(of[lang, s][t] for t in kept) + len(kept) for s in sources}
        whole = sum(total[s] - len(kept) for s in sources) + len(kept)
        share = lambda c, n: 1 + unit * (c + 1) // n
        p = {s: {t: share(of[lang, s][t], total[s]) for t in kept} for s in sources}
        q = {t: share(sum(of[lang, s][t] for s in sources), whole) for t in kept}
        price = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = rank([(o, sum(price(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s])
            terms = rank([(t, price(p[s][t], q[t])) for t in kept if of[lang, s][t] > 0 and p[s][t] > q[t]])[:top]
            out += [(lang, s, part, i, v, r + 1) for part, xs in (("pair", pairs), ("term", terms)) for r, (i, v) in enumerate(xs)]
    return sorted(out)


def audited(df, **kw):
    got = divergence.audit(df, **kw)
    assert got.columns == COLUMNS
    return sorted(tuple(r) for r in got.collect())


def random_docs(rng, n):
    vocabulary = ["".join(rng.choice("abcdeé漢") for _ in range(rng.randint(1, 3))) for _ in range(60)]
    text = lambda: rng.choice([" ", "-", "7", "\n"]).join(rng.choice([str, str.upper])(w) for w in rng.choices(vocabulary, range(1, 61), k=rng.randint(0, 30)))
    docs = [(text(), rng.choice(["x", "y", None, ""]), rng.choice(["s1", "s2", "s2", "s2", "ß", None])) for _ in range(n)]
    return docs + [("only here", "z", "s1"), (None, "z", "s2"), ("", "w", None), ("Ça ça ÇA", "v", "a"), ("ça", "v", "b"), ("ça", "v", "b")]


def frame(llm, docs):  # noqa: F811
    return llm.createDataFrame([(1, t, lang, s, "p", 2, 3, 4, 5) for t, lang, s in docs], "doc_id long, text string, lang string, source string, part string, item long, value long, rank long, term int")


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_dictionaries(llm, seed):  # noqa: F811
    docs = random_docs(random.Random(seed), 150)
    expected = brute(docs)
    df = frame(llm, docs).repartition(5)
    assert audited(df) == expected
    # many ranges of terms, counts handed on early, few pairs at a time
    assert audited(df, range_leaves=16, entries=40, walk=8) == expected
    assert audited(df, least_docs=1, top=3, unit=1000) == brute(docs, least_docs=1, top=3, unit=1000)


def test_edge_documents(edge_docs):  # noqa: F811
    docs = [tuple(r) for r in edge_docs.select("text", "lang", "source").collect()]
    assert audited(edge_docs) == brute(docs)
    assert audited(edge_docs, least_docs=1) == brute(docs, least_docs=1)


def test_no_documents(no_docs):  # noqa: F811
    assert audited(no_docs) == []


def test_groups_without_kept_terms(llm):  # noqa: F811
    got = audited(frame(llm, [("a b", "x", "s"), (None, "x", "t"), ("c", "x", "u"), ("d", "y", None)]))
    assert got == sorted(("x", s, "pair", o, 0, r) for s, others in (("s", "tu"), ("t", "su"), ("u", "st")) for r, o in enumerate(others, 1))


def test_long_texts_are_counted_in_slices():
    text = (b"ab cd " * 200 + b"x" * 5000 + b" ") * 400
    got = Counter()
    for part in divergence._terms(text):
        got.update(part)
    assert got == Counter(text.split())


def test_trees_share_equal_subtrees():
    rng = np.random.default_rng(4)
    block = rng.integers(0, 3, 16)
    counts = np.stack([np.tile(block, 4), np.concatenate([np.tile(block, 3), rng.integers(0, 3, 16)]), np.zeros(64, np.int64)])[:, :61]
    forest = divergence.Forest(counts)
    at_16 = forest.nodes[4]
    assert at_16[0, 0] == at_16[0, 1] == at_16[0, 2] == at_16[1, 0] == at_16[1, 2]
    assert len(np.unique(at_16)) == len(np.unique(np.pad(counts, ((0, 0), (0, 3)), constant_values=-1).reshape(3, 4, 16).reshape(-1, 16), axis=0))
    a, b = np.array([0, 0, 1]), np.array([1, 2, 2])
    which, u, v, times = forest.leaf_pairs(a, b)
    for i in range(3):
        got = Counter({(x, y): t for w, x, y, t in zip(which.tolist(), u.tolist(), v.tolist(), times.tolist()) if w == i})
        assert got == Counter(zip(counts[a[i]].tolist(), counts[b[i]].tolist()))
    # equal pairs are met once
    assert len(which) == len({(w, x, y) for w, x, y in zip(which.tolist(), u.tolist(), v.tolist())})
    tree, place = forest.occupied(np.arange(3))
    assert sorted(zip(tree.tolist(), place.tolist())) == [(int(t), int(p)) for t, p in zip(*np.nonzero(counts > 0))]


def test_shares_of_large_counts():
    counts, total = np.array([0, 5, 3 * 10**11, 9 * 10**17]), np.array([7, 10**6, 10**12, 10**18])
    assert divergence.shares(counts, total).tolist() == [1 + 10**9 * (c + 1) // t for c, t in zip(counts.tolist(), total.tolist())]
