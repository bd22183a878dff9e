"""The line CRF: sums against all labellings, gradient against differences, scores on planted documents."""

import itertools
import math
import random

import numpy as np
from llm_fixtures import SF_SMALL, doc, edge_docs, llm, no_docs, words  # noqa: F401 (fixtures)

from rateprofile.llm import quality
from rateprofile.llm.common import table
from rateprofile.llm.queries import QUERIES

LABELS = "doc_id long, quality int, label string, text string"


def chain(good, step):
    """(log total, probability of label 1 per line) by adding up all labellings."""
    n = len(good)
    total, one = 0.0, np.zeros(n)
    for y in itertools.product((0, 1), repeat=n):
        e = math.exp(sum(g for g, b in zip(good, y) if b) + sum(step[a][b] for a, b in zip(y, y[1:])))
        total += e
        one += e * np.array(y)
    return math.log(total), one / total


def test_sums_of_all_labellings():
    rng = np.random.default_rng(1)
    sizes = [3, 1, 5, 2, 5]
    doc_ = np.repeat(np.arange(5), sizes)
    good, step = rng.normal(0, 2, len(doc_)), rng.normal(0, 1, (2, 2))
    chains = quality.Chains(doc_)
    got, (_, _, total) = chains.marginals(good, step), chains.sums(good, step)
    for c in range(5):
        want, p = chain(good[doc_ == c], step)
        assert np.allclose(got[doc_ == c], p)
        assert math.isclose(total[np.flatnonzero(chains.first == np.flatnonzero(doc_ == c)[0])[0]], want)


def test_gradient():
    rng = np.random.default_rng(2)
    doc_ = np.repeat(np.arange(4), [2, 4, 1, 3])
    x, w, step = rng.normal(size=(10, 3)), rng.normal(size=3), rng.normal(size=(2, 2))
    label, weight = np.repeat([0.0, 1.0, 1.0, 0.0], [2, 4, 1, 3]), np.repeat([0.1, 0.2, 0.3, 0.4], [2, 4, 1, 3])
    chains = quality.Chains(doc_)
    f = lambda v: quality.likelihood(v[:3], v[3:].reshape(2, 2), x, doc_, chains, label, weight)[0]
    v = np.concatenate([w, step.ravel()])
    _, g, gs = quality.likelihood(w, step, x, doc_, chains, label, weight)
    numeric = [(f(v + d) - f(v - d)) / 2e-5 for d in np.eye(7) * 1e-5]
    assert np.allclose(np.concatenate([g, gs.ravel()]), numeric, atol=1e-6)


def lines_of(*texts):
    raw = [t.encode() for t in texts]
    return quality.line_features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


def test_lines_and_features():
    got = lines_of("one two\n\n  \nThree, THREE!", "", "x\r\ny", "\n", "last last LAST")
    assert got.doc.tolist() == [0, 0, 2, 2, 4]
    assert list(zip(got.start.tolist(), got.end.tolist())) == [(0, 7), (12, 25), (0, 2), (3, 4), (0, 14)]
    upper, again = got.x[:, quality._UPPER], got.x[:, quality._CLASSES]
    assert np.allclose(upper, [0, math.sqrt(6 / 13), 0, 0, math.sqrt(4 / 14)])
    assert np.allclose(again, [0, 0, 0, 0, math.sqrt(1 / 3)])
    # a repeated line is seen, a document's neighbours are its own
    got = lines_of("a b\nc d\na b", "a b")
    assert got.x[:, -1].tolist() == [0, 0, 1, 0]
    f = quality.chain_features(got.x, got.doc)
    assert f.shape == (4, quality.FEATURES) and f[:, -3].tolist() == [1, 0, 0, 1] and f[:, -2].tolist() == [0, 0, 1, 1]
    n = got.x.shape[1]
    assert np.array_equal(f[1, n : 2 * n], got.x[0]) and np.array_equal(f[1, 2 * n : 3 * n], got.x[2]) and not f[3, n : 3 * n].any()


def corpus(rng, n):
    """Documents of prose (1), junk (0), and their labels; the words are the same."""
    rows, labels = [], []
    for i in range(n):
        lines = [words(rng, rng.randint(3, 12)).capitalize() + "." for _ in range(rng.randint(1, 6))]
        bad = i % 3 == 0
        if bad:
            junk = rng.choice([lambda s: s.upper().replace(" ", "!! "), lambda s: s.replace(" ", " | "), lambda s: " ".join([s.split()[0]] * 9)])
            lines = [junk(s) for s in lines]
        rows.append(doc(i, "\n".join(lines)))
        labels.append((i, 0 if bad else 1, "z", "t"))
    return rows, labels


def frames(llm, rows, labels):  # noqa: F811
    from llm_fixtures import DOCS

    return llm.createDataFrame(rows, DOCS), llm.createDataFrame(labels, LABELS)


def test_unseen_documents(llm):  # noqa: F811
    rng = random.Random(3)
    rows, labels = corpus(rng, 240)
    docs, marked = frames(llm, rows, labels)
    model = quality.fit(docs, marked.filter("doc_id >= 80"))
    got = {r["doc_id"]: r for r in quality.score(docs, model, ["doc_id"]).collect()}
    assert all((got[i]["score"] >= quality.THRESHOLD) == bool(q) for i, q, _, _ in labels[:80])
    # every line has its place in the text and a probability; the score is their mean by length
    text = {r[0]: r[1] for r in rows}
    for i, r in got.items():
        assert [text[i][x["start"] : x["end"]] for x in r["lines"]] == text[i].split("\n")
        size = [len(s.encode()) for s in text[i].split("\n")]
        assert math.isclose(r["score"], sum(s * x["good"] for s, x in zip(size, r["lines"])) / sum(size), abs_tol=1e-9)
    # the same rows in another layout give the same model
    again = quality.fit(docs.repartition(7), marked.filter("doc_id >= 80").repartition(3))
    assert np.array_equal(again.w, model.w) and np.array_equal(again.step, model.step)


def test_lines_are_labelled_within_a_document(llm):  # noqa: F811
    rng = random.Random(4)
    rows, labels = corpus(rng, 240)
    docs, marked = frames(llm, rows, labels)
    model = quality.fit(docs, marked)
    prose, junk = [words(rng, 30).capitalize() + "." for _ in range(30)], [words(rng, 30).upper().replace(" ", "!! ") for _ in range(30)]
    mixed = llm.createDataFrame([(1, "\n".join(prose + junk)), (2, "\n".join(prose)), (3, "\n".join(junk))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.score(mixed, model, ["doc_id"]).collect()}
    good = [x["good"] > 0.5 for x in got[1]["lines"]]
    assert sum(good[:28]) >= 26 and sum(good[32:]) <= 2
    assert got[3]["score"] < got[1]["score"] < got[2]["score"]


def test_edge_documents(llm, edge_docs, no_docs):  # noqa: F811
    rows, labels = corpus(random.Random(5), 60)
    docs, marked = frames(llm, rows, labels + [(None, 1, "z", "t"), (7, None, "z", "t"), (8, 5, "z", "t"), (9, 0, "z", "t"), (9, 0, "z", "t"), (10**6, 1, "z", "t")])
    model = quality.fit(docs, marked)
    got = [(r["doc_id"], r["score"], r["lines"]) for r in quality.score(edge_docs, model, ["doc_id"]).collect()]
    given = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    assert sorted(str(g[0]) for g in got) == sorted(str(g[0]) for g in given)
    assert all(0 <= s <= 1 and len(ls) == len([x for x in (dict(given).get(i) or "").split("\n") if x.strip(" \t\n\v\f\r")]) for i, s, ls in got if i is not None)
    # without words: the share of good labels; copies alike
    assert {s for i, s, _ in got if i in (3, 4, 5)} == {model.prior}
    assert len({s for i, s, _ in got if i in (0, 1)}) == 1 and len([i for i, _, _ in got if i == 2]) == 2 and len({s for i, s, _ in got if i == 2}) == 1
    # keys of any name come back
    assert quality.score(edge_docs, model, ["row", "doc_id", "score"]).columns[:2] == ["row", "doc_id"]
    assert quality.score(no_docs, model, ["doc_id"]).count() == 0
    # labels of one kind, or none
    assert {r["score"] for r in quality.score(edge_docs, quality.fit(docs, marked.filter("quality = 1")), ["doc_id"]).collect()} == {1.0}
    assert {r["score"] for r in quality.score(edge_docs, quality.fit(no_docs, marked.limit(0)), ["doc_id"]).collect()} == {0.5}
    assert quality.fit(no_docs, marked).prior == model.prior


def test_query_on_held_out_rows(llm):  # noqa: F811
    got = {r["doc_id"]: r for r in QUERIES["op12_quality"](llm, SF_SMALL).collect()}
    assert len(got) == table(llm, SF_SMALL, "documents").count()
    marked = [r for r in table(llm, SF_SMALL, "labels").collect() if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    right = [got[r["doc_id"]]["predicted"] == r["quality"] for r in marked]
    assert len(right) > 5 and sum(right) >= 0.9 * len(right)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got.values())
