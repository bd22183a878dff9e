"""Top-k, WARC and preference formatting, and the pipeline."""

import base64
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
from llm_fixtures import SF_SMALL, edge_docs, llm, no_docs, words  # noqa: F401 (fixtures)
from pyspark.sql import functions as F

from rateprofile.llm import chat, topk, warc
from rateprofile.llm.common import table

# ---- top-k


def brute_top(rows, k):
    fine = [(n, i, [math.floor(1024 * float(np.float32(x))) for x in v]) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, q, a in fine:
        if q is None or q % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i is None, i or 0) for m, i, b in fine if m != n and len(b) == len(a))
        out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(scores[:k])]
    return out


def top_of(df, **kw):
    return [tuple(r) for r in topk.top_k(df, F.col("id") % 100 == 0, **kw).select("query_id", "rank", "vec_id", "score").collect()]


def test_top_k_random(llm):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) * s for _ in range(8)]) for i in range(700) for s in [rng.choice([0.01, 0.3, 1, 5])]]
    rows += [(700, [0.0] * 8), (701, [1.0] * 8), (702, [1.0] * 8), (800, [1.0] * 8), (800, [1.0] * 8), (None, [1.0] * 8)]
    rows += [(900, None), (901, [None] + [1.0] * 7), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (1000, [1.0, 2.0]), (1001, [3.0, 4.0]), (1100, [])]
    df = llm.createDataFrame([(*r, "x", 1, 2) for r in rows], "vec_id long, embedding array<float>, id string, score int, norm int")
    expected = Counter(brute_top(rows, 10))
    assert Counter(top_of(df)) == expected
    # small buckets, blocks of queries and pruning by coordinates all the way
    assert Counter(top_of(df, bucket_rows=50, query_block=3, coordinate_from=0.0)) == expected
    assert Counter(top_of(df, bucket_rows=7, coordinate_from=2.0)) == expected


def test_top_k_few(llm):
    schema = "vec_id long, embedding array<float>"
    assert top_of(llm.createDataFrame([], schema)) == []
    assert top_of(llm.createDataFrame([(0, [1.0])], schema)) == []
    assert top_of(llm.createDataFrame([(0, [1.0]), (1, [-2.0])], schema)) == [(0, 1, 1, -2048 * 1024)]


def test_top_k_of_wide_values_is_exact(llm):
    schema = "vec_id long, embedding array<double>"
    exact = lambda rows: Counter((q, r, i, s) for q, r, i, s in brute_wide(rows))
    small = [(0, [0.001]), (1, [6e12]), (2, [1e13])]
    assert sorted(top_of(llm.createDataFrame(small, schema))) == [(0, 1, 2, 1024 * 10**13), (0, 2, 1, 1024 * 6 * 10**12)]
    # sums that doubles cannot hold, wide queries, and scores that no long holds
    rng = random.Random(9)
    wide = [(i, [rng.choice([1.0, 2.0**20 + 1, 3e7, 1e12, -5e15, 0.25]) * rng.uniform(0.5, 2) for _ in range(3)]) for i in range(230)]
    wide += [(300, [1e300, 1.0, 1.0]), (301, [1e307, 0.0, 0.0]), (400, [1.0, 1.0, 1.0])]
    for kw in ({}, {"bucket_rows": 20, "query_block": 2, "coordinate_from": 0.0}):
        assert Counter(top_of(llm.createDataFrame(wide, schema), **kw)) == exact(wide)


def brute_wide(rows, k=10):
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if all(math.isfinite(1024 * x) for x in v)]
    for q, a in whole:
        if q % 100 == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q]
            yield from ((q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(t for t in scores if abs(t[0]) < 2**63)[:k]))


# ---- WARC

PAGES = "page_id long, url string, html string, offset int, length string, payload string, sha int"


def pages(rng):
    rows = [(i, f"http://h{i % 3}.example/{i}", f"<p>{rng.choice(['a', 'b', 'ü'])}</p>" * rng.randint(1, 3)) for i in range(60)]
    rows += [(60, None, "<p>null url</p>"), (61, "http://x/ y\r\nz", None), (62, "", ""), (None, "http://n", "<p>a</p>"), (None, "http://n", "<p>a</p>")]
    rows += [(63, "http://t", "tie"), (63, "http://t", "tie"), (64, "http://l", "long " * 200_000), (65, "http://c", "a\r\n\r\nContent-Length: 3\r\n\r\nb")]
    return rows


def brute_warc(rows):
    last = defaultdict(lambda: None)
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(i, last[h or ""] or i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        top = last[h or ""]
        revisit = top is not None and i != top
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    return out


def test_warc_round_trip(llm):
    rows = pages(random.Random(8))
    df = llm.createDataFrame([(*r, 1, "l", "p", 2) for r in rows], PAGES).repartition(3)
    index = warc.write(df, archive_bytes=2000)
    assert index.count() == len(rows) and index.select("archive").distinct().count() > 3
    for gap, most in ((warc.MAX_GAP, warc.MAX_READ), (0, 500), (10**9, 10**9)):
        got = warc.read(index, gap, most).collect()
        assert all(r["intact"] for r in got)
        assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == Counter(brute_warc(rows))
    texts = {r["page_id"]: bytes(r["payload"]).decode() for r in got if r["payload"] is not None and r["page_id"] is not None}
    assert all(texts[i] == (h or "") for i, _, h in rows if i in texts)
    # a selection reads only its own ranges, and all of it at once where it is dense
    some = index.filter("page_id % 7 = 0")
    assert sorted(r["page_id"] for r in warc.read(some, 0).collect()) == sorted(i for i, _, _ in rows if i is not None and i % 7 == 0)
    assert warc.ranges(index, 10**9, 10**9).count() == index.select("archive").distinct().count()


def test_warc_empty(llm):
    assert warc.read(warc.write(llm.createDataFrame([], PAGES))).count() == 0


# ---- preference formatting

TURNS = "conv_id long, turn long, role string, text string, position int, start string, pair_id int, part string"


def conversations():
    u, a = "user", "assistant"
    talks = {
        0: [(0, "system", "s"), (1, u, "hi"), (2, a, "yes"), (3, u, "more"), (4, a, "sure")],
        1: [(0, "system", "s"), (1, u, "hi"), (2, a, "no")],
        2: [(0, u, "q"), (1, a, "same")],
        3: [(0, u, "q"), (1, a, "same")],
        4: [(0, u, "only one side")],
        7: [(5, u, "gap"), (9, a, "x"), (9, a, "x"), (None, a, "late")],
        6: [(5, u, "gap"), (9, a, "x")],
        8: [(0, None, None), (1, a, "")],
        9: [(0, None, None), (1, a, "é😀 text")],
        10: [(i, u if i % 2 == 0 else a, f"t{i}") for i in range(2500)],
        11: [(i, u if i % 2 == 0 else a, f"t{i}" if i != 2100 else "other") for i in range(2300)],
    }
    return [(c, *t) for c, ts in talks.items() for t in ts] + [(None, 0, u, "nobody")]


def brute_pairs(rows):
    sides = defaultdict(lambda: {True: [], False: []})
    for c, turn, role, text in rows:
        if c is not None:
            sides[c // 2][c % 2 == 0].append((turn is None, turn or 0, role or "", text or ""))
    out = {}
    for p, s in sides.items():
        talk = {k: [(r, t) for _, _, r, t in sorted(v)] for k, v in s.items()}
        n = 0
        while n < min(map(len, talk.values())) and talk[True][n] == talk[False][n]:
            n += 1
        form = lambda r, t: f"<|im_start|>{r}\n{t}<|im_end|>\n"
        prompt = "".join(form(*x) for x in talk[True][:n])
        sides_out = []
        for k in (True, False):
            text, mask = "", []
            for r, t in talk[k][n:]:
                start = len(prompt) + len(text)
                text += form(r, t)
                if r == "assistant":
                    mask.append((start + len(f"<|im_start|>{r}\n"), len(prompt) + len(text) - 1))
            sides_out.append((text, mask))
        out[p] = (prompt, sides_out[0][0], sides_out[1][0], sides_out[0][1], sides_out[1][1])
    return out


def test_preferences(llm):
    rows = conversations()
    df = llm.createDataFrame([(*r, 1, "s", 2, "p") for r in rows], TURNS)
    segments = chat.format_pairs(df, *chat.id_pairs(df))
    got = {r["pair_id"]: (r["prompt"], r["chosen"], r["rejected"], [tuple(m) for m in r["chosen_mask"]], [tuple(m) for m in r["rejected_mask"]]) for r in chat.examples(segments).collect()}
    assert got == brute_pairs(rows)
    # the prompt is there once
    assert segments.filter("part = 'prompt' and pair_id = 5").count() == 2100
    none = llm.createDataFrame([], TURNS)
    assert chat.format_pairs(none, *chat.id_pairs(none)).count() == 0


def test_pairs_that_share_their_beginning(llm):
    schema = "conv_id long, turn int, role string, text string, chosen int, pair_id string"
    rng = random.Random(11)
    rows = [(c, t, ["user", "assistant"][t % 2], f"c{c} t{t}", 1, "x") for c in range(20) for t in range(rng.randint(0, 6))]
    rows += [(30, None, None, None, 1, "x"), (30, 1, "user", "a", 1, "x"), (30, 1, "user", "a", 1, "x"), (33, 0, "user", "alone", 1, "x"), (None, 0, "user", "none", 1, "x")]
    got = defaultdict(list)
    for r in sorted(chat.answered_by_others(llm.createDataFrame(rows, schema)).collect(), key=lambda r: r["turn"]):
        got[r["pair_id"], r["chosen"]].append((r["role"], r["text"]))
    turns = defaultdict(list)
    for c, t, role, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        turns[c].append((role or "", text or ""))
    want = {}
    for p in {c // 2 for c in turns}:
        a, b = turns[2 * p], turns[2 * p + 1]
        k = 1 + p % (len(a) - 1) if len(a) > 1 else 0
        want.update({(p, True): a, (p, False): a[:k] + b[k:]})
    assert dict(got) == {k: v for k, v in want.items() if v}
    assert chat.answered_by_others(llm.createDataFrame([], schema)).count() == 0


def test_most_registered_pairs_have_a_prompt(llm):
    from rateprofile.llm.queries import QUERIES

    parts = QUERIES["op9_preference_format"](llm, SF_SMALL).groupBy("pair_id").agg(F.collect_set("part").alias("parts")).collect()
    assert sum("prompt" in r["parts"] for r in parts) > len(parts) / 2
    assert sum({"prompt", "chosen", "rejected"} <= set(r["parts"]) for r in parts) > len(parts) / 3


# ---- pipeline


def test_pipeline(llm, edge_docs):
    import corpus_pipeline

    docs = table(llm, SF_SMALL, "documents")
    kept = docs
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(llm, kept, SF_SMALL).cache()
        assert kept.columns == docs.columns, name
        counts.append(kept.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    final = corpus_pipeline.run(llm, SF_SMALL).collect()
    own = {r["doc_id"] for r in kept.collect()}
    assert final and {i for r in final for i in r["doc_ids"]} <= own


def test_pipeline_learns_from_all_labelled_documents(llm):
    """A language whose documents all lie in op8's held-out third is learned, and its documents stay."""
    import zlib

    import corpus_pipeline

    asked = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    rng = random.Random(8)
    greek = lambda text: "".join(chr(0x3B1 + ord(c) - 97) if c != " " else c for c in text)
    rows = [(i, greek(words(rng, 60)), "el", "a") if asked(i) else (i, words(rng, 60), "en", "a") for i in range(120)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = dict(corpus_pipeline.STAGES)["language_id"](llm, docs, SF_SMALL).collect()
    assert sum(r["lang"] == "el" for r in docs.collect()) > 20
    assert {r["doc_id"] for r in kept} == set(range(120))


def test_pipeline_edges(llm, edge_docs, no_docs):
    """What each stage does with nulls, empty texts, repeated rows and clashing columns."""
    from collections import Counter

    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: Counter(repr(tuple(r)) for r in df.collect())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(llm, no_docs, SF_SMALL).collect() == []
    given = rows(edge_docs)
    kept = {name: stages[name](llm, edge_docs, SF_SMALL) for name, _ in corpus_pipeline.STAGES[:-1]}
    for name, df in kept.items():
        # rows stay as they are, or go; all columns stay
        assert df.columns == edge_docs.columns and not rows(df) - given, name
    spoken = kept["language_id"].collect()
    assert spoken and all(r["text"] and any(c.isalpha() for c in r["text"]) for r in spoken)
    fate = Counter(r["text"] for r in spoken)
    assert all(fate[t] in (0, n) for t, n in Counter(r["text"] for r in edge_docs.collect()).items())
    ids = Counter(r["doc_id"] for r in kept["near_duplicates"].collect())
    assert ids[0] == 1 and not ids[1] and ids[3] + ids[4] + ids[5] <= 1 and ids[6] == ids[9] == 1
    # no benchmark passage and no entity in these texts
    assert rows(kept["benchmark_decontamination"]) == rows(kept["pii_surrogates"]) == given
    mixed = stages["source_mix"](llm, edge_docs, SF_SMALL).collect()
    assert {r["source"] for r in mixed} == {"a", "b", "c", "d", ""}  # the texts of the null source have no words
    assert all(r["n_words"] == len(r["text"].split(" ")) <= 64 and r["doc_ids"] for r in mixed)
    entity = llm.createDataFrame([(1, "write to a@b.org", "en", "s", 17), (1, "write to a@b.org", "en", "s", 17), (2, None, "en", "s", None), (3, "", None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long")
    new = stages["pii_surrogates"](llm, entity, SF_SMALL).collect()
    assert len(new) == 4 and len({r["text"] for r in new if r["doc_id"] == 1}) == 1 and not any("a@b.org" in (r["text"] or "") for r in new)
    assert {(r["doc_id"], r["text"], r["n_chars"]) for r in new if r["doc_id"] != 1} == {(2, None, None), (3, "", 0)}
    assert all(r["n_chars"] == len(r["text"]) for r in new if r["doc_id"] == 1)
