"""Many substrings as one pattern, many labellings in two passes, JSON of varying shape."""

import contextlib
import io
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from rateprofile.functions import columns
from rateprofile.functions.columns import contains_any, substring_pattern
from rateprofile.operators import clustering, labellings, scaling
from rateprofile.plans import write_family_outputs, write_global_outputs
from rateprofile.queries import em
from rateprofile.sources import read_published, variant_fields


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


# ---- P12

letters = st.text(alphabet="ab.\n\\(é漢😀", min_size=1, max_size=4)


@settings(max_examples=200, deadline=None)
@given(st.lists(letters, min_size=1, max_size=12), st.lists(letters, max_size=8))
def test_pattern_finds_what_contains_finds(subs, texts):
    # the escapes are those of java.util.regex; here as Python writes them
    pattern = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m[1], 16))), substring_pattern(subs))
    for t in texts + ["".join(texts)]:
        assert (re.search(pattern, t) is not None) == any(s in t for s in subs)


def test_ten_thousand_substrings(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdeXY .|*ß\n😀") for _ in range(n))
    subs = sorted({word(rng.randint(4, 9)) for _ in range(12_000)})[:10_000] + ["long " * 800]
    names = [word(15) for _ in range(3000)] + ["", "x" + "long " * 800, None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = df.select("name", contains_any("name", subs).alias("hit"))
    assert "rlike" in _plan(got).lower() and "Contains(" not in _plan(got)
    found = [r.hit for r in got.collect()]
    assert found == [None if n is None else any(s in n for s in subs) for n in names]
    assert 0.1 < sum(bool(f) for f in found) / len(found) < 0.95
    any_case = df.filter(contains_any("name", [s.upper() for s in subs if "ß" not in s], ignore_case=True)).count()
    assert any_case == sum(n is not None and any(s.lower() in n.lower() for s in subs if "ß" not in s) for n in names)


def test_few_substrings_and_the_empty_one(spark):
    df = spark.createDataFrame([("ab",), ("c",), ("",)], "name string")
    assert df.filter(contains_any("name", [])).count() == 0
    assert df.filter(contains_any("name", ["b", "c"])).count() == 2
    many = [f"n{i}" for i in range(columns.CHAIN_SUBSTRINGS + 5)]
    assert df.filter(contains_any("name", many + ["c"])).count() == 1
    assert df.filter(contains_any("name", many + [""])).count() == 3


# ---- labellings


@pytest.mark.parametrize("block_values", [1_000_000, 40])
def test_labellings_match_brute_force(spark, block_values):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, (40, 3)), rng.normal(4, 1, (30, 3)), [[9.0, 9.0, 9.0]]])
    n = len(x)
    label = {
        "heaps": [0] * 40 + [1] * 30 + [2],
        "mod": [i % 4 for i in range(n)],
        "one": [5] * n,
        "some": [None if i % 3 == 0 else i % 2 for i in range(n)],
    }
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], *[label[k][i] for k in label]) for i in range(n)], "id long, x array<double>, heaps int, mod int, one int, some int")
    for source, col in ((df, "x"), (scaling.assemble(df, "x", "v"), "v")):
        got = {r.labelling: r for r in labellings.score_labellings(source, {k: F.col(k) for k in label}, col, block_values).collect()}
        for name, values in label.items():
            keep = [i for i in range(n) if values[i] is not None]
            c, y = np.array([values[i] for i in keep]), x[keep]
            assert got[name].n == len(keep) and got[name].clusters == len(set(c))
            cost = sum(((y[c == k] - y[c == k].mean(0)) ** 2).sum() for k in set(c))
            assert abs(got[name].training_cost - cost) < 1e-6
            if len(set(c)) < 2:
                assert got[name].silhouette is None
                continue
            d = ((y[:, None] - y[None]) ** 2).sum(-1)
            s = []
            for i, k in enumerate(c):
                mates = (c == k).sum() - 1
                a = d[i, c == k].sum() / mates if mates else None
                b = min(d[i, c == o].mean() for o in set(c) if o != k)
                s.append(0.0 if a is None else (b - a) / max(a, b))
            assert abs(got[name].silhouette - np.mean(s)) < 1e-9
    assert abs(clustering.silhouette(scaling.assemble(df, "x", "v"), "mod", "v") - got["mod"].silhouette) < 1e-9
    assert labellings.score_labellings(df.limit(0), {"mod": F.col("mod")}, "x").count() == 0


def test_scores_of_all_k_read_the_vectors_twice(spark, monkeypatch):
    reads = []
    real = em.table

    def counted(spark_, sf_dir, name, cols=None):
        df = real(spark_, sf_dir, name, cols)
        acc = spark_.sparkContext.accumulator(0)
        reads.append((acc, df.count()))

        def seen(batches):
            for b in batches:
                acc.add(b.num_rows)
                yield b

        return df.mapInArrow(seen, df.schema)

    monkeypatch.setattr(em, "table", counted)
    assert em.q_k_scores(spark, SF_SMALL).count() == len(em.SWEEP_KS)
    assert sum(acc.value for acc, _ in reads) <= 2 * sum(n for _, n in reads)


# ---- variants


def test_variant_rows(spark):
    texts = ['{"k": 3, "a": {"b": [1, "x"]}}', '{"k": "7"}', '{"k": "text"}', '{"k": null}', "{}", "[5]", "", "{broken", None, '{"k": {"z": 1.5}}', '{"k": true}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string")
    got = variant_fields(df, "j", {"k": ("$.k", "long"), "t": ("$.k", "string"), "b": ("$.a.b[1]", "string"), "shape": ("$.k", "shape")}, ["id"])
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        (0, 3, "3", "x", "BIGINT"),
        (1, 7, "7", None, "STRING"),
        (2, None, "text", None, "STRING"),
        (3, None, None, None, "VOID"),
        (4, None, None, None, None),
        (5, None, None, None, None),
        (6, None, None, None, None),
        (7, None, None, None, None),
        (8, None, None, None, None),
        (9, None, '{"z":1.5}', None, "OBJECT<z: DECIMAL(2,1)>"),
        (10, 1, "true", None, "BOOLEAN"),
    ]


# ---- published outputs


def test_published_outputs(spark, scratch):
    clustered = spark.createDataFrame([(1, "DEF", 0), (2, "MID", 1), (3, "MID", 0)], "player_id long, family string, cluster int")
    sizes = clustered.groupBy("family").count()
    write_family_outputs({"assignments": clustered, "sizes": sizes}, scratch, published=True)
    # a run of one family replaces that family; one that it no longer clusters is gone
    again = clustered.filter("family = 'DEF'").withColumn("cluster", F.lit(4))
    write_family_outputs({"assignments": again, "sizes": again.groupBy("family").count()}, scratch, published=True)
    assert rows(read_published(spark, f"{scratch}/families")) == [(1, "DEF", 4), (2, "MID", 1), (3, "MID", 0)]
    write_family_outputs({"assignments": again.limit(0), "sizes": sizes.filter("family = 'MID'")}, scratch, published=True)
    assert rows(read_published(spark, f"{scratch}/families")) == [(1, "DEF", 4)]
    for v in (1, 2):
        table = clustered.withColumn("cluster", F.lit(v))
        write_global_outputs({"train_clusters": table, "test_clusters": table}, scratch, published=True)
    assert {r.cluster for r in read_published(spark, f"{scratch}/player_features_train").collect()} == {2}
