"""Array files in byte ranges against the plain scan."""

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rateprofile.sources.array_files import _lines, array_records, read_array_files
from rateprofile.sources.json_sources import CORRUPT, accepted, flatten_events, read_json_arrays
from rateprofile.sources.schemas import EVENT_SCHEMA


@pytest.fixture
def small_splits(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(n)) for k in saved]
    for k, v in saved.items():
        spark.conf.set(k, v)


VALUES = [1, "a", "line\\nbreak \\u00e9 é 漢 😀", 'quote " and \\ and {[}], ', None, True, [], {}, [[], [{}]], {"k": ["]", "{", ","]}, 2.5, "x" * 400]


@pytest.mark.parametrize("indent", [0, 1, 4])
def test_records_at_any_split(spark, scratch, small_splits, indent):
    rng = random.Random(indent)
    want = []
    for name, n in (("a", 60), ("b", 0), ("c", 1), ("d", 25)):
        data = [{"i": i, "v": [rng.choice(VALUES) for _ in range(rng.randint(0, 6))]} if i % 7 else rng.choice(VALUES) for i in range(n)]
        with open(f"{scratch}/{name}.json", "w") as f:
            json.dump(data, f, indent=indent, ensure_ascii=bool(n % 2))
        want += [(f"{name}.json", json.dumps(x, sort_keys=True)) for x in data]
    for size in (60, 1000, 1 << 20):
        small_splits(size)
        got = [(os.path.basename(r.file), json.dumps(json.loads(r.record), sort_keys=True)) for r in array_records(spark, f"{scratch}/*.json").collect()]
        assert sorted(got) == sorted(want), size
    small_splits(100)
    assert _lines(spark, f"{scratch}/a.json").rdd.getNumPartitions() > 8


def test_events_equal_the_plain_scan(spark, football_dir, scratch, small_splits):
    for p in sorted(glob.glob(f"{football_dir}/events/*.json"))[:2]:
        with open(f"{scratch}/{os.path.basename(p)}", "w") as f:
            json.dump(json.load(open(p)), f, indent=2)
    plain = flatten_events(accepted(read_json_arrays(spark, f"{scratch}/*.json", EVENT_SCHEMA)))
    small_splits(20_000)
    got = read_array_files(spark, f"{scratch}/*.json", EVENT_SCHEMA)
    assert got.filter(F.col(CORRUPT).isNotNull()).count() == 0
    assert sorted(map(str, flatten_events(got.drop(CORRUPT, "source_file")).collect())) == sorted(map(str, plain.collect()))


def test_broken_elements(spark, scratch):
    with open(f"{scratch}/1.json", "w") as f:
        f.write('[\n{"id": "a"},\n{"id": "b", "minute": "no number"},\n5,\n{"id": "c"}\n]\n')
    got = read_array_files(spark, f"{scratch}/1.json", EVENT_SCHEMA)
    assert rows(got.filter(F.col(CORRUPT).isNull()), "id") == [("a",), ("c",)]
    assert got.filter(F.col(CORRUPT).isNotNull()).count() == 2
    with open(f"{scratch}/2.json", "w") as f:
        f.write('[{"id": "a"},\n{"id": "b"')
    cut = read_array_files(spark, f"{scratch}/2.json", EVENT_SCHEMA)
    assert rows(cut.filter(F.col(CORRUPT).isNull()), "id") == [("a",)] and cut.count() == 2
