import random

import pytest


SF_SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, fingerprint string, hits int, spans string, size string, id string, key int, score string, kind string"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(n))


def doc(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), "r", "f", 1, "s", "z", "i", 7, "c", "k")


@pytest.fixture(scope="session")
def llm(spark):
    from rateprofile.llm.common import ship

    ship(spark)
    return spark


@pytest.fixture(scope="session")
def edge_docs(llm):
    """Nulls in every column, empty, wordless and very long texts, copies, near copies, repeated rows
    and ids, with extra columns named like those of the operators."""
    rng = random.Random(5)
    base, long_ = words(rng, 120), words(rng, 30_000)
    passage = words(rng, 60)
    rows = [
        doc(0, base),
        doc(1, base),
        doc(2, base + " tail"),
        doc(2, base + " tail"),
        doc(3, None),
        doc(4, "", "fr", None),
        doc(5, " \n\t ", None, "b"),
        doc(None, words(rng, 80), "de", "b"),
        doc(None, None, None, None),
        doc(6, long_, "de", "c"),
        doc(7, words(rng, 50) + " " + passage + " " + words(rng, 50), "fr", "c"),
        doc(8, passage + " " + words(rng, 70), "es", "c"),
        doc(9, "é" * 150 + " ß " + "漢字" * 120, "es", ""),
        doc(10, "Straße\x00null\x1funit 😀 " + words(rng, 40), "es", "d"),
        doc(11, "x"),
        doc(12, "ab " * 400),
        (None,) * 14,
    ]
    return llm.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], DOCS)
