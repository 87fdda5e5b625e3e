"""Texts of some megabytes among short ones, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from pageloom.llm import bilinear, fingerprints, similar, substrings
from tests.llm import test_bilinear, test_fingerprints, test_similar, test_substrings


@pytest.fixture(scope="module")
def rows():
    """A text, a near copy of it, a part of it, and short ones."""
    rng = random.Random(4)
    words = [f"word{i}" for i in range(20_000)]
    text = [rng.choice(words) for _ in range(300_000)]
    near = list(text)
    for at in rng.sample(range(len(near)), 1500):
        near[at] = "new"
    return [(1, " ".join(text)), (2, "a b c"), (3, " ".join(near)), (4, None), (5, " ".join(text[100_000:150_000]))]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, chunk int, TEXT string")


def test_fingerprints_of_long_texts(docs, rows):
    got = {r.doc_id: r for r in fingerprints.compare_with_next(docs).collect()}
    texts = [t or "" for _, t in rows]
    for (doc, _), text, following in zip(rows, texts, [*texts[1:], texts[0]], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert (got[doc].n_chars, got[doc].edited) == (len(text), edited)
        assert abs(got[doc].near_edited - test_fingerprints.jaccard(text, edited)) < 0.2
        assert abs(got[doc].near_next - test_fingerprints.jaccard(text, following)) < 0.2


def test_passages_of_long_texts(docs, rows):
    got = sorted(map(tuple, substrings.remove_repeats(docs, window=13).collect()))
    assert got == sorted(test_substrings.brute(rows, 13))
    assert got[4][2] == 50_000


def test_scores_of_long_texts(docs, rows):
    got = bilinear.score(docs, F.col("doc_id") == 30).collect()
    test_bilinear.check(got, rows)
    assert all(-10 * r.n_tokens < r.score < 0 for r in got)


def test_links_of_long_texts(docs, rows):
    got = similar.link(docs, 3, 90).drop("text_key", "component").collect()
    assert sorted(map(tuple, got)) == sorted(test_similar.brute(rows, 3, 90))
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}
