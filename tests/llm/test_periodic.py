import random

import numpy as np
import pytest

from pageloom.llm import periodic
from pageloom.llm.common import offsets

SCHEMA = "doc_id long, text string, runs int, DOC_ID string, lang string"


def brute(words):
    """Every run, by trying all lags at all places."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            m = 0
            while i + m + q < n and words[i + m] == words[i + m + q]:
                m += 1
            if m and m + q >= max(6, 4 * q):
                found.setdefault((i, m + q), q)
            i += m + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def odd_text(rng):
    words = [rng.choice("ab") for _ in range(rng.randrange(0, 60))]
    for _ in range(rng.randrange(0, 4)):
        block = [rng.choice("abcdefgh") for _ in range(rng.choice([1, 2, 3, 5, 9, 17, 40]))]
        loop = block * rng.randrange(1, 9)
        words += loop[: max(1, len(loop) - rng.randrange(0, 4))] + [rng.choice("abxyz") for _ in range(rng.randrange(0, 5))]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_many_documents_against_brute_force(seed):
    rng = random.Random(seed)
    texts = [odd_text(rng) for _ in range(60)]
    # one two-letter alphabet and blocks that hold the same grams several times
    texts += [list("abaab" * 9 + "b"), list("aabaaab" * 5), list("abcabd" * 8 + "abc"), ["a"] * 300, [], ["a"], list("ab" * 200 + "a" * 50)]
    bounds = offsets([len(t) for t in texts])
    number = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    got = periodic.runs(np.array([number[w] for t in texts for w in t], np.int64), bounds)
    want = [(s + bounds[i], n, q) for i, t in enumerate(texts) for s, n, q in brute(t)]
    assert sorted(map(tuple, got.tolist())) == sorted(want)


def test_seeds_on_a_covered_diagonal_are_not_extended_again(monkeypatch):
    calls = []
    plain = periodic.agreeing
    monkeypatch.setattr(periodic, "agreeing", lambda *a: calls.append(a) or plain(*a))
    found = periodic.runs(np.arange(50_000) % 7, np.array([0, 50_000]))
    assert found.tolist() == [[0, 50_000, 7]]
    assert len(calls) == 2  # to the right and to the left


def test_rows(spark):
    rng = random.Random(9)
    texts = [" ".join(odd_text(rng)) for _ in range(40)] + [None, "", " \n\t", "x y\n" * 6, "é\x0bé " * 9, "word " * 30_000]
    texts += [" ".join(f"w{i % 4001}" for i in range(40_000))]
    rows = list(enumerate(texts)) + [(None, "a " * 8), (3, texts[3]), (3, texts[3])]
    docs = spark.createDataFrame([(i, t, 1, "y", "x") for i, t in rows], SCHEMA).repartition(3)
    got = periodic.collapse(docs, keep=("lang",)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    want = []
    for doc, text in rows:
        words = (text or "").split()
        found = [(0, 30_000, 1)] if doc == 45 else [(0, 40_000, 4001)] if doc == 46 else brute(words)
        want.append((doc, len(words), found, collapsed(words, found), "x"))
    assert sorted(((r[0], r[1], [tuple(x) for x in r[2]], r[3], r[4]) for r in got), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert periodic.collapse(empty).collect() == []
    assert periodic.with_looped_tails(empty).collect() == []


def test_looped_tails(spark):
    import zlib

    rows = [(i, " ".join(f"w{j}" for j in range(i % 37))) for i in range(400)] + [(None, "a b"), (17, None)]
    got = periodic.with_looped_tails(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    looped = 0
    for (doc, text), row in zip(rows, got, strict=True):
        words, h = (text or "").split(), zlib.crc32(str(doc).encode())
        if doc is not None and h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            looped += 1
            text = " ".join(words)
        assert (row.doc_id, row.text) == (doc, text)
    assert looped > 20
