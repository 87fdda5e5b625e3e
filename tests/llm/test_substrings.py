import random

import numpy as np
import pytest

from pageloom.llm import common, substrings

SCHEMA = "doc_id long, text string, bucket int, TEXT string"


def brute(rows, window):
    seen = {}
    split = [(t or "").split(" ") if t else [] for _, t in rows]
    for (doc, _), words in zip(rows, split, strict=True):
        for p in range(len(words) - window + 1 if doc is not None else 0):
            key = tuple(words[p : p + window])
            seen[key] = min(seen.get(key, doc), doc)
    out = []
    for (doc, _), words in zip(rows, split, strict=True):
        off = set()
        for p in range(len(words) - window + 1 if doc is not None else 0):
            if seen[tuple(words[p : p + window])] < doc:
                off.update(range(p, p + window))
        out.append((doc, len(words), len(off), " ".join(w for i, w in enumerate(words) if i not in off)))
    return out


def documents(rng):
    vocabulary = ["a", "b", "é", "word", "|"] + [f"w{i}" for i in range(60)]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([12, 13, 14, 30]))) for _ in range(6)]
    passages += ["a " * 40 + "b", "a b " * 20 + "a", "b"]
    rows = []
    for i in range(80):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 15))) for _ in range(rng.randint(1, 6))]
        rows.append((rng.randint(0, 10**12) if rng.random() < 0.5 else i, " ".join(" ".join(parts).split())))
    rows += [rows[0], rows[1], (rows[2][0], rows[3][1]), (None, rows[0][1]), (900, None), (901, "")]
    return rows


@pytest.mark.parametrize("chunk", [300, 1 << 20])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(common.chunks, "__defaults__", (chunk,))
    rows = documents(random.Random(chunk))
    got = substrings.remove_repeats(spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(3), window=13).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, 13), key=key)


def test_symbols_of_a_passage_are_the_same_everywhere():
    rng = np.random.default_rng(5)
    for _ in range(50):
        passage = rng.integers(1, rng.choice([3, 9, 50]), 40).astype(np.uint64)
        seen = []
        for _ in range(2):
            before, after = rng.integers(1, 9, rng.integers(0, 30)), rng.integers(1, 9, rng.integers(0, 30))
            words = np.r_[before.astype(np.uint64), passage, after.astype(np.uint64)]
            names, first, last = substrings.recompress(words, np.zeros(len(words), np.int64))
            at = len(before)
            inside = (first >= at) & (last <= at + len(passage))
            seen.append(sorted(zip(names[inside].tolist(), (first[inside] - at).tolist(), (last[inside] - at).tolist(), strict=True)))
        assert seen[0] == seen[1]


def test_empty_table(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
