import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pageloom.llm import suffixes

SCHEMA = "doc_id long, text string, bucket int, TEXT string"


def brute(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    times = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for (doc, _), r in zip(rows, raw, strict=True):
        off = [False] * len(r)
        for i in range(len(r) - length + 1):
            if times[r[i : i + length]] > 1:
                off[i : i + length] = [True] * length
        runs = sum(o and not (i and off[i - 1]) for i, o in enumerate(off))
        out.append((doc, len(r), sum(off), runs, bytes(b for b, o in zip(r, off, strict=True) if not o)))
    return out


def documents(seed, letters):
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [prose(rng.choice([39, 40, 41, 70, 130])) for _ in range(6)] + ["ab" * 40, "a" * 60]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages)[rng.choice([0, 0, 3]) :] if rng.random() < 0.5 else prose(rng.randint(1, 80)) for _ in range(rng.randint(1, 5))]
        rows.append((i, "".join(parts)))
    near = prose(150)
    rows += [(100 + i, near[:i] + "#" + near[i:]) for i in range(0, 150, 9)]
    return rows + [rows[0], (rows[1][0], rows[2][1]), (None, rows[3][1]), (None, prose(90)), (900, None), (901, "")]


@pytest.mark.parametrize(("seed", "letters", "group"), [(1, "abcdefgh é", 2000), (2, "ab", 2000), (3, "abcdefghij", 3)])
def test_against_brute_force(spark, monkeypatch, seed, letters, group):
    monkeypatch.setattr(suffixes, "GROUP", group)
    rows = documents(seed, letters)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(3)
    got = suffixes.remove_repeats(docs, length=40).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    found = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got]
    assert sorted(found, key=key) == sorted(brute(rows, 40), key=key)


def test_sorting():
    rng = random.Random(4)
    for _ in range(60):
        start = bytes(rng.choice(b"ab\0") for _ in range(rng.choice([0, 70, 200])))
        strings = [start[: rng.choice([len(start), 65])] + bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 80))]
        assert [strings[i] for i in suffixes.deep_shallow(strings)] == sorted(strings)


def test_empty_table(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def chunk(texts):
    n = len(texts)
    return suffixes.Bytes(pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int64())], ["doc_id", "text_key"]), texts)


@pytest.mark.parametrize("slab", [1, 7, 64, 1000])
def test_slabs_give_the_same_anchors(monkeypatch, slab):
    rng = random.Random(slab)
    texts = [bytes(rng.choice(b"ab ") for _ in range(rng.choice([0, 3, 19, 20, 21, 90, 400]))) for _ in range(30)]
    whole = chunk(texts).anchors(20)
    monkeypatch.setattr(suffixes, "SLAB", slab)
    for a, b in zip(chunk(texts).anchors(20), whole, strict=True):
        assert a.tolist() == b.tolist()


def test_a_chunk_of_short_texts_has_no_anchors():
    assert [len(x) for x in chunk([b"abc" * 5] * 20).anchors(20)] == [0] * 4


def test_anchors_of_a_chunk_take_little_memory():
    full = chunk([np.random.default_rng(i).integers(97, 123, 1 << 16, np.uint8).tobytes() for i in range(32)])
    tracemalloc.start()
    try:
        assert len(full.anchors(400)[0])
        assert tracemalloc.get_traced_memory()[1] < 32 << 20  # of a chunk of 2 MB; all at once it was 155 MB
    finally:
        tracemalloc.stop()
