import random
import zlib

import numpy as np
import pytest

from pageloom.llm import bpe, packing
from pageloom.llm.queries import packed, tokenizer_path

SCHEMA = "doc_id long, text string, ids int, TEXT string"


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(tokenizer_path())


def library(coder, text):
    return coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_trees_of_small_leaves_give_the_library_s_tokens(coder):
    rng = random.Random(1)
    kinds = [
        ["a", "b", "the", "ing", "'s", "'", "''", "re", " ", "\n", "é", "é", "<|endoftext|>", "<|", "|>", "endoftext", "12", "中", "İ", "Σ"],
        ["a", "b", "c", "d", "the", "in"],
        ["'", "s", "re", "!", "<|endoftext|>", "<", "|", ">"],
    ]
    for _ in range(300):
        text = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(1, 300)))
        assert coder.tree(text, rng.choice([3, 10, 40]))[0].tolist() == library(coder, text)
        ids, at = coder.texts([text.encode(), b"", text.encode()])
        assert ids[at[2] :].tolist() == library(coder, text)


def test_long_documents_are_cut_and_joined(spark, coder):
    rng = random.Random(2)
    unsplit = "".join(rng.choice("abcdefghié") for _ in range(5000))
    spaced = " ".join("".join(rng.choice("abcd,.") for _ in range(rng.randint(1, 9))) for _ in range(900))
    rows = [(1, unsplit), (2, spaced), (2, spaced), (None, spaced + " x"), (3, None), (4, ""), (5, "Hello WORLD<|endoftext|>")]
    docs = spark.createDataFrame([(i, t, 7, "other") for i, t in rows], SCHEMA)
    got = bpe.encode(docs, tokenizer_path(), decode=True, piece_chars=700).collect()
    want = [library(coder, t or "") for _, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in got), key=key) == sorted(
        ((i, np.array(w, "<u4").tobytes(), coder.tokenizer.decode(w, skip_special_tokens=False)) for (i, _), w in zip(rows, want, strict=True)), key=key
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert bpe.encode(docs, tokenizer_path()).collect() == []
    assert packed(docs).collect() == []


def test_fullest_combination():
    assert sorted(packing.fullest([(7, 1), (5, 2), (4, 1)], 10)) == [(5, 2)]
    assert packing.fullest([(7, 1)], 5) == []
    assert sum(k * n for k, n in packing.fullest([(6, 3), (4, 1), (3, 1)], 15)) == 15


def test_fill_uses_every_piece_once():
    rng = random.Random(3)
    for _ in range(30):
        counts = {rng.randint(1, 60): rng.randint(1, 40) for _ in range(rng.randint(1, 30))}
        used = {}
        for combo, times in packing.fill(counts, 60):
            assert times > 0 and sum(k * n for k, n in combo) <= 60
            for k, n in combo:
                used[k] = used.get(k, 0) + n * times
        assert used == counts


def test_packed_pieces_are_whole_and_gapless(spark, coder):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["one", "two", "three", "zz9"]) for _ in range(rng.choice([0, 3, 50, 900, 9000]))) for _ in range(120)]
    rows = [*enumerate(texts), (200, None), (None, "a"), (3, texts[3])]
    got = packed(spark.createDataFrame([(i, t, 7, "other") for i, t in rows], SCHEMA)).collect()
    want = []
    for i, t in rows:
        ids = np.array([*library(coder, t or ""), 1], "<u4")
        want += [(i, p, s, len(x), zlib.crc32(x.tobytes())) for p, s in enumerate(range(0, len(ids), 4096)) for x in [ids[s : s + 4096]]]
    key = lambda r: (r[0] is None, *(x or 0 for x in r))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    bins = []  # first fit, longest first
    for length in sorted((w[3] for w in want), reverse=True):
        at = next((i for i, free in enumerate(bins) if free >= length), None)
        if at is None:
            bins.append(4096 - length)
        else:
            bins[at] -= length
    assert len(by) <= len(bins)
