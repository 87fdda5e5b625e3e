import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.llm import bilinear
from pageloom.llm.queries import QUERIES, table

SCHEMA = "doc_id long, text string, chunk int, TEXT string"


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def base(rows):
    counts = Counter(t for doc, text in rows if doc is None or zlib.crc32(str(doc).encode()) % 10 for t in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    score = lambda text: sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in tokens(text))
    return [(doc, len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), total, score(x)) for doc, x in rows]


def check(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    want = sorted(base(rows), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-12)


def test_better_than_frequencies_on_held_out_texts(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op5_log_bilinear"](spark, sf).collect()
    check(got, [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()])
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in got)
    n = sum(r.n_tokens for r in held)
    model, plain = sum(r.score for r in held) / n, sum(r.base_score for r in held) / n
    assert model > plain + 0.1, (model, plain)


def test_odd_rows(spark):
    rows = [(1, "A a b"), (1, "A a b"), (2, None), (3, ""), (None, "a b c"), (10, "zzz é"), (15, " \n"), (1, "other")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    got = bilinear.score(docs, F.crc32(F.col("doc_id").cast("string")) % 10 == 0).collect()
    check(got, rows)
    assert all(-1000 < r.score < 0 for r in got)
    none = bilinear.score(docs, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known) for r in none} == {(0, 0)} and all(abs(r.score) + abs(r.base_score) < 1e-5 for r in none)
    assert bilinear.score(docs.where("false"), F.lit(True)).collect() == []


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    classes = bilinear.Classes(np.arange(5, dtype=np.uint64))
    model = bilinear.Model(rng.random(classes.number) / classes.number)
    everything = np.arange(classes.number)
    for one, two in ((0, 3), (classes.start, classes.start), (7, classes.start)):
        own, unseen = model.log_probabilities(everything, np.full(len(everything), one), np.full(len(everything), two), np.full(classes.number, 0.25, np.float32))
        assert np.exp(own).sum() == pytest.approx(1, abs=1e-5)
        assert np.exp(unseen) == pytest.approx(0.25, abs=1e-5)
