"""Every stage against a brute-force version on its own input."""

from collections import Counter

import pytest

import corpus_pipeline
from pageloom.llm import quality, similar
from pageloom.llm.queries import quality_model, table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "lang", "n_chars", "source", "text"]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """What each stage reads, and what the last returns."""
    docs = table(spark, SF, "documents")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns(inputs):
    assert all(sorted(df.columns) == COLUMNS for df in inputs[:-1])


def test_rejected_documents_go(spark, inputs):
    scores = quality.score(inputs[0], quality_model(inputs[0], table(spark, SF, "labels"))).collect()
    want = {r.doc_id for r in scores if r.score >= 0.3}
    assert {r.doc_id for r in inputs[1].collect()} == want and len(want) > 100


def test_one_of_each_group_stays(inputs):
    rows = {r.doc_id: similar.shingles(r.text.encode(), 5) for r in inputs[1].collect()}
    group = {i: i for i in rows}
    for i in sorted(rows):
        for j in rows:
            common = len(rows[i] & rows[j])
            if group[i] != group[j] and rows[i] and rows[j] and 100 * common >= 80 * (len(rows[i]) + len(rows[j]) - common):
                a, b = sorted((group[i], group[j]))
                group = {k: a if g == b else g for k, g in group.items()}
    assert {r.doc_id for r in inputs[2].collect()} == set(group.values())


def test_repeated_passages_go(inputs):
    raw = {r.doc_id: r.text.encode() for r in inputs[2].collect()}
    times = Counter(t[i : i + 400] for t in raw.values() for i in range(len(t) - 399))
    for r in inputs[3].collect():
        t = raw[r.doc_id]
        off = bytearray(len(t))
        for i in range(len(t) - 399):
            if times[t[i : i + 400]] > 1:
                off[i : i + 400] = b"\1" * 400
        assert r.text == bytes(b for b, o in zip(t, off, strict=True) if not o).decode(errors="ignore") and r.n_chars == len(r.text)
    assert inputs[3].count() == len(raw)


def test_every_document_is_packed(inputs):
    assert {r.doc_id for r in inputs[4].collect()} == {r.doc_id for r in inputs[3].collect()}


def test_run(spark, inputs):
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, inputs[4].collect()))


def test_odd_rows(spark):
    rows = [(1, "a b c d e f", "en"), (1, "a b c d e f", "en"), (2, None, None), (None, "a b c d e f", "en"), (3, "", "x"), (3, "", "x")]
    docs = spark.createDataFrame([(i, t, g, None, 0) for i, t, g in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = similar.keep_one(docs, 5, 80).collect()
    assert sorted(((r.doc_id or 0), r.text or "") for r in kept) == [(1, "a b c d e f"), (2, ""), (3, ""), (3, "")]
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).collect()
        assert stage(spark, docs.where("false"), SF).collect() == []
