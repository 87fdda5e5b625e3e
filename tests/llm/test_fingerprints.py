import hashlib
import random

from pyspark.sql import functions as F

from pageloom.llm import fingerprints

SCHEMA = "doc_id long, text string, range int, TEXT string"


def shingles(text):
    words = text.encode().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_next_edited_and_likeness(spark):
    rng = random.Random(1)
    words = [f"w{i}é" for i in range(400)]
    texts = [" \n".join(rng.choice(words) for _ in range(rng.choice([0, 1, 4, 5, 30, 300, 2000]))) for _ in range(90)]
    for i in range(1, 90, 3):
        texts[i] = texts[i - 1]
    ids = rng.sample(range(-1000, 10**9), 90)
    rows = [*zip(ids, texts, strict=True), (5, None), (10**18, "a b")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA).repartition(5)
    got = {r.doc_id: r for r in fingerprints.compare_with_next(docs).withColumn("sha", F.sha2("edited", 256)).collect()}
    assert len(got) == len(rows)
    order = sorted((i, t or "") for i, t in rows)
    off = []
    for (i, text), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert (got[i].n_chars, got[i].edited) == (len(text), edited)
        assert got[i].sha == hashlib.sha256(edited.encode()).hexdigest()
        off += [got[i].near_edited - jaccard(text, edited), got[i].near_next - jaccard(text, following)]
        if text == following:
            assert got[i].near_next == 1.0
    assert [x for x in off if abs(x) >= 0.2] == []
    assert sum(map(abs, off)) / len(off) < 0.03
    assert abs(sum(off) / len(off)) < 0.01


def test_rows_without_order(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "d"), (None, "x y"), (None, "x y")]
    got = fingerprints.compare_with_next(spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.n_chars) for r in got) == [(False, 1), (False, 5), (False, 5), (True, 3), (True, 3)]
    assert all(r.edited_print is not None for r in got)
    alone = fingerprints.compare_with_next(spark.createDataFrame([(1, "a b c d", 1, "x")], SCHEMA)).first()
    assert (alone.edited, alone.near_next) == ("a b a b", 1.0)


def test_empty_texts_and_tables(spark):
    assert fingerprints.compare_with_next(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = fingerprints.compare_with_next(spark.createDataFrame([(1, "", 1, "x"), (2, "a", 1, "x")], SCHEMA)).collect()
    assert [(r.near_edited, r.near_next, r.print is None) for r in sorted(rows)] == [(1.0, 0.0, True), (1.0, 0.0, False)]


def test_fingerprints_as_text(spark):
    docs = spark.createDataFrame([("a b c d e f",), ("a  b\tc d e f ",), ("",)], "t string")
    got = [r[0] for r in docs.select(fingerprints.as_text(fingerprints.fingerprint(F.col("t")))).collect()]
    assert got[0] == got[1] and len(got[0]) == 256 and set(got[0]) <= set("0123456789abcdef") and got[2] == ""
