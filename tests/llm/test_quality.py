import numpy as np

from pageloom.llm import quality
from pageloom.llm.queries import QUERIES, table

DOCS, LABELS = "doc_id long, text string, score int, TEXT string", "doc_id long, label int, DOC_ID string"


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op8_attention_quality"](spark, sf).collect()
    assert len(rows) == table(spark, sf, "documents").count()
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    held = [(r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, q, _ in held if q == k] for k in (1, 0))
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.99
    assert np.mean([p == q for _, q, p in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    x, passages, labels = rng.normal(size=(9, 5)), np.array([2, 1, 6]), np.array([1.0, 0.0, 1.0])
    model = quality.Model(np.zeros(5), np.ones(5), hidden=4, gate=3)
    model.p = {k: v.astype(float) for k, v in model.p.items()}
    bags = quality.Bags(passages)

    def loss():
        s = quality.sigmoid(model.forward(x, bags)[-1])
        return -np.mean(labels * np.log(s) + (1 - labels) * np.log(1 - s))

    grads = model.gradients(x, bags, labels)
    for k, v in model.p.items():
        for i in np.ndindex(v.shape):
            old = v[i]
            v[i] = old + 1e-5
            up = loss()
            v[i] = old - 1e-5
            down = loss()
            v[i] = old
            assert abs((up - down) / 2e-5 - grads[k][i]) < 1e-6


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1, "x"), (2, "", 1, "x"), (None, "a b", 1, "x"), (1, "é" * 3000, 1, "x"), (1, None, 1, "x")], DOCS)
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (None, 1, "x"), (2, None, "x"), (7, 0, "x")], LABELS)
    got = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not r.text}) == 1
    none = quality.train(docs, labels.where("false"))
    assert none is None and {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.where("false"), none).collect() == []
    assert quality.train(docs.where("false"), labels) is None


def test_passages_of_texts():
    x, passages = quality.features([b"", b"a" * 512, b"a" * 513, b"ab ab"])
    assert passages.tolist() == [1, 1, 2, 1] and x.shape == (5, quality.FEATURES)
    alone = [quality.features([t])[0] for t in (b"", b"a" * 512, b"a" * 513, b"ab ab")]
    assert np.allclose(x, np.concatenate(alone))


def test_documents_are_learned_from_whole(spark, monkeypatch):
    rng = np.random.default_rng(1)
    words = ["the", "river", "went", "under", "a", "stone", "bridge", "and", "people", "walked"]

    def text(i, bad):
        clean = " ".join(rng.choice(words, 4000))[: 40 * quality.PASSAGE]
        return clean + ("%$#@ 0193 {}" * 200 if bad else " ".join(rng.choice(words, 480))[:2400])

    rows = [(i, text(i, i % 2), 1, "x") for i in range(160)]
    docs = spark.createDataFrame(rows, DOCS).repartition(8)
    labels = spark.createDataFrame([(i, 1 - i % 2, "x") for i in range(120)], LABELS)
    got = {r.doc_id: r.score for r in quality.score(docs, quality.train(docs, labels)).collect()}
    assert all((got[i] > 0.5) == (i % 2 == 0) for i in range(120, 160))

    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, passages, labels: seen.append((len(x), passages.tolist())))
    monkeypatch.setattr(quality, "SAMPLE_PASSAGES", 100)
    quality.train(docs, labels)
    whole = {len(quality.features([t.encode()])[0]) for _, t, *_ in rows}
    assert len(seen[0][1]) == 3 and set(seen[0][1]) <= whole and seen[0][0] == sum(seen[0][1])


def test_a_fraction_of_the_passages_comes_to_the_driver(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = ["the", "River", "went", "under", "a", "stone", "bridge,", "and", "people", "walked.", "1907"]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words, 300)), 1, "x") for i in range(200)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(200)], LABELS)
    came, fitted, to_arrow = [], [], type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda df: came.append(to_arrow(df)) or came[-1])
    monkeypatch.setattr(quality, "fit", lambda x, passages, labels: fitted.append((x, passages)))
    quality.train(docs, labels)
    x, passages = fitted[0]
    assert 2 * came[0].nbytes < x.nbytes and passages.sum() == len(x)
    # the same numbers as before they were deflated, in the order of the sample
    rows = {r.doc_id: r.text for r in docs.collect()}
    want, _ = quality.features([rows[p["doc_id"]].encode() for p in came[0].column("place").to_pylist()])
    assert (x == want).all()
