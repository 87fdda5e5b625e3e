import numpy as np
import pytest

from pageloom.llm import whitening
from pageloom.llm.queries import QUERIES, table

SCHEMA = "vec_id long, embedding array<float>, label int, VEC_ID string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA).repartition(5)


def on_grid(vectors):
    return np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000


def compare(got, ids, vectors, components, weights=None):
    """Rows of whiten against numpy over all rows; weights: of each row in the fit, one by default."""
    x = on_grid(vectors)
    weights = np.ones(len(x), np.int64) if weights is None else weights
    n, sums = int(weights.sum()), (x * weights[:, None]).sum(0)
    centred = x - sums / n
    covariance = (centred * weights[:, None]).T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    assert sorted(r.vec_id for r in got) == sorted(ids)
    where = {}
    for i, v in zip(ids, x, strict=True):
        where.setdefault(i, []).append(v)
    signs = None
    for r in sorted(got, key=lambda r: r.vec_id):
        v = where[r.vec_id][0]
        assert r.n == n
        assert r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums, strict=True))
        want = (v - sums / n) @ axes / np.sqrt(values)
        signs = np.sign(want * np.array(r.whitened)) if signs is None else signs
        assert np.allclose(np.array(r.whitened) * signs, want, atol=1e-7)
        assert np.allclose(r.explained, values / np.trace(covariance), rtol=1e-9)
        assert r.identity_error < 1e-8


def test_against_numpy_with_copies(spark):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(9, 9))
    rows = [(i, (rng.normal(size=9) @ mix).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # a hot vector
    odd = [(500, None), (501, [1.0, None]), (502, [float("nan")] * 9), (503, [float("inf")] * 9)]
    got = whitening.whiten(frame(spark, rows + odd), components=6).collect()
    compare(got, [i for i, _ in rows], [v for _, v in rows], 6)


def test_weights_of_one(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(60)]
    copies = [(100 + i, rows[0][1]) for i in range(50)]
    got = whitening.whiten(frame(spark, rows + copies), weights="one").collect()
    first = [r for r in got if r.vec_id < 100]
    compare(first, [i for i, _ in rows], [v for _, v in rows], 4)
    assert {r.deviation for r in got if r.vec_id >= 100} == {next(r.deviation for r in got if r.vec_id == 0)}
    with pytest.raises(ValueError, match="weights"):
        whitening.whiten(frame(spark, rows), weights="two")


def test_odd_rows(spark):
    short = [(1, [0.5, 1.0]), (2, [0.25]), (3, []), (None, [3.0, -1.0]), (1, [0.5, 1.0]), (4, [1e30, 0.0])]
    got = whitening.whiten(frame(spark, short)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, len(r.whitened)) for r in got) == [(False, 1, 2), (False, 1, 2), (False, 2, 2), (False, 3, 2), (False, 4, 2), (True, 0, 2)]
    assert len({str(r.whitened) for r in got if r.vec_id == 1}) == 1
    # as many components as there is variance: the others are null
    flat = [(i, [float(i), 2.0 * i, 7.0]) for i in range(20)]
    for r in whitening.whiten(frame(spark, flat)).collect():
        assert r.whitened[0] is not None and r.whitened[1:] == [None, None]
        assert abs(r.explained[0] - 1) < 1e-12 and r.identity_error < 1e-9
    same = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(0, [None, None], [0.0, 0.0], None)] * 2
    for rows in ([], [(1, None)], [(1, [])]):
        assert whitening.whiten(frame(spark, rows)).collect() == []


def test_deviations_beyond_a_long_are_null(spark):
    rows = [(i, [float(2**24 if i % 2 else -(2**24))]) for i in range(2000)]
    assert {r.deviation for r in whitening.whiten(frame(spark, rows)).collect()} == {None}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = sorted((r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect())
    got = QUERIES["op12_weighted_whitening"](spark, sf).collect()
    assert len(got) == 32 * len(rows)
    by_id = {}
    for r in sorted(got, key=lambda r: (r.vec_id, r.component)):
        by_id.setdefault(r.vec_id, []).append(r)
    x = np.array([[r.whitened for r in by_id[i]] for i, _ in rows])
    assert np.abs(x.T @ x / len(x) - np.eye(32)).max() < 1e-8
    grid = on_grid([v for _, v in rows])
    n, sums = len(grid), grid.sum(0)
    assert [by_id[i][0].deviation for i, _ in rows] == ((n * grid - sums) ** 2).sum(1).tolist()
    values = np.linalg.eigvalsh(np.cov(grid.T, bias=True))[::-1]
    assert np.allclose([r.explained for r in by_id[0]], (values / values.sum())[:32], rtol=1e-9)
