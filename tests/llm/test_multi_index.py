import numpy as np
import pytest

from pageloom.llm import multi_index
from pageloom.llm.queries import QUERIES, table

SCHEMA = "vec_id long, embedding array<float>, label int, VEC_ID string, ids string"


def exact(rows, asked, k=5):
    ids = np.array([i for i, _ in rows])
    size = max(len(v) for _, v in rows)
    x = np.array([[*v, *[0] * (size - len(v))] for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in asked:
        scores = x @ x[list(ids).index(i)]
        order = [j for j in np.lexsort((ids, -np.round(scores, 12))) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), scores[j]) for j in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=7).astype(np.float32).tolist()) for i in range(0, 300)]
    rows += [(1000 + i, rows[50][1]) for i in range(20)] + [(2000, rows[3][1][:4])]
    odd = [(None, [1.0]), (500, None), (501, []), (502, [0.0, 0.0]), (503, [1.0, None]), (504, [float("nan"), 1.0]), (550, [float("inf")])]
    data = [(i, v, 0, "x", "y") for i, v in rows + odd + rows[:3]]
    vectors = spark.createDataFrame(data, SCHEMA)
    queries = spark.createDataFrame([r for r in data if r[0] is not None and r[0] % 50 == 0], SCHEMA)
    got = answers(multi_index.nearest(vectors, queries))
    asked = [i for i, _ in rows if i % 50 == 0]
    want = exact(rows, asked)
    assert sorted(got) == sorted(asked)
    for i in asked:
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]]
        assert np.allclose([s for _, s in got[i]], [s for _, s in want[i]], atol=1e-12)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(1, [1.0]), (2, [2.0])]])
def test_few_rows(spark, rows):
    vectors = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    queries = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows if i % 50 == 0], SCHEMA)
    assert multi_index.nearest(vectors, queries).collect() == []


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    asked = [i for i, _ in rows if i % 50 == 0]
    got, want = answers(QUERIES["op1_multi_index"](spark, sf)), exact(rows, asked)
    assert sorted(got) == sorted(want)
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in asked)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_cells_come_in_the_order_of_their_distance():
    rng = np.random.default_rng(2)
    left, right = rng.random(6), rng.random(6)
    sizes = rng.integers(0, 3, 36)
    cells = multi_index.traverse(left, right, sizes, 10**9)
    total = (left[:, None] + right).ravel()
    assert cells == [c for c in total.argsort() if sizes[c]]


def test_vectors_that_share_an_id(spark):
    rng = np.random.default_rng(3)
    near = [1.0, 0, 0, 0, 0, 0]
    rows = [(0, (near + rng.normal(0, 0.01, 6)).astype(np.float32).tolist()) for _ in range(12)]
    rows += [(0, [0.0, 0.0, 0.0, 0.0, 0.0, 1.0])] + [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(1, 40)]
    rows += [(50, rows[0][1]), (51, rows[0][1])]
    vectors = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.array([i for i, _ in rows])
    for asked in (rows[0], rows[-1]):  # each alone: both have the query's own id or another one among the nearest many times
        queries = spark.createDataFrame([(*asked, 0, "x", "y")], SCHEMA)
        scores = x @ (np.array(asked[1], float) / np.linalg.norm(asked[1]))
        want = [(int(ids[j]), scores[j]) for j in np.lexsort((ids, -np.round(scores, 12))) if ids[j] != asked[0]][:5]
        got = answers(multi_index.nearest(vectors, queries))[asked[0]]
        assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([s for _, s in got], [s for _, s in want], atol=1e-12)
    # two vectors of one id: each has answers of its own
    queries = spark.createDataFrame([(*r, 0, "x", "y") for r in (rows[0], rows[12])], SCHEMA)
    got = sorted((round(r.score, 9), r.vec_id) for r in multi_index.nearest(vectors, queries).collect())
    want = []
    for at in (0, 12):
        scores = x @ x[at]
        want += [(round(scores[j], 9), int(ids[j])) for j in np.lexsort((ids, -np.round(scores, 12))) if ids[j] != 0][:5]
    assert got == sorted(want)
