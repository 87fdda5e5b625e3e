import numpy as np
import pytest

from pageloom.llm import near_vectors
from pageloom.llm.queries import QUERIES, table

SCHEMA = "vec_id long, embedding array<float>, label int, VEC_ID string, name string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", "y") for i, v, k in rows], SCHEMA).repartition(5)


def brute(rows, cosine=0.98):
    """vec_id, n_links and component_id, rows in their order; vectors without null."""
    size = max((len(v) for _, v, _ in rows), default=0)
    x = np.zeros((len(rows), size))
    for i, (_, v, _) in enumerate(rows):
        x[i, : len(v)] = v
    norms = np.linalg.norm(x, axis=1)
    good = np.array([i is not None and k is not None for i, _, k in rows]) & (norms > 0) & np.isfinite(norms)
    x[good] /= norms[good, None]
    labels = np.array([-1 if k is None else k for _, _, k in rows])
    links = (x @ x.T >= cosine) & (labels[:, None] == labels) & good[:, None] & good
    np.fill_diagonal(links, False)
    least = list(range(len(rows)))
    todo = set(least)
    while todo:
        group, new = set(), {todo.pop()}
        while new:
            group |= new
            new = {int(j) for i in new for j in np.flatnonzero(links[i])} - group
        todo -= group
        ids = [rows[i][0] for i in group]
        for i in group:
            least[i] = min(ids) if None not in ids else None
    return [(r[0], int(links[i].sum()), least[i]) for i, r in enumerate(rows)]


def clustered(rng, groups=40, dims=16):
    rows = []
    for g in range(groups):
        centre = rng.normal(size=dims)
        for _ in range(rng.integers(1, 12)):
            rows.append((centre + rng.normal(scale=rng.choice([0.02, 0.1, 0.16]), size=dims)).astype(np.float32).tolist())
    rows += [rows[3]] * 30 + [(5 * np.array(rows[4])).tolist()] * 2
    ids = rng.permutation(10**6)[: len(rows)].tolist()
    return [(i, v, int(rng.integers(0, 2))) for i, v in zip(ids, rows, strict=True)]


def check(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == sorted(brute(rows), key=key)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("tiny_blocks", [False, True])
def test_against_brute_force(spark, monkeypatch, tiny_blocks):
    if tiny_blocks:  # many cells, blocks and groups of visitors
        monkeypatch.setattr(near_vectors, "CELL_ROWS", 4)
        monkeypatch.setattr(near_vectors, "BLOCK_ROWS", 7)
        monkeypatch.setattr(near_vectors, "VISITOR_ROWS", 5)
        monkeypatch.setattr(near_vectors, "RECALL", 1.0)
    rows = clustered(np.random.default_rng(4))
    rows += [(None, rows[0][1], 0), (77, rows[0][1], None), (78, [], 0), (79, [0.0] * 16, 0), (80, [float("nan")], 1), (81, [float("inf")], 1)]
    rows += rows[:4]
    check(near_vectors.link(frame(spark, rows), recall=near_vectors.RECALL).collect(), rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 0.0], 3)], [(1, None, 3), (2, [None, 1.0], 3)], [(5, [2.0], 1), (4, [1.0], 1), (4, [1.0], 2)]])
def test_few_rows(spark, rows):
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_vectors.link(frame(spark, rows)).collect())
    linked = len(rows) == 3
    assert got == ([(4, 0, 4, True), (4, 1, 4, True), (5, 1, 4, False)] if linked else [(r[0], 0, r[0], True) for r in rows])


def test_a_cosine_of_the_threshold_links(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [3.0, 4.0], 0)]
    got = near_vectors.link(frame(spark, rows), cosine=0.8).collect()
    assert sorted((r.vec_id, r.component_id) for r in got) == [(1, 1), (2, 2), (3, 2)]


def test_recall_of_the_query(spark):
    sf = "/root/testdata/check_s"
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, sf, "embeddings").collect()]
    want = {i: (n, c) for i, n, c in brute(rows)}
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op13_near_vectors"](spark, sf).collect()}
    assert got.keys() == want.keys()
    assert sum(n for n, _ in got.values()) >= 0.999 * sum(n for n, _ in want.values()) > 1000
    assert sum(got[i] == want[i] for i in want) >= 0.999 * len(want)
    assert all(got[i][0] <= want[i][0] for i in want)


def test_cells_come_in_the_order_of_their_cost_up_to_the_limit():
    rng = np.random.default_rng(2)
    left, right = rng.random(6), rng.random(7)
    total = (left[:, None] + right).ravel()
    for limit in (0.5, 1.0, 3.0):
        want = [c for c in total.argsort() if total[c] <= limit]
        if want:
            assert near_vectors.nearest_cells(left, right, limit) == want


def test_no_vector_is_nearer_than_the_least_distance():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(500, 8))
    half = near_vectors.Half(points, 12)
    least, own = half.least(points), half.nearest(points)
    far = ((points[:, None] - points[None]) ** 2).sum(2)
    assert (least[:, own] <= far + 1e-9).all()
