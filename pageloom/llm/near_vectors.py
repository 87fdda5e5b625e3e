"""Near copies among embeddings of one label, with an inverted multi-index (operator 13).

Vectors are cut into two halves, each quantised by a codebook of its own; pairs
of centroids are the cells of a product grid. Two vectors of one label link if
their cosine reaches a threshold. A vector visits the cells in the order of the
least distance that a vector there can have from it: in each half the distance
to the plane between the cell's centroid and its own, squared and summed. A heap
walks the two sorted lists (multi-sequence traversal), up to a distance at which
the target recall is reached; that distance is measured on SAMPLE_ROWS vectors
(those of the smallest hash) against copies of them that were moved to just the
threshold, in random directions and towards other vectors. All vectors are
indexed, all visit, and every pair met is verified by cosine in double precision.

* A pair is found if either vector visits the other's cell. A vector counts the
  links that it finds itself and is told of those that only the other finds.
* Equal vectors of a label are one entry with a number, so copies cost nothing.
* Cells lie in blocks of about BLOCK_ROWS entries, large ones in several, and a
  block's visitors are dealt into groups of about VISITOR_ROWS: what meets in a
  task is bounded. A task returns each entry's number of links, and links as a
  star for each group that is connected in it: rows grow with the entries and
  not with the pairs. A dense group of m different vectors in one cell is
  compared in slices, m^2 products, as the number of links asks for each of them.
* Components are found by rounds of joins over tables (large star, small star).

Vectors that are null, zero or hold null, NaN or infinite components, and rows
with a null label or vec_id, link with nothing: n_links is 0, component_id their
own vec_id and kept true. Shorter vectors are read as padded with zeros.
Repeated rows are vectors of their own and linked with each other; those that
share the smallest vec_id of a component are all kept. A cosine of exactly the
threshold links. An empty table gives an empty table. Other columns do no harm,
whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import joined_back, materialize, mixed, pick
from pageloom.llm.multi_index import codebook, distances, matrix, usable
from pageloom.llm.similar import components

COSINE = 0.98
RECALL = 0.9999
SAMPLE_ROWS = 16_384
#: Vectors for each cell on average, and centroids of a half at most.
CELL_ROWS, CENTROIDS = 512, 512
BLOCK_ROWS = 4096
VISITOR_ROWS = 16_384
#: Copies that are moved from each vector of the sample.
TRIALS = 4


class Half:
    """Codebook of one half of the vectors."""

    def __init__(self, points: np.ndarray, centroids: int):
        self.centres = codebook(points, centroids)
        apart = np.sqrt(np.maximum(((self.centres[:, None] - self.centres[None]) ** 2).sum(2), 0))
        self.apart = np.where(apart > 0, 2 * apart, np.inf)

    def nearest(self, points: np.ndarray) -> np.ndarray:
        return distances(points, self.centres).argmin(1)

    def least(self, points: np.ndarray) -> np.ndarray:
        """Least squared distance from each point to what is nearest to each centroid."""
        far = distances(points, self.centres)
        own = far.argmin(1)
        to_plane = np.maximum(far - far[np.arange(len(points)), own][:, None], 0) / self.apart[own]
        return to_plane**2


def nearest_cells(left: np.ndarray, right: np.ndarray, limit: float) -> list[int]:
    """Cells in the order of the sum of what their halves cost, up to a limit."""
    a, b = left.argsort(kind="stable"), right.argsort(kind="stable")
    a, b = a[left[a] <= limit], b[right[b] <= limit]
    dl, dr, ia, ib, n = left[a].tolist(), right[b].tolist(), a.tolist(), b.tolist(), len(right)
    heap, found = [(dl[0] + dr[0], 0, 0)], []
    while heap:
        cost, i, j = heapq.heappop(heap)
        if cost > limit:
            break
        found.append(ia[i] * n + ib[j])
        if j + 1 < len(dr):
            heapq.heappush(heap, (dl[i] + dr[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(dl):
            heapq.heappush(heap, (dl[i + 1] + dr[0], i + 1, 0))
    return found


def reach(points: np.ndarray, halves: tuple[Half, Half], cosine: float, recall: float) -> float:
    """The squared distance up to which cells are visited for a share of the pairs that are just near enough."""
    rng = np.random.default_rng(13)
    cut, most = points.shape[1] // 2, 0.0
    for directions in (lambda: rng.normal(size=points.shape), lambda: points[rng.permutation(len(points))]):
        needed = []
        for _ in range(TRIALS):
            z = directions()
            z = z - (z * points).sum(1, keepdims=True) * points
            long = np.sqrt((z**2).sum(1, keepdims=True))
            moved = cosine * points + np.sqrt(max(0.0, 1 - cosine**2)) * np.divide(z, long, where=long > 1e-9, out=np.zeros_like(z))
            costs = [h.least(points[:, s])[np.arange(len(points)), h.nearest(moved[:, s])] for h, s in zip(halves, (slice(0, cut), slice(cut, None)), strict=True)]
            needed.append(costs[0] + costs[1])
        most = max(most, float(np.quantile(np.concatenate(needed), recall)))
    return most


def joined_labels(labels: np.ndarray, hit: np.ndarray, own: np.ndarray) -> None:
    """Puts each visitor (a row of hits) and what it hits into one group; labels: group of each vertex, changed in place."""
    for row in np.flatnonzero(hit.any(1)).tolist():
        groups = np.unique(np.r_[labels[own[row]], labels[: hit.shape[1]][hit[row]]])
        if len(groups) > 1:
            labels[np.isin(labels, groups)] = groups[0]


def link(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row; vectors: vec_id, label, embedding."""
    rows = pick(vectors, vec_id="long", label="string", embedding="array<double>")
    part = usable() & F.col("label").isNotNull()
    alone = rows.where(~part).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    rows = rows.where(part)
    entries = rows.groupBy("label", "embedding").agg(F.count("*").alias("times"), F.min("vec_id").alias("first"))
    entries = materialize(entries.withColumn("name", F.monotonically_increasing_id()), "vectors")
    total, size = entries.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not total:
        return alone.withColumn("kept", F.lit(True))
    size = max(2, size)
    half = size // 2
    sample = entries.orderBy(F.xxhash64("embedding"), "embedding").limit(SAMPLE_ROWS).select("embedding").toArrow()
    points = matrix(sample.column("embedding").combine_chunks(), size)
    centroids = int(np.clip((total / CELL_ROWS) ** 0.5, 1, min(CENTROIDS, max(1, len(points) // 32))))
    halves = Half(points[:, :half], centroids), Half(points[:, half:], centroids)
    limit = reach(points, halves, cosine, recall)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
            x = matrix(batch.column("embedding"), size)
            left, right = halves[0].least(x[:, :half]), halves[1].least(x[:, half:])
            cell = halves[0].nearest(x[:, :half]) * centroids + halves[1].nearest(x[:, half:])
            visits = []
            for i in range(len(x)):
                found = np.array(nearest_cells(left[i], right[i], limit), np.int32)
                visits.append((found if cell[i] in found else np.r_[found, cell[i]].astype(np.int32)).tobytes())
            columns = [*map(batch.column, ("name", "label", "embedding", "times")), pa.array(cell.astype(np.int32)), pa.array(visits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["name", "label", "embedding", "times", "cell", "visits"])

    kinds = "name long, label string, embedding array<double>, times long, cell int, visits binary"
    indexed = materialize(entries.mapInArrow(placed, kinds), "cells")
    sizes = np.zeros(centroids**2, np.int64)  # at most CENTROIDS squared rows come to the driver
    for row in indexed.groupBy("cell").count().collect():
        sizes[row[0]] = row[1]
    parts = -(-sizes // BLOCK_ROWS)  # blocks of a large cell
    parts[parts <= 1] = 0
    filled = np.where(parts > 0, 0, sizes).cumsum() // BLOCK_ROWS  # small cells share blocks
    first = np.where(parts > 0, filled.max() + 1 + np.r_[0, parts.cumsum()[:-1]], filled)
    blocks = int((first + np.maximum(parts, 1)).max())

    def visited(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The cells with entries that a vector visits, by block; its blocks, and where each one's cells begin."""
        cells = np.frombuffer(blob, np.int32)
        cells = cells[sizes[cells] > 0]
        cells = cells[np.argsort(first[cells], kind="stable")]
        own, starts = np.unique(first[cells], return_index=True)
        return cells, own, starts

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(blocks, np.int64)
        for batch in batches:
            for blob in batch.column("visits").to_pylist():
                counts[visited(blob)[1]] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"block": pa.array(some), "visitors": pa.array(counts[some])})

    visitors = np.zeros(blocks, np.int64)  # one row for each block comes to the driver
    for row in indexed.select("visits").mapInArrow(counted, "block long, visitors long").groupBy("block").agg(F.sum("visitors")).collect():
        visitors[row[0]] = row[1]
    for cell in np.flatnonzero(parts):  # all blocks of a large cell have its visitors
        visitors[first[cell] : first[cell] + parts[cell]] = visitors[first[cell]]
    dealt = np.maximum(-(-visitors // VISITOR_ROWS), 1)  # groups of visitors of each block

    def hashed(names: np.ndarray) -> np.ndarray:
        return (mixed(names.astype(np.uint64)) >> np.uint64(1)).astype(np.int64)

    def sent(batch: pa.RecordBatch, taken: list[int], extra: dict[str, pa.Array]) -> pa.RecordBatch:
        out = batch.take(pa.array(taken, pa.int64()))
        return pa.RecordBatch.from_arrays([*out.columns, *extra.values()], [*batch.schema.names, *extra])

    def hosts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            cell, name = batch.column("cell").to_numpy(), hashed(batch.column("name").to_numpy())
            block = first[cell] + name % np.maximum(parts[cell], 1)
            taken = np.repeat(np.arange(len(cell)), dealt[block])
            group = np.arange(len(taken)) - np.repeat(np.r_[0, dealt[block].cumsum()[:-1]], dealt[block])
            for i in range(0, len(taken), 4096):
                some = slice(i, i + 4096)
                yield sent(batch, taken[some].tolist(), {"block": pa.array(block[taken[some]]), "visitor_group": pa.array(group[some])})

    def guests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            names = hashed(batch.column("name").to_numpy())
            taken, to, asked = [], [], []
            for i, blob in enumerate(batch.column("visits").to_pylist()):
                cells, own, starts = visited(blob)
                for block, mine in zip(own.tolist(), np.split(cells, starts[1:]), strict=True):
                    for p in range(max(1, int(parts[mine[0]]))):
                        taken.append(i)
                        to.append(block + p)
                        asked.append(mine.tobytes())
                if len(taken) >= 4096 or (taken and i + 1 == batch.num_rows):
                    block = np.array(to, np.int64)
                    group = names[taken] % dealt[block]
                    yield sent(batch.drop_columns(["visits"]), taken, {"asked": pa.array(asked, pa.binary()), "block": pa.array(block), "visitor_group": pa.array(group)})
                    taken, to, asked = [], [], []

    def verified(here: pa.Table, come: pa.Table) -> pa.Table:
        names = [t.column("name").to_numpy() for t in (here, come)]
        vertices, at = np.unique(np.concatenate(names), return_inverse=True)
        out = np.zeros(len(vertices), np.int64)
        linked = np.zeros(len(vertices), bool)
        labels = np.arange(here.num_rows + len(vertices))  # entries of the block, then all vertices
        if here.num_rows and come.num_rows:
            mine, theirs = at[: here.num_rows], at[here.num_rows :]
            x, q = (matrix(t.column("embedding").combine_chunks(), size) for t in (here, come))
            cells, cell = np.unique(here.column("cell").to_numpy(), return_inverse=True)
            others, other = np.unique(come.column("cell").to_numpy(), return_inverse=True)
            times, more = here.column("times").to_numpy(), come.column("times").to_numpy()
            goes = np.zeros((here.num_rows, len(others)), bool)  # which visitors' cells an entry visits itself
            for i, blob in enumerate(here.column("visits").to_pylist()):
                goes[i] = np.isin(others, np.frombuffer(blob, np.int32))
            asked = come.column("asked").to_pylist()
            labels[: here.num_rows] = here.num_rows + mine
            own = here.num_rows + theirs
            for start in range(0, len(q), 256):
                some = slice(start, start + 256)
                wanted = np.array([np.isin(cells, np.frombuffer(b, np.int32)) for b in asked[some]])
                hit = (q[some] @ x.T >= cosine) & wanted[:, cell] & (theirs[some][:, None] != mine[None])
                if not hit.any():
                    continue
                out[theirs[some]] += hit @ times
                told = hit & ~goes[:, other[some]].T
                np.add.at(out, mine, more[some] @ told)
                linked[theirs[some]] |= hit.any(1)
                linked[mine] |= hit.any(0)
                joined_labels(labels, hit, own[some])
        root = labels[here.num_rows :] - here.num_rows
        return pa.table({"name": pa.array(vertices[linked]), "n": pa.array(out[linked]), "root": pa.array(vertices[root[linked]])})

    keys = ["label", "block", "visitor_group"]
    inside = indexed.mapInArrow(hosts, f"{kinds}, block long, visitor_group long")
    visiting = indexed.mapInArrow(guests, "name long, label string, embedding array<double>, times long, cell int, asked binary, block long, visitor_group long")
    found = inside.groupBy(*keys).cogroup(visiting.groupBy(*keys)).applyInArrow(verified, "name long, n long, root long")
    found = materialize(found, "links")
    counts = found.groupBy("name").agg(F.sum("n").alias("n"))
    joined = components(found.select(F.col("name").alias("a"), F.col("root").alias("b")))
    groups = entries.join(counts, "name", "left").join(joined, entries["name"] == joined["node"], "left")
    n_links = F.coalesce("n", F.lit(0)) + F.col("times") - 1
    groups = groups.select("label", "embedding", "times", "first", n_links.alias("n_links"), F.coalesce("component", "name").alias("component"))
    groups = materialize(groups, "groups")
    smallest = groups.groupBy("component").agg(F.min("first").alias("component_id"))
    groups = groups.join(smallest, "component").select("label", "embedding", "times", "n_links", "component_id")
    n_rows = groups.agg(F.sum("times")).first()[0]
    done = joined_back(rows, groups, ["label", "embedding"], n_rows).select("vec_id", "n_links", "component_id")
    return done.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
