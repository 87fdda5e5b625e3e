"""Nearest neighbours with an inverted multi-index (operator 1).

Vectors are cut into two halves and each half is quantised by a codebook of its
own; a pair of centroids is a cell. A query walks the pairs in the order of
their summed distances with a heap until the cells hold enough vectors, and
those are compared exactly, by cosine in double precision.

* The codebooks are fitted on SAMPLE_ROWS vectors at most (those with the
  smallest hash of their id); every vector is indexed.
* Cells lie in blocks of about BLOCK_ROWS vectors, large cells in several; a
  query goes to the blocks of its cells. Queries, too, are dealt into groups of
  BLOCK_ROWS, so that what meets in a task is bounded. The pairs of a block and
  a group are matrix products.
* Ids can repeat among the nearest, the query's own as well. Of each id the k
  best are kept, and of those the 2 k best: without any one id k are left.
* Equal vectors are one entry with the k + 1 smallest ids: no others can be
  among anyone's k nearest, as ties go to the smaller id.

Rows take part if vec_id is not null and the vector is not null, has no null,
NaN or infinite component and is not zero. Shorter vectors are read as padded
with zeros. Rows that are repeated count once; rows that share a vec_id are
candidates of their own, but never of a query with that vec_id. Empty tables
and tables without queries give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.common import materialize, pick

SAMPLE_ROWS = 10_000
CENTROIDS = 128
BLOCK_ROWS = 8192
#: Share of all vectors that a query is compared with, and the least number.
#: 0.35 gives a recall of about 0.95 of 5 on vectors that are nearly noise; clustered ones need far less.
SHARE = 0.35
LEAST = 512


def codebook(points: np.ndarray, centroids: int, rounds: int = 12) -> np.ndarray:
    """k-means from points spread over the sample."""
    centres = points[np.linspace(0, len(points) - 1, centroids).astype(int)].copy()
    for _ in range(rounds):
        nearest = quantised(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=centroids)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, without the points' own part."""
    return (centres**2).sum(1) - 2 * points @ centres.T


def quantised(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return distances(points, centres).argmin(1)


def traverse(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells with vectors, nearest first, until they hold enough; sizes: vectors of each cell."""
    a, b = left.argsort(kind="stable"), right.argsort(kind="stable")
    dl, dr, ia, ib, n = left[a].tolist(), right[b].tolist(), a.tolist(), b.tolist(), len(right)
    heap, found, held = [(dl[0] + dr[0], 0, 0)], [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = ia[i] * n + ib[j]
        if sizes[cell]:
            found.append(cell)
            held += sizes[cell]
        if j + 1 < n:
            heapq.heappush(heap, (dl[i] + dr[j + 1], i, j + 1))
        if j == 0 and i + 1 < n:
            heapq.heappush(heap, (dl[i + 1] + dr[0], i + 1, 0))
    return found


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Unit vectors, padded with zeros to a size."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy()[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    out = np.zeros((len(lengths), size))
    out[np.arange(size) < lengths[:, None]] = values
    # scaled first, so that no square is too large or too small
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out**2).sum(1, keepdims=True))


def needed(scores: np.ndarray, first: np.ndarray, ends: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Entries that hold the 2 k best rows if of each id only the k best count, best first.

    first: first id of each entry; ids: those of all entries, up to ends.
    """
    size = 4 * k
    while True:
        size = min(size, len(scores))
        order = np.flatnonzero(scores >= np.partition(scores, -size)[-size])
        order = order[scores[order] > -np.inf]
        order = order[np.lexsort((first[order], -scores[order]))]
        kept, times, whole = [], {}, 0  # whole: entries whose first id counts
        for e in order.tolist():
            if whole >= 2 * k or (len(kept) >= 2 * k and scores[e] < scores[kept[2 * k - 1]]):
                return np.array(kept, np.int64)
            mine = ids[ends[e] : ends[e + 1]].tolist()
            if any(times.get(i, 0) < k for i in mine):
                kept.append(e)
                whole += times.get(mine[0], 0) < k
                for i in mine:
                    times[i] = times.get(i, 0) + 1
        if size == len(scores):
            return np.array(kept, np.int64)
        size *= 4


def usable() -> Column:
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col("vec_id").isNotNull() & F.coalesce(whole, F.lit(False)) & F.exists("embedding", lambda x: x != 0)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, share: float = SHARE) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found of each query.

    vectors and queries: vec_id, embedding.
    """
    vectors = pick(vectors, vec_id="long", embedding="array<double>").where(usable())
    queries = pick(queries, vec_id="long", embedding="array<double>").where(usable()).dropDuplicates(["vec_id", "embedding"])
    by_vector = Window.partitionBy("embedding").orderBy("vec_id")
    entries = vectors.withColumn("place", F.dense_rank().over(by_vector)).where(F.col("place") <= k + 1)
    entries = entries.groupBy("embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    entries = materialize(entries, "vectors")
    sample = entries.orderBy(F.xxhash64("ids"), "ids").limit(SAMPLE_ROWS).select("embedding").toArrow()
    asked = materialize(queries.groupBy("embedding").agg(F.min("vec_id").alias("id")).select("embedding", F.xxhash64("embedding", "id").alias("asked")), "queries")
    none = "query_id long, rank int, vec_id long, score double"
    total, queried = entries.count(), asked.count()
    if not total or not queried:
        return vectors.sparkSession.createDataFrame([], none)
    size = max(2, *(t.agg(F.max(F.size("embedding"))).first()[0] for t in (entries, asked)))
    half = size // 2
    points = matrix(sample.column("embedding").combine_chunks(), size)
    centroids = max(1, min(CENTROIDS, len(points) // 8))
    left, right = codebook(points[:, :half], centroids), codebook(points[:, half:], centroids)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("embedding"), size)
                cell = quantised(x[:, :half], left) * centroids + quantised(x[:, half:], right)
                yield batch.append_column("cell", pa.array(cell.astype(np.int32)))

    indexed = materialize(entries.mapInArrow(placed, "embedding array<double>, ids array<long>, cell int"), "cells")
    sizes = np.zeros(centroids**2, np.int64)  # at most CENTROIDS squared rows come to the driver
    for row in indexed.groupBy("cell").count().collect():
        sizes[row[0]] = row[1]
    parts = -(-sizes // BLOCK_ROWS)  # blocks of a large cell
    parts[parts <= 1] = 0
    filled = np.where(parts > 0, 0, sizes).cumsum() // BLOCK_ROWS  # small cells share blocks
    first = np.where(parts > 0, filled.max() + 1 + np.r_[0, parts.cumsum()[:-1]], filled)
    enough, groups = max(LEAST, int(share * total)), -(-queried // BLOCK_ROWS)

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            ids = batch.column("ids")
            one = ids.values.to_numpy()[ids.offsets.to_numpy()[:-1]]
            block = first[cell] + one % np.maximum(parts[cell], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block.astype(np.int64))], [*batch.schema.names, "block"])

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("embedding"), size)
            near = distances(x[:, :half], left), distances(x[:, half:], right)
            rows, blocks, cells = [], [], []
            for i in range(len(x)):
                found = np.array(traverse(near[0][i], near[1][i], sizes, enough), np.int32)
                for block in np.unique(first[found]):
                    mine = found[first[found] == block]
                    for part in range(max(1, parts[mine[0]])):
                        rows.append(i)
                        blocks.append(block + part)
                        cells.append(mine.tobytes())
                if rows and (len(rows) >= 4096 or i + 1 == len(x)):
                    taken = batch.take(pa.array(rows))
                    group = taken.column("asked").to_numpy() % groups
                    columns = [*taken.columns, pa.array(blocks, pa.int64()), pa.array(cells, pa.binary()), pa.array(group.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "block", "cells", "query_group"])
                    rows, blocks, cells = [], [], []

    def compared(entries: pa.Table, asked: pa.Table) -> pa.Table:
        rows, at, scores = [], [], []
        if entries.num_rows and asked.num_rows:
            x, q = (matrix(t.column("embedding").combine_chunks(), size) for t in (entries, asked))
            cell = entries.column("cell").to_numpy()
            lists = entries.column("ids").combine_chunks()
            ids = lists.values.to_numpy()[lists.offsets.to_numpy()[:-1]]
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            lists_of_cells = asked.column("cells").to_pylist()
            for start in range(0, len(q), 256):
                score = np.clip(q[start : start + 256] @ x.T, -1, 1)
                seen = np.zeros((len(score), len(sizes)), bool)
                for i, blob in enumerate(lists_of_cells[start : start + 256]):
                    seen[i, np.frombuffer(blob, np.int32)] = True
                score[~seen[:, cell]] = -np.inf
                for i, s in enumerate(score):
                    best = needed(s, ids, ends, flat, k)
                    rows += [start + i] * len(best)
                    at += best.tolist()
                    scores += s[best].tolist()
        columns = [asked.column("asked").take(pa.array(rows, pa.int64())), entries.column("ids").take(pa.array(at, pa.int64())), pa.array(scores, pa.float64())]
        return pa.table(columns, ["asked", "ids", "score"])

    kinds = "embedding array<double>, ids array<long>, cell int, block long"
    blocks = indexed.mapInArrow(blocked, kinds).withColumn("query_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    sent = asked.mapInArrow(routed, "embedding array<double>, asked long, block long, cells binary, query_group int")
    found = (
        blocks.groupBy("block", "query_group")
        .cogroup(sent.groupBy("block", "query_group"))
        .applyInArrow(compared, "asked long, ids array<long>, score double")
    )
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    of_id = Window.partitionBy("asked", "vec_id").orderBy(F.desc("score"))
    ranked = found.select("asked", "score", F.explode("ids").alias("vec_id")).withColumn("place", F.row_number().over(of_id)).where(F.col("place") <= k)
    ranked = ranked.withColumn("place", F.row_number().over(best)).where(F.col("place") <= 2 * k)
    lists = ranked.groupBy("asked").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    answers = asked.join(lists, "asked").select("embedding", "near")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    rows = queries.select(F.col("vec_id").alias("query_id"), "embedding").join(answers, "embedding")
    rows = rows.select("query_id", F.posexplode(others).alias("place", "near"))
    return rows.select("query_id", (F.col("place") + 1).alias("rank"), "near.vec_id", "near.score")
