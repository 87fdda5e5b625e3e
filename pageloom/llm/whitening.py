"""Whitening of embeddings through the covariance of their distinct vectors (operator 12).

Entries are put on an integer grid, x = floor(64 c) + 1000000. Rows with the same
x are grouped; a group's number of rows (or one) is the weight of its vector in
the fit. The covariance is a sum of products of centred matrices, weighted, one
product for a batch of distinct vectors. Each distinct vector is whitened once,
and the rows are joined back to it.

* Sums are exact: x and its weighted sums are integers, so what is centred is
  (n x - S) / n with a numerator without error.
* A task adds up one matrix of dimensions x dimensions. Matrices of FAN tasks
  are added in one task, and again of FAN of those, before the driver adds the
  rest: for a million tasks 256 matrices come to it.
* The eigenvectors are found on the driver, in double precision, from that one
  matrix. Their signs are those that numpy gives, the same for all rows.
* The covariance of the whitened vectors is added up in the same way; its
  largest difference from the identity is identity_error.
* A vector that many rows share is one row of the fit and of the whitening; rows
  of very large groups get theirs by a broadcast of fewer than HOT_GROUPS rows.

Rows whose vector is null, or holds null, NaN or infinite entries, are dropped.
Rows with a null vec_id and repeated rows count like others, each with its
result. Shorter vectors are read as padded with zeros, the empty vector
included. Entries are limited to +-LARGEST. Components whose variance is nothing
but rounding (fewer distinct vectors than dimensions, constant or dependent
dimensions) have null in whitened and are not part of identity_error, which is
null if there is no other component; ties of eigenvalues are in numpy's order.
deviation is null where it exceeds a long. Empty tables, and tables of empty
vectors only, give no rows. Other columns do no harm, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import joined_back, materialize, pick

GRID, ORIGIN = 64, 1_000_000
#: Largest absolute entry, so that sums of 2^32 rows are longs.
LARGEST = float(2**24)
COMPONENTS = 32
#: Matrices that are added in one task.
FAN = 64
BATCH_ROWS = 4096


def finite() -> Column:
    whole = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(whole, F.lit(False))


def on_grid(size: int) -> Column:
    """x of an embedding, padded to a size."""
    limited = lambda c: F.least(F.greatest(c, F.lit(-LARGEST)), F.lit(LARGEST))
    padded = F.concat("embedding", F.array_repeat(F.lit(0.0), F.lit(size) - F.size("embedding")))
    return F.transform(padded, lambda c: F.floor(GRID * limited(c)) + F.lit(ORIGIN).cast("long"))


def rows_of(column: pa.Array, size: int) -> np.ndarray:
    start, end = column.offsets[0].as_py(), column.offsets[-1].as_py()
    return column.values.slice(start, end - start).to_numpy(zero_copy_only=False).reshape(-1, size)


def added(table: DataFrame, kind: type, shape: tuple[int, ...], part) -> np.ndarray:
    """Sum over a table of an array that part makes of each batch."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                total += part(batch.slice(start, BATCH_ROWS))
        yield pa.RecordBatch.from_pydict({"place": pa.array([TaskContext.get().partitionId()], pa.int64()), "total": [total.tobytes()]})

    def together(some: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, kind) for b in some.column("total").to_pylist())
        return pa.table({"place": pa.array([some.column("place")[0].as_py() // FAN], pa.int64()), "total": pa.array([total.tobytes()], pa.binary())})

    sums = table.mapInArrow(own, "place long, total binary")
    for _ in range(2):
        sums = sums.groupBy(F.floor(F.col("place") / FAN).alias("group")).applyInArrow(together, "place long, total binary")
    return sum((np.frombuffer(r.total, kind).reshape(shape) for r in sums.collect()), np.zeros(shape, kind))


def whiten(vectors: DataFrame, components: int = COMPONENTS, weights: str = "count") -> DataFrame:
    """vec_id, n, deviation, whitened and explained (arrays by component) and identity_error of every row with a whole vector.

    vectors: vec_id, embedding. weights: "count" fits on all rows, "one" on the
    distinct vectors; n is the sum of the weights.
    """
    if weights not in ("count", "one"):
        raise ValueError(f"weights is count or one, not {weights!r}")
    rows = pick(vectors, vec_id="long", embedding="array<double>").where(finite())
    size = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    if not size:
        empty = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    rows = rows.select("vec_id", on_grid(size).alias("x"))
    groups = materialize(rows.groupBy("x").agg(F.count("*").alias("times")), "distinct")
    total, distinct = groups.agg(F.sum("times"), F.count("*")).first()
    n = total if weights == "count" else distinct

    def weight(batch: pa.RecordBatch) -> np.ndarray:
        times = batch.column("times").to_numpy()
        return times if weights == "count" else np.ones_like(times)

    sums = added(groups, np.int64, (size,), lambda b: weight(b) @ rows_of(b.column("x"), size))

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return (n * rows_of(batch.column("x"), size) - sums) / n

    def products(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        return (x * w[:, None]).T @ x

    covariance = added(groups, np.float64, (size, size), lambda b: products(centred(b), weight(b))) / n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    wanted = min(components, size)
    values, axes = values[::-1], axes[:, ::-1][:, :wanted]
    real = values[:wanted] > max(values[0], 0) * size * 8 * np.finfo(float).eps
    scale = np.divide(1, np.sqrt(np.where(real, values[:wanted], 1)), where=real, out=np.zeros(wanted))
    trace = covariance.trace()
    explained = (np.maximum(values[:wanted], 0) / trace if trace > 0 else np.zeros(wanted)).tolist()

    def deviations(x: np.ndarray) -> pa.Array:
        away = n * x - sums
        if int(np.abs(away).max(initial=0)) ** 2 * size < 2**63:
            return pa.array((away**2).sum(1))
        exact = (away.astype(object) ** 2).sum(1).tolist()
        return pa.array([d if d < 2**63 else None for d in exact], pa.int64())

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, BATCH_ROWS) for b in batches for i in range(0, b.num_rows, BATCH_ROWS)):
            flat = (centred(batch) @ axes * scale).ravel()
            values = pa.array(flat, mask=np.tile(~real, batch.num_rows))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * wanted), values)
            columns = [batch.column("x"), batch.column("times"), deviations(rows_of(batch.column("x"), size)), lists]
            yield pa.RecordBatch.from_arrays(columns, ["x", "times", "deviation", "whitened"])

    done = materialize(groups.mapInArrow(whitened, "x array<long>, times long, deviation long, whitened array<double>"), "whitened")

    def again(batch: pa.RecordBatch) -> np.ndarray:
        return products(np.nan_to_num(rows_of(batch.column("whitened"), wanted)), weight(batch))

    off = np.abs(added(done, np.float64, (wanted, wanted), again) / n - np.eye(wanted))[np.ix_(real, real)]
    error = F.lit(float(off.max())) if real.any() else F.lit(None).cast("double")
    return joined_back(rows, done, ["x"], total).select(
        "vec_id",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*map(F.lit, explained)).alias("explained"),
        error.alias("identity_error"),
    )
