"""What the operators share: picking columns, scratch tables, bytes of texts, exchanges."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.session import run_dir

#: Bytes of text that a task works on at a time.
CHUNK_BYTES = 8 << 20
#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def pick(df: DataFrame, keep: tuple[str, ...] = (), **types: str) -> DataFrame:
    """The named columns with the given types, those to keep as they are, and no others.

    Columns are found by their exact names, so others that differ in case or
    clash with names used inside an operator do no harm; of two columns of one
    name the first counts.
    """
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    place = lambda n: F.col(f"_{df.columns.index(n)}")
    return plain.select(*[place(n).cast(t).alias(n) for n, t in types.items()], *[place(n).alias(n) for n in keep])


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The table, written to the shared folder, or a given one below it, and read back: lineage ends here."""
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else run_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Groups that joined_back broadcasts are larger than this share of all rows, so they are fewer than this.
HOT_GROUPS = 256


def joined_back(rows: DataFrame, groups: DataFrame, keys: list[str], total: int) -> DataFrame:
    """Rows with the columns of their group; groups: one row for each value of the keys, and `times`, its rows of the total.

    Groups with more than a HOT_GROUPS-th of the rows are fewer than HOT_GROUPS
    and come to the rows; all other rows meet their group in a shuffle.
    """
    large = F.broadcast(groups.where(F.col("times") * HOT_GROUPS > total))
    small = groups.where(F.col("times") * HOT_GROUPS <= total)
    others = rows.join(large.select(*keys), keys, "left_anti")
    return rows.join(large, keys).unionByName(others.join(small, keys))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def typed(df: DataFrame, *names: str) -> str:
    """Names and types of columns, as a schema."""
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def text_key() -> Column:
    """Tells rows apart that share a doc_id; equal rows get equal results."""
    return F.xxhash64("text").alias("text_key")


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows whose texts together reach the limit, with their texts."""
    try:
        yield from _chunks(batches, limit)
    finally:
        give_back()


def give_back() -> None:
    """Return memory that a task no longer uses to the system; its process lives on."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def give_back_driver(spark: SparkSession) -> None:
    """The driver lets go of finished plans: their broadcasts and shuffles stay until its JVM collects them."""
    spark.sparkContext._jvm.System.gc()
    give_back()


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        texts = raw_texts(batch.column("text"))
        start = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= limit:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, size = i + 1, 0
        if start < len(texts):
            yield batch.slice(start), texts[start:]


def offsets(lengths) -> np.ndarray:
    """Where each of some runs begins, and the total."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of several runs, one after the other."""
    ends = offsets(lengths)
    return np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values: the finishing steps of a common integer hash."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def lower_ascii(text: bytes) -> bytes:
    """bytes.lower() changes A-Z only."""
    return text.lower()
