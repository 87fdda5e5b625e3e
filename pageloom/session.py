"""Session-level helpers: shared scratch space and cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Folders of ``run_dir`` made inside the innermost ``scratch`` block.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@cache
def _own_dir() -> str:
    """One temporary folder for a process, deleted when it ends."""
    folder = tempfile.mkdtemp(prefix="pageloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session without the setting gets a temporary folder.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set")
    return _own_dir()


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    path = f"{shared_dir(spark)}/pageloom/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that operators make inside the block are deleted at its end, also after a failure.

    Their results read from them, so write results to a folder of your own
    inside the block. Blocks may be nested; other threads are not concerned.
    """
    folders: list[str] = []
    before = _made.set(folders)
    try:
        yield
    finally:
        _made.reset(before)
        for path in folders:
            release(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write the table to shared storage and read it back.

    Cuts the lineage, so expensive or unrepeatable work such as service calls
    is neither done twice nor lost with an executor.
    """
    return stored(df, run_dir(df.sparkSession, name))


def stored(df: DataFrame, path: str) -> DataFrame:
    """As ``materialize``, in a folder that the caller names and may release."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``run_dir`` and what is in it, wherever it is."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal short rows evenly over tasks before they turn into heavy work.

    Rows are dealt in turn and not by key, so copies of one key do not meet,
    and the number is given, so that adaptive execution does not put the short
    rows back together.
    """
    return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
