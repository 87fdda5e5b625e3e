"""File scans: a directory tree, or a table of paths.

A tree is listed in tasks, a level of folders at a time, so its names never
pass the driver. ``scan_files`` is Spark's own scan, for file systems that only
Spark reads.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.paths import plain_path
from pageloom.operators.admission import FILE_NOT_FOUND, NO_PATH
from pageloom.options import LoadOptions
from pageloom.session import release, run_dir, spread
from pageloom.sources.systems import Systems, default_system

# Bytes of file content per Arrow batch handed back to Spark.
BATCH_BYTES = 32 << 20

# Files that a task reads.
FILES_PER_TASK = 1000

# Folders that a task lists, and names in an Arrow batch.
FOLDERS_PER_TASK = 100
NAMES_PER_BATCH = 10_000

# Bytes that a task reads, where they are known beforehand.
BYTES_PER_TASK = 128 << 20

# Characters with a meaning in a file glob.
_GLOB_SPECIAL = set("*?[]{}\\,^")


def type_glob(types: tuple[str, ...]) -> str | None:
    """A case-insensitive file-name glob for the extensions, if one exists."""
    # Extensions are lower-cased before they are looked up, so an entry that
    # is not lower-case matches no file.
    usable = [ext for ext in types if ext == ext.lower()]
    if not usable or any(not ext.startswith(".") or _GLOB_SPECIAL & set(ext) for ext in usable):
        return None

    def either(char: str) -> str:
        return f"[{char}{char.upper()}]" if len(char.upper()) == 1 and char != char.upper() else char

    return "*{" + ",".join("".join(either(char) for char in ext) for ext in usable) + "}"


def scan_files(
    spark: SparkSession, root: str | list[str], options: LoadOptions | None = None, recursive: bool = True
) -> DataFrame:
    """``(source, content, length)`` of all files below ``root``.

    Bytes are only read where a plan uses ``content``. With ``options`` files
    of other types are skipped by name and never opened; leave it out to see
    them as rejects. Names that start with ``.`` or ``_`` are not listed. A
    root that does not exist is an error.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    glob = type_glob(options.types) if options else None
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        found = reader.load(root)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        path = failure.getMessageParameters()["path"]
        raise FileNotFoundError(FILE_NOT_FOUND + re.sub(r"\Afile:/+", "/", path)) from None
    return found.select(plain_path("path").alias("source"), "content", "length")


@dataclass(frozen=True)
class Listing:
    """``files(source, length)``, one row for each file, kept in a scratch folder until ``close``."""

    files: DataFrame
    scratch: str

    def close(self) -> None:
        release(self.files.sparkSession, self.scratch)


def listable(spark: SparkSession, root: str | list[str]) -> bool:
    """Whether tasks can list these folders: no patterns, and of a file system that pyarrow knows."""
    systems = Systems(default_system(spark))
    for path in [root] if isinstance(root, str) else root:
        try:
            systems.find(path)
        except ValueError:
            return False
        if _GLOB_SPECIAL & set(path):
            return False
    return True


def list_files(spark: SparkSession, root: str | list[str]) -> Listing:
    """All files below ``root``, whatever their names, without opening them.

    Each round lists the folders that the one before it found, in as many tasks
    as there are folders for. What is found is written to shared storage; only
    numbers come to the driver. One folder is listed by one task. A root that
    is a file is that file; one that does not exist is an error.
    """
    from pyarrow import fs

    default = default_system(spark)
    roots = sorted(set([root] if isinstance(root, str) else root))
    systems = Systems(default)
    kinds = []
    for path in roots:
        system, inner = systems.find(path)
        info = system.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(FILE_NOT_FOUND + re.sub(r"\Afile:/+", "/", path))
        kinds.append((re.sub(r"\Afile:/+", "/", path), info.size, info.type == fs.FileType.Directory))
    schema = "source string, length long, folder boolean"

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        systems = Systems(default)
        for batch in batches:
            for folder in batch.column("source").to_pylist():
                system, inner = systems.find(folder)
                infos = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
                for start in range(0, len(infos), NAMES_PER_BATCH):
                    some = infos[start : start + NAMES_PER_BATCH]
                    names = [f"{folder.rstrip('/')}/{info.base_name}" for info in some]
                    sizes = pa.array([info.size for info in some], pa.int64())
                    folders = [info.type == fs.FileType.Directory for info in some]
                    yield pa.RecordBatch.from_arrays([pa.array(names), sizes, pa.array(folders)], ["source", "length", "folder"])

    scratch = run_dir(spark, "listing")
    found = spark.createDataFrame(kinds, schema)
    level = 0
    while True:
        found.write.parquet(f"{scratch}/level={level}")
        written = spark.read.schema(schema).parquet(f"{scratch}/level={level}")
        folders = written.where("folder").select("source")
        number = folders.count()
        if not number:
            break
        found = spread(folders, -(-number // FOLDERS_PER_TASK)).mapInArrow(below, schema)
        level += 1
    files = spark.read.schema(f"{schema}, level int").parquet(scratch).where("NOT folder").select("source", "length")
    return Listing(files, scratch)


def read_sources(paths: DataFrame, partitions: int | None = None, opened: str | None = None) -> DataFrame:
    """Add ``content`` and ``error`` to a table of paths ``(source[, ...])``.

    Files are opened where the paths are, so no listing passes the driver and
    no bytes are shuffled; the short path rows are dealt out first, in
    ``partitions`` tasks or one for every FILES_PER_TASK of them. A path that
    does not exist is a row with an error. Any other failure, such as a
    throttled read or a file system that is not known, fails the task, so that
    Spark tries it again. Paths may be URIs of any file system pyarrow knows.

    Where ``opened`` names a column, rows in which it is not true pass without
    content; it is dropped. With a column ``length`` tasks are also made for
    every BYTES_PER_TASK.
    """
    if partitions is None:
        at_least = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        wanted = F.col(opened) if opened else F.lit(True)
        length = F.sum(F.when(wanted, F.col("length"))) if "length" in paths.columns else F.lit(0)
        count, size = paths.agg(F.count("*"), length).first()
        partitions = max(at_least, -(-count // FILES_PER_TASK), -(-(size or 0) // BYTES_PER_TASK))
    names = [name for name in paths.columns if name != opened]
    schema = T.StructType(
        [*[paths.schema[name] for name in names], T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())]
    )
    not_found, no_path, batch_bytes = FILE_NOT_FOUND, NO_PATH, BATCH_BYTES
    default = default_system(paths.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        systems = Systems(default)

        def read(path: str) -> bytes | None:
            system, inner = systems.find(path)
            try:
                with system.open_input_stream(inner, compression=None) as stream:
                    return stream.read()
            except OSError:
                from pyarrow import fs

                if system.get_file_info(inner).type == fs.FileType.File:
                    raise
                return None

        def read_rows(batch, start, contents, errors):
            columns = [batch.column(name).slice(start, len(contents)) for name in names]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(contents, pa.binary()), pa.array(errors, pa.string())],
                names=[*names, "content", "error"],
            )

        for batch in batches:
            start, size, contents, errors = 0, 0, [], []
            wanted = batch.column(opened).to_pylist() if opened else [True] * batch.num_rows
            for source, read_it in zip(batch.column("source").to_pylist(), wanted):
                content = read(source) if source and read_it else None
                contents.append(content)
                missing = content is None and read_it
                errors.append(not_found + (no_path if source is None else source) if missing else None)
                size += len(content or b"")
                if size >= batch_bytes:
                    yield read_rows(batch, start, contents, errors)
                    start, size, contents, errors = start + len(contents), 0, [], []
            if contents:
                yield read_rows(batch, start, contents, errors)

    return spread(paths, partitions).mapInArrow(run, schema)


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """``(source, content, length)`` of all files below ``root``, listed and read in tasks.

    The rows of ``scan_files``, for trees of more files than the driver can
    hold names of. File systems that only Spark reads are left to its own scan.
    """
    if not listable(spark, root):
        return scan_files(spark, root)
    top = re.sub(r"\Afile:/+", "/", root).rstrip("/")
    below = F.expr(f"substring(source, {len(top) + 1})")
    listed = list_files(spark, root).files.where(~F.rlike(below, F.lit(r"/(\.|_[^/=]*(/|\z))")))
    return read_sources(listed).select("source", "content", "length")
