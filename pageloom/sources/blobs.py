"""A sink that writes one file per row: ``(path, content)``.

Spark's ``binaryFile`` format only reads. This data source writes each row's
bytes to its own path. A file is written under a name of its own and renamed
into place, so a retried or speculative task leaves whole files only, and
writing the same table again gives the same files. Names not yet renamed carry
the number of the run; what tasks that were lost have left of them is deleted
when the run ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from pageloom.functions.paths import page_file_path
from pageloom.sources.systems import Systems, default_system

FORMAT = "blobs"


@dataclass
class WrittenFiles(WriterCommitMessage):
    files: int


def hidden_path(path: str, run: str) -> str:
    """A new name beside a path; file scans don't see names with a leading dot."""
    directory, mark, name = path.rpartition("/")
    return f"{directory}{mark}.{name}.{run}.{uuid.uuid4().hex}"


def sweep(paths: DataFrame, run: str) -> int:
    """Delete what a run has left under hidden names in the folders of its paths; returns how many files that was.

    Call it when the run's tasks have ended. Each folder is listed once, in a task.
    """
    default = default_system(paths.sparkSession)
    folders = paths.select(F.regexp_extract("path", r"\A(.*)/[^/]*\z", 1).alias("folder")).where("folder <> ''").distinct()

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        systems, gone = Systems(default), 0
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                system, inner = systems.find(folder)
                for info in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
                    if info.is_file and info.base_name.startswith(".") and f".{run}." in info.base_name:
                        system.delete_file(info.path)
                        gone += 1
        yield pa.RecordBatch.from_pydict({"gone": [gone]})

    return folders.mapInArrow(clean, "gone long").agg(F.sum("gone")).first()[0] or 0


def put(system, target: str, content, made: set[str], run: str = "") -> None:
    """Write a file under a hidden name and rename it; a failure leaves nothing behind."""
    directory = target.rpartition("/")[0]
    if directory and directory not in made:
        system.create_dir(directory, recursive=True)
        made.add(directory)
    staged = hidden_path(target, run)
    try:
        with system.open_output_stream(staged) as stream:
            stream.write(content)
        system.move(staged, target)
    except BaseException:
        from pyarrow import fs

        if system.get_file_info(staged).type == fs.FileType.File:
            system.delete_file(staged)
        raise


@dataclass
class BlobWriter(DataSourceArrowWriter):
    #: ``scheme://host`` that paths without a scheme are in.
    default: str = ""
    #: Number of the run, in the names of files that are not finished.
    run: str = ""

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        files = 0
        systems, made = Systems(self.default), set()
        for batch in iterator:
            for path, content in zip(batch.column("path"), batch.column("content")):
                if not content.is_valid:
                    raise ValueError(f"No content for {path.as_py()}")
                system, target = systems.find(path.as_py())
                put(system, target, content.as_buffer(), made, self.run)
                files += 1
        return WrittenFiles(files)


class BlobSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> BlobWriter:
        return BlobWriter(self.options.get("default", ""), self.options.get("run", ""))


def write_blobs(files: DataFrame) -> None:
    """Write every row ``(path, content)`` as a file of its own.

    A path without a scheme is in Spark's default file system, as elsewhere in
    Spark. A row without content fails. Paths are read once more when the files
    are written, to sweep their folders.
    """
    spark = files.sparkSession
    spark.dataSource.register(BlobSink)
    run = uuid.uuid4().hex
    writer = files.select("path", "content").write.format(FORMAT).option("default", default_system(spark))
    try:
        writer.option("run", run).mode("append").save()
    finally:
        sweep(files, run)


def own_folder(source: str = "source") -> Column:
    """A folder name for each file: its name without the ending, and a digest that tells equal names apart."""
    stem = F.regexp_extract(source, r"([^/]*?)(?:\.[^./]*)?/*$", 1)
    return F.concat(stem, F.lit("-"), F.substring(F.sha1(F.coalesce(F.col(source), F.lit(""))), 1, 12))


def placed_images(images: DataFrame, directory: str) -> DataFrame:
    """Adds ``path``: below ``directory``, in ``dir`` if that is a column or else in a folder of its file."""
    root = F.lit(directory.rstrip("/"))
    folder = F.col("dir") if "dir" in images.columns else own_folder()
    return images.withColumn("path", page_file_path(F.concat(root, F.lit("/"), folder), "page_no", "fmt"))


def fail_on_shared_paths(placed: DataFrame) -> None:
    """Two rows of one path would overwrite each other."""
    twice = placed.groupBy("path").count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"Several images would be written to {twice['path']}")


def save_page_images(images: DataFrame, directory: str) -> DataFrame:
    """Write page images ``(source, page_no, fmt, content[, dir])`` and return their paths.

    Pages go to ``dir``, a folder below ``directory``, or without that column
    to a folder of their file. Returned are ``(source, page_no, path)``; order
    by them for the order of pages. Two rows of one path raise before anything
    is written.
    """
    placed = placed_images(images, directory)
    fail_on_shared_paths(placed)
    write_blobs(placed)
    return placed.select("source", "page_no", "path")


def save_page_image(images: DataFrame) -> DataFrame:
    """Write converted pages ``(source, page_number, content, error, path)`` to paths of the caller's choice.

    Rows with an error are not written and come back with it.
    """
    sound = images.where(F.col("error").isNull())
    fail_on_shared_paths(sound)
    write_blobs(sound)
    path = F.when(F.col("error").isNull(), F.col("path"))
    return images.select("source", "page_number", path.alias("path"), "error")
