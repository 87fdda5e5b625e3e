"""Files to documents."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.columns import held_column
from pageloom.functions.media import Transcoder
from pageloom.functions.paths import file_ext
from pageloom.operators.admission import admit, fail_on_error, ingest_table, rejected, route_kind
from pageloom.operators.ocr import BackendFactory, apply_ocr, stored_responses
from pageloom.operators.pdf_info import attach_pdf_info, task_info, with_task_info
from pageloom.operators.request import build_requests
from pageloom.operators.response import check_responses, response_rejects, to_documents
from pageloom.options import LoadOptions
from pageloom.schemas import OPEN_PDF, PDF
from pageloom.session import release, run_dir, stored
from pageloom.sources.files import list_files, listable, read_sources, scan_files, type_glob

OnError = Literal["collect", "fail"]


class LoadError(ValueError):
    """Strict mode met a file that gives no documents."""


@dataclass(frozen=True)
class LoadResult:
    """Documents and rejects, and the folder of the answers they are taken from, if one was written."""

    documents: DataFrame
    rejects: DataFrame
    scratch: str | None = None

    def close(self) -> None:
        """Delete the folder; neither table can be read after that."""
        if self.scratch is not None:
            release(self.documents.sparkSession, self.scratch)


def _raise_first(rejects: DataFrame) -> None:
    bad = rejects.first()
    if bad is not None:
        raise LoadError(bad["error"])


def load_responses(
    responses: DataFrame,
    options: LoadOptions = LoadOptions(),
    pdf_info: DataFrame | None = None,
    on_error: OnError = "collect",
) -> LoadResult:
    """Documents and rejects of answered requests.

    Answers are read, checked and written to shared storage while this
    function runs; both results are taken from there until ``close``.
    """
    scratch = run_dir(responses.sparkSession, "answers")
    checked = stored(check_responses(responses), scratch)
    rejects = response_rejects(checked)
    if on_error == "fail":
        _raise_first(rejects)
    # Joined per file: before pages are rows, and without file bytes.
    informed = checked if pdf_info is None else attach_pdf_info(checked, pdf_info)
    return LoadResult(to_documents(informed, options.split), rejects, scratch)


def load_table(
    files: DataFrame,
    backend: BackendFactory,
    options: LoadOptions = LoadOptions(),
    pdf_info: DataFrame | None = None,
    transcoder: Transcoder | None = None,
    on_error: OnError = "collect",
) -> LoadResult:
    """Documents and rejects of a table of files.

    The bytes of ``files`` are read once and the service called once per
    admitted file, while this function runs; a task that is tried again does
    not repeat its calls. With ``on_error="fail"`` a bad file raises its message.

    PDF info is joined to names alone, in a job of its own that does not read
    bytes, and taken up by the tasks that make the calls: neither bytes nor
    answers are shuffled, however large the info table is.
    """
    spark = files.sparkSession
    admitted = admit(ingest_table(files), options)
    scratch = run_dir(spark, "calls")
    try:
        info = kind = None
        if pdf_info is not None:
            info = f"{scratch}/info"
            kind = task_info(admitted, pdf_info, info)
        if on_error == "fail":
            admitted = fail_on_error(admitted)
        requests = build_requests(admitted, options, transcoder)
        answers = apply_ocr(requests, backend, journal=f"{scratch}/answers", info=info)
        if kind is not None:
            answers = with_task_info(answers, kind)
        return load_responses(answers, options, None, on_error)
    finally:
        release(spark, scratch)


def load_stored(
    files: DataFrame,
    stored_answers: DataFrame,
    options: LoadOptions = LoadOptions(),
    pdf_info: DataFrame | None = None,
    on_error: OnError = "collect",
) -> LoadResult:
    """As ``load_table`` with the answers of an earlier run, joined by source.

    The answers are used where they are stored: nothing is written, and
    documents and rejects each read them when they are used.
    """
    keyed = admit(ingest_table(files), options).drop("content", "ext").withColumnRenamed("error", "refused")
    if pdf_info is not None:
        # Joined to the short rows, before they carry their answers.
        keyed = attach_pdf_info(keyed, pdf_info)
    answered = stored_responses(keyed, stored_answers)
    rejects = response_rejects(answered)
    if on_error == "fail":
        _raise_first(rejects)
    return LoadResult(to_documents(answered, options.split), rejects)


def load_requested(
    paths: DataFrame,
    backend: BackendFactory,
    options: LoadOptions = LoadOptions(),
    pdf_info: DataFrame | None = None,
    transcoder: Transcoder | None = None,
    on_error: OnError = "collect",
) -> LoadResult:
    """Documents and rejects for a table of paths ``(source[, extra, loc, pdf])``.

    Missing files are rejects. PDF info is joined to the short path rows,
    before any bytes are read.
    """
    if pdf_info is not None:
        paths = paths.withColumn("pdf", held_column(paths, "pdf", PDF, OPEN_PDF))
        routed = paths.withColumn("kind", route_kind(file_ext("source"), options.types))
        paths = attach_pdf_info(routed, pdf_info).drop("kind")
    return load_table(read_sources(paths), backend, options, None, transcoder, on_error)


def load_path(
    spark: SparkSession,
    root: str | list[str],
    backend: BackendFactory,
    options: LoadOptions = LoadOptions(),
    pdf_info: DataFrame | None = None,
    transcoder: Transcoder | None = None,
    on_error: OnError = "collect",
) -> LoadResult:
    """Documents and rejects of all files below ``root``, whatever their names.

    The tree is listed once, in tasks. Its names are routed and joined to the
    PDF info; then the files of supported types are opened, where their short
    rows are. Folders given as patterns, or on file systems that only Spark
    reads, are scanned by Spark instead (see ``load_scanned``).
    """
    if not listable(spark, root):
        return load_scanned(spark, root, backend, options, pdf_info, transcoder, on_error)
    listing = list_files(spark, root)
    try:
        paths = listed_paths(listing.files, options, pdf_info)
        if on_error == "fail":
            _raise_first(rejected(admit(paths, options)))
        return load_table(read_sources(paths, opened="opened"), backend, options, None, transcoder, on_error)
    finally:
        listing.close()


def listed_paths(listed: DataFrame, options: LoadOptions, pdf_info: DataFrame | None) -> DataFrame:
    """Listed names with their PDF info and, in ``opened``, whether they are to be read."""
    paths = listed.withColumn("kind", route_kind(file_ext("source"), options.types))
    if pdf_info is not None:
        paths = attach_pdf_info(paths.withColumn("pdf", F.lit(None).cast(PDF)), pdf_info)
    return paths.withColumn("opened", F.col("kind").isNotNull()).drop("kind")


def load_scanned(
    spark: SparkSession,
    root: str | list[str],
    backend: BackendFactory,
    options: LoadOptions = LoadOptions(),
    pdf_info: DataFrame | None = None,
    transcoder: Transcoder | None = None,
    on_error: OnError = "collect",
) -> LoadResult:
    """As ``load_path``, through Spark's own scan of any file system and pattern.

    The driver lists the tree, and names that start with ``.`` or ``_`` are not
    seen. Files of other types are not opened: they are found by a second scan
    that reads names only.
    """
    if type_glob(options.types) is None:
        return load_table(scan_files(spark, root), backend, options, pdf_info, transcoder, on_error)
    unsupported = rejected(admit(scan_files(spark, root), options))
    if on_error == "fail":
        _raise_first(unsupported)
    loaded = load_table(scan_files(spark, root, options), backend, options, pdf_info, transcoder, on_error)
    return LoadResult(loaded.documents, loaded.rejects.unionByName(unsupported), loaded.scratch)
