"""File scans, path tables and missing files."""

from __future__ import annotations

import pytest

from pageloom.operators.admission import missing_sources
from pageloom.options import DEFAULT_SUPPORTED_TYPES, LoadOptions
from pageloom.sources.files import read_sources, scan_files, type_glob
from pageloom.streaming.ingest import start_loading, stream_files
from tests.backends import echo_backend


def test_type_glob():
    assert type_glob((".pdf", ".h5")) == "*{.[pP][dD][fF],.[hH]5}"
    assert type_glob((".pdf", ".PNG")) == "*{.[pP][dD][fF]}"
    assert type_glob((".PNG",)) is None
    assert type_glob(("", ".pdf")) is None
    assert type_glob((".a*",)) is None
    assert type_glob(()) is None
    assert type_glob(DEFAULT_SUPPORTED_TYPES) is not None


@pytest.fixture
def tree(tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a.pdf", "b.Jpg", "c.txt", ".hidden.pdf", "_under.pdf"):
        (tmp_path / "in" / name).write_bytes(name.encode())
    return tmp_path / "in"


def test_scan_files(spark, tree):
    rows = {row.source: (bytes(row.content), row.length) for row in scan_files(spark, str(tree)).collect()}
    assert rows == {f"{tree}/{name}": (name.encode(), len(name)) for name in ("a.pdf", "b.Jpg", "c.txt")}
    admissible = scan_files(spark, str(tree), LoadOptions()).select("source").collect()
    assert sorted(row.source for row in admissible) == [f"{tree}/a.pdf", f"{tree}/b.Jpg"]


def test_scan_of_one_file_and_of_none(spark, tree):
    assert [row.source for row in scan_files(spark, f"{tree}/a.pdf").collect()] == [f"{tree}/a.pdf"]
    with pytest.raises(FileNotFoundError, match=f"^File not found: {tree}/gone.pdf$"):
        scan_files(spark, f"{tree}/gone.pdf")


def test_read_sources_keeps_columns_and_reports_missing(spark, tree):
    paths = spark.createDataFrame(
        [(f"{tree}/a.pdf", 1), (f"{tree}/_under.pdf", 2), (f"{tree}/nope.pdf", 3), (str(tree), 4), ("", 5), (None, 6)],
        "source string, key int",
    )
    for partitions in (None, 3):
        rows = {row.key: row for row in read_sources(paths, partitions).collect()}
        assert bytes(rows[1].content) == b"a.pdf" and rows[1].error is None
        assert bytes(rows[2].content) == b"_under.pdf"
        assert rows[3].content is None and rows[3].error == f"File not found: {tree}/nope.pdf"
        assert rows[4].content is None and rows[4].error is not None
        assert rows[5].error == "File not found: "
        assert rows[6].content is None and rows[6].error == "File not found: undefined"


def test_missing_sources_counts_every_request(spark):
    requested = spark.createDataFrame([("a",), ("gone",), ("gone",), ("b",)], "source string")
    scanned = spark.createDataFrame([("a",), ("a",), ("b",)], "source string")
    got = [tuple(row) for row in missing_sources(requested, scanned).collect()]
    assert got == [("gone", "File not found: gone", 2)]


def test_streaming_load_takes_each_file_once(spark, tree, tmp_path):
    out = str(tmp_path / "out")

    def run():
        query = start_loading(stream_files(spark, str(tree), max_files_per_trigger=2), out, echo_backend())
        query.awaitTermination(120)
        documents = spark.read.parquet(f"{out}/documents")
        return sorted((row.source, row.page_content) for row in documents.collect())

    assert run() == [(f"{tree}/a.pdf", "a.pdf"), (f"{tree}/b.Jpg", "b.Jpg")]
    (tree / "late.png").write_bytes(b"one\ftwo")
    assert run() == [(f"{tree}/a.pdf", "a.pdf"), (f"{tree}/b.Jpg", "b.Jpg"), (f"{tree}/late.png", "one")]
    rejects = spark.read.parquet(f"{out}/rejects").collect()
    assert [row.source for row in rejects] == [f"{tree}/c.txt"]
