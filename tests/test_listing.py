"""Listing in tasks, info joined to names, and calls that are not repeated."""

from __future__ import annotations

import json
import os
import re
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom import LoadOptions, load_path, load_table
from pageloom.operators.admission import admit, ingest_table
from pageloom.operators.journal import Journal, TaskInfo
from pageloom.operators.ocr import apply_ocr
from pageloom.operators.pdf_info import task_info, with_task_info
from pageloom.operators.request import build_requests
from pageloom.plans import load
from pageloom.session import run_dir
from pageloom.sources.files import list_files, listable, read_sources, read_tree, scan_files
from pageloom.workload.catalog import QUERIES
from tests.backends import echo_backend
from tests.test_plans import plan, settings  # noqa: F401

NAMES = ("a.pdf", "_b.PDF", ".c.pdf", "notes.txt", "deep/x.png", "deep/_er/y z%20é.jpg", "deep/_er/more/z")


@pytest.fixture
def tree(tmp_path):
    for name in NAMES:
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(name.encode())
    (tmp_path / "in" / "empty").mkdir()
    return tmp_path / "in"


def listed(spark, root):
    listing = list_files(spark, root)
    rows = sorted((row.source, row.length) for row in listing.files.collect())
    listing.close()
    assert not os.path.exists(listing.scratch.removeprefix("file:"))
    return rows


def test_every_name_is_listed_once(spark, tree):
    want = sorted((f"{tree}/{name}", len(name.encode())) for name in NAMES)
    assert listed(spark, str(tree)) == want
    assert listed(spark, f"file://{tree}/") == want
    assert listed(spark, [str(tree), str(tree), f"{tree}/a.pdf"]) == sorted([*want, (f"{tree}/a.pdf", 5)])
    assert listed(spark, f"{tree}/empty") == []
    with pytest.raises(FileNotFoundError, match=f"^File not found: {tree}/gone$"):
        list_files(spark, f"{tree}/gone")


def test_names_do_not_come_to_the_driver(spark, tree, monkeypatch):
    def no(*args, **more):
        raise AssertionError("rows came to the driver")

    kind = type(spark.range(1))
    for name in ("collect", "toPandas", "toArrow", "toLocalIterator", "take", "head", "first"):
        monkeypatch.setattr(kind, name, no)
    listing = list_files(spark, str(tree))
    assert listing.files.count() == len(NAMES)


def test_what_tasks_can_list(spark, tree):
    assert listable(spark, str(tree)) and listable(spark, [f"file://{tree}"])
    assert not listable(spark, f"{tree}/*.pdf") and not listable(spark, "viewfs://store/in")


def test_load_path_lists_once_and_opens_supported_files_only(spark, tree, monkeypatch):
    calls = []
    monkeypatch.setattr(load, "list_files", lambda *a: calls.append(a) or list_files(*a))
    monkeypatch.setattr(load, "scan_files", lambda *a: 1 / 0)
    os.mkfifo(tree / "pipe.txt")  # opening it would never end
    info = spark.createDataFrame([(f"{tree}/_b.PDF", "5.0", 2)], "source string, version string, num_pages int")
    result = load_path(spark, str(tree), echo_backend(), pdf_info=info)
    got = {row.source.removeprefix(f"{tree}/"): row for row in result.documents.collect()}
    assert sorted(got) == sorted(n for n in NAMES if n.endswith(("pdf", "PDF", "png", "jpg")))
    assert all(row.page_content == name for name, row in got.items())
    assert got["_b.PDF"].metadata.pdf.totalPages == 2 and got["a.pdf"].metadata.pdf.totalPages is None
    rejects = sorted(row.source.removeprefix(f"{tree}/") for row in result.rejects.collect())
    assert rejects == ["deep/_er/more/z", "notes.txt", "pipe.txt"]
    assert len(calls) == 1


def test_patterns_are_scanned_by_spark(spark, tree):
    result = load_path(spark, f"{tree}/*.pdf", echo_backend())
    assert [row.source for row in result.documents.collect()] == [f"{tree}/a.pdf"]


def moved(df):
    """Columns that each exchange of a plan moves."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [re.findall(r"(\w+)#", line) for line in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)]


def test_info_moves_to_names_and_never_bytes_or_answers(spark, tree, settings, monkeypatch):  # noqa: F811
    rows = spark.range(2000).select(F.concat(F.lit("f"), "id", F.lit(".pdf")).alias("source"), F.lit("1").alias("version"), F.lit(3).alias("num_pages"))
    path = run_dir(spark, "wide-info")
    rows.write.parquet(path)
    info = spark.read.parquet(path)
    listing = list_files(spark, str(tree))
    requests = build_requests(admit(ingest_table(read_sources(load.listed_paths(listing.files, LoadOptions(), info), opened="opened"))))
    columns = moved(requests)
    assert len(columns) >= 3  # both sides of the join, and the dealing out of names
    assert not {"content", "request", "response", "pages"} & {name for names in columns for name in names}

    plans = []
    answer = load.load_responses
    monkeypatch.setattr(load, "load_responses", lambda answers, *a: plans.append(moved(answers)) or answer(answers, *a))
    path = run_dir(spark, "files")
    rows.select("source", F.col("source").cast("binary").alias("content")).write.parquet(path)
    result = load_table(spark.read.parquet(path), echo_backend(), pdf_info=info)
    assert plans == [[]]
    assert result.documents.where("metadata.pdf.totalPages = 3").count() == 2000


def test_info_is_found_though_the_tasks_have_changed(spark):
    files = spark.createDataFrame([(f"{i}.pdf", b"x") for i in range(40)] + [(None, b"x")], "source string, content binary")
    info = spark.createDataFrame([(f"{i}.pdf", "5.0", {"n": i}, i) for i in range(0, 40, 2)], "source string, version string, info map<string, bigint>, num_pages int")
    folder = run_dir(spark, "info")
    kind = task_info(ingest_table(files), info, folder)
    for again in (files, files.repartition(5), files.coalesce(1)):
        requests = build_requests(admit(ingest_table(again)))
        got = with_task_info(apply_ocr(requests, echo_backend(), info=folder), kind).collect()
        assert len(got) == 41
        for row in got:
            number = int(row.source.split(".")[0]) if row.source else 1
            if number % 2:
                assert row.pdf is None
            else:
                assert row.pdf.totalPages == number and row.pdf.info["n"].toPython() == number


def test_sources_are_looked_up_once(spark, tmp_path, monkeypatch):
    info = spark.createDataFrame([("a.pdf", "5.0", 1)], "source string, version string, num_pages int")
    files = spark.createDataFrame([("a.pdf", b""), ("b.pdf", b"")], "source string, content binary").coalesce(1)
    folder = str(tmp_path / "info")
    task_info(ingest_table(files), info, folder)
    known = TaskInfo(folder, 0)
    assert [x and json.loads(x)["totalPages"] for x in known.of(["a.pdf", "b.pdf", None])] == [1, None, None]
    monkeypatch.setattr(known, "_read", lambda *a: 1 / 0)
    assert known.of(["b.pdf"]) == [None]


def test_a_journal_gives_back_what_it_was_told(tmp_path):
    first = Journal(str(tmp_path), 3)
    keys = [first.key("a", "r"), first.key("a", "r"), first.key(None, "r"), first.key("None", "r")]
    assert len(set(keys)) == 4 and first.find(keys[0]) is None
    first.add(keys[0], "é" * 9, None)
    first.add(keys[1], None, "no")
    again = Journal(f"file://{tmp_path}", 3)
    assert [again.key("a", "r"), again.key("a", "r"), again.key(None, "r")] == keys[:3]
    assert [again.find(k) for k in keys] == [("é" * 9, None), (None, "no"), None, None]
    assert Journal(str(tmp_path), 4).find(keys[0]) is None


DYING = """
import os, sys, json
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from pageloom import load_table
folder = sys.argv[2]
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", folder + "/shared").getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def backend():
    import base64, json, os, time
    def call(request):
        text = base64.b64decode(json.loads(request)["document"]["documentUrl"].split(";base64,")[1]).decode()
        if text == "17" and not os.path.exists(folder + "/died"):
            time.sleep(1)  # the others under way are answered meanwhile
            open(folder + "/died", "w").close()
            os._exit(1)
        with open(folder + "/calls", "a") as log:
            log.write(text + "\\n")
        if text == "5":
            raise RuntimeError("refused")
        return json.dumps({"pages": [{"markdown": text}]})
    return call

files = spark.createDataFrame([(f"{i}.pdf", str(i).encode()) for i in range(30)], "source string, content binary").coalesce(1)
result = load_table(files, backend)
print(json.dumps([sorted(r.page_content for r in result.documents.collect()), [r.error for r in result.rejects.collect()], os.listdir(folder + "/shared/pageloom")]))
"""


def test_a_task_that_dies_half_way_repeats_no_call(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", DYING, root, str(tmp_path)], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    documents, rejects, left = json.loads(done.stdout.splitlines()[-1])
    assert documents == sorted(str(i) for i in range(30) if i != 5)
    assert rejects == ["OCR processing failed: refused"]
    assert (tmp_path / "died").exists()
    assert sorted((tmp_path / "calls").read_text().split()) == sorted(str(i) for i in range(30))
    assert [name for name in left if name.startswith("calls")] == []  # the journal is gone


def test_a_tree_read_in_tasks_has_the_rows_of_the_scan(spark, tree):
    (tree / "_k=1").mkdir()
    (tree / "_k=1" / "v.png").write_bytes(b"v")
    rows = lambda df: sorted((r.source, bytes(r.content), r.length) for r in df.collect())
    want = rows(scan_files(spark, str(tree)))
    assert {os.path.relpath(row[0], tree) for row in want} == {"a.pdf", "notes.txt", "deep/x.png", "_k=1/v.png"}
    for root in (f"{tree}/", f"file://{tree}"):
        assert rows(read_tree(spark, root)) == want


def test_written_pages_are_not_listed_by_the_driver(spark, tmp_path):
    customers = spark.range(1, 4).withColumnRenamed("id", "c_custkey")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    saved = QUERIES["save_pdf_pages"](spark, str(tmp_path))
    assert "binaryfile" not in plan(saved).lower()
    assert sorted((r.source, r.page_no, r.name) for r in saved.collect()) == [
        ("/cards/1.pdf", 1, "page-1.png"),
        *(("/cards/3.pdf", n, f"page-{n}.png") for n in (1, 2, 3)),
    ]
