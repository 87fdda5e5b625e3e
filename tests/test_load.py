"""Files to documents, end to end and on literal answers."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.errors import PySparkException

from pageloom import LoadError, LoadOptions, load_path, load_requested, load_stored, load_table
from pageloom.operators.admission import UNSUPPORTED_TYPE, admit, ingest_table
from pageloom.operators.ocr import apply_ocr
from pageloom.operators.request import build_requests
from pageloom.operators.response import response_rejects, to_documents
from pageloom.options import DEFAULT_SUPPORTED_TYPES
from pageloom.schemas import METADATA, REJECTS
from tests.backends import echo_backend

UNSUPPORTED = UNSUPPORTED_TYPE + ".jpg, .jpeg, .png, .webp, .tiff, .bmp, .gif, .pdf"
ANSWERS = "source string, kind string, response string, error string"


def fixed_backend(answer):
    """A backend that gives one answer to all; an exception is raised."""

    def make():
        def call(request):
            if isinstance(answer, Exception):
                raise answer
            return json.dumps(answer)

        return call

    return make


def table(spark, *rows, schema="source string, content binary"):
    return spark.createDataFrame(list(rows), schema)


def documents(result_or_df):
    df = getattr(result_or_df, "documents", result_or_df)
    return [
        (row.source, row.page_content, row.metadata.asDict(recursive=True)) for row in df.orderBy("source").collect()
    ]


def rejects(result_or_df):
    df = getattr(result_or_df, "rejects", result_or_df)
    return sorted((row.source or "", row.error) for row in df.collect())


PAGE = {
    "markdown": "Test content",
    "images": [
        {
            "id": "img1",
            "topLeftX": 10,
            "topLeftY": 20,
            "bottomRightX": 100,
            "bottomRightY": 200,
            "imageBase64": "base64data",
        }
    ],
    "dimensions": {"width": 800, "height": 600},
}
REGION = {
    "id": "img1",
    "top_left_x": 10,
    "top_left_y": 20,
    "bottom_right_x": 100,
    "bottom_right_y": 200,
    "image_base64": "base64data",
}


def test_image_becomes_one_document(spark):
    result = load_table(table(spark, ("test.png", b"\x89PNG")), fixed_backend({"pages": [PAGE, PAGE]}))
    [(source, text, meta)] = documents(result)
    assert (source, text) == ("test.png", "Test content")
    assert meta["images"] == [REGION]
    assert meta["dimensions"] == {"dpi": None, "height": 600, "width": 800}
    assert meta["loc"] == {"pageNumber": 1}
    assert meta["pdf"] is None
    assert rejects(result) == []


def test_missing_parts_of_a_page_get_defaults(spark):
    answer = {"pages": [{"images": [{"id": "a", "topLeftX": 3}]}]}
    [(_, text, meta)] = documents(load_table(table(spark, ("t.jpg", b"x")), fixed_backend(answer)))
    assert text == ""
    assert meta["dimensions"] is None
    assert meta["images"] == [
        dict(id="a", top_left_x=3, top_left_y=0, bottom_right_x=0, bottom_right_y=0, image_base64=None)
    ]
    [(_, _, bare)] = documents(load_table(table(spark, ("t.jpg", b"x")), fixed_backend({"pages": [{}]})))
    assert bare["images"] == []


def test_numbers_may_be_written_with_a_fraction(spark):
    page = {"images": [{"id": 7, "topLeftX": 10.0, "topLeftY": 1e300}], "dimensions": {"width": 800.0}}
    [(_, _, meta)] = documents(load_table(table(spark, ("t.jpg", b"x")), fixed_backend({"pages": [page]})))
    assert meta["images"][0]["id"] == "7"
    assert (meta["images"][0]["top_left_x"], meta["images"][0]["top_left_y"]) == (10, 0)
    assert meta["dimensions"] == {"dpi": None, "height": None, "width": 800}


def test_pdf_pages_are_numbered(spark):
    answer = {"pages": [{"markdown": "page 1"}, {"markdown": "page 2"}]}
    rows = documents(load_table(table(spark, ("test.pdf", b"%PDF")), fixed_backend(answer)))
    assert [(text, meta["pdf"]["loc"]["pageNumber"]) for _, text, meta in rows] == [("page 1", 1), ("page 2", 2)]
    assert all(meta["images"] == [] and meta["dimensions"] is None and meta["loc"] is None for _, _, meta in rows)
    assert rows[0][2]["pdf"]["version"] is None


def test_combined_pdf_keeps_base_metadata_only(spark):
    answer = {"pages": [{"markdown": "page 1"}, {"markdown": None}, {"markdown": "page 3", **PAGE, "dimensions": None}]}
    files = table(
        spark,
        ("t.pdf", b"%PDF", {"lang": "fr", "images": "mine"}),
        ("t.png", b"\x89PNG", {"lang": "en", "images": "mine"}),
        schema="source string, content binary, extra map<string,string>",
    )
    rows = documents(load_table(files, fixed_backend(answer), LoadOptions(split_pages=False)))
    assert [(source, text) for source, text, _ in rows] == [
        ("t.pdf", "page 1\n\n\n\nTest content"),
        ("t.png", "page 1"),
    ]
    pdf, image = rows[0][2], rows[1][2]
    assert pdf["images"] is None and pdf["dimensions"] is None and pdf["loc"] is None and pdf["pdf"] is None
    assert pdf["extra"] == {"lang": "fr", "images": "mine"}
    assert image["images"] == [] and image["extra"] == {"lang": "en"} and image["loc"] == {"pageNumber": 1}


def test_no_pages_is_one_combined_document_or_none(spark):
    files = table(spark, ("t.pdf", b"%PDF"))
    empty = fixed_backend({"pages": []})
    assert documents(load_table(files, empty)) == []
    [(_, text, _)] = documents(load_table(files, empty, LoadOptions(split_pages=False)))
    assert text == ""


@pytest.mark.parametrize(
    ("source", "answer", "error"),
    [
        ("t.png", RuntimeError("API error"), "OCR processing failed: API error"),
        ("t.pdf", RuntimeError("PDF API error"), "OCR processing failed: PDF API error"),
        ("t.png", {}, "OCR processing failed: Malformed response structure"),
        ("t.pdf", {}, "OCR processing failed: Malformed response structure"),
        ("t.png", {"pages": []}, "OCR processing failed: Malformed response structure"),
        ("t.png", {"pages": [None, PAGE]}, "OCR processing failed: Malformed response structure"),
        (
            "t.pdf",
            {"pages": [PAGE, None]},
            "OCR processing failed: Cannot read properties of null (reading 'images')",
        ),
        (
            "t.pdf",
            {"pages": [{"images": [None]}]},
            "OCR processing failed: Cannot read properties of null (reading 'id')",
        ),
    ],
)
def test_failed_answers_are_rejects(spark, source, answer, error):
    result = load_table(table(spark, (source, b"x")), fixed_backend(answer))
    assert rejects(result) == [(source, error)]
    assert documents(result) == []
    with pytest.raises((LoadError, PySparkException), match="OCR processing failed"):
        load_table(table(spark, (source, b"x")), fixed_backend(answer), on_error="fail")


def test_null_pages_after_an_images_first_do_not_matter(spark):
    result = load_table(table(spark, ("t.png", b"x")), fixed_backend({"pages": [PAGE, None]}))
    assert len(documents(result)) == 1 and rejects(result) == []


def test_unparsable_answer_is_malformed(spark):
    stored = spark.createDataFrame([("t.pdf", "pdf", "<html>", None)], ANSWERS)
    assert rejects(response_rejects(stored)) == [("t.pdf", "OCR processing failed: Malformed response structure")]


def test_checks_run_in_order_and_nothing_is_sent(spark):
    files = table(spark, (None, b"x"), ("", b"x"), ("t.xyz", b"x"), ("noext", b"x"))
    # Any call would show as a failed one.
    result = load_table(files, fixed_backend(RuntimeError("called")))
    required = "File path is required in metadata.source"
    assert rejects(result) == [("", required), ("", required), ("noext", UNSUPPORTED), ("t.xyz", UNSUPPORTED)]
    assert documents(result) == []


def test_default_types_all_load(spark):
    rows = [(f"test{ext}", b"x") for ext in DEFAULT_SUPPORTED_TYPES]
    assert len(documents(load_table(table(spark, *rows), fixed_backend({"pages": [PAGE]})))) == 8


@pytest.mark.parametrize(
    ("types", "source", "kind"),
    [
        ((".xyz",), "t.xyz", "image"),
        ((".xyz",), "t.XYZ", "image"),
        ((".XYZ",), "t.XYZ", None),
        ((".png",), "t.pdf", None),
        ((".pdf",), "t.PDF", "pdf"),
        ((), "t.pdf", None),
        (("",), "noext", "image"),
    ],
)
def test_configured_types(spark, types, source, kind):
    options = LoadOptions(supported_types=types)
    row = admit(ingest_table(table(spark, (source, b"x"))), options).first()
    assert row.kind == kind
    assert (row.error is None) == (kind is not None)
    if kind is None:
        assert row.error == UNSUPPORTED_TYPE + ", ".join(types)


def names_and_types(schema):
    return [(field.name, field.dataType.simpleString()) for field in schema.fields]


@pytest.mark.parametrize("split", [True, False])
def test_result_schemas(spark, split):
    result = load_table(table(spark, ("t.pdf", b"x")), echo_backend(), LoadOptions(split_pages=split))
    assert names_and_types(result.documents.schema) == [
        ("source", "string"),
        ("page_content", "string"),
        ("metadata", METADATA.simpleString()),
    ]
    assert names_and_types(result.rejects.schema) == names_and_types(REJECTS)


def test_options_fall_back_like_the_loader():
    assert LoadOptions(model_name="").model == LoadOptions().model
    assert LoadOptions(model_name="m").model == "m"
    assert LoadOptions().split and not LoadOptions(split_pages=False).split
    assert LoadOptions().types == DEFAULT_SUPPORTED_TYPES


def test_caller_metadata(spark):
    schema = "source string, content binary, extra map<string,string>"
    given = {"lang": "fr", "images": "x", "dimensions": "y", "loc": '{"pageNumber": 7}', "source": "other"}
    files = table(spark, ("t.png", b"x", given), ("t.pdf", b"x", {**given, "pdf": "{}"}), schema=schema)
    pdf, image = documents(load_table(files, fixed_backend({"pages": [PAGE]})))
    assert image[2]["extra"] == {"lang": "fr"} and image[2]["loc"] == {"pageNumber": 7}
    assert image[2]["source"] == "t.png" and image[2]["images"] == [REGION]
    assert pdf[2]["loc"] == {"pageNumber": 7} and pdf[2]["pdf"]["loc"] == {"pageNumber": 1}


def info_table(spark):
    return spark.createDataFrame(
        [("a.pdf", "5.0", {"Title": "A"}, None, 3), ("c.png", "5.0", {}, {}, 1)],
        "source string, version string, info map<string,string>, metadata map<string,string>, num_pages int",
    )


@pytest.mark.parametrize("split", [True, False])
def test_pdf_info_or_the_document_without_it(spark, split):
    files = table(spark, ("a.pdf", b"x"), ("b.pdf", b"x"), ("c.png", b"x"))
    options = LoadOptions(split_pages=split)
    result = load_table(files, fixed_backend({"pages": [PAGE]}), options, pdf_info=info_table(spark))
    read, unread, image = [meta["pdf"] for _, _, meta in documents(result)]
    loc = {"pageNumber": 1} if split else None
    assert read == {"version": "5.0", "info": {"Title": "A"}, "metadata": None, "totalPages": 3, "loc": loc}
    if split:
        assert unread == {"version": None, "info": None, "metadata": None, "totalPages": None, "loc": loc}
    else:
        assert unread is None
    assert image is None


def test_stored_answers(spark):
    files = table(spark, ("a.pdf", b"x"), ("b.png", b"x"), ("c.pdf", b"x"), ("d.txt", b"x"))
    stored = spark.createDataFrame(
        [("a.pdf", json.dumps({"pages": [PAGE, PAGE]}), None), ("b.png", None, "timeout")],
        "source string, response string, error string",
    )
    result = load_stored(files, stored)
    assert [source for source, _, _ in documents(result)] == ["a.pdf", "a.pdf"]
    assert rejects(result) == [
        ("b.png", "OCR processing failed: timeout"),
        ("c.pdf", "OCR processing failed: No stored response"),
        ("d.txt", UNSUPPORTED),
    ]


def test_backend_is_made_once_per_partition_and_batches_are_cut(spark):
    def make():
        made = []
        made.append(1)

        def call(request):
            return json.dumps({"pages": [{"markdown": str(len(made)) + "x" * 1000}]})

        return call

    rows = [(f"{i}.png", str(i).encode()) for i in range(50)]
    requests = build_requests(admit(ingest_table(table(spark, *rows)))).coalesce(1)
    answers = apply_ocr(requests, make, batch_bytes=4096)
    got = to_documents(answers).collect()
    assert sorted(row.source for row in got) == sorted(source for source, _ in rows)
    assert {row.page_content for row in got} == {"1" + "x" * 1000}
    assert "request" not in answers.columns


def test_strict_mode_raises_the_message(spark):
    bad = table(spark, ("t.xyz", b"x"), ("ok.pdf", b"x"))
    with pytest.raises((LoadError, PySparkException), match="Unsupported file type"):
        load_table(bad, echo_backend(), on_error="fail")
    good = load_table(table(spark, ("ok.pdf", b"a\fb")), echo_backend(), on_error="fail")
    assert [text for _, text, _ in documents(good)] == ["a", "b"]


@pytest.fixture
def tree(tmp_path):
    (tmp_path / "sub").mkdir()
    for name, content in {
        "a.pdf": b"one\ftwo",
        "B.PDF": b"three",
        "sub/c d%20é.png": b"four",
        "notes.txt": b"no",
        "noext": b"no",
    }.items():
        (tmp_path / name).write_bytes(content)
    return tmp_path


def test_load_path(spark, tree):
    result = load_path(spark, str(tree), echo_backend())
    assert [(source, text) for source, text, _ in documents(result)] == [
        (f"{tree}/B.PDF", "three"),
        (f"{tree}/a.pdf", "one"),
        (f"{tree}/a.pdf", "two"),
        (f"{tree}/sub/c d%20é.png", "four"),
    ]
    assert rejects(result) == [(f"{tree}/noext", UNSUPPORTED), (f"{tree}/notes.txt", UNSUPPORTED)]
    with pytest.raises(LoadError, match="Unsupported file type"):
        load_path(spark, str(tree), echo_backend(), on_error="fail")


def test_load_path_with_types_that_have_no_glob(spark, tree):
    result = load_path(spark, str(tree), echo_backend(), LoadOptions(supported_types=("", ".txt")))
    assert [source for source, _, _ in documents(result)] == [f"{tree}/noext", f"{tree}/notes.txt"]
    assert len(rejects(result)) == 3


def test_load_requested_reports_missing_files(spark, tree):
    paths = [f"{tree}/a.pdf", f"{tree}/gone.pdf", f"file://{tree}/B.PDF", f"{tree}/notes.txt", f"{tree}/gone.txt"]
    info = spark.createDataFrame([(f"{tree}/a.pdf", "5.0", 2)], "source string, version string, num_pages int")
    result = load_requested(table(spark, *[(p,) for p in paths], schema="source string"), echo_backend(), pdf_info=info)
    got = documents(result)
    assert [(source, text) for source, text, _ in got] == [
        (f"{tree}/a.pdf", "one"),
        (f"{tree}/a.pdf", "two"),
        (f"file://{tree}/B.PDF", "three"),
    ]
    assert [meta["pdf"]["totalPages"] for _, _, meta in got] == [2, 2, None]
    assert rejects(result) == [
        (f"{tree}/gone.pdf", f"File not found: {tree}/gone.pdf"),
        (f"{tree}/gone.txt", f"File not found: {tree}/gone.txt"),
        (f"{tree}/notes.txt", UNSUPPORTED),
    ]
    gone = table(spark, (f"{tree}/a.pdf",), (f"{tree}/gone.pdf",), schema="source string")
    with pytest.raises(PySparkException, match=f"File not found: {tree}/gone.pdf"):
        load_requested(gone, echo_backend(), on_error="fail")


def test_a_result_can_be_released(spark):
    result = load_table(table(spark, ("ok.pdf", b"a")), echo_backend())
    assert result.documents.count() == 1 and os.path.isdir(result.scratch)
    result.close()
    assert not os.path.exists(result.scratch)
