"""Column expressions on literal cases."""

from __future__ import annotations

import base64
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pageloom.functions.json_text import metadata_json
from pageloom.functions.media import data_uri, ocr_request, sniff_mime, transcoded
from pageloom.functions.paths import file_ext, page_file_path, plain_path
from pageloom.functions.render import conversion_error, page_bounds_error, page_limit, render_options
from pageloom.functions.text import page_text, preview_fixed, preview_if_longer
from pageloom.schemas import METADATA


def values(spark, rows, schema, *columns):
    return [tuple(row) for row in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_file_ext(spark):
    cases = {
        "test.pdf": ".pdf",
        "test.PDF": ".pdf",
        "/a.b/c": "",
        "/a.b/c.TIFF": ".tiff",
        "archive.tar.gz": ".gz",
        "noext": "",
        ".hidden": "",
        "/x/.hidden": "",
        ".hidden.png": ".png",
        "ends.": ".",
        "a.pdf/": ".pdf",
        "a.pdf//": ".pdf",
        "..": "",
        "/x/..": "",
        "...": ".",
        "..a": ".a",
        "/": "",
        "": "",
        "a b.jp g": ".jp g",
        "new\nline.pdf": ".pdf",
        "a.pdf\n": ".pdf\n",
        "http://h/825?page=2": "",
    }
    got = values(spark, [(key,) for key in cases], "source string", "source", file_ext("source"))
    assert dict(got) == cases


def test_file_ext_of_missing_path(spark):
    assert values(spark, [(None,)], "source string", file_ext("source")) == [(None,)]


def test_plain_path(spark):
    rows = [("file:/a/b.pdf",), ("file:///a/b.pdf",), ("/a/file:/b",), ("hdfs://nn/a",)]
    got = values(spark, rows, "p string", plain_path("p"))
    assert got == [("/a/b.pdf",), ("/a/b.pdf",), ("/a/file:/b",), ("hdfs://nn/a",)]


@pytest.mark.parametrize(
    ("directory", "path"),
    [("out", "out/page-3.png"), ("out/", "out/page-3.png"), ("", "page-3.png"), ("/", "/page-3.png")],
)
def test_page_file_path(spark, directory, path):
    got = values(spark, [(directory, 3, "png")], "d string, n int, f string", page_file_path("d", "n", "f"))
    assert got == [(path,)]


@pytest.mark.parametrize(
    ("head", "mime"),
    [
        ("89504E470D0A1A0A", "image/png"),
        ("FFD8FF", "image/jpeg"),
        ("FFD8", "image/jpeg"),
        ("52494646", "image/webp"),
        ("5249", "image/webp"),
        ("49492A00", "image/tiff"),
        ("4D4D002A", "image/tiff"),
        ("49492A", "image/png"),
        ("4D4D2A00", "image/png"),
        ("424D", "image/png"),
        ("47494638", "image/png"),
        ("FF", "image/png"),
        ("", "image/png"),
    ],
)
def test_sniff_mime(spark, head, mime):
    assert values(spark, [(bytes.fromhex(head),)], "c binary", sniff_mime("c")) == [(mime,)]


def test_transcoded_tiff_becomes_jpeg_or_stays(spark):
    intel, motorola, png = bytes.fromhex("49492A00"), bytes.fromhex("4D4D002A"), b"\x89PNG"
    rows = [(intel,), (motorola,), (png,)]

    def codec(tiff):
        return F.when(F.hex(tiff) == "49492A00", F.lit(b"converted-jpeg"))

    with_codec = transcoded("c", sniff_mime("c"), codec)
    without = transcoded("c", sniff_mime("c"))
    got = values(spark, rows, "c binary", with_codec["content"], with_codec["mime"])
    assert got == [(b"converted-jpeg", "image/jpeg"), (motorola, "image/tiff"), (png, "image/png")]
    kept = values(spark, rows, "c binary", without["content"], without["mime"])
    assert kept == [(intel, "image/tiff"), (motorola, "image/tiff"), (png, "image/png")]


def test_transcoder_sees_only_tiff(spark):
    eager = transcoded("c", sniff_mime("c"), lambda tiff: F.coalesce(tiff, F.lit(b"made up")))
    got = values(spark, [(b"\x89PNG",)], "c binary", eager["content"], eager["mime"])
    assert got == [(b"\x89PNG", "image/png")]


def test_transcoder_may_be_a_pandas_udf(spark):
    @F.pandas_udf("binary")
    def codec(tiff: pd.Series) -> pd.Series:
        return tiff.map(lambda content: None if content is None else b"jpeg:" + bytes(content))

    out = transcoded("c", sniff_mime("c"), codec)
    rows = [(bytes.fromhex("49492A00"),), (b"\x89PNG",)]
    got = values(spark, rows, "c binary", out["content"], out["mime"])
    assert got == [(b"jpeg:II*\x00", "image/jpeg"), (b"\x89PNG", "image/png")]


def test_data_uri_has_no_line_breaks(spark):
    content = bytes(range(256)) * 5
    [(uri,)] = values(spark, [(content,)], "c binary", data_uri(F.lit("image/png"), "c"))
    assert uri == "data:image/png;base64," + base64.b64encode(content).decode()


def test_ocr_request(spark):
    rows = [("image", "data:a"), ("pdf", "data:b")]
    got = values(spark, rows, "kind string, uri string", ocr_request("kind", "uri", "test-model"))
    assert [json.loads(request) for (request,) in got] == [
        {"model": "test-model", "document": {"type": "image_url", "imageUrl": "data:a"}, "includeImageBase64": True},
        {
            "model": "test-model",
            "document": {"type": "document_url", "documentUrl": "data:b"},
            "includeImageBase64": True,
        },
    ]


def test_text_and_previews(spark):
    rows = [(None,), ("short",), ("é" * 500,), ("x" * 501,)]
    got = values(spark, rows, "t string", page_text("t"), preview_fixed("t"), preview_if_longer("t"))
    assert got == [
        ("", None, None),
        ("short", "short...", "short"),
        ("é" * 500, "é" * 200 + "...", "é" * 500),
        ("x" * 501, "x" * 200 + "...", "x" * 500 + "..."),
    ]


@pytest.mark.parametrize("length", [1, 2, 5, 8])
def test_previews_count_utf16_units(spark, length):
    texts = ["", "ab", "😀", "a😀", "😀😀😀", "abcd😀", "aé😀b😀c", "x" * 8, "x" * 9, "😀" * 9, "abcdefg😀", "1234😀6"]
    got = values(spark, [(t,) for t in texts], "t string", preview_fixed("t", length), preview_if_longer("t", length))

    def cut(text):
        return text.encode("utf-16-be")[: 2 * length].decode("utf-16-be", errors="replace") + "..."

    def units(text):
        return len(text.encode("utf-16-be")) // 2

    assert got == [(cut(t), cut(t) if units(t) > length else t) for t in texts]


def test_render_options_default_when_empty(spark):
    schema = "s double, f string, q int, p int"
    rows = [(None, None, None, None), (0.0, "", 0, 0), (float("nan"), "webp", 80, -1), (1.5, "jpeg", 1, 7)]
    options = render_options("s", "f", "q", "p")
    names = ("scale", "output_format", "quality", "page_number")
    got = values(spark, rows, schema, *[options[name] for name in names])
    assert got == [(2.0, "png", 100, 1), (2.0, "png", 100, 1), (2.0, "webp", 80, -1), (1.5, "jpeg", 1, 7)]


def test_page_bounds(spark):
    rows = [(0, 3), (1, 3), (3, 3), (4, 3)]
    error = page_bounds_error("n", "m")
    got = values(spark, rows, "n int, m int", error, conversion_error(error), conversion_error(error, True))
    inner = "Invalid page number: 4. PDF has 3 pages."
    page = "Failed to convert PDF to image: "
    assert got[1:3] == [(None, None, None)] * 2
    assert got[3] == (inner, page + inner, "Failed to convert PDF to images: " + page + inner)
    assert got[0][0] == "Invalid page number: 0. PDF has 3 pages."


def test_page_limit(spark):
    limits = [page_limit("n", limit) for limit in (0, -1, 1, 5, 9)]
    assert values(spark, [(5,)], "n int", *limits) == [(5, 5, 1, 5, 5)]


REGION = dict(id="img1", top_left_x=10, top_left_y=20, bottom_right_x=100, bottom_right_y=200)


def json_of(spark, **fields):
    empty = dict(source="t.pdf", images=None, dimensions=None, loc=None, pdf=None, extra=None)
    df = spark.createDataFrame([({**empty, **fields},)], "metadata struct<" + _fields() + ">")
    return df.select(metadata_json("metadata")).first()[0]


def _fields():
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in METADATA.fields)


def expected(value):
    return json.dumps(value, indent=2, ensure_ascii=False)


def test_metadata_json_of_a_pdf_page(spark):
    got = json_of(
        spark,
        images=[{**REGION, "image_base64": "data"}, {**REGION, "image_base64": None}],
        dimensions=dict(dpi=None, height=600, width=800),
        pdf=dict(version="1.0", info={"Title": 'a "b"\n'}, metadata=None, totalPages=2, loc=dict(pageNumber=2)),
        extra={"lang": "fr"},
    )
    assert got == expected(
        {
            "source": "t.pdf",
            "lang": "fr",
            "pdf": {
                "version": "1.0",
                "info": {"Title": 'a "b"\n'},
                "metadata": None,
                "totalPages": 2,
                "loc": {"pageNumber": 2},
            },
            "images": [{**REGION, "image_base64": "data"}, REGION],
            "dimensions": {"height": 600, "width": 800},
        }
    )


def test_metadata_json_of_unread_pdf_image_and_combined(spark):
    unread = dict(version=None, info=None, metadata=None, totalPages=None, loc=dict(pageNumber=1))
    page = json_of(spark, images=[], pdf=unread)
    assert page == expected({"source": "t.pdf", "images": [], "dimensions": None, "pdf": {"loc": {"pageNumber": 1}}})
    image = json_of(spark, images=[], loc=dict(pageNumber=1))
    assert image == expected({"source": "t.pdf", "images": [], "dimensions": None, "loc": {"pageNumber": 1}})
    combined = json_of(spark, pdf=dict(version="1", info={}, metadata={}, totalPages=1, loc=None))
    assert combined == expected(
        {"source": "t.pdf", "pdf": {"version": "1", "info": {}, "metadata": {}, "totalPages": 1}}
    )
