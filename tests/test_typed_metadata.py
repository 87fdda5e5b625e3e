"""Caller keys whose values have types of their own."""

from __future__ import annotations

import json

import pytest

from pageloom import LoadOptions, load_stored, load_table
from pageloom.functions.json_text import number_text, typed_text
from pageloom.operators.admission import ingest_table
from pageloom.operators.pdf_info import attach_pdf_info, doc_info
from pageloom.operators.report import page_report
from pageloom.schemas import OPEN_MAP, OPEN_PDF
from pyspark.sql import functions as F
from tests.backends import echo_backend

KEYS = "struct<n: int, ratio: double, ok: boolean, tags: array<string>, who: struct<name: string, none: int>, text: string>"
GIVEN = (3, 0.5, True, ["a", "b"], ("x\"y", None), "plain")


def plain(extra):
    return {key: value.toPython() for key, value in extra.items()}


WANTED = {"n": 3, "ratio": 0.5, "ok": True, "tags": ["a", "b"], "who": {"name": 'x"y', "none": None}, "text": "plain"}


def files(spark, kind=KEYS, given=GIVEN, source="a.pdf"):
    return spark.createDataFrame([(source, b"one\ftwo", given)], f"source string, content binary, extra {kind}")


@pytest.mark.parametrize("form", ["struct", "variant", "map", "json"])
def test_typed_keys_reach_the_documents_through_a_call(spark, form):
    table = files(spark)
    if form == "variant":
        table = table.withColumn("extra", F.to_variant_object("extra"))
    elif form == "map":
        table = table.withColumn("extra", F.to_variant_object("extra").cast(OPEN_MAP))
    elif form == "json":
        table = table.withColumn("extra", F.parse_json(F.to_json("extra", {"ignoreNullFields": "false"})))
    result = load_table(table, echo_backend())
    rows = result.documents.collect()
    assert len(rows) == 2
    for row in rows:
        got = plain(row.metadata.extra)
        assert float(got.pop("ratio")) == 0.5
        assert got == {k: v for k, v in WANTED.items() if k != "ratio"}
    result.close()


def test_maps_of_other_values(spark):
    for kind, given, wanted in (
        ("map<string, bigint>", {"a": 1, "b": None}, {"a": 1, "b": None}),
        ("map<string, array<int>>", {"a": [1, 2]}, {"a": [1, 2]}),
        ("map<string, boolean>", None, None),
    ):
        [row] = ingest_table(files(spark, kind, given)).collect()
        got = row.extra and {k: v and v.toPython() for k, v in row.extra.items()}
        assert got == wanted


def test_strings_stay_strings(spark):
    [row] = ingest_table(files(spark, "map<string, string>", {"a": "1", "loc": '{"pageNumber": 4}'})).collect()
    assert row.extra == {"a": "1"} and row.loc.pageNumber == 4


def test_a_variant_that_is_no_object_has_no_keys(spark):
    table = files(spark).withColumn("extra", F.parse_json(F.lit("[1, 2]")))
    assert ingest_table(table).first().extra is None


@pytest.mark.parametrize("loc", ['{"pageNumber": 7}', '"{\\"pageNumber\\": 7}"', "5", "null", '"no json"'])
def test_location_and_pdf_under_typed_keys(spark, loc):
    text = f'{{"lang": "fr", "loc": {loc}, "source": 1, "pdf": {{"version": "9", "info": {{"Pages": 2}}}}}}'
    [row] = ingest_table(files(spark).withColumn("extra", F.parse_json(F.lit(text)))).collect()
    assert plain(row.extra) == {"lang": "fr"}
    assert (row.loc.pageNumber if row.loc else None) == (7 if "7" in loc else None)
    assert row.pdf.version == "9" and plain(row.pdf.info) == {"Pages": 2}


def test_computed_keys_win_over_typed_ones(spark):
    table = files(spark, "struct<images: int, dimensions: boolean, kept: int>", (1, True, 2))
    answers = spark.createDataFrame([("a.pdf", '{"pages":[{"markdown":"m"}]}')], "source string, response string")
    [page] = load_stored(table, answers).documents.collect()
    assert plain(page.metadata.extra) == {"kept": 2} and page.metadata.images == []
    [whole] = load_stored(table, answers, LoadOptions(split_pages=False)).documents.collect()
    assert plain(whole.metadata.extra) == {"images": 1, "dimensions": True, "kept": 2}


def test_typed_pdf_info(spark):
    info = spark.createDataFrame(
        [("a.pdf", "5.0", (2, True), {"x": "y"}, 3)],
        "source string, version string, info struct<Pages: int, Signed: boolean>, metadata map<string, string>, num_pages int",
    )
    assert dict(doc_info(info).dtypes)["info"] == "map<string,variant>"
    short = spark.createDataFrame([("a.pdf", "pdf", None), ("b.pdf", "pdf", None)], "source string, kind string, pdf string")
    short = short.withColumn("pdf", F.lit(None))
    read, unread = attach_pdf_info(short, info).orderBy("source").collect()
    assert plain(read.pdf.info) == {"Pages": 2, "Signed": True} and plain(read.pdf.metadata) == {"x": "y"}
    assert read.pdf.totalPages == 3 and unread.pdf is None
    answers = spark.createDataFrame([("a.pdf", '{"pages":[{}]}')], "source string, response string")
    documents = load_stored(files(spark, "map<string, string>", {"k": "v"}), answers, pdf_info=info).documents
    assert documents.schema["metadata"].dataType["pdf"].dataType == OPEN_PDF
    printed = json.loads(page_report(documents).first().metadata)
    assert printed["pdf"]["info"] == {"Pages": 2, "Signed": True} and printed["k"] == "v"


def test_the_report_prints_types(spark):
    answers = spark.createDataFrame([("a.pdf", '{"pages":[{}]}')], "source string, response string")
    documents = load_stored(files(spark), answers, LoadOptions(split_pages=False)).documents
    text = page_report(documents).first().metadata
    assert text == json.dumps({"source": "a.pdf", **WANTED}, indent=2)


@pytest.mark.parametrize(
    "text",
    ["{}", "[]", "[[], {}]", '{"a": {"b": [1, {"c": "{[,:]}"}]}, "d": "\\"\\\\"}', '"x"', "null", "true", '["\\u0001", "é"]'],
)
def test_nested_values_are_laid_out_like_the_rest(spark, text):
    got = spark.range(1).select(typed_text(F.parse_json(F.lit(text)), 0)).first()[0]
    want = json.dumps(json.loads(text), indent=2, ensure_ascii=False).replace("\n", "\n  ")
    assert got == want


def test_long_values_do_not_exhaust_the_stack(spark):
    value = {"s": "\\\"" * 50_000, "l": list(range(2000))}
    got = spark.range(1).select(typed_text(F.parse_json(F.lit(json.dumps(value))), 0)).first()[0]
    assert json.loads(got) == value


@pytest.mark.parametrize(
    ("java", "script"),
    [("1.0", "1"), ("-0.0", "0"), ("0.1", "0.1"), ("1.234567825E7", "12345678.25"), ("-3.0E8", "-300000000"), ("1.0E20", "100000000000000000000")]
    + [("1.25E21", "1.25e+21"), ("1.0E300", "1e+300"), ("1.5E-7", "1.5e-7"), ("1.0E-5", "0.00001"), ("100", "100")],
)
def test_numbers_are_printed_without_needless_parts(spark, java, script):
    assert spark.range(1).select(number_text(F.lit(java))).first()[0] == script
