"""The plans are what they are meant to be."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from pageloom.operators.admission import admit, ingest_table, missing_sources, rejected
from pageloom.operators.images import page_fanout
from pageloom.operators.pdf_info import attach_pdf_info
from pageloom.operators.request import build_requests
from pageloom.operators.report import page_total
from pageloom.operators.response import check_responses, combine_pages, response_rejects, to_documents
from pageloom.operators.text_items import document_parts, page_counts, parse_pdf, parse_pdf_parts, text_lines
from pageloom.schemas import CHECKED_RESPONSE, TEXT_RESPONSE
from pageloom.session import materialize, run_dir
from pageloom.sources.files import scan_files


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (?!.*ReusedExchange)", plan(df)))


@pytest.fixture(scope="module")
def responses(spark):
    rows = [("a.pdf", "pdf", '{"pages":[{"markdown":"x"}]}', None)]
    path = run_dir(spark, "plan-responses")
    spark.createDataFrame(rows, "source string, kind string, response string, error string").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([], "source string, page_no int, item_seq int, str string, y double")


@pytest.fixture(scope="module")
def info(spark):
    return spark.createDataFrame([], "source string, version string, num_pages int")


@pytest.mark.parametrize(
    "make", [to_documents, lambda df: to_documents(df, False), combine_pages, response_rejects]
)
def test_responses_are_parsed_once_without_a_shuffle(responses, make):
    df = make(responses)
    assert exchanges(df) == 0
    assert plan(df).count("from_json(") == 1


def test_checked_answers_are_not_parsed_again(responses):
    checked = materialize(check_responses(responses), "plan-checked")
    assert "from_json" not in plan(to_documents(checked))
    rejects = plan(response_rejects(checked))
    assert "from_json" not in rejects
    assert re.search(r"ReadSchema: (.*)", rejects).group(1) == "struct<source:string,fault:string>"
    assert "PushedFilters: [IsNotNull(fault)]" in rejects


def test_answers_are_read_as_far_as_they_are_needed(responses):
    read = lambda df: re.search(r"from_json\((.*)", plan(df)).group(1)
    for df in (response_rejects(responses), page_total(responses)):
        assert "StructField(id," in read(df)
        assert "imageBase64" not in read(df) and "markdown" not in read(df) and "dimensions" not in read(df)
    text = read(combine_pages(responses))
    assert "StructField(markdown," in text and "imageBase64" not in text and "dimensions" not in text
    assert "imageBase64" in read(to_documents(responses)) and "imageBase64" in read(to_documents(responses, False))


ODD = [
    '{"pages":[{"markdown":"x","images":"oops"}]}', '{"pages":[{"markdown":"x","dimensions":{"dpi":"abc"}}]}',
    '{"pages":[{"markdown":{"a":1},"images":[null]}]}', '{"pages":[{"images":[{"topLeftX":"q"}]},{"markdown":"y"}]}',
    '{"pages":[null,{}]}', '{"pages":[5]}', '{"pages":"x"}', '{"pages":[{"images":[5]}]}', '{"pages":[{"images":[{"imageBase64":5}]}]}',
    '{"pages":[{"markdown":"x"', '{"pages":{"markdown":"x"}}', '[{"pages":[]}]', '{"pages":[{"dimensions":7}]}', '{"pages":[]}', "", None,
]


def test_reading_less_checks_the_same(spark):
    rows = [(f"{i}.{kind}", kind, text) for i, text in enumerate(ODD) for kind in ("pdf", "image")]
    answers = spark.createDataFrame(rows, "source string, kind string, response string")
    faults = lambda df: sorted((r.source, r.fault) for r in df.collect())
    whole = faults(check_responses(answers).select("source", F.coalesce("fault", F.lit("")).alias("fault")))
    for schema in (CHECKED_RESPONSE, TEXT_RESPONSE):
        assert faults(check_responses(answers, schema).select("source", F.coalesce("fault", F.lit("")).alias("fault"))) == whole
    combined = lambda df: sorted((r.source, r.page_content) for r in df.collect())
    pdfs = to_documents(answers.where("kind = 'pdf'"), False)
    assert combined(combine_pages(answers)) == combined(pdfs)


def test_text_moves_once_per_step(items, info):
    assert exchanges(text_lines(items)) == 2
    assert exchanges(parse_pdf_parts(items, info)) == 2
    assert exchanges(parse_pdf(items, info)) == 3
    assert exchanges(parse_pdf(items, info, part_pages=0)) == 2
    assert "Join" not in plan(parse_pdf(items, info))
    assert exchanges(document_parts(items.withColumnRenamed("str", "text"))) == 1


def test_page_limit_and_columns_reach_the_scan(spark, items, info):
    path = run_dir(spark, "plan-items")
    items.withColumn("font", F.lit("x")).write.parquet(path)
    parsed = plan(parse_pdf(spark.read.parquet(path), info, max_pages=2))
    assert "LessThanOrEqual(page_no,2)" in parsed
    assert "font" not in parsed


def test_counts_are_combined_before_the_shuffle(items):
    assert "partial_count" in plan(page_counts(items))


def test_fanout_moves_blocks_and_not_pages(info):
    lines = [line.strip(" :+-*()0123456789") for line in plan(page_fanout(info)).splitlines()]
    generates = [i for i, line in enumerate(lines) if line.startswith("Generate")]
    [exchange] = [i for i, line in enumerate(lines) if line.startswith("Exchange")]
    assert generates[0] < exchange < generates[1]


def test_rejects_do_not_read_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"x")
    files = ingest_table(scan_files(spark, str(tmp_path)))
    names = rejected(admit(files))
    assert "content" not in re.search(r"ReadSchema: (.*)", plan(names)).group(1)
    assert "content" in plan(build_requests(admit(files)))
    assert exchanges(build_requests(admit(files))) == 0


def wide(spark, rows, name):
    """A table on storage too wide to be broadcast under the test's threshold."""
    path = run_dir(spark, name)
    rows.withColumn("pad", F.sha2(F.rand(1).cast("string"), 512)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def settings(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "10b",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10b",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_keys(spark, n):
    """A third of all rows share one source."""
    source = F.when(F.col("id") % 3 == 0, "hot.pdf").otherwise(F.concat(F.lit("c"), F.col("id"), F.lit(".pdf")))
    return spark.range(0, n, 1, 8).select(source.alias("source"), F.lit("pdf").alias("kind"))


def test_a_hot_source_is_split_when_info_is_attached(spark, settings):
    n = 30_000
    files = wide(spark, hot_keys(spark, n), "hot-files")
    info = spark.range(n).select(
        F.when(F.col("id") == 0, "hot.pdf").otherwise(F.concat(F.lit("c"), F.col("id"), F.lit(".pdf"))).alias("source"),
        F.lit("1").alias("version"),
        (F.col("id") + 1).cast("int").alias("num_pages"),
    )
    files = files.withColumn("pdf", F.lit(None))
    attached = attach_pdf_info(files, info)
    rows = attached.select("source", F.col("pdf.totalPages").alias("pages")).collect()
    assert len(rows) == n
    assert all(row.pages == 1 for row in rows if row.source == "hot.pdf")
    assert all(row.pages is not None for row in rows)
    attached.select("source", "pad", "pdf").write.format("noop").mode("overwrite").save()
    final = attached.select("source", "pad", "pdf")
    final.collect()
    assert "skew=true" in plan(final)


def test_a_hot_missing_path_is_collapsed_before_the_shuffle(spark, settings):
    n = 90_000
    requested = hot_keys(spark, n)
    listed = requested.filter("source <> 'hot.pdf'")
    missing = missing_sources(requested, listed.union(listed))
    [row] = missing.collect()
    assert (row.source, row.error, row.requests) == ("hot.pdf", "File not found: hot.pdf", n // 3)
    first = missing_sources(requested, listed)
    assert exchanges(first) == 2 and "partial_count" in plan(first)
