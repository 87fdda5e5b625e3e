"""Text from placed items against a plain loop over them."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pageloom import parse_pdf, text_lines
from pageloom.operators.text_items import (
    combine_page_table,
    custom_renderer,
    document_parts,
    document_text,
    item_runs,
    page_counts,
    parse_pdf_parts,
    text_chunks,
)

ITEMS = "source string, page_no int, item_seq int, str string, y double"
INFO = "source string, version string, info map<string,string>, num_pages int"


def page_text(items):
    """What a page should read: ``(str, y)`` in order."""
    text, last = "", None
    for i, (word, y) in enumerate(items):
        if y is None:
            return ""
        text += word if i == 0 or last == y else "\n" + word
        last = y
    return text


def file_text(pages, count, fails=lambda text: False):
    texts = [page_text(pages.get(number, [])) for number in range(1, count + 1)]
    return "".join("\n\n" + text for text in texts if not fails(text))


def random_items(seed, sources=6, pages=5, most=40):
    rng = random.Random(seed)
    rows, by_file = [], defaultdict(lambda: defaultdict(list))
    for source in range(sources):
        for page in range(1, pages + 1):
            seq = 0
            for _ in range(rng.choice([0, 1, 2, most])):
                seq += rng.choice([1, 1, 1, 7])
                y = rng.choice([0.1 + 0.2, 0.3, 10.0, 10.0, -0.0, 0.0, float("nan")])
                if rng.random() < 0.003:
                    y = None
                word = rng.choice(["", "a", "bé", " c ", "d\n", "e😀"])
                rows.append((f"f{source}", page, seq, word, y))
                by_file[f"f{source}"][page].append((word, y))
    rng.shuffle(rows)
    return rows, by_file


@pytest.mark.parametrize(("seed", "chunk"), [(1, 4096), (2, 3), (3, 1)])
def test_text_lines_equals_a_loop(spark, seed, chunk):
    rows, by_file = random_items(seed)
    got = {
        (row.source, row.page_no): row.text
        for row in text_lines(spark.createDataFrame(rows, ITEMS).repartition(5), chunk).collect()
    }
    assert got == {(s, p): page_text(items) for s, pages in by_file.items() for p, items in pages.items() if items}


@pytest.mark.parametrize(
    ("items", "text"),
    [
        ([("a", 1.0), ("b", 1.0)], "ab"),
        ([("a", 1.0), ("b", 2.0), ("c", 1.0)], "a\nb\nc"),
        ([("a", 0.1 + 0.2), ("b", 0.3)], "a\nb"),
        ([("a", 0.0), ("b", -0.0)], "ab"),
        ([("a", math.nan), ("b", math.nan)], "a\nb"),
        ([("", 1.0), ("b", 2.0)], "\nb"),
        ([("a", 1.0), ("b", None)], ""),
    ],
)
@pytest.mark.parametrize("chunk", [1, 4096])
def test_line_rules(spark, items, text, chunk):
    rows = [("f", 1, i, word, y) for i, (word, y) in enumerate(items)]
    assert text_lines(spark.createDataFrame(rows, ITEMS), chunk).first().text == text == page_text(items)


@pytest.mark.parametrize("max_pages", [0, -1, 1, 3, 99])
@pytest.mark.parametrize(("chunk", "part"), [(4096, 1024), (2, 2), (3, 0)])
def test_parse_pdf_equals_a_loop(spark, max_pages, chunk, part):
    rows, by_file = random_items(7)
    counts = {f"f{i}": 4 + i % 3 for i in range(6)} | {"blank": 2, "none": 0}
    rows = [row for row in rows if row[1] <= counts[row[0]]]
    info = [(s, "5.0", {"Title": s} if s != "f0" else None, n) for s, n in counts.items()]
    # A file that could not be opened has items at most, and no result.
    rows.append(("unopened", 1, 1, "x", 1.0))
    items, infos = spark.createDataFrame(rows, ITEMS), spark.createDataFrame(info, INFO)
    parsed = parse_pdf(items, infos, max_pages, chunk_items=chunk, part_pages=part)
    got = {row.source: row for row in parsed.collect()}
    assert set(got) == set(counts)
    for source, count in counts.items():
        rendered = count if max_pages <= 0 else min(max_pages, count)
        row = got[source]
        assert row.text == file_text(by_file[source], rendered)
        assert (row.numpages, row.numrender, row.version) == (count, rendered, "5.0")
        assert row.info == (None if source == "f0" else {"Title": source}) and row.metadata is None


def test_failing_pages_depend_on_the_renderer(spark):
    rows = [("f", 1, 0, "good", 1.0), ("f", 2, 0, "bad", 1.0), ("f", 3, 0, "x", None)]
    items = spark.createDataFrame(rows, ITEMS)
    info = spark.createDataFrame([("f", "1", None, 4)], INFO)
    default = parse_pdf(items, info).first()
    assert default.text == "\n\ngood\n\nbad\n\n\n\n"
    custom = parse_pdf(items, info, renderer=lambda page: F.when(page.text != "bad", page.text)).first()
    assert custom.text == "\n\ngood\n\n\n\n"
    nothing = parse_pdf(items, info, renderer=lambda page: F.lit(None).cast("string")).first()
    assert (nothing.text, nothing.numpages, nothing.numrender) == ("", 4, 4)


def test_custom_renderer(spark):
    rows = [("f", 1, 0, "a", 1.0), ("f", 2, 0, "b", 1.0), ("f", 3, 0, "c", 1.0)]
    items = spark.createDataFrame(rows, ITEMS)
    info = spark.createDataFrame([("f", "1", None, 3)], INFO)
    tag = F.lit("[Custom Renderer] ")
    parsed = parse_pdf(items, info, max_pages=2, renderer=lambda page: F.concat(tag, page.text)).first()
    assert parsed.text == "\n\n[Custom Renderer] a\n\n[Custom Renderer] b"
    assert (parsed.numpages, parsed.numrender) == (3, 2)

    @F.pandas_udf("string")
    def shout(text: pd.Series) -> pd.Series:
        return text.str.upper()

    shouted = parse_pdf(items, info, renderer=lambda page: shout(page.text)).first()
    assert shouted.text == "\n\nA\n\nB\n\nC"
    kept = custom_renderer(text_lines(items), lambda page: F.when(page.page_no != 2, page.text))
    assert sorted(row.page_no for row in kept.collect()) == [1, 3]


@pytest.mark.parametrize("chunk", [1, 2, 4096])
def test_renderer_over_the_items(spark, chunk):
    rows = [("f", 1, i, word, y) for i, (word, y) in enumerate([("a", 1.0), ("b", 1.0), ("c", None)])]
    items = spark.createDataFrame(rows, ITEMS)
    info = spark.createDataFrame([("f", "1", None, 2)], INFO)

    def spaced(page):
        return F.array_join(F.transform(page.items, lambda item: F.concat_ws("@", item["str"], item["y"])), " ")

    parsed = parse_pdf(items, info, renderer=spaced, with_items=True, chunk_items=chunk).first()
    assert parsed.text == "\n\na@1.0 b@1.0 c\n\n"
    pages = custom_renderer(text_lines(items, chunk, with_items=True), spaced)
    assert [(row.text, len(row)) for row in pages.collect()] == [("a@1.0 b@1.0 c", 3)]


def test_text_of_page_rows(spark):
    pages = spark.createDataFrame(
        [("a", n, f"p{n}") for n in (3, 1, 2, 10)] + [("b", 1, "")], "source string, page_no int, text string"
    )
    for part in (1, 2, 1024):
        texts = {row.source: row.text for row in document_text(pages, part).collect()}
        assert texts == {"a": "\n\np1\n\np2\n\np3\n\np10", "b": "\n\n"}
        combined = {row.source: row.text for row in combine_page_table(pages, part).collect()}
        assert combined == {"a": "p1\n\np2\n\np3\n\np10", "b": ""}
    parts = document_parts(pages, 2).filter("source = 'a'").orderBy("part").collect()
    assert [(row.part, row.text) for row in parts] == [(0, "\n\np1\n\np2"), (1, "\n\np3"), (4, "\n\np10")]


def test_page_counts_include_failed_pages(spark):
    pages = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, None), ("a", 3, "y"), ("b", 1, "z")], "source string, page_no int, text string"
    )
    got = {row.source: (row.numpages, row.numrender) for row in page_counts(pages, 2).collect()}
    assert got == {"a": (3, 2), "b": (1, 1)}


def test_a_hot_page_is_cut_before_it_is_gathered(spark):
    """One page holds most items: no group of the first step exceeds a chunk."""
    n, chunk = 20_000, 500
    hot = spark.range(n).select(
        F.lit("hot").alias("source"),
        F.lit(1).alias("page_no"),
        F.col("id").cast("int").alias("item_seq"),
        F.concat(F.lit("w"), F.col("id")).alias("str"),
        F.floor(F.col("id") / 7).cast("double").alias("y"),
    )
    cold = spark.createDataFrame([(f"c{i}", 1, 0, "x", 1.0) for i in range(50)], ITEMS)
    items = hot.unionByName(cold)
    chunks = text_chunks(items, chunk).collect()
    assert Counter(row.source for row in chunks)["hot"] == n // chunk
    assert all(row.body.count("w") <= chunk for row in chunks)
    text = {row.source: row.text for row in text_lines(items, chunk).collect()}
    assert text["hot"] == page_text([(f"w{i}", float(i // 7)) for i in range(n)])
    assert len(text) == 51


def test_a_hot_file_is_put_together_in_parts(spark):
    pages, per_part = 5_000, 100
    items = spark.range(pages).select(
        F.lit("hot").alias("source"),
        (F.col("id") + 1).cast("int").alias("page_no"),
        F.lit(0).alias("item_seq"),
        F.concat(F.lit("p"), F.col("id")).alias("str"),
        F.lit(1.0).alias("y"),
    )
    info = spark.createDataFrame([("hot", "1", None, pages)], INFO)
    parts = parse_pdf_parts(items, info, part_pages=per_part).orderBy("part").collect()
    assert len(parts) == pages // per_part
    assert all(row.text.count("p") == per_part for row in parts)
    want = "".join(f"\n\np{i}" for i in range(pages))
    assert "".join(row.text for row in parts) == want
    assert parse_pdf(items, info, part_pages=per_part).first().text == want


def test_what_moves_is_a_row_for_a_chunk_and_a_string_for_a_line(spark):
    n, line, chunk = 3_000, 10, 500
    items = spark.range(0, n, 1, 2).select(
        F.lit("f").alias("source"),
        F.lit(1).alias("page_no"),
        F.col("id").cast("int").alias("item_seq"),
        F.concat(F.lit("w"), F.col("id")).alias("str"),
        F.floor(F.col("id") / line).cast("double").alias("y"),
    )
    rows = item_runs(items, chunk).collect()
    assert len(rows) == n // chunk
    assert sum(len(row.runs) for row in rows) == n // line
    [(run,)] = item_runs(items.where("item_seq < 3")).select("runs").first()
    assert (run.item_seq, run.str, run.y, run["items"]) == (0, "w0\x1fw1\x1fw2", 0.0, 3)


@pytest.mark.parametrize("chunk", [2, 4096])
@pytest.mark.parametrize("with_items", [False, True])
def test_runs_that_overlap_or_hold_the_mark(spark, chunk, with_items):
    """Numbers given twice, in two runs that do not meet, and texts with the mark itself."""
    words = ["a", "b\x1fc", "", "\x1f", "é", "x", "x", ""]
    rows = [("f", 1, i, word, 1.0) for i, word in enumerate(words)]
    again = [("f", 1, i, word + "2", 1.0) for i, word in enumerate(words)]
    rows += again + [(None, None, 0, "n", 1.0), (None, None, 1, None, 1.0), ("g", 1, None, "q", 1.0), ("g", 1, None, "p", 1.0)]
    got = text_lines(spark.createDataFrame(rows, ITEMS).coalesce(1), chunk, with_items).collect()
    both = "".join("".join(sorted((word, word + "2"))) for word in words)
    assert {(row.source, row.page_no): row.text for row in got} == {("f", 1): both, (None, None): "n", ("g", 1): "pq"}
    if with_items:
        items = next(row["items"] for row in got if row.source == "f")
        assert [(item.item_seq, item.str) for item in items] == [(i, w + e) for i, w in enumerate(words) for e in ("", "2")]
