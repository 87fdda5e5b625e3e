"""Operator inputs derived row by row from the given tables.

No input needs a shuffle and none drops rows; remainders of ids only vary what
a row looks like. Each derivation has its SQL twin below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSIONS = (
    ".pdf", ".PDF", ".jpg", ".Jpeg", ".png", ".webp", ".tiff",
    ".bmp", ".gif", ".txt", "", ".pdf", ".xyz.pdf",
)
MAGIC = ("FFD8FF", "52494646", "49492A00", "4D4D002A", "89504E47", "")

PAGE_WORDS = 200
LINE_WORDS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as it is scanned."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], number: str) -> Column:
    choices = F.array(*[F.lit(value) for value in values])
    return F.element_at(choices, (F.col(number) % len(values) + 1).cast("int"))


def _sql_pick(values: tuple[str, ...], number: str) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return f"([{listed}])[{number} % {len(values)} + 1]"


def extension() -> Column:
    """The extension of a document's file."""
    return _pick(EXTENSIONS, "doc_id")


EXTENSION_SQL = _sql_pick(EXTENSIONS, "doc_id")


def magic_bytes(number: str) -> Column:
    """How many leading bytes a file of ``files`` has before its text."""
    return F.octet_length(F.unhex(_pick(MAGIC, number)))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: any extension, any leading bytes, some bad paths."""
    slot = F.col("doc_id") % 97
    folder = F.concat(F.lit("/corpus/"), F.col("source"))
    path = (
        F.when(slot == 7, F.lit(None))
        .when(slot == 8, "")
        .when(slot == 9, F.concat(folder, F.lit("/.doc"), F.col("doc_id")))
        .otherwise(F.concat(folder, F.lit("/doc-"), F.col("doc_id"), _pick(EXTENSIONS, "doc_id")))
    )
    extra = F.map_from_arrays(
        F.array(F.lit("doc_id"), F.lit("lang"), F.lit("images"), F.lit("loc")),
        F.array(
            F.col("doc_id").cast("string"),
            F.col("lang"),
            F.lit("caller"),
            F.when(F.col("doc_id") % 5 == 0, '{"pageNumber": 7}'),
        ),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        path.alias("source"),
        F.concat(F.unhex(_pick(MAGIC, "doc_id")), F.col("text").cast("binary")).alias("content"),
        extra.alias("extra"),
    )


FILES_SQL = f"""
files AS (
  SELECT doc_id, lang, text,
    CASE WHEN doc_id % 97 = 7 THEN NULL
         WHEN doc_id % 97 = 8 THEN ''
         WHEN doc_id % 97 = 9 THEN '/corpus/' || source || '/.doc' || doc_id
         ELSE '/corpus/' || source || '/doc-' || doc_id || {_sql_pick(EXTENSIONS, "doc_id")} END AS source,
    CASE WHEN doc_id % 97 = 7 THEN NULL
         WHEN doc_id % 97 IN (8, 9) THEN ''
         ELSE replace(lower({_sql_pick(EXTENSIONS, "doc_id")}), '.xyz', '') END AS ext,
    {_sql_pick(MAGIC, "doc_id")} AS magic,
    unhex({_sql_pick(MAGIC, "doc_id")}) || encode(text) AS content
  FROM documents
),
admitted AS (
  SELECT *,
    CASE WHEN source IS NULL OR source = '' THEN 'File path is required in metadata.source'
         WHEN ext NOT IN ('.jpg', '.jpeg', '.png', '.webp', '.tiff', '.bmp', '.gif', '.pdf')
         THEN 'Unsupported file type. Supported types: .jpg, .jpeg, .png, .webp, .tiff, .bmp, .gif, .pdf'
    END AS error,
    CASE WHEN ext = '.pdf' THEN 'pdf'
         WHEN ext IN ('.jpg', '.jpeg', '.png', '.webp', '.tiff', '.bmp', '.gif') THEN 'image' END AS kind,
    CASE magic WHEN 'FFD8FF' THEN 'image/jpeg' WHEN '52494646' THEN 'image/webp'
               WHEN '49492A00' THEN 'image/tiff' WHEN '4D4D002A' THEN 'image/tiff'
               ELSE 'image/png' END AS image_mime
  FROM files
)
"""


def pdf_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored answer per document, one page per line; some are broken."""
    line_no = lambda i: i.cast("int")

    def page(line: Column, i: Column) -> Column:
        i, size = line_no(i), F.length(line)
        image = F.struct(
            F.concat(F.lit("img-"), i).alias("id"),
            F.when(i % 3 != 0, i).alias("topLeftX"),
            size.alias("topLeftY"),
            (i + size).alias("bottomRightX"),
            F.when(i % 5 != 0, 2 * size).alias("bottomRightY"),
            F.when(i % 2 == 0, F.replace(F.base64(line.cast("binary")), F.lit("\r\n"), F.lit(""))).alias(
                "imageBase64"
            ),
        )
        return F.struct(
            F.nullif(line, F.lit("")).alias("markdown"),
            F.when(i % 4 != 3, F.array(image)).alias("images"),
            F.when(
                i % 3 != 2,
                F.struct(F.lit(72).alias("dpi"), (i + 100).alias("height"), size.alias("width")),
            ).alias("dimensions"),
        )

    pages = F.transform(F.split("text", "\n"), page)
    slot = F.col("doc_id") % 31
    response = (
        F.when(slot == 3, "{}")
        .when(slot == 4, '{"pages":[null]}')
        .when(slot == 5, '{"pages":[]}')
        .when(slot != 6, F.to_json(F.struct(pages.alias("pages"))))
    )
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/answers/doc-"), F.col("doc_id"), F.lit(".pdf")).alias("source"),
        F.lit("pdf").alias("kind"),
        F.create_map(F.lit("lang"), F.col("lang")).alias("extra"),
        response.alias("response"),
        F.when(slot == 6, "HTTP 503").alias("error"),
    )


PDF_ANSWERS_SQL = """
answers AS (
  SELECT doc_id, lang, text, '/answers/doc-' || doc_id || '.pdf' AS source,
    CASE doc_id % 31 WHEN 3 THEN 'OCR processing failed: Malformed response structure'
                     WHEN 4 THEN 'OCR processing failed: Cannot read properties of null (reading ''images'')'
                     WHEN 6 THEN 'OCR processing failed: HTTP 503' END AS fault
  FROM documents
),
answer_pages AS (
  SELECT source, lang, i, line, length(line) AS size
  FROM (
    SELECT source, lang, generate_subscripts(lines, 1) - 1 AS i, unnest(lines) AS line
    FROM (SELECT source, lang, string_split(text, chr(10)) AS lines
          FROM answers WHERE fault IS NULL AND doc_id % 31 <> 5)
  )
)
"""


def image_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored answer per line item; a second page that must not be used."""
    number = F.col("l_linenumber")
    region = F.struct(
        F.col("l_returnflag").alias("id"),
        F.col("l_partkey").cast("int").alias("topLeftX"),
        F.when(number % 2 == 1, F.col("l_suppkey").cast("int")).alias("topLeftY"),
        number.alias("bottomRightX"),
        F.lit(None).cast("int").alias("bottomRightY"),
    )
    pages = F.array(
        F.struct(
            F.when(number != 4, F.concat_ws(" ", "l_returnflag", "l_linestatus", "l_partkey")).alias("markdown"),
            F.when(number != 3, F.array(region, region)).alias("images"),
        ),
        F.struct(F.lit("second page").alias("markdown"), F.array(region).alias("images")),
    )
    response = (
        F.when(number == 7, "{}")
        .when(number == 6, '{"pages":[]}')
        .when(number == 5, '{"pages":[null]}')
        .otherwise(F.to_json(F.struct(pages.alias("pages"))))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("/scans/"), F.col("l_orderkey"), F.lit("-"), number, F.lit(".png")).alias("source"),
        F.lit("image").alias("kind"),
        F.when(number == 2, F.struct(F.lit(9).alias("pageNumber"))).alias("loc"),
        response.alias("response"),
    )


IMAGE_ANSWERS_SQL = """
image_answers AS (
  SELECT *, '/scans/' || l_orderkey || '-' || l_linenumber || '.png' AS source,
    CASE WHEN l_linenumber >= 5 THEN 'OCR processing failed: Malformed response structure' END AS fault,
    CASE WHEN l_linenumber = 4 THEN ''
         ELSE l_returnflag || ' ' || l_linestatus || ' ' || l_partkey END AS content
  FROM lineitem
)
"""


def text_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents as placed text; some lines run on, some pages are broken."""
    words = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "str"))
    place = F.col("pos") % PAGE_WORDS
    line = F.expr(f"pos % {PAGE_WORDS} div {LINE_WORDS}")
    y = 800.0 - 14.25 * (line - F.when(line % 7 == 6, 1).otherwise(0))
    page_no = F.expr(f"pos div {PAGE_WORDS} + 1").cast("int")
    broken = (F.col("doc_id") % 23 == 4) & (F.col("pos") == 5)
    return words.select(
        text_source(),
        page_no.alias("page_no"),
        F.col("pos").alias("item_seq"),
        "str",
        F.when(~broken & (place >= 0), y).alias("y"),
    )


def pages_with_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same words as pages that hold their items, as an extractor hands them over."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("words"))
    firsts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(PAGE_WORDS))
    # Cut inside the array, so that a page's row does not carry the whole document.
    cut = F.transform(firsts, lambda first: F.struct(first.alias("first"), F.slice("words", first + 1, PAGE_WORDS).alias("words")))
    pages = docs.select("doc_id", F.explode(cut).alias("page")).select("doc_id", "page.*")

    def item(word: Column, i: Column) -> Column:
        line = F.floor(i / LINE_WORDS)
        y = 800.0 - 14.25 * (line - F.when(line % 7 == 6, 1).otherwise(0))
        broken = (F.col("doc_id") % 23 == 4) & (F.col("first") + i == 5)
        return F.struct(word.alias("str"), F.when(~broken, y).alias("y"))

    page_no = F.expr(f"first div {PAGE_WORDS} + 1").cast("int")
    return pages.select(text_source(), page_no.alias("page_no"), F.transform("words", item).alias("items"))


def text_source() -> Column:
    return F.concat(F.lit("/text/doc-"), F.col("doc_id"), F.lit(".pdf")).alias("source")


def text_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PDF info of the same files; some have trailing pages without text."""
    words = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    pages = F.floor((words + (PAGE_WORDS - 1)) / PAGE_WORDS) + F.col("doc_id") % 3
    return table(spark, sf_dir, "documents").select(
        text_source(),
        F.lit("1.0").alias("version"),
        F.when(F.col("doc_id") % 4 != 0, F.create_map(F.lit("lang"), F.col("lang"))).alias("info"),
        F.when(F.col("doc_id") % 5 != 0, F.create_map(F.lit("origin"), F.col("source"))).alias("metadata"),
        pages.cast("int").alias("num_pages"),
    )


TEXT_ITEMS_SQL = f"""
items AS (
  SELECT source, pos, str, CAST(pos // {PAGE_WORDS} + 1 AS BIGINT) AS page_no,
    CASE WHEN doc_id % 23 = 4 AND pos = 5 THEN NULL
         ELSE 800.0 - 14.25 * (line - CASE WHEN line % 7 = 6 THEN 1 ELSE 0 END) END AS y
  FROM (
    SELECT doc_id, '/text/doc-' || doc_id || '.pdf' AS source, pos, str,
      pos % {PAGE_WORDS} // {LINE_WORDS} AS line
    FROM (
      SELECT doc_id, generate_subscripts(words, 1) - 1 AS pos, unnest(words) AS str
      FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents)
    )
  )
),
placed AS (
  SELECT source, page_no, pos, y,
    CASE WHEN lag(pos) OVER w IS NULL OR y = lag(y) OVER w THEN str ELSE chr(10) || str END AS piece
  FROM items WINDOW w AS (PARTITION BY source, page_no ORDER BY pos)
),
page_texts AS (
  SELECT source, page_no,
    CASE WHEN bool_or(y IS NULL) THEN '' ELSE string_agg(piece, '' ORDER BY pos) END AS text
  FROM placed GROUP BY source, page_no
),
text_info AS (
  SELECT '/text/doc-' || doc_id || '.pdf' AS source, lang, source AS origin, doc_id,
    CAST((length(text) - length(replace(text, ' ', '')) + {PAGE_WORDS}) // {PAGE_WORDS} + doc_id % 3 AS BIGINT)
      AS num_pages
  FROM documents
),
all_pages AS (
  SELECT i.source, i.num_pages, p.page_no, coalesce(t.text, '') AS text
  FROM (SELECT source, num_pages, unnest(range(1, num_pages + 1)) AS page_no FROM text_info) p
  JOIN text_info i ON i.source = p.source
  LEFT JOIN page_texts t ON t.source = p.source AND t.page_no = p.page_no
)
"""


def turn_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as files whose pages are already rows."""
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("/talks/"), F.col("conv_id"), F.lit(".pdf")).alias("source"),
        (F.col("turn") + 1).cast("int").alias("page_no"),
        "text",
    )


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as PDF files of 0 to 5 pages."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("/pdf/order-"), F.col("o_orderkey"), F.lit(".pdf")).alias("source"),
        (F.col("o_orderkey") % 6).cast("int").alias("num_pages"),
    )


def page_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as page-image requests; options are often empty or zero."""
    number = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_discount").alias("scale"),
        F.when(F.col("l_returnflag") == "A", "jpeg").when(F.col("l_returnflag") == "R", "").alias("output_format"),
        F.when(number != 3, F.col("l_quantity").cast("int") % 10).alias("quality"),
        (F.col("l_quantity").cast("int") % 12 - 2).alias("page_number"),
        (F.col("l_partkey") % 9).cast("int").alias("num_pages"),
    )


PAGE_REQUESTS_SQL = """
requests AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_discount = 0 THEN 2.0 ELSE l_discount END AS scale,
    CASE WHEN l_returnflag = 'A' THEN 'jpeg' ELSE 'png' END AS output_format,
    CASE WHEN l_linenumber = 3 OR CAST(l_quantity AS BIGINT) % 10 = 0 THEN 100
         ELSE CAST(l_quantity AS BIGINT) % 10 END AS quality,
    CASE WHEN CAST(l_quantity AS BIGINT) % 12 = 2 THEN 1
         ELSE CAST(l_quantity AS BIGINT) % 12 - 2 END AS page_number,
    l_partkey % 9 AS num_pages
  FROM lineitem
)
"""


def html_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages' bytes in the place of page images."""
    return table(spark, sf_dir, "pages").select("page_id", F.col("html").cast("binary").alias("content"))
