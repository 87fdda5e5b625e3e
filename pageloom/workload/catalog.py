"""Queries by name, each with the SQL that gives the same rows.

Results are flat: integers as bigint, bytes as digest or base64.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.media import data_uri, sniff_mime
from pageloom.functions.paths import file_ext, page_file_path
from pageloom.functions.render import page_bounds_error
from pageloom.functions.text import preview_fixed, preview_if_longer
from pageloom.operators import admission, images, pdf_info, report, response, text_items
from pageloom.operators.ocr import stored_responses
from pageloom.operators.request import build_requests, media
from pageloom.plans import page_images
from pageloom.options import LoadOptions
from pageloom.plans.load import listed_paths, load_stored
from pageloom.schemas import PDF
from pageloom.session import run_dir
from pageloom.sources.blobs import save_page_images, write_blobs
from pageloom.sources.files import list_files, read_sources, read_tree, scan_files
from pageloom.workload import inputs
from pageloom.workload.inputs import (
    FILES_SQL,
    IMAGE_ANSWERS_SQL,
    PAGE_REQUESTS_SQL,
    PDF_ANSWERS_SQL,
    TEXT_ITEMS_SQL,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        # The suffix keeps a query apart from a function it imports.
        name = fn.__name__.removesuffix("_query")
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn

    return register


def long(name: str | Column, alias: str | None = None) -> Column:
    column = F.col(name) if isinstance(name, str) else name
    return column.cast("bigint").alias(alias or str(name))


def admitted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.admit(admission.ingest_table(inputs.files(spark, sf_dir)))


def doc_key() -> Column:
    return F.try_element_at("extra", F.lit("doc_id")).cast("bigint").alias("doc_id")


# Sources and sinks


@query("""
SELECT 'doc-' || doc_id || '.bin' AS name, octet_length(encode(text)) AS length, md5(text) AS digest FROM documents
""")
def scan_files_query(spark, sf_dir):
    root = run_dir(spark, "scan")
    name = F.concat(F.lit(f"{root}/doc-"), F.col("doc_id"), F.lit(".bin"))
    write_blobs(
        table(spark, sf_dir, "documents").select(name.alias("path"), F.col("text").cast("binary").alias("content"))
    )
    return scan_files(spark, root).select(
        F.substring_index("source", "/", -1).alias("name"), "length", F.md5("content").alias("digest")
    )


def written_tree(spark, sf_dir, name: str) -> str:
    """Documents as files in folders by language and number, some with hidden names, of any type; returns the root."""
    root = run_dir(spark, name)
    folder = F.concat_ws("/", F.lit(root), "lang", (F.col("doc_id") % 10).cast("string"))
    start = F.when(F.col("doc_id") % 4 == 1, "_").when(F.col("doc_id") % 4 == 2, ".").otherwise("")
    path = F.concat(folder, F.lit("/"), start, F.lit("doc-"), F.col("doc_id"), inputs.extension())
    write_blobs(table(spark, sf_dir, "documents").select(path.alias("path"), F.col("text").cast("binary").alias("content")))
    return root


TREE_SQL = f"""
tree AS (
  SELECT *, lang || '/' || (doc_id % 10) || '/' || CASE doc_id % 4 WHEN 1 THEN '_' WHEN 2 THEN '.' ELSE '' END
    || 'doc-' || doc_id || {inputs.EXTENSION_SQL} AS name
  FROM documents
)
"""


@query(f"WITH {TREE_SQL} SELECT name, CAST(octet_length(encode(text)) AS BIGINT) AS length FROM tree")
def list_files_query(spark, sf_dir):
    """A tree listed in tasks, hidden names included."""
    listed = list_files(spark, written_tree(spark, sf_dir, "listed"))
    return listed.files.select(F.substring_index("source", "/", -3).alias("name"), "length")


@query(f"""
WITH {TREE_SQL},
typed AS (SELECT *, lower(regexp_extract({inputs.EXTENSION_SQL}, '(\\.[^.]*)$', 1)) AS last FROM tree)
SELECT name, kind, CASE WHEN kind IS NOT NULL THEN md5(text) END AS digest,
  CASE WHEN kind = 'pdf' AND doc_id % 3 = 0 THEN doc_id % 9 + 1 END AS total_pages
FROM (
  SELECT *, CASE WHEN doc_id % 4 = 2 AND {inputs.EXTENSION_SQL} = '' THEN NULL WHEN last = '.pdf' THEN 'pdf'
    WHEN last IN ('.jpg', '.jpeg', '.png', '.webp', '.tiff', '.bmp', '.gif') THEN 'image' END AS kind
  FROM typed
)
""")
def listed_sources(spark, sf_dir):
    """Listed names joined to their PDF info, then the files of supported types read where their names are."""
    root = written_tree(spark, sf_dir, "sources")
    listed = list_files(spark, root).files
    number = F.regexp_extract("source", r"doc-(\d+)", 1).cast("bigint")
    info = listed.where(number % 3 == 0).select("source", F.lit("1.0").alias("version"), (number % 9 + 1).cast("int").alias("num_pages"))
    paths = listed_paths(listed, LoadOptions(), info)
    admitted = admission.admit(admission.ingest_table(read_sources(paths, opened="opened")))
    return admitted.select(
        F.substring_index("source", "/", -3).alias("name"),
        "kind",
        F.md5("content").alias("digest"),
        long(F.when(F.col("kind") == "pdf", F.col("pdf.totalPages")), "total_pages"),
    )


@query("""
SELECT '/orders/' || o_orderkey || '.pdf' AS source, 'File not found: /orders/' || o_orderkey || '.pdf' AS error,
  count(*) AS requests
FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
GROUP BY o_orderkey
""")
def missing_sources(spark, sf_dir):
    def path(key: str) -> Column:
        return F.concat(F.lit("/orders/"), F.col(key), F.lit(".pdf")).alias("source")

    requested = table(spark, sf_dir, "orders").select(path("o_orderkey"))
    scanned = table(spark, sf_dir, "lineitem").select(path("l_orderkey"))
    return admission.missing_sources(requested, scanned)


@query(f"""
WITH {FILES_SQL}
SELECT doc_id, kind, octet_length(content) AS bytes, lang,
  CASE WHEN doc_id % 5 = 0 THEN CAST(7 AS BIGINT) END AS caller_page
FROM admitted WHERE error IS NULL
""")
def ingest_table(spark, sf_dir):
    return admission.accepted(admitted_files(spark, sf_dir)).select(
        doc_key(),
        "kind",
        long(F.octet_length("content"), "bytes"),
        F.col("extra")["lang"].alias("lang"),
        long(F.col("loc.pageNumber"), "caller_page"),
    )


@query("""
SELECT '/talks/' || conv_id || '.pdf' AS source, turn + 1 AS page_no,
  'talk-' || conv_id || '/page-' || (turn + 1) || '.png' AS path, md5(text) AS digest
FROM conversations
""")
def page_file_paths(spark, sf_dir):
    root = run_dir(spark, "page-files")
    pages = inputs.turn_pages(spark, sf_dir).select(
        "source",
        "page_no",
        F.concat(F.lit("talk-"), F.regexp_extract("source", r"(\d+)\.pdf", 1)).alias("dir"),
        F.lit("png").alias("fmt"),
        F.col("text").cast("binary").alias("content"),
    )
    saved = save_page_images(pages, root)
    relative = F.substring_index("path", "/", -2)
    found = read_tree(spark, root).select(
        F.substring_index("source", "/", -2).alias("path"), F.md5("content").alias("digest")
    )
    return saved.select("source", long("page_no"), relative.alias("path")).join(found, "path", "left")


@query("""
SELECT '/cards/' || c_custkey || '.pdf' AS source, page_no, 'page-' || page_no || '.png' AS name,
  md5('/cards/' || c_custkey || '.pdf:' || page_no) AS digest
FROM (SELECT c_custkey, unnest(range(1, c_custkey % 4 + 1)) AS page_no FROM customer WHERE c_custkey % 7 <> 2)
""")
def save_pdf_pages_query(spark, sf_dir):
    """All pages of many files, some of which have a page that fails."""
    # The hook stands for an image library.
    def draw(source: Column, page_no: Column, scale: Column) -> Column:
        bad = F.regexp_extract(source, r"(\d+)\.pdf", 1).cast("bigint") % 7 == 2
        return F.when(~(bad & (page_no == 1)), F.concat_ws(":", source, page_no).cast("binary"))

    root = run_dir(spark, "saved-pages")
    name = F.concat(F.lit("/cards/"), F.col("c_custkey"), F.lit(".pdf"))
    pages = (F.col("c_custkey") % 4).cast("int")
    files = table(spark, sf_dir, "customer").select(name.alias("source"), pages.alias("num_pages"))
    written, _ = page_images.save_pdf_pages(files, root, draw)
    found = read_tree(spark, root).select(
        F.substring_index("source", root.rpartition("/")[2], -1).alias("place"), F.md5("content").alias("digest")
    )
    place = F.substring_index("path", root.rpartition("/")[2], -1)
    return (
        written.withColumn("place", place)
        .join(found, "place", "full")
        .select("source", long("page_no"), F.substring_index("place", "/", -1).alias("name"), "digest")
    )


# Filters and routing


@query(f"WITH {FILES_SQL} SELECT doc_id, ext FROM files")
def file_ext_query(spark, sf_dir):
    return inputs.files(spark, sf_dir).select("doc_id", file_ext("source").alias("ext"))


@query(f"""
WITH {FILES_SQL}
SELECT doc_id, error IS NULL AS supported, error FROM admitted WHERE source <> ''
""")
def supported_filter(spark, sf_dir):
    admitted = admitted_files(spark, sf_dir).filter(F.col("source") != "")
    return admitted.select(doc_key(), F.col("error").isNull().alias("supported"), "error")


@query(f"WITH {FILES_SQL} SELECT doc_id, source, error FROM admitted WHERE source IS NULL OR source = ''")
def require_source(spark, sf_dir):
    checked = inputs.files(spark, sf_dir).withColumn("error", admission.source_error(F.col("source")))
    return checked.filter(F.col("error").isNotNull()).select("doc_id", "source", "error")


@query(f"WITH {FILES_SQL} SELECT doc_id, source, kind FROM admitted WHERE error IS NULL")
def route_kind(spark, sf_dir):
    return admission.accepted(admitted_files(spark, sf_dir)).select(doc_key(), "source", "kind")


@query(f"""
WITH {PAGE_REQUESTS_SQL}
SELECT l_orderkey, l_linenumber, page_number, num_pages,
  CASE WHEN page_number < 1 OR page_number > num_pages
       THEN 'Invalid page number: ' || page_number || '. PDF has ' || num_pages || ' pages.' END AS error,
  CASE WHEN page_number < 1 OR page_number > num_pages
       THEN 'Failed to convert PDF to image: Invalid page number: ' || page_number || '. PDF has ' || num_pages
            || ' pages.' END AS raised
FROM requests
""")
def page_bounds(spark, sf_dir):
    checked = images.page_bounds(inputs.page_requests(spark, sf_dir))
    return checked.select(
        "l_orderkey",
        "l_linenumber",
        long("page_number"),
        long("num_pages"),
        page_bounds_error("page_number", "num_pages").alias("error"),
        F.col("error").alias("raised"),
    )


@query(f"""
WITH {TEXT_ITEMS_SQL}
SELECT source, page_no, count(*) AS items FROM items WHERE page_no <= 2 GROUP BY source, page_no
""")
def page_limit(spark, sf_dir):
    kept = text_items.limit_pages(inputs.text_items(spark, sf_dir), 2)
    return kept.groupBy("source", long("page_no")).agg(F.count(F.lit(1)).alias("items"))


# Scalar functions


@query(f"WITH {FILES_SQL} SELECT doc_id, image_mime AS mime FROM admitted")
def sniff_mime_query(spark, sf_dir):
    return inputs.files(spark, sf_dir).select("doc_id", sniff_mime("content").alias("mime"))


@query(f"""
WITH {FILES_SQL}
SELECT doc_id, md5(CASE WHEN kind = 'image' AND magic = '49492A00' THEN unhex('FFD8') || content ELSE content END)
    AS digest,
  CASE WHEN kind = 'pdf' THEN 'application/pdf'
       WHEN magic = '49492A00' THEN 'image/jpeg' ELSE image_mime END AS mime
FROM admitted WHERE error IS NULL
""")
def transcoded_mime(spark, sf_dir):
    def jpeg(tiff: Column) -> Column:
        # Stands for an image codec: succeeds on one byte order only.
        return F.when(F.hex(F.substring(tiff, 1, 4)) == "49492A00", F.concat(F.unhex(F.lit("FFD8")), tiff))

    sent = media(admission.accepted(admitted_files(spark, sf_dir)), jpeg)
    return sent.select(doc_key(), F.md5("content").alias("digest"), "mime")


@query(f"""
WITH {FILES_SQL} SELECT doc_id, 'data:' || image_mime || ';base64,' || base64(content) AS uri FROM admitted
""")
def data_uri_query(spark, sf_dir):
    return inputs.files(spark, sf_dir).select("doc_id", data_uri(sniff_mime("content"), "content").alias("uri"))


@query(f"""
WITH {FILES_SQL}
SELECT doc_id, CASE WHEN error IS NULL THEN '{{"model":"ocr-latest","document":{{"type":"'
  || CASE WHEN kind = 'pdf' THEN 'document_url","documentUrl":"data:application/pdf'
          ELSE 'image_url","imageUrl":"data:' || image_mime END
  || ';base64,' || base64(content) || '"}},"includeImageBase64":true}}' END AS request
FROM admitted
""")
def ocr_request(spark, sf_dir):
    return build_requests(admitted_files(spark, sf_dir)).select(doc_key(), "request")


@query(f"""
WITH {PDF_ANSWERS_SQL} SELECT source, i + 1 AS page_no, line AS text FROM answer_pages
""")
def page_text(spark, sf_dir):
    documents = response.to_documents(inputs.pdf_answers(spark, sf_dir))
    return documents.select(
        "source", long(F.col("metadata.pdf.loc.pageNumber"), "page_no"), F.col("page_content").alias("text")
    )


@query("SELECT doc_id, substring(text, 1, 200) || '...' AS preview FROM documents")
def preview_fixed_query(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", preview_fixed("text").alias("preview"))


@query("""
SELECT doc_id, CASE WHEN length(text) > 500 THEN substring(text, 1, 500) || '...' ELSE text END AS preview
FROM documents
""")
def preview_if_longer_query(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", preview_if_longer("text").alias("preview"))


@query("""
SELECT '/out/' || l_orderkey || '/page-' || l_linenumber || '.'
  || CASE WHEN l_returnflag = 'A' THEN 'jpeg' ELSE 'png' END AS path
FROM lineitem
""")
def page_file_name(spark, sf_dir):
    fmt = F.when(F.col("l_returnflag") == "A", "jpeg").otherwise("png")
    folder = F.concat(F.lit("/out/"), F.col("l_orderkey"), F.lit("/"))
    return table(spark, sf_dir, "lineitem").select(page_file_path(folder, "l_linenumber", fmt).alias("path"))


@query(f"""
WITH {PAGE_REQUESTS_SQL}
SELECT l_orderkey, l_linenumber, CAST(scale AS DOUBLE) AS scale, output_format, quality, page_number FROM requests
""")
def render_options(spark, sf_dir):
    filled = images.apply_render_options(inputs.page_requests(spark, sf_dir))
    return filled.select(
        "l_orderkey", "l_linenumber", "scale", "output_format", long("quality"), long("page_number")
    )


# Responses to pages


@query(f"""
WITH {PDF_ANSWERS_SQL}
SELECT a.source, CASE a.doc_id % 31 WHEN 4 THEN 1 WHEN 5 THEN 0 WHEN 3 THEN NULL WHEN 6 THEN NULL
  ELSE p.pages END AS pages, p.chars
FROM answers a
LEFT JOIN (SELECT source, count(*) AS pages, CAST(sum(size) AS BIGINT) AS chars FROM answer_pages GROUP BY source) p
  ON p.source = a.source
""")
def parse_response(spark, sf_dir):
    parsed = response.parse_response(inputs.pdf_answers(spark, sf_dir))
    chars = F.aggregate(
        "pages",
        F.lit(0).cast("bigint"),
        lambda total, page: total + F.length(F.coalesce(page["markdown"], F.lit(""))),
    )
    sound = F.when((F.size("pages") > 0) & F.get("pages", F.lit(0)).isNotNull(), chars)
    pages = F.when(F.col("pages").isNotNull(), F.size("pages"))
    return parsed.select("source", long(pages, "pages"), long(sound, "chars"))


@query(f"""
WITH {PDF_ANSWERS_SQL}, {IMAGE_ANSWERS_SQL}
SELECT source, fault AS error FROM answers WHERE fault IS NOT NULL
UNION ALL SELECT source, fault FROM image_answers WHERE fault IS NOT NULL
""")
def malformed_response(spark, sf_dir):
    return response.response_rejects(all_answers(spark, sf_dir))


def all_answers(spark, sf_dir):
    return inputs.pdf_answers(spark, sf_dir).unionByName(
        inputs.image_answers(spark, sf_dir), allowMissingColumns=True
    )


@query(f"""
WITH {PDF_ANSWERS_SQL}
SELECT source, i + 1 AS page_no, nullif(line, '') AS markdown FROM answer_pages
""")
def explode_pages(spark, sf_dir):
    pages = response.explode_pages(inputs.pdf_answers(spark, sf_dir))
    return pages.select("source", long("page_no"), F.col("page.markdown").alias("markdown"))


@query(f"WITH {IMAGE_ANSWERS_SQL} SELECT source, content AS text FROM image_answers WHERE fault IS NULL")
def first_page(spark, sf_dir):
    pages = response.first_page(inputs.image_answers(spark, sf_dir))
    return response.page_documents(pages).select("source", F.col("page_content").alias("text"))


@query(f"""
WITH {PDF_ANSWERS_SQL}
SELECT source, i + 1 AS page_no, i % 4 <> 3 AS has_region,
  CASE WHEN i % 4 <> 3 THEN 'img-' || i END AS id,
  CASE WHEN i % 4 <> 3 THEN CASE WHEN i % 3 = 0 THEN 0 ELSE i END END AS top_left_x,
  CASE WHEN i % 4 <> 3 THEN size END AS top_left_y,
  CASE WHEN i % 4 <> 3 THEN i + size END AS bottom_right_x,
  CASE WHEN i % 4 <> 3 THEN CASE WHEN i % 5 = 0 THEN 0 ELSE 2 * size END END AS bottom_right_y,
  CASE WHEN i % 4 <> 3 AND i % 2 = 0 THEN base64(encode(line)) END AS image_base64
FROM answer_pages
""")
def image_regions(spark, sf_dir):
    documents = response.to_documents(inputs.pdf_answers(spark, sf_dir))
    rows = documents.select(
        "source",
        long(F.col("metadata.pdf.loc.pageNumber"), "page_no"),
        (F.size("metadata.images") > 0).alias("has_region"),
        F.explode_outer("metadata.images").alias("region"),
    )
    corners = ("top_left_x", "top_left_y", "bottom_right_x", "bottom_right_y")
    return rows.select(
        "source",
        "page_no",
        "has_region",
        "region.id",
        *[long(F.col(f"region.{name}"), name) for name in corners],
        "region.image_base64",
    )


@query(f"""
WITH {PDF_ANSWERS_SQL}
SELECT source, i + 1 AS page_no, i % 3 = 2 AS missing,
  CASE WHEN i % 3 <> 2 THEN CAST(72 AS BIGINT) END AS dpi,
  CASE WHEN i % 3 <> 2 THEN i + 100 END AS height,
  CASE WHEN i % 3 <> 2 THEN size END AS width
FROM answer_pages
""")
def page_dimensions(spark, sf_dir):
    size = F.col("metadata.dimensions")
    return response.to_documents(inputs.pdf_answers(spark, sf_dir)).select(
        "source",
        long(F.col("metadata.pdf.loc.pageNumber"), "page_no"),
        size.isNull().alias("missing"),
        *[long(size[name], name) for name in ("dpi", "height", "width")],
    )


def echoed(spark, sf_dir):
    """Admitted files answered without a service: their own text as one page."""
    admitted = admission.accepted(admitted_files(spark, sf_dir)).withColumn("doc_id", doc_key())
    after = F.substring("content", inputs.magic_bytes("doc_id") + 1, F.octet_length("content"))
    text = F.decode(after, "UTF-8")
    page = F.struct(text.alias("markdown"))
    return admitted.select(
        "source", "kind", "extra", "loc", "pdf", F.to_json(F.struct(F.array(page).alias("pages"))).alias("response")
    )


@query(f"""
WITH {FILES_SQL}
SELECT doc_id, source, 'doc_id=' || doc_id || ',lang=' || lang AS extra, CAST(0 AS BIGINT) AS images,
  md5(text) AS digest
FROM admitted WHERE error IS NULL
""")
def merge_metadata(spark, sf_dir):
    documents = response.to_documents(echoed(spark, sf_dir))
    entries = F.array_sort(F.map_entries("metadata.extra"))
    listed = F.array_join(F.transform(entries, lambda entry: F.concat_ws("=", entry["key"], entry["value"])), ",")
    return documents.select(
        F.col("metadata.extra")["doc_id"].cast("bigint").alias("doc_id"),
        "source",
        listed.alias("extra"),
        long(F.size("metadata.images"), "images"),
        F.md5("page_content").alias("digest"),
    )


@query(f"""
WITH {IMAGE_ANSWERS_SQL}
SELECT source, CAST(CASE WHEN l_linenumber = 2 THEN 9 ELSE 1 END AS BIGINT) AS page_no
FROM image_answers WHERE fault IS NULL
""")
def image_loc(spark, sf_dir):
    documents = response.to_documents(inputs.image_answers(spark, sf_dir))
    return documents.select("source", long(F.col("metadata.loc.pageNumber"), "page_no"))


@query(f"""
WITH {PDF_ANSWERS_SQL}
SELECT p.source, p.i + 1 AS page_no, CAST(l.pages AS BIGINT) AS total_pages
FROM answer_pages p
LEFT JOIN (SELECT '/answers/doc-' || doc_id || '.pdf' AS source, 1 + doc_id % 5 AS pages FROM labels) l
  ON l.source = p.source
""")
def pdf_loc(spark, sf_dir):
    # Pages without their texts and images are short: these rows are joined.
    pages = response.to_documents(inputs.pdf_answers(spark, sf_dir).transform(with_pdf))
    short = pages.select("source", F.lit("pdf").alias("kind"), F.col("metadata.pdf").alias("pdf"))
    informed = pdf_info.attach_pdf_info(short.withColumn("page", F.col("pdf.loc")), label_info(spark, sf_dir))
    pdf = F.struct(F.col("page").alias("loc"), F.col("pdf.totalPages").alias("totalPages"))
    return informed.select(
        "source", long(pdf["loc"]["pageNumber"], "page_no"), long(pdf["totalPages"], "total_pages")
    )


def with_pdf(df: DataFrame) -> DataFrame:
    return df.withColumn("pdf", F.lit(None).cast(PDF))


def label_info(spark, sf_dir):
    """PDF info for the labelled documents only."""
    return table(spark, sf_dir, "labels").select(
        F.concat(F.lit("/answers/doc-"), F.col("doc_id"), F.lit(".pdf")).alias("source"),
        F.lit("1.0").alias("version"),
        F.when(F.col("toxic") == 0, F.create_map(F.lit("quality"), F.col("quality").cast("string"))).alias("info"),
        (F.col("doc_id") % 5 + 1).cast("int").alias("num_pages"),
    )


@query(f"""
WITH {PDF_ANSWERS_SQL}, {IMAGE_ANSWERS_SQL}
SELECT source, line AS page_content, i + 1 AS page_no, CAST(CASE WHEN i % 4 = 3 THEN 0 ELSE 1 END AS BIGINT) AS images,
  lang
FROM answer_pages
UNION ALL
SELECT source, content, CASE WHEN l_linenumber = 2 THEN 9 ELSE 1 END, CASE WHEN l_linenumber = 3 THEN 0 ELSE 2 END,
  NULL
FROM image_answers WHERE fault IS NULL
""")
def to_documents(spark, sf_dir):
    meta = F.col("metadata")
    return response.to_documents(all_answers(spark, sf_dir)).select(
        "source",
        "page_content",
        long(F.coalesce(meta["loc"]["pageNumber"], meta["pdf"]["loc"]["pageNumber"]), "page_no"),
        long(F.size(meta["images"]), "images"),
        meta["extra"]["lang"].alias("lang"),
    )


# Join


@query("""
SELECT '/answers/doc-' || d.doc_id || '.pdf' AS source,
  CASE WHEN l.doc_id IS NOT NULL THEN '1.0' END AS version,
  CASE WHEN l.doc_id IS NOT NULL THEN 1 + d.doc_id % 5 WHEN d.doc_id % 10 = 0 THEN 99 END AS total_pages,
  CASE WHEN l.toxic = 0 THEN CAST(l.quality AS VARCHAR) END AS quality
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def attach_pdf_info(spark, sf_dir):
    given = F.struct(
        F.lit(None).alias("version"),
        F.lit(None).alias("info"),
        F.lit(None).alias("metadata"),
        F.lit(99).alias("totalPages"),
        F.lit(None).alias("loc"),
    ).cast(PDF)
    files = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/answers/doc-"), F.col("doc_id"), F.lit(".pdf")).alias("source"),
        F.lit("pdf").alias("kind"),
        F.when(F.col("doc_id") % 10 == 0, given).alias("pdf"),
    )
    return pdf_info.attach_pdf_info(files, label_info(spark, sf_dir)).select(
        "source",
        F.col("pdf.version").alias("version"),
        long(F.col("pdf.totalPages"), "total_pages"),
        F.col("pdf.info")["quality"].alias("quality"),
    )


# External call, renderers and errors


def sent_text(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/sent/"), F.col("doc_id"), F.when(F.col("doc_id") % 2 == 0, ".pdf").otherwise(".png")).alias(
            "source"
        ),
        F.col("text").cast("binary").alias("content"),
    )
    return build_requests(admission.admit(admission.ingest_table(files)))


def sent_files(spark, sf_dir) -> DataFrame:
    name = F.concat(F.lit("/sent/"), F.col("doc_id"), F.when(F.col("doc_id") % 2 == 0, ".pdf").otherwise(".png"))
    return table(spark, sf_dir, "documents").select(
        name.alias("source"),
        F.col("text").cast("binary").alias("content"),
        F.create_map(F.lit("lang"), F.col("lang")).alias("extra"),
    )


def stored_answers(spark, sf_dir) -> DataFrame:
    """Answers of an earlier run: a page per line; some calls failed, some are missing."""
    pages = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("markdown")))
    failed = F.startswith("text", F.lit("E"))
    return table(spark, sf_dir, "documents").where(F.col("doc_id") % 41 != 3).select(
        F.concat(F.lit("/sent/"), F.col("doc_id"), F.when(F.col("doc_id") % 2 == 0, ".pdf").otherwise(".png")).alias("source"),
        F.when(~failed, F.to_json(F.struct(pages.alias("pages")))).alias("response"),
        F.when(failed, F.concat(F.lit("service refused "), F.col("lang"))).alias("error"),
    )


STORED_SQL = """
sent AS (
  SELECT doc_id, lang, text, '/sent/' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.pdf' ELSE '.png' END AS source,
    CASE WHEN doc_id % 41 = 3 THEN 'OCR processing failed: No stored response'
         WHEN starts_with(text, 'E') THEN 'OCR processing failed: service refused ' || lang END AS error
  FROM documents
)
"""


@query(f"""
WITH {STORED_SQL}
SELECT source, text FROM sent WHERE doc_id % 41 <> 3 AND error IS NULL
""")
def apply_ocr_query(spark, sf_dir):
    """Requests answered from a table of earlier answers, put together again."""
    answers = stored_responses(sent_text(spark, sf_dir), stored_answers(spark, sf_dir))
    pages = F.from_json("response", "pages array<struct<markdown: string>>")["pages"]
    text = F.array_join(F.transform(pages, lambda page: page["markdown"]), "\n")
    return answers.where("error IS NULL").select("source", text.alias("text"))


@query(f"""
WITH {STORED_SQL},
pages AS (
  SELECT *, generate_subscripts(lines, 1) AS page_no, unnest(lines) AS line
  FROM (SELECT *, string_split(text, chr(10)) AS lines FROM sent WHERE error IS NULL)
)
SELECT source, lang, page_no, md5(line) AS digest, CAST(CASE WHEN doc_id % 2 = 0 THEN 9 END AS BIGINT) AS total_pages
FROM pages WHERE doc_id % 2 = 0 OR page_no = 1
""")
def load_stored_query(spark, sf_dir):
    """The whole way from files to documents, with PDF info and the answers of an earlier run."""
    files = sent_files(spark, sf_dir)
    info = files.select("source", F.lit("1.0").alias("version"), F.lit(9).alias("num_pages"))
    meta = F.col("metadata")
    return load_stored(files, stored_answers(spark, sf_dir), pdf_info=info).documents.select(
        "source",
        meta["extra"]["lang"].alias("lang"),
        long(F.coalesce(meta["pdf"]["loc"]["pageNumber"], meta["loc"]["pageNumber"]), "page_no"),
        F.md5("page_content").alias("digest"),
        long(meta["pdf"]["totalPages"], "total_pages"),
    )


TYPED_SQL = f"""
{STORED_SQL},
typed AS (
  SELECT s.*, d.n_chars, d.source AS origin, n_chars * 0.25 AS pages, n_chars > 2000 AS long
  FROM sent s JOIN documents d USING (doc_id) WHERE s.error IS NULL
)
"""


def typed_files(spark, sf_dir) -> DataFrame:
    """The sent files with keys of several types, nested ones and one that a page overrides."""
    docs = table(spark, sf_dir, "documents")
    origin = F.struct(F.col("source").alias("name"), F.array("doc_id", F.col("doc_id") + 1).alias("ids"), F.lit(None).cast("int").alias("none"))
    keys = F.struct(
        "lang",
        "n_chars",
        (F.col("n_chars") * 0.25).alias("pages"),
        (F.col("n_chars") > 2000).alias("long"),
        origin.alias("origin"),
        F.lit(3).alias("images"),
        F.when(F.col("doc_id") % 3 == 0, F.struct((F.col("doc_id") % 7).cast("int").alias("pageNumber"))).alias("loc"),
    )
    name = F.concat(F.lit("/sent/"), F.col("doc_id"), F.when(F.col("doc_id") % 2 == 0, ".pdf").otherwise(".png"))
    return docs.select(name.alias("source"), F.col("text").cast("binary").alias("content"), keys.alias("extra"))


@query(f"""
WITH {TYPED_SQL}
SELECT doc_id, source, lang, n_chars, pages::DOUBLE AS pages, long, origin, [doc_id, doc_id + 1][2] AS second_id,
  CASE WHEN doc_id % 2 = 0 THEN 6 ELSE 5 END AS n_keys,
  CASE WHEN doc_id % 3 = 0 THEN doc_id % 7 WHEN doc_id % 2 = 1 THEN 1 END AS caller_page
FROM typed
""")
def merge_metadata_typed(spark, sf_dir):
    """Keys that hold numbers, booleans and nested values, merged and read back as what they are; a document for each file."""
    files, options = typed_files(spark, sf_dir), LoadOptions(split_pages=False)
    meta = F.col("metadata")
    at = lambda key, path, kind: F.variant_get(meta["extra"][key], path, kind)
    return load_stored(files, stored_answers(spark, sf_dir), options).documents.select(
        at("origin", "$.ids[0]", "bigint").alias("doc_id"),
        "source",
        at("lang", "$", "string").alias("lang"),
        at("n_chars", "$", "bigint").alias("n_chars"),
        at("pages", "$", "double").alias("pages"),
        at("long", "$", "boolean").alias("long"),
        at("origin", "$.name", "string").alias("origin"),
        at("origin", "$.ids[1]", "bigint").alias("second_id"),
        F.size(meta["extra"]).alias("n_keys"),
        long(meta["loc"]["pageNumber"], "caller_page"),
    )


@query(f"WITH {STORED_SQL} SELECT source, error FROM sent WHERE error IS NOT NULL")
def wrap_error(spark, sf_dir):
    return load_stored(sent_files(spark, sf_dir), stored_answers(spark, sf_dir)).rejects


@query(f"""
WITH {STORED_SQL}
SELECT source, lang, md5(CASE WHEN doc_id % 2 = 0 THEN replace(text, chr(10), chr(10) || chr(10))
                              ELSE split_part(text, chr(10), 1) END) AS digest,
  CASE WHEN doc_id % 2 = 0 THEN NULL ELSE CAST(0 AS BIGINT) END AS images
FROM sent WHERE error IS NULL
""")
def combined_documents(spark, sf_dir):
    """Images and PDFs in one pass, a document for each file."""
    files, options = sent_files(spark, sf_dir), LoadOptions(split_pages=False)
    documents = load_stored(files, stored_answers(spark, sf_dir), options).documents
    images = F.col("metadata.images")
    return documents.select(
        "source",
        F.col("metadata.extra")["lang"].alias("lang"),
        F.md5("page_content").alias("digest"),
        long(F.when(images.isNotNull(), F.size(images)), "images"),
    )


@query(f"""
WITH {TEXT_ITEMS_SQL}
SELECT source, '[Custom Renderer] ' || text AS text, page_no FROM page_texts
""")
def custom_renderer(spark, sf_dir):
    pages = text_items.text_lines(inputs.text_items(spark, sf_dir))
    rendered = text_items.custom_renderer(pages, lambda page: F.concat(F.lit("[Custom Renderer] "), page.text))
    return rendered.select("source", "text", long("page_no"))


@query(f"""
WITH {TEXT_ITEMS_SQL}
SELECT source, string_agg(str, ' ' ORDER BY pos) AS text, page_no FROM items GROUP BY source, page_no
""")
def item_renderer(spark, sf_dir):
    def spaced(page: text_items.Page) -> Column:
        return F.array_join(F.transform(page.items, lambda item: item["str"]), " ")

    pages = text_items.page_lines(inputs.pages_with_items(spark, sf_dir), with_items=True)
    return text_items.custom_renderer(pages, spaced).select("source", "text", long("page_no"))


@query(f"""
WITH {TEXT_ITEMS_SQL}
SELECT source,
  coalesce(string_agg(chr(10) || chr(10) || text, '' ORDER BY page_no) FILTER (NOT contains(text, 'é')), '') AS text,
  min(num_pages) AS numpages, min(num_pages) AS numrender
FROM all_pages GROUP BY source
""")
def page_failures(spark, sf_dir):
    def plain_only(page: text_items.Page) -> Column:
        # Stands for a renderer that cannot cope with some texts.
        return F.when(~F.contains(page.text, F.lit("é")), page.text)

    parsed = text_items.parse_pdf(
        inputs.text_items(spark, sf_dir), inputs.text_info(spark, sf_dir), renderer=plain_only
    )
    return parsed.select("source", "text", long("numpages"), long("numrender"))


# Aggregations and windows


@query(f"WITH {TEXT_ITEMS_SQL} SELECT source, page_no, text FROM page_texts")
def text_lines(spark, sf_dir):
    pages = text_items.text_lines(inputs.text_items(spark, sf_dir))
    return pages.select("source", long("page_no"), "text")


@query(f"WITH {TEXT_ITEMS_SQL} SELECT source, page_no, text FROM page_texts")
def text_lines_nested(spark, sf_dir):
    """As ``text_lines``, from pages that hold their items: no exchange."""
    pages = text_items.page_lines(inputs.pages_with_items(spark, sf_dir))
    return pages.select("source", long("page_no"), "text")


TURN_PAGES_SQL = """
turn_pages AS (
  SELECT '/talks/' || conv_id || '.pdf' AS source, turn + 1 AS page_no,
    CASE WHEN conv_id % 5 <> 1 AND (conv_id + turn) % 4 <> 1 THEN text END AS text
  FROM conversations
)
"""


def partly_failed(spark, sf_dir) -> DataFrame:
    """Pages that are already rows; some have no text, and some files none at all."""
    number = F.regexp_extract("source", r"(\d+)\.pdf", 1).cast("bigint")
    there = (number % 5 != 1) & ((number + F.col("page_no") - 1) % 4 != 1)
    return inputs.turn_pages(spark, sf_dir).withColumn("text", F.when(there, F.col("text")))


@query(f"""
WITH {TURN_PAGES_SQL}
SELECT source, coalesce(string_agg(chr(10) || chr(10) || text, '' ORDER BY page_no), '') AS text
FROM turn_pages GROUP BY source
""")
def document_text_pages(spark, sf_dir):
    return text_items.document_text(partly_failed(spark, sf_dir))


@query(f"""
WITH {TEXT_ITEMS_SQL}
SELECT source, 'PDF info is missing' AS error FROM text_info WHERE doc_id % 3 = 1
""")
def without_info(spark, sf_dir):
    third = F.regexp_extract("source", r"(\d+)\.pdf", 1).cast("bigint") % 3 != 1
    return text_items.without_info(inputs.text_items(spark, sf_dir), inputs.text_info(spark, sf_dir).where(third))


@query(f"""
WITH {TEXT_ITEMS_SQL}
SELECT source, string_agg(chr(10) || chr(10) || text, '' ORDER BY page_no) AS text FROM all_pages GROUP BY source
""")
def document_text(spark, sf_dir):
    parsed = text_items.parse_pdf(inputs.text_items(spark, sf_dir), inputs.text_info(spark, sf_dir))
    return parsed.select("source", "text")


def parsed_sql(limit: str) -> str:
    return f"""
WITH {TEXT_ITEMS_SQL}
SELECT source, num_pages AS numpages, least(num_pages, {limit}) AS numrender,
  CASE WHEN doc_id % 4 <> 0 THEN lang END AS lang, CASE WHEN doc_id % 5 <> 0 THEN origin END AS origin,
  (SELECT coalesce(string_agg(chr(10) || chr(10) || p.text, '' ORDER BY p.page_no), '')
   FROM all_pages p WHERE p.source = i.source AND p.page_no <= {limit}) AS text,
  '1.0' AS version
FROM text_info i
"""


def parsed(spark, sf_dir, max_pages: int) -> DataFrame:
    files = text_items.parse_pdf(
        inputs.text_items(spark, sf_dir), inputs.text_info(spark, sf_dir), max_pages=max_pages
    )
    return files.select(
        "source",
        long("numpages"),
        long("numrender"),
        F.col("info")["lang"].alias("lang"),
        F.col("metadata")["origin"].alias("origin"),
        "text",
        "version",
    )


@query(parsed_sql("num_pages"))
def parse_pdf(spark, sf_dir):
    return parsed(spark, sf_dir, max_pages=0)


@query(parsed_sql("2"))
def parse_pdf_limited(spark, sf_dir):
    return parsed(spark, sf_dir, max_pages=2)


@query(f"""
WITH {TEXT_ITEMS_SQL}
SELECT source, (page_no - 1) // 2 AS part, string_agg(chr(10) || chr(10) || text, '' ORDER BY page_no) AS text
FROM page_texts GROUP BY source, part
""")
def document_parts(spark, sf_dir):
    pages = text_items.text_lines(inputs.text_items(spark, sf_dir))
    return text_items.document_parts(pages, part_pages=2)


@query(f"""
WITH {PDF_ANSWERS_SQL}
SELECT source, CASE WHEN doc_id % 31 = 5 THEN '' ELSE replace(text, chr(10), chr(10) || chr(10)) END AS page_content,
  lang, TRUE AS base_only
FROM answers WHERE fault IS NULL
""")
def combine_pages(spark, sf_dir):
    documents = response.combine_pages(inputs.pdf_answers(spark, sf_dir))
    meta = F.col("metadata")
    base_only = meta["images"].isNull() & meta["dimensions"].isNull() & meta["loc"].isNull() & meta["pdf"].isNull()
    return documents.select("source", "page_content", meta["extra"]["lang"].alias("lang"), base_only.alias("base_only"))


@query(f"""
WITH {TURN_PAGES_SQL}
SELECT source, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY page_no) AS text FROM turn_pages GROUP BY source
""")
def combine_page_table(spark, sf_dir):
    return text_items.combine_page_table(partly_failed(spark, sf_dir))


@query("""
SELECT '/talks/' || conv_id || '.pdf' AS source, count(*) AS numpages, least(3, count(*)) AS numrender
FROM conversations GROUP BY conv_id
""")
def page_counts(spark, sf_dir):
    counts = text_items.page_counts(inputs.turn_pages(spark, sf_dir), max_pages=3)
    return counts.select("source", long("numpages"), long("numrender"))


@query("""
SELECT '/answers/doc-' || doc_id || '.pdf' AS source, '1.0' AS version, toxic <> 0 AS info_missing,
  TRUE AS metadata_missing, 1 + doc_id % 5 AS num_pages
FROM labels
""")
def doc_info(spark, sf_dir):
    return pdf_info.doc_info(label_info(spark, sf_dir)).select(
        "source",
        "version",
        F.col("info").isNull().alias("info_missing"),
        F.col("metadata").isNull().alias("metadata_missing"),
        long("num_pages"),
    )


@query(f"""
WITH {PDF_ANSWERS_SQL}
SELECT a.source, count(p.source) AS pages FROM answers a LEFT JOIN answer_pages p ON p.source = a.source
WHERE a.fault IS NULL GROUP BY a.source
""")
def page_total(spark, sf_dir):
    return report.page_total(inputs.pdf_answers(spark, sf_dir))


# Row generators


@query("""
SELECT '/pdf/order-' || o_orderkey || '.pdf' AS source, unnest(range(1, o_orderkey % 6 + 1)) AS page_no FROM orders
""")
def page_fanout(spark, sf_dir):
    return images.page_fanout(inputs.order_files(spark, sf_dir)).select("source", long("page_no"))


@query("""
SELECT page_id, fmt, quality, 'sample.' || fmt AS file_name, md5(html) AS digest
FROM pages, (VALUES ('jpg', CAST(90 AS BIGINT)), ('png', NULL), ('webp', 90)) formats(fmt, quality)
""")
def format_fanout(spark, sf_dir):
    return images.format_fanout(inputs.html_images(spark, sf_dir)).select(
        "page_id", "fmt", long("quality"), "file_name", F.md5("content").alias("digest")
    )


@query(f"""
WITH {PAGE_REQUESTS_SQL}
SELECT l_orderkey, l_linenumber, page_number,
  CASE WHEN page_number BETWEEN 1 AND num_pages
       THEN md5(CASE WHEN output_format = 'jpeg' THEN 'jpeg' || quality || ':' ELSE '' END
                || l_orderkey || ':' || page_number) END AS digest,
  CASE WHEN page_number NOT BETWEEN 1 AND num_pages
       THEN 'Failed to convert PDF to image: Invalid page number: ' || page_number || '. PDF has ' || num_pages
            || ' pages.' END AS error
FROM requests
""")
def convert_pages(spark, sf_dir):
    # Both hooks stand for an image library.
    def draw(source: Column, page_no: Column, scale: Column) -> Column:
        return F.concat_ws(":", source, page_no).cast("binary")

    def encode(content: Column, fmt: Column, quality: Column) -> Column:
        return F.concat(F.concat(fmt, quality, F.lit(":")).cast("binary"), content)

    requests = inputs.page_requests(spark, sf_dir).withColumn("source", F.col("l_orderkey").cast("string"))
    converted = page_images.convert_pages(requests, draw, encode)
    return converted.select(
        "l_orderkey", "l_linenumber", long("page_number"), F.md5("content").alias("digest"), "error"
    )


@query("""
SELECT page_id, fmt, fmt <> 'png' AS needs_encode,
  CASE WHEN fmt = 'png' THEN md5(html) WHEN fmt = 'jpg' AND page_id % 5 = 0 THEN NULL
       ELSE md5(fmt || '90:' || html) END AS digest,
  CASE WHEN fmt = 'jpg' AND page_id % 5 = 0
       THEN 'Failed to convert PDF to image: Image processing failed: cannot encode as jpg' END AS error
FROM pages, (VALUES ('jpg'), ('png'), ('webp')) formats(fmt)
""")
def format_dispatch(spark, sf_dir):
    def encode(content: Column, fmt: Column, quality: Column) -> Column:
        # Stands for an image codec: fails on some of one format.
        works = (fmt != "jpg") | (F.col("page_id") % 5 != 0)
        return F.when(works, F.concat(F.concat(fmt, quality, F.lit(":")).cast("binary"), content))

    fanned = images.format_fanout(inputs.html_images(spark, sf_dir))
    return images.format_dispatch(fanned, encode).select(
        "page_id", "fmt", "needs_encode", F.md5("content").alias("digest"), "error"
    )


# Report


@query(f"""
WITH {PDF_ANSWERS_SQL}
SELECT source, i + 1 AS page, substring(line, 1, 200) || '...' AS preview,
  '{{' || chr(10) || '  "source": "' || source || '",' || chr(10)
  || '  "lang": "' || lang || '",' || chr(10)
  || '  "images": ' || CASE WHEN i % 4 = 3 THEN '[]' ELSE
       '[' || chr(10) || '    {{' || chr(10) || '      "id": "img-' || i || '",' || chr(10)
       || '      "top_left_x": ' || CASE WHEN i % 3 = 0 THEN 0 ELSE i END || ',' || chr(10)
       || '      "top_left_y": ' || size || ',' || chr(10)
       || '      "bottom_right_x": ' || (i + size) || ',' || chr(10)
       || '      "bottom_right_y": ' || CASE WHEN i % 5 = 0 THEN 0 ELSE 2 * size END
       || CASE WHEN i % 2 = 0
            THEN ',' || chr(10) || '      "image_base64": "' || base64(encode(line)) || '"' ELSE '' END
       || chr(10) || '    }}' || chr(10) || '  ]' END || ',' || chr(10)
  || '  "dimensions": ' || CASE WHEN i % 3 = 2 THEN 'null' ELSE
       '{{' || chr(10) || '    "dpi": 72,' || chr(10) || '    "height": ' || (i + 100) || ',' || chr(10)
       || '    "width": ' || size || chr(10) || '  }}' END || ',' || chr(10)
  || '  "pdf": {{' || chr(10) || '    "loc": {{' || chr(10) || '      "pageNumber": ' || (i + 1) || chr(10)
  || '    }}' || chr(10) || '  }}' || chr(10) || '}}' AS metadata
FROM answer_pages
""")
def page_report(spark, sf_dir):
    pages = report.page_report(response.to_documents(inputs.pdf_answers(spark, sf_dir)))
    return pages.select("source", long("page"), "preview", "metadata")


@query(f"""
WITH {TYPED_SQL}
SELECT source, CAST(1 AS BIGINT) AS page, substring(replace(text, chr(10), chr(10) || chr(10)), 1, 200) || '...' AS preview,
  '{{' || chr(10) || '  "source": "' || source || '",' || chr(10)
  || '  "lang": "' || lang || '",' || chr(10)
  || '  "n_chars": ' || n_chars || ',' || chr(10)
  || '  "pages": ' || regexp_replace(pages::DECIMAL(18, 2)::VARCHAR, '\\.?0+$', '') || ',' || chr(10)
  || '  "long": ' || long || ',' || chr(10)
  || '  "origin": {{' || chr(10) || '    "ids": [' || chr(10) || '      ' || doc_id || ',' || chr(10)
  || '      ' || (doc_id + 1) || chr(10) || '    ],' || chr(10)
  || '    "name": "' || origin || '",' || chr(10) || '    "none": null' || chr(10) || '  }},' || chr(10)
  || '  "images": 3'
  || CASE WHEN doc_id % 3 = 0 THEN ',' || chr(10) || '  "loc": {{' || chr(10) || '    "pageNumber": ' || (doc_id % 7) || chr(10) || '  }}' ELSE '' END
  || chr(10) || '}}' AS metadata
FROM typed WHERE doc_id % 2 = 0
""")
def page_report_typed(spark, sf_dir):
    """The report of whole PDFs whose caller gave numbers, booleans and nested values."""
    files, options = typed_files(spark, sf_dir), LoadOptions(split_pages=False)
    documents = load_stored(files, stored_answers(spark, sf_dir), options).documents
    pages = report.page_report(documents.where(F.col("source").endswith(".pdf")))
    return pages.select("source", long("page"), "preview", "metadata")
