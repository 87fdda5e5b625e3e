"""Page images: fan-out, bounds, formats and files."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pageloom import convert_pages, save_pdf_pages
from pageloom.operators.images import ImageFormat, format_dispatch, format_fanout, page_blocks, page_bounds, page_fanout
from pageloom.operators.rendering import render_blocks
from pageloom.session import run_dir
from pageloom.sources.blobs import save_page_image, save_page_images, sweep, write_blobs
from pageloom.sources.files import scan_files

FILES = "source string, num_pages int"


def test_page_fanout_counts_up_only(spark):
    files = spark.createDataFrame([("a", 3), ("b", 1), ("c", 0), ("d", -2), ("e", None)], FILES)
    for block in (1, 2, 256):
        got = sorted(tuple(row) for row in page_fanout(files, block).select("source", "page_no").collect())
        assert got == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]


def test_a_file_of_very_many_pages_is_spread(spark):
    files = spark.createDataFrame([("hot", 100_000), ("cold", 10)], FILES)
    blocks = page_blocks(files, 100)
    assert blocks.filter("last_page - first_page >= 100").isEmpty()
    shares = [
        row["count"] for row in page_fanout(files, 100).groupBy(F.spark_partition_id()).count().collect()
    ]
    assert sum(shares) == 100_010
    assert max(shares) < 50_000


def test_page_bounds_use_the_filled_options(spark):
    schema = "source string, num_pages int, scale double, output_format string, quality int, page_number int"
    rows = [("a", 2, None, None, None, n) for n in (None, 0, 1, 2, 3, -1)]
    got = page_bounds(spark.createDataFrame(rows, schema)).collect()
    assert [(row.page_number, row.error is None) for row in got] == [
        (1, True),
        (1, True),
        (1, True),
        (2, True),
        (3, False),
        (-1, False),
    ]
    assert got[4].error == "Failed to convert PDF to image: Invalid page number: 3. PDF has 2 pages."


def test_format_fanout_and_dispatch(spark):
    images = spark.createDataFrame([("a", bytearray(b"png"))], "source string, content binary")
    fanned = format_fanout(images)
    got = sorted((row.fmt, row.quality, row.file_name) for row in fanned.collect())
    assert got == [("jpg", 90, "sample.jpg"), ("png", None, "sample.png"), ("webp", 90, "sample.webp")]
    assert format_fanout(images, [ImageFormat("png")]).count() == 1

    def encode(content, fmt, quality):
        return F.when(fmt == "jpg", F.concat(F.lit("jpg:").cast("binary"), content))

    rows = {row.fmt: row for row in format_dispatch(fanned, encode).collect()}
    assert bytes(rows["png"].content) == b"png" and not rows["png"].needs_encode
    assert bytes(rows["jpg"].content) == b"jpg:png" and rows["jpg"].error is None
    assert rows["webp"].content is None
    assert rows["webp"].error.startswith("Failed to convert PDF to image: Image processing failed: ")
    unencoded = {row.fmt: row.error is None for row in format_dispatch(fanned).collect()}
    assert unencoded == {"png": True, "jpg": False, "webp": False}


def placed_images(spark):
    return spark.createDataFrame(
        [("a", n, "png", bytearray(f"a{n}".encode()), "a") for n in (1, 2, 11)]
        + [("b", 1, "jpeg", bytearray(b"b1"), "deep/er")],
        "source string, page_no int, fmt string, content binary, dir string",
    )


def test_save_page_images_and_scan_them_back(spark):
    root = run_dir(spark, "test-images")
    saved = save_page_images(placed_images(spark), root).orderBy("source", "page_no").collect()
    paths = [row.path for row in saved]
    assert [path.removeprefix(root) for path in paths] == [
        "/a/page-1.png",
        "/a/page-2.png",
        "/a/page-11.png",
        "/deep/er/page-1.jpeg",
    ]
    assert [open(path, "rb").read() for path in paths] == [b"a1", b"a2", b"a11", b"b1"]
    scanned = scan_files(spark, root).collect()
    assert {(row.source, bytes(row.content), row.length) for row in scanned} == {
        (path, open(path, "rb").read(), os.path.getsize(path)) for path in paths
    }


def test_writing_again_replaces_whole_files(spark):
    root = run_dir(spark, "test-again")
    for content in (b"a longer first text", b"second"):
        files = spark.createDataFrame([(f"{root}/x.bin", bytearray(content))], "path string, content binary")
        write_blobs(files)
    assert os.listdir(root) == ["x.bin"]
    assert open(f"{root}/x.bin", "rb").read() == b"second"


def draw(source, page_no, scale):
    return F.concat_ws(":", source, page_no, scale).cast("binary")


def encode(content, fmt, quality):
    ok = content != F.lit("a:2:2.0").cast("binary")
    return F.when(ok, F.concat(content, quality.cast("string").cast("binary")))


def test_save_pdf_pages(spark):
    root = run_dir(spark, "test-pages")
    files = spark.createDataFrame([("a", 3, "a"), ("b", 1, "b")], FILES + ", dir string")
    written, rejects = save_pdf_pages(files, root, draw)
    rows = written.orderBy("source", "page_no").collect()
    got = [(row.source, row.page_no, row.path.removeprefix(root)) for row in rows]
    assert got == [("a", n, f"/a/page-{n}.png") for n in (1, 2, 3)] + [("b", 1, "/b/page-1.png")]
    assert open(f"{root}/a/page-2.png", "rb").read() == b"a:2:2.0"
    assert rejects.isEmpty()


def test_pages_without_a_folder_go_to_one_of_their_file(spark):
    root = run_dir(spark, "test-own-folders")
    files = spark.createDataFrame([("/x/a.pdf", 2), ("/y/a.pdf", 2)], FILES)
    written, _ = save_pdf_pages(files, root, draw)
    paths = {row.path: f"{row.source}:{row.page_no}:2.0".encode() for row in written.collect()}
    assert len(paths) == 4 and all(open(path, "rb").read() == content for path, content in paths.items())
    pages = files.select("source", F.col("num_pages").alias("page_no"), F.lit("png").alias("fmt"), F.col("source").cast("binary").alias("content"))
    saved = [row.path for row in save_page_images(pages, root + "/again").collect()]
    assert len({os.path.dirname(path) for path in saved}) == 2 and all(os.path.basename(os.path.dirname(p)).startswith("a-") for p in saved)


def test_two_images_of_one_path_are_an_error(spark):
    root = run_dir(spark, "test-clash")
    rows = [("a", 1, "png", bytearray(b"1"), "same"), ("b", 1, "png", bytearray(b"2"), "same")]
    images = spark.createDataFrame(rows, "source string, page_no int, fmt string, content binary, dir string")
    with pytest.raises(ValueError, match="same/page-1.png"):
        save_page_images(images, root)
    assert not os.path.exists(root)


def test_one_page_to_a_path_of_the_caller(spark):
    root = run_dir(spark, "test-single")
    rows = [("a", 1, bytearray(b"one"), None, f"{root}/deep/x.png"), ("b", 9, None, "bad page", f"{root}/y.png")]
    pages = spark.createDataFrame(rows, "source string, page_number int, content binary, error string, path string")
    got = sorted((row.source, row.path, row.error) for row in save_page_image(pages).collect())
    assert got == [("a", f"{root}/deep/x.png", None), ("b", None, "bad page")]
    assert open(f"{root}/deep/x.png", "rb").read() == b"one" and os.listdir(root) == ["deep"]
    with pytest.raises(PySparkException, match="No content"):
        write_blobs(pages)


def test_a_failed_page_keeps_its_file_from_being_written(spark):
    root = run_dir(spark, "test-failed-pages")
    files = spark.createDataFrame([("a", 3, "a"), ("b", 1, "b")], FILES + ", dir string")
    written, rejects = save_pdf_pages(files, root, draw, encode, fmt="jpeg", quality=80)
    assert [row.path.removeprefix(root) for row in written.collect()] == ["/b/page-1.jpeg"]
    assert os.listdir(f"{root}/a") == [] and os.listdir(f"{root}/b") == ["page-1.jpeg"]
    assert open(f"{root}/b/page-1.jpeg", "rb").read() == b"b:1:2.080"
    [row] = rejects.collect()
    assert row.source == "a"
    assert row.error.startswith(
        "Failed to convert PDF to images: Failed to convert PDF to image: Image processing failed: "
    )
    scaled, rejects = save_pdf_pages(files, root, draw, encode, fmt="jpeg", scale=1)
    assert scaled.count() == 4 and rejects.isEmpty()
    assert open(f"{root}/a/page-2.jpeg", "rb").read() == b"a:2:1.0100"


def test_convert_pages(spark):
    schema = "source string, num_pages int, scale double, output_format string, quality int, page_number int"
    rows = [
        ("a", 2, None, None, None, None),
        ("a", 2, 3.0, "webp", 50, 1),
        ("a", 2, 0.0, "jpeg", 0, 2),
        ("a", 2, 1.0, "png", 1, 3),
    ]
    got = convert_pages(spark.createDataFrame(rows, schema), draw, encode).collect()
    assert [None if row.content is None else bytes(row.content) for row in got] == [
        b"a:1:2.0",
        b"a:1:3.050",
        None,
        None,
    ]
    assert [row.error is None for row in got] == [True, True, False, False]
    assert got[2].error.startswith("Failed to convert PDF to image: Image processing failed: ")
    assert got[3].error == "Failed to convert PDF to image: Invalid page number: 3. PDF has 2 pages."
    nothing = convert_pages(spark.createDataFrame(rows[:1], schema), lambda *_: F.lit(None).cast("binary"))
    assert nothing.first().error == "Failed to convert PDF to image: page was not rendered"


def opening(folder):
    """A renderer that notes in files when it is made, and which file it opens for which pages."""

    def make():
        import uuid

        open(f"{folder}/made-{uuid.uuid4().hex}", "w").close()

        def render(source, pages, scale):
            open(f"{folder}/{source}-{pages[0]}-{pages[-1]}-{uuid.uuid4().hex}", "w").close()
            if source == "gone":
                raise OSError("cannot open gone")
            for page in pages:
                if source == "torn" and page == 3:
                    raise ValueError("page tree ends")
                if source != "short" or page != 2:
                    yield f"{source}:{page}:{scale}".encode() if source != "blank" else None

        return render

    return make


def test_a_file_is_opened_once_for_a_block_of_pages(spark, tmp_path):
    files = spark.createDataFrame([("a", 7, "x"), ("b", 1, "y"), ("none", 0, "z"), ("gone", 2, "g"), ("torn", 4, "t"), ("blank", 1, "l"), ("short", 2, "s")], f"{FILES}, key string")
    for block, batch_bytes in ((256, 1 << 20), (3, 1)):
        folder = tmp_path / str(block)
        folder.mkdir()
        rows = render_blocks(files, opening(folder), 2.0, block, batch_bytes).collect()
        got = {(r.source, r.page_no): (r.content and bytes(r.content).decode(), r.error) for r in rows}
        assert all(r.key == dict(a="x", b="y", gone="g", torn="t", blank="l", short="s")[r.source] for r in rows)
        want = {("a", n): (f"a:{n}:2.0", None) for n in range(1, 8)} | {("b", 1): ("b:1:2.0", None), ("blank", 1): (None, None)}
        want |= {("gone", n): (None, "Failed to convert PDF to image: cannot open gone") for n in (1, 2)}
        want |= {("torn", 1): ("torn:1:2.0", None), ("torn", 2): ("torn:2:2.0", None)}
        if block == 256:
            want |= {("torn", n): (None, "Failed to convert PDF to image: page tree ends") for n in (3, 4)}
        else:  # the second block is opened anew
            want |= {("torn", 3): (None, "Failed to convert PDF to image: page tree ends"), ("torn", 4): ("torn:4:2.0", None)}
        want |= {("short", 1): ("short:1:2.0", None), ("short", 2): (None, None)}
        assert got == want
        opened = sorted(name.rsplit("-", 1)[0] for name in os.listdir(folder) if not name.startswith("made"))
        whole = ["a-1-7", "b-1-1", "blank-1-1", "gone-1-2", "short-1-2", "torn-1-4"]
        assert opened == (whole if block == 256 else sorted([*whole[1:-1], "a-1-3", "a-4-6", "a-7-7", "torn-1-3", "torn-4-4"]))


def test_pages_of_a_renderer_are_saved(spark, tmp_path):
    files = spark.createDataFrame([("a", 3), ("gone", 2), ("blank", 1)], FILES)
    root = f"{tmp_path}/out"
    (tmp_path / "log").mkdir()
    written, rejects = save_pdf_pages(files, root, renderer=opening(tmp_path / "log"), scale=3)
    rows = sorted((r.source, r.page_no, r.path) for r in written.collect())
    assert [(s, n) for s, n, _ in rows] == [("a", 1), ("a", 2), ("a", 3)]
    assert [open(path).read() for _, _, path in rows] == ["a:1:3.0", "a:2:3.0", "a:3:3.0"]
    assert sorted((r.source, r.error) for r in rejects.collect()) == [
        ("blank", "Failed to convert PDF to images: Failed to convert PDF to image: page was not rendered"),
        ("gone", "Failed to convert PDF to images: Failed to convert PDF to image: cannot open gone"),
    ]
    assert len([n for n in os.listdir(tmp_path / "log") if n.startswith("a-")]) == 1
    with pytest.raises(ValueError, match="Either"):
        save_pdf_pages(files, root)


def test_a_sweep_deletes_the_hidden_files_of_its_run_only(spark, tmp_path):
    for name in (".p.png.run1.x", ".p.png.run2.x", "p.png", "run1", ".run1"):
        (tmp_path / name).write_text("x")
    paths = spark.createDataFrame([(f"{tmp_path}/p.png",), (f"{tmp_path}/q.png",), (f"{tmp_path}/none/q.png",), ("bare",)], "path string")
    assert sweep(paths, "run1") == 1
    assert sorted(os.listdir(tmp_path)) == [".p.png.run2.x", ".run1", "p.png", "run1"]


DYING = """
import json, os, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pageloom import save_pdf_pages
from pageloom.plans import page_images
from pageloom.sources import blobs
folder = sys.argv[2]
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", folder + "/shared").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
written = blobs.put

def put(system, target, content, made, run=""):
    written(system, target, content, made, run)
    mark = folder + "/died"
    if not os.path.exists(mark):
        open(mark, "w").close()
        os._exit(1)

page_images.put = blobs.put = put
draw = lambda source, page_no, scale: F.concat_ws(":", source, page_no).cast("binary")
files = spark.createDataFrame([(str(i), 3) for i in range(5)], "source string, num_pages int")
saved, _ = save_pdf_pages(files, folder + "/out", draw)
print(json.dumps(sorted([r.source, r.page_no, r.path] for r in saved.collect())))
"""


def test_what_a_lost_task_has_staged_is_deleted(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", DYING, root, str(tmp_path)], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    rows = json.loads(done.stdout.splitlines()[-1])
    assert (tmp_path / "died").exists() and len(rows) == 15
    there = sorted(os.path.join(at, name) for at, _, names in os.walk(tmp_path / "out") for name in names)
    assert there == sorted(path for _, _, path in rows)
    assert all(open(path).read() == f"{source}:{page}" for source, page, path in rows)
