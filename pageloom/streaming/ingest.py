"""Load files as they arrive.

Every operator between a file and its documents is row-wise, so no state or
watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pageloom.functions.media import Transcoder
from pageloom.functions.paths import plain_path
from pageloom.operators.admission import admit, ingest_table
from pageloom.operators.ocr import BackendFactory, apply_ocr
from pageloom.operators.request import build_requests
from pageloom.operators.response import check_responses, response_rejects, to_documents
from pageloom.options import LoadOptions
from pageloom.session import release

# Columns of Spark's binary file source.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(spark: SparkSession, root: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """``(source, content)`` of files appearing below ``root``."""
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("recursiveFileLookup", True)
        .load(root)
        .select(plain_path("path").alias("source"), "content")
    )


def start_loading(
    files: DataFrame,
    out_dir: str,
    backend: BackendFactory,
    options: LoadOptions = LoadOptions(),
    transcoder: Transcoder | None = None,
) -> StreamingQuery:
    """Write answers, documents and rejects of all available files, then stop.

    Each batch writes below its own number and overwrites it when repeated, so
    a batch that is run again after a failure leaves no second copy.
    """

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        place = f"batch={batch_id}"
        requests = build_requests(admit(ingest_table(batch), options), options, transcoder)
        # A batch that is run again finds the calls it has made.
        calls = f"{out_dir}/calls/{place}"
        answers = check_responses(apply_ocr(requests, backend, journal=calls))
        answers.write.mode("overwrite").parquet(f"{out_dir}/answers/{place}")
        checked = batch.sparkSession.read.schema(answers.schema).parquet(f"{out_dir}/answers/{place}")
        to_documents(checked, options.split).write.mode("overwrite").parquet(f"{out_dir}/documents/{place}")
        response_rejects(checked).write.mode("overwrite").parquet(f"{out_dir}/rejects/{place}")
        release(batch.sparkSession, calls)

    return (
        files.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", f"{out_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
