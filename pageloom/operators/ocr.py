"""The external call, and answers stored from an earlier one."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.operators.journal import Journal, TaskInfo
from pageloom.sources.systems import default_system

# One request (JSON text) to one response (JSON text); raises on failure.
Backend = Callable[[str], str]
BackendFactory = Callable[[], Backend]

# Fixed value: message layer.
OCR_FAILED = "OCR processing failed: "

# Responses carry page images, so batches are cut by size and not by rows.
BATCH_BYTES = 16 << 20


# Calls of a task under way at a time.
CALLS = 4


def wrap_error(message: Column) -> Column:
    return F.concat(F.lit(OCR_FAILED), message)


def apply_ocr(
    requests: DataFrame,
    backend: BackendFactory,
    batch_bytes: int = BATCH_BYTES,
    calls: int = CALLS,
    journal: str | None = None,
    info: str | None = None,
) -> DataFrame:
    """Call the service once per row: ``request`` becomes ``response`` and ``error``.

    The factory runs once per partition, so a client is shared by its rows; up
    to ``calls`` of them wait for their answers at a time, so a client has to
    stand being called from several threads, or ``calls`` be 1. A
    failing call is a row with an error, never a failed task; a row without a
    request passes through.

    With ``journal``, a folder in shared storage of this job's own, answers are
    noted there as they come, and a task that is tried again takes them from
    there: no call is made twice, except for those under way when it failed.
    Write the result as a table before using it more than once.

    ``info`` is a folder of ``task_info``; rows get what it has for their
    source as ``read_pdf``, where they are.
    """
    kept = [field for field in requests.schema.fields if field.name != "request"]
    added = ["response", "error", *(["read_pdf"] if info else [])]
    schema = T.StructType([*kept, *[T.StructField(name, T.StringType()) for name in added]])
    names = [field.name for field in kept]
    default = default_system(requests.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from concurrent.futures import ThreadPoolExecutor

        call = backend()
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        notes = Journal(journal, task, default) if journal else None
        known = TaskInfo(info, task, default) if info else None

        def ask(request, key):
            try:
                answer = call(request), None
            except Exception as failure:  # the service's failure is data here
                answer = None, str(failure)
            if notes:
                notes.add(key, *answer)
            return answer

        def answers(requests, sources):
            """Of a few requests, those that are not noted asked at a time."""
            texts = requests.to_pylist()
            keys = [notes.key(s, t) if notes and t is not None else None for s, t in zip(sources.to_pylist(), texts)]
            found = [(None, None) if t is None else notes.find(k) if notes else None for k, t in zip(keys, texts)]
            open_ones = [i for i, answer in enumerate(found) if answer is None]
            for i, answer in zip(open_ones, pool.map(ask, [texts[i] for i in open_ones], [keys[i] for i in open_ones])):
                found[i] = answer
            return found

        def answered(batch, start, responses, errors):
            columns = [batch.column(name).slice(start, len(responses)) for name in names]
            columns += [pa.array(responses, pa.string()), pa.array(errors, pa.string())]
            if known:
                sources = batch.column("source").slice(start, len(responses)).to_pylist()
                columns.append(pa.array(known.of(sources), pa.string()))
            return pa.RecordBatch.from_arrays(columns, names=[*names, *added])

        with ThreadPoolExecutor(calls) as pool:
            for batch in batches:
                column, sources = batch.column("request"), batch.column("source")
                start, size, responses, errors = 0, 0, [], []
                # As many answers are held as calls are made at a time.
                for first in range(0, len(column), calls):
                    for response, error in answers(column.slice(first, calls), sources.slice(first, calls)):
                        responses.append(response)
                        errors.append(error)
                        size += len(response or "")
                    if size >= batch_bytes:
                        yield answered(batch, start, responses, errors)
                        start, size, responses, errors = start + len(responses), 0, [], []
                if responses:
                    yield answered(batch, start, responses, errors)

    return requests.mapInArrow(run, schema)


def stored_responses(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Take answers from a table ``(source, response[, error])`` instead of calling.

    Requests are narrowed to their keys first, so no file bytes are shuffled.
    A file without a stored answer gets an error.
    """
    error = F.col("error") if "error" in stored.columns else F.lit(None).cast("string")
    answers = stored.select("source", "response", error.alias("error"), F.lit(True).alias("found"))
    joined = requests.drop("request", "content").join(answers, "source", "left")
    return joined.withColumn(
        "error", F.when(F.col("found").isNull(), F.lit("No stored response")).otherwise(F.col("error"))
    ).drop("found")
