"""What tasks of one job keep in shared storage: answers of calls made, and info that rows are to get.

Both are found by the number of a task, which a repeated task has again, so
nothing is shuffled to bring them to the rows they belong to.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa

from pageloom.sources.blobs import put
from pageloom.sources.systems import Systems


def plain(path: str) -> str:
    return re.sub(r"\Afile:/+", "/", path)


class Journal:
    """Answers of the calls that a task has made, by source and request.

    Each answer is a file, named by its key, written under a hidden name and
    renamed as soon as it is there. A task that is run again lists which answers
    it has, and reads one when its turn comes. The same request of the same
    source several times in a task is counted.
    """

    SCHEMA = pa.schema([("response", pa.string()), ("error", pa.string())])

    def __init__(self, folder: str, task: int, default: str = ""):
        from pyarrow import fs

        self.system, self.folder = Systems(default).find(f"{plain(folder)}/task={task}")
        self.made: set[str] = set()
        self.seen: Counter[str] = Counter()
        there = self.system.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        self.noted = {info.base_name for info in there if info.is_file}

    def key(self, source: str | None, request: str) -> str:
        digest = hashlib.sha256(repr(source).encode() + b"\0" + request.encode()).hexdigest()
        self.seen[digest] += 1
        return f"{digest}-{self.seen[digest]}"

    def find(self, key: str) -> tuple[str | None, str | None] | None:
        """Response and error of a call made before, or None."""
        if key not in self.noted:
            return None
        with self.system.open_input_file(f"{self.folder}/{key}") as stream, pa.ipc.open_stream(stream) as reader:
            [row] = reader.read_all().to_pylist()
        return row["response"], row["error"]

    def add(self, key: str, response: str | None, error: str | None) -> None:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.SCHEMA) as writer:
            writer.write_batch(pa.RecordBatch.from_pylist([{"response": response, "error": error}], self.SCHEMA))
        put(self.system, f"{self.folder}/{key}", sink.getvalue(), self.made)


class TaskInfo:
    """Info of the sources in a task, read from ``(source, read_pdf)`` tables in folders of task numbers.

    A source that is not in the folder of this task, which happens if the plan
    was cut into other tasks since, is looked up in all folders.
    """

    def __init__(self, folder: str, task: int, default: str = ""):
        self.system, self.root = Systems(default).find(plain(folder))
        self.found = self._read(f"{self.root}/task={task}")

    def _read(self, folder: str, wanted: list[str] | None = None) -> dict[str, str | None]:
        import pyarrow.dataset as ds
        from pyarrow import fs

        if self.system.get_file_info(folder).type == fs.FileType.NotFound:
            return {}
        data = ds.dataset(folder, filesystem=self.system, format="parquet", exclude_invalid_files=False)
        rows = data.to_table(["source", "read_pdf"], filter=None if wanted is None else ds.field("source").isin(wanted))
        return dict(zip(rows["source"].to_pylist(), rows["read_pdf"].to_pylist()))

    def of(self, sources: list[str | None]) -> list[str | None]:
        other = sorted({s for s in sources if s is not None and s not in self.found})
        if other:
            self.found |= dict.fromkeys(other) | self._read(self.root, other)
        return [self.found.get(s) for s in sources]
