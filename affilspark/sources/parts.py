"""A data source that writes lines into parts which end by the bytes written, with commit and abort."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

_AT_ONCE = 16  # files that the driver moves at a time


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: its partition and its parts in order."""

    partition: int = 0
    names: list[str] = field(default_factory=list)


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{posixpath.abspath(uri)}")


def _lines(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The column's texts as lines in one buffer (null: an empty line), and the places between them."""
    none = pa.scalar(b"", pa.large_binary())
    lines = pc.binary_join_element_wise(column.cast(pa.large_binary()), none, pa.scalar(b"\n", pa.large_binary()), null_handling="replace")
    _, ends, text = lines.buffers()
    return memoryview(text or b""), np.frombuffer(ends, np.int64)[lines.offset : lines.offset + len(lines) + 1]


class LineWriter(DataSourceArrowWriter):
    """Writes one text column. A part is closed once it has max_bytes or max_rows, so it is over max_bytes by less than a row.
    What a batch has for a part is written at once; no Python object is made for a row.

    Tasks write below `_temporary`; only when all have ended are the parts of the attempts that count moved,
    named by partition and place, and what an overwrite replaces is removed. A failed or lost task leaves nothing
    beside them, and an aborted write leaves the folder as it was.
    """

    def __init__(self, uri: str, suffix: str, max_bytes: int, max_rows: int, overwrite: bool):
        self.uri, self.suffix, self.max_bytes, self.max_rows, self.overwrite = uri, suffix, max_bytes, max_rows, overwrite
        self.work = f"_temporary/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, root = _opened(self.uri)
        folder = f"{root}/{self.work}/{task.partitionId():06d}-{task.taskAttemptId()}"
        store.create_dir(folder, recursive=True)
        done = Written(task.partitionId())
        out, size, rows = None, 0, 0
        try:
            for batch in iterator:
                text, ends = _lines(batch.column(0))
                at, n = 0, len(batch)
                while at < n:
                    if out is None:
                        name, size, rows = f"{folder}/{len(done.names):06d}{self.suffix}", 0, 0
                        out = store.open_output_stream(name)
                        done.names.append(name)
                    full = int(np.searchsorted(ends[at + 1 :], ends[at] + self.max_bytes - size)) + 1  # lines that fill the part
                    to = at + max(1, min(n - at, full, self.max_rows - rows))
                    out.write(text[ends[at] : ends[to]])
                    size, rows, at = size + int(ends[to] - ends[at]), rows + to - at, to
                    if size >= self.max_bytes or rows >= self.max_rows:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _opened(self.uri)
        old = [f for f in store.get_file_info(fs.FileSelector(root)) if f.base_name != "_temporary"] if self.overwrite else []
        for f in old:
            store.delete_dir(f.path) if f.type == fs.FileType.Directory else store.delete_file(f.path)
        run = "" if self.overwrite else f"-{self.work[-8:]}"
        moves = [(n, f"{root}/part-{m.partition:06d}-{i:06d}{run}{self.suffix}") for m in messages if m for i, n in enumerate(m.names)]
        with ThreadPoolExecutor(_AT_ONCE) as pool:
            list(pool.map(lambda move: store.move(*move), moves))
        self._clear(store, root)
        store.open_output_stream(f"{root}/_SUCCESS").close()

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _opened(self.uri)
        self._clear(store, root)

    def _clear(self, store: fs.FileSystem, root: str) -> None:
        """Removes this write's folder, and `_temporary` with the last one."""
        if store.get_file_info(f"{root}/{self.work}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/{self.work}")
        top = f"{root}/_temporary"
        if store.get_file_info(top).type != fs.FileType.NotFound and not store.get_file_info(fs.FileSelector(top)):
            store.delete_dir(top)


class LineParts(DataSource):
    """`df.write.format("line_parts")` for a frame of one text column; options: max_bytes, max_rows, suffix."""

    @classmethod
    def name(cls) -> str:
        return "line_parts"

    def writer(self, schema, overwrite: bool) -> LineWriter:
        if len(schema.fields) != 1 or schema.fields[0].dataType.simpleString() != "string":
            raise ValueError("line_parts writes one text column")
        o = self.options
        return LineWriter(o["path"], o.get("suffix", ".json"), int(o.get("max_bytes", 16 << 20)), int(o.get("max_rows", 1 << 62)), overwrite)
