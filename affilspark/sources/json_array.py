"""JSON array documents read in parallel: one file is split by bytes, whatever its line breaks.

Spark's text reader cuts the file at each "}" and deals out byte ranges (blocks) of it. Where a block begins
is not known to be inside a string or not, so a first pass sums each block up for both cases; folding these
in file order gives every block's true start. A second pass then cuts out the elements, and the few
that cross blocks are put together from their pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ESCAPED = re.compile(r"\\.", re.S)
_TOKEN = re.compile(r'\\.|["{}\[\]]', re.S)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, piece) in file order within a block; the "}" that ends a piece is cut off."""
    lines = spark.read.option("lineSep", "}").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("piece"))


def _net(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def piece_effect(piece: str) -> tuple[bool, int, int]:
    """Whether a piece turns "inside a string" around, and its change of depth if begun outside and inside of one.

    No escape crosses pieces, as a backslash never stands before a "}".
    """
    if "\\" in piece:
        piece = _ESCAPED.sub("", piece)
    parts = piece.split('"')
    return len(parts) % 2 == 0, _net("".join(parts[::2])), _net("".join(parts[1::2]))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per run of pieces of a block: its order in the task, the turn, and the depths."""
    at, n, state = None, 0, None
    out: list[tuple] = []
    for batch in batches:
        for file, block, piece in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (file, block) != at:
                if state:
                    out.append((*at, n, *state))
                at, n, state = (file, block), n + 1, (False, 0, 0)
            turn, outside, inside = piece_effect(piece + "}")
            turned, a, b = state
            state = (turned ^ turn, a + (inside if turned else outside), b + (outside if turned else inside))
    if state:
        out.append((*at, n, *state))
    columns = list(zip(*out, strict=True)) if out else [[]] * 6
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "n", "turn", "outside", "inside"])


def block_starts(rows: list[tuple[str, int, bool, int, int]]) -> dict[tuple[str, int], tuple[bool, int]]:
    """(file, block) to (inside a string, depth) where the block begins, from the sums of all blocks."""
    starts: dict[tuple[str, int], tuple[bool, int]] = {}
    now, state = None, (False, 0)
    for file, block, turn, outside, inside in sorted(rows):
        if file != now:
            now, state = file, (False, 0)
        starts[file, block] = state
        quoted, depth = state
        state = (quoted ^ turn, depth + (inside if quoted else outside))
    return starts


class Cutter:
    """Takes the pieces of a block in order and gives (kind, text): whole elements, and what crosses its edges.

    Elements are the objects and arrays at depth 1. kind is "whole", "tail" (ends an element begun earlier), "head" (begins
    one that does not end here) or "middle" (the block lies inside one).
    """

    def __init__(self, quoted: bool, depth: int):
        self.quoted, self.depth, self.parts = quoted, depth, []
        self.open = self.borrowed = depth >= 2

    def feed(self, piece: str) -> list[tuple[str, str]]:
        found = []
        while piece:
            if not self.open:
                at = self._begin(piece)
                if at is None:
                    break
                piece, self.open = piece[at:], True
            end = self._end(piece)
            self.parts.append(piece[:end])
            if end is None:
                break
            found.append(self._closed("tail" if self.borrowed else "whole"))
            piece = piece[end:]
        return found

    def _end(self, piece: str) -> int | None:
        """Where the open element ends, depth being 1 again; else the state moves past the piece."""
        if self.depth - piece.count("]") - piece.count("}") > 1:  # most pieces: no need to look at each sign
            turn, outside, inside = piece_effect(piece)
            self.depth += inside if self.quoted else outside
            self.quoted ^= turn
            return None
        for m in _TOKEN.finditer(piece):
            c = m[0]
            if c == '"':
                self.quoted = not self.quoted
            elif not self.quoted and len(c) == 1:
                self.depth += 1 if c in "{[" else -1
                if self.depth == 1:
                    return m.end()
        return None

    def _begin(self, piece: str) -> int | None:
        """Where an element begins; else the state moves past the piece."""
        for m in _TOKEN.finditer(piece):
            c = m[0]
            if c == '"':
                self.quoted = not self.quoted
            elif self.quoted or len(c) > 1:
                continue
            elif c in "{[":
                if self.depth == 1:
                    return m.start()
                self.depth += 1
            else:
                self.depth -= 1
        return None

    def _closed(self, kind: str) -> tuple[str, str]:
        text = "".join(self.parts)
        self.parts, self.open, self.borrowed = [], False, False
        return kind, text

    def rest(self) -> tuple[str, str] | None:
        return self._closed("middle" if self.borrowed else "head") if self.parts else None


def _cut_out(starts: dict[tuple[str, int], tuple[bool, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["file", "block", "kind", "text"])

        at, cutter, rows = None, None, []
        for batch in batches:
            for file, block, piece in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (file, block) != at:
                    if cutter and (last := cutter.rest()):
                        rows.append((*at, *last))
                    at, cutter = (file, block), Cutter(*starts[file, block])
                rows += [(*at, *x) for x in cutter.feed(piece + "}")]
            yield packed(rows)
            rows = []
        if cutter and (last := cutter.rest()):
            yield packed([(*at, *last)])

    return run


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """`text` of each object at the top level of the JSON array in each file of path; numbers, texts and arrays there are left out.

    A pass over the files before the result is made sums blocks up; the driver sees a row a block. Splits follow
    spark.sql.files.maxPartitionBytes.
    """
    pieces = _pieces(spark, path)
    sums = pieces.mapInArrow(_summed, "file string, block long, n long, turn boolean, outside long, inside long").drop("n").collect()
    cut = pieces.mapInArrow(_cut_out(block_starts([tuple(r) for r in sums])), "file string, block long, kind string, text string")
    # of the pieces at edges, each head begins an element; what follows up to the next head is its continuation
    order = Window.partitionBy("file").orderBy("block", F.col("kind") == "head")
    edges = cut.where("kind <> 'whole'").select("file", "block", "kind").withColumn("element", F.sum((F.col("kind") == "head").cast("int")).over(order))
    joined = cut.where("kind <> 'whole'").join(edges, ["file", "block", "kind"]).groupBy("file", "element")
    crossing = joined.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "").alias("text"), F.max((F.col("kind") == "tail").cast("int")).alias("ended"))
    return cut.where("kind = 'whole'").select("text").unionByName(crossing.where("ended = 1").select("text")).where("text like '{%'")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of the array's objects, as the multiLine reader gives them, but read by as many tasks as the file has blocks."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return array_elements(spark, path).select(F.from_json("text", fields).alias("r")).select("r.*")
