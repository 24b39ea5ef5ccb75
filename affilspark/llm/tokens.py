"""Token output in training order: a keyed Feistel permutation gives every sequence its slot."""

from __future__ import annotations

import base64
import json
import re
import uuid
from array import array
from itertools import groupby

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affilspark.llm import _words as W
from affilspark.llm._spark import cut, parts, small, small_batches, table, widen

#: A public byte-level BPE as rank lines, its pre-token pattern and the free id that ends a document.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END, LENGTH, PER_SHARD, KEY = 50256, 512, 4096, 20240229
#: Distinct pieces of text whose ids a worker keeps.
CACHE = 100_000
ROUNDS = 6

# spaces and line breaks that are not between two words
_ODD = re.compile(r"[ \n]\s|\s[ \n]|^[ \n]|[ \n]$|[^\S \n]")

_encoders: dict[int, _Encoder] = {}


class _Pieces(dict):
    """Ids of pieces of text as bytes; short pieces are kept, up to CACHE of them."""

    def __init__(self, encode, before: str):
        super().__init__()
        self.encode, self.before = encode, before

    def __missing__(self, piece: str) -> bytes:
        ids = array("H", self.encode(self.before + piece)).tobytes()
        if len(piece) <= 64 and len(self) < CACHE:
            self[piece] = ids
        return ids


class _Encoder:
    """Ids of texts as bytes. No token crosses a lone line break between words, or ends in a space that a word follows."""

    def __init__(self, ranks: bytes):
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={}).encode_ordinary
        self.first, self.later = _Pieces(self.encode, ""), _Pieces(self.encode, " ")

    def ids(self, text: str) -> bytes:
        if not text or _ODD.search(text):
            return array("H", self.encode(text)).tobytes()
        lines = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            lines.append(self.first[head] + b"".join(map(self.later.__getitem__, rest)))
        return self.first["\n"].join(lines)


def _encoder(ranks: bytes) -> _Encoder:
    mark = hash(ranks)
    if mark not in _encoders:
        _encoders[mark] = _Encoder(ranks)
    return _encoders[mark]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: bytes | None = None, end: int = END) -> DataFrame:
    """uid, id, tie, n_tokens and packed (compressed 16-bit ids, the end token last) of each document.

    Null texts count as empty: the end token alone. uid numbers the rows of this run only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tie"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    last = array("H", [end]).tobytes()

    def run(batches):
        own, squeeze = _encoder(shared.value), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            n, packed = [], []
            for lo in range(0, batch.num_rows, 256):
                for text in batch.column(3).slice(lo, 256).to_pylist():
                    ids = own.ids(text) + last
                    n.append(len(ids) // 2)
                    packed.append(squeeze.compress(ids))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64()), pa.array(packed, pa.binary())], names=["uid", "id", "tie", "n_tokens", "packed"])

    return rows.mapInArrow(run, widen(rows.select("uid", "id", "tie"), n_tokens="long", packed="binary"))


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: a balanced Feistel network that is walked until it is below n."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = W.mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key % (1 << 63)))
    out = np.array(x, np.uint64)
    live = np.arange(len(out))
    while len(live):
        left, right = out[live] >> shift, out[live] & mask
        for k in keys:
            left, right = right, left ^ (W.mix(right ^ k) & mask)
        out[live] = (left << shift) | right
        live = live[out[live] >= np.uint64(n)]
    return out.astype(np.int64)


def _starts(batches):
    carry = 0
    for batch in batches:
        n = batch.column(1).to_numpy()
        total = np.cumsum(n)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(total - n + carry)], names=["uid", "part_id", "start"])
        carry += int(total[-1]) if len(n) else 0


def ordinals(sized: DataFrame) -> tuple[DataFrame, int]:
    """uid with `start`, the number of sequences before it in order of (id, tie), and their whole number.

    Range partitions are summed in the tasks; the driver sees one sum for each partition.
    """
    spark = sized.sparkSession
    ranged = cut(sized.repartitionByRange(parts(spark), "id", "tie", "uid").sortWithinPartitions("id", "tie", "uid").select("uid", "n_seq", F.spark_partition_id().alias("part_id")))
    sums = dict(ranged.groupBy("part_id").agg(F.sum("n_seq")).collect())
    before, total = {}, 0
    for k in sorted(sums):
        before[k], total = total, total + sums[k]
    local = ranged.mapInArrow(_starts, "uid long, part_id int, start long")
    if not before:
        return local.select("uid", "start"), 0
    base = F.broadcast(spark.createDataFrame(list(before.items()), "part_id int, base long"))  # a row for each partition
    return local.join(base, "part_id").select("uid", (F.col("start") + F.col("base")).alias("start")), total


def materialise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY, end: int = END) -> DataFrame:
    """All sequences in slot order: slot, shard, byte_offset, id, part, n_tokens, tokens.

    A document's ids and an end token are cut into sequences of `length` ids, the last padded with
    the end token to the fixed stride of 2 * length bytes (little-endian 16-bit ids). Sequences are
    numbered by (id, hash of text, part), so the same documents get the same slots whatever their
    layout; permute() maps numbers to slots. Shard = slot // per_shard, byte_offset = stride * (slot
    mod per_shard). A shard lies in one partition, in order. Ids keep their type and null ones come first; null and
    empty texts are one sequence of end tokens; texts of any length are written whole; repeated rows are
    sequences of their own; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer, "rb") as f:
        ranks = f.read()
    ids = cut(encode(docs, id_col, text_col, ranks, end))
    sized = ids.select("uid", "id", "tie", F.ceil(F.col("n_tokens") / length).cast("long").alias("n_seq"))
    start, total = ordinals(sized)
    start = cut(start)
    placed = ids.join(small(start, 1_000_000), "uid").select("id", "n_tokens", "packed", "start")
    stride = 2 * length
    pad = array("H", [end] * length).tobytes()

    def split(batches):
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                piece = batch.slice(lo, 512)
                n, first = piece.column(1).to_numpy(), piece.column(3).to_numpy()
                count = -(-n // length)
                row = np.repeat(np.arange(len(n)), count)
                part = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                slot = permute(first[row] + part, total, key)
                data = []
                for z, k in zip(piece.column(2).to_pylist(), count.tolist(), strict=True):
                    raw = open_.decompress(z)
                    data.extend(raw[i * stride : (i + 1) * stride] for i in range(k))
                    data[-1] += pad[len(data[-1]) :]
                used = np.minimum(n[row] - part * length, length).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(slot // per_shard), pa.array(slot % per_shard * stride), piece.column(0).take(pa.array(row)), pa.array(part.astype(np.int32)), pa.array(used), pa.array(data, pa.binary())],
                    names=["slot", "shard", "byte_offset", id_col, "part", "n_tokens", "tokens"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    records = placed.mapInArrow(split, f"slot long, shard long, byte_offset long, `{id_col}` {id_type}, part int, n_tokens int, tokens binary")
    shards = -(-max(total, 1) // per_shard)
    p = min(parts(spark), shards)
    return records.repartitionById(p, F.expr(f"cast(shard * {p} div {shards} as int)")).sortWithinPartitions("slot")


def write_shards(records: DataFrame, path: str, length: int = LENGTH, per_shard: int = PER_SHARD) -> None:
    """Writes the records end to end as files of per_shard; path is a folder or URI that all tasks reach (also hdfs, s3, gs).

    A run writes shard-NNNNNNNN.bin below a folder of its own, each first under a name of its task's attempt, so a
    task that runs again replaces equal bytes. manifest.json, put in place last, names the run and its number of
    sequences: until then readers see the former run, afterwards none of its shards, and its folder goes. A run that is cut
    off leaves the former one whole. The record of slot s is at byte_offset of file shard: reading on, or resuming at
    any slot, is a seek.
    """
    run = f"run-{uuid.uuid4().hex}"
    store, folder = fs.FileSystem.from_uri(path)
    store.create_dir(f"{folder}/{run}", recursive=True)

    def write(batches):
        store, folder = fs.FileSystem.from_uri(path)
        attempt = TaskContext.get().taskAttemptId()
        rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True))
        shards, counts = [], []
        for shard, group in groupby(rows, key=lambda row: row[0]):
            name, n = f"{folder}/{run}/.shard-{shard:08d}.{attempt}", 0
            with store.open_output_stream(name) as out:
                for _, record in group:
                    out.write(record.as_buffer())
                    n += 1
            store.move(name, f"{folder}/{run}/shard-{shard:08d}.bin")
            shards.append(shard)
            counts.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(counts, pa.int64())], names=["shard", "n"])

    written = records.select("shard", "tokens").mapInArrow(write, "shard long, n long").agg(F.count("*"), F.sum("n")).first()
    manifest = {"run": run, "length": length, "per_shard": per_shard, "shards": written[0], "sequences": written[1] or 0}
    with store.open_output_stream(f"{folder}/.manifest.{run}") as out:
        out.write(json.dumps(manifest).encode())
    store.move(f"{folder}/.manifest.{run}", f"{folder}/manifest.json")
    for old in store.get_file_info(fs.FileSelector(folder)):
        if old.type == fs.FileType.Directory and old.base_name.startswith("run-") and old.base_name != run:
            store.delete_dir(old.path)


def read_from(path: str, slot: int = 0):
    """Sequences of the committed run from `slot` on, as arrays of 16-bit ids."""
    store, folder = fs.FileSystem.from_uri(path)
    with store.open_input_file(f"{folder}/manifest.json") as f:
        m = json.loads(f.read())
    stride = 2 * m["length"]
    while slot < m["sequences"]:
        shard, skip = divmod(slot, m["per_shard"])
        with store.open_input_file(f"{folder}/{m['run']}/shard-{shard:08d}.bin") as f:
            f.seek(skip * stride)
            while record := f.read(stride):
                yield np.frombuffer(record, "<u2")
                slot += 1


def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(table(spark, sf_dir, "documents"))
