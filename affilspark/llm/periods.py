"""Periodic runs of words: harmonic-grid candidates extended exactly over a recompression grammar."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affilspark.llm._spark import small_batches, table
from affilspark.llm.recompression import Grammar

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Words that share a grammar (a longer text has one to itself), grid points looked at at once.
WORDS, POINTS = 1 << 18, 1 << 21


def _grid(begin: np.ndarray, n: np.ndarray, repeats: int, shortest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and periods: for each period q every (repeats-1)*q-th word, as a run of repeats*q words has one that equals the word q on."""
    most = np.where(n >= shortest, n // repeats, 0)
    doc = np.repeat(np.arange(len(n)), most)
    q = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    count = (n[doc] - q - 1) // ((repeats - 1) * q) + 1
    total = np.cumsum(count)
    lo = 0
    while lo < len(doc):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + POINTS, "right")))
        c = count[lo:hi]
        period = np.repeat(q[lo:hi], c)
        step = np.arange(len(period)) - np.repeat(np.cumsum(c) - c, c)
        yield np.repeat(begin[doc[lo:hi]], c) + step * (repeats - 1) * period, period
        lo = hi


def runs_of(sequences: list[np.ndarray], repeats: int = 4, shortest: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, start, length, period) of every maximal run of at least max(shortest, repeats * period) symbols, by sequence, start, period.

    A run's period is its smallest. Symbols are numbers from 0.
    """
    n = np.array([len(x) for x in sequences], np.int64)
    names = 1 + max((int(x.max()) for x in sequences if len(x)), default=0)
    separators = np.cumsum(np.r_[0, n + 1])
    s = np.empty(int(separators[-1]) + 1, np.int64)
    s[separators] = names + np.arange(len(separators))
    for at, x in zip(separators, sequences, strict=False):
        s[at + 1 : at + 1 + len(x)] = x
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    grammar = None
    for at, q in _grid(separators[:-1] + 1, n, repeats, shortest):
        hit = s[at] == s[at + q]
        at, q = at[hit], q[hit]
        if not len(at):
            continue
        grammar = grammar or Grammar(s, separators)
        back = grammar.extend_back(at - 1, at + q - 1)
        length = back + q + grammar.extend(at, at + q)
        ok = length >= np.maximum(shortest, repeats * q)
        found.append(((at - back)[ok], length[ok], q[ok]))
    start, length, q = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    least = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])][: len(start)]  # multiples of the smallest period have the same ends
    start, length, q = start[least], length[least], q[least]
    order = np.lexsort((q, start))
    start, length, q = start[order], length[order], q[order]
    doc = np.searchsorted(separators, start, "right") - 1
    return doc, start - separators[doc] - 1, length, q


def _collapsed(words: list[str], start: np.ndarray, length: np.ndarray, q: np.ndarray) -> str:
    if not len(start):
        return " ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + q, 1)
    np.add.at(change, start + length, -1)
    return " ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def _block(ids: pa.Array, texts: list[list[str]], repeats: int, shortest: int) -> pa.RecordBatch:
    names: dict[str, int] = {}
    numbers = [np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words)) for words in texts]
    doc, start, length, q = runs_of(numbers, repeats, shortest)
    edge = np.searchsorted(doc, np.arange(len(texts) + 1))
    kept = [_collapsed(words, start[a:b], length[a:b], q[a:b]) for words, a, b in zip(texts, edge[:-1], edge[1:], strict=True)]
    runs = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, q)], ["start", "length", "period"]))
    return pa.RecordBatch.from_arrays([ids, pa.array([len(w) for w in texts], pa.int64()), runs, pa.array(kept, pa.string())], names=["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: int = 4, shortest: int = 6) -> DataFrame:
    """id, n_words, runs (array of start, length, period, by start and period), collapsed, one row for each row of docs.

    A run is a stretch of consecutive words, numbered from 0, with smallest period q and at least
    max(shortest, repeats * q) words that no neighbouring word extends. collapsed has the words that no run
    holds after its first q, joined by one space. Candidates are the points of a grid of every
    (repeats - 1) * q-th word for each q; both ends come from extension queries on the grammar of
    the texts, so they are exact. Texts of a block (WORDS words, or one longer text) share a grammar; rows do
    not see each other, no shuffle is made. Null and empty texts have no words and no runs; repeated
    rows and ids give a row each; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column, lo, n, words = batch.column(0), batch.column(1), 0, 0, []
            for i in range(batch.num_rows):
                words.append(_WORD.findall(column[i].as_py() or ""))
                n += len(words[-1])
                if n >= WORDS or i == batch.num_rows - 1:
                    yield _block(ids[lo : i + 1], words, repeats, shortest)
                    lo, n, words = i + 1, 0, []

    return rows.mapInArrow(run, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def looped(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the ids, by their hash, get the tail of their words made periodic. A null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("h"), g.alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)).alias("w"))
    sized = chosen.withColumn("n", F.coalesce(F.size("w"), F.lit(0)).cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    sized = sized.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int"))), F.lit(1), (F.col("n") - F.col("a")).cast("int"))
    return sized.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of all documents with the contract's periodic tails; digests of runs and kept words, and the longest run."""
    found = periodic_runs(looped(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    out = found.select("id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select(
        F.col("id").alias("doc_id"), "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.col("n_runs") > 0, F.concat("lines", F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"), "collapsed_sha256",
    )
