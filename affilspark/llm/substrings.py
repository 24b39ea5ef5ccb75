"""Substring dedup: repeated word windows of a corpus, found by suffix automata over reference shards.

A corpus that is its own reference cannot be streamed through automata of all its shards: that is
quadratic. So every window first gets an anchor, the least hash of the short grams in it; equal
windows have equal anchors. Stretches whose anchor occurs again are the reference, sharded by
anchor; each shard's automaton counts occurrences and the stretches are streamed through it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affilspark.llm import _words as W
from affilspark.llm._spark import cut, parts, small_batches, table
from affilspark.llm.automaton import SuffixAutomaton, spans

#: Words of a window and of an anchor gram; most stretches in one automaton's shard, most windows of a stretch.
WINDOW, GRAM, SHARD, LONGEST = 35, 8, 1000, 256
KEYS = ["k1", "k2"]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    key = lambda n: F.xxhash64(F.lit(n), F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col))
    return docs.select(key(1).alias("k1"), key(2).alias("k2"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def _runs(data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Runs of windows with one anchor: row, anchor, first and last window in the row, weight (2 if the gram occurs twice in it)."""
    starts, ends, first = W.spans(data, offsets)
    width = window - gram + 1
    if len(starts) < window:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    g = W.mix(W.rolling(W.hashes(data, starts, ends), gram))
    at, row = W.whole(first, window)
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    least = W.sliding_min(g, width)[at]
    new = np.r_[True, (least[1:] != least[:-1]) | (row[1:] != row[:-1])]
    begin = np.flatnonzero(new)
    size = np.diff(np.r_[begin, len(at)])
    pieces = -(-size // LONGEST)  # a periodic text has one anchor throughout; its run is cut, so that shards are bounded in words
    begin = np.repeat(begin, pieces) + LONGEST * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    end = np.r_[begin[1:], len(at)] - 1
    anchor = least[begin]
    left, right = np.empty(len(begin), np.int64), np.empty(len(begin), np.int64)
    for lo in range(0, len(begin), 1 << 14):
        part = slice(lo, lo + (1 << 14))
        left[part] = at[begin[part]] + np.argmax(g[at[begin[part], None] + np.arange(width)] == anchor[part, None], axis=1)
        right[part] = at[end[part]] + width - 1 - np.argmax(g[at[end[part], None] + np.arange(width - 1, -1, -1)] == anchor[part, None], axis=1)
    base = first[:-1][row[begin]]
    return row[begin], anchor.view(np.int64), at[begin] - base, at[end] - base, 1 + (left != right)


def anchors(keyed: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """k1, k2, anchor, w0, w1 (first and last window of the run, at most LONGEST of them), n of every run of every text."""

    def run(batches):
        for batch in batches:
            for lo, _, data, offsets in W.blocks(batch.column(2)):
                row, anchor, w0, w1, n = _runs(data, offsets, window, gram)
                take = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(anchor), pa.array(w0.astype(np.int32)), pa.array(w1.astype(np.int32)), pa.array(n.astype(np.int32))], names=["k1", "k2", "anchor", "w0", "w1", "n"])

    return keyed.select("k1", "k2", "text").mapInArrow(run, "k1 long, k2 long, anchor long, w0 int, w1 int, n int")


def _stretches(window: int):
    """Texts with their runs to (anchor, hot, k1, k2, w0, stretch): the run's words, one space between."""

    def run(batches):
        for batch in batches:
            runs = batch.column(4)
            cuts = np.asarray(runs.offsets)
            flat = runs.flatten()
            anchor, hot, w0, w1 = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            for lo in range(0, batch.num_rows, 64):
                out, size = [], min(64, batch.num_rows - lo)
                rows, text = [], batch.column(3).slice(lo, size).to_pylist()
                for i in range(size):
                    words = (text[i] or "").encode().split()
                    for j in range(cuts[lo + i] - cuts[0], cuts[lo + i + 1] - cuts[0]):
                        out.append(b" ".join(words[w0[j] : w1[j] + window]))
                        rows.append((lo + i, j))
                if not out:
                    continue
                row, j = np.array(rows).T
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(anchor[j]), pa.array(hot[j].astype(bool)), batch.column(0).take(take), batch.column(1).take(take), pa.array(w0[j].astype(np.int32)), pa.array(out, pa.binary())], names=["anchor", "hot", "k1", "k2", "w0", "stretch"])

    return run


def _shard(group: list, window: int):
    """(k1, k2, start, end) of the words of a shard's stretches that are in a window that occurs twice."""
    texts: dict[bytes, list] = {}
    for k1, k2, w0, text in group:
        texts.setdefault(text, []).append((k1, k2, w0))
    split = {t: t.split() for t in texts}
    if len(texts) == 1 and len(group) > 1:  # each stretch matches its equal to its end
        found = {t: [(0, len(w))] for t, w in split.items()}
    else:
        reference = SuffixAutomaton()
        for t, at in texts.items():
            reference.add(split[t], len(at))
        reference.count()
        found = {t: spans(reference.match(split[t], 2), window) for t in texts}
    for t, at in texts.items():
        for a, b in found[t]:
            for k1, k2, w0 in at:
                yield k1, k2, w0 + a, w0 + b


def _automata(window: int):
    """Stretches sorted by anchor to the spans that their shard's automaton finds."""

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(4)], names=["k1", "k2", "a", "b"])

    def run(batches):
        now, group, out = None, [], []
        for batch in batches:
            batch = batch.filter(pa.compute.invert(batch.column(1)))
            columns = [batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)]
            for anchor, *row in zip(*columns, strict=True):
                if anchor != now:
                    out.extend(_shard(group, window))
                    now, group = anchor, []
                    if len(out) > 20_000:
                        yield batch_of(out)
                        out = []
                group.append(row)
        out.extend(_shard(group, window))
        yield batch_of(out)

    return run


def _windows(window: int):
    """Stretches to single windows with 128 bits of hash."""

    def run(batches):
        for batch in batches:
            batch = batch.filter(batch.column(1))
            for lo, _, data, offsets in W.blocks(batch.column(5).cast(pa.string()), 1 << 18):
                starts, ends, first = W.spans(data, offsets)
                h = W.hashes(data, starts, ends)
                at, row = W.whole(first, window)
                one, two = (W.mix(W.rolling(x, window))[at].view(np.int64) if len(h) >= window else np.zeros(0, np.int64) for x in (h, W.mix(h + np.uint64(99))))
                take = pa.array(row + lo)
                pos = batch.column(4).to_numpy()[row + lo] + at - first[row]
                yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), batch.column(2).take(take), batch.column(3).take(take), pa.array(pos.astype(np.int64))], names=["h1", "h2", "k1", "k2", "a"])

    return run


def repeated_spans(keyed: DataFrame, window: int = WINDOW, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """k1, k2, a, b: spans of words inside windows whose words also start somewhere else in the corpus.

    Counts of anchors are summed before they are shuffled. A shard has up to `shard` stretches; those
    of a more frequent anchor go window by window through counts of 128-bit hashes instead, which
    are summed in the tasks too, so neither a hot passage nor a hot line lands in one task.
    """
    spark = keyed.sparkSession
    found = anchors(keyed, window, gram)
    often = cut(found.groupBy("anchor").agg(F.sum("n").alias("n"), F.count("*").alias("m")).where("n > 1").select("anchor", (F.col("m") > shard).alias("hot")))
    runs = found.join(often, "anchor").groupBy(*KEYS).agg(F.collect_set(F.struct("anchor", "hot", "w0", "w1")).alias("runs"))
    stretches = keyed.join(runs, KEYS).select("k1", "k2", "id", "text", "runs").mapInArrow(_stretches(window), "anchor long, hot boolean, k1 long, k2 long, w0 int, stretch binary")
    # one exchange, read by the automata and by the window counts: each skips the other's rows
    stretches = stretches.repartition(parts(spark), "anchor", F.when(F.col("hot"), F.xxhash64("k1", "w0")))
    cold = stretches.sortWithinPartitions("anchor").mapInArrow(_automata(window), "k1 long, k2 long, a long, b long")
    if not often.where("hot").limit(1).count():
        return cold
    single = stretches.mapInArrow(_windows(window), "h1 long, h2 long, k1 long, k2 long, a long")
    # a window that many texts hold is counted and joined in as many salts as there are partitions
    single = single.withColumn("salt", F.pmod(F.xxhash64("k1", "k2", "a"), F.lit(parts(spark))))
    each = single.groupBy("h1", "h2", "salt").count()
    twice = each.groupBy("h1", "h2").agg(F.sum("count").alias("n"), F.collect_set("salt").alias("salt")).where("n > 1").select("h1", "h2", F.explode("salt").alias("salt"))
    hot = single.join(twice, ["h1", "h2", "salt"]).select("k1", "k2", "a", (F.col("a") + window).alias("b"))
    return cold.unionByName(hot)


def _strip(batches):
    for batch in batches:
        n, gone, digest = [], [], []
        for lo in range(0, batch.num_rows, 256):
            piece = batch.slice(lo, 256)
            for text, found in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()
                change = np.zeros(len(words) + 1, np.int64)
                for s in found or ():
                    change[s["a"]] += 1
                    change[s["b"]] -= 1
                lost = np.cumsum(change[:-1]) > 0
                n.append(len(words))
                gone.append(int(lost.sum()))
                kept = words if not gone[-1] else [w for w, x in zip(words, lost.tolist(), strict=True) if not x]
                digest.append(b" ".join(kept))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.binary())], names=["id", "n_words", "n_removed", "kept"])


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, digest: bool = False, **options) -> DataFrame:
    """id, n_words, n_removed, kept: each text without the words in repeated windows, one space between words.

    A window is `window` consecutive words of one text; it is repeated if its words start at any
    other place, in the same text too. Windows are judged on the input: of copies all go. Null and
    empty texts have no words; a text shorter than the window stays whole; very long texts are judged whole;
    repeated rows are copies of each other, ties do not arise; other columns are ignored; an empty table gives no rows. With `digest` the kept text's
    SHA-256 comes in place of the text.
    """
    small_batches(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    lost = repeated_spans(keyed, window, **options).groupBy(*KEYS).agg(F.collect_set(F.struct("a", "b")).alias("lost"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in _strip(batches):
            kept = batch.column(3)
            last = pa.array([hashlib.sha256(x).hexdigest() for x in kept.to_pylist()]) if digest else kept.cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], last], names=[*batch.schema.names[:3], "kept"])

    out = keyed.join(lost, KEYS, "left").select("id", "text", "lost").mapInArrow(run, f"id {kind}, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("id", id_col)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = strip_repeats(table(spark, sf_dir, "documents"), digest=True)
    return got.withColumnRenamed("kept", "kept_sha256")


#: DuckDB: counts of all windows of 35 words, spelled out.
OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), p AS (
  SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i, CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i:i + 34], ' ') END AS key FROM d
), c AS (
  SELECT r, i, word, key IS NOT NULL AND count(*) OVER (PARTITION BY key) > 1 AS again FROM p
), g AS (
  SELECT r, i, word, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM c
), s AS (
  SELECT r, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM g GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (r)
"""
