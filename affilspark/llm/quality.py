"""Quality classifier: naive Bayes log-count ratios scale n-gram indicators of a linear SVM."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affilspark.llm import _words as W
from affilspark.llm import svm
from affilspark.llm._spark import fold, small, small_batches, table, widen

#: Size of the hashed feature space and most training documents of a label.
DIMENSIONS, PER_LABEL = 1 << 18, 1500
THRESHOLD = 0.3

# shape of a word: case (none, lower, upper, title or mixed) and kind of its last byte
_ALPHA, _UPPER, _DIGIT, _PUNCT = (np.array([f(chr(c)) and c < 128 for c in range(256)]) for f in (str.isalpha, str.isupper, str.isdigit, lambda x: x.isprintable() and not x.isalnum()))


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = lambda mask: (lambda c: c[ends] - c[starts])(np.r_[0, np.cumsum(mask[data])])
    upper, alpha, digit, punct = total(_UPPER), total(_ALPHA | (np.arange(256) >= 128)), total(_DIGIT), total(_PUNCT)
    case = np.where(alpha == 0, 0, np.where(upper == 0, 1, np.where(upper == 1, 2, 3)))
    return (case * 4 + np.minimum(digit, 1) * 2 + (punct > alpha)) * 4 + np.minimum(punct, 3)


def features(data: np.ndarray, offsets: np.ndarray, size: int = DIMENSIONS) -> list[np.ndarray]:
    """The n-gram indicators of each row, as sorted indices below size.

    n-grams: words (A-Z lowered) and pairs of neighbours; and of how a text is written: words of up to 3 bytes
    with their case, pairs of words' shapes, whether a word repeats one of the three before it, and
    byte 3-grams around punctuation. The latter's share of the text, in steps of four, is part of the
    indicator, so that a long text differs from a long junk one.
    """
    starts, ends, first = W.spans(data, offsets)
    if not len(starts):
        return [np.zeros(1, np.int64) for _ in range(len(offsets) - 1)]
    h, shape = W.hashes(data, starts, ends), _shapes(data, starts, ends).astype(np.uint64)
    word = W.hashes(W.LOWER[data], starts, ends)
    after, follows = np.r_[shape[1:], shape[:1]], np.r_[word[1:], word[:1]]
    last = first[1:][np.diff(first) > 0] - 1
    after[last], follows[last] = 0, 0  # a text's last word has no neighbour
    single = W.mix(word + np.uint64(8 << 40))
    double = W.mix(word * W.BASE + follows + np.uint64(9 << 40))
    short = np.where(ends - starts <= 3, h, np.uint64(1) + shape)
    pair = W.mix(shape * np.uint64(4096) + after + np.uint64(1 << 40))
    again = np.zeros(len(h), bool)
    place = np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))
    for k in (1, 2, 3):
        again[k:] |= (h[k:] == h[:-k]) & (place[k:] >= k)
    again = W.mix(again.astype(np.uint64) + np.uint64(2 << 40))
    tail = np.maximum(ends - 3, starts)
    edge = np.where(_PUNCT[data[ends - 1]], W.mix(W.hashes(data, tail, ends) + np.uint64(3)), np.uint64(5) << np.uint64(40))
    grams = np.stack([short, pair, again, edge])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        got, n = np.unique(grams[:, a:b], return_counts=True)
        level = np.floor(np.log(n / max(b - a, 1) + 1e-9) / np.log(4)).astype(np.int64)
        length = np.array([min(int(np.log2(b - a + 1)), 12)], np.uint64) + np.uint64(7 << 40)
        keys = np.concatenate([W.mix(got + (level + 64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), W.mix(got), W.mix(length), single[a:b], double[a:b]])
        out.append(np.unique((keys >> np.uint64(20)) % np.uint64(size)).astype(np.int64))
    return out


def log_count_ratios(rows: DataFrame, text_col: str, label_col: str, smoothing: float = 1.0, size: int = DIMENSIONS) -> np.ndarray:
    """log of each feature's smoothed share in label 1 over that in label 0, over all rows."""

    def count(batches):
        total = np.zeros((2, size), np.int64)
        for batch in batches:
            label = batch.column(batch.schema.get_field_index(label_col)).to_numpy(zero_copy_only=False)
            for lo, _, data, offsets in W.blocks(batch.column(batch.schema.get_field_index(text_col)), 1 << 20):
                for i, x in enumerate(features(data, offsets)):
                    total[label[lo + i], x] += 1
        at = np.flatnonzero(total.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[1, at]), pa.array(total[0, at])], names=["f", "up", "down"])

    counts = rows.select(text_col, label_col).mapInArrow(count, "f long, up long, down long").groupBy("f").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    got = counts.toPandas()  # at most `size` rows
    up, down = np.full(size, smoothing), np.full(size, smoothing)
    up[got["f"]] += got["up"]
    down[got["f"]] += got["down"]
    return np.log(up / up.sum()) - np.log(down / down.sum())


def _design(texts: list, ratios: np.ndarray) -> svm.Rows:
    out = []
    for _, _, data, offsets in W.blocks(pa.array(texts, pa.large_string()), 1 << 20):
        for x in features(data, offsets):
            v = ratios[x]
            out.append((x, v / max(np.linalg.norm(v), 1e-6)))
    return out


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "label", id_col: str = "doc_id", per_label: int = PER_LABEL) -> dict:
    """Weights (ratios included), and slope and offset of the score, from rows with label 0 or 1.

    The ratios count all rows; the hinge-loss fit takes at most per_label rows of each label (those
    least by a hash), in one Spark task. Null texts count as empty; other labels are left out. With
    one label or none the score is that label's smoothed share.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(label_col).isin(0, 1)).select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.col(label_col).cast("int").alias("_y"), F.xxhash64(F.lit(13), F.col(id_col), F.col(text_col)).alias("_h"))
    counts = {r[0]: r[1] for r in rows.groupBy("_y").count().collect()}
    if len(counts) < 2:
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        return {"w": np.zeros(DIMENSIONS), "ratios": np.zeros(DIMENSIONS), "bias": 0.0, "a": 1.0, "b": float(np.log(share / (1 - share)))}
    ratios = log_count_ratios(rows, "_text", "_y")
    shared = rows.sparkSession.sparkContext.broadcast(ratios)
    edge = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.5 * per_label / n + 50 / n))])
    near = rows.where(F.pmod(F.col("_h"), F.lit(1 << 20)) < edge[F.col("_y")] * (1 << 20))
    least = near.withColumn("_r", F.row_number().over(Window.partitionBy("_y").orderBy(F.pmod(F.col("_h"), F.lit(1 << 20)), "_h", "_text"))).where(F.col("_r") <= per_label)

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["_h", "_text"])
        x, y = _design(g["_text"].tolist(), shared.value), np.where(g["_y"] > 0, 1.0, -1.0)
        half = np.arange(len(y)) % 2 == 0
        weight = np.array([counts[int(v > 0)] / max((y == v).sum(), 1) for v in y])
        weight /= weight.mean()
        margins = np.zeros(len(y))
        for side in (half, ~half):  # the score is fitted to margins of rows that the weights have not seen
            seen, unseen = ([x[i] for i in np.flatnonzero(k)] for k in (side, ~side))
            margins[~side] = svm.margins(unseen, svm.fit(seen, DIMENSIONS, y[side], 1.0))
        a, b = svm.platt(margins, y, weight)
        w = svm.fit(x, DIMENSIONS, y, 1.0)
        return pd.DataFrame({"w": [w.tobytes()], "a": [a], "b": [b]})

    got = least.select("_text", "_y", "_h", F.lit(0).alias("_one")).groupBy("_one").applyInPandas(fit, "w binary, a double, b double").first()
    w = np.frombuffer(got["w"])
    return {"w": w[:-1] * 1.0, "ratios": ratios, "bias": float(w[-1]), "a": got["a"], "b": got["b"]}


def score(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """docs without the text, with `score` in (0, 1), higher where label 1 is likelier; null texts count as empty."""
    rest = [c for c in docs.columns if c not in (text_col, "score")]
    shared = docs.sparkSession.sparkContext.broadcast((model["w"] * model["ratios"], model["ratios"] ** 2))
    bias, a, b = model["bias"], model["a"], model["b"]

    def run(batches):
        weight, square = shared.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for lo, _, data, offsets in W.blocks(batch.column(batch.schema.get_field_index(text_col)), 1 << 20):
                for i, x in enumerate(features(data, offsets)):
                    out[lo + i] = weight[x].sum() / max(np.sqrt(square[x].sum()), 1e-6) + bias
            out = 1 / (1 + np.exp(-np.clip(a * out + b, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.select(rest).columns, pa.array(out)], names=[*rest, "score"])

    return docs.select(*rest, text_col).mapInArrow(run, widen(docs.select(*rest), score="double"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0).select(F.col("doc_id").alias("_id"), F.col("quality").alias("label"))
    labels = small(labels, 2_000_000)  # 16 bytes a row; beyond it Spark shuffles both sides
    model = train(docs.where(fold("doc_id", 5) != 0).join(labels, F.col("doc_id") == F.col("_id")))
    got = score(docs.select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out")), model)
    return got.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
