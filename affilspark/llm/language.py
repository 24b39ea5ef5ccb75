"""Language identification: the family first, then one-versus-one linear SVMs within it."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affilspark.llm import _words as W
from affilspark.llm import svm
from affilspark.llm._spark import cut, fold, small_batches, table, widen

#: Families of language codes; other codes are put in families by their texts.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk tr tk uz",
}
#: Size of the hashed feature space, most training documents of a language, most languages of a learned family.
DIMENSIONS, PER_LANGUAGE, FAMILY = 1 << 14, 1000, 12
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_FOLD = W.LOWER.copy()
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32


def features(data: np.ndarray, offsets: np.ndarray, size: int = DIMENSIONS) -> np.ndarray:
    """Root-scaled, unit-length counts of hashed byte 2- and 3-grams of each row; non-letters count as space."""
    a = _FOLD[data].astype(np.uint32)
    if len(a) < 2:
        return np.zeros((len(offsets) - 1, size), np.float32)
    pair = a[:-1] * np.uint32(0x9E3779B1) + a[1:] * np.uint32(0x85EBCA6B)
    triple = pair[:-1] * np.uint32(0xC2B2AE35) + a[2:] * np.uint32(0x27D4EB2F) + np.uint32(1) if len(a) > 2 else a[:0]
    shift = np.uint32(32 - (size.bit_length() - 1))
    pair, triple = (pair * np.uint32(0x2C1B3C6D)) >> shift, (triple * np.uint32(0x297A2D39)) >> shift
    out = np.zeros((len(offsets) - 1, size), np.float32)
    for i, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if hi - lo >= 2:
            x = np.bincount(pair[lo : hi - 1], minlength=size) + np.bincount(triple[lo : max(hi - 2, lo)], minlength=size)
            x = np.sqrt(x, dtype=np.float32)
            out[i] = x / np.sqrt(x @ x)
    return out


def _sparse(batches):
    """Rows lang, h, text to lang, h and the text's features: indices and values."""
    for batch in batches:
        at, value = [], []
        for lo, hi, data, offsets in W.blocks(batch.column(2), 1 << 18):
            for x in features(data, offsets):
                i = np.flatnonzero(x)
                at.append(i.astype(np.int32))
                value.append(x[i])
        cuts = pa.array(np.cumsum([0, *map(len, at)]).astype(np.int32))
        columns = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate([np.zeros(0, kind), *x]).astype(kind))) for x, kind in ((at, np.int32), (value, np.float32))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["lang", "h", "at", "v"])


def _train(g: pd.DataFrame) -> pd.DataFrame:
    g = g.assign(n=g["at"].map(len), s=g["v"].map(lambda v: float(np.sum(v)))).sort_values(["h", "lang", "n", "s"])
    x, y = [(np.asarray(at, np.int64), np.asarray(v, float)) for at, v in zip(g["at"], g["v"], strict=True)], g["y"].to_numpy()
    share = np.where(y > 0, len(y) / max(2 * (y > 0).sum(), 1), len(y) / max(2 * (y <= 0).sum(), 1))
    w = svm.fit(x, DIMENSIONS, y, 10 * share)
    a, _ = svm.platt(svm.margins(x, w), y)
    return pd.DataFrame({"model": [g["model"].iloc[0]], "w": [w.astype(np.float32).tobytes()], "a": [min(a, 20.0)]})


def _centres(rows: DataFrame, langs: list[str]) -> np.ndarray:
    """The summed features of each language's rows; a row of DIMENSIONS for each language."""
    place = {k: i for i, k in enumerate(langs)}

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for lang, at, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                total.setdefault(place[lang], np.zeros(DIMENSIONS))[at] += v
        for k, x in total.items():
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k)), pa.array(at), pa.array(x[at])], names=["k", "i", "x"])

    got = rows.where(F.col("lang").isin(langs)).select("lang", "at", "v").mapInArrow(run, "k long, i long, x double").groupBy("k", "i").agg(F.sum("x").alias("x")).toPandas()
    out = np.zeros((len(langs), DIMENSIONS))
    out[got["k"], got["i"]] = got["x"]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _halve(langs: list[str], centre: np.ndarray) -> list[list[str]]:
    """Groups of at most FAMILY languages: halves along the direction in which their centres differ most."""
    if len(langs) <= FAMILY:
        return [langs]
    x = centre - centre.mean(axis=0)
    along = x @ (x.T @ np.linalg.eigh(x @ x.T)[1][:, -1])
    order = np.lexsort((np.arange(len(langs)), along.round(9)))
    parts = (np.sort(order[: len(order) // 2]), np.sort(order[len(order) // 2 :]))
    return [group for part in parts for group in _halve([langs[i] for i in part], centre[part])]


def _families(langs: list[str], rows: DataFrame) -> dict[str, str]:
    """The family of each language: by FAMILIES (a code's tag after - or _ aside), others in groups of like texts."""
    listed = {code: name for name, codes in FAMILIES.items() for code in codes.split()}
    out = {k: listed.get(k, listed.get(re.split("[-_]", k.lower())[0])) for k in langs}
    other = [k for k, v in out.items() if v is None]
    groups = _halve(other, _centres(rows, other)) if len(other) > FAMILY else [other]
    return out | {k: f"other {i}" for i, group in enumerate(groups) for k in group}


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_language: int = PER_LANGUAGE) -> list[tuple[str, str, str, np.ndarray, float]]:
    """Models (family or "", one, other, weights, slope) learned from rows with a text and a language.

    Every value of lang is learned. At most per_language documents of each, those least by a hash of id and
    text, are the bounded training sample, and each is featurised once. Each pair of families and each
    pair of languages within a family is one SVM, trained in a Spark task of its own; the driver gets the
    weights, DIMENSIONS floats a model. One language alone gives a model without weights; other columns
    are ignored; repeated rows count as often as they occur.
    """
    spark = labelled.sparkSession
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.xxhash64(F.lit(11), F.col(id_col), F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # a row for each language
    if not counts:
        return []
    langs = sorted(counts)
    if len(langs) == 1:
        return [("only", langs[0], "", np.zeros(0, np.float32), 1.0)]
    # a rate that keeps half as many again makes the exact cut below cheap
    rate = spark.createDataFrame([(k, float(min(1.0, 1.5 * per_language / n + 50 / n) * (1 << 20))) for k, n in counts.items()], "lang string, rate double")
    near = rows.join(F.broadcast(rate), "lang").where(F.pmod("h", F.lit(1 << 20)) < F.col("rate")).select("lang", "h", "text")
    least = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 20)), "h", F.xxhash64("text")))).where(F.col("r") <= per_language)
    sample = cut(least.select("lang", "h", "text").mapInArrow(_sparse, "lang string, h long, at array<int>, v array<float>"))
    kin: dict[str, list[str]] = {}
    for k, name in sorted(_families(langs, sample).items()):
        kin.setdefault(name, []).append(k)
    models = [("", a, b, kin[a], kin[b]) for a, b in combinations(sorted(kin), 2)]
    models += [(f, a, b, [a], [b]) for f in sorted(kin) for a, b in combinations(kin[f], 2)]
    sides = spark.createDataFrame([(i, k, y) for i, (_, _, _, up, down) in enumerate(models) for group, y in ((up, 1), (down, -1)) for k in group], "model int, lang string, y int")
    dealt = sample.join(F.broadcast(sides), "lang")
    got = {r["model"]: r for r in dealt.groupBy("model").applyInPandas(_train, "model int, w binary, a double").collect()}
    out = [(f, a, b, np.frombuffer(got[i]["w"], np.float32), got[i]["a"]) for i, (f, a, b, _, _) in enumerate(models)]
    return out + [(f, k[0], "", np.zeros(0, np.float32), 1.0) for f, k in kin.items() if len(k) == 1]


def _decide(margins: np.ndarray, pairs: list, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """By one-versus-one: for each row the name with most wins (then the largest sum of chances, then the first by name), and its least chance."""
    votes, sums = np.zeros((len(margins), len(names))), np.zeros((len(margins), len(names)))
    least = np.ones((len(margins), len(names)))
    place = {k: i for i, k in enumerate(names)}
    for j, (one, other, slope) in enumerate(pairs):
        p = 1 / (1 + np.exp(-np.clip(slope * margins[:, j], -30, 30)))
        for i, q in ((place[one], p), (place[other], 1 - p)):
            votes[:, i] += q > 0.5
            sums[:, i] += q
            least[:, i] = np.minimum(least[:, i], q)
    best = np.argmax(votes * (len(names) + 1) + sums, axis=1)
    return best, least[np.arange(len(best)), best]


def _levels(models: list) -> dict[str, tuple[list[str], list, np.ndarray]]:
    """For the families ("") and for each family: its names in order, its pairs with slopes, and their weights side by side."""
    out = {}
    for level in sorted({m[0] for m in models}):
        own = [m for m in models if m[0] == level]
        pairs = [m for m in own if m[2]]
        weights = np.stack([m[3] for m in pairs], axis=1) if pairs else np.zeros((DIMENSIONS + 1, 0), np.float32)
        out[level] = sorted({x for m in own for x in m[1:3] if x}), [(m[1], m[2], m[4]) for m in pairs], weights
    return out


def identify(docs: DataFrame, models: list, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """docs without the text (unless keep_text), with lang_pred and score (0 to 1) from the whole text.

    The score is the least pairwise chance of the family times that of the language in it. Null
    texts and texts without a letter get `und` and score 0, and so does all if nothing was learned.
    Ties go to the first name in order. Very long texts are read whole; repeated rows come back
    repeated; an empty table gives no rows. Other columns pass; columns named lang_pred or score are replaced.
    """
    small_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c not in ("lang_pred", "score") and (keep_text or c != text_col)]
    shared = docs.sparkSession.sparkContext.broadcast(_levels(models))

    def guess(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        levels = shared.value
        names, pairs, weights = levels.get("", ([next(iter(levels))], [], np.zeros((DIMENSIONS + 1, 0), np.float32)))
        fam, chance = _decide(x @ weights[:-1] + weights[-1], pairs, names)
        out = np.empty(len(x), object)
        for f, name in enumerate(names):
            rows = np.flatnonzero(fam == f)
            inner, pairs, weights = levels[name]
            k, q = _decide(x[rows] @ weights[:-1] + weights[-1], pairs, inner)
            out[rows] = np.array(inner, object)[k]
            chance[rows] *= q
        return out, chance

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            pred, score = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            for lo, hi, data, offsets in W.blocks(column, 1 << 20):
                text = data.tobytes()
                ok = np.array([bool(_LETTER.search(text[a:b].decode("utf-8", "replace"))) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
                for at in range(0, hi - lo if shared.value else 0, 256):
                    to = min(at + 256, hi - lo)
                    begin = offsets[at]
                    pred[lo + at : lo + to], score[lo + at : lo + to] = guess(features(data[begin : offsets[to]], offsets[at : to + 1] - begin))
                pred[lo:hi][~ok] = UNKNOWN
                score[lo:hi][~ok] = 0.0
            yield pa.RecordBatch.from_arrays([*batch.select(rest).columns, pa.array(pred, pa.string()), pa.array(score)], names=[*rest, "lang_pred", "score"])

    read = rest if text_col in rest else [*rest, text_col]
    return docs.select(*read).mapInArrow(run, widen(docs.select(*rest), lang_pred="string", score="double"))


def keep_identified(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", least: float = 0.25) -> DataFrame:
    """docs without the rows of unknown language: `und`, or a score below `least`; their columns, of any names, stay as they are."""
    models = train(docs, text_col, lang_col, id_col)
    own = docs.toDF(*[f"u{i}" for i in range(len(docs.columns))])
    got = identify(own, models, f"u{docs.columns.index(text_col)}", keep_text=True)
    ok = F.col("lang_pred") != UNKNOWN
    if len(models) > 1:
        ok = ok & (F.col("score") >= least)
    return got.where(ok).select(*own.columns).toDF(*docs.columns)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = train(docs.where(fold("doc_id", 4) != 2))
    held = docs.select("doc_id", "text", (fold("doc_id", 4) == 2).alias("held_out"))
    return identify(held, models)
