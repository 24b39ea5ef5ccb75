"""Mixing sources to target weights by entropy balancing, with rates rounded into copies."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affilspark.llm._spark import cut, parts, row_hashes, small_batches, table

#: Weights of sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Documents and words that one rounding group holds on average; a hot source has as many groups as it needs.
GROUP_DOCS, GROUP_WORDS = 4096, 4_000_000


def n_words(text):
    """Runs of bytes other than space and 0x09-0x0D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, cap: float = 3.0) -> DataFrame:
    """sources(source, weight, source_size, ...) with `target`: the whole size shared by weight.

    No target passes cap times its source's size; the excess is shared again by weight until none is
    above. One scale tau fits all: target = min(cap * size, weight * tau); the driver sees two sums
    a round. With all sources capped the targets are the caps.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    tau = None
    seen = -1
    while True:
        over = F.lit(False) if tau is None else F.col("weight") * F.lit(tau) > cap * F.col("source_size")
        n, held, free = sources.agg(F.sum(over.cast("long")), F.sum(F.when(over, cap * F.col("source_size")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if n == seen or not free:
            break
        seen, tau = n, (total - held) / free
    whole = cap * F.col("source_size")
    return sources.withColumn("target", whole.cast("double") if tau is None or not free else F.least(whole.cast("double"), F.col("weight") * F.lit(float(tau))))


def _ordered(stats: DataFrame) -> DataFrame:
    """Sources with `place`, their number in order of code points, null last; the driver sees a count for each partition."""
    spark = stats.sparkSession
    order = [F.col("source").isNull(), F.encode("source", "UTF-8")]
    ranged = cut(stats.repartitionByRange(parts(spark), *order).withColumn("pid", F.spark_partition_id()))
    before, total = [], 0
    for pid, n in sorted(map(tuple, ranged.groupBy("pid").count().collect())):
        before.append((pid, total))
        total += n
    base = spark.createDataFrame(before, "pid int, base long")
    within = F.row_number().over(Window.partitionBy("pid").orderBy(*order)) - 1
    return ranged.withColumn("within", within).join(F.broadcast(base), "pid").withColumn("place", F.col("base") + F.col("within")).drop("pid", "within", "base")


def rates(sized: DataFrame, sources: DataFrame, steps: int = 40, close: float = 1e-9) -> DataFrame:
    """sources with `tilt`, the dual variable of each source's word constraint, and `rate` = exp(tilt).

    Entropy balancing minimises sum(size * r * log r) over the documents of sized(source, size) under
    sum(size * r) = target for each source. Its dual is convex, with r = exp(tilt); as a document is in one
    source, the gradient (target less words taken) and the Hessian (words taken) are a sum each.
    Every Newton step, damped to at most 1, sums them over all documents in the tasks, until no
    source is farther than `close` of its target from it; if `steps` of them do not get there, the job
    stops with an error. A source without words (or target) has rate 0.
    """
    same = F.col("source").eqNullSafe(F.col("s"))
    dual = sources.select(F.col("source").alias("s"), "target").withColumn("tilt", F.lit(0.0)).where("target > 0")
    for _ in range(steps):
        rated = sized.where("size > 0").select("source", "size").join(hint(dual), same).select("s", "target", "tilt", (F.col("size") * F.exp("tilt")).alias("mass"))
        sums = cut(rated.groupBy("s", "target", "tilt").agg(F.sum("mass").alias("mass")))
        far = sums.agg(F.max(F.abs(F.col("target") - F.col("mass")) / F.col("target"))).first()[0]
        if far is None or far <= close:
            break
        step = (F.col("target") - F.col("mass")) / F.col("mass")
        dual = sums.select("s", "target", (F.col("tilt") + F.greatest(F.lit(-1.0), F.least(F.lit(1.0), step))).alias("tilt"))
    else:
        raise RuntimeError(f"rates did not settle in {steps} Newton steps: a source is off its target by {far:.3g} of it")
    return sources.join(dual.select("s", "tilt"), same, "left").drop("s").withColumn("rate", F.coalesce(F.exp("tilt"), F.lit(0.0)))


def hint(sources: DataFrame) -> DataFrame:
    """A broadcast hint if a count finds that a row of about 100 bytes for each source is at most 8 MB."""
    return F.broadcast(sources) if sources.count() * 100 < 8 << 20 else sources


def _round(cap: int):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["size", "k1", "k2"], ascending=[False, True, True], kind="stable")
        copies = np.zeros(len(g), np.int64)
        owed = 0.0
        for i, (size, rate, n) in enumerate(zip(g["size"].tolist(), g["rate"].tolist(), g["n"].tolist(), strict=True)):
            if size > 0:
                owed += rate * size * n
                copies[i] = min(cap * n, max(0, round(owed / size)))
                owed -= copies[i] * size
        g["copies"] = copies
        return g[["k1", "k2", "s", "size", "n", "copies"]]

    return run


def _mixed(docs: DataFrame, text_col: str, source_col: str, id_col: str, weights, cap: int, keep_text: bool) -> DataFrame:
    """docs with their columns as u0, u1, ... in order (without the text's unless keep_text), and size, source_size, target and copies."""
    small_batches(docs.sparkSession)
    own = docs.toDF(*[f"u{i}" for i in range(len(docs.columns))])
    text, source, the_id = (f"u{docs.columns.index(c)}" for c in (text_col, source_col, id_col))
    named = own.select("*", *row_hashes(the_id, text))
    sized = cut(named.withColumn("size", n_words(F.col(text))).drop(text))
    rows = sized.select("k1", "k2", F.col(source).alias("source"), "size")
    stats = _ordered(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")))
    stats = cut(stats.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))))
    goal = rates(rows, targets(stats, float(cap))).withColumn("groups", F.greatest(F.lit(1), F.ceil(F.greatest(F.col("docs") / GROUP_DOCS, F.col("source_size") / GROUP_WORDS))))
    goal = cut(goal.select(F.col("source").alias("s"), "source_size", "target", "rate", "groups"))
    # equal rows of a source are one row with a number and are rounded together
    each = rows.groupBy("k1", "k2", "source", "size").agg(F.count("*").alias("n"))
    each = each.join(hint(goal), F.col("source").eqNullSafe(F.col("s"))).withColumn("part", F.pmod(F.xxhash64("k1", F.lit(7)), F.col("groups")))
    each = each.select("k1", "k2", "source", "s", "part", "size", "n", "rate").repartition(parts(docs.sparkSession), "s", "part")
    done = each.groupBy("s", "part").applyInPandas(_round(cap), f"k1 long, k2 long, s {docs.schema[source_col].dataType.simpleString()}, size long, n long, copies long")
    done = cut(done)
    done = done.select(F.col("k1").alias("a"), F.col("k2").alias("b"), F.col("s").alias("t"), *(["size"] if keep_text else []), "n", "copies")
    full = named if keep_text else sized
    full = full.join(done, (F.col("k1") == F.col("a")) & (F.col("k2") == F.col("b")) & F.col(source).eqNullSafe(F.col("t")))
    many = full.where("n > 1").withColumn("nth", F.row_number().over(Window.partitionBy("a", "b", "t").orderBy("a")))
    share = F.expr("copies div n") + (F.col("nth") <= F.col("copies") % F.col("n")).cast("long")
    full = full.where("n = 1").unionByName(many.withColumn("copies", share).drop("nth"))
    full = full.join(hint(goal), F.col("t").eqNullSafe(F.col("s")))
    return full.select(*[c for c in own.columns if keep_text or c != text], "size", "source_size", "target", "copies")


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", weights=WEIGHTS, cap: int = 3, keep_text: bool = True) -> DataFrame:
    """docs with _size, _source_size, _target and _copies (0 to cap).

    A document's rate is exp(tilt of its source); within groups of a source it is rounded to copies
    from the longest document down, each rounding passing its remainder on, so a group ends within
    half its shortest document of its share (unless all are at 0 or cap copies). Groups are made by
    a hash of the row and hold ids' hashes and sizes, no texts, so reruns agree and long texts do not weigh. Null
    sources are one source, last in order; null texts have size 0 and no copies; equal rows are
    rounded together and share their copies; ties in size go by hash; an empty table gives no rows. Columns of docs
    named as the four new ones are replaced, all others pass whatever their names.
    """
    docs = docs.drop("_size", "_source_size", "_target", "_copies")
    names = [c for c in docs.columns if keep_text or c != text_col]
    return _mixed(docs, text_col, source_col, id_col, weights, cap, keep_text).toDF(*names, "_size", "_source_size", "_target", "_copies")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep_text=False)
    return got.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"))


def mixed(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", weights=WEIGHTS, cap: int = 3) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken; columns of any names pass as they are."""
    got = _mixed(docs, text_col, source_col, id_col, weights, cap, True).where("copies > 0")
    copied = got.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copied.drop("copy", "size", "source_size", "target", "copies").toDF(*docs.columns)
