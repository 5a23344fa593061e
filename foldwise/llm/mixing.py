"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Every document of a source expects ``rate = target / source size`` copies.  The
expected copies are prefix-summed over the documents of the source (ordered by
size, id and text digest, so that the sample is stratified by size), one random
offset in [0, 1) per source is added, and a document is emitted once for each
integer boundary its stretch of the prefix sum crosses: floor(rate) or
ceil(rate) times.

The ranks are distributed: rows are range-partitioned by (source, size, id,
digest), numbered inside their partition, and shifted by the counts of the
partitions before; no window or group ever holds a whole source.  The numbered
rows are checkpointed so that offsets and rows come from one materialisation.
The two windows over *sources* see one row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwise.llm.common import checkpoint, n_words, no_null_text

#: a source takes at most so many times its own size
MAX_REPEAT = 3
WEIGHTS = (1, 2, 3)
SEED = 20261


def source_key(source: str | Column) -> Column:
    """Non-null key that sorts by code point, NULL last."""
    c = F.col(source) if isinstance(source, str) else source
    return F.when(c.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), c))


def offset_of(key: Column, seed: int) -> Column:
    """Uniform offset of a source: 16 bits, so that integer rates add exactly."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 4), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(65536.0)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Targets of (skey, source_size) rows, one row per source.

    Weights repeat over the sources in key order.  Shares stop at ``max_repeat``
    times the source's size and the excess is reshared by weight: the fixed
    point is a water level, found from running sums over the sources sorted by
    cap / weight."""
    by_key = W.partitionBy(F.lit(0)).orderBy("skey")
    by_fill = W.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), "skey")
    before = by_fill.rowsBetween(W.unboundedPreceding, -1)
    onwards = by_fill.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(0))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_key) - 1) % len(weights) + 1).cast("int"))
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onwards))
    out = (sizes.withColumn("weight", w)
           .withColumn("cap", F.col("source_size").cast("double") * float(max_repeat))
           .withColumn("total", F.sum("source_size").over(everything).cast("double"))
           .withColumn("fill", F.col("cap") / F.col("weight"))
           .withColumn("level_here", level)
           .withColumn("at", F.row_number().over(by_fill))
           .withColumn("first_open", F.min(F.when(F.col("fill") > F.col("level_here"), F.struct("at", "level_here")))
                       .over(everything)))
    top = F.col("first_open.level_here")
    target = F.when(top.isNull() | (F.col("fill") <= top), F.col("cap")).otherwise(F.col("weight") * top)
    return out.select("skey", "source_size", target.alias("target"))


def mix(docs: DataFrame, size: Column | None = None, source: str = "source", doc_id: str = "doc_id",
        tie: Column | None = None, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT,
        seed: int = SEED) -> DataFrame:
    """One row per input row: ``rec`` (struct of all its columns), ``size``,
    ``source_size``, ``target``, ``copies`` and ``taken = copies * size``.

    ``size`` defaults to the words of ``text``; ``tie`` orders rows of equal size
    and id (default: digest of ``text``).  NULL text has size 0; a NULL source is
    a source of its own (last); a source of size 0 has target 0 and its rows 0
    copies; NULL ids sort first; repeated rows are sampled as rows of their own;
    an empty table gives an empty result.  Extra columns ride along inside
    ``rec``, so their names cannot clash."""
    size = n_words("text") if size is None else size
    tie = F.md5(no_null_text("text")) if tie is None else tie
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rec"),
                       source_key(source).alias("skey"), size.alias("size"),
                       F.col(doc_id).alias("id"), tie.alias("tie"))
    order = ["skey", "size", "id", "tie"]
    numbered = checkpoint(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                          .select("*", F.spark_partition_id().alias("pid"),
                                  F.monotonically_increasing_id().alias("mid")).drop("tie", "id"))
    parts = numbered.groupBy("skey", "pid").agg(F.min("mid").alias("first"), F.count(F.lit(1)).alias("n"),
                                                F.sum("size").alias("s"))
    parts = parts.withColumn("before", F.coalesce(
        F.sum("n").over(W.partitionBy("skey").orderBy("pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    targets = source_targets(parts.groupBy("skey").agg(F.sum("s").alias("source_size")), weights, max_repeat)
    starts = (parts.join(targets, "skey")
              .select("skey", "pid", "source_size", "target", (F.col("before") - F.col("first")).alias("shift")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = (F.col("mid") + F.col("shift")).cast("double")
    u = offset_of(F.col("skey"), seed)
    copies = (F.floor(u + (rank + 1.0) * rate) - F.floor(u + rank * rate)).cast("long")
    return (numbered.join(starts, ["skey", "pid"])
            .select("rec", "size", "source_size", "target", copies.alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: every record ``copies`` times, its own columns only."""
    return (mixed.where("copies > 0").select("rec", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
            .select("rec.*"))
