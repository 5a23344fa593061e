"""Two-pass external shuffle into shards.

Pass 1 scatters the records into buckets by seeded hashes: the shard by highest
random weight of (seed, id, shard), a bucket inside the shard by another seeded
hash of the record.  The number of buckets follows from the bytes of the table,
so that a bucket fits in memory at every table size.  Pass 2 Fisher-Yates
shuffles each bucket in its own task and writes it; a record's slot is its place
in the bucket plus the rows of the shard's earlier buckets.

Law ``key``: id and shard count alone decide the shard, and a further shard only
takes rows into itself (``grown_shard`` is the shard under one more).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.common import scratch

SEED = 71
#: bytes of one bucket: small against an executor's memory
BUCKET_BYTES = 16 << 20
ROW_OVERHEAD = 16


def record_size(text: str = "text"):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_OVERHEAD


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of 0..n-1: swap each place, from the last, with a random place up to it."""
    rng = np.random.Generator(np.random.Philox(key=[seed, bucket]))
    picks = rng.integers(0, np.arange(1, n + 1)).tolist() if n else []
    out = list(range(n))
    for i in range(n - 1, 0, -1):
        j = picks[i]
        out[i], out[j] = out[j], out[i]
    return np.array(out, dtype=np.int64)


def _weight(seed: int, doc_id: str, shard):
    return F.xxhash64(F.lit(seed), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), shard)


def shuffle_to_shards(docs: DataFrame, n_shards: int, path: str | None = None, seed: int = SEED,
                      bucket_bytes: int = BUCKET_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the shuffled records under ``path`` (Parquet, one folder per shard) and return them as read back:
    ``rec`` (struct of all columns), ``shard``, ``bucket``, ``slot``, ``grown_shard``.

    NULL ids count as the empty id; a NULL or empty text has 16 bytes; repeated
    rows are records of their own (identical ones land in one bucket); extra
    columns ride along in ``rec``; an empty table gives an empty result."""
    spark = docs.sparkSession
    path = path or scratch(spark, "shards")
    total = docs.agg(F.sum(record_size(f"`{text}`"))).first()[0] or 0
    per_shard = max(1, math.ceil(total / n_shards / bucket_bytes))
    weights = F.transform(F.sequence(F.lit(0), F.lit(n_shards)), lambda s: _weight(seed, doc_id, s))
    best = F.array_max(F.transform(F.slice("w", 1, n_shards), lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    rec = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(rec.alias("rec"), weights.alias("w"),
                       F.pmod(F.xxhash64(F.lit(seed + 1), rec), F.lit(per_shard)).cast("int").alias("sub"),
                       F.col(f"`{doc_id}`").alias("k1"), F.xxhash64(rec).alias("k2"))
    rows = rows.select("rec", "sub", "k1", "k2", best.alias("b"), F.element_at("w", n_shards + 1).alias("next"))
    rows = rows.select("rec", (F.col("b.i") * per_shard + F.col("sub")).alias("bucket"), F.col("b.i").alias("shard"),
                       F.when(F.col("next") > F.col("b.w"), F.lit(n_shards)).otherwise(F.col("b.i")).alias("grown_shard"), "k1", "k2")
    counts = (rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("first", F.coalesce(F.sum("n").over(
                  W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .select("bucket", "first"))
    out = T.StructType([T.StructField("rec", rows.schema["rec"].dataType), T.StructField("shard", T.IntegerType()),
                        T.StructField("bucket", T.IntegerType()), T.StructField("slot", T.LongType()),
                        T.StructField("grown_shard", T.IntegerType())])

    def shuffled(bucket: pa.Table) -> pa.Table:
        bucket = bucket.sort_by([("k1", "ascending"), ("k2", "ascending")])
        bucket = bucket.take(fisher_yates(bucket.num_rows, seed, bucket["bucket"][0].as_py()))
        slot = pa.array(np.arange(bucket.num_rows, dtype=np.int64) + bucket["first"][0].as_py())
        return bucket.select(["rec", "shard", "bucket"]).append_column("slot", slot).append_column(
            "grown_shard", bucket["grown_shard"])

    done = rows.join(counts, "bucket").groupBy("bucket").applyInArrow(shuffled, out)
    done.write.partitionBy("shard").parquet(path)
    return spark.read.schema(out).parquet(path)
