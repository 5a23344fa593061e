"""Embedding whitening with a covariance weighted by multiplicity.

Equal x vectors are grouped once, with partial counts, so that a vector which
a third of all rows repeat is one row from there on.  Every pass works on the
distinct vectors with fit weights (their counts, or one each): the exact sums,
the centred covariance as a weighted matrix product per batch, the projection
of every distinct vector and the covariance of the result.  Rows get their
vector's values by a join on the vector; Spark splits its skewed keys.

Only matrices of dimension x dimension leave a task; they are added up in
groups before a bounded number of them reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import bound_batches, checkpoint

#: x = floor(SCALE * c) + OFFSET
SCALE, OFFSET = 1024.0, 100_000
COMPONENTS = 8
#: partial matrices that reach the driver at most
GROUPS = 32
#: an eigenvalue below this share of the trace, times the dimensions, has no direction
RANK_EPS = 1e-14


def _matrix(col: pa.Array, kind: type) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(col), -1)


def _summed(df: DataFrame, partial: Callable[[np.ndarray, np.ndarray], np.ndarray], column: str, dtype: str) -> np.ndarray | None:
    """Sum over all batches of ``partial(vectors, weights)``, as numbers of ``dtype``; None without rows."""
    kind = np.int64 if column == "x" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for b in batches:
            if b.num_rows:
                part = partial(_matrix(b[column], kind), b["weight"].to_numpy())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([total.astype(dtype).tobytes()], pa.binary())], names=["part", "m"])

    def add(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        total = sum(np.frombuffer(m.as_buffer(), dtype) for m in t["m"])
        return pa.table({"part": pa.array([t["part"][0].as_py() % GROUPS], pa.int32()), "m": pa.array([total.tobytes()], pa.binary())})

    parts = df.select(column, "weight").mapInArrow(run, "part int, m binary")
    got = parts.groupBy(F.col("part") % GROUPS).applyInArrow(add, "part int, m binary").orderBy("part").collect()
    return sum(np.frombuffer(r.m, dtype) for r in got) if got else None


def centred(x: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """x - sums / n of whole numbers, rounded once: the difference of whole parts is exact."""
    whole, rest = np.divmod(sums, n)
    return (x - whole).astype(np.float64) - rest / n


def deviations(x: np.ndarray, sums: np.ndarray, n: int) -> list[int | None]:
    """Exact sum of (n * x - sums)^2 per row; None beyond a long."""
    most = int(np.abs(x).max(initial=0))
    if n * most < 2**62 and int(np.abs(sums).max(initial=0)) < 2**62:
        d = n * x - sums
        if int(np.abs(d).max(initial=0)) ** 2 * x.shape[1] < 2**63:
            return (d * d).sum(axis=1).tolist()
    big = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [v if v < 2**63 else None for v in big]


def components_of(cov: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) by falling eigenvalue; the largest entry of each is positive."""
    value, vector = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(-value, kind="stable")[:count]
    value, vector = value[order], vector[:, order]
    live = value > RANK_EPS * len(cov) * max(np.trace(cov), 0.0)
    value, vector = value[live], vector[:, live]
    sign = np.sign(vector[np.abs(vector).argmax(axis=0), np.arange(vector.shape[1])]) if len(value) else np.ones(0)
    return value, vector * sign


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           weights: str = "counts", scale: float = SCALE, offset: int = OFFSET) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    ``weights``: "counts" fits on all vectors, "one" on each distinct vector once;
    n is the fit's total weight.  Rows with a NULL vector, or NULL or non-finite
    entries, are left out, as are empty vectors and those whose length is not the
    most frequent one (of equally frequent ones the longest).  Rows of NULL id and
    rows that repeat keep rows of their own.  Directions without variance (all
    vectors equal, more components than dimensions) have no component.  A
    deviation beyond a long is NULL.  Other columns are not read.  An empty table
    gives an empty result."""
    if weights not in ("counts", "one"):
        raise ValueError(f"weights are counts or one, not {weights!r}")
    spark = vectors.sparkSession
    v = F.col("v")
    rows = bound_batches(vectors).select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = rows.where(v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)))
    rows = rows.select("id", F.transform(v, lambda c: F.floor(F.lit(scale) * c).cast("long") + F.lit(offset).cast("long")).alias("x"))
    groups = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    distinct = checkpoint(groups.withColumn("weight", F.col("copies") if weights == "counts" else F.lit(1).cast("long")))
    sizes = distinct.groupBy(F.size("x").alias("dims")).agg(F.sum("copies").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    dims = sizes.dims if sizes else 1
    distinct = distinct.where(F.size("x") == dims)

    first = _summed(distinct, lambda x, w: np.concatenate([[w.sum()], w @ x]), "x", "<i8")
    if first is None:
        return spark.createDataFrame([], f"id {rows.schema['id'].dataType.simpleString()}, component int, n long, deviation long, "
                                         "whitened double, explained double, identity_error double")
    n, sums = int(first[0]), first[1:]

    def product(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        c = centred(x, sums, n)
        return ((c * w[:, None]).T @ c).ravel()

    cov = _summed(distinct, product, "x", "<f8").reshape(dims, dims) / n
    value, vector_of = components_of(cov, components)
    explained = (value / np.trace(cov)).tolist()
    turn = vector_of / np.sqrt(value)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b["x"], np.int64) if b.num_rows else np.empty((0, dims), np.int64)
            white = centred(x, sums, n) @ turn
            yield pa.RecordBatch.from_arrays(
                [b["x"], b["weight"], pa.array(deviations(x, sums, n), pa.int64()), pa.array(list(white), pa.list_(pa.float64()))],
                names=["x", "weight", "deviation", "white"])

    white = checkpoint(distinct.select("x", "weight").mapInArrow(project, "x array<long>, weight long, deviation long, white array<double>"))
    error = 0.0
    if len(value):
        k = len(value)
        mean = _summed(white, lambda y, w: w @ y, "white", "<f8") / n
        got = _summed(white, lambda y, w: (((y - mean) * w[:, None]).T @ (y - mean)).ravel(), "white", "<f8").reshape(k, k) / n
        error = float(np.abs(got - np.eye(k)).max())
    shares = F.array(*[F.lit(float(e)) for e in explained]) if explained else F.array().cast("array<double>")
    back = rows.join(white.drop("weight"), "x").select("id", "deviation", F.posexplode("white").alias("k", "whitened"))
    return back.select("id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                       F.element_at(shares, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"))
