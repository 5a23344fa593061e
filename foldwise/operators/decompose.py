"""PCA (M8) and FastICA (M9) as fitted stages: fit, transform, save and load.

Input columns are 0-filled and standardised.  The fit is one aggregate for the
means and one Gram pass around them, so that variances do not cancel; scores of
all components are one matrix product per Arrow batch and rows do not move.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.operators import gram, ica
from foldwise.sources.sinks import read_json_doc, write_json_doc


def _project(df: DataFrame, columns: Sequence[str], weights: np.ndarray, offset: np.ndarray, names: Sequence[str]) -> DataFrame:
    """``df`` with the columns ``names`` = [0-filled columns] @ weights + offset."""
    kept, inputs = df.columns, [f"__in{j}" for j in range(len(columns))]
    taken = set(kept) & set(names)
    if taken:
        raise ValueError(f"columns that are there already: {sorted(taken)}")
    ready = df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(x) for c, x in zip(columns, inputs, strict=True)])
    schema = T.StructType([*df.schema.fields, *[T.StructField(c, T.DoubleType()) for c in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b[c].to_numpy() for c in inputs]) if inputs else np.empty((b.num_rows, 0))
            y = x @ weights + offset
            yield pa.RecordBatch.from_arrays([*[b[c] for c in kept], *[pa.array(y[:, k]) for k in range(len(names))]],
                                             schema=pa.schema([*[b.schema.field(c) for c in kept], *[pa.field(c, pa.float64()) for c in names]]))

    return ready.mapInArrow(run, schema)


@dataclass
class PCAModel:
    columns: list[str]
    n: int
    mean: list[float]
    scale: list[float]              # population deviations, 1 for a constant column
    eigenvalues: list[float]        # of the correlations, falling
    loadings: list[list[float]]     # a column per component; the largest entry of each is positive

    def explained(self) -> list[float]:
        total = sum(self.eigenvalues)
        return [e / total if total > 0 else 0.0 for e in self.eigenvalues]

    def variance_frame(self, spark: SparkSession) -> DataFrame:
        """(component, eigenvalue, explained_variance_ratio, cumulative), a row per component."""
        share = self.explained()
        rows = [(k + 1, float(e), float(r), float(c)) for k, (e, r, c) in enumerate(zip(self.eigenvalues, share, np.cumsum(share), strict=True))]
        return spark.createDataFrame(rows, "component int, eigenvalue double, explained_variance_ratio double, cumulative double")

    def _weights(self, k: int, whiten: bool) -> tuple[np.ndarray, np.ndarray]:
        w = np.array(self.loadings).reshape(len(self.columns), -1)[:, :k] / np.array(self.scale)[:, None]
        if whiten:
            w = w / np.sqrt(np.maximum(np.array(self.eigenvalues[:k]), 1e-300))
        return w, -np.array(self.mean) @ w

    def transform(self, df: DataFrame, k: int = 2, prefix: str = "pc", whiten: bool = False) -> DataFrame:
        """``df`` with the scores pc1 .. pck (unit variance with ``whiten``)."""
        w, offset = self._weights(k, whiten)
        return _project(df, self.columns, w, offset, [f"{prefix}{i + 1}" for i in range(w.shape[1])])

    def save(self, spark: SparkSession, path: str) -> None:
        write_json_doc(spark, asdict(self), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PCAModel:
        return cls(**read_json_doc(spark, path))


def fit_pca(df: DataFrame, columns: Sequence[str]) -> PCAModel:
    """All components of the standardised, 0-filled columns."""
    cols = list(columns)
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    centre = filled.agg(*[F.avg(c).alias(c) for c in cols]).first()
    centre = [float(centre[c] or 0.0) for c in cols]
    mom = gram.moments(filled, cols, [], None, centre).total()
    p = len(cols)
    n = mom[2 * p, 2 * p]
    if not n:
        raise ValueError("no rows to fit components on")
    rest = mom[:p, 2 * p] / n                         # what rounding left of the means
    cov = mom[:p, :p] / n - np.outer(rest, rest)
    std = np.sqrt(np.clip(np.diag(cov), 0.0, None))
    scale = np.where(std > 0, std, 1.0)
    lam, vec = gram.pca_from_gram(cov / np.outer(scale, scale))
    return PCAModel(cols, int(n), (np.array(centre) + rest).tolist(), scale.tolist(), lam.tolist(), vec.tolist())


@dataclass
class ICAModel:
    pca: PCAModel
    unmixing: list[list[float]]     # (components, whitened components)
    iterations: int

    def transform(self, df: DataFrame, prefix: str = "ic") -> DataFrame:
        """``df`` with the component scores ic1 .. ick: uncorrelated, unit variance."""
        w, offset = self.pca._weights(len(self.unmixing), True)
        u = np.array(self.unmixing).T
        return _project(df, self.pca.columns, w @ u, offset @ u, [f"{prefix}{i + 1}" for i in range(u.shape[1])])

    def save(self, spark: SparkSession, path: str) -> None:
        write_json_doc(spark, asdict(self), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ICAModel:
        d = json.loads(json.dumps(read_json_doc(spark, path)))
        return cls(PCAModel(**d["pca"]), d["unmixing"], d["iterations"])


def fit_ica(df: DataFrame, columns: Sequence[str], components: int = 3, seed: int = 42, max_iter: int = 500, pca: PCAModel | None = None) -> ICAModel:
    """Independent components of the whitened columns (components without variance are left out)."""
    pca = pca or fit_pca(df, columns)
    live = sum(e > 1e-12 * sum(pca.eigenvalues) for e in pca.eigenvalues)
    k = min(components, live)
    if not k:
        raise ValueError("no column varies")
    names = [f"z{i + 1}" for i in range(k)]
    white = pca.transform(df.select(*pca.columns), k, "z", whiten=True).select(*names)
    w, iterations = ica.fast_ica(white, names, seed=seed, max_iter=max_iter)
    return ICAModel(pca, w.tolist(), int(iterations))
