"""FastICA (parallel, logcosh) on PCA-whitened components.

Whitening comes from the Gram eigen-decomposition; each fixed-point iteration
is ONE aggregate over the (cached) whitened columns giving E[z g(Wz)^T] and
E[g'(Wz)]; the symmetric decorrelation runs on the driver on an c x c matrix."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _sym_decorrelate(w: np.ndarray) -> np.ndarray:
    s, u = np.linalg.eigh(w @ w.T)
    s = np.clip(s, np.finfo(float).tiny, None)
    return (u * (1.0 / np.sqrt(s))) @ u.T @ w


def fast_ica(whitened: DataFrame, cols: Sequence[str], seed: int = 42, max_iter: int = 500, tol: float = 1e-4):
    """Unmixing matrix W (c x c) of the whitened columns; returns (W, iterations)."""
    c = len(cols)
    rng = np.random.default_rng(seed)
    w = _sym_decorrelate(rng.normal(size=(c, c)))
    z = whitened.select(*[F.col(x).cast("double") for x in cols]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = z.count()
        it = 0
        for it in range(1, max_iter + 1):
            proj = [sum(F.lit(float(w[i, j])) * F.col(cols[j]) for j in range(c)) for i in range(c)]
            g = [F.tanh(p) for p in proj]
            aggs = [F.sum(F.col(cols[j]) * g[i]).alias(f"m{i}_{j}") for i in range(c) for j in range(c)]
            aggs += [F.sum(1.0 - F.tanh(proj[i]) ** 2).alias(f"d{i}") for i in range(c)]
            r = z.agg(*aggs).first()
            ezg = np.array([[r[f"m{i}_{j}"] for j in range(c)] for i in range(c)]) / n
            egp = np.array([r[f"d{i}"] for i in range(c)]) / n
            w_new = _sym_decorrelate(ezg - egp[:, None] * w)
            lim = float(np.max(np.abs(np.abs(np.einsum("ij,ij->i", w_new, w)) - 1.0)))
            w = w_new
            if lim < tol:
                break
        return w, it
    finally:
        z.unpersist()
