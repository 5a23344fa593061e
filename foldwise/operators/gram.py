"""G, the Gram pass, and the linear solves that only need its aggregates.

One scan of the table yields, per *cell* (a fold, or a (fold, inner fold)
pair), the moment matrix  M = sum a a^T  of the augmented row vector

    a = [x - c (0 where NULL) | NULL indicators | 1 | y_1 .. y_T]

computed per Arrow batch with numpy inside ``mapInArrow``, added up over the
batches of a task (one packed triangle per task and cell leaves Python) and then
over tasks in two steps.  Its size is (2p + 1 + T)^2 per cell, independent of the
number of rows; the number of columns is checked, since all cells reach the driver.  Because imputation with a median m
and standardisation are affine in ``a`` (x_imp - c = x0 + z (m - c)), the
moments of the imputed, standardised features of *any* training set (a union
of cells) follow on the driver by a matrix product; no per-fold
re-materialisation of the data is needed.

Per-row quantities that are not moments (ridge leave-one-out residuals, the
predictions themselves) are computed in a second scan with the small solved
matrices shipped to the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.prep import PrepModel


@dataclass
class Moments:
    p: int
    t: int
    cells: dict[int, np.ndarray]  # cell -> (m x m) moment matrix

    @property
    def m(self) -> int:
        return 2 * self.p + 1 + self.t

    def total(self, cells: Sequence[int] | None = None, exclude: Sequence[int] = ()) -> np.ndarray:
        keys = [c for c in (cells if cells is not None else self.cells) if c not in set(exclude)]
        out = np.zeros((self.m, self.m))
        for c in keys:
            out += self.cells[c]
        return out


#: bytes of all moment matrices that the driver takes
DRIVER_BYTES = 1 << 30
#: tasks whose matrices one task of the first step adds up
FAN_IN = 32


def _task_moments(p: int, t: int, centre: np.ndarray):
    m = 2 * p + 1 + t
    iu = np.triu_indices(m)

    def run(batches):
        from pyspark import TaskContext

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            cols = batch.columns
            cell = cols[0].to_numpy(zero_copy_only=False).astype(np.int64)
            n = len(cell)
            if n == 0:
                continue
            a = np.empty((n, m))
            for j in range(p):
                x = cols[1 + j].to_numpy(zero_copy_only=False).astype(np.float64)
                miss = np.isnan(x)
                a[:, j] = np.where(miss, 0.0, x - centre[j])
                a[:, p + j] = miss
            a[:, 2 * p] = 1.0
            for j in range(t):
                a[:, 2 * p + 1 + j] = np.nan_to_num(cols[1 + p + j].to_numpy(zero_copy_only=False).astype(np.float64))
            order = np.argsort(cell, kind="stable")
            cell, a = cell[order], a[order]
            cuts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                c = int(cell[s])
                mat = a[s:e].T @ a[s:e]
                sums[c] = sums[c] + mat if c in sums else mat
        part = TaskContext.get().partitionId()
        for c, mat in sums.items():  # one at a time: a packed triangle may be large
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([part], pa.int32()), pa.array([mat[iu].tobytes()], pa.binary())],
                                             names=["cell", "part", "m"])

    return run


def _add_packed(t: pa.Table) -> pa.Table:
    t = t.sort_by("part")
    total = None
    for x in t["m"]:
        now = np.frombuffer(x.as_buffer(), np.float64)
        total = now.copy() if total is None else total + now
    return pa.table({"cell": t["cell"].slice(0, 1).combine_chunks(), "part": pa.array([t["part"][0].as_py() // FAN_IN], pa.int32()),
                     "m": pa.array([total.tobytes()], pa.binary())})


def moments(df: DataFrame, features: Sequence[str], targets: Sequence[str], cell: str | None,
            centre: Sequence[float]) -> Moments:
    """One pass: moment matrices per cell.  ``targets`` must already be in
    training space (e.g. log1p) and non-NULL.

    Raises if the matrices of all cells are more than DRIVER_BYTES together."""
    p, t = len(features), len(targets)
    cell_col = F.col(cell).cast("int") if cell else F.lit(0)
    src = df.select(cell_col.alias("cell"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                    *[F.col(c).cast("double").alias(f"y{i}") for i, c in enumerate(targets)])
    schema, m = "cell int, part int, m binary", 2 * p + 1 + t
    if 8 * m * m > DRIVER_BYTES:
        raise ValueError(f"{p} columns: a moment matrix of {8 * m * m} bytes is more than {DRIVER_BYTES}")
    parts = src.mapInArrow(_task_moments(p, t, np.asarray(centre, dtype=np.float64)), schema)
    some = parts.groupBy("cell", F.floor(F.col("part") / FAN_IN)).applyInArrow(_add_packed, schema)
    whole = some.groupBy("cell").applyInArrow(_add_packed, schema)
    iu = np.triu_indices(m)
    cells: dict[int, np.ndarray] = {}
    for r in whole.select("cell", "m").toLocalIterator():
        if 8 * m * m * (len(cells) + 1) > DRIVER_BYTES:
            raise ValueError(f"{p} columns in more than {len(cells)} cells: moment matrices of more than {DRIVER_BYTES} bytes")
        mat = np.zeros((m, m))
        mat[iu] = np.frombuffer(r.m, np.float64)
        cells[r.cell] = mat + np.triu(mat, 1).T
    return Moments(p, t, cells)


# ---------------------------------------------------------------- affine maps
def standardise_map(model: PrepModel, features: Sequence[str], centre: Sequence[float]) -> np.ndarray:
    """T (p x (2p+1)) with x_std = T a_x for the kept features of ``model``;
    columns of dropped features are zero."""
    p = len(features)
    tmat = np.zeros((p, 2 * p + 1))
    for j, c in enumerate(features):
        if c not in model.stats:
            continue
        s = model.stats[c]
        med = 0.0 if s.median is None else s.median
        mean = 0.0 if s.mean is None else s.mean
        tmat[j, j] = 1.0 / s.scale
        tmat[j, p + j] = (med - centre[j]) / s.scale
        tmat[j, 2 * p] = -(mean - centre[j]) / s.scale
    return tmat


@dataclass
class Design:
    """Centered normal equations of one training set in standardised space."""
    n: float
    mean_x: np.ndarray      # (p,)
    mean_y: np.ndarray      # (T,)
    gram: np.ndarray        # (p x p) centered X^T X
    xty: np.ndarray         # (p x T) centered X^T y
    yty: np.ndarray         # (T x T) centered y^T y
    tmat: np.ndarray        # (p x (2p+1)) standardisation map
    active: np.ndarray      # (p,) bool, kept features


def design(mom: np.ndarray, tmat: np.ndarray, p: int, t: int) -> Design:
    ax = slice(0, 2 * p + 1)
    ay = slice(2 * p + 1, 2 * p + 1 + t)
    n = mom[2 * p, 2 * p]
    sxx = tmat @ mom[ax, ax] @ tmat.T
    sx = tmat @ mom[ax, 2 * p]
    sxy = tmat @ mom[ax, ay]
    sy = mom[2 * p, ay]
    syy = mom[ay, ay]
    mx, my = sx / n, sy / n
    active = np.abs(tmat).sum(axis=1) > 0
    return Design(n, mx, my, sxx - n * np.outer(mx, mx), sxy - n * np.outer(mx, my), syy - n * np.outer(my, my), tmat, active)


def raw_coefficients(d: Design, w: np.ndarray, intercept: float) -> np.ndarray:
    """Coefficients over a_x = [x - c | z | 1] of the model  intercept + w . x_std."""
    beta = d.tmat.T @ w
    beta[-1] += intercept
    return beta


# ---------------------------------------------------------------- solvers
RIDGE_ALPHAS = np.logspace(-4, 4, 25)   # fixed values: base ridge grid
META_ALPHAS = np.logspace(-3, 3, 19)    # fixed values: meta ridge grid


def _restrict(d: Design):
    idx = np.flatnonzero(d.active)
    return idx, d.gram[np.ix_(idx, idx)], d.xty[idx]


def ridge(d: Design, alpha: float, target: int = 0) -> tuple[np.ndarray, float]:
    idx, g, b = _restrict(d)
    w = np.zeros(len(d.active))
    if len(idx):
        w[idx] = np.linalg.solve(g + alpha * np.eye(len(idx)), b[:, target])
    return w, float(d.mean_y[target] - d.mean_x @ w)


def ridge_eigen(d: Design):
    idx, g, b = _restrict(d)
    lam, vec = np.linalg.eigh(g)
    lam = np.clip(lam, 0.0, None)
    return idx, lam, vec, vec.T @ b


def bayesian_ridge(d: Design, target: int = 0, max_iter: int = 300, tol: float = 1e-3,
                   alpha_1: float = 1e-6, alpha_2: float = 1e-6, lambda_1: float = 1e-6, lambda_2: float = 1e-6):
    """Evidence maximisation (MacKay updates) from the Gram eigen-decomposition."""
    idx, lam, vec, vtb = ridge_eigen(d)
    n = d.n
    b = vtb[:, target]
    yty = d.yty[target, target]
    var_y = yty / n
    alpha_ = 1.0 / (var_y + np.finfo(np.float64).eps)
    lambda_ = 1.0
    coef_old = None
    for _ in range(max_iter):
        coef_v = b / (lam + lambda_ / alpha_)
        coef = vec @ coef_v
        rss = yty - 2 * coef_v @ b + coef_v @ (lam * coef_v)
        gamma = float(np.sum(alpha_ * lam / (lambda_ + alpha_ * lam)))
        lambda_ = (gamma + 2 * lambda_1) / (float(coef @ coef) + 2 * lambda_2)
        alpha_ = (n - gamma + 2 * alpha_1) / (max(rss, 0.0) + 2 * alpha_2)
        if coef_old is not None and np.sum(np.abs(coef_old - coef)) < tol:
            break
        coef_old = coef
    coef = vec @ (b / (lam + lambda_ / alpha_))
    w = np.zeros(len(d.active))
    w[idx] = coef
    return w, float(d.mean_y[target] - d.mean_x @ w), {"alpha": alpha_, "lambda": lambda_}


def _enet_cd(g, b, l1, l2, w, yty, max_iter=5000, tol=1e-4):
    """Cyclic coordinate descent for one alpha from a warm start (fallback)."""
    diag = np.diag(g)
    for _ in range(max_iter):
        for j in range(len(b)):
            if diag[j] > 0:
                rho = b[j] - g[j] @ w + diag[j] * w[j]
                w[j] = np.sign(rho) * max(abs(rho) - l1, 0.0) / (diag[j] + l2)
        gw = g @ w
        dual = float(np.max(np.abs(b - gw - l2 * w)))
        r2 = yty + w @ gw - 2 * b @ w
        const = l1 / dual if dual > l1 else 1.0
        gap = (0.5 * (r2 + r2 * const ** 2) if dual > l1 else r2) + l1 * np.abs(w).sum() \
            - const * (yty - b @ w) + 0.5 * l2 * (1 + const ** 2) * (w @ w)
        if gap <= tol * max(yty, 1e-300):
            break
    return w


def enet_path(g: np.ndarray, b: np.ndarray, n: float, alphas: Sequence[float], l1_ratio: float,
              yty: float, max_iter: int = 5000, tol: float = 1e-4) -> np.ndarray:
    """Elastic-net solutions along a decreasing alpha grid (one column each) for
    1/(2n) |y - Xw|^2 + a r |w|_1 + a (1 - r) / 2 |w|^2 on the centered Gram.

    Exact active-set method, warm-started along the path: solve the KKT system
    on the active set with fixed signs, drop sign violators, add the most
    correlated inactive coordinate, until the KKT conditions hold.  With a
    p x p Gram each step is a tiny solve; coordinate descent is the fallback
    if the active set ever cycles."""
    p = len(b)
    out = np.zeros((p, len(alphas)))
    w = np.zeros(p)
    active: list[int] = []
    signs: dict[int, float] = {}
    for k, a in enumerate(alphas):
        l1 = n * a * l1_ratio
        l2 = n * a * (1.0 - l1_ratio)
        ok = False
        for _ in range(4 * p + 10):
            if active:
                idx = np.array(active)
                sv = np.array([signs[j] for j in active])
                sol = np.linalg.solve(g[np.ix_(idx, idx)] + l2 * np.eye(len(idx)), b[idx] - l1 * sv)
                bad = [j for j, v, sg in zip(active, sol, sv) if v * sg < 0]
                if bad:
                    for j in bad:
                        active.remove(j)
                        signs.pop(j)
                    continue
                w = np.zeros(p)
                w[idx] = sol
            else:
                w = np.zeros(p)
            c = b - g @ w - l2 * w
            inactive = [j for j in range(p) if j not in signs and g[j, j] > 0]
            if not inactive:
                ok = True
                break
            viol = np.abs(c[inactive])
            jmax = int(np.argmax(viol))
            if viol[jmax] <= l1 * (1 + 1e-10) + 1e-300:
                ok = True
                break
            j = inactive[jmax]
            active.append(j)
            signs[j] = float(np.sign(c[j]))
        if not ok:
            w = _enet_cd(g, b, l1, l2, w.copy(), yty, max_iter, tol)
            active = [j for j in range(p) if w[j] != 0]
            signs = {j: float(np.sign(w[j])) for j in active}
        out[:, k] = w
    return out


def enet_alphas(b: np.ndarray, n: float, l1_ratio: float, n_alphas: int = 100, eps: float = 1e-3) -> np.ndarray:
    amax = float(np.max(np.abs(b))) / (n * l1_ratio) if len(b) else 1.0
    amax = max(amax, np.finfo(float).tiny)
    return np.logspace(np.log10(amax * eps), np.log10(amax), n_alphas)[::-1]


def sse_from_moments(w: np.ndarray, b0: float, mom: np.ndarray, tmat: np.ndarray, p: int, t_index: int) -> float:
    """Sum of squared errors of  b0 + w . x_std  on the rows of a moment matrix."""
    beta = tmat.T @ w
    beta[-1] += b0
    ax = slice(0, 2 * p + 1)
    yi = 2 * p + 1 + t_index
    return float(mom[yi, yi] - 2 * beta @ mom[ax, yi] + beta @ mom[ax, ax] @ beta)


# ---------------------------------------------------------------- PCA
def pca_from_gram(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (descending) and loadings; sign fixed so that the largest
    absolute loading of each component is positive."""
    lam, vec = np.linalg.eigh(cov)
    order = np.argsort(lam)[::-1]
    lam, vec = np.clip(lam[order], 0.0, None), vec[:, order]
    for k in range(vec.shape[1]):
        j = int(np.argmax(np.abs(vec[:, k])))
        if vec[j, k] < 0:
            vec[:, k] = -vec[:, k]
    return lam, vec
