"""Scalar column expressions.

All of these are plain ``pyspark.sql.functions`` compositions so they stay in
whole-stage codegen.  NULL is the single missing marker: NaN and +-Inf are
turned into NULL at the scan (``to_null_if_not_finite``) because Spark's
``avg``/``count``/``greatest`` treat NaN as a value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values that must equal the reference's -------------------------
FEATURE_EPS = 1e-6          # denominator guard of the ratio features
TARGET_FLOOR = 1e-8         # post-processing floor of IC50 / CC50
INVERSE_FLOOR = 1e-9        # floor after expm1 in the stacking path
RATIO_EPS = 1e-9            # clip of IC50 / CC50 inside the SI ratio blend
GROUP_DECIMALS = 6          # rounding before duplicate grouping
SANITIZE_CLIP = 15.0        # clip of scaled features (notebook path)
BOUNDED_LOG_MAX = 50000.0   # upper bound of the bounded inverse, log targets
BOUNDED_LIN_MAX = 500.0     # upper bound of the bounded inverse, plain targets
# ---------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_null_if_not_finite(c: str | Column) -> Column:
    """NaN, +Inf, -Inf -> NULL; everything else cast to double."""
    x = col(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


def stable_hash(c: str | Column, seed: int) -> Column:
    """Order-free pseudo-random integer in [0, 2^32) from a key and a seed.

    Same value in DuckDB: ``('0x' || substr(md5(key::varchar || ':' || seed), 1, 8))::bigint``.
    """
    text = F.concat(col(c).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def safe_ratio(num: str | Column, den: str | Column, eps: float = FEATURE_EPS) -> Column:
    """num / (den + eps); NULL instead of an ANSI error when the sum is exactly 0."""
    return F.try_divide(col(num), col(den) + F.lit(eps))


def positive_flag(c: str | Column) -> Column:
    """1.0 when x > 0, else 0.0 (a missing value is 0.0, not missing)."""
    return F.when(col(c) > 0, F.lit(1.0)).otherwise(F.lit(0.0))


def log_target(y: str | Column, use_log: bool = True) -> Column:
    """Training space of a target: log1p(max(y, 0)) or identity."""
    y = col(y).cast("double")
    if not use_log:
        return y
    return F.when(y.isNotNull(), F.log1p(F.greatest(F.lit(0.0), y)))


def inverse_floored(p: str | Column, use_log: bool = True) -> Column:
    """max(expm1(p), 1e-9) for log targets, identity otherwise."""
    p = col(p)
    if not use_log:
        return p
    return F.when(p.isNotNull(), F.greatest(F.expm1(p), F.lit(INVERSE_FLOOR)))


def inverse_plain(p: str | Column, use_log: bool = True) -> Column:
    """expm1(p) without floor (baseline OOF and final models)."""
    return F.expm1(col(p)) if use_log else col(p)


def _finite_or_zero(p: Column) -> Column:
    return F.when(p.isNull() | F.isnan(p) | (F.abs(p) == F.lit(float("inf"))), F.lit(0.0)).otherwise(p)


def inverse_bounded(p: str | Column, use_log: bool = True) -> Column:
    """Notebook inverse: non-finite -> 0; log: clip to [-1, log1p(50000)], expm1, floor 1e-9;
    plain: clip to [0, 500]."""
    x = _finite_or_zero(col(p))
    if use_log:
        import math

        clipped = F.least(F.greatest(x, F.lit(-1.0)), F.lit(math.log1p(BOUNDED_LOG_MAX)))
        return F.greatest(F.expm1(clipped), F.lit(INVERSE_FLOOR))
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(BOUNDED_LIN_MAX))


def sanitize_scaled(c: str | Column) -> Column:
    """Non-finite -> 0, then clip to [-15, 15]."""
    x = _finite_or_zero(col(c))
    return F.least(F.greatest(x, F.lit(-SANITIZE_CLIP)), F.lit(SANITIZE_CLIP))


def floor_at(c: str | Column, floor: float) -> Column:
    """max(x, floor) that keeps NULL as NULL (greatest() would skip it)."""
    x = col(c)
    return F.when(x.isNotNull(), F.greatest(x, F.lit(floor)))


def ratio_blend(si: str | Column, ic: str | Column, cc: str | Column, w: float, eps: float = TARGET_FLOOR) -> Column:
    """w*SI + (1-w)*max(CC50, eps)/max(IC50, eps)."""
    ratio = floor_at(cc, eps) / floor_at(ic, eps)
    return F.lit(float(w)) * col(si) + F.lit(1.0 - float(w)) * ratio


def grouping_value(c: str | Column, decimals: int = GROUP_DECIMALS) -> Column:
    """Value used for duplicate grouping: non-finite -> 0, half-to-even rounding, -0.0 -> 0.0."""
    x = to_null_if_not_finite(c)
    return F.bround(F.coalesce(x, F.lit(0.0)), decimals) + F.lit(0.0)


def vector_key(cols: list[str], decimals: int = GROUP_DECIMALS) -> Column:
    """16-hex-digit key of the rounded feature vector (equal vectors share a key)."""
    parts = [grouping_value(c, decimals).cast("string") for c in cols]
    return F.substring(F.sha2(F.concat_ws(",", *parts), 256), 1, 16)


def rmse_expr(y: str | Column, p: str | Column) -> Column:
    """Aggregate expression sqrt(mean((y - p)^2))."""
    d = col(y) - col(p)
    return F.sqrt(F.avg(d * d))
