"""Output rounding shared by a Spark query and its SQL twin.

Floating sums differ between engines in the last bits (summation order), so
every floating output is rounded on both sides: to a fixed number of
decimals, or to a number of significant digits (scaled by an exact power of
ten so both engines perform the same IEEE operations)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sig(x: Column, digits: int = 9) -> Column:
    e = F.floor(F.log10(F.abs(x)))
    p = F.pow(F.lit(10.0), F.abs(e))
    up = F.round(x / p, digits - 1) * p
    down = F.round(x * p, digits - 1) / p
    return F.when(x.isNull() | (x == 0), x).when(e >= 0, up).otherwise(down)


def sql_sig(x: str, digits: int = 9) -> str:
    e = f"floor(log10(abs({x})))"
    p = f"pow(10.0, abs({e}))"
    return (
        f"(CASE WHEN ({x}) IS NULL OR ({x}) = 0 THEN ({x}) "
        f"WHEN {e} >= 0 THEN round(({x}) / {p}, {digits - 1}) * {p} "
        f"ELSE round(({x}) * {p}, {digits - 1}) / {p} END)"
    )
