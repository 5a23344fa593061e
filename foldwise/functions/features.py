"""Domain features (ratio, sum, flag and product columns) from a declarative spec.

The spec names *roles*; a role map binds roles to the columns of the table at
hand, so the same spec runs on the reference's descriptor names or on any
other table.  A feature whose inputs are absent is skipped with a warning,
decided once per schema (not per row).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.exprs import positive_flag, safe_ratio

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class DerivedFeature:
    name: str
    kind: str                     # ratio | sum | flag | product
    inputs: tuple[tuple[str, ...], ...]  # per input: candidate roles, first present wins


# ---- fixed values: derived feature names and their inputs ----------------
DOMAIN_FEATURES: tuple[DerivedFeature, ...] = (
    DerivedFeature("LogP_TPSA", "ratio", (("MolLogP",), ("TPSA",))),
    DerivedFeature("Arom_Heavy_ratio", "ratio", (("NumAromaticRings", "fr_benzene"), ("HeavyAtomCount",))),
    DerivedFeature("Charge_sum", "sum", (("MaxPartialCharge",), ("MinPartialCharge",))),
    DerivedFeature("fr_imide_flag", "flag", (("fr_imide",),)),
    DerivedFeature("fr_sulfone_flag", "flag", (("fr_sulfone",),)),
    DerivedFeature("Ring_LogP", "product", (("RingCount",), ("MolLogP",))),
    DerivedFeature("FractionCSP3_LogP", "product", (("FractionCSP3",), ("MolLogP",))),
)
# ---------------------------------------------------------------------------


def _resolve(candidates: tuple[str, ...], roles: dict[str, str], columns: set[str]) -> str | None:
    for role in candidates:
        name = roles.get(role, role)
        if name in columns:
            return name
    return None


def domain_feature_columns(df: DataFrame, roles: dict[str, str] | None = None) -> dict[str, Column]:
    """Expressions of the derived columns whose inputs exist in ``df``."""
    roles = roles or {}
    columns = set(df.columns)
    out: dict[str, Column] = {}
    for feat in DOMAIN_FEATURES:
        names = [_resolve(c, roles, columns) for c in feat.inputs]
        if any(n is None for n in names):
            log.warning("%s: input columns missing, skipped", feat.name)
            continue
        a = F.col(names[0]).cast("double")
        if feat.kind == "ratio":
            out[feat.name] = safe_ratio(a, F.col(names[1]).cast("double"))
        elif feat.kind == "sum":
            out[feat.name] = a + F.col(names[1]).cast("double")
        elif feat.kind == "flag":
            out[feat.name] = positive_flag(a)
        elif feat.kind == "product":
            out[feat.name] = a * F.col(names[1]).cast("double")
        else:  # pragma: no cover - spec is fixed above
            raise ValueError(feat.kind)
    return out


def add_domain_features(df: DataFrame, roles: dict[str, str] | None = None) -> DataFrame:
    """One projection adding every derivable domain feature; existing columns untouched."""
    return df.withColumns(domain_feature_columns(df, roles))
