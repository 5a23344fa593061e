"""Model registry (C24): nine named candidates in a fixed order.

Linear candidates are solved from Gram aggregates (see ``gram``); tree
candidates are grown on binned rows (see ``forests``) with the reference's
hyper-parameters: leaf-limited and depth-limited boosting with L2 on leaves, bags
of rows and features, early stopping by patience, bagged trees, extra-trees.
Random draws differ from other libraries', so values do too; interface,
hyper-parameters and stopping rules are kept.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from foldwise.operators.trees import TreeParams

# ---- fixed values: candidate names in registry order ----------------------
CANDIDATES = ("lgb", "xgb", "ridge", "elastic_net", "hist_gbrt", "random_forest",
              "extra_trees", "grad_boosting_sklearn", "bayesian_ridge")
LINEAR = ("ridge", "elastic_net", "bayesian_ridge")
ENET_L1_RATIOS = (0.1, 0.5, 0.9, 0.99)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TreeSpec:
    name: str
    params: TreeParams
    final_params: TreeParams | None = None   # of the final fit, if they differ
    final_stop_share: float | None = None    # rows of the final fit that decide when it stops (None: the hold-out's)
    description: str = ""


# ---- fixed values: rounds, rates, sizes, shares and patience of the presets
_PRESETS = {
    "lgb": TreeSpec("lgb", TreeParams("boost", trees=2000, rate=0.05, leaves=31, min_rows=20, l2=1.0, rows=0.9, columns=0.9, patience=80),
                    description="leaf-limited booster, early stop"),
    "xgb": TreeSpec("xgb", TreeParams("boost", trees=3000, rate=0.05, depth=6, l2=1.0, rows=0.9, columns=0.9, patience=80),
                    description="depth-6 booster, early stop"),
    "hist_gbrt": TreeSpec("hist_gbrt", TreeParams("boost", trees=200, rate=0.08, depth=7, leaves=31, min_rows=15, l2=1e-3),
                          TreeParams("boost", trees=400, rate=0.06, depth=7, leaves=31, min_rows=12, l2=1e-3, patience=25), 0.12,
                          description="histogram booster"),
    "random_forest": TreeSpec("random_forest", TreeParams("bag", trees=400, min_rows=2), description="bagged trees"),
    "extra_trees": TreeSpec("extra_trees", TreeParams("extra", trees=500, min_rows=2), description="trees on random thresholds"),
    "grad_boosting_sklearn": TreeSpec("grad_boosting_sklearn", TreeParams("boost", trees=180, rate=0.06, depth=4, min_rows=5, rows=0.9),
                                      TreeParams("boost", trees=250, rate=0.05, depth=4, min_rows=4, rows=0.9),
                                      description="classic booster"),
}
# ---------------------------------------------------------------------------

#: ``scale="small"`` (tests): so many rounds or trees at most
SMALL_TREES = 30


def registry(scale: str = "reference", include: tuple[str, ...] = CANDIDATES) -> list[str]:
    """Ordered, unique candidate names (``include`` filters, order kept)."""
    names = [n for n in CANDIDATES if n in include]
    assert len(set(names)) == len(names)
    return names


def tree_spec(name: str, scale: str = "reference") -> TreeSpec:
    spec = _PRESETS[name]
    if scale == "reference":
        return spec
    small = lambda p: p and replace(p, trees=min(p.trees, SMALL_TREES))
    return replace(spec, params=small(spec.params), final_params=small(spec.final_params))


def replace_params(spec: TreeSpec, overlay: dict) -> TreeSpec:
    """Same candidate, overridden parameters (of its final fit too)."""
    unknown = set(overlay) - {f.name for f in fields(TreeParams)}
    if unknown:
        raise ValueError(f"unknown tree parameters: {sorted(unknown)}")
    final = replace(spec.final_params, **overlay) if spec.final_params else None
    return replace(spec, params=replace(spec.params, **overlay), final_params=final)
