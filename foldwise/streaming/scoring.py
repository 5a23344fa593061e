"""Score a streaming DataFrame with a trained linear bundle.

Prediction is row-local: derive features, impute/scale and every base model
are linear in the augmented row vector, so all base predictions of a batch are
one matrix product, the meta model a column expression over them.  The plan has
no shuffle and no state, so it runs in append mode on any source
(files, Kafka) and each micro-batch scales with the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.exprs import inverse_plain
from foldwise.operators import blend
from foldwise.operators.oof import score_linear
from foldwise.plans.train import TrainResult, derive, postprocess


def score_stream(result: TrainResult, stream: DataFrame) -> DataFrame:
    cfg = result.cfg
    if result.final_trees or result.extra:
        raise ValueError("streaming scoring supports the linear candidates (trees need a batch transform)")
    df = derive(stream, cfg).select(cfg.id_col, *result.features)
    names, logs, outs = result.names, dict(cfg.targets), []
    # all linear scores of a row in one matrix product per Arrow batch, then columns over them
    scored, columns = score_linear(df, result.final_linear, result.features, result.centre, None)
    base = {pair: f"__base{i}" for i, pair in enumerate(columns)}
    scored = scored.select(cfg.id_col, *[inverse_plain(F.col(c), logs[t]).alias(base[t, m]) for (t, m), c in columns.items()])
    for t, _ in cfg.targets:
        if result.metas:
            meta = result.metas[t]
            outs.append(blend.linear_column(meta.final.beta, [base[t, n] for n in names], meta.centre).alias(t))
        else:
            w = result.weights[t]
            outs.append((sum(F.lit(float(w.get(n, 1.0))) * F.col(base[t, n]) for n in names) / F.lit(sum(w.get(n, 1.0) for n in names))).alias(t))
    return postprocess(scored.select(cfg.id_col, *outs), cfg, result.si_blend_w)
