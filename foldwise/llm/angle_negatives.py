"""Hard-negative mining by angular triangle filtering.

Components become integers, so scores are exact inner products.  Every row
stores its angles to a few reference directions.  The angle between an anchor
and a row lies between the difference and the sum of their angles to each
direction; the cosines of both ends, times the norms and widened for rounding,
bound the score from both sides.  Only pairs whose bounds overlap the window of
scores that can still matter are scored.

Rows are packed into blocks and dealt into lanes of bounded size; blocks of
anchors (a stated share of the rows) visit every lane.  In a lane an anchor
block keeps the best rows found so far, which narrows its windows, and leaves
with bounded lists, merged by a window function.

1. Positives: an anchor's best rows of its own label.
2. Negatives: for each positive the best rows of other labels whose score lies
   between two shares of the positive's score.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwise.llm.common import bound_batches, checkpoint

#: components are floor(SCALE * x)
SCALE = 256.0
POSITIVES = 5
NEGATIVES = 10
#: a negative's score lies between these shares of the positive's, in hundredths
LOW_SHARE, HIGH_SHARE = 30, 90
#: reference directions, and rows that they may be averaged from (any directions give the same result)
DIRECTIONS = 8
SAMPLE = 1024
#: rows of a block, anchors of a block, anchors that meet a block at once
BLOCK_ROWS = 4096
ANCHOR_ROWS = 1024
ANCHORS_AT_ONCE = 128
#: rows of a lane at most, on average, and lanes at least
LANE_ROWS = 1 << 18
MIN_LANES = 16
#: bound on inner products up to which sums of doubles are exact
EXACT = 2.0**53
#: relative and absolute widening of score bounds: beyond the rounding of angles, cosines and norms
SLACK, SLACK_ABS = 1e-6, 1.0
SEED = 1117

_PACKED = "uid long, n int, ids binary, labels binary, q binary, angles binary, norms binary"
_FIELDS = ("ids", "labels", "q", "angles", "norms")


def integer_components(v: np.ndarray, scale: float = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles, as whole doubles."""
    return np.floor(scale * v)


def angles_to(q: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(angles to the unit ``directions``, norms) of rows; a zero row has right angles and norm 0."""
    norms = np.linalg.norm(q, axis=1)
    cosines = q @ directions.T / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(cosines, -1.0, 1.0)), norms


def score_bounds(a_angles: np.ndarray, a_norms: np.ndarray, b_angles: np.ndarray, b_norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds on the inner products of all rows of a with all of b.

    cos(x + y) <= cosine <= cos(x - y) for the angles x and y to any direction."""
    ca, sa, cb, sb = np.cos(a_angles), np.sin(a_angles), np.cos(b_angles), np.sin(b_angles)
    low = np.full((len(a_norms), len(b_norms)), -1.0)
    high = np.ones_like(low)
    for k in range(ca.shape[1]):
        along, across = np.outer(ca[:, k], cb[:, k]), np.outer(sa[:, k], sb[:, k])
        np.maximum(low, along - across, out=low)
        np.minimum(high, along + across, out=high)
    size = np.outer(a_norms, b_norms)
    slack = SLACK * size + SLACK_ABS
    return low * size - slack, high * size + slack


def exact_scores(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, most: float) -> np.ndarray:
    """Integer inner products a[i] . b[j]; ``most`` bounds them in size."""
    out = np.empty(len(i), np.int64)
    for k in range(0, len(i), 1 << 14):
        x, y = a[i[k: k + (1 << 14)]], b[j[k: k + (1 << 14)]]
        if most < EXACT:
            out[k: k + len(x)] = np.einsum("ij,ij->i", x, y)
        else:  # sums beyond exact doubles: whole numbers of any size, held to the range of a long
            whole = [sum(int(u) * int(v) for u, v in zip(p, r, strict=True)) for p, r in zip(x, y, strict=True)]
            out[k: k + len(x)] = [max(min(w, 2**63 - 1), -(2**63)) for w in whole]
    return out


def best_per_key(key: np.ndarray, score: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Places of each key's ``keep`` highest scores, ties by smaller id, in the order (key, rank)."""
    order = np.lexsort((ids, -score, key))
    k = key[order]
    return order[np.arange(len(k)) - np.searchsorted(k, k) < keep]


def reference_directions(sample: np.ndarray, labels: np.ndarray, count: int = DIRECTIONS, seed: int = SEED) -> np.ndarray:
    """Unit directions: the means of the most frequent labels of a sample, filled up with random ones."""
    dims = sample.shape[1]
    found = []
    names, times = np.unique(labels, return_counts=True)
    for name in names[np.lexsort((names, -times))][:count]:
        mean = sample[labels == name].mean(axis=0)
        if np.linalg.norm(mean) > 0:
            found.append(mean)
    rng = np.random.Generator(np.random.Philox(key=[seed, dims]))
    found += list(rng.standard_normal((count - len(found), dims)))
    out = np.array(found)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _vectors(col: pa.Array, dims: int) -> np.ndarray:
    """Lists as rows of doubles, shorter ones filled with zeros."""
    sizes = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == dims).all():
        return flat.reshape(len(col), dims)
    out = np.zeros((len(col), dims))
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _pack(rows: DataFrame, dims: int, directions: np.ndarray, most_rows: int) -> DataFrame:
    """Blocks of at most ``most_rows`` rows of one partition each, with angles and norms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        uid, held, count = TaskContext.get().partitionId() << 32, [], 0

        def block(parts: list[tuple]) -> pa.RecordBatch:
            ids, labels, q = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(labels, kind="stable")
            ids, labels, q = ids[order], labels[order], q[order]
            angles, norms = angles_to(q, directions)
            arrays = dict(zip(_FIELDS, (ids, labels, q, angles, norms), strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array([uid], pa.int64()), pa.array([len(ids)], pa.int32()),
                 *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in arrays.values()]], names=["uid", "n", *arrays])

        for b in batches:
            at = 0
            while at < b.num_rows:
                part = b.slice(at, most_rows - count)
                at, count = at + part.num_rows, count + part.num_rows
                held.append((part["id"].to_numpy(), part["label"].to_numpy(), integer_components(_vectors(part["v"], dims))))
                if count == most_rows:
                    yield block(held)
                    uid, held, count = uid + 1, [], 0
        if held:
            yield block(held)

    return rows.mapInArrow(run, _PACKED)


def _unpack(b: pa.RecordBatch, i: int, prefix: str, dims: int) -> tuple[np.ndarray, ...]:
    ids, labels, q, angles, norms = (
        np.frombuffer(b[prefix + c][i].as_buffer(), np.int64 if c in ("ids", "labels") else np.float64) for c in _FIELDS)
    return ids, labels, q.reshape(-1, dims), angles.reshape(len(ids), -1), norms


def _visit(blocks: DataFrame, anchors: DataFrame, lanes: int, dims: int, keep: int, wanted: Callable, schema: str) -> DataFrame:
    """Every anchor block with every row block; per lane the ``keep`` best rows of each slot of each anchor.

    ``wanted(anchor rows, extra)`` gives (same, low, high): whether labels are to be
    equal, and per anchor and slot the window of scores (low > high: none)."""
    left = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns],
                          F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane")).hint("merge")
    right = blocks.withColumn("lane", F.pmod(F.xxhash64("uid"), F.lit(lanes)).cast("int"))
    pairs = left.join(right, "lane").drop("lane")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, anchor, state = None, None, None

        def out() -> pa.RecordBatch:
            key, score, ids = state
            slots = anchor[2].shape[1]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), now, np.int64)), pa.array((key // slots).astype(np.int32)), pa.array((key % slots).astype(np.int32)),
                 pa.array(anchor[0][0][key // slots]), pa.array(ids), pa.array(score)], names=["uid", "at", "slot", "anchor_id", "id", "score"])

        for b in batches:
            for i in range(b.num_rows):
                if b["a_uid"][i].as_py() != now:
                    if state is not None and len(state[0]):
                        yield out()
                    now = b["a_uid"][i].as_py()
                    rows = _unpack(b, i, "a_", dims)
                    same, low, high = wanted(rows, b, i)
                    anchor = (rows, same, low.copy(), high)
                    state = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
                state = _meet(anchor, _unpack(b, i, "", dims), state, keep)
        if state is not None and len(state[0]):
            yield out()

    return pairs.mapInArrow(run, schema)


def _meet(anchor: tuple, rows: tuple, state: tuple, keep: int) -> tuple:
    """The best rows so far of each (anchor, slot), after one more block; raises the windows' lower ends in place."""
    (a_ids, a_labels, a_q, a_angles, a_norms), same, low, high = anchor
    ids, labels, q, angles, norms = rows
    slots = low.shape[1]
    most = float(a_norms.max(initial=0.0) * norms.max(initial=0.0))
    first, last = np.where(low <= high, low, np.inf).min(axis=1), np.where(low <= high, high, -np.inf).max(axis=1)
    keys, scores, found = [state[0]], [state[1]], [state[2]]
    for k in range(0, len(a_ids), ANCHORS_AT_ONCE):
        part = np.arange(k, min(k + ANCHORS_AT_ONCE, len(a_ids)))
        # rows of a block are sorted by label: only the stretch of the anchors' labels can hold their own label
        begin, end = (np.searchsorted(labels, a_labels[part].min()), np.searchsorted(labels, a_labels[part].max(), "right")) if same else (0, len(ids))
        if begin == end:
            continue
        near = slice(begin, end)
        lower, upper = score_bounds(a_angles[part], a_norms[part], angles[near], norms[near])
        hit = (upper >= first[part, None]) & (lower <= last[part, None])  # windows that overlap
        hit &= (a_labels[part, None] == labels[near]) == same
        hit &= a_ids[part, None] != ids[near]
        i, j = np.nonzero(hit)
        i, j = part[i], j + begin
        s = exact_scores(a_q, q, i, j, most)
        for slot in range(slots):
            ok = (s >= low[i, slot]) & (s <= high[i, slot])
            key = i[ok] * slots + slot
            best = best_per_key(key, s[ok], ids[j[ok]], keep)
            keys.append(key[best])
            scores.append(s[ok][best])
            found.append(ids[j[ok]][best])
    key, score, who = np.concatenate(keys), np.concatenate(scores), np.concatenate(found)
    best = best_per_key(key, score, who, keep)
    key, score, who = key[best], score[best], who[best]
    full = np.flatnonzero(np.arange(len(key)) - np.searchsorted(key, key) == keep - 1)  # a lower score can no longer enter
    low[key[full] // slots, key[full] % slots] = score[full]
    return key, score, who


_OUT = "uid long, at int, slot int, anchor_id long, id long, score long"


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    order = W.partitionBy("uid", "at", "slot").orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def hard_negatives(vectors: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low_share: int = LOW_SHARE, high_share: int = HIGH_SHARE,
                   block_rows: int = BLOCK_ROWS, anchor_rows: int = ANCHOR_ROWS, lane_rows: int = LANE_ROWS,
                   directions: int = DIRECTIONS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank).

    An anchor's positives are its ``positives`` best other rows of its label; each
    positive's negatives are the ``negatives`` best rows of other labels with
    low_share * p <= 100 * n <= high_share * p.  Higher scores come first, ties by
    smaller id.  ``is_anchor`` is a column over the input.

    Rows with a NULL id, label or vector, and vectors with NULL or non-finite
    components, take no part; a shorter vector counts as filled with zeros, a
    zero or empty one scores 0 with every row.  Rows that repeat an id are rows of
    their own, but never positives or negatives of that id; equal anchors return
    equal rows.  Other columns are not read.  An empty table, or one without
    anchors, gives an empty result."""
    name = F.col(f"`{label}`") if isinstance(label, str) else label
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = bound_batches(vectors).select(F.col(f"`{key}`").cast("long").alias("id"), name.alias("label"), v.alias("v"), is_anchor.alias("anchor"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = dict(rows.dtypes)["label"] in ("tinyint", "smallint", "int", "bigint")
    rows = rows.withColumn("label", F.col("label").cast("long") if whole else F.xxhash64(F.col("label").cast("string")))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("v")).alias("dims")).first()
    dims = max(1, seen.dims or 0)
    few = rows.select("id", "label", "v").orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).collect()
    sample = np.zeros((len(few), dims))
    for i, r in enumerate(few):
        sample[i, : len(r.v)] = integer_components(np.array(r.v))
    units = reference_directions(sample, np.array([r.label for r in few], np.int64), directions)
    blocks = checkpoint(_pack(rows.select("id", "label", "v"), dims, units, block_rows))
    chosen = rows.where("anchor").select("id", "label", "v")
    anchors = checkpoint(_pack(chosen.repartition(max(1, math.ceil(seen.anchors / anchor_rows)), F.xxhash64("id", "v")), dims, units, anchor_rows))
    lanes = max(MIN_LANES, math.ceil(seen.n / lane_rows))

    def any_score(a: tuple, b: pa.RecordBatch, i: int) -> tuple:
        return True, np.full((len(a[0]), 1), -np.inf), np.full((len(a[0]), 1), np.inf)

    best = _ranked(_visit(blocks, anchors, lanes, dims, positives, any_score, _OUT), positives)
    best = checkpoint(best.select("uid", "at", F.col("rank").alias("pos"), "anchor_id", F.col("id").alias("positive_id"),
                                  F.col("score").alias("positive_score")))
    windows = best.groupBy("uid").agg(F.collect_list(F.struct("at", "pos", "positive_score")).alias("windows"))

    def window(a: tuple, b: pa.RecordBatch, i: int) -> tuple:
        low, high = np.full((len(a[0]), positives), np.inf), np.full((len(a[0]), positives), -np.inf)
        for w in b["a_windows"][i].as_py():
            p = w["positive_score"]
            low[w["at"], w["pos"] - 1], high[w["at"], w["pos"] - 1] = -((-low_share * p) // 100), high_share * p // 100
        return False, low, high

    # a block of anchors has a bounded number of windows
    asked = anchors.join(windows, "uid")
    near = _ranked(_visit(blocks, asked, lanes, dims, negatives, window, _OUT), negatives)
    near = near.select("uid", "at", (F.col("slot") + 1).alias("pos"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return best.join(near, ["uid", "at", "pos"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score",
        F.col("pos").cast("int").alias("positive_rank"))
