"""Embedding near-duplicates by spherical-cap filters.

The filter directions are a random product code: the (randomly rotated) space is
cut into blocks, each block has a few random unit codewords, and every
combination of one codeword per block is a direction.  A unit vector belongs to
all directions whose inner product with it reaches ``alpha``; they are found by
list decoding, extending codeword by codeword and dropping what the best rest
cannot lift over the threshold.  A vector with fewer than ``least`` such
directions takes its ``least`` best.  Vectors meet in the buckets of their
directions and label and are compared there by cosine in double precision.

A pair that meets in several buckets is counted in the first of their common
directions only, so buckets emit counts and a spanning forest of their links,
never all links.  Buckets are cut into blocks of bounded size.  Equal vectors of
a label are one node.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import checkpoint
from foldwise.llm.graph import connected_components, in_blocks, map_groups, shared_counts

MIN_COSINE = 0.98
BLOCKS = 3
#: directions that a vector is in on average, and at least
WANT = 32
LEAST = 24
#: vectors per bucket, over all labels, that the number of codewords aims at
BUCKET = 500
MIN_CODEWORDS = 8
SEED = 1601
#: vectors decoded together
CHUNK = 2048


def choose_codewords(n: int, blocks: int = BLOCKS, want: int = WANT, bucket: int = BUCKET) -> int:
    """Codewords per block so that the buckets of n vectors stay about as large at every n."""
    return max(MIN_CODEWORDS, int(np.ceil((n * want / bucket) ** (1 / blocks))))


def choose_alpha(dims: int, codewords: int, blocks: int = BLOCKS, want: int = WANT) -> float:
    """Threshold that a random vector reaches for ``want`` directions on average."""
    share = min(0.5, want / codewords ** min(blocks, dims))
    return NormalDist().inv_cdf(1 - share) / np.sqrt(dims) if share < 0.5 else 0.0


@cache
def product_code(dims: int, blocks: int, codewords: int, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rotation, unit codewords of each block)."""
    rng = np.random.Generator(np.random.Philox(key=[seed, dims]))
    rotation, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    words = [rng.standard_normal((codewords, len(part))) for part in np.array_split(np.arange(dims), min(blocks, dims))]
    return rotation, [w / np.linalg.norm(w, axis=1, keepdims=True) for w in words]


def decode_list(unit: np.ndarray, codewords: int = MIN_CODEWORDS, blocks: int = BLOCKS, want: int = WANT,
                least: int = LEAST, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(row, direction) of every direction that reaches the threshold, at least ``least`` per row, sorted by row and direction."""
    rotation, words = product_code(unit.shape[1], blocks, codewords, seed)
    turned = unit @ rotation
    ends = np.cumsum([w.shape[1] for w in words])
    scores = [turned[:, e - w.shape[1]: e] @ w.T for w, e in zip(words, ends, strict=True)]
    rest = np.zeros((len(unit), len(words) + 1))
    for k in range(len(words) - 1, -1, -1):
        rest[:, k] = rest[:, k + 1] + scores[k].max(axis=1)

    def decode(rows: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, code, total = rows, np.zeros(len(rows), np.int64), np.zeros(len(rows))
        for k, s in enumerate(scores):
            m = s.shape[1]
            total = (total[:, None] + s[at]).ravel()
            code = (code[:, None] * m + np.arange(m)).ravel()
            at = np.repeat(at, m)
            live = total + rest[at, k + 1] >= need[at]
            at, code, total = at[live], code[live], total[live]
        return at, code, total

    least = min(least, int(np.prod([len(w) for w in words])))
    alpha = choose_alpha(unit.shape[1], codewords, blocks, want) * np.sqrt(len(words))
    at, code, _ = decode(np.arange(len(unit)), np.full(len(unit), alpha))
    few, step = np.flatnonzero(np.bincount(at, minlength=len(unit)) < least), 1
    while len(few):  # lower the threshold of the rows with too few, then keep their best
        more, codes, total = decode(few, np.full(len(unit), alpha - 0.15 * step * (abs(alpha) + 0.05)))
        enough = np.bincount(more, minlength=len(unit))[few] >= least
        done, few, step = few[enough], few[~enough], 2 * step
        order = np.lexsort((codes, -total, more))
        more, codes = more[order], codes[order]
        best = np.isin(more, done) & (np.arange(len(more)) - np.searchsorted(more, more) < least)
        keep = ~np.isin(at, done)
        at, code = np.concatenate([at[keep], more[best]]), np.concatenate([code[keep], codes[best]])
    order = np.lexsort((code, at))
    return at[order], code[order]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(v: np.ndarray) -> np.ndarray:
    scale = np.abs(v).max(axis=1, keepdims=True)
    v = v / scale
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the given edges."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            up[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 min_cosine: float = MIN_COSINE, blocks: int = BLOCKS, want: int = WANT,
                 least: int = LEAST, seed: int = SEED) -> DataFrame:
    """(id, n_links, component_id, kept), one row per row.

    ``n_links`` counts other rows of the same label with cosine at or over
    ``min_cosine``; ``component_id`` is the smallest id reachable by links.  Rows
    with a NULL label or id, and vectors that are NULL, empty, zero or hold NULL
    or non-finite components, link with nothing; vectors of different lengths
    are never compared; rows that repeat an id are vectors of their own that
    share a component; other columns are not read; an empty table gives an empty
    result."""
    v = F.col("v")
    kind = "float" if vectors.select(f"`{vector}`").dtypes[0][1] == "array<float>" else "double"
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast(f"array<{kind}>").alias("v"),
                          F.col(f"`{label}`").cast("string").alias("label"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = (F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()
              & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    good = rows.where(usable).select("id", "label", F.transform(v, lambda x: x + F.lit(0.0).cast(kind)).alias("v"))
    # equal vectors of a label: one node, with its smallest id and number of rows; the class is keyed by a 128-bit digest
    good = good.select("id", F.md5(F.concat_ws("|", "label", F.array_join(F.transform("v", lambda x: x.cast("string")), ","))
                                   .cast("binary")).alias("cls"), "label", "v")
    classes = good.groupBy("cls").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"))
    members = checkpoint(good.select("id", "cls"))
    nodes = checkpoint(good.join(classes.withColumnRenamed("low", "id"), ["cls", "id"]).dropDuplicates(["cls"])
                       .select(F.xxhash64("cls").alias("node"), "cls", "copies", "v",
                               F.xxhash64("label", F.size("v")).alias("space")))

    codewords = choose_codewords(nodes.count(), blocks, want)

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = np.diff(b.column("v").offsets.to_numpy())
            out: list[list[int]] = [[]] * b.num_rows
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                for k in range(0, len(at), CHUNK):
                    part = at[k: k + CHUNK]
                    row, code = decode_list(_unit(_matrix(b.column("v").take(pa.array(part)))), codewords, blocks, want, least, seed)
                    for i, codes in zip(part, np.split(code, np.searchsorted(row, np.arange(1, len(part)))), strict=True):
                        out[i] = codes.tolist()
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("space"), pa.array(out, pa.list_(pa.int32()))],
                                             names=["node", "space", "filters"])

    listed = checkpoint(nodes.select("node", "space", "v").mapInArrow(filters, "node long, space long, filters array<int>"))
    buckets = listed.select("node", F.explode("filters").alias("f"), "space").select(
        F.xxhash64("space", "f").alias("bucket"), "f", "node", "space")
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("bucket")
    packed = nodes.select("node", "copies", "v").join(listed.select("node", "filters"), "node")
    meet = in_blocks(buckets.join(shared, "bucket", "left_semi"), "bucket", "node").join(packed, "node")

    def compare(t: pa.Table) -> pa.Table | None:
        b, bi, bj = t["b"].to_numpy(), t["bi"][0].as_py(), t["bj"][0].as_py()
        left, right = np.flatnonzero(b == bi), np.flatnonzero(b == bj)
        unit = _unit(_matrix(t["v"]))
        node, copies, here = t["node"].to_numpy(), t["copies"].to_numpy(), t["f"][0].as_py()
        hit = unit[left] @ unit[right].T >= min_cosine
        hit &= node[left][:, None] < node[right][None, :] if bi == bj else node[left][:, None] != node[right][None, :]
        if not hit.any():
            return None
        lists = t["filters"].combine_chunks()
        flat, off = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        earlier = [flat[s:e][flat[s:e] < here] for s, e in zip(off[:-1], off[1:], strict=True)]
        # a pair counts in the first of its common directions: those that share an earlier one are left out
        rows, columns = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
        again = shared_counts([earlier[x] for x in left[rows]], [earlier[x] for x in right[columns]]) > 0
        hit[np.ix_(rows, columns)] &= ~again
        i, j = np.nonzero(hit)
        i, j = left[i], right[j]
        if not len(i):
            return None
        ids = np.concatenate([node[i], node[j]])
        n = np.concatenate([copies[j], copies[i]])
        who, at = np.unique(ids, return_inverse=True)
        edges = forest(node[i], node[j])
        return pa.table({"a": np.concatenate([who, [x for x, _ in edges]]).astype(np.int64),
                         "b": pa.array([None] * len(who) + [y for _, y in edges], pa.int64()),
                         "n": pa.array(np.bincount(at, weights=n).astype(np.int64).tolist() + [None] * len(edges), pa.int64())})

    found = checkpoint(map_groups(meet, ["bucket", "bi", "bj"], compare, "a long, b long, n long"))
    links = found.where("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    edges = found.where("b IS NOT NULL").select("a", "b")
    # vectors that share an id share a component: edges between their nodes
    several = members.groupBy("id").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("id")
    places = members.join(several, "id", "left_semi").distinct().join(nodes.select("cls", "node"), "cls")
    same_id = places.join(places.groupBy("id").agg(F.min("node").alias("a")), "id").where("a <> node").select("a", F.col("node").alias("b")).distinct()
    reached = connected_components(edges.union(same_id))
    by_class = (nodes.select("node", "cls", "copies").join(reached.withColumnRenamed("id", "node"), "node", "left")
                .join(links, "node", "left")
                .select("cls", F.coalesce("component", "node").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    ids = members.join(by_class, "cls")
    # components in terms of ids; rows that repeat an id tie components together
    smallest = ids.groupBy("component").agg(F.min("id").alias("component_id"))
    out = ids.join(smallest, "component").select("id", "n_links", "component_id")
    rest = rows.where(~F.coalesce(usable, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.union(rest).select("id", F.col("n_links").cast("long"), "component_id",
                                  F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
