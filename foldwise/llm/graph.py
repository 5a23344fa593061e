"""Connected components, and groups handed to Python in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import checkpoint, give_back

#: members of a block of :func:`in_blocks`; a task holds two blocks
BLOCK = 1000


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node with an edge; ``edges`` has long columns a, b; component is the smallest id.

    Alternating large-star and small-star steps: every step links the neighbours
    of a node to the smallest of them, until nothing changes (about log n
    rounds).  The smallest neighbour comes from an aggregate and a join, so that
    a node with a third of all edges is combined before the shuffle and split
    by the skew join.  Each round is checkpointed; only a count and a checksum
    reach the driver.  An edge from a node to itself makes a component of one."""
    loops = edges.where("a = b").select(F.col("a").alias("id"), F.col("a").alias("component"))
    now = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    last = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            break
        last = state
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(low.select("u", F.col("m").alias("v"))))
        now = checkpoint(small.distinct())
    members = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return members.union(roots).union(loops).groupBy("id").agg(F.min("component").alias("component"))


def in_blocks(rows: DataFrame, key: str, member: str, block: int = BLOCK) -> DataFrame:
    """Deal the members of each key into blocks and repeat each row for every pair of blocks it belongs to.

    Adds ``bi <= bj`` (the pair of blocks) and ``b`` (the row's own block).  All
    pairs of a key's members meet in some (key, bi, bj), which holds about
    2 * ``block`` rows however large the key's group is."""
    sizes = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("nb"))
    dealt = rows.join(sizes, key).withColumn("b", F.pmod(F.xxhash64(F.lit(5), F.col(member)), F.col("nb")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda x: F.struct(
        F.least(F.col("b"), x).alias("bi"), F.greatest(F.col("b"), x).alias("bj")))
    return dealt.withColumn("pair", F.explode(pairs)).select("*", "pair.bi", "pair.bj").drop("pair", "nb")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many values each array of ``left`` shares with each of ``right`` (values are distinct inside an array): matrix products, columns in blocks."""
    both = np.zeros((len(left), len(right)), np.float32)
    if not left or not right:
        return both
    values = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in [*left, *right]])
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    column = column.reshape(-1)
    often = times[column] > 1
    row, column = row[often], (np.cumsum(times > 1) - 1)[column[often]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int((times > 1).sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        m = np.zeros((len(left) + len(right), width), np.float32)
        m[row[a:b], column[a:b] - start] = 1
        both += m[: len(left)] @ m[len(left):].T
    return both


def map_groups(rows: DataFrame, keys: Sequence[str], work: Callable[[pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """Hand each group of equal (integer) ``keys`` to ``work`` as one table.

    Like a grouped map, but small groups share the batches they travel in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held and (out := work(pa.Table.from_batches(held))) is not None:
                yield from out.to_batches()
            held.clear()

        last = None
        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(x).to_numpy(zero_copy_only=False) for x in keys], axis=1)
            cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(k)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if last is not None and not (k[start] == last).all():
                    yield from flush()
                last = k[start]
                held.append(b.slice(start, end - start))
        yield from flush()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda b: give_back(run(b)), schema)
