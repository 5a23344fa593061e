"""N-gram Jaccard join by MinHash banding.

Documents are sets of word n-grams (64-bit hashes).  A signature of bands x rows
minima is cut into bands; both numbers follow from the threshold and the target
recall.  Texts of equal words are one node (their smallest id).  Nodes are
shuffled on band hashes; each bucket's nodes are paired with its smallest node
(a linear number of pairs), the pairs are verified on the full n-gram sets, and
verified pairs form components.  What that leaves open is then settled exactly:

* nodes of one bucket that are still in different components are compared with
  each other, in blocks;
* nodes of one component are compared with each other, in blocks, to count links.

Blocks emit per-node counts and links between components, never all pairs of a
group.  Words are runs of characters other than ASCII white space, A-Z in lower
case; a text of fewer than n words has one n-gram, its words; a text without
words has none and links with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import bound_batches, byte_chunks, checkpoint, give_back
from foldwise.llm.graph import connected_components, in_blocks, map_groups

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 192
SEED = 90210
#: n-grams that are hashed together, which keeps them in the processor's cache
CHUNK = 1 << 16
#: bytes of text that one pass splits and hashes (an array of it takes eight times that)
TEXT_BYTES = 1 << 17
#: columns of a matrix product, and rows of a quotient, that are in memory at once
WIDTH, ROWS = 1024, 128


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, hence fewest false candidates, whose bands reach the recall at the threshold."""
    for rows in range(32, 0, -1):
        miss = 1 - threshold**rows
        bands = 1 if miss <= 0 else int(np.ceil(np.log(1 - recall) / np.log(miss)))
        if bands * rows <= max_hashes:
            return bands, rows
    raise ValueError("no band and row counts reach the recall")


_rng = np.random.Generator(np.random.Philox(key=SEED))
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]  # A-Z as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def ngram_hashes(texts: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all n-grams in text order, number of n-grams of each text, words' hash of each text) of a binary array."""
    ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]: ends[-1]]
    off = ends - ends[0]
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.uint64)
    word = ~_SPACE[data]
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    inner = off[(off > 0) & (off < len(data))]
    begins[inner] = word[inner]
    stops[inner - 1] = word[inner - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(stops)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), dtype=np.uint64, out=sums[1:])
    words = _mix((sums[last + 1] - sums[first]) * _powers(_INVERSE, len(data))[first] + (last - first).astype(np.uint64))
    upto = np.searchsorted(first, off)
    per_text = np.diff(upto)
    short = (per_text < n) & (per_text > 0)
    grams_of = np.where(per_text >= n, per_text - n + 1, short.astype(np.int64))
    starts = np.repeat(upto[:-1] - (np.cumsum(grams_of) - grams_of), grams_of) + np.arange(grams_of.sum())
    left = np.repeat(upto[1:], grams_of) - starts  # words from the n-gram's start to the text's end
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    grams = np.zeros(len(starts), np.uint64)
    for k in range(n):
        grams += np.where(left > k, padded[starts + k], np.uint64(0)) * _PLACE[k]
    order = np.arange(len(words)) - np.repeat(upto[:-1], per_text)
    chained = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _powers(_BASE, int(per_text.max()) + 1)[order], dtype=np.uint64, out=chained[1:])
    return _mix(grams), grams_of, _mix(chained[upto[1:]] - chained[upto[:-1]] + per_text.astype(np.uint64))


def signatures(grams: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts x bands, int64) of texts with at least one n-gram; rows of other texts are 0."""
    rng = np.random.Generator(np.random.Philox(key=SEED + 1))
    mul = rng.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    add = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
    low = (grams >> np.uint64(32)).astype(np.uint32)
    some = np.flatnonzero(counts)
    minima = np.zeros((bands * rows, len(some)), np.uint32)
    ends = np.cumsum(counts[some])
    start = 0
    while start < len(some):
        end = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + CHUNK, "right")))
        a = int(ends[start - 1]) if start else 0
        part = low[a: int(ends[end - 1])]
        cut = np.concatenate([[0], ends[start: end - 1] - a]).astype(np.int64)
        buf = np.empty_like(part)
        for j in range(bands * rows):
            np.multiply(part, mul[j], out=buf)
            np.add(buf, add[j], out=buf)
            minima[j, start:end] = np.minimum.reduceat(buf, cut)
        start = end
    out = np.zeros((len(counts), bands), np.int64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            h = np.full(len(some), np.uint64(b + 1))
            for r in range(rows):
                h = _mix(h * _BASE + minima[b * rows + r])
            out[some, b] = h.view(np.int64)
    return out


def sign_documents(docs: DataFrame, bands: int, rows: int, n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, digest, n_grams, bands) of every row; texts of equal words have equal digests (128 bits)."""
    raw = bound_batches(docs).select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(c.start, c.stop - c.start) for x in batches for c in byte_chunks(x.column("text"), TEXT_BYTES)):
            grams, counts, words = ngram_hashes(b.column("text"), n)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(grams, dtype=np.uint64)])
            upto = np.concatenate([[0], np.cumsum(counts)])
            both = np.stack([words, sums[upto[1:]] - sums[upto[:-1]]], axis=1)
            sig = signatures(grams, counts, bands, rows)
            yield pa.RecordBatch.from_arrays([
                b.column("id"), pa.array([x.tobytes() for x in both], pa.binary()), pa.array(counts),
                pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1) * bands, pa.int32()), pa.array(sig.ravel()))],
                names=["id", "digest", "n_grams", "bands"])

    return raw.mapInArrow(lambda b: give_back(run(b)), "id long, digest binary, n_grams long, bands array<long>")


def ngram_sets(docs: DataFrame, n: int) -> DataFrame:
    """(id, grams): sorted distinct n-gram hashes as bytes, of rows (id, text as binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(c.start, c.stop - c.start) for x in batches for c in byte_chunks(x.column("text"), TEXT_BYTES)):
            grams, counts, _ = ngram_hashes(b.column("text"), n)
            upto = np.concatenate([[0], np.cumsum(counts)])
            sets = [np.unique(grams[s:e]).tobytes() for s, e in zip(upto[:-1], upto[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sets, pa.binary())], names=["id", "grams"])

    return docs.mapInArrow(lambda b: give_back(run(b)), "id long, grams binary")


def _set(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted arrays of distinct hashes; empty sets are similar to nothing."""
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def similar_matrix(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of pairs at or over the threshold: shared n-grams are counted by matrix products, columns in blocks."""
    if not left or not right:  # a block may be empty
        return np.zeros((len(left), len(right)), bool)
    n_left, n_right = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    grams = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), np.concatenate([n_left, n_right]))
    _, column, times = np.unique(grams, return_inverse=True, return_counts=True)
    column = column.reshape(-1)
    shared = times[column] > 1
    number = np.cumsum(times > 1) - 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(left), len(right)), np.float32)
    total = int(times[times > 1].size)
    m = np.empty((len(left) + len(right), min(WIDTH, total)), np.float32)
    for start in range(0, total, WIDTH):
        a, b = np.searchsorted(column, [start, start + WIDTH])
        m[:] = 0
        m[row[a:b], column[a:b] - start] = 1
        both += m[: len(left)] @ m[len(left):].T
    hit = np.zeros(both.shape, bool)
    for start in range(0, len(left), ROWS):
        part = both[start: start + ROWS].astype(np.float64)
        union = n_left[start: start + ROWS, None] + n_right[None, :] - part
        hit[start: start + ROWS] = np.divide(part, union, out=np.zeros_like(part), where=union > 0) >= threshold
    return hit


def spanning_links(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, column) of a boolean matrix that connect the same rows and columns as all its pairs do, at most one per row and column."""
    rows_seen, columns_seen = np.zeros(hit.shape[0], bool), np.zeros(hit.shape[1], bool)
    out_i, out_j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start in np.flatnonzero(hit.any(axis=1)):
        if rows_seen[start]:
            continue
        front = np.array([start])
        rows_seen[start] = True
        while len(front):
            columns = np.flatnonzero(hit[front].any(axis=0) & ~columns_seen)
            columns_seen[columns] = True
            out_i.append(front[hit[np.ix_(front, columns)].argmax(axis=0)])
            out_j.append(columns)
            front = np.flatnonzero(hit[:, columns].any(axis=1) & ~rows_seen)
            rows_seen[front] = True
            out_i.append(front)
            out_j.append(columns[hit[np.ix_(front, columns)].argmax(axis=1)] if len(columns) else columns)
    return np.concatenate(out_i), np.concatenate(out_j)


def _sides(t: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows of the two blocks of a table of :func:`in_blocks`, and whether they are one block."""
    b = t["b"].to_numpy()
    bi, bj = t["bi"][0].as_py(), t["bj"][0].as_py()
    return np.flatnonzero(b == bi), np.flatnonzero(b == bj), bi == bj


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, n: int = N,
                 recall: float = RECALL, max_hashes: int = MAX_HASHES, count_links: bool = True) -> DataFrame:
    """(id, class_id, n_links, kept), one row per row of ``docs``.

    ``class_id`` is the smallest id reachable by links, ``n_links`` the number of
    other documents at or over the threshold (copies included), ``kept`` whether
    the row's id is the class id.  NULL ids link with nothing (class NULL, kept);
    rows that repeat an id count as one document, linked to whatever one of its
    texts links to; NULL and empty texts link with nothing; other columns are
    not read; an empty table gives an empty result.  Without ``count_links`` the
    links inside a class are not counted (``n_links`` is NULL); classes are the same."""
    bands, rows = choose_bands(threshold, recall, max_hashes)
    signed = checkpoint(sign_documents(docs, bands, rows, n, key, text))
    linkable = signed.where("id IS NOT NULL AND n_grams > 0")
    nodes = checkpoint(linkable.select("id", "digest").distinct().groupBy("digest").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")))
    of_node = linkable.join(nodes.select(F.col("node").alias("id"), "digest"), ["id", "digest"]).select("id", "digest", "bands")
    keyed = of_node.select(F.explode("bands").alias("bucket"), "id")
    hubs = keyed.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("top")).where("hub < top").select("bucket", "hub")
    buckets = checkpoint(keyed.join(hubs, "bucket").distinct())
    involved = buckets.select("id").distinct()
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))
    sets = checkpoint(ngram_sets(texts.join(involved, "id", "left_semi"), n).distinct())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [jaccard(_set(x), _set(y)) >= threshold for x, y in zip(b.column("ga"), b.column("gb"), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    stars = buckets.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    paired = (stars.join(sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
              .join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a"))
    linked = checkpoint(paired.mapInArrow(lambda b: give_back(verify(b)), "a long, b long").distinct())
    first = checkpoint(connected_components(linked))

    # nodes of one bucket in different components: every pair of them that no star has compared
    part = F.coalesce("component", "id")
    open_rows = buckets.where("id <> hub").join(first, "id", "left").select("bucket", "id", part.alias("part"))
    split = open_rows.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("bucket")
    unsettled = in_blocks(open_rows.join(split, "bucket", "left_semi"), "bucket", "id").join(sets, "id")

    def across(t: pa.Table) -> pa.Table | None:
        left, right, _ = _sides(t)
        ids, parts = t["id"].to_numpy(), t["part"].to_numpy()
        grams = [_set(x) for x in t["grams"]]
        hit = similar_matrix([grams[i] for i in left], [grams[i] for i in right], threshold)
        hit &= (parts[left][:, None] != parts[right][None, :])
        i, j = spanning_links(hit)
        a, b = ids[left[i]], ids[right[j]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)}) if len(a) else None

    crossing = checkpoint(map_groups(unsettled, ["bucket", "bi", "bj"], across, "a long, b long").distinct())
    if not count_links:
        final = connected_components(linked.union(crossing).union(_equal_ids(nodes, linkable)))
        return _classes(signed, linkable, nodes, final, None)
    joined = checkpoint(connected_components(linked.union(crossing)))

    # nodes of one component: links of each (every link lies in a component)
    weights = nodes.groupBy(F.col("node").alias("id")).agg(F.sum("copies").alias("copies"))
    inside = in_blocks(joined.join(weights, "id"), "component", "id").join(sets, "id")

    def count(t: pa.Table) -> pa.Table | None:
        left, right, same = _sides(t)
        ids, copies = t["id"].to_numpy(), t["copies"].to_numpy()
        grams = [_set(x) for x in t["grams"]]
        hit = similar_matrix([grams[i] for i in left], [grams[i] for i in right], threshold)
        hit &= ids[left][:, None] != ids[right][None, :]
        out_ids, out_n = [ids[left]], [hit @ copies[right]]
        if not same:
            out_ids.append(ids[right])
            out_n.append(hit.T @ copies[left])
        return pa.table({"id": np.concatenate(out_ids), "n": np.concatenate(out_n).astype(np.int64)})

    counted = map_groups(inside, ["component", "bi", "bj"], count, "id long, n long")
    links = counted.groupBy("id").agg(F.sum("n").alias("n"))
    stars = joined.where("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))
    final = connected_components(stars.union(_equal_ids(nodes, linkable)))
    return _classes(signed, linkable, nodes, final, links)


def _classes(signed: DataFrame, linkable: DataFrame, nodes: DataFrame, final: DataFrame, links: DataFrame | None) -> DataFrame:
    """The result's rows from the components of nodes and the links of each node (None: not counted)."""
    with_links = nodes.select("digest", F.col("node").alias("id"), "copies").join(final, "id", "left")
    with_links = with_links.join(links, "id", "left") if links is not None else with_links.withColumn("n", F.lit(0).cast("long"))
    labels = with_links.select("digest", F.coalesce("component", "id").alias("class_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    known = linkable.select("id", "digest").join(labels, "digest").groupBy("id").agg(
        F.min("class_id").alias("class_id"), F.max("n_links").alias("n_links"))
    out = signed.select("id").join(known, "id", "left")
    cls = F.coalesce("class_id", "id")
    n_links = F.coalesce("n_links", F.lit(0)).cast("long") if links is not None else F.lit(None).cast("long")
    return out.select("id", cls.alias("class_id"), n_links.alias("n_links"),
                      F.coalesce(cls == F.col("id"), F.lit(True)).alias("kept"))


def _equal_ids(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Edges between the nodes of ids that have several texts."""
    several = rows.groupBy("id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("id")
    found = rows.select("id", "digest").join(several, "id", "left_semi").join(nodes, "digest")
    low = found.groupBy("id").agg(F.min("node").alias("a"))
    return found.join(low, "id").where("a <> node").select("a", F.col("node").alias("b")).distinct()
