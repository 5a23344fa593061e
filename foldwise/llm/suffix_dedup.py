"""Exact substring deduplication with suffix arrays built by two-stage sorting.

A byte is removed if a string of ``width`` bytes covers it that also starts in a
row with a smaller id.  No machine holds the corpus, so equal strings are first
brought together:

1. Rows are dealt into blocks of bounded bytes by a hash.  The smallest hash of
   the k-grams inside a ``width``-byte window (its anchor) depends on the window
   alone, so equal windows have equal anchors; neighbouring windows with one
   anchor form a run, whose bytes are a segment.
2. Anchors (4 bytes each, distinct per block) are shuffled into buckets; those of
   one row only are dropped.  Most of the text leaves here.
3. Of the segments of the other anchors, hashes, smallest ids and places are
   shuffled by anchor, no bytes.  Segments that are equal to one of a smaller id
   go as a whole, in whatever block they lie.  Where all segments of an anchor are
   equal that is all; where they differ, the bytes of each different segment are
   asked for once.  Of an anchor with very many different ones they come as single
   windows, by the window's hash, so that no bucket grows with a common k-gram.
4. In each bucket a suffix array of the distinct segments is built: suffixes
   smaller than their successors are sorted directly, the others are induced by
   a scan over the buckets of first bytes; adjacent suffixes with a common prefix
   of ``width`` bytes form a class, and a window is removed if its class has a
   smaller id.
5. The removed stretches return to the blocks, where they are cut out.

Rows are compared as whole texts in UTF-8; the texts are shuffled once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.common import bound_batches, byte_chunks
from foldwise.llm.jaccard_join import _BASE, _INVERSE, _mix, _powers

WIDTH = 50
KGRAM = 20
#: bytes of text of a block, and rows
BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 8192
#: bytes of text whose windows are hashed together (their arrays take about fifty times that)
RUN_BYTES = 1 << 18
#: bytes of text of a batch that goes back to the JVM, about
OUT_BYTES = 1 << 20
#: segments of an anchor that are cut into single windows if there are more different ones than so many blocks' worth of so many
HOT_BLOCKS, BLOCK_SEGMENTS = 1000, 128
#: windows whose bytes are hashed together
WINDOWS = 1 << 14
#: hash buckets per block of text, and the number of buckets up to which there is one per block
BUCKET_BLOCKS = 4
MANY = 64
#: parts of a bucket's segments whose suffix arrays are built one after the other, which bounds memory
PARTS = 16
_BYTE = np.random.Generator(np.random.Philox(key=505)).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: bounds the segments: not a byte of UTF-8
END = 0xFF
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


# ------------------------------------------------------------- suffix array
def words8(text: np.ndarray) -> np.ndarray:
    """Eight bytes from every place as a big-endian number; past the end come zeros."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j: j + len(text)]
    return out


def _word_at(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.where(at < len(words), words[np.minimum(at, len(words) - 1)], np.uint64(0))


def sort_directly(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by the ``depth`` bytes from there: eight bytes at a time, ties go on."""
    order = places[np.argsort(words[places], kind="stable")]
    if not len(order):
        return order
    group = np.cumsum(np.concatenate([[0], words[order][1:] != words[order][:-1]]))
    for shift in range(8, depth, 8):
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        key, g = _word_at(words, order[tied] + shift), group[tied]
        again = np.lexsort((key, g))
        order[tied] = order[tied][again]
        key = key[again]
        new = np.ones(len(order), bool)
        new[1:] = group[1:] != group[:-1]
        inside = (tied[1:] == tied[:-1] + 1) & (g[1:] == g[:-1])
        new[tied[1:]] |= inside & (key[1:] != key[:-1])
        group = np.cumsum(new) - 1
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` (bytes, the last one END) sorted by at least ``depth`` bytes; places that agree so far are neighbours.

    Two stages: a suffix whose first byte is not larger than its second is sorted
    directly; a suffix whose first byte is larger follows the order of its
    successor, which lies in the bucket of a smaller byte, and is placed by
    scanning the finished buckets in order, before the directly sorted suffixes
    of its own bucket."""
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    after = np.concatenate([text[1:], [np.uint8(END)]])
    induced = text > after
    direct = sort_directly(words8(text), np.flatnonzero(~induced), depth)
    firsts = text[direct]
    cuts = np.searchsorted(firsts, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for byte in range(256):
        bucket = np.concatenate([*waiting[byte], direct[cuts[byte]: cuts[byte + 1]]])
        waiting[byte] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before]]
        heads = text[before]
        by_head = np.argsort(heads, kind="stable")
        before, heads = before[by_head], heads[by_head]
        if len(before):
            starts = np.flatnonzero(np.concatenate([[True], heads[1:] != heads[:-1]]))
            for s, e in zip(starts, [*starts[1:], len(before)], strict=True):
                waiting[heads[s]].append(before[s:e])
    return np.concatenate(out)


def common_prefix(words: np.ndarray, order: np.ndarray, width: int) -> np.ndarray:
    """Whether each place of ``order`` agrees with the one before in ``width`` bytes (``width`` >= 8)."""
    same = np.ones(len(order), bool)
    same[:1] = False
    for shift in sorted({*range(0, width - 7, 8), width - 8}):
        w = _word_at(words, order + shift)
        same[1:] &= w[1:] == w[:-1]
    return same


# ------------------------------------------------------------- anchors
def window_runs(data: np.ndarray, off: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor) of the runs of windows of texts data[off[i]:off[i+1]]."""
    n = len(data)
    none = np.empty(0, np.int64)
    if n < width:
        return none, none, np.empty(0, np.uint64)
    h = _BYTE[data]
    power, have, span = int(_BASE), 1, {1: h}  # hashes of 1, 2, 4, ... bytes by doubling, then k from their sum of powers
    while have * 2 <= k:
        h = span[have]
        span[2 * have] = h[:-have] * np.uint64(power) + h[have:]
        power, have = power * power % (1 << 64), have * 2
    grams, done = span[have], have
    while done < k:
        step = 1 << ((k - done).bit_length() - 1)
        tail = span[step][done:]
        m = min(len(grams), len(tail))
        factor = np.uint64(pow(int(_BASE), step, 1 << 64))
        grams = grams[:m] * factor + tail[:m]
        done += step
    del span, h
    low = _mix(grams)
    w, size = width - k + 1, 1
    while size * 2 <= w:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < w:
        low = np.minimum(low[: len(low) - (w - size)], low[w - size:])
    valid = np.zeros(n - width + 2, bool)  # one more, for the end of the last run
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        if b - a >= width:
            valid[a: b - width + 1] = True
    valid[-1] = False
    same = np.zeros(len(valid), bool)
    same[1:-1] = valid[1:-1] & valid[:-2] & (low[1:] == low[:-1])
    starts = np.flatnonzero(valid & ~same)
    # a run ends before the next start or the next place that is not valid
    ends = np.flatnonzero(valid[:-1] & ~same[1:]) + 1
    return starts, ends - starts, _mix(low[starts] + np.uint64(1))


def _texts(t: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(bytes, offsets, array) of column data."""
    col = t["data"].combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.binary())
    ends = np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, col.offset * 4).astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[ends[0]: ends[-1]] if len(col) else np.empty(0, np.uint8)
    return data, ends - ends[0], col


def _block(t: pa.Table) -> pa.Table:
    """Rows of a block in an order that every pass finds again; rows of NULL id last."""
    return t.sort_by([("id", "ascending"), ("k", "ascending")])


def _chunk_runs(t: pa.Table, width: int, k: int) -> Iterator[tuple]:
    """(chunk's first byte, bytes, first row, offsets, starts, windows, anchors) chunk by chunk; NULL ids have no run."""
    data, off, col = _texts(t)
    rows = len(t) - t["id"].null_count
    for c in byte_chunks(col.slice(0, rows), RUN_BYTES):
        a, b = off[c.start], off[c.stop]
        yield (a, data[a:b], c.start, off[c.start: c.stop + 1] - a, *window_runs(data[a:b], off[c.start: c.stop + 1] - a, width, k))


def _pack(**arrays: np.ndarray) -> bytes:
    """Arrays of one payload: lengths first, then the bytes."""
    parts = [np.ascontiguousarray(a).tobytes() for a in arrays.values()]
    return np.array([len(p) for p in parts], "<i8").tobytes() + b"".join(parts)


def _unpack(payload: memoryview, *kinds: str) -> list[np.ndarray]:
    lens = np.frombuffer(payload[: 8 * len(kinds)], "<i8")
    ends = 8 * len(kinds) + np.cumsum(lens)
    return [np.frombuffer(payload[e - n: e], kind) for e, n, kind in zip(ends.tolist(), lens.tolist(), kinds, strict=True)]


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    sorted_bucket = bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], sorted_bucket[1:] != sorted_bucket[:-1]]))
    for s, e in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(sorted_bucket[s]), order[s:e]


def _table(rows: list[tuple], names: list[str], kinds: list) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, cols, kinds, strict=True)})


# ------------------------------------------------------------- steps
def _anchors(t: pa.Table, width: int, k: int, buckets: int) -> pa.Table:
    """Step 2, map side: distinct anchors of the block, by bucket; several: found in more than one row of the block."""
    block, t = t["block"][0].as_py(), _block(t)
    ids = t["id"].to_numpy(zero_copy_only=False)
    all_a, all_id = [], []
    for _, _, row0, off, starts, _, anchor in _chunk_runs(t, width, k):
        all_a.append(anchor)
        all_id.append(ids[row0 + np.searchsorted(off, starts, "right") - 1].astype(np.int64))
    rows = []
    if all_a:
        a, who = np.concatenate(all_a), np.concatenate(all_id)
        order = np.argsort(a, kind="stable")  # rows are in the order of ids
        a, who = a[order], who[order]
        cut = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.empty(0, np.int64)
        last = np.concatenate([cut[1:], [len(a)]]).astype(np.int64) - 1
        several = who[cut] != who[last] if len(a) else np.empty(0, bool)
        one = a[cut]
        for b, at in _by_bucket((one % np.uint64(buckets)).astype(np.int64)):
            short = (one[at] >> np.uint64(32)).astype("<u4")
            rows.append((b, block, _pack(v=short, s=several[at])))
    return _table(rows, ["bucket", "block", "payload"], [pa.int32(), pa.int32(), pa.binary()])


def _shared(t: pa.Table) -> pa.Table:
    """Step 2, reduce side: anchors of the bucket found in two rows or more, back to their blocks."""
    bucket = t["bucket"][0].as_py()
    blocks = t["block"].to_numpy()
    got = [_unpack(memoryview(p.as_buffer()), "<u4", "?") for p in t["payload"]]
    v, several = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
    block = np.repeat(blocks, [len(g[0]) for g in got])
    _, at, times = np.unique(v, return_inverse=True, return_counts=True)
    at = at.reshape(-1)
    keep = (times[at] > 1) | (np.bincount(at, weights=several, minlength=len(times)) > 0)[at]
    v, block = v[keep], block[keep]
    rows = [(b, bucket, _pack(v=v[i])) for b, i in _by_bucket(block)]
    return _table(rows, ["block", "bucket", "payload"], [pa.int32(), pa.int32(), pa.binary()])


#: rows of steps 3 and 4: bytes or hashes of a bucket's segments (kind 0), stretches of a block that go (kind 1)
_PARTS_OF_BLOCKS = ["bucket", "block", "kind", "payload"], [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
_PARTS_SCHEMA = "bucket int, block int, kind int, payload binary"


def _planes(a: np.ndarray, kind: str) -> np.ndarray:
    """Numbers as first bytes, second bytes, ...: the many zeros stand together and leave in compression."""
    return np.ascontiguousarray(a, kind).view("u1").reshape(len(a), np.dtype(kind).itemsize).T


def _from_planes(a: np.ndarray, kind: str) -> np.ndarray:
    return np.ascontiguousarray(a.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel().astype(np.int64)


def _gone(block: int, start: np.ndarray, length: np.ndarray, off: np.ndarray) -> tuple:
    _, start, end = merged_spans(start, length, off)
    return 0, block, 1, _pack(s=start, n=end - start)


def _lowest(route: np.ndarray, content: np.ndarray, size: np.ndarray, who: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, head, later) of segments by route: of equal ones (head: the first) those of the smallest id come first, the others are later."""
    order = np.lexsort((start, who, size, content, route))
    route, content, size, who = route[order], content[order], size[order], who[order]
    new = np.ones(len(order), bool)
    new[1:] = (content[1:] != content[:-1]) | (route[1:] != route[:-1]) | (size[1:] != size[:-1])
    return order, new, who > who[new][np.cumsum(new) - 1]


def _hashes(t: pa.Table, found: pa.Table, width: int, k: int, buckets: int) -> pa.Table:
    """Step 3, map side: distinct segments of shared anchors by bucket, and the stretches that are already known to go."""
    if not len(t) or not len(found):
        return _table([], *_PARTS_OF_BLOCKS)
    block, t = t["block"][0].as_py(), _block(t)
    ids = t["id"].to_numpy(zero_copy_only=False)
    key = np.concatenate([(np.uint64(b) << np.uint64(32)) | _unpack(memoryview(p.as_buffer()), "<u4")[0].astype(np.uint64)
                          for b, p in zip(found["bucket"].to_pylist(), found["payload"], strict=True)])
    key.sort()
    start, size, route, content, who = [], [], [], [], []
    _, whole, _ = _texts(t)
    for a, chunk, row0, off, s, n, anchor in _chunk_runs(t, width, k):
        mine = ((anchor % np.uint64(buckets)) << np.uint64(32)) | (anchor >> np.uint64(32))
        hit = key[np.minimum(np.searchsorted(key, mine), len(key) - 1)] == mine
        s, length, mine = s[hit], n[hit] + width - 1, mine[hit]
        sums = np.zeros(len(chunk) + 1, np.uint64)
        np.cumsum(_BYTE[chunk] * _powers(_BASE, len(chunk)), dtype=np.uint64, out=sums[1:])
        h = _mix((sums[s + length] - sums[s]) * _powers(_INVERSE, len(chunk) + 1)[s])
        start.append(s + a)
        size.append(length)
        content.append(h ^ _mix(length.astype(np.uint64)))
        route.append(mine)
        who.append(ids[row0 + np.searchsorted(off, s, "right") - 1].astype(np.int64))
    start, size, route, content, who = map(np.concatenate, (start, size, route, content, who))
    order, head, later = _lowest(route, content, size, who, start)
    rows = [_gone(block, start[order[later]], size[order[later]], whole)]
    order, head = order[~later], head[~later]
    for b, at in _by_bucket((route[order] >> np.uint64(32)).astype(np.int64)):
        one = order[at[head[at]]]
        rows.append((b, block, 0, _pack(place=_planes(start[order[at]], "<u4"), head=head[at], v=route[one].astype("<u4"),
                                        content=content[one], size=_planes(size[one], "<u4"), who=_planes(who[one], "<i8"))))
    return _table(rows, *_PARTS_OF_BLOCKS)


def _asked(t: pa.Table, most: int) -> pa.Table:
    """Step 3, reduce side: back to the blocks, segments that go as a whole and those whose bytes must be compared.

    A segment goes if an equal one has a smaller id; what is left of an anchor is
    compared if there are different segments, window by window if more than ``most``."""
    bucket, rows, held = t["bucket"][0].as_py(), [], []
    for b, kind, p in zip(t["block"].to_pylist(), t["kind"].to_pylist(), t["payload"], strict=True):
        if kind:
            rows.append((bucket, b, 1, p.as_py()))
        else:
            held.append((b, *_unpack(memoryview(p.as_buffer()), "u1", "?", "<u4", "<u8", "u1", "u1")))
    if held:
        v, content = (np.concatenate([x[k] for x in held]) for k in (3, 4))
        size, who = (np.concatenate([_from_planes(x[k], kind) for x in held]) for k, kind in ((5, "<u4"), (6, "<i8")))
        order, head, later = _lowest(v, content, size, who, np.arange(len(v)))
        first = np.concatenate([[True], v[order[1:]] != v[order[:-1]]])
        different = np.add.reduceat(head.astype(np.int64), np.flatnonzero(first))[np.cumsum(first) - 1]
        gone, ask, hot = (np.empty(len(v), bool) for _ in range(3))
        gone[order], ask[order], hot[order] = later, ~later & (different > 1), different > most
        upto = 0
        for b, place, lead, *_ in held:
            place, at = _from_planes(place, "<u4"), upto + np.cumsum(lead) - 1
            mine = np.arange(upto, at[-1] + 1)
            upto = at[-1] + 1
            whole, rest, one = gone[at], ask[at], mine[ask[mine]]
            if whole.any() or len(one):
                rows.append((bucket, b, 0, _pack(s=_planes(place[whole], "<u4"), n=_planes(size[at[whole]], "<u4"), place=_planes(place[rest], "<u4"),
                                                 head=lead[rest], v=v[one], size=_planes(size[one], "<u4"), who=_planes(who[one], "<i8"), hot=hot[one])))
    return _table(rows, *_PARTS_OF_BLOCKS)


def window_hashes(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes from each place."""
    powers = _powers(_BASE, width)
    parts = [(_BYTE[data[starts[k: k + WINDOWS, None] + np.arange(width)]] * powers).sum(axis=1, dtype=np.uint64) for k in range(0, len(starts), WINDOWS)]
    return _mix(np.concatenate([np.empty(0, np.uint64), *parts]))


def _segments(t: pa.Table, asked: pa.Table, width: int, buckets: int) -> pa.Table:
    """Step 4, map side: the bytes that were asked for, by bucket, and the stretches that are known to go."""
    if not len(t) or not len(asked):
        return _table([], *_PARTS_OF_BLOCKS)
    block, t = t["block"][0].as_py(), _block(t)
    data, off, _ = _texts(t)
    none = np.empty(0, np.int64)
    rows, gone, windows = [], [(none, none)], [(none, none)]

    def send(b: int, place: np.ndarray, head: np.ndarray, size: np.ndarray, who: np.ndarray, part: np.ndarray) -> None:
        lead = place[head]  # one copy of the bytes for all places of an equal segment in one row
        cut = np.repeat(lead - (np.cumsum(size) - size), size) + np.arange(size.sum())
        rows.append((b, block, 0, _pack(place=place.astype("<i8"), head=head, size=size.astype("<i8"), who=who.astype("<i8"), part=part.astype(np.uint8), text=data[cut])))

    for b, kind, p in zip(asked["bucket"].to_pylist(), asked["kind"].to_pylist(), asked["payload"], strict=True):
        if kind:
            gone.append(tuple(_unpack(memoryview(p.as_buffer()), "<i8", "<i8")))
            continue
        s, n, place, head, v, size, who, hot = _unpack(memoryview(p.as_buffer()), "u1", "u1", "u1", "?", "<u4", "u1", "u1", "?")
        s, n, place, size, who = (_from_planes(x, kind) for x, kind in ((s, "<u4"), (n, "<u4"), (place, "<u4"), (size, "<u4"), (who, "<i8")))
        gone.append((s, n))
        at = np.cumsum(head) - 1
        cold, many = ~hot[at], size[at[hot[at]]] - width + 1
        if cold.any():
            send(b, place[cold], head[cold], size[~hot], who[~hot], v[~hot] % np.uint32(PARTS))
        windows.append((np.repeat(place[~cold] - (np.cumsum(many) - many), many) + np.arange(many.sum()), np.repeat(who[at[~cold]], many)))
    start, who = (np.concatenate(x) for x in zip(*windows, strict=True))
    h = window_hashes(data, start, width)
    order, head, later = _lowest(h, h, np.full(len(h), width), who, start)
    gone.append((start[order[later]], np.full(int(later.sum()), width)))
    order, head = order[~later], head[~later]
    for b, at in _by_bucket((h[order] % np.uint64(buckets)).astype(np.int64)):
        one = order[at[head[at]]]
        send(b, start[order[at]], head[at], np.full(len(one), width), who[one], h[one] // np.uint64(buckets) % np.uint64(PARTS))
    return _table([_gone(block, *(np.concatenate(x) for x in zip(*gone, strict=True)), off), *rows], *_PARTS_OF_BLOCKS)


def _repeats(t: pa.Table, width: int) -> pa.Table:
    """Step 4: suffix arrays of the bucket's segments; stretches to remove, by block."""
    rows, held = [], []
    for b, kind, p in zip(t["block"].to_pylist(), t["kind"].to_pylist(), t["payload"], strict=True):
        if kind:
            rows.append((b, p.as_py()))
        else:
            place, head, size, who, part, text = _unpack(memoryview(p.as_buffer()), "<i8", "?", "<i8", "<i8", "u1", "u1")
            held.append((b, place, np.cumsum(head) - 1, np.cumsum(size), size, who, part, text))
    for k in range(PARTS):
        rows += _repeats_of_part(held, k, width)
    return _table(rows, ["block", "payload"], [pa.int32(), pa.binary()])


def _repeats_of_part(held: list[tuple], k: int, width: int) -> list[tuple]:
    numbers: dict[bytes, int] = {}
    low: list[int] = []
    occurrences = []  # (block, segment, id, place)
    for b, place, at, ends, size, who, part, text in held:
        mine = np.flatnonzero(part == k)
        number = np.full(len(size), -1, np.int64)
        for i, e, n, w in zip(mine.tolist(), ends[mine].tolist(), size[mine].tolist(), who[mine].tolist(), strict=True):
            x = numbers.setdefault(text[e - n: e].tobytes(), len(numbers))
            if x == len(low):
                low.append(w)
            elif w < low[x]:
                low[x] = w
            number[i] = x
        here = number[at] >= 0
        occurrences.append((np.full(int(here.sum()), b), number[at[here]], who[at[here]], place[here]))
    if not numbers:
        return []
    segs = list(numbers)
    sizes = np.array([len(s) for s in segs], np.int64)
    end = bytes([END])
    text = np.frombuffer(end.join(segs) + end, np.uint8)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    order = suffix_array(text, width)
    seg_of = np.repeat(np.arange(len(segs)), sizes + 1)
    order = order[order + width <= (begin + sizes)[seg_of[order]]]  # places where a whole window follows
    same = common_prefix(words8(text), order, width)
    ids = np.array(low, np.int64)[seg_of[order]]
    cls = np.flatnonzero(~same)
    lowest = np.repeat(np.minimum.reduceat(ids, cls), np.diff(np.concatenate([cls, [len(order)]])))
    gone = np.zeros(len(text) + 1, bool)
    gone[order[lowest < ids]] = True
    first = np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1]]))
    last = np.flatnonzero(gone[:-1] & ~gone[1:])
    seg = seg_of[first]
    rel, length = first - begin[seg], last - first + width
    upto = np.searchsorted(seg, np.arange(len(segs) + 1))
    block, number, who, place = (np.concatenate(x) for x in zip(*occurrences, strict=True))
    whole = who > np.array(low, np.int64)[number]  # another block has the segment in a smaller id
    n = np.where(whole, 0, upto[number + 1] - upto[number])
    pick = np.repeat(upto[number] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    s = np.concatenate([place[whole], np.repeat(place, n) + rel[pick]])
    z = np.concatenate([sizes[number[whole]], length[pick]])
    b = np.concatenate([block[whole], np.repeat(block, n)])
    return [(x, _pack(s=s[i], n=z[i])) for x, i in _by_bucket(b)]


def merged_spans(start: np.ndarray, length: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the maximal stretches covered by the given ones, none of which leaves its row."""
    some = length > 0
    order = np.argsort(start[some], kind="stable")
    start, end = start[some][order], (start + length)[some][order]
    row = np.searchsorted(off, start, "right") - 1
    reach = np.maximum.accumulate(end) if len(end) else end
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] > reach[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]]).astype(np.int64)[: len(first)] - 1
    return row[first], start[first], reach[last]


def _cut(t: pa.Table, gone: pa.Table) -> pa.Table:
    """Step 5: texts of the block without the removed stretches."""
    t = _block(t)
    data, off, _ = _texts(t)
    parts = [_unpack(memoryview(p.as_buffer()), "<i8", "<i8") for p in gone["payload"]]
    start, length = (np.concatenate([np.empty(0, np.int64), *(p[k] for p in parts)]) for k in (0, 1))
    del parts
    row, start, end = merged_spans(start, length, off)
    before = np.concatenate([[0], np.cumsum(end - start)])  # bytes removed up to each stretch
    kept = np.empty(len(data) - int(before[-1]), np.uint8)
    at = 0
    for a, b in zip([0, *end.tolist()], [*start.tolist(), len(data)], strict=True):
        kept[at: at + b - a] = data[a:b]
        at += b - a
    ends = off - before[np.searchsorted(row, np.arange(len(off)))]
    kept_col = pa.Array.from_buffers(pa.binary(), len(t), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(kept)])
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(row, np.arange(len(t) + 1)), pa.int32()),
        pa.StructArray.from_arrays([pa.array(start - off[row]), pa.array(end - start)], fields=list(SPANS.value_type)))
    out = pa.table([t["rec"], t["id"], kept_col, spans], names=["rec", "id", "kept", "spans"])
    rows = max(1, len(t) * OUT_BYTES // max(1, len(kept)))
    return pa.Table.from_batches(out.to_batches(max_chunksize=rows), out.schema)


def suffix_dedup(docs: DataFrame, keep: list[Column], key: str = "doc_id", text: str = "text", width: int = WIDTH,
                 kgram: int = KGRAM, block_bytes: int = BLOCK_BYTES, hot_blocks: int = HOT_BLOCKS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rec`` (struct of ``keep``), ``id``, ``kept`` (remaining bytes) and ``spans`` (removed stretches of the
    text's bytes: start, length), one row per row.

    NULL texts are empty; texts shorter than ``width`` lose nothing; a row of NULL
    id is neither searched nor cut; rows that share an id never remove bytes of
    each other; columns outside ``keep`` are not read; an empty table gives an
    empty result."""
    if not 8 <= kgram <= width:
        raise ValueError("a k-gram has 8 bytes or more and fits in a window")
    raw = bound_batches(docs).select(F.struct(*keep).alias("rec"), F.col(f"`{key}`").cast("long").alias("id"),
                      F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("data"))
    total, n = raw.agg(F.sum(F.octet_length("data")), F.count(F.lit(1))).first()
    blocks = max(1, math.ceil((total or 0) / block_bytes), math.ceil(n / block_rows))
    buckets = max(math.ceil(blocks / BUCKET_BLOCKS), min(blocks, MANY))
    rows = raw.select(F.pmod(F.xxhash64(F.lit(3), "id", "data"), F.lit(blocks)).cast("int").alias("block"),
                      "id", F.xxhash64("data").alias("k"), "rec", "data")
    by_block = rows.groupBy("block")
    anchors = by_block.applyInArrow(lambda t: _anchors(t, width, kgram, buckets), "bucket int, block int, payload binary")
    shared = anchors.groupBy("bucket").applyInArrow(_shared, "block int, bucket int, payload binary")
    hashes = by_block.cogroup(shared.groupBy("block")).applyInArrow(lambda t, found: _hashes(t, found, width, kgram, buckets), _PARTS_SCHEMA)
    asked = hashes.groupBy("bucket").applyInArrow(lambda t: _asked(t, hot_blocks * BLOCK_SEGMENTS), _PARTS_SCHEMA)
    segments = by_block.cogroup(asked.groupBy("block")).applyInArrow(lambda t, wanted: _segments(t, wanted, width, buckets), _PARTS_SCHEMA)
    gone = segments.groupBy("bucket").applyInArrow(lambda t: _repeats(t, width), "block int, payload binary")
    out = T.StructType([T.StructField("rec", rows.schema["rec"].dataType), T.StructField("id", T.LongType()),
                        T.StructField("kept", T.BinaryType()),
                        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])))])
    return by_block.cogroup(gone.groupBy("block")).applyInArrow(_cut, out)
