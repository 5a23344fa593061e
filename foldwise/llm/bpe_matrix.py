"""Byte-level BPE encoding and decoding with length-bucketed padded matrices.

The distinct pieces (matches of the split pattern) of a batch are laid out by
length in matrices of token ids, one row per piece.  In each round every
unfinished row merges its leftmost pair of minimum rank: ranks of all adjacent
pairs come from one hashed lookup, the merged place is dropped by shifting the
rest of the row left (compaction), and finished rows leave the matrix.  A piece
that is itself a token is not merged.  Pieces beyond ``LONG_BYTES`` take the same
merges in the same order from a heap, since a padded row costs its length in
every round.

Ranks come from a file read once per task; a Python worker keeps nothing of them
afterwards, since later tasks of other kinds use it again.  Each row's text is
encoded whole; nothing is shuffled.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.common import bound_batches, byte_chunks, give_back

LONG_BYTES = 512
#: distinct pieces that a task remembers
PIECES_KEPT = 100_000
#: bytes of the texts that are split and merged together, which bounds memory
CHUNK_BYTES = 1 << 18
_NONE = np.int32(np.iinfo(np.int32).max)


class Ranks:
    """Token bytes and merge ranks; pair (left id, right id) -> merged id by open addressing."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for t, r in ranks.items():
            tokens[r] = t
        self.tokens = tokens
        self.bytes_id = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        left, right, to = [], [], []
        for t, r in ranks.items():
            for cut in range(1, len(t)):
                a, b = ranks.get(t[:cut]), ranks.get(t[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    to.append(r)
        key = np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64)
        self.mask = np.uint64((1 << (max(4, len(key) * 4 - 1)).bit_length()) - 1)
        self.keys = np.full(int(self.mask) + 1, np.uint64(2**64 - 1))
        self.values = np.full(int(self.mask) + 1, _NONE)
        todo, at = np.arange(len(key)), self._slot(key)
        self.probes = 0
        while len(todo):  # rows that find their slot free and come first in it settle, the rest step on
            self.probes += 1
            free = self.keys[at] == np.uint64(2**64 - 1)
            _, first = np.unique(at, return_index=True)
            settle = np.zeros(len(todo), bool)
            settle[first] = True
            settle &= free
            self.keys[at[settle]] = key[todo[settle]]
            self.values[at[settle]] = np.array(to, np.int32)[todo[settle]]
            todo, at = todo[~settle], (at[~settle] + np.uint64(1)) & self.mask
        lens = np.array([len(t) for t in tokens], dtype=np.int64)
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.start, self.lens = np.cumsum(lens) - lens, lens

    def _slot(self, key: np.ndarray) -> np.ndarray:
        x = key * np.uint64(0x9E3779B97F4A7C15)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of left + right, or the largest int32 where there is no such token."""
        key = (left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)).ravel()
        at = self._slot(key)
        out = np.where(self.keys[at] == key, self.values[at], _NONE)
        todo = np.flatnonzero((self.keys[at] != key) & (self.keys[at] != np.uint64(2**64 - 1)))
        for _ in range(self.probes):
            if not len(todo):
                break
            at[todo] = (at[todo] + np.uint64(1)) & self.mask
            there = self.keys[at[todo]]
            hit = there == key[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (there != np.uint64(2**64 - 1))]
        return out.reshape(left.shape)


def load_ranks(path: str) -> Ranks:
    with open(path, "rb") as f:
        return Ranks({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})


def merge_matrix(ids: np.ndarray, ranks: Ranks) -> list[np.ndarray]:
    """Token ids of each row of equal length: all rows merge their leftmost minimum pair, round by round."""
    out: list[np.ndarray] = [None] * len(ids)  # type: ignore[list-item]
    row, m = np.arange(len(ids)), ids
    pair = ranks.merged(m[:, :-1], m[:, 1:]) if m.shape[1] > 1 else np.empty((len(m), 0), np.int32)
    while len(row):
        width = m.shape[1]
        best = pair.argmin(axis=1) if width > 1 else np.zeros(len(row), np.int64)
        rank = pair[np.arange(len(row)), best] if width > 1 else np.full(len(row), _NONE)
        done = rank == _NONE
        if done.any():
            for r, v in zip(row[done].tolist(), m[done], strict=True):
                out[r] = v
            row, m, pair, best, rank = row[~done], m[~done], pair[~done], best[~done], rank[~done]
            if not len(row):
                break
        # compaction: places after the merged one move left by one
        at = np.arange(width - 1)
        m = np.take_along_axis(m, at + (at > best[:, None]), axis=1)
        here = np.arange(len(row))
        m[here, best] = rank
        if width == 2:
            pair = np.empty((len(m), 0), np.int32)
            continue
        at = np.arange(width - 2)
        pair = np.take_along_axis(pair, at + (at >= best[:, None]), axis=1)
        left, right = np.flatnonzero(best > 0), np.flatnonzero(best < width - 2)
        pair[left, best[left] - 1] = ranks.merged(m[left, best[left] - 1], m[left, best[left]])
        pair[right, best[right]] = ranks.merged(m[right, best[right]], m[right, best[right] + 1])
    return out


def merge_long(piece: bytes, ranks: Ranks) -> np.ndarray:
    """The same merges for one long piece: a heap of (rank, place) over a linked list."""
    get, tokens = ranks.ranks.get, ranks.tokens
    ids = ranks.bytes_id[np.frombuffer(piece, np.uint8)].tolist()
    n = len(ids)
    prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i) for i in range(n - 1) if (r := get(tokens[ids[i]] + tokens[ids[i + 1]])) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        j = nxt[i]
        if ids[i] < 0 or j >= n or get(tokens[ids[i]] + tokens[ids[j]]) != r:
            continue  # this pair is gone
        ids[i], ids[j] = r, -1
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
        for a in (prev[i], i):
            if a >= 0 and nxt[a] < n and (x := get(tokens[ids[a]] + tokens[ids[nxt[a]]])) is not None:
                heapq.heappush(heap, (x, a))
    return np.array([x for x in ids if x >= 0], dtype=np.int32)


def encode_pieces(pieces: list[bytes], ranks: Ranks) -> list[np.ndarray]:
    """Token ids of each piece."""
    out: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
    by_length: dict[int, list[int]] = {}
    for i, p in enumerate(pieces):
        whole = ranks.ranks.get(p)
        if whole is not None:
            out[i] = np.array([whole], np.int32)
        elif len(p) > LONG_BYTES:
            out[i] = merge_long(p, ranks)
        else:
            by_length.setdefault(len(p), []).append(i)
    for width, rows in by_length.items():
        step = max(1, (1 << 20) // width)
        for k in range(0, len(rows), step):
            part = rows[k: k + step]
            ids = ranks.bytes_id[np.frombuffer(b"".join([pieces[i] for i in part]), np.uint8)].reshape(len(part), width)
            for i, v in zip(part, merge_matrix(ids, ranks), strict=True):
                out[i] = v
    return out


def _ragged(flat: np.ndarray, start: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """flat[start[i] : start[i] + lens[i]] for all i, end to end."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start - (ends - lens), lens) + np.arange(total)]


class _Numbers(dict):
    """Numbers keys in the order of their first look-up."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class Pieces:
    """Numbers of the distinct pieces met so far and their tokens, laid end to end.

    It starts anew once it holds ``most`` pieces, so that its size does not
    follow the input; what it holds never changes a result."""

    def __init__(self, ranks: Ranks, most: int = PIECES_KEPT):
        self.ranks, self.most = ranks, most
        self.clear()

    def clear(self) -> None:
        self.number = _Numbers()
        self.flat, self.start, self.lens = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def learn_new(self) -> None:
        """Encode the pieces numbered since the last call."""
        new = list(islice(self.number, len(self.lens), None))
        if not new:
            return
        tokens = encode_pieces([p.encode() for p in new], self.ranks)
        lens = np.array([len(t) for t in tokens], np.int64)
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.flat = np.concatenate([self.flat, *tokens]).astype(np.uint32)


def encode_texts(texts: list[str], split: regex.Pattern, known: Pieces) -> list[np.ndarray]:
    """Token ids (uint32) of each text."""
    if len(known.number) > known.most:
        known.clear()
    number = known.number
    which = []
    for t in texts:
        found = split.findall(t)
        which.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
    known.learn_new()
    per_text = [len(w) for w in which]
    at = np.concatenate([*which, np.empty(0, np.int64)])
    lens = known.lens[at]
    ids = _ragged(known.flat, known.start[at], lens)
    piece_ends = np.concatenate([[0], np.cumsum(lens)])
    bounds = piece_ends[np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)]
    return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def decode_ids(ids: np.ndarray, ranks: Ranks) -> bytes:
    """Bytes of a list of token ids."""
    if not len(ids):
        return b""
    at = ids.astype(np.int64)
    return _ragged(ranks.flat, ranks.start[at], ranks.lens[at]).tobytes()


def encode(docs: DataFrame, ranks_path: str, pattern: str, keep: list[Column], text: str = "text",
           decoded: bool = False) -> DataFrame:
    """``rec`` (struct of ``keep``) and ``ids`` (little-endian unsigned 32-bit token ids, binary) of each row.

    With ``decoded`` also the bytes that the ids decode to, in the same pass.
    NULL and empty texts have no token; repeated rows are rows of their own;
    columns outside ``keep`` are not read; an empty table gives an empty result.
    The rank file must lie at ``ranks_path`` on every executor."""
    rows = bound_batches(docs).select(F.struct(*keep).alias("rec"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["rec"], T.StructField("ids", T.BinaryType())])
    if decoded:
        schema.add("decoded", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, split = Pieces(load_ranks(ranks_path)), regex.compile(pattern)
        for b in (x.slice(c.start, c.stop - c.start) for x in batches for c in byte_chunks(x.column("text"), CHUNK_BYTES)):
            ids = encode_texts(b.column("text").to_pylist(), split, known)
            columns = [b.column("rec"), pa.array([v.astype("<u4").tobytes() for v in ids], pa.binary())]
            if decoded:
                columns.append(pa.array([decode_ids(v, known.ranks) for v in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(lambda b: give_back(run(b)), schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``rec``, ``ids`` and ``decoded`` (bytes) of rows of :func:`encode`; NULL ids decode to no byte."""
    schema = T.StructType([encoded.schema["rec"], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(ranks_path)
        for b in (x.slice(c.start, c.stop - c.start) for x in batches for c in byte_chunks(x.column("ids"), CHUNK_BYTES)):
            out = [decode_ids(np.frombuffer(v.as_py() or b"", "<u4"), ranks) for v in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("rec"), b.column("ids"), pa.array(out, pa.binary())], names=["rec", "ids", "decoded"])

    return encoded.select("rec", "ids").mapInArrow(lambda b: give_back(run(b)), schema)
