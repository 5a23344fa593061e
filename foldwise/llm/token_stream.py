"""Token ids in Arrow stream files of fixed-size-list batches.

Documents are range-partitioned and sorted by id; each partition encodes its
texts in that order and writes its own pair of files in the Arrow stream format:

* ``ids-*.arrows``: rows of ``ids`` (fixed-size list of uint16, or uint32 where
  the vocabulary needs it) and ``mask`` (fixed-size list of bool, one bit each:
  whether the place holds a token, or padding), the documents one after the
  other, cut into sequences of equal length.  All batches but the last hold the
  same number of sequences, so they have the same size in bytes: batch i starts
  at ``first + i * step``, and a memory-mapped reader hands out its buffers
  without a copy.
* ``docs-*.arrows``: (doc_id, n_tokens) of the documents, in order.

A task names its files itself and reports them in its row of the manifest, so a
repeated or lost attempt leaves at most an unlisted file.  Starts over all
files are running sums of the manifest's token counts (one row per file).
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm.common import bound_batches, checkpoint, no_null_text, scratch

#: tokens of a sequence, sequences of a batch, documents of an index batch
LENGTH = 2048
BATCH = 64
INDEX_BATCH = 4096
#: bytes of text per file
FILE_BYTES = 16 << 20
END_ID = 0
#: characters that the tokenizer gets at once: longer texts are cut where a new word begins
PIECE_CHARS = 1 << 16
#: characters whose words are looked up at once; bytes of words that a worker remembers, words that are
#: encoded in one text, and what a remembered word costs beside its bytes and ids
CHUNK_CHARS = 4 << 20
MEMORY_BYTES = 128 << 20
WORDS = 128
WORD_COST = 160

_MANIFEST = "part int, ids_file string, docs_file string, docs long, tokens long"
_INDEX = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
#: a blank between two characters that are not white space: byte-level patterns always start a word there
_CUT = re.compile(r"(?<=\S) (?=\S)")


def sequence_schema(length: int = LENGTH, vocabulary: int = 1 << 32) -> pa.Schema:
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


def _place(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


# ------------------------------------------------------------- encoding
@cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # the special tokens' strings in a text are ordinary text
    return t


def pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces that encode apart as they do together, cut at the first chance from ``most`` characters on."""
    at = 0
    while len(text) - at > most:
        cut = _CUT.search(text, at + most)
        if cut is None:
            break
        yield text[at: cut.start()]
        at = cut.start()
    yield text[at:]


def _encode(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of every text; the library gets a bounded number of characters at once."""
    ids: list[np.ndarray] = []
    for some in _groups(texts, PIECE_CHARS):
        ids += [np.array(e.ids, np.uint32) for e in _tokenizer(path).encode_batch_fast(some, add_special_tokens=False)]
    return ids


def _groups(texts: list[str], most: int) -> Iterator[list[str]]:
    """The texts in order, in groups of at most ``most`` characters (or one text)."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= most):
            size += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


def encode_texts(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of every text, without special tokens."""
    cut = [list(pieces(t)) for t in texts]
    flat = [p for ps in cut for p in ps]
    memory = _memory(path)
    if memory is None:
        ids = _encode(flat, path)
    else:
        ids = [x for some in _groups(flat, CHUNK_CHARS) for x in memory.encode(some)]
    out, at = [], 0
    for ps in cut:
        out.append(ids[at] if len(ps) == 1 else np.concatenate(ids[at: at + len(ps)]))
        at += len(ps)
    return out


class WordMemory:
    """Encodes texts word by word, each different word by the library once.

    A word begins at a blank between two characters that are not white space,
    where byte-level patterns always start a match, so the ids of a text are
    those of its words in order.  Words not met before go to the library, many in
    one text; the name of a byte-level token has a character per byte, which tells
    where the ids of a word end.  Once the words hold ``most`` bytes, those met in
    one chunk only are forgotten, to be learnt again."""

    def __init__(self, path: str, most: int = MEMORY_BYTES):
        self.path, self.most = path, most
        vocabulary = _tokenizer(path).get_vocab(with_added_tokens=False)
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)
        self.slots: dict[bytes, int] = {}  # word k has the ids ends[k] .. ends[k + 1] and was met in met[k] chunks
        self.ids, self.ends, self.met, self.held = np.empty(0, np.uint32), np.zeros(1, np.int64), np.empty(0, np.int64), 0

    def _forget(self) -> None:
        """Keep the words that were met in more than one chunk, if they are few enough."""
        kept = [(w, k) for w, k in self.slots.items() if self.met[k] > 1] if self.held else []
        if 2 * len(kept) > len(self.slots):
            kept = []
        at = np.array([k for _, k in kept], np.int64)
        n = self.ends[at + 1] - self.ends[at]
        after = np.cumsum(n)
        self.ids = self.ids[np.repeat(self.ends[at] - after + n, n) + np.arange(n.sum())]
        self.slots = {w: i for i, (w, _) in enumerate(kept)}
        self.ends, self.met = np.append(0, after), np.zeros(len(kept), np.int64)
        self.held = sum(len(w) + WORD_COST for w in self.slots) + self.ids.nbytes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.held > self.most:
            self._forget()
        raw = [t.encode() for t in texts]
        data, bounds = b"".join(raw), np.cumsum([0] + [len(r) for r in raw])
        if not data:
            return [np.empty(0, np.uint32) for _ in texts]
        outer = np.zeros(len(data) + 1, bool)  # where a text starts or ends
        outer[bounds] = True
        starts = np.flatnonzero(_word_starts(data, outer) | outer)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]).dictionary_encode()
        place, (_, ends, buffer) = words.indices.to_numpy(), words.dictionary.buffers()
        ends, buffer = np.frombuffer(ends, np.int64)[: len(words.dictionary) + 1].tolist(), buffer.to_pybytes()
        keys = [buffer[a:b] for a, b in zip(ends, ends[1:])]
        alone = np.ones(len(keys), bool)  # words between two blanks can follow each other in one text, others not
        alone[place[~(outer[starts[:-1]] | outer[starts[1:]])]] = False
        found = list(map(self.slots.get, keys))
        new = [i for i, k in enumerate(found) if k is None]
        self._learn([keys[i] for i in new if not alone[i]], [keys[i] for i in new if alone[i]])
        for i in new:
            found[i] = self.slots[keys[i]]
        slot = np.array(found)
        self.met[slot] += 1
        first, n = self.ends[slot][place], (self.ends[slot + 1] - self.ends[slot])[place]
        after = np.cumsum(n)
        ids = self.ids[np.repeat(first - after + n, n) + np.arange(after[-1])]
        cuts = np.append(0, after)[np.searchsorted(starts, bounds)].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, inner: list[bytes], outer: list[bytes]) -> None:
        """Encode the inner words behind each other, the others apart."""
        groups = [inner[i: i + WORDS] for i in range(0, len(inner), WORDS)] + [[w] for w in outer]
        ids, ends, base = [self.ids], [self.ends], self.ends[-1]
        for words, got in zip(groups, _encode([b"".join(g).decode() for g in groups], self.path), strict=True):
            token_ends, word_ends = np.cumsum(self.token_bytes[got]), np.cumsum([len(w) for w in words])
            last = np.searchsorted(token_ends, word_ends)
            if token_ends[-1] != word_ends[-1] or (token_ends[last] != word_ends).any():
                raise ValueError("a token reaches over the start of a word")
            self.slots.update(zip(words, range(len(self.slots), len(self.slots) + len(words))))
            ids.append(got)
            ends.append(base + last + 1)
            base += len(got)
            self.held += int(word_ends[-1]) + 4 * len(got) + WORD_COST * len(words)
        self.ids, self.ends = np.concatenate(ids), np.concatenate(ends)
        self.met = np.append(self.met, np.zeros(len(self.slots) - len(self.met), np.int64))


def _word_starts(data: bytes, outer: np.ndarray) -> np.ndarray:
    """Whether a byte is a blank between two characters of one text that are certainly no
    white space (ASCII, or letters and signs of two bytes from U+00C0 on)."""
    b = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(b == 0x20)
    at = at[(at > 1) & (at < len(b) - 1)]
    at = at[~(outer[at] | outer[at + 1])]
    before, lead, behind = b[at - 1], b[at - 2], b[at + 1]
    solid = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (lead >= 0xC3) & (lead < 0xE0))
    solid &= ((behind > 0x20) & (behind < 0x7F)) | ((behind >= 0xC3) & (behind < 0xE0))
    out = np.zeros(len(b) + 1, bool)
    out[at[solid]] = True
    return out


@cache
def _memory(path: str) -> WordMemory | None:
    """The worker's memory of words for a tokenizer whose ids of a text are those of its words; else None."""
    t = json.loads(_tokenizer(path).to_str())
    pre, model = t["pre_tokenizer"] or {}, t["model"]
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True) and not t["normalizer"]
    plain = plain and not t["truncation"] and not t["padding"] and all(a["special"] for a in t["added_tokens"])
    bpe = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
    return WordMemory(path) if plain and bpe else None


# ------------------------------------------------------------- files
class SequenceWriter:
    """Appends documents to a file of equal-length sequences; at most one batch is held."""

    def __init__(self, sink, length: int = LENGTH, batch: int = BATCH, vocabulary: int = 1 << 32):
        self.length, self.schema = length, sequence_schema(length, vocabulary)
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.ids = np.zeros(length * batch, self.schema.field("ids").type.value_type.to_pandas_dtype())
        self.used = self.tokens = 0

    def append(self, ids: np.ndarray, end_id: int = END_ID) -> int:
        """Write a document's ids and its end id; returns their number."""
        ids = np.append(ids, np.uint32(end_id))
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, len(self.ids) - self.used)
            self.ids[self.used: self.used + n] = ids[at: at + n]
            at, self.used = at + n, self.used + n
            if self.used == len(self.ids):
                self._flush()
        self.tokens += len(ids)
        return len(ids)

    def _flush(self) -> None:
        size = -(-self.used // self.length) * self.length  # the last sequence is padded
        self.ids[self.used: size] = 0
        columns = self.ids[:size].copy(), np.arange(size) < self.used
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in columns]
        self.writer.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))
        self.used = 0

    def close(self) -> None:
        if self.used:
            self._flush()
        self.writer.close()


class SequenceReader:
    """Random access to a file of equal-length sequences.

    Local files are memory-mapped and batches are views of the mapping; other
    stores are read at the batch's place."""

    def __init__(self, uri: str):
        fs, path = _place(uri)
        local = isinstance(fs, pa.fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        self.schema = pa.ipc.read_schema(self.source)
        self.length = self.schema.field("ids").type.list_size
        self.first = self.source.tell()
        head = self._read(self.first)
        self.step, self.per_batch = self.source.tell() - self.first, 0 if head is None else head.num_rows
        self.held = (0, head)

    def _read(self, at: int) -> pa.RecordBatch | None:
        self.source.seek(at)
        try:
            return pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)
        except EOFError:  # the stream's end mark: no batch here
            return None

    def batch(self, i: int) -> pa.RecordBatch | None:
        if self.held[0] != i:
            self.held = (i, self._read(self.first + i * self.step))
        return self.held[1]

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """(ids, mask) of sequence i, without a copy from a local file (the mask's bits are an Arrow array)."""
        b = self.batch(i // self.per_batch) if self.per_batch else None
        k = i % self.per_batch if self.per_batch else 0
        if b is None or k >= b.num_rows:
            raise IndexError(i)
        ids, mask = (b[c].flatten().slice(k * self.length, self.length) for c in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask

    def tokens(self, start: int, n: int) -> Iterator[tuple[np.ndarray, bool]]:
        """Tokens start .. start + n of the file as views of its batches, each with whether the mask holds all of them."""
        size = self.per_batch * self.length
        while n > 0:
            b = self.batch(start // size) if size else None
            at = start % size if size else 0
            if b is None or at >= b.num_rows * self.length:
                raise IndexError(start)
            view = b["ids"].flatten().to_numpy(zero_copy_only=True)[at: at + n]
            yield view, b["mask"].flatten().slice(at, len(view)).true_count == len(view)
            start, n = start + len(view), n - len(view)

    def close(self) -> None:
        self.held = (-1, None)
        self.source.close()


def read_index(uri: str) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, n_tokens) of a file's documents."""
    fs, path = _place(uri)
    with fs.open_input_stream(path) as source, pa.ipc.open_stream(source) as reader:
        yield from reader


# ------------------------------------------------------------- write and read on Spark
@dataclass(frozen=True)
class TokenFiles:
    """Files of one written table: a row per file, in the order of ids, with the tokens before it."""

    path: str
    files: list[tuple[int, str, str, int, int, int]]  # part, ids file, docs file, docs, tokens, tokens before

    @property
    def tokens(self) -> int:
        return sum(f[4] for f in self.files)


def write_tokens(docs: DataFrame, tokenizer: str, path: str | None = None, key: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, length: int = LENGTH, batch: int = BATCH, file_bytes: int = FILE_BYTES) -> TokenFiles:
    """Encode all texts and write them under ``path`` (a folder that all executors share) in ascending order of ids.

    NULL texts are empty and hold the end id alone; rows of NULL id come first;
    rows that share an id follow each other by a hash of the text; a text of any
    length is encoded whole and runs over as many sequences as it needs; columns
    but the id and the text are not read; an empty table has no files."""
    spark = docs.sparkSession
    vocabulary = max(_tokenizer(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1)
    path = (path or scratch(spark, "tokens")).rstrip("/")
    raw = bound_batches(docs).select(F.col(f"`{key}`").cast("long").alias("doc_id"), no_null_text(F.col(f"`{text}`")).alias("text"))
    total = raw.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    # copies of one id and text are told apart by their place, so that they can part over files
    rows = raw.select("doc_id", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place"), "text")
    parts = max(1, -(-total // file_bytes))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("place")]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, name, out = TaskContext.get().partitionId(), uuid.uuid4().hex, None
        held: list[tuple[int | None, int]] = []
        n_docs = 0
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                files = tuple(f"{path}/{kind}-{part:06d}-{name}.arrows" for kind in ("ids", "docs"))
                fs, folder = _place(path)
                fs.create_dir(folder, recursive=True)
                sinks = [fs.open_output_stream(_place(f)[1]) for f in files]
                out, index = SequenceWriter(sinks[0], length, batch, vocabulary), pa.ipc.new_stream(sinks[1], _INDEX)
            for i, ids in zip(b["doc_id"].to_pylist(), encode_texts(b["text"].to_pylist(), tokenizer), strict=True):
                held.append((i, out.append(ids, end_id)))
                n_docs += 1
                if len(held) == INDEX_BATCH:
                    index.write_batch(_index(held))
                    held = []
        if out is not None:
            if held:
                index.write_batch(_index(held))
            out.close()
            index.close()
            for s in sinks:
                s.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "ids_file": [files[0]], "docs_file": [files[1]],
                                              "docs": [n_docs], "tokens": [out.tokens]})

    manifest = checkpoint(dealt.mapInArrow(run, _MANIFEST))
    files, before = [], 0
    for r in manifest.orderBy("part").collect():  # one row per file
        files.append((r.part, r.ids_file, r.docs_file, r.docs, r.tokens, before))
        before += r.tokens
    return TokenFiles(path, files)


def _index(rows: list[tuple[int | None, int]]) -> pa.RecordBatch:
    ids, n = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], schema=_INDEX)


def read_tokens(spark: SparkSession, written: TokenFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, masked) per document, read back from the files, one task per file.

    ids_crc32 is taken over the ids as little-endian uint32; ``masked``: whether the mask holds all its tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids_file, docs_file, base in zip(b["ids_file"].to_pylist(), b["docs_file"].to_pylist(), b["before"].to_pylist(), strict=True):
                reader, at = SequenceReader(ids_file), 0
                for index in read_index(docs_file):
                    sizes = index["n_tokens"].to_numpy()
                    starts = at + np.cumsum(sizes) - sizes
                    crcs, masked = [], []
                    for s, n in zip(starts.tolist(), sizes.tolist(), strict=True):
                        crc, whole = 0, True
                        for view, held in reader.tokens(s, n):
                            crc, whole = zlib.crc32(view.astype("<u4", copy=False), crc), whole and held
                        crcs.append(crc)
                        masked.append(whole)
                    at += int(sizes.sum())
                    yield pa.RecordBatch.from_arrays([index["doc_id"], pa.array(starts + base), index["n_tokens"], pa.array(crcs, pa.int64()), pa.array(masked)],
                                                     names=["doc_id", "start", "n_tokens", "ids_crc32", "masked"])
                reader.close()

    listed = spark.createDataFrame(written.files, "part int, ids_file string, docs_file string, docs long, tokens long, before long")
    dealt = listed.repartitionByRange(max(1, len(written.files)), "part")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, masked boolean")
