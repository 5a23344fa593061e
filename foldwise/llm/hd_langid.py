"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point alone.
An n-gram's vector binds (multiplies) its letters' vectors, each rotated by its
place in the n-gram; a text's vector bundles (adds) the vectors of all its
n-grams; a language's prototype bundles its labelled texts.  A text gets the
language whose prototype has the largest cosine with it.

Texts are lower-cased, runs of other characters than letters become one blank,
and a blank stands before and after the text, so a text with a letter has an
n-gram.  Bundles are exact integers, so prototypes do not depend on how rows are
partitioned.  A batch is bundled as products of (texts x distinct n-grams) counts
and (distinct n-grams x dimensions) vectors, some n-grams at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.common import bound_batches, byte_chunks, give_back

DIMENSIONS = 1024
N = 3
SEED = 4001
#: more learned values than this in ``lang`` raise: prototypes travel with the tasks
MAX_LANGUAGES = 2000
UNKNOWN = "und"
#: bytes of text, rows and n-grams of one product, which bound its memory
CHUNK_BYTES = 1 << 18
CHUNK_ROWS = 256
CHUNK_GRAMS = 1024


@cache
def _letters() -> np.ndarray:
    """Lower-case letter of each code point's place, 0 for other characters."""
    return np.array([i if chr(i).isalpha() else 0 for i in range(0x110000)], dtype=np.uint32)


@cache
def letter_vector(code: int, dims: int, seed: int) -> np.ndarray:
    rng = np.random.Generator(np.random.Philox(key=[seed, code]))
    return rng.integers(0, 2, dims, dtype=np.int8) * 2 - 1


def ngram_vectors(grams: np.ndarray, dims: int, seed: int) -> np.ndarray:
    """Bound vectors of the rows of ``grams`` (code points): place j is rotated by n - 1 - j."""
    codes, at = np.unique(grams, return_inverse=True)
    base = np.stack([letter_vector(int(c), dims, seed) for c in codes])
    at = at.reshape(grams.shape)
    out = np.ones((len(grams), dims), dtype=np.int8)
    for j in range(grams.shape[1]):
        out *= np.roll(base, grams.shape[1] - 1 - j, axis=1)[at[:, j]]
    return out


def bundles(texts: list[str | None], n: int = N, dims: int = DIMENSIONS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(bundle of each text as float32 rows, number of its n-grams); counts are exact below 2**24."""
    parts = [(" " + t.lower() + " ") if t else " " for t in texts]
    lens = np.array([len(p) for p in parts])
    code = _letters()[np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    text = np.repeat(np.arange(len(parts)), lens)
    keep = np.ones(len(code), bool)  # one blank for each run of blanks of a text
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0) | (text[1:] != text[:-1])
    code, text = code[keep], text[keep]
    m = len(code) - n + 1
    out, total = np.zeros((len(parts), dims), np.float32), np.zeros(len(parts), np.int64)
    if m <= 0:
        return out, total
    grams = np.stack([code[j: m + j] for j in range(n)], axis=1)
    inside = (text[:m] == text[n - 1:]) & (grams[:, n // 2] != 0 if n > 2 else True) & grams.any(axis=1)
    grams, text = grams[inside], text[:m][inside]
    if not len(grams):
        return out, total
    packed = np.zeros(len(grams), np.uint64)
    for j in range(n):
        packed = packed * np.uint64(0x110000) + grams[:, j]
    _, first, at = np.unique(packed, return_index=True, return_inverse=True)
    order = np.argsort(at.reshape(-1), kind="stable")
    at, of = at.reshape(-1)[order], text[order]
    for start in range(0, len(first), CHUNK_GRAMS):
        part = grams[first[start: start + CHUNK_GRAMS]]
        a, b = np.searchsorted(at, [start, start + len(part)])
        counts = np.bincount(of[a:b] * len(part) + at[a:b] - start, minlength=len(parts) * len(part))
        out += counts.reshape(len(parts), len(part)).astype(np.float32) @ ngram_vectors(part, dims, seed).astype(np.float32)
    return out, np.bincount(text, minlength=len(parts)).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], text: Callable[[pa.RecordBatch], pa.Array]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of the batches of at most CHUNK_ROWS rows and CHUNK_BYTES bytes of text (or one row), with their texts."""
    for b in batches:
        texts = text(b)
        for c in byte_chunks(texts, CHUNK_BYTES):
            for start in range(c.start, c.stop, CHUNK_ROWS):
                n = min(CHUNK_ROWS, c.stop - start)
                yield b.slice(start, n), texts.slice(start, n).to_pylist()


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", n: int = N, dims: int = DIMENSIONS,
          seed: int = SEED) -> dict[str, np.ndarray]:
    """Prototype of each language: the bundle of all its rows' texts (rows with a NULL language are not used).

    A partition sends one partial bundle per language; the sums are taken by
    (language, dimension).  What reaches the driver is languages x dimensions."""
    rows = bound_batches(labelled).where(F.col(f"`{lang}`").isNotNull()).select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b, texts in _slices(batches, lambda b: b.column("text")):
            langs = np.array(b.column("lang").to_pylist(), dtype=object)
            vectors, _ = bundles(texts, n, dims, seed)
            for name in set(langs):
                sums[name] = sums.get(name, 0) + vectors[langs == name].sum(axis=0, dtype=np.float64)
        for name, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dims), pa.array(np.arange(dims, dtype=np.int32)),
                                              pa.array(v.astype(np.int64))], names=["lang", "dim", "s"])

    sums = rows.mapInArrow(lambda b: give_back(partial(b)), "lang string, dim int, s long").groupBy("lang", "dim").agg(F.sum("s").alias("s"))
    by_lang = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("dim", "s")))["s"].alias("v"))
    got = by_lang.limit(MAX_LANGUAGES + 1).collect()
    if len(got) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r["lang"]: np.array(r["v"], dtype=np.float64) for r in got}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: list[Column], text: str = "text", n: int = N,
            dims: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """``rec`` (struct of ``keep``), ``lang_pred`` and ``score`` (cosine, cut to 0..1) of every row's whole text.

    NULL texts and texts without a letter get ``und`` and 0; so does every text
    if nothing was learned.  Equal cosines go to the smaller language name.  A
    kept column named like the text must be the text: it is sent to Python once."""
    rows = bound_batches(docs).select(F.struct(*keep).alias("rec"), F.col(f"`{text}`").alias("text"))
    kept_text = text in rows.schema["rec"].dataType.names
    if kept_text:
        rows = rows.select("rec")
    names = sorted(prototypes)
    unit = np.stack([prototypes[k] / max(np.linalg.norm(prototypes[k]), 1e-300) for k in names]) if names else None
    schema = T.StructType([rows.schema["rec"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in _slices(batches, lambda b: b.column("rec").field(text) if kept_text else b.column("text")):
            vectors, grams = bundles(texts, n, dims, seed)
            if unit is None:
                langs, scores = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows)
            else:
                v = vectors.astype(np.float64)
                cos = np.round(v @ unit.T / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300), 9)
                best = cos.argmax(axis=1)
                langs = [names[i] if g else UNKNOWN for i, g in zip(best, grams, strict=True)]
                scores = np.where(grams > 0, np.clip(cos[np.arange(len(v)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([b.column("rec"), pa.array(langs, pa.string()), pa.array(scores)],
                                             names=["rec", "lang_pred", "score"])

    return rows.mapInArrow(lambda b: give_back(score(b)), schema)
