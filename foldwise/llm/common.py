"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.session import ensure_checkpoint_dir

#: a run of characters that are not ASCII white space
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def no_null_text(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def n_words(col: str | Column) -> Column:
    """Number of white-space separated words (NULL text: 0)."""
    return F.regexp_count(no_null_text(col), F.lit(WORD)).cast("long")


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


#: bytes of text that one numpy pass works on, which bounds its memory
CHUNK_BYTES = 1 << 19


#: bytes of an Arrow batch that is sent to Python, where the session leaves Spark's default
BATCH_BYTES = 1 << 20
_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bound_batches(df: DataFrame) -> DataFrame:
    """Bound the Arrow batches of the session's Python stages; ``df`` itself comes back.

    Spark's default (64 MB or 10,000 rows) is held once by the JVM and once by
    the worker for each running task, and documents fill it.  A value that the
    session has set is left alone.  The size of a batch never changes a result."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_CONF, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        conf.set(_BATCH_CONF, str(BATCH_BYTES))
    return df


def give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last one, memory that this Python worker has freed returns to the system.

    Workers are used again by later tasks of any kind, and allocators keep what
    large arrays have left behind."""
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def byte_chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[slice]:
    """Consecutive slices of a binary array of at most ``most`` bytes (or one value)."""
    start = size = 0
    for i, n in enumerate(pa.compute.binary_length(texts).fill_null(0).to_pylist()):
        if i > start and size + n > most:
            yield slice(start, i)
            start, size = i, 0
        size += n
    if len(texts):
        yield slice(start, len(texts))
