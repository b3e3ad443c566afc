"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import pickle
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stage

__all__ = ["arrow_map", "bucket_of", "free_shared", "hash64", "held", "mix64", "picked", "share", "stage", "text_chunks", "texts_of"]


# Executors get this subpackage's functions with the job and need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__package__])


_SHARED: list = []


def share(df: DataFrame, value):
    """Broadcast a bounded object; a task gets it back with ``held``."""
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))
    _SHARED.append(shared)
    return shared


def free_shared() -> None:
    """Give back all that was shared, once the rows made with it are written. Unwritten frames lose their model."""
    while _SHARED:
        _SHARED.pop().destroy()
    release()


def held(shared):
    return pickle.loads(shared.value)


def picked(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns can never clash with those an operator makes."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def bucket_of(key: Column, modulus: int) -> Column:
    """crc32 of the key's text, modulo ``modulus``; NULL for a NULL key."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow``; when a task ends its worker, which Spark keeps, hands unused memory back."""

    def run(batches):
        yield from fn(batches)
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, NULL as empty, without decoding."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def text_chunks(batch: pa.RecordBatch, name: str, max_bytes: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch whose texts together hold about ``max_bytes``, so memory does not follow text length."""
    column = batch.column(batch.schema.get_field_index(name))
    sizes = pc.binary_length(column.cast(pa.binary()).fill_null(b"")).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > max_bytes:
            yield batch.slice(start, i - start), texts_of(column.slice(start, i - start))
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield batch.slice(start), texts_of(column.slice(start))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of unsigned 64-bit words (multiply and xor-shift rounds)."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def hash64(values: Sequence[bytes], seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte strings."""
    import xxhash

    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(v, seed) for v in values), dtype=np.uint64, count=len(values))
