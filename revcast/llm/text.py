"""Shared text kernels: Arrow string batches as flat byte arrays.

Operators that read whole texts run as ``mapInArrow`` tasks. A batch is cut
into slices of about ``SLICE_BYTES`` of text (a longer document is a slice of
its own), and the work on a slice is done by numpy over its flat UTF-8 bytes,
so a task's memory is bounded by the slice, or by its longest document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 1_000_000
# Bytes of an Arrow batch between Spark and a Python worker: a worker holds a
# batch and what it makes of a slice of it.
BATCH_BYTES = 8 << 20



def bound_batches(spark: SparkSession) -> None:
    """Limit the session's Arrow batches to ``BATCH_BYTES``, if they are larger."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(name, "64m"))
    if now.endswith(("b", "B")):
        now = now[:-1]
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
# Word bytes after lower-casing: digits, a-z and every byte of a non-ASCII character.
WORD = np.zeros(256, dtype=bool)
WORD[ord("0"):ord("9") + 1] = True
WORD[ord("a"):ord("z") + 1] = True
WORD[128:] = True

def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


# Keys of the span hash, and spans (in bytes) from which hashlib takes over.
_KEYS = np.random.default_rng(20241203).integers(1, 1 << 63, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LONG = 256


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans ``values[start:end]``; equal spans have
    equal hashes wherever they stand. Blocks of eight bytes are mixed in one after
    the other under keys, so that no arithmetic of the letters carries over to
    the hash; long spans are hashed by blake2b."""
    width = values.dtype.itemsize
    if width > 1:
        values, starts, ends = np.ascontiguousarray(values).view(np.uint8), starts * width, ends * width
    starts, sizes = np.asarray(starts, np.int64), np.asarray(ends, np.int64) - np.asarray(starts, np.int64)
    padded = np.concatenate([values, np.zeros(8, np.uint8)])
    words = np.ndarray(len(values) + 1, "<u8", padded, strides=(1,))
    out = mix(sizes.astype(np.uint64) * _KEYS[0] + _KEYS[1])
    long = np.flatnonzero(sizes > _LONG)
    at = np.flatnonzero((sizes > 0) & (sizes <= _LONG))
    done = 0
    while len(at):
        left = sizes[at] - done
        block = words[starts[at] + done] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * np.minimum(left, 8).astype(np.uint64)))
        h = (out[at] ^ block) * _KEYS[2]
        out[at] = mix(mix(h ^ (h >> np.uint64(29))) + _KEYS[1])
        done += 8
        at = at[left > 8]
    for i in long.tolist():
        digest = hashlib.blake2b(values[starts[i]:starts[i] + sizes[i]], digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat UTF-8 bytes and row offsets of a string array; null reads as empty."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes, at least one row each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(low: np.ndarray, offsets: np.ndarray,
               word: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of lower-cased rows, and for each row
    the index of its first word (one more entry at the end)."""
    inside = word[low]
    before = np.zeros(len(low), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(low), bool)
    after[:-1] = inside[1:]
    firsts = offsets[:-1][offsets[:-1] < len(low)]
    before[firsts] = False
    lasts = offsets[1:][offsets[1:] > 0] - 1
    after[lasts] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(start, start + length)``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def map_texts(df: DataFrame, key: str, text: str, out: list[StructField],
              work: Callable[[pa.Array], dict[str, object]], size: int = SLICE_BYTES) -> DataFrame:
    """One output row for each input row: ``key`` as it is, then the columns
    that ``work`` makes of a slice of texts. Other columns are not read, so
    names that clash with the result's do no harm."""
    schema = StructType([StructField(key, df.schema[key].dataType)] + out)
    names = [f.name for f in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            for i, j in slices(offsets, size):
                made = work(texts.slice(i, j - i))
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(i, j - i)] + [_array(made[n], f) for n, f in zip(names, out, strict=True)],
                    names=[key, *names])

    return df.select(key, text).mapInArrow(run, schema)


def map_columns(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                out: list[StructField]) -> DataFrame:
    """``mapInArrow`` over all columns by their places: inside they are called c0, c1 and
    so on, so any name will do. ``run`` yields the columns of ``out`` in order."""
    inside = [f"c{i}" for i in range(len(out))]

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=inside)

    schema = StructType([StructField(n, f.dataType) for n, f in zip(inside, out, strict=True)])
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(named, schema).toDF(*[f.name for f in out])


def _array(values: object, field: StructField) -> pa.Array:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(field.dataType)
    if isinstance(values, pa.Array):
        return values.cast(kind)
    return pa.array(values, kind)
