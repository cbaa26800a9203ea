"""Helpers of the training-data operators: staged tables, batches and words as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rillflow.session import work_dir

BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared work folder and read from there: lineage ends, results are fixed."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, longer by underscores while one of ``taken`` is called so."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def task_number() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` takes about ``limit`` bytes in each; a longer value stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = text_offsets(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def text_offsets(array: pa.Array) -> np.ndarray:
    """Byte offsets of a string array's values; nulls are empty."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind, width = (np.int64, 8) if wide else (np.int32, 4)
    if not len(array):
        return np.zeros(1, np.int64)
    return np.frombuffer(array.buffers()[1], kind, len(array) + 1, array.offset * width).astype(np.int64)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array's values and each value's offset among them."""
    if array.null_count:
        array = array.fill_null("" if not pa.types.is_binary(array.type) else b"")
    offsets = text_offsets(array)
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


# The bytes that separate words in the two definitions of a word.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALPHANUMERIC = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(texts: pa.Array, separators: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A-Z lower-cased, as one binary array, and each text's offset in it."""
    raw, offsets = text_bytes(texts)
    inside = np.ones(256, bool)
    inside[[b for b in separators if not 65 <= b <= 90]] = False
    return words_from(_LOWER[raw], inside[raw], offsets)


def words_from(data: np.ndarray, inside: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    if not len(data):
        return pa.array([], pa.binary()), np.zeros(len(offsets), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    kept = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
    bounds = np.append(kept[starts], kept[-1])
    packed = data[inside]
    if bounds[-1] < 2**31:
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(packed)])
    else:
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
    return words, np.searchsorted(starts, offsets)


def coded(words: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """A number for each word and the distinct words by number."""
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary.to_pylist()


def sums_between(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values[offsets[i]:offsets[i + 1]]`` for each i."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[offsets[1:]] - total[offsets[:-1]]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1 ... of every range, one range after another."""
    if not len(starts):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])
