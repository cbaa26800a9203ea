"""Byte-level BPE with a two-tier lookup.

A text is cut into pre-tokens by a pattern; each is encoded on its own. A
minimal perfect hash, built once from the vocabulary, answers all distinct
pre-tokens of a batch at once: every key of the vocabulary has a slot of its
own and no slot is free, so one comparison with the slot's token tells whether
the pre-token is in the vocabulary. The others are merged: their bytes are a
linked list and a heap gives the pair of lowest rank, leftmost first, so a
pre-token of a million letters costs its length times a logarithm. Merged
pre-tokens are remembered in two generations of bounded size.

The vocabulary is shared with all tasks; it does not grow with the documents.
A null text is empty and has no ids; null ids decode to null. Repeated rows are
rows of their own. Other columns pass through; those named as the results are
replaced. A text longer than ``LONG_TEXT`` is cut by the pattern in steps, so
its pre-tokens are never all in memory.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from rillflow.llm.shared import free_name, slices, text_offsets

BATCH_BYTES = 2 << 20
LONG_TEXT = 1 << 20
STEP = 200_000
CACHE_BYTES = 16 << 20
MOST_VOCABULARY = 64 << 20
KEYS_PER_BUCKET = 2
TRIES = 64

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _hashes(keys: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _slot(hashes: np.ndarray, step: np.ndarray, size: int) -> np.ndarray:
    x = hashes + step.astype(np.uint64) * _ODD
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


@dataclass(frozen=True)
class PerfectHash:
    """A slot for each of ``size`` keys, none left over, by hash and displace.

    Keys fall into buckets. A bucket's displacement is the first for which all
    its keys meet free slots, largest buckets first; a bucket of one key is
    given one of the slots that are left, stored as a negative number.
    """

    size: int
    displacement: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray) -> PerfectHash:
        size = len(hashes)
        if len(np.unique(hashes)) != size:
            raise ValueError("two keys have the same hash")
        buckets = max(1, size // KEYS_PER_BUCKET)
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=buckets)
        ends = np.cumsum(counts)
        displacement = np.zeros(buckets, np.int64)
        taken = np.zeros(size, bool)
        for b in np.argsort(-counts, kind="stable").tolist():
            if counts[b] < 2:
                break
            own = hashes[order[ends[b] - counts[b]:ends[b]]]
            first = 0
            while True:
                tried = np.arange(first, first + TRIES)
                slots = _slot(own[None], tried[:, None], size)
                ordered = np.sort(slots, axis=1)
                fits = ~taken[slots].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if fits.any():
                    at = int(np.argmax(fits))
                    displacement[b] = first + at
                    taken[slots[at]] = True
                    break
                first += TRIES
        single = np.flatnonzero(counts == 1)
        displacement[single] = -1 - np.flatnonzero(~taken)
        return cls(size, displacement)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        step = self.displacement[(hashes % np.uint64(len(self.displacement))).astype(np.int64)]
        return np.where(step < 0, -1 - step, _slot(hashes, np.maximum(step, 0), self.size))


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by id, and the id in each slot of the perfect hash."""

    tokens: pa.Array
    slot_ids: np.ndarray
    hash: PerfectHash

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> Vocabulary:
        """``ranks``: token to id, lower ids merged first. All single bytes must be among them."""
        lacking = [b for b in range(256) if bytes([b]) not in ranks]
        if lacking:
            raise ValueError(f"the vocabulary lacks {len(lacking)} single bytes")
        if sum(map(len, ranks)) > MOST_VOCABULARY:
            raise ValueError(f"a vocabulary of more than {MOST_VOCABULARY} bytes is not shared with all tasks")
        keys, ids = list(ranks), np.fromiter(ranks.values(), np.int64, len(ranks))
        hashes = _hashes(keys)
        perfect = PerfectHash.of(hashes)
        slot_ids = np.empty(len(keys), np.int64)
        slot_ids[perfect.slots(hashes)] = ids
        by_id: list[bytes | None] = [None] * (int(ids.max()) + 1)
        for token, i in ranks.items():
            by_id[i] = token
        return cls(pa.array(by_id, pa.large_binary()), slot_ids, perfect)

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        """A file of lines: a token in base64, a space, its rank."""
        with open(path, "rb") as f:
            return cls.of({base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())})

    def ids_of(self, keys: list[bytes]) -> np.ndarray:
        """The id of every key that is a token, -1 for the others."""
        if not keys:
            return np.zeros(0, np.int64)
        ids = self.slot_ids[self.hash.slots(_hashes(keys))]
        same = pc.equal(self.tokens.take(pa.array(ids)), pa.array(keys, pa.large_binary()))
        return np.where(same.to_numpy(zero_copy_only=False), ids, -1)


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the adjacent pair of lowest rank is joined, leftmost first, until no pair is a token."""
    n = len(piece)
    end = list(range(1, n + 1))  # where the part that starts here ends; 0: no part starts here
    before = list(range(-1, n - 1))  # where the part before it starts
    get = ranks.get
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        right = end[i]
        # Joined meanwhile, or with another part than the one this pair was found with.
        if not right or right >= n or end[right] != stop:
            continue
        end[i], end[right] = stop, 0
        if stop < n:
            before[stop] = i
            if (rank := get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        if i and (rank := get(piece[before[i]:stop])) is not None:
            heapq.heappush(heap, (rank, before[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Encoder:
    """One task's encoder: the shared vocabulary, the compiled pattern and the merges remembered so far."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        self.ranks = {token: i for i, token in enumerate(vocabulary.tokens.to_pylist()) if token is not None}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0

    def _merged(self, piece: bytes) -> bytes:
        ids = self.known.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            if ids is None:
                ids = np.array(merged(piece, self.ranks), "<u4").tobytes()
            self.known[piece] = ids
            self.held += len(piece) + len(ids) + 200
            if self.held > CACHE_BYTES:
                self.known, self.older, self.held = {}, self.known, 0
        return ids

    def of_pieces(self, pieces: list[str]) -> tuple[pa.Buffer | bytes, np.ndarray]:
        """The ids of all pieces, packed, and each piece's number of ids."""
        if not pieces:
            return b"", np.zeros(0, np.int64)
        encoded = pa.array(pieces, pa.large_string()).dictionary_encode()
        distinct = encoded.dictionary.cast(pa.large_binary()).to_pylist()
        ids = self.vocabulary.ids_of(distinct)
        packed = [i.tobytes() for i in ids.astype("<u4")]
        for at in np.flatnonzero(ids < 0).tolist():
            packed[at] = self._merged(distinct[at])
        taken = pa.array(packed, pa.large_binary()).take(encoded.indices)
        offsets = text_offsets(taken)
        return taken.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])), np.diff(offsets) >> 2

    def encode(self, texts: list[str]) -> tuple[list, np.ndarray]:
        """The packed ids of all texts, in parts, and each text's number of ids."""
        parts, counts, pieces, per_text = [], np.zeros(len(texts), np.int64), [], np.zeros(len(texts), np.int64)

        def flush(upto: int) -> None:
            nonlocal pieces
            data, numbers = self.of_pieces(pieces)
            parts.append(data)
            total = np.concatenate([[0], np.cumsum(numbers)])
            ends = np.cumsum(per_text[:upto])
            counts[:upto] += total[ends] - total[ends - per_text[:upto]]
            pieces, per_text[:upto] = [], 0

        for i, text in enumerate(texts):
            if len(text) <= LONG_TEXT:
                found = self.pattern.findall(text)
                pieces += found
                per_text[i] = len(found)
                continue
            found = (m.group() for m in self.pattern.finditer(text))
            while step := list(islice(found, STEP)):
                pieces += step
                per_text[i] = len(step)
                flush(i + 1)
        flush(len(texts))
        return parts, counts


def _kept(docs: DataFrame, keep: Sequence[str] | None, *new: str) -> list[StructField]:
    names = docs.columns if keep is None else keep
    return [docs.schema[c] for c in names if c not in new]


def _check_pattern(pattern: str) -> str:
    if re.match(r"\s*$", pattern):
        raise ValueError("a pattern for pre-tokens is needed")
    return pattern


def shared_vocabulary(spark: SparkSession, vocabulary: Vocabulary):
    """The vocabulary for all tasks; its size is checked when it is made."""
    return spark.sparkContext.broadcast(vocabulary)


def encode(docs: DataFrame, shared, pattern: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``_ids``: the ids of ``text`` as little-endian unsigned 32-bit integers."""
    kept = _kept(docs, keep, "_ids")
    names = [f.name for f in kept]
    given = free_name("_bpe_text", names)
    _check_pattern(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern)
        for batch in slices(batches, given, BATCH_BYTES):
            parts, counts = encoder.encode(batch.column(given).to_pylist())
            offsets = np.concatenate([[0], np.cumsum(counts * 4)]).astype(np.int32)
            data = parts[0] if len(parts) == 1 else b"".join(map(memoryview, parts))
            ids = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], ids], names=[*names, "_ids"])

    rows = docs.select(*names, F.coalesce(F.col(text), F.lit("")).alias(given))
    return rows.mapInArrow(run, StructType([*kept, StructField("_ids", BinaryType())]))


def decode(encoded: DataFrame, shared, ids: str = "_ids", keep: Sequence[str] | None = None) -> DataFrame:
    """``encoded`` with ``_decoded``: the bytes of the tokens of every row's ids. An id that is no token fails the task."""
    kept = _kept(encoded, keep, "_decoded")
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value.tokens
        for batch in slices(batches, ids, BATCH_BYTES):
            given = batch.column(ids)
            packed, offsets = given.buffers()[2], text_offsets(given)
            flat = np.frombuffer(packed, "<u4", int(offsets[-1] - offsets[0]) >> 2, int(offsets[0])) if packed else np.zeros(0, "<u4")
            taken = tokens.take(pa.array(flat))
            if taken.null_count:
                raise ValueError("an id has no token")
            ends = text_offsets(taken)[(offsets - offsets[0]) >> 2]
            data = taken.buffers()[2]
            valid = None
            if given.null_count:
                valid = pc.is_valid(given).buffers()[1] if not given.offset else pa.array(given.is_valid().to_pylist()).buffers()[1]
            decoded = pa.Array.from_buffers(pa.binary(), batch.num_rows, [valid, pa.py_buffer(ends.astype(np.int32)), data if data else pa.py_buffer(b"")])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], decoded], names=[*names, "_decoded"])

    return encoded.select(*dict.fromkeys([*names, ids])).mapInArrow(run, StructType([*kept, StructField("_decoded", BinaryType())]))
