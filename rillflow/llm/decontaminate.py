"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of 13 words (all its words, if fewer). A window
is a set of word shingles, and a document that contains the window contains all
of them, so one necessary shingle is enough to join on: the window's rarest in
the corpus. A shingle that hits says where the window would start; starts that
leave the document's bounds are dropped, the others are compared word for word.

The benchmark is read in blocks of bounded size, each shared with all tasks;
every block passes over all documents. Ranges found by several blocks are
united. Null and empty texts have no words. Repeated items count under each of
their ids, repeated documents each for itself, other columns pass through.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from rillflow.llm.shared import NOT_ALPHANUMERIC, ranges, slices, stage, sums_between, words_of

WINDOW = 13
SHINGLE = 4
BLOCK_BYTES = 8 << 20
BATCH_BYTES = 1 << 20
COMPARED = 1 << 18

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _codes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` word numbers; 0 where a word is in no item."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    code = np.full(n, size, np.uint64)
    known = np.ones(n, bool)
    for k in range(size):
        part = ids[k:k + n]
        known &= part > 0
        code = (code ^ part.astype(np.uint64)) * _ODD
        code ^= code >> np.uint64(31)
    code *= _MIX
    return np.where(known, code | np.uint64(1), np.uint64(0))


@dataclass
class Block:
    """One block of the benchmark: its words, windows and shingles."""

    vocabulary: pa.Array
    windows: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]
    shingles: np.ndarray
    sizes: np.ndarray
    members: list[np.ndarray]

    @staticmethod
    def of(items: list[tuple[str, str]], window: int = WINDOW) -> Block:
        words, offsets = words_of(pa.array([text for _, text in items], pa.string()), NOT_ALPHANUMERIC)
        encoded = words.dictionary_encode()
        ids = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        holders: dict[bytes, set[str]] = defaultdict(set)
        for (item, _), a, b in zip(items, offsets[:-1].tolist(), offsets[1:].tolist()):
            length = min(window, b - a)
            for at in range(a, b - length + 1 if length else a):
                holders[ids[at:at + length].tobytes()].add(item)
        keys = list(holders)
        lengths = np.array([len(k) // 8 for k in keys], np.int64)
        windows = np.zeros((len(keys), window), np.int64)
        for row, key in zip(windows, keys):
            row[:len(key) // 8] = np.frombuffer(key, np.int64)
        sizes = np.minimum(lengths, SHINGLE)
        members = [_codes(w[:n], s) for w, n, s in zip(windows, lengths, sizes)]
        every = np.unique(np.concatenate(members)) if members else np.zeros(0, np.uint64)
        return Block(encoded.dictionary, windows, lengths, [sorted(holders[k]) for k in keys], every, np.unique(sizes), members)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Each word's number in the block, 0 for words of no item."""
        if pa.types.is_large_binary(words.type):
            words = words.cast(pa.binary()) if words.nbytes < 2**31 else pa.concat_arrays([w.cast(pa.binary()) for w in _parts(words)])
        return pc.fill_null(pc.index_in(words, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """By shingle size: where the ids hold one of the block's shingles, and which."""
        for size in self.sizes.tolist():
            codes = _codes(ids, size)
            at = np.flatnonzero(codes)
            place = np.minimum(np.searchsorted(self.shingles, codes[at]), len(self.shingles) - 1)
            same = self.shingles[place] == codes[at]
            yield size, at[same], place[same]

    def prefixes(self, holding: np.ndarray) -> None:
        """Joins every window by its rarest shingle, given how often the corpus holds each."""
        chosen, offset = np.zeros(len(self.members), np.int64), np.zeros(len(self.members), np.int64)
        for w, codes in enumerate(self.members):
            places = np.searchsorted(self.shingles, codes)
            offset[w] = np.lexsort((np.arange(len(places)), places, holding[places]))[0]
            chosen[w] = places[offset[w]]
        order = np.argsort(chosen, kind="stable")
        self.window_of, self.offset_of = order, offset[order]
        self.first = np.searchsorted(chosen[order], np.arange(len(self.shingles)))
        self.number = np.bincount(chosen, minlength=len(self.shingles))
        self.members = []


def _parts(words: pa.Array):
    step = max(1, len(words) // (words.nbytes // 2**30 + 1))
    return [words.slice(i, step) for i in range(0, len(words), step)]


def _contained(block: Block, ids: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Start and number of every window that a text contains, in runs of bounded size."""
    for _, at, shingle in block.hits(ids):
        kept = block.number[shingle] > 0
        at, shingle = at[kept], shingle[kept]
        ends = np.cumsum(block.number[shingle])
        begin = 0
        while begin < len(at):
            done = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, done + COMPARED, side="right")))
            number = block.number[shingle[begin:stop]]
            place = ranges(block.first[shingle[begin:stop]], number)
            window = block.window_of[place]
            start = np.repeat(at[begin:stop], number) - block.offset_of[place]
            begin = stop
            length = block.lengths[window]
            text = np.searchsorted(offsets, np.maximum(start, 0), side="right") - 1
            inside = (start >= 0) & (text < len(offsets) - 1)
            inside[inside] &= start[inside] + length[inside] <= offsets[text[inside] + 1]
            # The shingle itself must lie in the same text.
            hit = start + block.offset_of[place]
            inside[inside] &= hit[inside] < offsets[text[inside] + 1]
            start, window, length = start[inside], window[inside], length[inside]
            reach = np.arange(block.windows.shape[1])
            seen = ids[np.minimum(start[:, None] + reach, len(ids) - 1)]
            same = ((seen == block.windows[window]) | (reach >= length[:, None])).all(1)
            yield start[same], window[same]


def _item_blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The benchmark cut by a hash into parts of about ``block_bytes``."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // block_bytes))
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) for part in range(parts)]


def _holding(docs: DataFrame, block: Block) -> np.ndarray:
    """How often all documents hold each of the block's shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total = np.zeros(len(own.shingles), np.int64)
        for batch in slices(batches, limit=BATCH_BYTES):
            words, _ = words_of(batch.column("text"), NOT_ALPHANUMERIC)
            for _, _, place in own.hits(own.numbers(words)):
                total += np.bincount(place, minlength=len(total))
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], names=["place", "n"])

    counts = docs.select("text").mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(block.shingles), np.int64)
    out[counts["place"].to_numpy()] = counts["n"].to_numpy()
    return out


FOUND = [
    StructField("_n_words", LongType()), StructField("_hit_from", ArrayType(LongType())), StructField("_hit_to", ArrayType(LongType())),
    StructField("_items", ArrayType(StringType())),
]


def _marked(docs: DataFrame, block: Block, again: bool) -> DataFrame:
    """``docs`` with the columns of ``FOUND``; ``again``: united with those that it has."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    kept = [f for f in docs.schema.fields if f.name not in ("_n_words", "_hit_from", "_hit_to", "_items")]
    columns = [f.name for f in kept]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in slices(batches, limit=BATCH_BYTES):
            words, offsets = words_of(batch.column("text"), NOT_ALPHANUMERIC)
            ids = own.numbers(words)
            change = np.zeros(len(ids) + 1, np.int64)
            items = [set() for _ in range(batch.num_rows)]
            if again:
                n, rows = batch.num_rows, {c: batch.column(c).to_pylist() for c in ("_hit_from", "_hit_to", "_items")}
                for i in range(n):
                    change[np.array(rows["_hit_from"][i], np.int64) + offsets[i]] += 1
                    np.add.at(change, np.array(rows["_hit_to"][i], np.int64) + offsets[i], -1)
                    items[i].update(rows["_items"][i])
            for start, window in _contained(own, ids, offsets):
                np.add.at(change, start, 1)
                np.add.at(change, start + own.lengths[window], -1)
                text = np.searchsorted(offsets, start, side="right") - 1
                for pair in np.unique(text << 32 | window).tolist():
                    items[pair >> 32].update(own.items[pair & 0xFFFFFFFF])
            hit = np.cumsum(change[:-1]) > 0
            edge = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
            # A range ends where its text ends, though the next text may begin with a hit.
            heads = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(hit))]
            cut = np.unique(heads[hit[heads - 1] & hit[heads]]) if len(heads) else heads
            begin = np.sort(np.concatenate([np.flatnonzero(edge == 1), cut]))
            end = np.sort(np.concatenate([np.flatnonzero(edge == -1), cut]))
            bounds = np.searchsorted(begin, offsets)
            base = np.repeat(offsets[:-1], np.diff(bounds))
            as_list = lambda x: pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns] + [pa.array(np.diff(offsets)), as_list(begin - base), as_list(end - base), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                names=columns + ["_n_words", "_hit_from", "_hit_to", "_items"],
            )

    return docs.mapInArrow(mark, StructType(kept + FOUND))


def mark(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``_n_words``, the word ranges that benchmark windows cover and the items these are of.

    Columns of these names that ``docs`` has are replaced.
    """
    out, blocks = docs, _item_blocks(benchmark, block_bytes)
    for number, part in enumerate(blocks):
        block = Block.of([(r["item_id"], r["text"]) for r in part.collect()])
        if len(block.shingles):
            block.prefixes(_holding(docs, block))
        else:
            block.number = np.zeros(0, np.int64)
        out = _marked(out, block, number > 0)
        if len(blocks) > 1:
            out = stage(out, "marked")
    return out


def with_decision(marked: DataFrame) -> DataFrame:
    """Adds ``_n_hit`` and ``_contaminated``: a twentieth of the words, or more, are hit."""
    hit = F.aggregate(F.zip_with("_hit_from", "_hit_to", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda x, y: x + y)
    return marked.withColumn("_n_hit", hit).withColumn("_contaminated", (F.col("_n_hit") > 0) & (F.col("_n_hit") * 20 >= F.col("_n_words")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    return with_decision(mark(docs, benchmark)).where(~F.col("_contaminated")).select(*docs.columns)
