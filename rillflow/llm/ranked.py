"""Ranked lexical search the other way round: documents stream through an index of the items.

The items' terms, a bounded block of them, make an inverted index that all
tasks share. A first pass counts, over all documents, how many hold each of
these terms, the documents and their terms. In the second every task streams
its documents' term counts through the index and keeps, for each item, a heap
of its ``k`` best; a document is offered to a heap only if it beats the heap's
last. The heaps' rows, at most ``k`` an item and task, are merged by rank. So
no document, posting or pair is shuffled, whatever the documents hold.

Items come in blocks of about ``BLOCK_BYTES`` of text and ``BLOCK_ITEMS``
items; each block passes over the documents twice. An item longer than that is
a block of its own.

Scores are 64-bit integers (see ``search``). A null text has no terms: such a
document is not counted, such an item finds nothing. Equal scores are ordered by
ascending ``doc_id``, null last; repeated documents and repeated items are rows
of their own. Other columns of either table are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.shared import NOT_ALPHANUMERIC, coded, ranges, slices, stage, words_of

BEST = 10
BLOCK_BYTES = 8 << 20
BLOCK_ITEMS = 4096
BATCH_BYTES = 2 << 20
CELLS = 1 << 20

_DOCUMENTS, _TERMS = -1, -2


@dataclass
class Index:
    """Items by term: the items that hold term ``t`` lie at ``starts[t]:starts[t + 1]``, with how often each holds it."""

    numbers: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    times: np.ndarray
    n_items: int

    @classmethod
    def of(cls, texts: list[str | None]) -> Index:
        words, offsets = words_of(pa.array(texts, pa.large_string()), NOT_ALPHANUMERIC)
        codes, distinct = coded(words) if len(words) else (np.zeros(0, np.int64), [])
        item = np.repeat(np.arange(len(texts)), np.diff(offsets))
        pair, times = np.unique(codes.astype(np.int64) * len(texts) + item, return_counts=True)
        term = pair // max(1, len(texts))
        starts = np.searchsorted(term, np.arange(len(distinct) + 1))
        return cls({t: i for i, t in enumerate(distinct)}, starts, pair % max(1, len(texts)), times, len(texts))

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a batch: text, term and occurrences of every indexed term that a text holds, and each text's number of terms."""
        words, offsets = words_of(texts, NOT_ALPHANUMERIC)
        sizes = np.diff(offsets)
        if not len(words) or not self.numbers:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), sizes
        codes, distinct = coded(words)
        get = self.numbers.get
        terms = np.fromiter((get(w, -1) for w in distinct), np.int64, len(distinct))[codes]
        held = terms >= 0
        pair, times = np.unique((np.repeat(np.arange(len(sizes)), sizes) * len(self.numbers) + terms)[held], return_counts=True)
        return pair // len(self.numbers), pair % len(self.numbers), times, sizes


def _statistics(docs: DataFrame, index: Index) -> tuple[np.ndarray, int, int]:
    """For each indexed term the documents that hold it; the documents with terms; all their terms."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        holding, documents, terms = np.zeros(len(own.numbers), np.int64), 0, 0
        for batch in slices(batches, limit=BATCH_BYTES):
            _, term, _, sizes = own.counts(batch.column("text"))
            holding += np.bincount(term, minlength=len(holding))
            documents += int((sizes > 0).sum())
            terms += int(sizes.sum())
        at = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, [_DOCUMENTS, _TERMS])), pa.array(np.append(holding[at], [documents, terms]))], names=["place", "n"]
        )

    total = docs.select("text").mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(total["place"].to_pylist(), total["n"].to_pylist()))
    holding = np.zeros(len(index.numbers), np.int64)
    for place, n in found.items():
        if place >= 0:
            holding[place] = n
    return holding, found.get(_DOCUMENTS, 0), found.get(_TERMS, 0)


@dataclass
class Scorer:
    index: Index
    weights: np.ndarray
    documents: int
    terms: int

    @classmethod
    def of(cls, index: Index, holding: np.ndarray, documents: int, terms: int) -> Scorer:
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in holding.tolist()]
        return cls(index, np.array(weights, np.int64), documents, terms)

    def scores(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """The place of a run of texts and their scores, texts by items, some texts at a time."""
        text, term, times, sizes = self.index.counts(texts)
        length = 25 + 75 * sizes * self.documents // max(1, self.terms)
        gain = self.weights[term] * (1_000_000_000 * times // (1000 * times + 8 * length[text]))
        step = max(1, CELLS // max(1, self.index.n_items))
        for first in range(0, len(sizes), step):
            size = min(step, len(sizes) - first)
            a, b = np.searchsorted(text, (first, first + size))
            starts, held = self.index.starts[term[a:b]], np.diff(self.index.starts)[term[a:b]]
            postings = ranges(starts, held)
            cell = np.repeat(text[a:b] - first, held) * self.index.n_items + self.index.items[postings]
            value = np.repeat(gain[a:b], held) * self.index.times[postings]
            yield first, _sums(cell, value, size * self.index.n_items).reshape(size, self.index.n_items)


def _sums(cell: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """Exact integer sums by cell: doubles hold them up to 2**53, larger ones are added in two halves."""
    if float(value.sum(dtype=np.float64)) < 2**53:
        return np.bincount(cell, value, size).astype(np.int64)
    low = np.bincount(cell, value & 0x1FFFFF, size).astype(np.int64)
    return low + (np.bincount(cell, value >> 21, size).astype(np.int64) << 21)


class Heaps:
    """The ``k`` best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)

    def offer(self, scores: np.ndarray, ids: list[int | None]) -> None:
        """``scores``: documents by items. Equal scores are told apart by id, so those of the heap's last are offered too."""
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        value = scores[row, item]
        # Of a run of documents only the best of each item can stay.
        known = np.array([i is not None for i in ids])
        number = np.array([0 if i is None else i for i in ids], np.int64)
        order = np.lexsort((number[row], ~known[row], -value, item))
        item, row, value = item[order], row[order], value[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        for i, r, v in zip(*(x[place < self.k].tolist() for x in (item, row, value))):
            heap, entry = self.heaps[i], (v, ids[r] is not None, -(ids[r] or 0))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.least[i] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for item, heap in enumerate(self.heaps):
            for score, known, negative in heap:
                yield item, -negative if known else None, score


def _best(docs: DataFrame, scorer: Scorer, k: int) -> DataFrame:
    """``_place, doc_id, score``: the heaps of all tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        heaps = Heaps(own.index.n_items, k)
        for batch in slices(batches, limit=BATCH_BYTES):
            ids = batch.column("doc_id").to_pylist()
            for first, scores in own.scores(batch.column("text")):
                heaps.offer(scores, ids[first:first + len(scores)])
        rows = list(heaps.rows())
        place, doc, score = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], names=["_place", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(search, "_place bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, block_bytes: int = BLOCK_BYTES, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 for every item.

    With N documents that have terms, L terms in them, n in one, of which a term
    is tf and is held by df documents: the term weighs
    w = floor(1000 ln((2N + 2) / (2df + 1))) and adds w (10^9 tf div (1000 tf + 8m)),
    m = 25 + 75 n N div L, for each time that the item holds it.
    """
    spark = docs.sparkSession
    given = stage(items.select("item_id", "text", F.monotonically_increasing_id().alias("_row")), "items")
    size, number = given.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = max(1, -(-(size or 0) // block_bytes), -(-number // block_items))
    found = []
    for part in range(parts):
        block = given.where(F.pmod(F.xxhash64("_row"), F.lit(parts)) == part).orderBy("_row").collect()
        index = Index.of([r["text"] for r in block])
        if not index.numbers:
            continue
        best = stage(_best(docs, Scorer.of(index, *_statistics(docs, index)), k), "best")
        rows = spark.createDataFrame([(i, r["_row"]) for i, r in enumerate(block)], "_place bigint, _row bigint")
        found.append(best.join(rows, "_place").select("_row", "doc_id", "score"))
    if not found:
        return given.where("false").select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("_row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(given.select("_row", "item_id"), "_row").select("item_id", "rank", "doc_id", "score")
