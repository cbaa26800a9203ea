"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector with several functions floor((a.x + b) / w), a normal
and b uniform. A query visits, in each table, its own bucket and the buckets
next to it in the order of their estimated success: the smaller the squared
distances to the boundaries that a set of steps crosses, the sooner. What the
tables yield is merged and ranked by the exact distance.

Queries that found fewer ids than there are to find go on: with wider cells, by
their own distances to the rows, and at last against all rows, in blocks.

Equal vectors are one candidate with its smallest ids, as many as a result can
need. Buckets are dealt to slots, whose number follows the rows and is bounded;
a slot with many rows is cut into blocks of rows and of queries, so no task
holds more than a block of each, however hot a bucket is.

Vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without an id. Rows with one id
are found and searched under that id once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.shared import stage

TABLES, FUNCTIONS, WIDTH, PROBES = 6, 5, 1.0, 100
SAMPLE = 512
BLOCK = 4096
#: Rounds with wider cells before the rest is compared with all rows, which is done at once below this number of pairs.
WIDER_ROUNDS = 3
EXACT_PAIRS = 1 << 27
MOST_SLOTS = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v`` of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & finite & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else -1))


def classes_of(rows: DataFrame, most: int) -> DataFrame:
    """A row per distinct vector with its ``most`` smallest ids, ascending.

    The rank limit is applied before the shuffle too, so copies of one vector do
    not meet in one task.
    """
    rank = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= most)
    return few.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))


class Hashes:
    """The tables' functions for vectors of one length and scale."""

    def __init__(self, dimensions: int, scale: float, tables: int, functions: int, width: float, seed: int = 7):
        random = np.random.default_rng(seed)
        self.tables, self.functions = tables, functions
        self.width = width * scale
        self.a = random.normal(size=(dimensions, tables * functions))
        self.b = random.uniform(0, self.width, tables * functions)
        self.odd = random.integers(1, 2**63, functions + 1, dtype=np.uint64) | np.uint64(1)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """In units of the width, by vector, table and function."""
        return ((x @ self.a + self.b) / self.width).reshape(len(x), self.tables, self.functions)

    def keys(self, cells: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The bucket of integer cells in each of ``tables``."""
        key = (tables.astype(np.uint64) + np.uint64(1)) * self.odd[-1]
        for f in range(self.functions):
            key = (key ^ cells[..., f].astype(np.int64).view(np.uint64)) * self.odd[f]
            key ^= key >> np.uint64(32)
        return key.view(np.int64)

    def buckets(self, x: np.ndarray) -> np.ndarray:
        return self.keys(np.floor(self.cells(x)), np.broadcast_to(np.arange(self.tables), (len(x), self.tables)))

    def probes(self, x: np.ndarray, number: int) -> np.ndarray:
        """The buckets that a vector visits, by vector, table and order."""
        cells = self.cells(x)
        base = np.floor(cells)
        inside = cells - base
        out = np.repeat(base[:, :, None, :], number, axis=2)
        valid = np.zeros(out.shape[:3], bool)
        for i in range(len(x)):
            for t in range(self.tables):
                for n, steps in enumerate(_in_order(inside[i, t], number)):
                    valid[i, t, n] = True
                    for f, step in steps:
                        out[i, t, n, f] += step
        out[~valid] = np.broadcast_to(base[:, :, None, :], out.shape)[~valid]
        tables = np.broadcast_to(np.arange(self.tables)[None, :, None], out.shape[:3])
        return self.keys(out, tables)


class Everything:
    """One bucket that holds and is visited by all: the exact end."""

    tables = 1

    def buckets(self, x: np.ndarray) -> np.ndarray:
        return np.zeros((len(x), 1), np.int64)

    def probes(self, x: np.ndarray, number: int) -> np.ndarray:
        return np.zeros((len(x), 1, 1), np.int64)


def _in_order(inside: np.ndarray, number: int) -> Iterator[list[tuple[int, int]]]:
    """Sets of steps to neighbouring cells, the likeliest first; the empty set leads.

    Single steps are sorted by the squared distance to their boundary. A set's
    successors put its last step one further or add the next one, which reaches
    every set once and in order of the sum.
    """
    yield []
    steps = sorted([(d * d, f, -1) for f, d in enumerate(inside.tolist())] + [((1 - d) ** 2, f, 1) for f, d in enumerate(inside.tolist())])
    heap, found = [(steps[0][0], (0,))], 1
    while heap and found < number:
        cost, chosen = heapq.heappop(heap)
        if len({steps[i][1] for i in chosen}) == len(chosen):
            found += 1
            yield [steps[i][1:] for i in chosen]
        last = chosen[-1]
        if last + 1 < len(steps):
            further = steps[last + 1][0]
            heapq.heappush(heap, (cost - steps[last][0] + further, (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + further, (*chosen, last + 1)))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _slot_of(keys: np.ndarray, slots: int) -> np.ndarray:
    return ((keys.view(np.uint64) * _MIX) >> np.uint64(40)).astype(np.int64) % slots


def nearest(vectors: DataFrame, key: str, vector: str, is_query, k: int = 10, tables: int = TABLES, functions: int = FUNCTIONS, width: float = WIDTH, probes: int = PROBES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row for which the column ``is_query(id)`` holds.

    The scale of the cells is the median distance within the ``SAMPLE`` vectors
    with the smallest hashes; all vectors are indexed. Every query gets ``k``
    rows, or as many as there are other ids.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    classes = stage(classes_of(rows, k + 1), "vectors")
    queries = stage(rows.where(is_query(F.col("id"))).distinct().select("id", "v"), "queries")
    drawn = classes.orderBy(F.xxhash64("v"), "ids").limit(SAMPLE).toArrow()
    if not drawn.num_rows:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sample = _matrix(drawn["v"].combine_chunks())
    apart = np.sqrt(((sample[:, None] - sample[None]) ** 2).sum(2))[np.triu_indices(len(sample), 1)]
    scale = float(np.median(apart)) if len(apart) and np.median(apart) > 0 else 1.0
    number = classes.count()
    enough = min(k, rows.select("id").distinct().limit(k + 1).count() - 1)
    best = stage(_found(classes, number, queries, Hashes(sample.shape[1], scale, tables, functions, width), k, probes), "nearest")
    for n in range(WIDER_ROUNDS + 1):
        full = best.groupBy("query_id").count().where(F.col("count") >= enough).select(F.col("query_id").alias("id"))
        short = stage(queries.join(full, "id", "left_anti").select("id", "v"), "queries")
        left = short.count() if enough else 0
        if not left:
            break
        exact = n == WIDER_ROUNDS or left * number <= EXACT_PAIRS
        if not exact:
            own = _matrix(short.select("v").orderBy(F.xxhash64("v")).limit(SAMPLE).toArrow()["v"].combine_chunks())
            scale = max(2 * scale, float(np.median([np.median(np.sqrt(((sample - x) ** 2).sum(1))) for x in own])))
        hashes = Everything() if exact else Hashes(sample.shape[1], scale, tables, functions, width)
        more = _found(classes, number, short, hashes, k, probes)
        best = stage(_best(best.select("query_id", "vec_id", "score").unionByName(more.select("query_id", "vec_id", "score")), k), "nearest")
        if exact:
            break
    return best


def _best(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _found(classes: DataFrame, number: int, queries: DataFrame, hashes: Hashes | Everything, k: int, probes: int) -> DataFrame:
    """The ``k`` nearest of every query in the buckets that it visits."""
    spark = classes.sparkSession
    slots = 1 << min(MOST_SLOTS.bit_length() - 1, max(4, (number * hashes.tables // BLOCK).bit_length()))
    shared = spark.sparkContext.broadcast(hashes)

    def counted(keys_of):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(slots, np.int64)
            for batch in batches:
                if batch.num_rows:
                    own = _slot_of(keys_of(_matrix(batch.column("v"))), slots)
                    rows_of = np.arange(len(own))[:, None]
                    pairs = np.unique((rows_of * slots + own.reshape(len(own), -1)).ravel()) if own.ndim > 2 else None
                    total += np.bincount(own.ravel() if pairs is None else pairs % slots, minlength=slots)
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], names=["slot", "n"])

        return count

    def blocks(df: DataFrame, keys_of) -> np.ndarray:
        counts = df.select("v").mapInArrow(counted(keys_of), "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        out = np.ones(slots, np.int64)
        out[counts["slot"].to_numpy()] = -(-counts["n"].to_numpy() // BLOCK)
        return out

    row_blocks = blocks(classes, lambda x: shared.value.buckets(x))
    query_blocks = blocks(queries, lambda x: shared.value.probes(x, probes))
    cut = spark.sparkContext.broadcast((row_blocks, query_blocks))
    kind = classes.schema["v"].dataType.simpleString()

    def place_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_row, by_query = cut.value
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = shared.value.buckets(_matrix(batch.column("v")))
            first = np.array([ids[0] for ids in batch.column("ids").to_pylist()], np.int64)
            row = np.repeat(np.arange(len(keys)), keys.shape[1])
            key_, slot = keys.ravel(), _slot_of(keys.ravel(), slots)
            block = (((first.view(np.uint64) * _MIX) >> np.uint64(20)).astype(np.int64))[row] % by_row[slot]
            copies = by_query[slot]
            other = np.concatenate([np.arange(n) for n in copies]) if len(copies) else copies
            row, key_, slot, block = (np.repeat(x, copies) for x in (row, key_, slot, block))
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(block), pa.array(other), pa.array(key_), batch.column("ids").take(pa.array(row)), batch.column("v").take(pa.array(row))],
                names=["slot", "block", "query_block", "key", "ids", "v"],
            )

    def place_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_row, by_query = cut.value
        for batch in batches:
            out = {n: [] for n in ("slot", "block", "query_block", "id", "keys", "row")}
            if not batch.num_rows:
                continue
            keys = shared.value.probes(_matrix(batch.column("v")), probes)
            for i, (own_id, own) in enumerate(zip(batch.column("id").to_pylist(), keys)):
                own = np.unique(own)
                slot = _slot_of(own, slots)
                order = np.argsort(slot, kind="stable")
                own, slot = own[order], slot[order]
                bounds = np.flatnonzero(np.diff(slot, prepend=-1))
                for a, b in zip(bounds.tolist(), [*bounds[1:].tolist(), len(own)]):
                    s = int(slot[a])
                    part = (own_id * int(_MIX) >> 20 & 0xFFFFFFFF) % int(by_query[s])
                    for block in range(int(by_row[s])):
                        for name, value in zip(out, (s, block, part, own_id, own[a:b], i)):
                            out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["slot"], pa.int64()), pa.array(out["block"], pa.int64()), pa.array(out["query_block"], pa.int64()), pa.array(out["id"], pa.int64()),
                 pa.array(out["keys"], pa.list_(pa.int64())), batch.column("v").take(pa.array(out["row"], pa.int64()))],
                names=["slot", "block", "query_block", "id", "keys", "v"],
            )

    unit = ["slot", "block", "query_block"]
    base = classes.mapInArrow(place_rows, f"slot bigint, block bigint, query_block bigint, key bigint, ids array<bigint>, v {kind}")
    asked = queries.mapInArrow(place_queries, f"slot bigint, block bigint, query_block bigint, id bigint, keys array<bigint>, v {kind}")

    def search(_, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        return _search(rows, queries, k)

    found = base.groupBy(*unit).cogroup(asked.groupBy(*unit)).applyInPandas(search, "query_id bigint, vec_id bigint, score double")
    return _best(found, k)


def _search(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest of each query among the rows of the buckets that it visits."""
    out: list[tuple] = []
    if len(rows) and len(queries):
        order = np.argsort(rows["key"].to_numpy(), kind="stable")
        keys, vectors = rows["key"].to_numpy()[order], np.stack(rows["v"].to_numpy()[order]).astype(np.float64)
        ids = rows["ids"].to_numpy()[order]
        only = np.array([x[0] for x in ids], np.int64), np.array([len(x) == 1 for x in ids])
        for own, visited, vector in zip(queries["id"], queries["keys"], queries["v"]):
            starts, ends = np.searchsorted(keys, visited, "left"), np.searchsorted(keys, visited, "right")
            spans = [np.arange(a, b) for a, b in zip(starts, ends) if a < b]
            if not spans:
                continue
            at = np.concatenate(spans)
            at = at[~(only[1][at] & (only[0][at] == own))]  # other vectors of the query's own id
            score = np.sqrt(((vectors[at] - np.asarray(vector, np.float64)) ** 2).sum(1))
            if len(at) > k + 1:
                kept = score <= np.partition(score, k)[k]
                at, score = at[kept], score[kept]
            near = sorted({(s, i) for s, place in zip(score.tolist(), at.tolist()) for i in ids[place].tolist() if i != own})
            out += [(own, i, s) for s, i in near[:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
