"""Packing by lexical retrieval.

Every document is cut into full windows; what is left of it, its tail, is packed
with the tails of documents that resemble it. Documents are dealt to shards by
likeness over the whole corpus: a random projection of a document's BM25 weights
goes down a tree of halving planes, learned from a bounded sample; neighbouring
leaves share a shard, leaves with more documents than a shard holds are split. A
shard has an inverted index of its documents' tokens, weighted by BM25 with
document frequencies and mean length of the whole corpus. Neighbours come from
the seed's shard; README gives the share of the best ones found. A window
starts with the first unused tail and takes its unused neighbours, best first;
the one that does not fit is cut, and its rest starts the next window. So only
a shard's last window is not full.

A null or empty text has its end id alone. Repeated rows are packed as often as
they occur. Columns beyond the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.shared import BATCH_BYTES, ranges, slices, stage, task_number
from rillflow.llm.tokens import CACHE_PIECES, encoder, with_end

WINDOW = 1024
SHARD_DOCS = 2048
#: Terms in more than one of this many tails of a shard have a row of scores each, the others a list.
COMMON = 8
K1, B = 1.2, 0.75
SKETCH = 128
LEAVES_PER_SHARD = 4
SAMPLE_PER_LEAF, MOST_SAMPLE = 32, 1 << 15
_TOKENS = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("full_crcs", pa.binary()), ("tail", pa.binary()), ("bag", pa.binary()),
    ("terms", pa.list_(pa.int32())), ("holders", pa.list_(pa.int64())),
])
_TOKENS_SQL = "row bigint, doc_id bigint, doc_tokens bigint, full_crcs binary, tail binary, bag binary, terms array<int>, holders array<bigint>"
PIECE_SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def tokenized(docs: DataFrame, tokenizer: str, end: int, window: int = WINDOW, batch_bytes: int = BATCH_BYTES, pieces: int = CACHE_PIECES) -> DataFrame:
    """A row per document with checksums of its full windows, its tail's ids and, if that is not all of it, its
    distinct ids and their numbers (``bag``), and a row per task with the number of its documents that hold each
    token (``terms, holders``)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = task_number() << 40
        encode = encoder(tokenizer, pieces).encode
        holders = np.zeros(1 << 16, np.int64)
        for batch in slices(batches, limit=batch_bytes):
            ids, counts = with_end(*encode(batch.column("text")), end)
            if ids.max() >= len(holders):
                holders = np.concatenate([holders, np.zeros(int(ids.max()) + 1 - len(holders), np.int64)])
            out = {name: [] for name in ("row", "doc_id", "doc_tokens", "full_crcs", "tail", "bag")}
            at = 0
            ids = ids.astype("<u4")
            # One sort for all documents of the batch: each one's distinct ids and their numbers lie together.
            owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
            both, times = np.unique((owner << np.uint64(32)) | ids, return_counts=True)
            distinct = (both & np.uint64(0xFFFFFFFF)).astype("<u4")
            holders += np.bincount(distinct, minlength=len(holders))
            bounds = np.searchsorted(both, np.arange(len(counts) + 1, dtype=np.uint64) << np.uint64(32)).tolist()
            for key, n, a, b in zip(batch.column("doc_id").to_pylist(), counts.tolist(), bounds, bounds[1:]):
                own = ids[at:at + n]
                full = n // window * window
                out["row"].append(number)
                out["doc_id"].append(key)
                out["doc_tokens"].append(n)
                out["full_crcs"].append(np.array([zlib.crc32(own[i:i + window]) for i in range(0, full, window)], "<u4").tobytes())
                out["tail"].append(_packed(own[full:]))
                out["bag"].append(_packed(np.concatenate([distinct[a:b], times[a:b]])) if full else None)
                at, number = at + n, number + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], f.type) if f.name in out else pa.nulls(len(counts), f.type) for f in _TOKENS], schema=_TOKENS
            )
        terms = np.flatnonzero(holders)
        if len(terms):
            yield pa.RecordBatch.from_pylist([{"terms": terms.tolist(), "holders": holders[terms].tolist()}], _TOKENS)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(rows, _TOKENS_SQL)


def _packed(ids: np.ndarray) -> bytes:
    """Two bytes an id where all fit, else four; the first byte says which."""
    if len(ids) and ids.max() > 0xFFFF:
        return b"\4" + ids.astype("<u4").tobytes()
    return b"\2" + ids.astype("<u2").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype("<u4")


def _bag(tail: bytes, bag: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids of the whole document and how often each occurs."""
    if bag is None:
        return np.unique(_unpacked(tail), return_counts=True)
    both = _unpacked(bag)
    return both[:len(both) // 2], both[len(both) // 2:].astype(np.int64)


def sketches(bags: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, mean_length: float) -> np.ndarray:
    """A unit vector for each document: its terms' BM25 weights, randomly projected."""
    signs = _signs(len(weight))
    out = np.zeros((len(bags), SKETCH), np.float32)
    for i, (terms, times) in enumerate(bags):
        norm = K1 * (1 - B + B * times.sum() / mean_length)
        out[i] = (weight[terms] * times * (K1 + 1) / (times + norm)).astype(np.float32) @ signs[terms]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


@lru_cache(1)
def _signs(terms: int) -> np.ndarray:
    return np.random.default_rng(20240607).choice(np.array([-1, 1], np.float32), (terms, SKETCH))


def tree_of(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Planes that part the sample ``depth`` times: normals and thresholds, by node.

    A node's two means, found from the halves along its main axis, give the
    normal; the plane lies where vectors are fewest, between the quarters.
    """
    normals, limits = np.zeros(((1 << depth) - 1, sample.shape[1]), np.float32), np.zeros((1 << depth) - 1, np.float32)
    parts = [sample]
    for node in range(len(limits)):
        own = parts[node]
        if len(own) > 1:
            centred = own - own.mean(0)
            axis = centred[np.argmax((centred**2).sum(1))]
            for _ in range(8):
                axis = centred.T @ (centred @ axis)
                axis /= max(1e-12, float(np.linalg.norm(axis)))
            right = centred @ axis > np.median(centred @ axis)
            for _ in range(8):
                if right.all() or not right.any():
                    break
                axis = centred[right].mean(0) - centred[~right].mean(0)
                right = centred @ axis > (centred[right].mean(0) + centred[~right].mean(0)) @ axis / 2
            along = own @ axis
            ordered, near = np.sort(along), max(1, len(own) // 32)
            at = np.arange(max(1, len(own) // 4), max(1, len(own) * 3 // 4) + 1)
            gaps = ordered[np.minimum(at + near - 1, len(own) - 1)] - ordered[np.maximum(at - near, 0)]
            best = at[np.argmax(gaps)]
            normals[node], limits[node] = axis, (ordered[best - 1] + ordered[best]) / 2
            right = along > limits[node]
            parts += [own[~right], own[right]]
        else:
            parts += [own, own[:0]]
        parts[node] = None
    return normals, limits


def leaf_of(vectors: np.ndarray, tree: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    normals, limits = tree
    node = np.zeros(len(vectors), np.int64)
    for _ in range((len(limits) + 1).bit_length() - 1):
        node = 2 * node + 1 + (np.einsum("ij,ij->i", vectors, normals[node]) > limits[node])
    return node - len(limits)


def _dealt(counts: dict[int, int], shard_docs: int) -> list[tuple[int, int, int]]:
    """Leaf, first shard and number of shards: neighbouring leaves share one, large ones are split."""
    out, shard, filled = [], -1, shard_docs
    for leaf, n in sorted(counts.items()):
        parts = -(-n // shard_docs)
        if filled + n > shard_docs:
            shard, filled = shard + 1, 0
        out.append((leaf, shard, parts))
        shard, filled = shard + parts - 1, (filled + n if parts == 1 else shard_docs)
    return out


def sharded(rows: DataFrame, total: int, weight: np.ndarray, mean_length: float, shard_docs: int) -> DataFrame:
    """``rows`` with the ``shard`` of each document. Leaves are staged, as they are counted first."""
    spark = rows.sparkSession
    depth = max(0, (LEAVES_PER_SHARD * (total - 1) // shard_docs).bit_length()) if total > shard_docs else 0
    if not depth:
        return rows.withColumn("shard", F.lit(0).cast("bigint"))
    shared = spark.sparkContext.broadcast((weight, mean_length))

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = sketches([_bag(*x) for x in zip(batch.column("tail").to_pylist(), batch.column("bag").to_pylist())], *shared.value)
            yield pa.RecordBatch.from_arrays([pa.array(vectors.tolist(), pa.list_(pa.float32()))], names=["v"])

    drawn = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < min(MOST_SAMPLE, SAMPLE_PER_LEAF << depth) / total * (1 << 20)
    sample = rows.where(drawn).select("tail", "bag").mapInArrow(sketched, "v array<float>").toArrow()["v"].combine_chunks()
    tree = spark.sparkContext.broadcast(tree_of(sample.flatten().to_numpy().reshape(-1, SKETCH), depth))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = sketches([_bag(*x) for x in zip(batch.column("tail").to_pylist(), batch.column("bag").to_pylist())], *shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf_of(vectors, tree.value), pa.int64())], names=[*batch.schema.names, "leaf"])

    kept = stage(rows.mapInArrow(placed, _TOKENS_SQL.partition(", terms")[0] + ", leaf bigint"), "packing-leaves")
    counts = {r["leaf"]: r["count"] for r in kept.groupBy("leaf").count().collect()}
    places = spark.createDataFrame(_dealt(counts, shard_docs), "leaf bigint, first bigint, parts bigint")
    return kept.join(F.broadcast(places), "leaf").withColumn("shard", F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))).drop("leaf", "first", "parts")


def pack(
    docs: DataFrame, tokenizer: str, end: int, window: int = WINDOW, shard_docs: int = SHARD_DOCS, batch_bytes: int = BATCH_BYTES, pieces: int = CACHE_PIECES,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` for every piece.

    Staged: ids of tails and token counts, read twice. The frequencies have a
    row for each token of the vocabulary, whatever the corpus, and go to all tasks.
    ``batch_bytes`` and ``pieces`` bound a worker's memory while it encodes.
    """
    staged = stage(tokenized(docs, tokenizer, end, window, batch_bytes, pieces), "packing")
    counts = staged.where("terms IS NOT NULL").select(F.explode(F.arrays_zip("terms", "holders")).alias("x"))
    frequencies = counts.groupBy("x.terms").agg(F.sum("x.holders").alias("n")).collect()
    rows = staged.where("terms IS NULL").drop("terms", "holders")
    total, tokens = rows.agg(F.count("row"), F.sum("doc_tokens")).first()
    if not total:
        return docs.sparkSession.createDataFrame([], PIECE_SCHEMA)
    weight = np.zeros(max((r["terms"] for r in frequencies), default=0) + 1)
    for r in frequencies:
        weight[r["terms"]] = np.log1p((total - r["n"] + 0.5) / (r["n"] + 0.5))
    mean_length = max(1.0, float(tokens) / total)
    shared = docs.sparkSession.sparkContext.broadcast((weight, mean_length))

    def pack_shard(frame: pd.DataFrame) -> pd.DataFrame:
        return _pack_shard(frame.sort_values("row"), *shared.value, window)

    return sharded(rows, total, weight, mean_length, shard_docs).groupBy("shard").applyInPandas(pack_shard, PIECE_SCHEMA)


class Index:
    """BM25 over one shard's documents: their tails, or ``bags`` of distinct ids and their numbers."""

    def __init__(self, tails: list[np.ndarray], weight: np.ndarray, mean_length: float, bags: list[tuple[np.ndarray, np.ndarray]] | None = None):
        bags = bags if bags is not None else [np.unique(t, return_counts=True) for t in tails]
        owner = np.repeat(np.arange(len(tails)), [len(terms) for terms, _ in bags])
        pairs = np.concatenate([terms for terms, _ in bags]).astype(np.int64) << 32 | owner if bags else np.zeros(0, np.int64)
        times = np.concatenate([n for _, n in bags]) if bags else np.zeros(0, np.int64)
        order = np.argsort(pairs, kind="stable")
        pairs, times = pairs[order], times[order]
        term, self.holder = pairs >> 32, (pairs & 0xFFFFFFFF).astype(np.int64)
        lengths = np.array([n.sum() for _, n in bags])
        norm = K1 * (1 - B + B * lengths / mean_length)
        self.weight = weight[term] * times * (K1 + 1) / (times + norm[self.holder])
        self.terms, self.starts = np.unique(term, return_index=True)
        self.ends = np.append(self.starts[1:], len(term))
        by_doc = np.argsort(self.holder, kind="stable")
        self.own = np.split(by_doc, np.cumsum(np.bincount(self.holder, minlength=len(tails)))[:-1]) if len(tails) else []
        self.place = np.searchsorted(self.terms, term)
        self.size = len(tails)
        common = (self.ends - self.starts) * COMMON > self.size
        self.row_of = np.where(common, np.cumsum(common) - 1, -1)
        self.rows = np.zeros((int(common.sum()), self.size), np.float32)
        held = common[self.place]
        self.rows[self.row_of[self.place[held]], self.holder[held]] = self.weight[held]

    def scores(self, seed: int) -> np.ndarray:
        """Of every tail for all of the seed's terms."""
        at = self.place[self.own[seed]]
        rows = self.row_of[at]
        rare = at[rows < 0]
        found = ranges(self.starts[rare], self.ends[rare] - self.starts[rare])
        return np.bincount(self.holder[found], self.weight[found], minlength=self.size) + self.rows[rows[rows >= 0]].sum(0)


def _pack_shard(frame: pd.DataFrame, weight: np.ndarray, mean_length: float, window: int) -> pd.DataFrame:
    shard = int(frame["shard"].iloc[0])
    keys, doc_tokens = frame["doc_id"].astype("object").where(frame["doc_id"].notna(), None).tolist(), frame["doc_tokens"].tolist()
    tails = [_unpacked(t) for t in frame["tail"]]
    pieces: list[tuple] = []
    sequence = shard << 32
    for i, crcs in enumerate(frame["full_crcs"]):
        for k, crc in enumerate(np.frombuffer(crcs, "<u4").tolist()):
            pieces.append((keys[i], k * window, window, crc, doc_tokens[i], sequence, 0))
            sequence += 1
    bags = [_bag(*x) for x in zip(frame["tail"], frame["bag"])] if "bag" in frame else None
    index = Index(tails, weight, mean_length, bags)
    unused = np.array([len(t) > 0 for t in tails], bool)
    taken = [0] * len(tails)
    filled, first = 0, 0

    def put(i: int) -> None:
        nonlocal filled
        part = tails[i][taken[i]:taken[i] + window - filled]
        start = doc_tokens[i] - len(tails[i]) + taken[i]
        pieces.append((keys[i], start, len(part), zlib.crc32(part), doc_tokens[i], sequence, filled))
        taken[i] += len(part)
        filled += len(part)

    seed = None
    while True:
        if seed is None or taken[seed] == len(tails[seed]):
            while first < len(tails) and not unused[first]:
                first += 1
            if first == len(tails):
                break
            seed = first
            unused[seed] = False
        put(seed)
        last = seed
        if filled < window:
            scores = np.where(unused, index.scores(seed), -1.0)
            for i in _best_first(scores):
                unused[i] = False
                put(i)
                last = i
                if filled == window:
                    break
        if filled < window:
            break
        sequence, filled, seed = sequence + 1, 0, last
    return pd.DataFrame(pieces, columns=[c.split()[0] for c in PIECE_SCHEMA.split(", ")]).astype({"doc_id": "Int64"})


def _best_first(scores: np.ndarray) -> Iterator[int]:
    """Unused tails by falling score, ties by position; sorted in growing parts, as few are needed."""
    size, done = 16, 0
    open_ = np.flatnonzero(scores >= 0)
    while done < len(open_):
        if size < len(open_):
            least = -np.partition(-scores[open_], size - 1)[size - 1]
            top = open_[scores[open_] >= least]
        else:
            top = open_
        ordered = top[np.lexsort((top, -scores[top]))]
        yield from ordered[done:].tolist()
        done, size = len(ordered), size * 4
