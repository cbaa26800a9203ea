"""Near-duplicate groups by a multi-index Hamming join of b-bit MinHash signatures.

A document is the set of its word shingles. Its signature keeps 16 bits of each
of 40 MinHash values and is split into 10 chunks of 4. Two signatures that
differ in at most 19 values have, by the pigeonhole principle, a chunk that
differs in at most one; each chunk is therefore indexed once for every value
that may be wrong, without that value. So all pairs within the distance share a
key, and at a similarity of 0.8 a pair is missed with a chance below one in ten
million. Every link is confirmed on the full sets.

Copies are no problem of pairs: documents with equal sets are one node. Of a
key's nodes each is first compared with the smallest; only nodes that this
leaves in different groups are compared with each other, in blocks, by tasks
that give links and never pairs.

Null or empty texts have no shingles and stand alone, as do texts of blanks. A
text of fewer words than a shingle is one shingle. Equal rows, or rows with one
id and different texts, are rows of their own; a null id is never a group's id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.shared import BLANKS, coded, free_name, ranges, slices, stage, sums_between, task_number, words_of
from rillflow.operators.lookup import BROADCAST_BYTES, measured_bytes

SHINGLE = 4
VALUES, CHUNK = 40, 4
PERCENT = 80
BITMAP_BITS = 1 << 26
BLOCK_NODES = 512
CELL_HASHES = 500_000
BATCH_BYTES = 1 << 20
COLUMNS = 4096

_SEEDS = np.random.default_rng(20240607).integers(1, 2**63, (2, VALUES), dtype=np.uint64) | np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, ascending, one text after another, and each text's number."""
    words, offsets = words_of(texts, BLANKS)
    counts = np.diff(offsets)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    codes, distinct = coded(words)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))[codes]
    rolled = hashes.copy()
    shorter = {}
    for k in range(1, size):
        shorter[k] = rolled
        rolled = _mixed(rolled[:-1] * _ODD + hashes[k:]) if len(rolled) > 1 else rolled[:0]
    long = counts >= size
    number = np.where(long, counts - size + 1, np.minimum(counts, 1))
    out = np.empty(int(number.sum()), np.uint64)
    starts = np.cumsum(number) - number
    out[ranges(starts[long], number[long])] = rolled[ranges(offsets[:-1][long], number[long])]
    for k, values in shorter.items():
        here = counts == k
        out[starts[here]] = values[offsets[:-1][here]] + np.uint64(k)
    bounds = np.append(starts, len(out))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        out[a:b].sort()
    first = np.ones(len(out), bool)
    first[1:] = out[1:] != out[:-1]
    first[starts[number > 0]] = True
    return out[first], sums_between(first.astype(np.int64), bounds)


def _digests(hashes: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
    """128 bits for each set; None for the empty one."""
    full = counts > 0
    starts = (np.cumsum(counts) - counts)[full]
    out = np.zeros((len(counts), 2), "<u8")
    if len(starts):
        out[full, 0] = np.add.reduceat(_mixed(hashes ^ _SEEDS[0, 0]), starts)
        out[full, 1] = np.add.reduceat(_mixed(hashes + _SEEDS[1, 1]), starts)
    return [d.tobytes() if ok else None for d, ok in zip(out, full)]


def signatures(docs: DataFrame, row: str | None = None) -> DataFrame:
    """``row, doc_id, n_shingles, digest, signature``; a set's digest and signature are null when it is empty.

    ``row``: a column that numbers the rows; without one they are numbered here.
    """
    schema = "row bigint, doc_id bigint, n_shingles bigint, digest binary, signature binary"
    own = row is not None

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = task_number() << 40
        for batch in slices(batches, limit=BATCH_BYTES):
            hashes, counts = shingle_sets(batch.column("text"))
            full = np.flatnonzero(counts)
            starts = (np.cumsum(counts) - counts)[full]
            values = np.zeros((len(counts), VALUES), "<u2")
            for k in range(VALUES if len(full) else 0):
                least = np.minimum.reduceat((hashes ^ _SEEDS[0, k]) * _SEEDS[1, k], starts)
                values[full, k] = least & np.uint64(0xFFFF)
            signed = [v.tobytes() if n else None for v, n in zip(values, counts)]
            rows = batch.column("row") if own else pa.array(np.arange(number, number + len(counts)))
            number += len(counts)
            yield pa.RecordBatch.from_arrays([
                rows, batch.column("doc_id"), pa.array(counts), pa.array(_digests(hashes, counts), pa.binary()), pa.array(signed, pa.binary()),
            ], names=["row", "doc_id", "n_shingles", "digest", "signature"])

    numbered = [F.col(row).cast("bigint").alias("row")] if own else []
    return docs.select(F.col("doc_id").cast("bigint"), "text", *numbered).mapInArrow(sign, schema)


def index_keys(nodes: DataFrame) -> DataFrame:
    """``key, node``: a key for each chunk and each of its values left out."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2").reshape(n, VALUES // CHUNK, CHUNK).astype(np.int64)
            out = np.empty((n, VALUES // CHUNK, CHUNK), np.int64)
            for left_out in range(CHUNK):
                key = np.zeros((n, VALUES // CHUNK), np.int64)
                for at in range(CHUNK):
                    if at != left_out:
                        key = key << 16 | values[:, :, at]
                out[:, :, left_out] = key | np.arange(VALUES // CHUNK) * CHUNK + left_out << 48
            yield pa.RecordBatch.from_arrays([
                pa.array(out.reshape(-1)), pa.array(np.repeat(batch.column("node").to_numpy(zero_copy_only=False), VALUES)),
            ], names=["key", "node"])

    return nodes.select("node", "signature").mapInArrow(keys, "key bigint, node bigint")


def _bitmap(keys: DataFrame, key: Column, bits: int) -> np.ndarray:
    """A bitmap of the keys' hashes: at most ``bits`` bits, so its size is bounded whatever the input."""
    place = keys.select(F.pmod(key, F.lit(bits)).alias("p"))
    parts = place.groupBy(F.expr("shiftright(p, 6)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(pmod(p, 64) AS int)))").alias("b")).toArrow()
    out = np.zeros(bits // 64, "<i8")
    out[parts["w"].to_numpy()] = parts["b"].to_numpy()
    return out.view(np.uint8)


def _key_of(digests: list[bytes], doc_ids: list) -> np.ndarray:
    """The bitmap's place of a set as held by a document."""
    heads = np.frombuffer(b"".join(d[:8] for d in digests), "<i8")
    own = np.array([0 if i is None else i for i in doc_ids], np.int64)
    return _mixed(heads.view(np.uint64) ^ own.view(np.uint64) * _ODD).view(np.int64) & np.int64(2**62 - 1)


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, hashes`` of the nodes in ``wanted`` (``node, digest, min_doc``).

    Tasks compute the sets again and let only those pass that a bitmap of the
    wanted may hold, so no text and no other set is shuffled.
    """
    spark = docs.sparkSession

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_key_of(batch.column("digest").to_pylist(), batch.column("min_doc").to_pylist()))], names=["place"])

    keys = wanted.select("digest", "min_doc").mapInArrow(places, "place bigint")
    bits = min(BITMAP_BITS, max(1 << 16, 1 << (16 * max(1, wanted.count())).bit_length()))
    shared = spark.sparkContext.broadcast(_bitmap(keys, F.col("place"), bits))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in slices(batches, limit=BATCH_BYTES):
            hashes, counts = shingle_sets(batch.column("text"))
            digests = _digests(hashes, counts)
            full = np.flatnonzero(counts)
            ids = batch.column("doc_id").to_pylist()
            if not len(full):
                continue
            place = _key_of([digests[i] for i in full], [ids[i] for i in full]) % bits
            passing = full[(bitmap[place >> 3] >> (place & 7) & 1).astype(bool)]
            starts = np.cumsum(counts) - counts
            values = hashes.view(np.int64)[ranges(starts[passing], counts[passing])]
            offsets = np.concatenate([[0], np.cumsum(counts[passing])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array([digests[i] for i in passing], pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
            ], names=["digest", "hashes"])

    found = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(sets, "digest binary, hashes array<bigint>")
    return found.join(wanted.select("node", "digest"), "digest").dropDuplicates(["node"]).select("node", "hashes")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are alike."""
    both = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b")
        .withColumn("common", F.size(F.array_intersect("ha", "hb")))
    )
    union = F.size("ha") + F.size("hb") - F.col("common")
    return both.where(F.col("common") * 100 >= union * PERCENT).select("a", "b")


def _alike_in_size(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def components(edges: DataFrame) -> DataFrame:
    """``node, group`` of the nodes on ``edges (a, b)``: the group is its smallest node.

    Alternates between joining each node's larger neighbours to its smallest
    neighbour and each node's smaller neighbours to the smallest of them, until
    nothing changes; each step is staged, none is collected.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        up = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(up.unionByName(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("group"))


def _spanning(a: np.ndarray, b: np.ndarray, size: int) -> list[int]:
    """The links that join something new, so that a unit gives fewer links than it has nodes."""
    parent = list(range(size))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            kept.append(k)
    return kept


def _links_within(unit: pd.DataFrame, same_block: bool) -> list[tuple[int, int]]:
    """Confirmed links between nodes of different groups, of one block or of two.

    The common shingles of all pairs at once: a product of the nodes' incidence
    with the shingles that more than one of them has, some columns at a time.
    """
    node, group, block = (unit[c].to_numpy() for c in ("node", "group", "block"))
    sizes = unit["hashes"].map(len).to_numpy()
    owner = np.repeat(np.arange(len(unit)), sizes)
    distinct, column, times = np.unique(np.concatenate([np.asarray(h, np.int64) for h in unit["hashes"]]), return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    kept = shared[column]
    owner, column = owner[kept], place[column[kept]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(unit), len(unit)), np.float32)
    for first in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        incidence = np.zeros((len(unit), COLUMNS), np.float32)
        incidence[owner[a:b], column[a:b] - first] = 1
        common += incidence @ incidence.T
    alike = common * 100 >= (sizes[:, None] + sizes[None] - common) * PERCENT
    alike &= group[:, None] != group[None]
    if not same_block:
        alike &= block[:, None] != block[None]
    i, j = np.nonzero(np.triu(alike, 1))
    return [(int(node[i[k]]), int(node[j[k]])) for k in _spanning(i, j, len(unit))]


def _links_apart(members: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between nodes that share a key and that the comparison with the keys' first nodes left apart.

    Nodes joined by such keys are a family, and a family is compared whole, in
    blocks: every pair of blocks is one unit of work, which gets each set once
    and gives links, not pairs. Keys of two nodes have been compared already.
    """
    grouped = members.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))
    several = grouped.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("least"), F.min("group").alias("g0"), F.max("group").alias("g1"))
    several = several.where("size > 2 AND g0 <> g1").select("key", "least")
    rest = stage(grouped.join(several, "key").select("node", "group", "least").distinct(), "apart")
    families = components(rest.select(F.col("node").alias("a"), F.col("least").alias("b")))
    rows = rest.select("node", "group").distinct().join(families.withColumnRenamed("group", "family"), "node", "left")
    rows = rows.withColumn("family", F.coalesce("family", "node"))
    sizes = rows.groupBy("family").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK_NODES).cast("int")
    rows = rows.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("family", "node", "group", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    units = stage(rows.join(sets, "node"), "units")
    cells = max(1, -(-(units.agg(F.sum(F.size("hashes"))).first()[0] or 0) // CELL_HASHES))

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        found = [pair for (_, lo, hi), unit in frame.groupby(["family", "lo", "hi"], sort=False) for pair in _links_within(unit, lo == hi)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    dealt = units.withColumn("cell", F.pmod(F.xxhash64("family", "lo", "hi"), F.lit(cells)))
    return dealt.groupBy("cell").applyInPandas(links, "a bigint, b bigint").distinct()


def _grouped(docs: DataFrame, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and the distinct sets (``node, digest, min_doc, first``) with their ``group``."""
    signed = stage(signatures(docs, row), "signatures")
    # The row that stands for a set: that of the smallest id, null last, then of the smallest number.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    nodes = stage(
        signed.where("digest IS NOT NULL").groupBy("digest")
        .agg(F.min("row").alias("node"), F.min("doc_id").alias("min_doc"), first, F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")),
        "nodes",
    )
    keys = index_keys(nodes)
    shared_keys = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("first")).where("size > 1").select("key", "first")
    members = stage(keys.join(shared_keys, "key"), "members")
    small = nodes.select("node", "n_shingles")
    first = small.select(F.col("node").alias("first"), F.col("n_shingles").alias("n_first"))
    stars = members.where("node <> first").select("node", "first").distinct().join(small, "node").join(first, "first")
    stars = stars.where(_alike_in_size(F.col("n_shingles"), F.col("n_first"))).select(F.col("first").alias("a"), F.col("node").alias("b"))
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "digest", "min_doc")
    sets = stage(full_sets(docs, wanted), "sets")
    links = stage(_confirmed(stars, sets), "links")
    groups = components(links)
    more = stage(_links_apart(members.select("key", "node"), groups, sets), "links")
    if not more.isEmpty():
        groups = components(links.unionByName(more))
    return signed, nodes.select("node", "digest", "min_doc", "first").join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    signed, placed = _grouped(docs)
    ids = placed.groupBy("group").agg(F.min("min_doc").alias("component"))
    by_set = placed.join(ids, "group").select("digest", "component")
    out = signed.join(by_set, "digest", "left")
    alone = F.col("digest").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every group: that of the smallest id, null last, whichever of equal ones.

    Rows are told apart by a number of their own, so a row goes only if its own
    text is like the one that stays: repeated rows leave one, rows of one id with
    different texts are judged apart, and rows without words all stay.
    """
    row = free_name("_row", docs.columns)
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    signed, placed = _grouped(numbered, row)
    stays = placed.groupBy("group").agg(F.min("first").alias("stays"))
    by_set = placed.join(stays, "group").select("digest", F.col("stays.row").alias("stays"))
    gone = stage(signed.join(by_set, "digest").where("row <> stays").select(F.col("row").alias(row)), "gone")
    # The numbers of the rows that go are measured: while they are few they are sent to the texts, not the texts to them.
    side = F.broadcast(gone) if measured_bytes(gone) <= BROADCAST_BYTES else gone
    return numbered.join(side, row, "left_anti").select(*docs.columns)
