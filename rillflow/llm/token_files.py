"""Token ids in directly addressable files.

A token id is cut into chunks of eight bits, lowest first. Level k holds the
k-th chunk of every id that has one, a bitmap that says which of them go on at
the next level, and a rank directory with the ones before each block of the
bitmap. Any token is read by its position alone: take its chunk, and while its
bit is set go to the next level at the number of ones before it.

Files are Parquet so that every store Spark writes to can hold them: a row is a
segment of about a million ids with its levels, and its range of positions can
be pruned by the row groups' statistics.

Null, empty and repeated texts and repeated or null document ids are allowed: a
text without tokens still has its end id, equal ids stand beside each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.shared import slices, task_number
from rillflow.llm.tokens import encoder, with_end
from rillflow.session import work_dir

BLOCK = 512
SEGMENT_TOKENS = 1 << 20
_LEVEL = pa.struct([("codes", pa.binary()), ("goes_on", pa.binary()), ("ranks", pa.binary())])
_SEGMENT = pa.schema([
    ("shard", pa.int32()), ("segment", pa.int32()), ("first_token", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("levels", pa.list_(_LEVEL)),
])
SEGMENT_SCHEMA = (
    "shard int, segment int, first_token bigint, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>,"
    " levels array<struct<codes:binary,goes_on:binary,ranks:binary>>"
)


def encode_levels(ids: np.ndarray) -> list[dict]:
    levels = []
    while True:
        goes_on = ids > 255
        counts = np.add.reduceat(goes_on, np.arange(0, len(ids), BLOCK), dtype=np.uint32) if len(ids) else np.zeros(0, np.uint32)
        levels.append({
            "codes": (ids & 255).astype(np.uint8).tobytes(),
            "goes_on": np.packbits(goes_on, bitorder="little").tobytes(),
            "ranks": (np.cumsum(counts, dtype=np.uint32) - counts).astype("<u4").tobytes(),
        })
        if not goes_on.any():
            return levels
        ids = ids[goes_on] >> 8


def decode_levels(levels: list[dict]) -> np.ndarray:
    """All ids of a segment."""
    ids = np.zeros(0, np.uint32)
    for level in reversed(levels):
        codes = np.frombuffer(level["codes"], np.uint8).astype(np.uint32)
        goes_on = np.unpackbits(np.frombuffer(level["goes_on"], np.uint8), count=len(codes), bitorder="little").astype(bool)
        codes[goes_on] |= ids << 8
        ids = codes
    return ids


def token_at(levels: list[dict], at: int) -> int:
    """One id, by its position in the segment, without decoding its neighbours."""
    value = 0
    for depth, level in enumerate(levels):
        value |= level["codes"][at] << (8 * depth)
        bits = np.frombuffer(level["goes_on"], np.uint8)
        if not bits[at >> 3] >> (at & 7) & 1:
            break
        block = at // BLOCK
        before = np.unpackbits(bits[block * BLOCK // 8:(at >> 3) + 1], bitorder="little")[:at - block * BLOCK].sum()
        at = int(np.frombuffer(level["ranks"], "<u4")[block]) + int(before)
    return value


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int, text: str = "text", key: str = "doc_id") -> None:
    """Writes all texts' ids, each text followed by ``end``, in ascending order of ``key``.

    Texts are dealt by ranges of the key and, among equal keys, of a hash, so
    that one key with very many rows is spread too.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("_tie"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, first = task_number(), 0, 0
        ids, keys, counts, held = [], [], [], 0
        encode = encoder(tokenizer).encode

        def cut():
            nonlocal number, first, ids, keys, counts, held
            levels = encode_levels(np.concatenate(ids))
            row = {"shard": shard, "segment": number, "first_token": first, "n_tokens": held, "doc_ids": keys, "doc_tokens": counts, "levels": levels}
            number, first, ids, keys, counts, held = number + 1, first + held, [], [], [], 0
            return pa.RecordBatch.from_pylist([row], _SEGMENT)

        for batch in slices(batches):
            own, lengths = with_end(*encode(batch.column("text")), end)
            ids.append(own)
            keys += batch.column("doc_id").to_pylist()
            counts += lengths.tolist()
            held += len(own)
            if held >= SEGMENT_TOKENS:
                yield cut()
        if held:
            yield cut()

    ordered.select("doc_id", "text").mapInArrow(segments, SEGMENT_SCHEMA).write.parquet(path)


def _shard_starts(files: DataFrame) -> DataFrame:
    """Ids before each shard. One row a shard, not a document, meets in the window."""
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    return totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))


def read_documents(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_levels(row["levels"]).astype("<u4")
                counts = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                crcs = [zlib.crc32(ids[e - n:e]) for e, n in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]] * len(counts), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["first_token"] + ends - counts), pa.array(counts), pa.array(crcs, pa.int64()),
                ], names=["shard", "doc_id", "in_shard", "n_tokens", "ids_crc32"])

    columns = files.select("shard", "first_token", "doc_ids", "doc_tokens", "levels")
    rows = columns.mapInArrow(documents, "shard int, doc_id bigint, in_shard bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(_shard_starts(files), "shard").select(
        "doc_id", (F.col("in_shard") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_tokens(files: DataFrame, positions: DataFrame, position: str = "position") -> DataFrame:
    """``positions`` with the id at each global position, null beyond the last.

    A position meets its segment by the million it lies in; a segment covers the
    millions it touches.
    """
    placed = files.join(_shard_starts(files), "shard").withColumn("_from", F.col("shard_start") + F.col("first_token"))
    step = F.lit(SEGMENT_TOKENS)
    covered = placed.withColumn("_part", F.explode(F.sequence(F.floor(F.col("_from") / step), F.floor((F.col("_from") + F.col("n_tokens") - 1) / step))))

    @F.udf("long")
    def read(levels, at):
        return token_at([level.asDict() for level in levels], at)

    here = positions.select(F.col(position).alias("_position")).distinct().withColumn("_part", F.floor(F.col("_position") / step))
    at = F.col("_position") - F.col("_from")
    hits = here.join(covered, "_part").where((at >= 0) & (at < F.col("n_tokens")))
    found = hits.select("_position", read("levels", at).alias("token_id"))
    return positions.join(found, positions[position] == found["_position"], "left").drop("_position")


def token_files(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Writes the files below the shared work folder and opens them."""
    spark = docs.sparkSession
    path = work_dir(spark, "token-files")
    write_tokens(docs, path, tokenizer, end)
    return spark.read.schema(SEGMENT_SCHEMA).parquet(path)
