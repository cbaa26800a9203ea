"""Keyed lookups of a large stream of rows in a side table.

The side is broadcast only after its size was measured. A larger side is joined
by shuffle. Only keys that hold more rows than a task's share are salted, each
into as many pieces as it has shares: one key holding a third of all rows is
spread over many tasks, and the side grows by its rows of such keys alone. The
result is the same either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 32

# Keys are counted in buckets of their hash, so many for each salt: what the
# driver gets does not grow with the keys.
BUCKETS_PER_SALT = 64


def measured_bytes(df: DataFrame) -> int:
    """Serialised size of a DataFrame, from one distributed aggregate."""
    row = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return df.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0)).alias("bytes")).first()["bytes"]


def _pieces(left: DataFrame, bucket: Column, salts: int) -> DataFrame | None:
    """``_bucket, _pieces`` of the buckets with more rows than a ``salts``-th of all; None without such."""
    counts = left.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in counts)
    hot = [(r["_bucket"], -(-r["n"] * salts // total)) for r in counts if r["n"] * salts > total]
    return left.sparkSession.createDataFrame(hot, "_bucket bigint, _pieces int") if hot else None


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join each left row with the right row of its key.

    ``right`` holds one row per key. ``how`` is ``left``, ``inner``,
    ``left_semi`` or ``left_anti``. The right key column is not kept.
    """
    keeps_right = how in ("left", "inner")
    rest = [c for c in right.columns if c != right_key] if keeps_right else []
    side = right.select(F.col(right_key).alias("_lookup_key"), *rest)

    if measured_bytes(side) <= broadcast_bytes:
        joined = left.join(F.broadcast(side), left[left_key] == F.col("_lookup_key"), how)
        return joined.drop("_lookup_key")

    # The hint keeps Spark from a broadcast by the size of the side's files.
    matches = left[left_key] == F.col("_lookup_key")
    salts = max(salts, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucket = lambda key: F.pmod(F.xxhash64(key), F.lit(salts * BUCKETS_PER_SALT))
    # Values of different types that are equal need not have the same hash.
    comparable = left.schema[left_key].dataType == side.schema["_lookup_key"].dataType
    pieces = _pieces(left, bucket(left[left_key]), salts) if comparable else None
    if pieces is None:
        return left.join(side.hint("merge"), matches, how).drop("_lookup_key")

    # The salt is the row's place in its partition: equal rows are spread too, and
    # a task that reads its source again repeats it.
    count = F.coalesce(F.col("_pieces"), F.lit(1))
    dealt = left.withColumn("_of", bucket(left[left_key])).join(F.broadcast(pieces), F.col("_of") == F.col("_bucket"), "left")
    salted = dealt.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), count).cast("int")).drop("_of", "_bucket", "_pieces")
    found = side.withColumn("_of", bucket(F.col("_lookup_key"))).join(F.broadcast(pieces), F.col("_of") == F.col("_bucket"), "left")
    spread = found.withColumn("_lookup_salt", F.explode(F.sequence(F.lit(0), count - 1))).drop("_of", "_bucket", "_pieces")
    matches = (salted[left_key] == F.col("_lookup_key")) & (F.col("_salt") == F.col("_lookup_salt"))
    return salted.join(spread.hint("merge"), matches, how).drop("_lookup_key", "_lookup_salt", "_salt")


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key by ``order``; partial aggregates keep the shuffle
    to one row per key and task."""
    columns = df.columns
    picked = df.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_first"))
    return picked.select(*[F.col("_first")[c].alias(c) for c in columns])
