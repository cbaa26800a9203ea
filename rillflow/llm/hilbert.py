"""Sharding along a Hilbert curve.

Rows are points: each metadata column is cut into 2^bits steps at quantiles and
the steps' Hilbert index puts rows that are near in all columns near each other.
Shards are runs of that order with row counts at most one apart, so a filter on
any of the columns can skip the shards whose ranges do not meet it.

The order is the curve's cell, then a hash of the text, so that equal texts lie
together, then the id. Positions come from counts of small pieces of the order,
summed within a cell and then over cells; no task orders a whole cell. All work
is DataFrame functions.

Null metadata sorts into step 0. Null and empty texts have no bytes. Repeated
rows get positions of their own. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 5
SLICES = 64
OVERHEAD = 16


def hilbert_index(steps: list[Column], bits: int = BITS) -> Column:
    """The curve's index of a point whose coordinates are numbers of ``bits`` bits.

    Turns the coordinates into the transposed index from the highest bit down,
    exchanging or inverting the lower bits, and takes its bits in turn. The plan
    of a step is bounded by the number of columns; intermediate values are array
    elements of one higher-order call, not nested copies of the expression.
    """
    n = len(steps)
    state = F.array(*[s.cast("int") for s in steps])

    def element(x: Column, i: int) -> Column:
        return F.element_at(x, i + 1)

    def turned(i: int, q: int):
        def turn(x: Column) -> Column:
            first, own = element(x, 0), element(x, i)
            swap = first.bitwiseXOR(own).bitwiseAND(F.lit(q - 1))
            inverted = own.bitwiseAND(F.lit(q)) != 0
            new_first = F.when(inverted, first.bitwiseXOR(F.lit(q - 1))).otherwise(first.bitwiseXOR(swap))
            if i == 0:
                return F.array(new_first, *[element(x, k) for k in range(1, n)])
            new_own = F.when(inverted, own).otherwise(own.bitwiseXOR(swap))
            return F.array(new_first, *[new_own if k == i else element(x, k) for k in range(1, n)])

        return turn

    def bind(x: Column, f) -> Column:
        # transform() over one element names a value, so that it is computed once.
        return F.element_at(F.transform(F.array(x), f), 1)

    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            state = bind(state, turned(i, q))
        q >>= 1

    def gray(x: Column) -> Column:
        out = [element(x, 0)]
        for k in range(1, n):
            out.append(element(x, k).bitwiseXOR(out[-1]))
        return F.array(*out)

    def fold(x: Column) -> Column:
        t = F.lit(0)
        for b in range(bits - 1, 0, -1):
            t = t.bitwiseXOR(F.when(element(x, n - 1).bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)))
        return bind(t, lambda t: F.transform(x, lambda v: v.bitwiseXOR(t)))

    def interleave(x: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for b in range(bits - 1, -1, -1):
            for k in range(n):
                bit = F.shiftright(element(x, k), b).bitwiseAND(F.lit(1)).cast("bigint")
                out = out.bitwiseOR(F.shiftleft(bit, b * n + n - 1 - k))
        return out

    return bind(bind(bind(state, gray), fold), interleave)


def quantile_steps(rows: DataFrame, columns: list[str], bits: int = BITS) -> list[Column]:
    """For each numeric column its step among 2^bits quantiles of all rows; the cuts are a fixed number of values."""
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = rows.agg(*[F.percentile_approx(c, cuts, 10_000).alias(c) for c in columns]).first()
    out = []
    for c in columns:
        bounds = sorted(set(found[c] or []))
        at = [(F.col(c) > F.lit(b)).cast("int") for b in bounds]
        out.append(F.coalesce(sum(at[1:], at[0]) if at else F.lit(0), F.lit(0)))
    return out


def hilbert_shards(rows: DataFrame, columns: list[str], shards: int, text_hash: str, key: str, bits: int = BITS) -> DataFrame:
    """``rows`` with ``shard`` and its gapless ``slot``, in the order of the curve over numeric ``columns``.

    ``text_hash`` and ``key`` are 64-bit columns that order rows of one cell.
    """
    cell = hilbert_index(quantile_steps(rows, columns, bits), bits)
    cut = F.lit(SLICES)
    placed = rows.withColumn("_cell", cell)
    placed = placed.withColumn("_text_slice", F.pmod(F.shiftright(text_hash, 40), cut))
    placed = placed.withColumn("_key_slice", F.pmod(F.xxhash64(F.struct(key), F.lit(7)), cut))
    piece = ["_cell", "_text_slice", "_key_slice"]
    counts = placed.groupBy(*piece).agg(F.count("*").alias("_n"))
    cells = counts.groupBy("_cell").agg(F.sum("_n").alias("_n"))
    # Two levels again: the curve has a bounded number of cells, and runs of them.
    run = F.shiftright("_cell", max(0, len(columns) * bits // 2)).alias("_run")
    cells = cells.select("_cell", "_n", run)
    runs = cells.groupBy("_run").agg(F.sum("_n").alias("_m"))
    runs = runs.select("_run", (F.sum("_m").over(Window.orderBy("_run")) - F.col("_m")).alias("_run_start"), F.sum("_m").over(Window.partitionBy()).alias("_all"))
    in_run = F.sum("_n").over(Window.partitionBy("_run").orderBy("_cell")) - F.col("_n")
    cells = cells.withColumn("_in_run", in_run).join(runs, "_run").select("_cell", (F.col("_run_start") + F.col("_in_run")).alias("_cell_start"), "_all")
    in_cell = F.sum("_n").over(Window.partitionBy("_cell").orderBy("_text_slice", "_key_slice")) - F.col("_n")
    starts = counts.withColumn("_in_cell", in_cell).join(cells, "_cell").select(*piece, (F.col("_cell_start") + F.col("_in_cell")).alias("_start"), "_all")
    within = F.row_number().over(Window.partitionBy(*piece).orderBy(text_hash, key)) - 1
    ranked = placed.join(starts, piece).withColumn("_rank", F.col("_start") + within)
    # Integer arithmetic: shard s takes positions from ceil(s * all / shards) on.
    shard = F.expr(f"_rank * {shards} DIV _all")
    first = F.expr(f"(_shard * _all + {shards} - 1) DIV {shards}")
    out = ranked.withColumn("_shard", shard).withColumn("_slot", F.col("_rank") - first)
    return out.select(*rows.columns, F.col("_shard").cast("int").alias("shard"), F.col("_slot").alias("slot"))


def metadata(docs: DataFrame) -> DataFrame:
    """``doc_id``, the size and checksum of the text, and the columns of the curve."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"), F.xxhash64("lang").cast("double").alias("lang_code"),
        F.xxhash64("source").cast("double").alias("source_code"),
    )


def shard_ranges(sharded: DataFrame, columns: list[str]) -> DataFrame:
    """For each shard its rows and each column's least and greatest value, to skip shards by."""
    ends = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), *ends)
