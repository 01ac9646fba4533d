"""The next value in a keyed sequence (``lead``), safe for very large keys.

A plain ``lead`` over ``Window.partitionBy(keys)`` puts every row of a key in
one task; one session holding a third of the log would then be sorted by one
core. With ``chunk`` (an expression that never decreases along the order, e.g.
the minute of the action time) the window runs per (key, chunk) instead, and the
successor of each chunk's last row is the first row of the key's next non-empty
chunk, found on a table with one row per (key, chunk). The result is exact: the
same as the unchunked ``lead``.

``with_successor_ranged`` needs no chunk and splits any key, however many rows it has
at one time: the rows are range-partitioned on (keys, order), so a large key becomes
several ranges, numbered in order, and ``lead`` runs over blocks of successive
numbers. The first row of each block is carried to the last row of the block before.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoplens.sinks.tables import staged

# rows of a block are numbered by this many low bits of the place in their range
BLOCK_BITS = 20


def with_successor(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   value: str, out: str, chunk: Column | None = None,
                   position: str | None = None) -> DataFrame:
    """Add column ``out``: ``value`` of the next row of the same key in ``order``
    (null for the key's last row). ``position`` names a further column that numbers the
    rows of a key and chunk in that order."""
    keys = list(keys)
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        df = df if position is None else df.withColumn(position, F.row_number().over(w))
        return df.withColumn(out, F.lead(value).over(w))

    # A null chunk becomes "" so it still joins and, like the nulls-first order
    # of the rows themselves, comes before every other chunk. Keys are compared
    # null-safe: the rows of a null key are one sequence, split into chunks as well.
    d = df.withColumn("_chunk", F.coalesce(chunk.cast("string"), F.lit("")))
    w1 = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    d = d if position is None else d.withColumn(position, F.row_number().over(w1))
    d = (d.withColumn(out, F.lead(value).over(w1))
          .withColumn("_last", F.lead(F.lit(True)).over(w1).isNull())
          .withColumn("_first", F.lag(F.lit(True)).over(w1).isNull()))
    # lag (not row_number() == 1) marks the heads: both branches then share one
    # window input, so Spark reuses the single shuffle of the rows.
    heads = d.where(F.col("_first")).select(*keys, "_chunk", F.col(value).alias("_head"))
    # One row per (key, chunk): bounded by time span / chunk width, not by data volume.
    w2 = Window.partitionBy(*keys).orderBy("_chunk")
    nxt = heads.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_chunk").alias("_of"),
                       F.lead("_head").over(w2).alias("_next_head"))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    return (d.join(nxt, same & (F.col("_chunk") == F.col("_of")), "left")
             .withColumn(out, F.when(F.col("_last"), F.col("_next_head")).otherwise(F.col(out)))
             .drop("_chunk", "_last", "_first", "_next_head", "_of", *[f"_key{i}" for i in range(len(keys))]))


def with_successor_ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                          value: str, out: str, position: str | None = None,
                          block_bits: int = BLOCK_BITS) -> DataFrame:
    """``with_successor`` for keys of any density. The sorted ranges are written to the
    shared store once, so that their numbers stand; ``position`` is that number.

    A task holds one range, then one block of at most 2^``block_bits`` rows; rows that
    are equal in keys and order are split too (by where they stand in the input). Only
    one row per block is looked at together.
    """
    keys = list(keys)
    by = [*keys, *order, "_row"]
    ranges = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    # (number of the range << 33) + place in the range
    rows = staged(ranges.drop("_row").withColumn("_at", F.monotonically_increasing_id()), "successor")
    block = F.shiftright("_at", block_bits)
    head = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(value).alias("v"))
    inside = Window.partitionBy("_block").orderBy("_at")
    d = rows.withColumn("_block", block).withColumn("_next", F.lead(head).over(inside))
    # a block's first row has the low bits 0; one row per block, in the order of the blocks
    firsts = rows.where(F.col("_at").bitwiseAND(F.lit((1 << block_bits) - 1)) == 0).select(block.alias("_b"), head.alias("_head"))
    carried = firsts.select("_b", F.lead("_head").over(Window.orderBy("_b")).alias("_carry"))
    d = d.join(carried, F.col("_block") == F.col("_b"), "left").withColumn("_next", F.coalesce("_next", "_carry"))
    same = reduce(lambda x, y: x & y, [F.col(f"_next.k{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)])
    d = d.withColumn(out, F.when(F.col("_next").isNotNull() & same, F.col("_next.v")))
    if position is not None:
        d = d.withColumn(position, F.col("_at"))
    return d.drop("_at", "_block", "_b", "_carry", "_next")
