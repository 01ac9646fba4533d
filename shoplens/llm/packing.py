"""Best-fit packing of documents into sequences of several permitted lengths.

Documents longer than the largest length are cut into pieces of that length. The
pieces are dealt into groups of about ``group_pieces`` by a hash of (doc_id,
piece), and each group is packed on its own: best-fit decreasing, where an item
that fits no open bin opens the bin size of least cost per token it can still
receive. The permitted lengths are optimised jointly: the group is packed once
for every largest size that may be opened, and the packing of least total cost
(after every bin is downsized to the smallest length that holds its contents)
wins. The cost of a sequence has a fixed part, a linear and a quadratic one.

Defined results: a null or empty text has its end token only (length 1); rows
with a null or repeated doc_id are packed like any other, their pieces told apart
by ``copy``; ties in length go by (doc_id, piece, copy). An empty table gives an
empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shoplens.llm.tables import WORD, texts, written

CAPACITIES = (512, 1024, 2048, 4096)
GROUP_PIECES = 4096
# rows of one doc_id and length that one step numbers
COPY_BLOCK = 4096


def sequence_cost(capacity: int) -> float:
    """Cost of one sequence: overhead, work per token, attention."""
    return 64.0 + capacity + capacity * capacity / 16384.0


def _best_fit(lengths, opened, capacities):
    """Bins (lists of item indexes) for ``lengths`` in the order given. A new bin has
    one of the sizes ``opened``, or the least capacity where none of them holds the item."""
    free: list[tuple[int, int]] = []  # (room, bin), sorted
    bins: list[list[int]] = []
    left = sum(lengths)
    for i, n in enumerate(lengths):
        at = bisect_left(free, (n, -1))
        if at < len(free):
            room, b = free.pop(at)
        else:
            fit = [c for c in opened if c >= n] or [_downsized(n, capacities)]
            room = min(fit, key=lambda c: (sequence_cost(c) / max(1, min(c, left)), -c))
            b = len(bins)
            bins.append([])
        bins[b].append(i)
        left -= n
        if room > n:
            insort(free, (room - n, b))
    return bins


def pack(lengths, capacities=CAPACITIES):
    """Packing of least total cost for item ``lengths`` (each at most the largest
    capacity): (bin of each item, offset in its bin, capacity of each bin)."""
    capacities = sorted(capacities)
    lengths = [int(n) for n in lengths]
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    ordered = [lengths[i] for i in order]
    best = min((_best_fit(ordered, capacities[:k + 1], capacities) for k in range(len(capacities))),
               key=lambda bins: _total(bins, ordered, capacities))
    bin_of, offset, caps = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    for b, items in enumerate(best):
        used = 0
        for k in items:
            bin_of[order[k]], offset[order[k]] = b, used
            used += ordered[k]
        caps.append(_downsized(used, capacities))
    return bin_of, offset, np.array(caps, np.int64)


def _downsized(used, capacities):
    return capacities[bisect_left(capacities, used)]


def _total(bins, lengths, capacities):
    return sum(sequence_cost(_downsized(sum(lengths[k] for k in b), capacities)) for b in bins)


def _pack_group(capacities):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "copy"], na_position="first").reset_index(drop=True)
        bin_of, offset, caps = pack(pdf["n_tokens"].tolist(), capacities)
        used = np.bincount(bin_of, weights=pdf["n_tokens"], minlength=len(caps)).astype(np.int64)
        pdf["bin"], pdf["bin_offset"] = bin_of, offset
        pdf["bin_capacity"], pdf["bin_used"] = caps[bin_of], used[bin_of]
        return pdf
    return run


def pieces(docs: DataFrame, max_length: int) -> DataFrame:
    """(doc_id, copy, piece, first_token, n_tokens): words plus one end token."""
    n = texts(docs).select("doc_id", (F.regexp_count("text", F.lit(WORD)) + 1).cast("bigint").alias("n"))
    rows = written(n.groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("rows")), "lengths")
    # rows of one id and length are numbered in blocks; the blocks of a large count are spread
    last = F.col("rows") - 1
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / COPY_BLOCK))).alias("block")
    large = rows.where(F.col("rows") > COPY_BLOCK).select("doc_id", "n", "rows", block).repartition("doc_id", "n", "block")
    small = rows.where(F.col("rows") <= COPY_BLOCK).select("doc_id", "n", "rows", F.lit(0).cast("bigint").alias("block"))
    start = F.col("block") * COPY_BLOCK
    copies = F.explode(F.sequence(start, F.least(last, start + (COPY_BLOCK - 1)))).alias("copy")
    numbered = small.select("doc_id", "n", copies).unionByName(large.select("doc_id", "n", copies))
    return (numbered
            .select("doc_id", "copy", "n", F.explode(F.sequence(
                F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / max_length))).alias("piece"))
            .select("doc_id", "copy", "piece", (F.col("piece") * max_length).alias("first_token"),
                    F.least(F.lit(max_length).cast("bigint"), F.col("n") - F.col("piece") * max_length).alias("n_tokens")))


def best_fit_pack(docs: DataFrame, capacities=CAPACITIES, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: doc_id, copy, piece, first_token, n_tokens, pack_group,
    bin, bin_offset, bin_capacity, bin_used. (pack_group, bin) names a sequence."""
    items = written(pieces(docs, max(capacities)), "pieces")
    groups = max(1, -(-items.count() // group_pieces))
    dealt = items.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "copy", "piece"), F.lit(groups)))
    schema = ("doc_id bigint, copy bigint, piece bigint, first_token bigint, n_tokens bigint, pack_group bigint, "
              "bin bigint, bin_offset bigint, bin_capacity bigint, bin_used bigint")
    return dealt.groupBy("pack_group").applyInPandas(_pack_group(tuple(capacities)), schema)
