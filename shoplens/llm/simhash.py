"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments (23, 23 and 18 bits, the last
one padded with zeros). The binary Golay code of length 23 is perfect: each word
has one codeword within distance 3. A segment's fuzzy indices are its nearest
codeword and, where that is at distance 3, the five at distance 4; two segments
that differ in at most one bit share an index. Of two fingerprints that differ in
at most two bits, one segment is equal (pigeonhole) and one of the other two
differs in at most one bit, so they share a key made of (ordered pair of segments,
the first one's bits, a fuzzy index of the second). Fingerprints with a common key
are joined and verified by their bit distance.

Keys are held by distinct fingerprints only. Keys with more than ``KEY_ROWS``
fingerprints aren't paired up: their fingerprints are linked through the 65 values
within one bit of each (two fingerprints differ in at most two bits just when they
share such a value), each to the least of its value, which no group of any size
turns into pairs. Components are the least labels spread along the links, with
pointer jumping, from files in the shared folder.

Defined results: null and empty texts have the fingerprint zero, linked like any
other; ids of rows with a null doc_id come last (a component of such rows only has
a null id); rows with the same doc_id have one node per fingerprint, and of a component's
rows with the smallest doc_id ``representatives`` keeps the one of the smallest
fingerprint, then text digest. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shoplens.llm.tables import texts, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
KEY_ROWS = 16
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


# ---- fingerprints --------------------------------------------------------------
def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    words = text.encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(
        starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())), np.uint64, len(words) - k + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in more than half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.ascontiguousarray(hashes[at:at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(size: int):
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(shingle_hashes(t, size)) for t in b.column("text").to_pylist()], np.uint64)
            more = [c for c in b.schema.names if c not in ("doc_id", "text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64)), *map(b.column, more)],
                                             names=["doc_id", "fp", *more])
    return run


# ---- Golay keys ----------------------------------------------------------------
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    w = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        w ^= np.where((w >> bit) & 1, GENERATOR << (bit - 11), 0)
    return w


@cache
def error_patterns() -> tuple[np.ndarray, np.ndarray]:
    """(patterns[2048, 6], how many): for each syndrome the least error and, where it
    has weight 3, the five errors of weight 4 with that syndrome."""
    errors = [[sum(1 << i for i in c) for c in combinations(range(23), w)] for w in range(5)]
    patterns, used = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    for weight, found in enumerate(errors):
        found = np.array(found, np.int64)
        for s, e in zip(syndromes(found).tolist(), found.tolist()):
            if weight < 4 or patterns[s, 0].bit_count() == 3:
                patterns[s, used[s]] = e
                used[s] += 1
    return patterns, used


def fuzzy_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index): the 12-bit indices of the codewords near each 23-bit word."""
    patterns, used = error_patterns()
    s = syndromes(words)
    row = np.repeat(np.arange(len(words)), used[s])
    nth = np.arange(len(row)) - np.repeat(np.cumsum(used[s]) - used[s], used[s])
    codeword = words[row] ^ patterns[s[row], nth]
    return row, codeword >> 11


def segments(fps: np.ndarray) -> list[np.ndarray]:
    x = fps.astype(np.uint64)
    return [(x & np.uint64((1 << 23) - 1)).astype(np.int64),
            ((x >> np.uint64(23)) & np.uint64((1 << 23) - 1)).astype(np.int64),
            (x >> np.uint64(46)).astype(np.int64)]


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): two fingerprints that differ in at most two bits share a key."""
    parts = segments(fps)
    rows, out = [], []
    for b in range(3):
        row, index = fuzzy_indices(parts[b])
        for a in range(3):
            if a != b:
                rows.append(row)
                out.append(((a * 3 + b) << 35) | (parts[a][row] << 12) | index)
    return np.concatenate(rows), np.concatenate(out)


def _key_rows(batches):
    for b in batches:
        fps = b.column("fp").to_numpy(zero_copy_only=False)
        for at in range(0, len(fps), 4096):
            block = fps[at:at + 4096]
            row, key = keys(block.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(block[row])], names=["key", "fp"])


# ---- links ---------------------------------------------------------------------
def links(fps: DataFrame) -> DataFrame:
    """(a, b), a < b: links between distinct fingerprints ``fps`` (fp); every two at
    distance of at most two bits are connected, nothing else is."""
    rows = written(fps.mapInArrow(_key_rows, "key bigint, fp bigint"), "golay_keys")
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    small = rows.join(sizes.where(F.col("n") <= KEY_ROWS).select("key"), "key")
    left, right = small.select("key", F.col("fp").alias("a")), small.select("key", F.col("fp").alias("b"))
    close = (left.join(right, "key").where("a < b").where(F.bit_count(F.expr("a ^ b")) <= MAX_BITS)
             .select("a", "b"))
    crowded = rows.join(sizes.where(F.col("n") > KEY_ROWS).select("key"), "key").select("fp").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *[F.shiftleft(F.lit(1).cast("bigint"), i) for i in range(64)])
    near = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", F.expr("fp ^ flip").alias("value"))
    least = near.groupBy("value").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    star = near.join(least, "value").where("a < fp").select("a", F.col("fp").alias("b"))
    return close.unionByName(star).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the least node connected to ``node``, for the nodes of
    ``edges`` (a, b). Each round takes the least label of the neighbours and then the
    label of that label; files in the shared folder carry the rounds."""
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        spread = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                  .groupBy("a").agg(F.min("label").alias("l")))
        lower = labels.join(spread.withColumnRenamed("a", "node"), "node").select(
            "node", "label", F.least("label", "l").alias("l"))
        jump = labels.select(F.col("node").alias("l"), F.col("label").alias("far"))
        new = written(lower.join(jump, "l").select("node", F.least("l", "far").alias("new"), "label"), "labels")
        if new.where("new <> label").isEmpty():
            return labels
        labels = new.select("node", F.col("new").alias("label"))


def _labelled(nodes: DataFrame) -> DataFrame:
    """``nodes`` (fp and further columns, a row per fingerprint) with the label of their component."""
    label = components(written(links(nodes.select("fp")), "fp_links")).withColumnRenamed("node", "fp")
    return nodes.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id, group_size (rows)."""
    hashed = written(texts(docs).mapInArrow(_fingerprints(shingle), "doc_id bigint, fp bigint"), "fingerprints")
    nodes = written(hashed.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "fp_nodes")
    grouped = _labelled(nodes)
    groups = grouped.groupBy("label").agg(F.min("first").alias("component_id"), F.sum("n").alias("group_size"))
    of_fp = grouped.join(groups, "label").select("fp", "component_id", "group_size")
    return hashed.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group_size")


def _digest(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def representatives(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: of each component the row with the
    smallest doc_id (then fingerprint, then text digest), once even when that row is repeated."""
    hashed = texts(docs).withColumn("digest", _digest(F.col("text"))).mapInArrow(
        _fingerprints(shingle), "doc_id bigint, fp bigint, digest binary")
    nodes = written(hashed.groupBy("fp", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "digest", "n")).alias("first")), "fp_nodes")
    # a digest has one fingerprint, so (id, digest) names rows of one component only
    keep = _labelled(nodes).groupBy("label").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("__id"), F.col("first.digest").alias("__digest"), F.col("first.n").alias("__n"))
    marked = (docs.withColumn("__digest", _digest(F.col("text"))).alias("d")
              .join(written(keep, "near_representatives").alias("k"), F.col("d.doc_id").cast("bigint").eqNullSafe(F.col("k.__id"))
                    & (F.col("d.__digest") == F.col("k.__digest"))))
    cols = [F.col(f"d.`{c}`") for c in docs.columns]
    once = marked.where("k.__n = 1").select(*cols)
    repeated = marked.where("k.__n > 1").select(*cols, F.col("d.__digest").alias("__digest"))
    return once.unionByName(repeated.dropDuplicates(["doc_id", "__digest"]).drop("__digest"))
