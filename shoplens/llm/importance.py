"""Importance resampling toward a target distribution, on hashed n-grams.

The features of a text are its runs of 1 to 3 words (ASCII letters lower-cased; a
word is a run of digits, letters and characters beyond ASCII). They come from one
scan: separators are collapsed to single spaces, and ``regex.finditer`` with
``overlapped=True`` and lookarounds at the word boundaries starts a match at every
word, whose groups end its n-grams. Each n-gram span is hashed by CRC-32, a longer
one going on from the checksum of the shorter, modulo ``buckets``.

With s of S features of the documents and t of T features of the target in a bucket,
its gain is floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))). A document's
weight is the sum of its features' gains; its score adds Gumbel noise seeded by its
id, so that taking the highest scores draws without replacement by weight.

The texts are scanned once: the buckets go to a Parquet table (two bytes a feature),
from which counts (per task, then at most ``buckets`` rows) and weights are read.
Ranks come from a range-partitioned sort: a task numbers its own rows, and the sizes
of the sorted partitions are added up on the driver, one number a partition.

Defined results: a null or empty text, or one without a word, has no features and
weight 0; it is never drawn. A null doc_id has the noise of an empty id and loses
ties against every other id. Rows with one doc_id are documents of their own with
equal noise; of equal scores and ids the one with more features comes first. Equal
rows are ranked one after the other. An empty target has T = 0. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from array import array
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from shoplens.llm.tables import prepare, written

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SEPARATORS = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# one match per word: the word, and with their leading spaces the two words after it
_GRAMS = regex.compile(rb"(?<![^ ])([^ ]++)( [^ ]++)?( [^ ]++)?(?![^ ])")


def gram_hashes(text: str | None) -> tuple[int, array]:
    """Number of words, and the CRC-32 of every run of 1 to 3 words."""
    flat = _SEPARATORS.sub(b" ", (text or "").encode().translate(_LOWER)).strip(b" ")
    out, words, crc = array("I"), 0, zlib.crc32
    add = out.append
    for m in _GRAMS.finditer(flat, overlapped=True):
        one, two, three = m.groups()
        h = crc(one)
        add(h)
        words += 1
        if two is not None:
            h = crc(two, h)
            add(h)
            if three is not None:
                add(crc(three, h))
    return words, out


def _scan_batches(buckets: int, carry: Sequence[str]):
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches):
        for b in batches:
            words, found = [], []
            for text in b.column("text"):
                n, hashes = gram_hashes(text.as_py())
                words.append(n)
                found.append((np.frombuffer(hashes, np.uint32) % buckets).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(words, pa.int64()), pa.array(found, pa.binary()),
                 *(b.column(c) for c in carry)], names=["doc_id", "n_words", "features", *carry])
    return run


def _types(columns) -> str:
    return "".join(f", {f.name} {f.dataType.simpleString()}" for f in columns)


def _features(docs: DataFrame, buckets: int, carry: Sequence[str]) -> DataFrame:
    """(doc_id, n_words, features: buckets as packed little-endian integers, *carry), written."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *carry)
    schema = "doc_id bigint, n_words bigint, features binary" + _types(rows.schema[2:])
    return written(rows.mapInArrow(_scan_batches(buckets, carry), schema), "importance", "features")


def _kind(buckets: int):
    return np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over the whole table; one task adds up its rows first."""
    kind = _kind(buckets)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for value in b.column("features"):
                total += np.bincount(np.frombuffer(value.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    rows = (features.select("features").mapInArrow(run, "bucket bigint, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # at most ``buckets`` rows
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln ratio) per bucket of the smoothed frequencies, in doubles."""
    m, big_s, big_t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float((t + 1) * (big_s + m)) / float((s + 1) * (big_t + m))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, from the document's id."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weigh_batches(gains: np.ndarray, seed: int, carry: Sequence[str]):
    kind = _kind(len(gains))

    def run(batches):
        for b in batches:
            n, weight, score = [], [], []
            for doc_id, value in zip(b.column("doc_id").to_pylist(), b.column("features")):
                at = np.frombuffer(value.as_buffer(), kind)
                n.append(len(at))
                weight.append(int(gains[at].sum()))
                score.append(weight[-1] + noise(doc_id, seed))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_words"), *(pa.array(x, pa.int64()) for x in (n, weight, score)),
                 *(b.column(c) for c in carry)],
                names=["doc_id", "n_words", "n_features", "weight", "score", *carry])
    return run


def _ranked(rows: DataFrame, percent: int) -> DataFrame:
    """Column ``rank``: 1, 2, 3... for the ``percent`` % of the rows with the highest scores."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features"), F.asc("_row")]
    # the row number splits rows that are equal in everything else, too
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    rows = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")
                   .withColumn("_at", F.monotonically_increasing_id()), "importance", "sorted")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r["part"], r["count"]) for r in rows.groupBy(part.alias("part")).count().collect())
    starts, drawn = [], 0
    for p, n in sizes:
        starts.append((p, drawn))
        drawn += n
    drawn = drawn * percent // 100
    before = rows.sparkSession.createDataFrame(starts, "_part bigint, _before bigint")  # a row per sorted partition
    rank = F.col("_before") + place + 1
    return (rows.withColumn("_part", part).join(F.broadcast(before), "_part")
            .withColumn("rank", F.when(rank <= drawn, rank)).drop("_part", "_before", "_at"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (null where
    not drawn), and the columns ``carry`` of ``docs``. ``target`` has a column ``text``."""
    found = _features(docs, buckets, carry)
    wanted = _features(target.select(F.lit(None).cast("bigint").alias("doc_id"), "text"), buckets, ())
    gains = bucket_gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))
    schema = "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint" + _types(found.schema[3:])
    scored = written(found.mapInArrow(_weigh_batches(gains, seed, carry), schema), "importance", "scored")
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return _ranked(scored.where(F.col("n_words") >= min_words), percent).unionByName(rest)


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (all columns, unchanged) that are drawn. Rows with one doc_id
    and one text are drawn together when any of them is."""
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    keyed = docs.select("doc_id", "text", digest.alias("_digest"))
    drawn = (resample(keyed, target, carry=["_digest"], **options).where(F.col("rank").isNotNull())
             .select(F.col("doc_id").alias("_id"), F.col("_digest").alias("_drawn")).distinct())
    return docs.join(drawn, docs["doc_id"].cast("bigint").eqNullSafe(F.col("_id")) & (digest == F.col("_drawn")), "left_semi")
