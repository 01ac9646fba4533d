"""Exact dedup with a persistent digest index.

The index is a table (digest, keep_id), bucketed and sorted by digest. New rows
are reduced to one row per digest (partial aggregation before the shuffle), those
known to the index are taken out by a sort-merge anti join that reads the index
without shuffling it, and the rest is appended. An append adds a sorted file to each
bucket, so a task sorts its own bucket, which is nearly in order, before it merges.
Only DataFrame functions are used.

Defined results: a null text equals the empty text; texts that differ only in
runs of ASCII white space are equal. Rows with a null id are grouped like any
other and give way to rows with an id. Rows that repeat the whole row count in
``group_size``; ``distinct_documents`` returns one of them. Empty tables give
empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplens.llm.tables import WHITE, texts, written
from shoplens.session import shared_path

# A digest with at least max(HOT_ROWS, rows / HOT_DIGESTS) rows is joined by a
# broadcast: there can be at most HOT_DIGESTS of them.
HOT_ROWS = 1000
HOT_DIGESTS = 1000


def digest(text):
    """SHA-256 (binary) of the text after white-space normalisation."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " "), 256))


class DigestIndex:
    """Digests seen so far, kept at ``path`` in the shared store across runs."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or shared_path(spark, "llm", "digest_index", unique=True)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = "digest_index_" + uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex[:16]
        if not spark.catalog.tableExists(self.name):
            spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
                      f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                      f"LOCATION '{self.path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def ingest(self, rows: DataFrame) -> None:
        """Append the digests of ``rows`` (digest, doc_id) that the index lacks, each
        with its smallest doc_id."""
        # written first: the optimiser would move the anti join below the aggregate, to where
        # all rows of a hot digest still are
        new = written(rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id")), "new_digests")
        fresh = new.join(self.table().select("digest").hint("merge"), "digest", "left_anti")
        (fresh.write.mode("append").format("parquet").option("path", self.path)
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))


def _groups(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """(digest, keep_id, group_size, n_keep): n_keep rows carry keep_id itself."""
    sizes = (rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("digest").agg(F.sum("n").alias("group_size"),
                                    F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "n")).alias("first")))
    return (sizes.join(index.table().hint("merge"), "digest")
            .select("digest", "keep_id", "group_size", F.col("first.n").alias("n_keep")))


def _with_groups(rows: DataFrame, groups: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` with their group's columns; the few hot digests by broadcast, the
    rest, which has no large group, by a join on the digest."""
    hot = groups.where(F.col("group_size") >= max(HOT_ROWS, n_rows // HOT_DIGESTS))
    hot_rows = rows.join(F.broadcast(hot), "digest")
    rest = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(groups, "digest")
    return hot_rows.unionByName(rest)


def dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Two batches in doc_id order are ingested, so the id that the index has for a
    digest is its smallest. With an ``index`` of earlier runs, digests known there
    keep the id recorded then.
    """
    rows = written(texts(docs).select("doc_id", digest(F.col("text")).alias("digest")), "digests")
    index = index or DigestIndex(docs.sparkSession)
    span = rows.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if span.a is not None:
        half = F.lit(span.a + (span.b - span.a) // 2)
        index.ingest(rows.where(F.col("doc_id") <= half))
        index.ingest(rows.where(F.col("doc_id") > half))
    index.ingest(rows.where(F.col("doc_id").isNull()))
    groups = written(_groups(rows, index), "digest_groups")
    return _with_groups(rows, groups, span.n).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: of each group the row with the
    smallest doc_id, once even when that row is repeated."""
    decisions = written(dedup(docs), "digest_decisions")
    keep = (decisions.where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("__n"))
            .select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__digest"), "__n"))
    marked = (docs.withColumn("__digest", digest(F.col("text"))).alias("d")
              .join(keep.alias("k"), F.col("d.doc_id").cast("bigint").eqNullSafe(F.col("k.__id"))
                    & (F.col("d.__digest") == F.col("k.__digest"))))
    cols = [F.col(f"d.`{c}`") for c in docs.columns]
    once = marked.where("k.__n = 1").select(*cols)
    repeated = marked.where("k.__n > 1").select(*cols, F.col("d.__digest").alias("__digest"))
    return once.unionByName(repeated.dropDuplicates(["doc_id", "__digest"]).drop("__digest"))
