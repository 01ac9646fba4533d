"""Folders of micro-batches: what batch ``b`` of a stream writes goes to
``<path>/batch=<b>`` in overwrite mode, so a replayed batch replaces its own output.
Readers see the batch as a partition column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shoplens.session import path_exists

# every so many batches, a batch writes all current rows instead of the changed ones
FULL_EVERY = 10


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch={int(batch_id)}"


def write_batch(df: DataFrame, path: str, batch_id: int, spark: SparkSession | None = None) -> DataFrame:
    """Write one batch's rows; returns them as read from the files. ``spark``: the session
    that goes on with them (a stream's own session has adaptive execution off)."""
    where = batch_path(path, batch_id)
    df.write.mode("overwrite").parquet(where)
    return (spark or df.sparkSession).read.schema(df.schema).parquet(where)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches with column ``batch``; empty before the first one."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(full).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], full)


def since_full(rows: DataFrame, batch_id: int, every: int) -> DataFrame:
    """The rows of the batches before ``batch_id``, from the last full one on (batch 0
    and every ``every``-th are full): at most ``every`` folders, whatever ran before."""
    last = max(int(batch_id) - 1, 0) // every * every
    return rows.where(f"batch >= {last} and batch < {int(batch_id)}")
