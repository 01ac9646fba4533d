"""Catalog-table and JDBC sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from shoplens.session import shared_path


def replace_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
                  fmt: str = "parquet", path: str | None = None) -> None:
    """Replace a catalog table with ``df`` (created when absent). With ``path`` the
    table's files live there (an external table) instead of the warehouse."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def replace_version(df: DataFrame, name: str, path: str) -> str:
    """Replace what ``name`` shows with ``df``, without a gap: the rows are written to a new
    folder below ``path`` first, then the catalog view ``name`` is switched to it in one
    step. A reader sees the old rows or the new ones, never neither, and a reader that
    began on the old folder finishes on it (old folders stay until someone deletes
    them). Returns the new folder. ``name`` must not be a table."""
    folder = f"{path}/version={uuid.uuid4().hex}"
    df.write.parquet(folder)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    return folder


def staged(df: DataFrame, *name: str) -> DataFrame:
    """``df`` written to a new folder of the shared store and read back: what is read twice
    is computed once, and lost executors start again from the files."""
    path = shared_path(df.sparkSession, *name, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, user: str | None = None,
                password: str | None = None, driver: str | None = None,
                batchsize: int = 1000, num_partitions: int | None = None,
                **options) -> None:
    """Append rows to a database table over JDBC: one connection per write
    partition, inserts batched, columns matched by name. ``num_partitions`` caps
    concurrent connections (Spark coalesces to it)."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize), **options}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if num_partitions is not None:
        opts["numPartitions"] = str(num_partitions)
    df.write.format("jdbc").options(**opts).mode("append").save()


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` rows (printed), e.g. after writing a table."""
    head = df.limit(n)
    head.show(n, truncate=False)
    return head
