"""Reading documents, bounded Arrow batches and tables written to the shared folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplens.session import shared_path

# ASCII white space, as the contracts define it.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Let Python workers import this package wherever they run, and hand them at most
    ``rows`` rows and about ``size`` bytes at a time, so that very long texts don't add
    up to one huge Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="shoplens-")), "shoplens.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        sc.addPyFile(path)  # Spark copies it to every executor
        _SHIPPED.add(sc.applicationId)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, text); a null text is the empty text."""
    prepare(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# Spark deletes a query's shuffle files when the query ends; else they stay until the
# driver's garbage collector happens to run.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, *name: str) -> DataFrame:
    """``df`` written as Parquet to a new folder of the shared store and read back:
    later steps and lost executors start from the files, not from the lineage. The
    shuffle files of the write go with it."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", *name, unique=True)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
