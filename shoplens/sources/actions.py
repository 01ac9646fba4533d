"""The user-action log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplens.schemas import ACTION


def conform_actions(df: DataFrame) -> DataFrame:
    """Cast the known action columns to their types (a typed decode that stays a
    DataFrame); extra columns, such as a tie-break sequence, are kept."""
    known = {f.name: f.dataType for f in ACTION.fields}
    cols = [F.col(c).cast(known[c]).alias(c) if c in known else F.col(c) for c in df.columns]
    return df.select(*cols)


def partition_columns(df: DataFrame) -> set[str]:
    """Names of the partition columns of the files that ``df`` reads."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found: set[str] = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith("Relation") or leaf.getClass().getSimpleName() == "LogicalRelation":
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                found.update(relation.partitionSchema().fieldNames())
    return found


def read_actions(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table name or a path. Parquet brings its own columns, of which the known
    ones are cast; other formats are read with the schema given. Projections and filters
    written later reach the scan either way."""
    if "/" not in source and ":" not in source:
        return conform_actions(spark.table(source))
    if fmt == "parquet":
        # Keep extra columns of the files (e.g. a tie-break sequence) but type the known ones.
        return conform_actions(spark.read.parquet(source))
    return spark.read.format(fmt).schema(ACTION).load(source)
