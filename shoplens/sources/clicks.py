"""Ad-click lines ``"<epoch-ms> <area> <city> <userid> <adid>"`` (single spaces).

The same parser serves batch and streaming DataFrames. Fields are read by position:
whatever follows the fifth is ignored, as the original jobs do. Lines that do not
parse go to a rejects DataFrame instead of failing the task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from shoplens.defaults import LINE_SEPARATOR
from shoplens.schemas import CLICK_LINE

NULL_FIELD = "\\N"      # a null area, city, user or ad in a line
_FIELDS = ["ts_ms", "area", "city", "userid", "adid"]
GOOD = "good"
REASONS = ("null line", "too few fields", "bad time")


def _split(lines: DataFrame, col: str) -> DataFrame:
    # rtrim first: a trailing separator yields no trailing empty field (as a
    # Java String.split would drop it).
    return lines.withColumn("_parts", F.split(F.rtrim(F.col(col)), LINE_SEPARATOR))


def _ok(strict: bool):
    n = F.size("_parts")
    enough = (n == 5) if strict else (n >= 5)
    ts_ok = F.get("_parts", 0).try_cast("bigint").isNotNull()
    return F.coalesce(enough & ts_ok, F.lit(False))


def parse_ad_clicks(lines: DataFrame, col: str = "value", strict: bool = False,
                    keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Lines -> (clicks, rejects).

    ``strict`` also rejects lines with more than five fields. ``keep`` carries extra
    input columns (e.g. a tie-break id) through to the clicks. A null field of the
    original click (``NULL_FIELD``) comes back as null.
    """
    parts = _split(lines, col)
    ok = _ok(strict)
    clicks = parts.where(ok).select(
        F.get("_parts", 0).cast("bigint").alias("ts_ms"),
        *[F.nullif(F.get("_parts", i), F.lit(NULL_FIELD)).alias(name) for i, name in enumerate(_FIELDS) if i > 0],
        *[F.col(k) for k in keep],
    )
    rejects = parts.where(~ok).select(F.col(col).alias("value"))
    return clicks, rejects


def click_lines(clicks: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The inverse of the parser: typed clicks -> ``value`` lines (and the columns ``keep``). A null field is
    written as ``NULL_FIELD``, so a line always has five fields (a null time still
    makes a line that is rejected)."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_FIELD)) for c in _FIELDS]
    return clicks.select(F.concat_ws(LINE_SEPARATOR, *fields).alias("value"), *keep)


def _reason(col: str = "value"):
    few = F.size(F.split(F.rtrim(col), LINE_SEPARATOR)) < len(_FIELDS)
    return F.when(F.col(col).isNull(), REASONS[0]).when(few, REASONS[1]).otherwise(REASONS[2])


def reject_counts(rejects: DataFrame) -> DataFrame:
    """(reason, lines): how many lines were rejected and why."""
    return rejects.groupBy(_reason().alias("reason")).agg(F.count("*").alias("lines"))


def parse_counted(lines: DataFrame, metrics: str | Observation, col: str = "value", strict: bool = False) -> DataFrame:
    """The clicks of ``parse_ad_clicks``, with the lines counted by outcome in the same pass:
    observed metrics ``good``, ``null line``, ``too few fields`` and ``bad time`` (more fields
    than five, too, if ``strict``).

    ``metrics`` is an ``Observation`` (batch; filled by the action that reads the clicks) or
    a name, under which each micro-batch of a stream reports them in its progress
    (``observed_counts``)."""
    marked = _split(lines, col).withColumn("_good", _ok(strict))
    reason = F.when(F.col("_good"), F.lit(GOOD)).otherwise(_reason(col))
    counts = [F.count(F.when(reason == r, F.lit(1))).alias(r) for r in (GOOD, *REASONS)]
    observed = marked.observe(metrics, *counts).where("_good")
    return observed.select(
        F.get("_parts", 0).cast("bigint").alias("ts_ms"),
        *[F.nullif(F.get("_parts", i), F.lit(NULL_FIELD)).alias(name) for i, name in enumerate(_FIELDS) if i > 0])


def observed_counts(progress: list, name: str) -> dict[str, int]:
    """Lines by outcome over the micro-batches of ``query.recentProgress``."""
    total = dict.fromkeys((GOOD, *REASONS), 0)
    for p in progress:
        row = p.observedMetrics.get(name)
        for r in total:
            total[r] += row[r] if row is not None else 0
    return total


def write_rejects_stream(rejects: DataFrame, path: str, checkpoint: str | None = None, trigger: dict | None = None):
    """Keep the rejected lines of a stream: appended as text files below ``path``, where
    ``read_click_lines`` and ``reject_counts`` find them."""
    w = (rejects.select(F.coalesce("value", F.lit("")).alias("value")).writeStream.format("text").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint or f"{path}/_checkpoint"))
    return (w.trigger(**trigger) if trigger else w).start()


def write_click_lines(clicks: DataFrame, path: str, fmt: str = "text", partition_by: list[str] | None = None, **options) -> None:
    """Publish lines: ``fmt='text'`` appends files to a folder a stream reads, with a folder
    per value of the columns ``partition_by``; ``fmt='kafka'`` (needs the Kafka connector
    on the classpath) writes to a topic."""
    writer = click_lines(clicks, tuple(partition_by or ())).write.format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("append").save(path)


def read_click_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files; folders named ``column=value`` give that column."""
    return spark.read.text(path)


def read_click_lines_stream(spark: SparkSession, fmt: str = "text", path: str | None = None,
                            **options) -> DataFrame:
    """A streaming DataFrame with one string column ``value``.

    ``fmt='kafka'`` takes the usual options (``kafka.bootstrap.servers``,
    ``subscribe``, ``startingOffsets='latest'``); offsets are tracked in the
    query checkpoint. ``fmt='text'`` reads files dropped into ``path``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string").alias("value"))
    return reader.schema(CLICK_LINE).load(path)

