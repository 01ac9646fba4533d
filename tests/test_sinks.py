import tempfile
import uuid

import pytest

from shoplens.session import checkpoint_root, shared_path
from shoplens.schemas import DAILY_TOTALS
from shoplens.sinks import read_batches, replace_table, replace_version, write_batch
from shoplens.sinks.batches import since_full
from shoplens.sources.clicks import (
    observed_counts, parse_ad_clicks, parse_counted, read_click_lines, reject_counts, write_click_lines, write_rejects_stream,
)
from tests.conftest import clicks_df


def test_replace_table_round_trip(spark):
    df = spark.createDataFrame([("1", 3), ("2", 1)], "category_id string, click_count long")
    name = "t_" + uuid.uuid4().hex[:8]
    replace_table(df, name)
    replace_table(df, name)               # replacing an existing table works too
    assert sorted(map(tuple, spark.table(name).collect())) == [("1", 3), ("2", 1)]
    spark.sql(f"DROP TABLE {name}")


def test_text_lines_publish_and_read(spark):
    path = tempfile.mkdtemp(prefix="shoplens-topic-") + "/ads"
    write_click_lines(clicks_df(spark, [(1, "a", "c", "u", "1"), (2, "b", "d", "v", "2")]), path)
    assert sorted(r.value for r in read_click_lines(spark, path).collect()) == ["1 a c u 1", "2 b d v 2"]


def test_shared_path_uses_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root and shared_path(spark, "x").startswith(root + "/shoplens/")
    assert shared_path(spark, "x", unique=True) != shared_path(spark, "x", unique=True)


def test_kafka_source_needs_connector(spark):
    from shoplens.sources.clicks import read_click_lines_stream
    with pytest.raises(Exception):
        read_click_lines_stream(spark, "kafka", **{"kafka.bootstrap.servers": "none:0",
                                                   "subscribe": "ads_log"})


def test_read_actions_from_catalog_table(spark):
    from shoplens.sources.actions import read_actions
    from tests.conftest import action, actions_df
    name = "actions_" + uuid.uuid4().hex[:6]
    replace_table(actions_df(spark, [action(page_id=3)]), name)
    df = read_actions(spark, name)
    assert df.schema["page_id"].dataType.simpleString() == "bigint"
    assert [r.page_id for r in df.collect()] == [3]
    spark.sql(f"DROP TABLE {name}")


def test_preview_shows_first_rows(spark, capsys):
    from shoplens.sinks import preview
    df = spark.range(500).withColumnRenamed("id", "n")
    head = preview(df, 100)
    assert head.count() == 100
    out = capsys.readouterr().out
    assert "|n  |" in out and "|99 |" in out and "|100|" not in out


def _totals(spark, rows):
    return spark.createDataFrame([(d, "a", "c", ad, n) for d, ad, n in rows], DAILY_TOTALS)


def _rows(df):
    return sorted((r.day, r.adid, r.clicks, r.batch) for r in df.collect())


def test_a_replayed_batch_replaces_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    assert read_batches(spark, path, DAILY_TOTALS).count() == 0
    write_batch(_totals(spark, [("d1", "1", 1)]), path, 0)
    write_batch(_totals(spark, [("d1", "1", 2), ("d2", "1", 1)]), path, 1)
    back = write_batch(_totals(spark, [("d1", "1", 3)]), path, 1)             # the same batch again
    assert back.count() == 1
    assert _rows(read_batches(spark, path, DAILY_TOTALS)) == [("d1", "1", 1, 0), ("d1", "1", 3, 1)]


def test_rows_since_the_last_full_batch(spark, tmp_path):
    path = str(tmp_path / "out")
    for b in range(9):
        write_batch(_totals(spark, [("d", "1", b)]), path, b)
    rows = read_batches(spark, path, DAILY_TOTALS)
    assert [sorted(r.batch for r in since_full(rows, b, 4).collect()) for b in (0, 1, 4, 5, 9)] == [
        [], [0], [0, 1, 2, 3], [4], [8]]
    plan = since_full(rows, 9, 4)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan


def test_a_view_is_switched_without_a_gap(spark, tmp_path):
    name = "versions_" + uuid.uuid4().hex[:8]
    replace_version(spark.createDataFrame([(1,)], "n int"), name, str(tmp_path))
    began = spark.table(name)
    seen = []

    class Slow:
        """Stands between the write of the new version and the switch of the view."""
        def __init__(self, df):
            self.df, self.sparkSession = df, self

        @property
        def write(self):
            return self.df.write

        def sql(self, text):
            seen.append([r.n for r in spark.table(name).collect()])
            return spark.sql(text)

    replace_version(Slow(spark.createDataFrame([(2,), (3,)], "n int")), name, str(tmp_path))
    assert seen == [[1]]                                   # between the two steps: the old rows
    assert sorted(r.n for r in spark.table(name).collect()) == [2, 3]
    assert [r.n for r in began.collect()] == [1]           # a reader that had begun goes on
    replace_version(spark.createDataFrame([("x", 1)], "m string, n int"), name, str(tmp_path))   # another shape
    assert spark.table(name).columns == ["m", "n"]
    spark.sql(f"DROP VIEW {name}")


LINES = ["1 a c u 1", "2 a c u 1 more fields", "3 a c u", "x a c u 1", "", None, "4 a c u 1 "]


@pytest.mark.parametrize("strict", [False, True])
def test_lines_are_counted_in_the_pass_that_reads_them(spark, strict):
    from pyspark.sql import Observation
    df = spark.createDataFrame([(x,) for x in LINES], "value string").repartition(3)
    seen = Observation("lines")
    got = parse_counted(df, seen, strict=strict).collect()
    clicks, rejects = parse_ad_clicks(df, strict=strict)
    assert sorted(map(tuple, got)) == sorted(map(tuple, clicks.collect()))
    exp = {"good": clicks.count(), "null line": 0, "too few fields": 0, "bad time": 0}
    exp.update({r.reason: r.lines for r in reject_counts(rejects).collect()})
    assert seen.get == exp


def test_lines_of_a_stream_are_counted_by_its_progress(spark, tmp_path):
    from shoplens.sources.clicks import read_click_lines_stream
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([(x or "",) for x in LINES], "value string").repartition(4).write.text(src)
    clicks = parse_counted(read_click_lines_stream(spark, "text", src, maxFilesPerTrigger=1), "lines")
    q = (clicks.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert len(q.recentProgress) > 1
    assert observed_counts(q.recentProgress, "lines") == {"good": 3, "null line": 0, "too few fields": 3, "bad time": 1}
    assert spark.read.parquet(out).count() == 3


def test_lines_are_read_by_position_and_rejects_kept(spark, tmp_path):
    lines = ["1 a c u 1", "2 a c u 1 more fields", "3 a c u", "x a c u 1", "", None, "4 a c u 1 "]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    clicks, rejects = parse_ad_clicks(df)
    assert sorted(r.ts_ms for r in clicks.collect()) == [1, 2, 4]
    assert {r.reason: r.lines for r in reject_counts(rejects).collect()} == {
        "too few fields": 2, "bad time": 1, "null line": 1}
    strict, rest = parse_ad_clicks(df, strict=True)
    assert sorted(r.ts_ms for r in strict.collect()) == [1, 4] and rest.count() == 5


def test_null_fields_survive_the_line_format(spark):
    from shoplens.sources.clicks import click_lines
    rows = [(1, None, "c", "u", "1"), (2, "a", None, None, "1"), (None, "a", "c", "u", "1")]
    clicks, rejects = parse_ad_clicks(click_lines(clicks_df(spark, rows)))
    assert sorted(map(tuple, clicks.collect())) == rows[:2]
    assert rejects.count() == 1


def test_rejected_lines_of_a_stream_are_kept(spark, tmp_path):
    from shoplens.sources.clicks import read_click_lines_stream
    src, out = str(tmp_path / "src"), str(tmp_path / "rejects")
    spark.createDataFrame([("1 a c u 1",), ("bad",), ("x a c u 1",)], "value string").write.text(src)
    _, rejects = parse_ad_clicks(read_click_lines_stream(spark, "text", src))
    q = write_rejects_stream(rejects, out, trigger={"availableNow": True})
    q.awaitTermination()
    assert sorted(r.value for r in read_click_lines(spark, out).collect()) == ["bad", "x a c u 1"]
