"""The command line, run inside the test session."""

from shoplens import streaming
from shoplens.__main__ import main
from shoplens.sinks import replace_table
from shoplens.sources.clicks import read_click_lines, reject_counts
from tests.conftest import action, actions_df

T0 = 1_543_190_400_000      # 2018-11-26 00:00:00 UTC


def _lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_streaming_commands_keep_rejects(spark, tmp_path):
    src = str(tmp_path / "lines")
    _lines(spark, src, [f"{T0} n bj u1 1", f"{T0 + 20 * 3_600_000} n bj u1 1 sixth", "short line", f"x{T0} n bj u1 1"])
    daily, bl, trend = (str(tmp_path / x) for x in ("daily", "blacklist", "trend"))
    common = ["--format", "text", "--path", src, "--available-now", "--state-partitions", "2", "--full-every", "5"]
    assert main(["ads-daily", *common, "--out", daily, "--tz", "Asia/Shanghai"]) == 0
    assert sorted((r.day, r.clicks) for r in streaming.read_daily_totals(spark, daily).collect()) == [
        ("2018-11-26", 1), ("2018-11-27", 1)]
    assert {r.reason: r.lines for r in reject_counts(read_click_lines(spark, f"{daily}/rejects")).collect()} == {
        "too few fields": 1, "bad time": 1}
    assert main(["blacklist", *common, "--out", bl, "--threshold", "2", "--rejects", str(tmp_path / "bad")]) == 0
    assert [r.userid for r in streaming.read_blacklist(spark, bl).collect()] == ["u1"]
    assert read_click_lines(spark, str(tmp_path / "bad")).count() == 2
    top = str(tmp_path / "top")
    assert main(["ads-top", *common, "--out", top, "--tz", "UTC"]) == 0
    assert [(r.day, r.rank, r.clicks) for r in streaming.read_top_ads(spark, top, full_every=5).collect()] == [("2018-11-26", 1, 2)]
    assert main(["ads-trend", *common, "--out", trend, "--bucket-ms", "3600000"]) == 0
    assert streaming.read_click_buckets(spark, trend).count() == 2


def test_page_jump_rate_command_orders_by_the_tie_column(spark, tmp_path):
    pages = [2, 1, 3]
    rows = [action(session_id="s", page_id=p, action_time="2018-11-26 10:00:00", action_seq=i) for i, p in enumerate(pages)]
    replace_table(actions_df(spark, rows), "cli_actions", path=str(tmp_path / "actions"))
    args = ["page-jump-rate", "--source", "cli_actions", "--params", '{"targetPageFlow": "1,2,3"}', "--dedupe", "none"]
    for extra, flows in ((["--tie", "action_seq", "--chunk", "none"], []), ([], ["1-2", "2-3"])):
        assert main([*args, *extra, "--target", "cli_rates"]) == 0
        assert sorted(r.flow for r in spark.table("cli_rates").collect()) == flows
    spark.sql("DROP TABLE cli_rates")
    spark.sql("DROP TABLE cli_actions")
