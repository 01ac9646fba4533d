import tempfile
import uuid

from shoplens.plans import jobs
from shoplens.params import JobParams
from shoplens.sources import testviews
from tests.conftest import SF_SMALL, action, actions_df


def test_one_task_id_per_run(spark):
    df = actions_df(spark, [action(click_category_id=c) for c in (1, 1, 2, 3)])
    out = jobs.category_top10_job(df, JobParams(), task_id="t-1").collect()
    assert {r.taskid for r in out} == {"t-1"} and [r.category_id for r in out] == ["1", "2", "3"]
    a, b = jobs.new_task_id(), jobs.new_task_id()
    assert a != b and len(a) == 36


def test_reports_written_to_tables(spark):
    path = tempfile.mkdtemp(prefix="shoplens-actions-") + "/actions"
    testviews.actions(spark, SF_SMALL).write.parquet(path)
    suffix = uuid.uuid4().hex[:6]
    targets = (f"top_{suffix}", f"sess_{suffix}")
    tid = jobs.run_category_reports(spark, path, '{"startDate": "", "endDate": "2024-01-31"}',
                                    targets=targets)
    top = spark.table(targets[0]).collect()
    sess = spark.table(targets[1]).collect()
    assert len(top) == 10 and {r.taskid for r in top} == {tid}
    assert {r.category_id for r in sess} <= {r.category_id for r in top}
    rate_tid = jobs.run_page_jump_rate(spark, path, '{"targetPageFlow": "1,2,3,4,5,6,7"}',
                                       target=f"rate_{suffix}", tie="action_seq")
    rates = spark.table(f"rate_{suffix}").collect()
    assert rates and {r.taskid for r in rates} == {rate_tid}
    for t in (*targets, f"rate_{suffix}"):
        spark.sql(f"DROP TABLE {t}")


def test_cli_page_jump_rate(spark, tmp_path):
    from shoplens.__main__ import main
    path = str(tmp_path / "actions")
    testviews.actions(spark, SF_SMALL).write.parquet(path)
    name = "cli_rate_" + uuid.uuid4().hex[:6]
    assert main(["page-jump-rate", "--source", path, "--params", '{"targetPageFlow": "1,2,3"}',
                 "--target", name, "--dedupe", "none", "--whole-percent"]) == 0
    rows = spark.table(name).collect()
    assert rows and all(isinstance(r.rate, int) for r in rows)
    spark.sql(f"DROP TABLE {name}")
