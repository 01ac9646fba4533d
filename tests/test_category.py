from pyspark.sql import functions as F

from shoplens.operators import category
from shoplens.operators.filters import in_action_time_range
from shoplens.params import JobParams, is_not_blank
from tests.conftest import action, actions_df


def _counts(df):
    return {r.category_id: (r.click_count, r.order_count, r.pay_count)
            for r in category.category_counts(df).collect()}


def test_precedence_click_over_order_over_pay(spark):
    # actions_precedence
    df = actions_df(spark, [
        action(click_category_id=5, order_category_ids="6", pay_category_ids="7"),
        action(order_category_ids="8", pay_category_ids="9"),
        action(pay_category_ids="10"),
        action(search_keyword="phone"),
    ])
    assert _counts(df) == {"5": (1, 0, 0), "8": (0, 1, 0), "10": (0, 0, 1)}


def test_id_lists_repeat_and_nulls(spark):
    # actions_lists
    df = actions_df(spark, [
        action(order_category_ids="1,1,2"),
        action(order_category_ids=None, pay_category_ids=None),
        action(click_category_id=None, pay_category_ids="3"),
        action(click_category_id=-1, order_category_ids="2"),
    ])
    assert _counts(df) == {"1": (0, 2, 0), "2": (0, 2, 0), "3": (0, 0, 1)}


def test_top10_ties_are_deterministic(spark):
    # actions_ties: 12 categories, several with equal counts
    rows = []
    for cid, clicks in [(1, 3), (2, 3), (3, 3), (4, 2), (5, 2), (6, 2), (7, 2), (8, 1), (9, 1),
                        (10, 1), (11, 1), (12, 1)]:
        rows += [action(click_category_id=cid)] * clicks
    rows.append(action(order_category_ids="9"))       # orders break the tie for 9
    df = actions_df(spark, rows)
    top = [r.category_id for r in category.top_categories(df, 10).collect()]
    # equal (click, order, pay) counts are ordered by category_id as a string
    assert top == ["1", "2", "3", "4", "5", "6", "7", "9", "10", "11"]


def test_top_sessions_per_category(spark):
    rows = []
    for sess, n in [("a", 3), ("b", 1), ("c", 3), ("d", 2)]:
        rows += [action(session_id=sess, click_category_id=1)] * n
    rows += [action(session_id="z", click_category_id=2)] * 5
    rows += [action(session_id="y", click_category_id=3)]
    df = actions_df(spark, rows)
    got = [(r.category_id, r.session_id, r.click_count)
           for r in category.top_sessions(df, n_categories=2, n_sessions=3)
           .orderBy("category_id", F.desc("click_count"), "session_id").collect()]
    assert got == [("1", "a", 3), ("1", "c", 3), ("1", "d", 2), ("2", "z", 5)]


def test_time_range_is_a_string_comparison(spark):
    # actions_bounds: endDate 2018-11-26 excludes that day's rows; blank start is skipped
    df = actions_df(spark, [
        action(date="2018-11-25", action_time="2018-11-25 23:59:59"),
        action(date="2018-11-26", action_time="2018-11-26 00:00:00"),
        action(date="2018-11-26", action_time="2018-11-26 10:00:00"),
    ])
    p = JobParams.from_json('{"startDate": "  ", "endDate": "2018-11-26"}')
    assert p.start_date is None and p.end_date == "2018-11-26"
    got = [r.action_time for r in in_action_time_range(df, p.start_date, p.end_date).collect()]
    assert got == ["2018-11-25 23:59:59"]
    got = [r.action_time for r in in_action_time_range(df, "2018-11-26 00:00:00", None).collect()]
    assert sorted(got) == ["2018-11-26 00:00:00", "2018-11-26 10:00:00"]


def test_time_range_adds_partition_predicate(spark):
    df = actions_df(spark, [action()])
    plan = in_action_time_range(df, "2018-11-25 10:00:00", "2018-11-27", date_col="date")._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "date" in plan and "2018-11-25" in plan


def test_params():
    p = JobParams.from_json('{"targetPageFlow": "1,2,3,4"}')
    assert p.target_page_flow == (1, 2, 3, 4)
    assert not is_not_blank(None) and not is_not_blank(" ") and is_not_blank("x")


def test_date_partitions_are_pruned(spark, tmp_path):
    df = actions_df(spark, [action(date=d, action_time=f"{d} 10:00:00") for d in
                            ("2018-11-24", "2018-11-25", "2018-11-26", "2018-11-27")])
    path = str(tmp_path / "log")
    df.write.partitionBy("date").parquet(path)
    from shoplens.sources.actions import read_actions
    logged = read_actions(spark, path)
    q = in_action_time_range(logged, "2018-11-25 00:00:00", "2018-11-26", date_col="date")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2018-11-25" in plan
    assert [r.date for r in q.collect()] == ["2018-11-25"]


def test_only_the_action_time_decides_unless_a_date_column_is_named(spark):
    rows = [action(date=d, action_time="2018-11-26 10:00:00", city_id=i) for i, d in
            enumerate([None, "20181126", "2018-11-26"])]
    df = actions_df(spark, rows)
    kept = in_action_time_range(df, "2018-11-25", "2018-11-27")
    assert sorted(r.city_id for r in kept.collect()) == [0, 1, 2]


def test_id_lists_drop_trailing_empties_only(spark):
    from shoplens.functions.ids import id_list
    lists = {"1,2,": ["1", "2"], "1,,2,,": ["1", "", "2"], ",3": ["", "3"], ",,": [], "": [""], "7": ["7"], None: None}
    df = spark.createDataFrame([(x,) for x in lists], "ids string")
    assert {r.ids: r.got for r in df.select("ids", id_list("ids").alias("got")).collect()} == lists


def test_a_callers_category_list_is_not_forced_into_a_broadcast(spark):
    from shoplens.operators.category import top_sessions
    df = actions_df(spark, [action(click_category_id=3, session_id="a"), action(click_category_id=4, session_id="b")])
    cats = spark.createDataFrame([("3",), ("4",)], "category_id string")
    got = top_sessions(df, categories=cats)
    assert sorted(map(tuple, got.collect())) == [("3", "a", 1), ("4", "b", 1)]
    assert "ResolvedHint" not in got._jdf.queryExecution().analyzed().toString()
