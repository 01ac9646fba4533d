import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from shoplens.schemas import ACTION, AD_CLICK  # noqa: E402
from shoplens.session import build_session, remove_run_folder  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="shoplens-tests", shuffle_partitions=4)
    yield s
    remove_run_folder(s)
    s.stop()


def action(date="2018-11-26", user_id=1, session_id="s1", page_id=1,
           action_time="2018-11-26 10:00:00", search_keyword=None, click_category_id=-1,
           click_product_id=-1, order_category_ids=None, order_product_ids=None,
           pay_category_ids=None, pay_product_ids=None, city_id=1, action_seq=0):
    return (date, user_id, session_id, page_id, action_time, search_keyword, click_category_id,
            click_product_id, order_category_ids, order_product_ids, pay_category_ids,
            pay_product_ids, city_id, action_seq)


def actions_df(spark, rows):
    from pyspark.sql import types as T
    schema = T.StructType(ACTION.fields + [T.StructField("action_seq", T.LongType())])
    return spark.createDataFrame(rows, schema)


def clicks_df(spark, rows):
    """rows: (ts_ms, area, city, userid, adid)"""
    return spark.createDataFrame(rows, AD_CLICK)
