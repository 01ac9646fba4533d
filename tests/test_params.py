import pytest

from shoplens.params import JobParams, parse_flow
from shoplens.streaming.jobs import interval_ms


def test_interval_forms():
    assert interval_ms("60 seconds") == 60_000
    assert interval_ms("1 hour") == 3_600_000
    assert interval_ms("6 hours") == 21_600_000
    assert interval_ms("500 milliseconds") == 500
    assert interval_ms("1 day") == 86_400_000
    assert interval_ms("1 minute 30 seconds") == 90_000
    with pytest.raises(ValueError):
        interval_ms("soon")


def test_parameter_document():
    p = JobParams.from_json('{"startDate": "2018-11-01", "endDate": null, "targetPageFlow": "1, 2,3"}')
    assert (p.start_date, p.end_date, p.target_page_flow) == ("2018-11-01", None, (1, 2, 3))
    assert JobParams.from_json("") == JobParams()
    assert JobParams.from_dict({"targetPageFlow": "  "}).target_page_flow == ()
    assert parse_flow([3, 4]) == (3, 4) and parse_flow("5,,6") == (5, 6)
