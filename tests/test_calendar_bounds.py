"""Facts after any fixed end of the calendar: kept, or an error that names them."""

import datetime as dt

import pytest

from ledgerlens.functions import calendar as C
from ledgerlens.operators.facts import on_calendar


@pytest.mark.parametrize("every_day", [False, True])
def test_facts_outside_of_the_calendar_are_an_error(spark, every_day):
    facts = spark.createDataFrame([(1999, 6, 1), (2005, 2, 1)], "year int, month int, n int")
    short = C.calendar_days(spark, dt.date(1999, 1, 1), dt.date(2001, 12, 31))
    with pytest.raises(Exception, match="outside of the calendar: 2005-2"):
        on_calendar(facts, short, every_day).collect()
    bounds = spark.createDataFrame([(dt.date(1999, 6, 3), dt.date(2005, 2, 9))], "lo date, hi date")
    got = on_calendar(facts, C.calendar_over(bounds), every_day).collect()
    assert len(got) == (30 + 28 if every_day else 2) and {r.calendar_date.year for r in got} == {1999, 2005}


def test_calendar_over_spans_whole_years(spark):
    bounds = spark.createDataFrame([(dt.date(1999, 6, 3), dt.date(2000, 2, 9))], "lo date, hi date")
    days = C.calendar_over(bounds)
    assert days.count() == 365 + 366 and days.columns == C.calendar_days(spark, dt.date(2000, 1, 1), dt.date(2000, 1, 2)).columns
    assert sorted(days.filter("year = 2000").collect()) == sorted(C.calendar_days(spark, dt.date(2000, 1, 1), dt.date(2000, 12, 31)).collect())
    assert C.calendar_over(spark.createDataFrame([(None, None)], "lo date, hi date")).count() == 0
