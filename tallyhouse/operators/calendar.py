"""A calendar with weekend, public-holiday, city-event and promotion columns.

The holiday rules are column arithmetic on the row's own year, so no holiday table is built or
joined and any span of years works.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Recurring city events as (month, day) and weekday promotions.
CITY_EVENTS = ((3, 14), (11, 8))
PROMOTIONS = {"Monday": "Banh Mi Monday", "Saturday": "Weekend Sharing Special"}
# Dated holidays as (month, day, name).
DATED_HOLIDAYS = (
    (1, 1, "New Year's Day"),
    (1, 26, "Australia Day"),
    (4, 25, "ANZAC Day"),
    (12, 25, "Christmas Day"),
    (12, 26, "Boxing Day"),
)
# N-th weekday holidays as (month, weekday, n, name).
WEEKDAY_HOLIDAYS = (
    (3, "Monday", 2, "Labour Day"),
    (6, "Monday", 2, "King's Birthday"),
    (11, "Tuesday", 1, "Melbourne Cup Day"),
)


def with_easter(days: DataFrame, day: str = "business_date") -> DataFrame:
    """Adds ``_easter``, Easter Sunday of the date's year, by Oudin's integer method.

    The method ends in an offset from 28 March.  Its steps are columns of their own, because each
    is used several times by the next.
    """
    steps = (
        f"year({day}) as _year",
        "_year div 100 as _century",
        "(_century - _century div 4 - (_century - (_century - 17) div 25) div 3 + 19 * (_year % 19) + 15) % 30 as _epact",
        "_epact - case when _epact = 29 or (_epact = 28 and _year % 19 > 10) then 1 else 0 end as _moon",
        "_moon - (_year + _year div 4 + _moon + 2 - _century + _century div 4) % 7 as _offset",
        "date_add(make_date(_year, 3, 28), int(_offset)) as _easter",
    )
    kept = days.columns
    for step in steps:
        days = days.selectExpr("*", step)
    return days.selectExpr(*kept, "_easter")


def nth_weekday(year: str, month: int, weekday: str, n: int) -> str:
    """The n-th given weekday of a month."""
    return f"date_add(next_day(date_sub(make_date({year}, {month}, 1), 1), '{weekday[:3]}'), {7 * (n - 1)})"


def _quoted(text: str) -> str:
    return '"' + text + '"'


def holiday_name(day: str = "business_date") -> str:
    """Name of the public holiday on a date with ``_easter``, NULL on ordinary days."""
    rules = [(f"{day} = date_sub(_easter, 2)", "Good Friday"), (f"{day} = date_add(_easter, 1)", "Easter Monday")]
    rules += [(f"month({day}) = {m} and dayofmonth({day}) = {d}", name) for m, d, name in DATED_HOLIDAYS]
    rules += [(f"{day} = {nth_weekday(f'year({day})', m, weekday, n)}", name) for m, weekday, n, name in WEEKDAY_HOLIDAYS]
    return "case " + " ".join(f"when {rule} then {_quoted(name)}" for rule, name in rules) + " end"


def day_spine(span: DataFrame) -> DataFrame:
    """Every date between ``first_date`` and ``last_date`` of a one-row frame."""
    return span.selectExpr("explode(sequence(first_date, last_date, interval 1 day)) as business_date")


def enrich_calendar(days: DataFrame) -> DataFrame:
    """Adds day name, the four calendar columns and the holiday's name to ``business_date``."""
    day = "business_date"
    events = " or ".join(f"(month({day}) = {m} and dayofmonth({day}) = {d})" for m, d in CITY_EVENTS)
    titles = " ".join(f"when {_quoted(weekday)} then {_quoted(title)}" for weekday, title in PROMOTIONS.items())
    named = with_easter(days).selectExpr(
        *days.columns, f"date_format({day}, 'EEEE') as day_name", f"{holiday_name(day)} as holiday_name"
    )
    return named.selectExpr(
        *days.columns,
        "day_name",
        f"weekday({day}) >= 5 as weekend_flag",
        "holiday_name is not null as public_holiday_flag",
        f"{events} as city_event_flag",
        f"case day_name {titles} end as promotion_name",
        "holiday_name",
    )
