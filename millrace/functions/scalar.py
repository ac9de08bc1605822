"""Scalar functions the SQL surface needs beyond Spark's own. All stay on the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def from_unixtime_tz(seconds: Column, pattern: str, zone: str) -> Column:
    """Unix seconds as text in a named zone, whatever the session zone is."""
    utc = F.timestamp_add("SECOND", seconds, F.expr(EPOCH))
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc), pattern)


def epoch_millis(stamp: Column, zoneless: bool) -> Column:
    """Milliseconds since 1970; a zone-less time is read as UTC."""
    if zoneless:
        return F.timestamp_diff("MILLISECOND", F.expr(EPOCH), stamp)
    return F.unix_millis(stamp)


def datediff_unit(start: Column, end: Column, unit: str = "DAY") -> Column:
    """Whole units from start to end, across years; MONTH of 2023-01-01 to 2024-03-01 is 14."""
    if unit.upper() == "DAY":
        return F.datediff(end, start).cast("bigint")
    return F.timestamp_diff(unit.upper(), start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))


def week(value: Column) -> Column:
    """ISO week number."""
    return F.weekofyear(value)


# The date forms that are recognised, each with the format that reads it, in matching order.
DATE_FORMS = [
    (r"\d{4}-\d{2}-\d{2}", "yyyy-MM-dd"),
    (r"\d{4}年\d{2}月\d{2}日", "yyyy年MM月dd日"),
    (r"\d{4}/\d{2}/\d{2}", "yyyy/MM/dd"),
    (r"\d{4}\.\d{2}\.\d{2}", "yyyy.MM.dd"),
    (r"\d{8}", "yyyyMMdd"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?Z?", None),
    (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
]
# The time forms that are recognised.
TIME_FORMS = [
    r"\d{2}:\d{2}:\d{2}",
    r"\d{2}:\d{2}:\d{2}.\d{3}",
]


def parse_date_auto(text: Column) -> Column:
    """A date from text in any recognised form; NULL when no form fits or the date does not exist."""

    def read(form: str | None) -> Column:
        # The ISO date-time starts with its date.
        return F.try_to_date(text, form) if form else F.try_to_date(F.left(text, F.lit(10)), "yyyy-MM-dd")

    branches = [(text.rlike(f"^(?:{pattern})$"), read(form)) for pattern, form in DATE_FORMS]
    chain = F.when(*branches[0])
    return reduce(lambda acc, branch: acc.when(*branch), branches[1:], chain)


def parse_time_auto(text: Column) -> Column:
    """Time of day as normal text ``HH:mm:ss[.SSS]``; NULL when no form fits or a part is out of range."""
    fits = text.rlike("^(?:%s)$" % "|".join(TIME_FORMS))
    normal = F.concat(F.left(text, F.lit(8)), F.when(F.length(text) > 8, F.concat(F.lit("."), F.right(text, F.lit(3)))).otherwise(""))
    in_range = normal.rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{3})?$")
    return F.when(fits & in_range, normal)
