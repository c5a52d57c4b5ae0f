"""numeric times of any calendar, as integer arithmetic on columns.

A moment is carried as parts, a struct of year, month, day, hour, minute, second and microsecond, so that dates which the
civil calendar lacks (30 February of a 360-day year, 29 February of years that are not leap) survive. Every calendar
counts its days from 1 March of its year 0: years begin in March, so that the leap day is a year's last and months follow
one formula. Floating-point values are split into whole units and the rest, so that microseconds stay exact.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of a calendar, by the one used here. The standard calendar is Julian before 15 October 1582.
CALENDARS = {
    "standard": ("standard", "gregorian"),
    "proleptic_gregorian": ("proleptic_gregorian",),
    "julian": ("julian",),
    "noleap": ("noleap", "365_day"),
    "all_leap": ("all_leap", "366_day"),
    "360_day": ("360_day",),
}
#: Microseconds of a unit, by its names.
UNITS = {
    1: ("microseconds", "microsecond", "microsec", "microsecs"),
    1_000: ("milliseconds", "millisecond", "millisec", "millisecs", "msec", "msecs", "ms"),
    1_000_000: ("seconds", "second", "secs", "sec", "s"),
    60_000_000: ("minutes", "minute", "mins", "min"),
    3_600_000_000: ("hours", "hour", "hrs", "hr", "h"),
    86_400_000_000: ("days", "day", "d"),
}
DAY = 86_400_000_000
PARTS = ("year", "month", "day", "hour", "minute", "second", "microsecond")
_SINCE = re.compile(r"^\s*(\w+)\s+since\s+([+-]?\d+)-(\d{1,2})-(\d{1,2})(?:[T\s]+(\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:\.(\d{1,6})\d*)?)?)?\s*(?:(Z|UTC|GMT)|([+-])(\d{1,2})(?::?(\d{2}))?)?\s*$", re.IGNORECASE)


class Units(NamedTuple):
    """Microseconds of the unit, and of the epoch its date and the microseconds since midnight (UTC; may be negative)."""

    size: int
    date: tuple[int, int, int]
    micros: int


def calendar_name(name: str) -> str:
    for own, names in CALENDARS.items():
        if name.lower() in names:
            return own
    raise ValueError(f"no calendar {name!r}")


def parse_units(text: str) -> Units:
    """Of "days since 1850-01-01 06:00:00" and the like; an offset from UTC may follow."""
    m = _SINCE.match(text)
    size = next((n for n, names in UNITS.items() if m and m[1].lower() in names), None)
    if size is None:
        raise ValueError(f"no time units {text!r}")
    clock = ((int(m[5] or 0) * 60 + int(m[6] or 0)) * 60 + int(m[7] or 0)) * 1_000_000 + int((m[8] or "0").ljust(6, "0"))
    zone = (int(m[11]) * 60 + int(m[12] or 0)) * 60_000_000 * (-1 if m[10] == "-" else 1) if m[10] else 0
    return Units(size, (int(m[2]), int(m[3]), int(m[4])), clock - zone)


def _div(a, b):  # noqa: ANN001, ANN202
    """a / b rounded down, of integers or of integer columns."""
    return F.floor(a / b) if isinstance(a, Column) else a // b


def _if(test, yes, no):  # noqa: ANN001, ANN202
    return F.when(test, yes).otherwise(no) if isinstance(test, Column) else yes if test else no


def _before(calendar: str, y):  # noqa: ANN001, ANN202
    """Days of the years (from March) before year y."""
    if calendar == "proleptic_gregorian":
        return 365 * y + _div(y, 4) - _div(y, 100) + _div(y, 400)
    if calendar == "julian":
        return 365 * y + _div(y, 4)
    return {"noleap": 365, "all_leap": 366}[calendar] * y


def _number(calendar: str, year, month, day):  # noqa: ANN001, ANN202
    if calendar == "360_day":
        return 360 * year + 30 * month + day - 91
    y, m = _if(month <= 2, year - 1, year), (month + 9) % 12
    return _before(calendar, y) + _div(153 * m + 2, 5) + day - 1


#: The first day of the civil calendar in either count.
_SWITCH, _SWITCH_JULIAN = _number("proleptic_gregorian", 1582, 10, 15), _number("julian", 1582, 10, 5)


def day_number(calendar: str, year, month, day):  # noqa: ANN001, ANN201
    """Days since 1 March of year 0 of a date's integers (columns or plain); consecutive days differ by one."""
    calendar = calendar_name(calendar)
    if calendar != "standard":
        return _number(calendar, year, month, day)
    civil = (year * 100 + month) * 100 + day >= 15821015
    return _if(civil, _number("proleptic_gregorian", year, month, day), _number("julian", year, month, day) - _SWITCH_JULIAN + _SWITCH)


def _let(value: Column | str, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once, however often body uses it.

    A column given by its name is a value already. An expression becomes the variable of a lambda function, which Spark
    does not compile: of large tables, select it into a column and give that column's name.
    """
    return body(F.col(value)) if isinstance(value, str) else F.transform(F.array(value), body)[0]


def _date(calendar: str, n: Column) -> tuple[Column, Column, Column]:
    """Year, month and day in closed form: n stands in them three or five times, and nothing grows by that."""
    if calendar == "360_day":
        return _div(n + 60, 360), _div(F.pmod(n + 60, F.lit(360)), 30) + 1, F.pmod(n + 60, F.lit(30)) + 1
    if calendar == "proleptic_gregorian":  # quarter days of 400 years, then of 4
        century = 4 * n + 3
        left = 4 * _div(F.pmod(century, F.lit(146_097)), 4) + 3
        year, day = 100 * _div(century, 146_097) + _div(left, 1461), _div(F.pmod(left, F.lit(1461)), 4)
    elif calendar == "julian":
        left = 4 * n + 3
        year, day = _div(left, 1461), _div(F.pmod(left, F.lit(1461)), 4)
    else:
        size = _before(calendar, 1)
        year, day = _div(n, size), F.pmod(n, F.lit(size))
    months = 5 * day + 2  # 153 for a month from March on
    return year + _div(months, 1530), (_div(months, 153) + 2) % 12 + 1, _div(F.pmod(months, F.lit(153)), 5) + 1


def _date_of(calendar: str, n: Column) -> list[Column]:
    """Year, month and day as columns of their own."""
    if calendar == "standard":
        either = zip(_date("proleptic_gregorian", n), _date("julian", n - _SWITCH + _SWITCH_JULIAN))
        found = [_if(n >= _SWITCH, civil, julian) for civil, julian in either]
    else:
        found = _date(calendar, n)
    return [x.cast("int").alias(p) for x, p in zip(found, PARTS)]


def date_of(calendar: str, n: Column | str) -> Column:
    """A struct of year, month and day of a day_number()."""
    calendar = calendar_name(calendar)
    return _let(n, lambda n: F.struct(*_date_of(calendar, n)))


def decode(value: Column | str, units: str, calendar: str = "standard") -> Column:
    """Parts of a numeric time; null of null, NaN and infinities. See _let() of names."""
    calendar = calendar_name(calendar)
    size, date, micros = parse_units(units)
    per_day, epoch = DAY // size, day_number(calendar, *date)

    def split(value: Column) -> Column:
        number = value.cast("double")
        whole = F.floor(number)
        clock = F.pmod(whole, F.lit(per_day)) * size + F.round((number - whole) * size).cast("long") + micros
        rest = F.pmod(clock, F.lit(DAY))
        clocks = (_div(rest, 3_600_000_000), _div(rest, 60_000_000) % 60, _div(rest, 1_000_000) % 60, rest % 1_000_000)
        day = _date_of(calendar, _div(whole, per_day) + epoch + _div(clock, DAY))
        return F.when(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < 1e15), F.struct(*day, *[c.cast("int").alias(p) for c, p in zip(clocks, PARTS[3:])]))

    return _let(value, split)


def _number_of(calendar: str, parts: Column) -> Column:
    return day_number(calendar, *[parts[p].cast("long") for p in PARTS[:3]])


def _length(calendar: str, year: Column, month: Column) -> Column:
    """Days of a month."""
    if calendar == "360_day":
        return F.lit(30)
    julian = year % 4 == 0
    civil = julian & ((year % 100 != 0) | (year % 400 == 0))
    leap = {"noleap": F.lit(False), "all_leap": F.lit(True), "julian": julian, "proleptic_gregorian": civil, "standard": _if(year <= 1582, julian, civil)}[calendar]
    return F.when(month == 2, _if(leap, F.lit(29), F.lit(28))).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def _has(calendar: str, parts: Column) -> Column:
    year, month, day = (parts[p].cast("long") for p in PARTS[:3])
    known = month.between(1, 12) & day.between(F.lit(1), _length(calendar, year, month))
    return known & ~((year * 100 + month) * 100 + day).between(15821005, 15821014) if calendar == "standard" else known


def is_valid(parts: Column | str, calendar: str = "standard") -> Column:
    """Whether the calendar has the date of parts; null of null."""
    calendar = calendar_name(calendar)
    return _let(parts, lambda p: F.when(p.isNotNull(), _has(calendar, p)))


def encode(parts: Column | str, units: str, calendar: str = "standard", strict: bool = False) -> Column:
    """The numeric time of parts; of a date that the calendar lacks null, or with strict the end of the job. See _let() of names."""
    calendar = calendar_name(calendar)
    size, date, micros = parse_units(units)
    epoch = day_number(calendar, *date)

    def number(p: Column) -> Column:
        clock = ((p["hour"].cast("long") * 60 + p["minute"]) * 60 + p["second"]) * 1_000_000 + p["microsecond"] - micros
        days, rest = _number_of(calendar, p) - epoch + _div(clock, DAY), F.pmod(clock, F.lit(DAY))
        value = days.cast("double") * (DAY // size) + _div(rest, size) + (rest % size) / F.lit(float(size))
        name = F.format_string("%d-%02d-%02d", *[p[x] for x in PARTS[:3]])
        lacks = F.raise_error(F.concat(F.lit(f"the {calendar} calendar has no "), name)).cast("double") if strict else F.lit(None).cast("double")
        return F.when(p.isNotNull(), F.when(_has(calendar, p), value).otherwise(lacks))

    return _let(parts, number)


def rebase(value: Column | str, units: str, calendar: str, to_units: str, to_calendar: str | None = None, strict: bool = False) -> Column:
    """The numeric time in other units and, if given, another calendar: the same date there, see encode() of one that it lacks."""
    return encode(decode(value, units, calendar), to_units, to_calendar or calendar, strict)


def _first_of(calendar: str, year: Column) -> Column:
    return day_number(calendar, year, F.lit(1).cast("long"), F.lit(1).cast("long"))


def day_of_year(parts: Column, calendar: str = "standard") -> Column:
    """From 1."""
    return (_number_of(calendar, parts) - _first_of(calendar, parts["year"].cast("long")) + 1).cast("int")


def days_in_year(year: Column, calendar: str = "standard") -> Column:
    return (_first_of(calendar, year.cast("long") + 1) - _first_of(calendar, year.cast("long"))).cast("int")


def to_timestamp(parts: Column) -> Column:
    """A timestamp without zone of parts; null of a date that the civil calendar lacks."""
    seconds = (parts["second"] + parts["microsecond"] / F.lit(1_000_000).cast("decimal(8,0)")).cast("decimal(16,6)")
    return F.try_make_timestamp_ntz(parts["year"], parts["month"], parts["day"], parts["hour"], parts["minute"], seconds)


def from_timestamp(time: Column) -> Column:
    """Parts of a timestamp."""
    micros = F.extract(F.lit("SECOND"), time) * 1_000_000
    fields = (F.year(time), F.month(time), F.dayofmonth(time), F.hour(time), F.minute(time), F.second(time), micros % 1_000_000)
    return F.when(time.isNotNull(), F.struct(*[c.cast("int").alias(p) for c, p in zip(fields, PARTS)]))
