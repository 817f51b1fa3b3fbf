"""Reporting periods as column expressions: a code's first and last day, its kind, date ranges."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _int(text: Column) -> Column:
    return text.try_cast("int")



def _first_of(year: Column, month: Column) -> Column:
    """The first day of a month, or null where there is no such month."""
    return F.try_to_date(F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-01")))


def _monday(year: Column) -> Column:
    """The Monday of ISO week 1: the week that holds 4 January."""
    return F.date_trunc("week", F.try_to_date(F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-01-04")))).cast("date")


def _let(value: Column, use) -> Column:
    """use(value) with the value evaluated once, however often it is used; keeps the generated code small."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _start(p: Column) -> Column:
    code, year, rest, number = p["code"], p["year"], p["rest"], p["number"]
    week = F.date_add(_monday(year), ((number - 1) * 7).cast("int"))
    return (
        F.when(~code.rlike("^[0-9]{4}"), None)
        .when(rest == "", _first_of(year, F.lit(1)))
        .when(rest.rlike("^[0-9]{2}$"), _first_of(year, number))
        .when(rest.rlike("^[0-9]{4}$"), F.try_to_date(code, "yyyyMMdd"))
        .when(rest.rlike("^[0-9]{2}B$") & number.between(1, 6), _first_of(year, 2 * number - 1))
        .when(rest.rlike("^Q[1-4]$"), _first_of(year, 3 * number - 2))
        .when(rest.rlike("^S[12]$"), _first_of(year, 6 * number - 5))
        .when(rest.rlike("^W[0-9]{1,4}$") & (number >= 1) & (week < _monday(year + 1)), week)
    )


def _end(start: Column, rest: Column) -> Column:
    months = F.when(rest == "", 12).when(rest.rlike("^[0-9]{2}$"), 1).when(rest.endswith("B"), 2).when(rest.startswith("Q"), 3).when(rest.startswith("S"), 6)
    return F.when(start.isNull(), None).when(rest.rlike("^[0-9]{4}$"), start).when(rest.startswith("W"), F.date_add(start, 6)).otherwise(F.date_sub(F.add_months(start, months), 1))


def period_bounds(code: Column) -> Column:
    """The first and last day of a period code as a struct (start, end), both null for an unknown kind."""
    rest = F.substring(code, 5, 64)
    parts = F.struct(code.alias("code"), _int(F.substring(code, 1, 4)).alias("year"), rest.alias("rest"), _int(F.regexp_extract(rest, "([0-9]+)", 1)).alias("number"))
    dated = _let(parts, lambda p: F.struct(_start(p).alias("start"), p["rest"].alias("rest")))
    return _let(dated, lambda d: F.struct(d["start"].alias("start"), _end(d["start"], d["rest"]).alias("end")))


def period_start(code: Column) -> Column:
    return period_bounds(code)["start"]


def period_end(code: Column) -> Column:
    return period_bounds(code)["end"]


def period_kind(code: Column) -> Column:
    """The shape of a code: the number of leading digits, then the rest with each number as #; null for relative periods."""
    lead = F.length(F.regexp_extract(code, "^([0-9]*)", 1))
    rest = F.regexp_replace(F.regexp_replace(code, "^[0-9]+", ""), "[0-9]+", "#")
    return F.when(lead > 0, F.concat(lead.cast("string"), rest))


def annual_factor(start: Column, end: Column) -> Column:
    """Days of the start's year over the days of the period."""
    days = F.dayofyear(F.make_date(F.year(start), F.lit(12), F.lit(31)))
    return days / (F.datediff(end, start) + 1)


_RANGE = re.compile(r"(\d{4}-\d{2}-\d{2})\.\.(\d{4}-\d{2}-\d{2})")


def parse_range(text: str) -> tuple[str, str]:
    """START..END as two ISO dates, or an error."""
    from datetime import date

    found = _RANGE.fullmatch(text)
    if not found:
        raise ValueError(f"not a date range: {text}")
    low, high = (date.fromisoformat(x) for x in found.groups())
    if low > high:
        raise ValueError(f"the range ends before it begins: {text}")
    return low.isoformat(), high.isoformat()


def parse_age(text: str) -> int:
    """Seconds of an age such as 12h, 3d or 2w."""
    found = re.fullmatch(r"(\d+)([hdw])", text)
    if not found:
        raise ValueError(f"not an age: {text}")
    return int(found[1]) * {"h": 3600, "d": 86400, "w": 604800}[found[2]]
