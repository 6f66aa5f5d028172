"""Column expressions used by the loads. All of them stay inside codegen."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from scdstar.schemas import CALENDAR_END, CALENDAR_START

# The characters a cell is stripped of.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace, line breaks included."""
    return F.btrim(text, F.lit(WHITESPACE))


def int_or_zero(text: Column) -> Column:
    """The integer a digits-only cell holds, blanks around it aside; 0 for every other cell.

    One replacement leaves ``0`` followed by the digits, if any, for the cast.
    """
    space = f"[{WHITESPACE}]*"
    digits = F.regexp_replace(text, f"(?s)^{space}([0-9]+){space}$|^.*$", "0$1")
    return F.coalesce(digits, F.lit("0")).cast("int")


def is_true(text: Column) -> Column:
    """True only for the exact text ``True``."""
    return F.coalesce(text == "True", F.lit(False))


def strict_cast(text: Column, kind: str) -> Column:
    """Cast a text cell, failing the job on an empty or malformed one.

    Does not depend on the session's ANSI setting.
    """
    message = F.concat(F.lit(f"not a {kind}: '"), F.coalesce(text, F.lit("")), F.lit("'"))
    return F.coalesce(text.try_cast(kind), F.raise_error(message).cast(kind))


def review_text(text: Column) -> Column:
    """The part after a single ``|`` if there is exactly one, else the whole text.

    The result is stripped and line feeds become blanks.
    """
    one_bar = text.contains("|") & (F.substring_index(text, "|", 2) == text)
    chosen = F.when(one_bar, F.substring_index(text, "|", -1)).otherwise(text)
    return F.replace(strip(chosen), F.lit("\n"), F.lit(" "))


def mean_of_nonzero(*scores: Column) -> Column:
    """Mean over the scores that are not 0; 0 if all are."""
    rated = reduce(add, [(s != 0).cast("int") for s in scores])
    total = reduce(add, scores)
    return F.when(rated > 0, total.cast("double") / rated).otherwise(F.lit(0.0))


def calendar_key(ts: Column) -> Column:
    """Key of the calendar day of ``ts``; NULL outside the calendar.

    The calendar holds one row per day, numbered from 1, so the key is a day
    count and looking it up needs no join.
    """
    day = F.to_date(ts)
    inside = day.between(F.lit(CALENDAR_START).cast("date"), F.lit(CALENDAR_END).cast("date"))
    return F.when(inside, F.datediff(day, F.lit(CALENDAR_START).cast("date")) + 1)


def weekday_name(day: Column, padded: bool = True) -> Column:
    """Full weekday name, blank-padded to nine characters by default."""
    name = F.date_format(day, "EEEE")
    return F.rpad(name, 9, " ") if padded else name


def whole_minutes(start: Column, end: Column) -> Column:
    """Whole minutes between two zone-less timestamps."""
    return (end - start).cast("interval minute").cast("long")


def hours(start: Column, end: Column) -> Column:
    """Hours between two zone-less timestamps."""
    seconds = (end - start).cast("interval second").cast("decimal(18, 6)")
    return seconds.cast("double") / 3600
