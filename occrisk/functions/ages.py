"""Ages and age bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from occrisk.functions import labels as L


def day_month_year(text: Column) -> Column:
    """Date of a ``d/m/yyyy`` text; blanks, placeholders and impossible dates are NULL."""
    worth_parsing = (text != "") & ~text.startswith(L.PLACEHOLDER_MARK)
    return F.when(worth_parsing, F.try_to_date(text, "d/M/yyyy"))


def _ymd(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def whole_years_between(later: Column, earlier: Column) -> Column:
    """Completed years from ``earlier`` to ``later``, truncated toward zero.

    yyyymmdd integers subtract to years * 10000 plus a remainder whose sign
    tells whether the anniversary has passed, so one truncating division
    suffices (29 Feb 2000 to 28 Feb 2001 is 0, to 1 Mar 2001 is 1).

    Pass columns, not parsing expressions: each date is read three times.
    """
    return F.call_function("div", _ymd(later) - _ymd(earlier), F.lit(10000)).cast("int")


def age_band(age: Column, oldest: int | None = None) -> Column:
    """Band label; with ``oldest`` the last band is closed there.

    A fractional age between two bands (17.5) belongs to none.
    """
    out = None
    for label, (low, high) in L.AGE_BANDS.items():
        last = oldest if high is None else high
        hit = (age >= low) if last is None else age.between(low, last)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out
