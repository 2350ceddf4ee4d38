"""Half-year period of an option landing file, derived from its name.

Rules (fixed values, must equal the reference's):
  year  = first match of ``(19|20)\\d{2}`` in the file name
  month = tried in this order, first match of each pattern only, kept if 1..12:
          ``(?:19|20)\\d{2}(\\d{2})\\d{2}``   e.g. 20260701 -> 07
          ``(?:19|20)\\d{2}[_-](\\d{2})``     e.g. 2016_03  -> 03
          ``[_-](\\d{2})[_-]``               e.g. _05_     -> 05
  year fallback: first data row (file order) whose build_year_2 holds a year
  month default ``01``; year default ``XXXX``
  half  = ``01`` for months 1-6, ``02`` for 7-12; period = year + '_' + half
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DEFAULT_MONTH, FIRST_HALF, SECOND_HALF, UNKNOWN_YEAR

YEAR_RE = r"(19|20)\d{2}"
MONTH_RES = [
    r"(?:19|20)\d{2}(\d{2})\d{2}",
    r"(?:19|20)\d{2}[_-](\d{2})",
    r"[_-](\d{2})[_-]",
]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_from_name(name: Column | str) -> Column:
    """First 4-digit 19xx/20xx run, NULL when absent."""
    y = F.regexp_extract(_c(name), YEAR_RE, 0)
    return F.when(y != "", y)


def has_year(name: str) -> bool:
    """Does a name hold such a year? (for listings, on the driver)"""
    return re.search(YEAR_RE, name, re.ASCII) is not None


def month_from_name(name: Column | str) -> Column:
    """Two-digit month from the first pattern whose first match is 01..12."""
    candidates = []
    for pattern in MONTH_RES:
        m = F.regexp_extract(_c(name), pattern, 1)
        mi = m.try_cast("int")
        candidates.append(F.when((m != "") & mi.between(1, 12), m))
    return F.coalesce(*candidates)


def year_from_text(c: Column | str) -> Column:
    """Year contained in a data value (fallback source), NULL when absent."""
    return year_from_name(c)


def half_of_month(month: Column | str) -> Column:
    m = _c(month).try_cast("int")
    return F.when(m.between(7, 12), F.lit(SECOND_HALF)).otherwise(F.lit(FIRST_HALF))


def period_of(year: Column, month: Column) -> Column:
    """``year_half`` group key with the defaults applied."""
    y = F.coalesce(year, F.lit(UNKNOWN_YEAR))
    m = F.coalesce(month, F.lit(DEFAULT_MONTH))
    return F.concat_ws("_", y, half_of_month(m))


def period_parts(period: Column | str) -> tuple[Column, Column]:
    """Integer (year, half) of a ``YYYY_HH`` label, for natural ordering."""
    parts = F.split(_c(period), "_")
    return parts.getItem(0).try_cast("int"), parts.getItem(1).try_cast("int")
