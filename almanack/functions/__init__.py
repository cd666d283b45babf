"""Column expressions shared by the analyses. All of them stay inside the JVM."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def underscored(*parts: ColumnOrName) -> Column:
    """Join the parts with underscores; one NULL part makes the whole NULL.

    ``concat_ws`` would skip a NULL part and so make two different keys equal.
    """
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("_"), _col(part)]
    return F.concat(*pieces[1:])


def season_week_key(year: ColumnOrName, week: ColumnOrName) -> Column:
    """``Y18_W2`` for week 2 of 2018: the year modulo 1000, without padding."""
    short_year = (_col(year) % 1000).cast("string")
    return F.concat(F.lit("Y"), short_year, F.lit("_W"), _col(week).cast("string"))


def mean_fahrenheit(tmax: ColumnOrName, tmin: ColumnOrName) -> Column:
    """Mean of two temperatures in tenths of a degree Celsius, in Fahrenheit."""
    return (_col(tmax) + _col(tmin)) / 20 * 1.8 + 32


def number_or(text: ColumnOrName, default: float = -1.0) -> Column:
    """The text as a double, or ``default`` where it is not a number."""
    return F.coalesce(_col(text).try_cast("double"), F.lit(default))


def drop_ends(text: ColumnOrName, left: int = 0, right: int = 0) -> Column:
    """The text without its first ``left`` and last ``right`` characters."""
    c = _col(text)
    return F.substring(c, F.lit(left + 1), F.greatest(F.length(c) - (left + right), F.lit(0)))


def char_range(text: ColumnOrName, start: int, end: int) -> Column:
    """Characters ``[start, end)``, counted from 0."""
    return F.substring(_col(text), start + 1, end - start)


def decade(year: ColumnOrName) -> Column:
    """First year of the decade: 1990 for 1997."""
    return _col(year) - _col(year) % 10


def day_angle(date: ColumnOrName) -> Column:
    """Day of the year as an angle, one turn in 365 days."""
    return F.dayofyear(_col(date)) / 365 * 2 * pi
