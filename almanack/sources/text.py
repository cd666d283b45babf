"""Lines of text into typed rows, by expressions the optimizer can see through.

Input is a DataFrame with a ``value`` column, as ``spark.read.text`` gives. A
column that the query does not use is never cut out of the line.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanack.functions import char_range, number_or

BAD_ROW = "bad_row"


@dataclass(frozen=True)
class Field:
    """A field of a delimited line: its position counted from 0 and its type.

    ``skip`` leading characters are cut off before the cast. ``default``, for
    doubles only, stands in for text that is not a number.
    """

    name: str
    at: int
    dtype: str = "string"
    skip: int = 0
    default: float | None = None


@dataclass(frozen=True)
class Slice:
    """A field of a fixed-width line: characters ``[start, end)`` from 0."""

    name: str
    start: int
    end: int
    dtype: str = "string"
    trim: bool = True


def parse_delimited(
    lines: DataFrame,
    fields: Sequence[Field],
    *,
    sep: str = ",",
    header_token: str | None = None,
    missing: tuple[str, Sequence[int]] | None = None,
    trim: bool = True,
    strict: bool = True,
) -> DataFrame:
    """Split lines at ``sep`` (a literal) and cast the wanted fields.

    ``header_token`` drops every line that contains it. ``missing`` is a marker
    and the positions where it drops the line. With ``strict`` a short line or
    a bad number raises in Spark's ANSI mode; without, the field is NULL and a
    column ``bad_row`` says that something on the line was amiss.
    """
    if header_token is not None:
        lines = lines.filter(~F.contains("value", F.lit(header_token)))
    # One escaped character is a pattern that Java splits at without a regex.
    cells = F.split("value", re.escape(sep))

    def cell(at: int) -> Column:
        raw = cells[at] if strict else F.try_element_at(cells, F.lit(at + 1))
        return F.trim(raw) if trim else raw

    if missing is not None:
        marker, positions = missing
        for at in positions:
            # A short line has no marker here and stays for the cast to judge.
            lines = lines.filter(F.coalesce(cell(at) != marker, F.lit(True)))

    raw = {}
    for field in fields:
        text = cell(field.at)
        raw[field.name] = F.substring(text, field.skip + 1, 2**31 - 1) if field.skip else text
    return _typed(lines, raw, {f.name: (f.dtype, f.default) for f in fields}, strict)


def parse_fixed_width(
    lines: DataFrame, slices: Sequence[Slice], *, strict: bool = True
) -> DataFrame:
    """Cut lines at fixed character positions and cast the pieces."""
    raw = {}
    for piece in slices:
        text = char_range("value", piece.start, piece.end)
        raw[piece.name] = F.trim(text) if piece.trim else text
    return _typed(lines, raw, {s.name: (s.dtype, None) for s in slices}, strict)


def _typed(
    lines: DataFrame,
    raw: dict[str, Column],
    types: dict[str, tuple[str, float | None]],
    strict: bool,
) -> DataFrame:
    typed, amiss = [], F.lit(False)
    for name, text in raw.items():
        dtype, default = types[name]
        if default is not None:
            value = number_or(text, default)
        elif dtype == "string":
            value = text
        else:
            value = text.cast(dtype) if strict else text.try_cast(dtype)
        typed.append(value.alias(name))
        amiss = amiss | value.isNull()
    if not strict:
        typed.append(amiss.alias(BAD_ROW))
    return lines.select(*typed)
