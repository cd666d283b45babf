"""Least-squares fits as grouped aggregates.

A fit of one label on two features needs five second moments. Spark merges
those from partial results, so all groups are fitted in one pass and a group
of any size costs its reducers one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from almanack.functions import day_angle

# The determinant of two features that lie on one line is zero but for rounding
# of about 1e-15 of the product of their variances.
SINGULAR = 1e-10


def fit_plane(x1: Column, x2: Column, y: Column) -> Column:
    """Aggregate: struct of intercept, b1, b2 of ``y ~ x1 + x2``.

    Rows with a NULL in any of the three are left out. The struct's fields are
    NULL where the features do not determine a plane.
    """
    x1, x2, y = _complete(x1, x2, y)
    b1, b2 = _slopes(x1, x2, y)
    intercept = F.avg(y) - b1 * F.avg(x1) - b2 * F.avg(x2)
    return F.struct(intercept.alias("intercept"), b1.alias("b1"), b2.alias("b2"))


def amplitude(sine: Column, cosine: Column, value: Column) -> Column:
    """Aggregate: amplitude of the yearly wave fitted to the values."""
    b1, b2 = _slopes(*_complete(sine, cosine, value))
    return F.sqrt(b1 * b1 + b2 * b2)


def seasonal_amplitude(date: Column, value: Column) -> Column:
    """Aggregate: amplitude of the yearly wave, from dates and values."""
    angle = day_angle(date)
    return amplitude(F.sin(angle), F.cos(angle), value)


def _complete(*columns: Column) -> tuple[Column, ...]:
    known = columns[0].isNotNull()
    for c in columns[1:]:
        known = known & c.isNotNull()
    return tuple(F.when(known, c) for c in columns)


def _slopes(x1: Column, x2: Column, y: Column) -> tuple[Column, Column]:
    v1, v2, v12 = F.var_pop(x1), F.var_pop(x2), F.covar_pop(x1, x2)
    c1, c2 = F.covar_pop(x1, y), F.covar_pop(x2, y)
    det = v1 * v2 - v12 * v12
    solvable = det > SINGULAR * v1 * v2
    return (
        F.when(solvable, (c1 * v2 - c2 * v12) / det),
        F.when(solvable, (c2 * v1 - c1 * v12) / det),
    )
