"""Mergeable moments: groups that are summarised apart and put together again.

The moments of some columns over a group of rows are their number, means and
co-moments (sums of products of deviations from the means). Those of a union of
groups follow from those of the groups, so a statistic of a whole table can be
had from its clusters, days or files without another pass over the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moments(*values: Column) -> Column:
    """Aggregate: struct of ``n``, means ``m0`` … and co-moments ``c00``, ``c01`` … .

    Rows with a NULL in any of the values are left out. Of no rows, n is 0 and the rest NULL.
    """
    known = values[0].isNotNull()
    for v in values[1:]:
        known = known & v.isNotNull()
    whole = [F.when(known, v) for v in values]
    n = F.count(whole[0])
    fields = [n.cast("double").alias("n"), *(F.avg(v).alias(f"m{i}") for i, v in enumerate(whole))]
    for i, j in _pairs(len(values)):
        fields.append((F.covar_pop(whole[i], whole[j]) * n).alias(f"c{i}{j}"))
    return F.struct(*fields)


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def merge_moments(groups: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Put the moments in the columns together, for all rows that agree in ``by``.

    Means first, weighted by n; then each group's co-moments, with what its means are
    off from those of all. Both are sums with partial results.
    """
    means, sums = [], []
    for c in columns:
        n = F.col(f"{c}.n")
        k = sum(f.startswith("m") for f in groups.schema[c].dataType.names)
        total = F.nullif(F.sum(n), F.lit(0.0))
        means += [(F.sum(n * F.col(f"{c}.m{i}")) / total).alias(f"_{c}_m{i}") for i in range(k)]
        off = [F.col(f"{c}.m{i}") - F.col(f"_{c}_m{i}") for i in range(k)]
        fields = [F.coalesce(F.sum(n), F.lit(0.0)).alias("n")]
        fields += [F.first(f"_{c}_m{i}").alias(f"m{i}") for i in range(k)]
        fields += [
            F.sum(F.col(f"{c}.c{i}{j}") + n * off[i] * off[j]).alias(f"c{i}{j}") for i, j in _pairs(k)
        ]
        sums.append(F.struct(*fields).alias(c))
    whole = groups.groupBy(*by).agg(*means)
    if by:
        joined = groups.join(whole, list(by))
    else:
        # One row of means, as a value in each row.
        joined = groups.withColumn("_means", whole.select(F.struct("*")).scalar())
        joined = joined.select(*groups.columns, "_means.*")
    return joined.groupBy(*by).agg(*sums)


def mean_of(column: str) -> Column:
    return F.col(f"{column}.m0")


def sample_deviation(column: str) -> Column:
    """Standard deviation of a sample, NULL for fewer than two rows."""
    n = F.col(f"{column}.n")
    return F.when(n > 1, F.sqrt(F.col(f"{column}.c00") / (n - 1)))


def wave_amplitude(column: str, singular: float) -> Column:
    """Amplitude of the wave fitted to moments of (sine, cosine, value), NULL if undetermined."""
    v1, v2, v12, c1, c2 = (F.col(f"{column}.{c}") for c in ("c00", "c11", "c01", "c02", "c12"))
    det = v1 * v2 - v12 * v12
    b1, b2 = (c1 * v2 - c2 * v12) / det, (c2 * v1 - c1 * v12) / det
    return F.when(det > singular * v1 * v2, F.sqrt(b1 * b1 + b2 * b2))
