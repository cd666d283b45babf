"""Conditional, arg-max and guarded aggregates, all with map-side partials."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share_where(condition: Column) -> Column:
    """Percentage of rows that meet the condition, NULL if there are no rows."""
    return F.try_divide(F.count_if(condition) * 100.0, F.count("*"))


def mean_where(value: Column, condition: Column) -> Column:
    """Mean over the rows that meet the condition, NULL if there are none."""
    return F.avg(F.when(condition, value))


def argmax_by_key(df: DataFrame, keys: Sequence[str], label: str, measure: str) -> DataFrame:
    """For each key the label of its largest measure; the smaller label on a tie.

    NaN counts as the largest measure, NULL as the smallest, and a NULL label comes
    after all others. A maximum of a struct cannot be kept in a hash table, so
    that Spark would sort. Where the label is a whole number of at most 32 bits and the measure a
    double, both are packed into one decimal that orders like the pair.
    """
    types = dict(df.dtypes)
    if types[measure] != "double" or types[label] not in ("int", "smallint", "tinyint"):
        return _argmax_by_struct(df, keys, label, measure)
    # A place for each label, the smaller the label the higher, and 0 for NULL.
    place = F.coalesce(F.lit(_LABELS // 2) - F.col(label).cast("long"), F.lit(0))
    rank = F.coalesce(order_bits(F.col(measure)), F.lit(-_INFINITE - _MANTISSA))
    wide = F.lit(_LABELS).cast("decimal(11,0)")
    packed = rank.cast("decimal(20,0)") * wide + place.cast("decimal(11,0)")
    best = df.groupBy(*keys).agg(F.max(packed).alias("best"), F.max(measure).alias(measure))
    found = F.pmod(F.col("best"), wide).cast("long")
    known = F.when(found > 0, F.lit(_LABELS // 2) - found).cast(types[label])
    return best.select(*keys, known.alias(label), measure)


#: Labels of 32 bits and one place for NULL have room in so many; half of it is for label 0.
_LABELS = 1 << 34
_MANTISSA = 1 << 52
#: The bits of infinity; those of NaN are above.
_INFINITE = 2047 * _MANTISSA


def order_bits(x: Column) -> Column:
    """The IEEE bits of a double as a whole number of its sign: numbers order as the doubles do.

    Exponent and mantissa are taken apart by exact steps: a logarithm that is set
    right by comparison, and divisions by powers of two. -0.0 equals 0.0, NaN is above
    infinity, NULL stays NULL.
    """
    size = F.abs(x)
    guess = F.least(F.floor(F.log2(size)), F.lit(1023))
    power = F.pow(F.lit(2.0), guess.cast("double"))
    exponent = guess - (size < power).cast("long") + (size / 2 >= power).cast("long")
    mantissa = size / F.pow(F.lit(2.0), exponent.cast("double"))
    normal = (exponent + 1023) * F.lit(_MANTISSA) + ((mantissa - 1) * F.lit(float(_MANTISSA))).cast("long")
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    bits = (
        F.when(F.isnan(x), F.lit(_INFINITE + 1))
        .when(size == float("inf"), F.lit(_INFINITE))
        .when(size < 2.0**-1022, tiny)
        .otherwise(normal)
    )
    return F.when(x.isNotNull(), F.when(~F.isnan(x) & (x < 0), -bits).otherwise(bits))


def _argmax_by_struct(
    df: DataFrame, keys: Sequence[str], label: str, measure: str
) -> DataFrame:
    best = F.max(F.struct(F.col(measure).alias("m"), (-F.col(label)).alias("minus_label")))
    return (
        df.groupBy(*keys)
        .agg(best.alias("best"))
        .select(
            *keys,
            (-F.col("best.minus_label")).alias(label),
            F.col("best.m").alias(measure),
        )
    )


def rows_at_max(df: DataFrame, column: str) -> DataFrame:
    """Every row that holds the greatest value of the column.

    The maximum is a scalar subquery, so the filter reaches the scan and skips
    the files and row groups that stay below it.
    """
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def argmax_row(df: DataFrame, *order: Column) -> DataFrame:
    """The first row in the given order, found by a top-1 in each partition."""
    return df.orderBy(*order).limit(1)


def having_min_counts(
    df: DataFrame, keys: Sequence[str], kind: str, minimums: Mapping[str, int]
) -> DataFrame:
    """Row counts by kind for the keys that have enough rows of each kind."""
    counts = {k: F.count_if(F.col(kind) == k) for k in minimums}
    enough = reduce(Column.__and__, [F.col(f"n_{k}") >= n for k, n in minimums.items()])
    return df.groupBy(*keys).agg(*(c.alias(f"n_{k}") for k, c in counts.items())).filter(enough)
