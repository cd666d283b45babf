"""Rows by rank: the first n, positions in an order, and samples that a key decides.

A plain ``limit`` after a sort sends up to n rows of each task into one. Here the
order is found by a range partitioning: rows are counted by partition, and an
offset for each partition turns a place within it into a place among all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanack.session import staging_path

#: A row's place has the partition's number above so many bits, its index there below.
INDEX_BITS = 33


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows in the order, partition by partition, with their ``_place``; written and reread.

    Written, because ranges are cut by a sample of the rows: a second job over a
    plan could cut them elsewhere.
    """
    path = staging_path(df.sparkSession, "ranged")
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _counts(ranged: DataFrame) -> list[tuple[int, int]]:
    """(partition, rows) in the order of the partitions: a number for each, no rows."""
    partition = F.shiftright("_place", INDEX_BITS).alias("partition")
    return sorted((r["partition"], r["count"]) for r in ranged.groupBy(partition).count().collect())


def with_positions(df: DataFrame, *order: str | Column, position: str = "position") -> DataFrame:
    """The rows with their position in the order, from 1, as ``row_number`` counts.

    ``row_number`` without a partition sorts all rows in one task. Here they are
    sorted by ranges, and a row's position is its index in its range and
    the rows of the ranges before. Rows equal in the order come one after
    the other in no certain order.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = _ranged(df, columns)
    before, offsets = 0, []
    for partition, rows in _counts(ranged):
        offsets.append((partition, before))
        before += rows
    known = df.sparkSession.createDataFrame(offsets, "_partition long, _before long")
    placed = ranged.withColumn("_partition", F.shiftright("_place", INDEX_BITS))
    index = F.col("_place").bitwiseAND((1 << INDEX_BITS) - 1)
    # A row for each partition of the sort: small whatever the data.
    return placed.join(F.broadcast(known), "_partition").select(
        *df.columns, (F.col("_before") + index + 1).alias(position)
    )


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in ascending order of the columns, NULL first.

    Only the columns of the order are sorted, by ranges, with a hash of the whole
    row that settles ties. The n-th of them is the boundary, and the rows up to
    it are a filter over ``df``: no task collects n rows. Equal rows at the
    boundary are counted, and where some of them are too many, only these
    pass through a limit. Fewer than n rows come back as they are.
    """
    if n <= 0:
        return df.limit(0)
    tie = F.xxhash64(*df.columns)
    rank = F.struct(*order, tie.alias("_tie"))
    keys = _ranged(df.select(*order, tie.alias("_tie")), [F.col(c) for c in (*order, "_tie")])
    before, place = 0, None
    for partition, rows in _counts(keys):
        if before + rows >= n:
            place = (partition << INDEX_BITS) + n - before - 1
            break
        before += rows
    if place is None:
        return df
    names = [*order, "_tie"]
    boundary = keys.where(F.col("_place") == place).select(F.struct(*names).alias("rank"))
    last = keys.where(F.struct(*names) == boundary.scalar())
    found = last.agg(F.count("*").alias("rows"), F.min("_place").alias("first")).first()
    # Equal rows are adjacent in one range, so their number up to the boundary is known.
    wanted = place - found["first"] + 1
    if wanted == found["rows"]:
        return df.where(rank <= boundary.scalar())
    equal = df.where(rank == boundary.scalar()).limit(wanted)
    return df.where(rank < boundary.scalar()).unionAll(equal)


def sample_by_key(df: DataFrame, fraction: float, *keys: str, seed: int = 0) -> DataFrame:
    """The rows whose key falls below the fraction when it is hashed with the seed.

    Which rows are drawn depends on their keys alone, not on partitions or order:
    another run, table layout or engine draws the same, and tables that share
    a key are sampled alike. Rows of one key stay together, so the size is near
    the fraction only for keys of few rows each. A NULL in a key is a value like any other.
    """
    return df.where(key_share(*keys, seed=seed) < int(fraction * SHARE_PARTS))


#: A hashed key falls into one of so many parts.
SHARE_PARTS = 1 << 32


def key_share(*keys: str, seed: int = 0) -> Column:
    """A number below ``SHARE_PARTS`` from the first 32 bits of the MD5 of seed and keys as text."""
    parts = [F.concat(F.lit(":"), F.coalesce(F.col(k).cast("string"), F.lit("NULL"))) for k in keys]
    digest = F.md5(F.concat(F.lit(str(seed)), *parts))
    return F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long")
