"""Joins that Spark has no single call for, and the size check before a broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from almanack.session import staging_path

BROADCAST_BYTES = 64 << 20
#: Characters that a text is looked up by, as a piece of it.
GRAM = 3
#: Characters of texts times needles up to which all are compared, and bytes of such needles.
SCAN_CHARS, SCAN_BYTES = 2_000_000_000, 4 << 20


def value_bytes(df: DataFrame) -> Column:
    """Aggregate: bytes of all values, with eight for each value and two more per row."""
    per_row = F.lit(8 * (len(df.columns) + 2))
    for field in df.schema.fields:
        if not isinstance(field.dataType, NumericType):
            text = F.col(f"`{field.name}`").cast("string")
            per_row = per_row + F.coalesce(F.octet_length(text), F.lit(0))
    return F.coalesce(F.sum(per_row.cast("long")), F.lit(0))


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Ask for a broadcast of ``df`` if it measures at most ``max_bytes``.

    Spark's own estimate is far off for joined, parsed or aggregated tables, so
    one aggregate over ``df`` takes the bytes of its values. A larger table
    comes back without a hint, for Spark to shuffle and, with adaptive
    execution, to split where a key is hot.
    """
    size = df.agg(value_bytes(df).alias("size")).first()["size"]
    return F.broadcast(df) if size <= max_bytes else df


def stored_dimension(
    df: DataFrame, max_bytes: int = BROADCAST_BYTES, size: Column | None = None
) -> DataFrame:
    """As ``bounded_broadcast``, for a table that is costly to compute.

    It is computed once: written to the shared folder, and measured by an
    observation of the rows as they are written. ``size`` is an aggregate of its
    bytes, unless it is ``value_bytes``. A task that runs again may be
    observed twice, which can only take the hint away.
    """
    path, observed = staging_path(df.sparkSession, "dimension"), Observation()
    measure = value_bytes(df) if size is None else size
    df.observe(observed, measure.alias("size")).write.parquet(path)
    again = df.sparkSession.read.schema(df.schema).parquet(path)
    return F.broadcast(again) if (observed.get["size"] or 0) <= max_bytes else again


def nested_pair_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner equi join whose row is the pair ``(_1, _2)`` of whole input rows."""
    firsts = left.select(F.col(left_key).alias("_k1"), F.struct("*").alias("_1"))
    seconds = right.select(F.col(right_key).alias("_k2"), F.struct("*").alias("_2"))
    return firsts.join(seconds, F.col("_k1") == F.col("_k2")).select("_1", "_2")


def contains_join(
    left: DataFrame,
    right: DataFrame,
    text: str,
    needles: Sequence[str],
    max_broadcast_bytes: int = BROADCAST_BYTES,
    max_scan: int = SCAN_CHARS,
) -> DataFrame:
    """Inner join on: the left text contains every needle of the right row.

    Case matters, an empty needle is in every text, and a NULL matches nothing.

    Texts and needles are measured. Where characters times needles are at most
    ``max_scan``, each text is compared with an array of all needles. Beyond that
    the texts are posted under their grams, pieces of ``GRAM`` characters, as
    pairs of 64-bit numbers: hash of text, hash of gram. A right row is looked up
    by one gram, the rarest that its needles have, as counted over all texts;
    needles shorter than ``GRAM`` are grams of their own length. Only what is
    found under that gram is brought back by the hash of its text and tested. A
    row with a gram that no text has goes before the lookup. Joins are equi
    joins, and the plan does not grow with lengths or numbers.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    known = right.dropna(subset=list(needles))
    sizes = F.array_distinct(F.array(*(_gram_size(n) for n in needles)))
    measured = known.agg(
        value_bytes(known).alias("size"),
        F.count("*").alias("rows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(sizes)))).alias("grams"),
    ).first()
    chars = left.agg(F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("chars")).first()["chars"]
    if measured["size"] <= min(max_broadcast_bytes, SCAN_BYTES) and chars * measured["rows"] <= max_scan:
        return _scanned(left, known, text, needles)

    def sized(table: DataFrame, times: int = 1) -> DataFrame:
        return F.broadcast(table) if measured["size"] * times <= max_broadcast_bytes else table

    marked = left.withColumn("_text", F.xxhash64(text))
    posted = marked.select("_text", F.explode(_grams(F.col(text), measured["grams"] or [GRAM])).alias("_gram"))
    rows = known.select(*needles).distinct()
    own = F.array_distinct(F.flatten(F.array(*(_grams_of_needle(F.col(n)) for n in needles))))
    wanted = rows.select(*needles, F.explode(own).alias("_gram"))
    # A gram is eight bytes for a character of a needle.
    held = posted.join(sized(wanted.select("_gram").distinct(), 8), "_gram")
    texts_with = held.groupBy("_gram").agg(F.count("*").alias("_n"))
    rarity = F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram")
    rarest = wanted.join(texts_with, "_gram", "left").groupBy(*needles).agg(F.min(rarity).alias("_rarest"))
    keyed = rarest.where("_rarest.n > 0").select(*needles, F.col("_rarest._gram").alias("_gram"))
    candidates = posted.join(sized(keyed, 2), "_gram").select("_text", *needles).distinct()
    found = marked.join(candidates, "_text").where(_holds_all(F.col(text), needles))
    return found.join(sized(known), list(needles)).select(*left.columns, *right.columns)


def _holds_all(text: Column, needles: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.contains(text, F.col(n)) for n in needles])


def _scanned(left: DataFrame, known: DataFrame, text: str, needles: Sequence[str]) -> DataFrame:
    """Each text against an array of all right rows, which reaches the tasks as one value."""
    array = known.agg(F.collect_list(F.struct(*known.columns)).alias("all")).scalar()

    def fits(row: Column) -> Column:
        return reduce(Column.__and__, [F.contains(F.col(text), row[n]) for n in needles])

    found = left.withColumn("_rows", array).withColumn("_row", F.explode(F.filter("_rows", fits)))
    return found.select(*left.columns, *(F.col("_row")[c].alias(c) for c in known.columns))


def _gram_size(needle: str) -> Column:
    return F.least(F.length(needle), F.lit(GRAM))


def _pieces(text: Column, size: int) -> Column:
    """Hashes of all pieces of ``size`` characters; of no characters, one piece that all texts have."""
    if size == 0:
        return F.when(text.isNotNull(), F.array(F.xxhash64(F.lit(0))))
    # A match of no width at each place, with what lies ahead of it: pieces that overlap.
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))
    return F.transform(pieces, lambda piece: F.xxhash64(F.lit(size), piece))


def _grams(text: Column, sizes: Sequence[int]) -> Column:
    """The different grams of the given sizes in a text, NULL for a NULL."""
    return F.array_distinct(F.flatten(F.array(*(_pieces(text, k) for k in sizes))))


def _grams_of_needle(needle: Column) -> Column:
    """All grams of ``GRAM`` characters, or a shorter needle as a whole."""
    whole = F.length(needle)
    grams = _pieces(needle, GRAM)
    for size in range(GRAM - 1, -1, -1):
        grams = F.when(whole == size, _pieces(needle, size)).otherwise(grams)
    return grams
