"""Positions, ranks and pairings that never put one whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from minegrain.runtime import cut_lineage

_POSITION_BITS = 33


def _offsets(sizes: DataFrame, order: list[str]) -> DataFrame:
    """Running start position per partition; one row per partition, so a single window is small."""
    before = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return sizes.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))


def with_row_index(df: DataFrame, order: list[Column | str], name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in the given order.

    A range-partitioned sort is materialised once; position = rows in earlier partitions + place in its own partition.
    """
    ordered = cut_lineage(df.orderBy(*order))
    mid = F.monotonically_increasing_id()
    tagged = ordered.withColumn("__mid", mid)
    tagged = tagged.withColumn("__part", F.shiftright("__mid", _POSITION_BITS)).withColumn(
        "__pos", F.col("__mid").bitwiseAND((1 << _POSITION_BITS) - 1)
    )
    sizes = tagged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    starts = _offsets(sizes, ["__part"]).select("__part", "__start")
    return (
        tagged.join(F.broadcast(starts), "__part")  # bounded: one row per partition
        .withColumn(name, F.col("__start") + F.col("__pos"))
        .drop("__mid", "__part", "__pos", "__start")
    )


def rank_within(
    df: DataFrame, by: list[str], order: list[Column | str], name: str = "rank", limit: int | None = None
) -> DataFrame:
    """1-based rank of each row inside its group.

    With a limit, Spark drops rows beyond it before the shuffle. Without one, a global sort spreads a hot group over
    many tasks and the rank is the distance to the group's first position.
    """
    if limit is not None:
        window = W.partitionBy(*by).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= limit)
    indexed = with_row_index(df, [*by, *order], "__index")
    first = indexed.groupBy(*by).agg(F.min("__index").alias("__first"))
    return (
        indexed.join(first, by)
        .withColumn(name, (F.col("__index") - F.col("__first") + 1).cast("int"))
        .drop("__index", "__first")
    )


def chunked_pairs(
    left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, chunk: int = 2000
) -> DataFrame:
    """Inner join of two sides on `key` where a hot key is cut into a grid of chunk x chunk cells.

    Columns other than the key must be distinct between the sides.
    """
    sizes = (
        left.select(key, F.lit(1).alias("__l"), F.lit(0).alias("__r"))
        .unionByName(right.select(key, F.lit(0).alias("__l"), F.lit(1).alias("__r")))
        .groupBy(key)
        .agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))
        .filter((F.col("__l") > 0) & (F.col("__r") > 0))
        .select(
            key,
            F.ceil(F.col("__l") / chunk).cast("int").alias("__lc"),
            F.ceil(F.col("__r") / chunk).cast("int").alias("__rc"),
        )
    )
    cells = ["__li", "__ri"]
    a = (
        left.join(sizes, key)
        .withColumn("__li", F.pmod(F.xxhash64(left_id), F.col("__lc")).cast("int"))
        .withColumn("__ri", F.explode(F.sequence(F.lit(0), F.col("__rc") - 1)))
        .drop("__lc", "__rc")
    )
    b = (
        right.join(sizes, key)
        .withColumn("__ri", F.pmod(F.xxhash64(right_id), F.col("__rc")).cast("int"))
        .withColumn("__li", F.explode(F.sequence(F.lit(0), F.col("__lc") - 1)))
        .drop("__lc", "__rc")
    )
    return a.join(b, [key, *cells]).drop(*cells)
