"""Stored tables, row keys and connected components shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minegrain.runtime import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: later steps start from files that outlive every executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*cols: str) -> Column:
    """128 bits of SHA-256 over the columns, nulls told apart from empty: equal only for rows that agree in all of them."""
    parts = []
    for c in cols:
        text = F.col(c).cast("string")
        parts += [F.coalesce(F.length(text).cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))]
    return F.substring(F.unhex(F.sha2(F.concat_ws(":", *parts), 256)), 1, 16)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node on an edge between different nodes; root is the smallest node reachable.

    Large-star and small-star steps in turn until the set of edges stands still. A node with many edges is a key of joins
    whose other side has one row per node, which adaptive execution splits; minima are combined before the shuffle.
    """
    spark = edges.sparkSession
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    e = stored(e, "edges")
    seen = None
    while True:
        sym = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = sym.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = stored(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (row[0], row[1]) == seen:
            break
        seen = (row[0], row[1])
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
