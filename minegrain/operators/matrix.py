"""Sparse matrices as long frames: normalisation, centring, products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minegrain.operators.tiles import tiled_product


def _scale_by(m: DataFrame, keys: list[str], value: str, norm: Column) -> DataFrame:
    """value / norm of its group; a group of norm 0 stays as it is.

    The norm is pre-aggregated before the shuffle; the join back has one row per group on one side, so a hot group is
    split by the adaptive skew join.
    """
    norms = m.groupBy(*keys).agg(norm.alias("__norm"))
    scaled = F.when(F.col("__norm") > 0, F.col(value) / F.col("__norm")).otherwise(F.col(value))
    return m.join(norms, keys).withColumn(value, scaled).select(m.columns)


def normalize_l1_rows(m: DataFrame, row: str = "row", value: str = "value") -> DataFrame:
    return _scale_by(m, [row], value, F.sum(F.abs(value)))


def normalize_l2(m: DataFrame, key: str = "row", value: str = "value") -> DataFrame:
    return _scale_by(m, [key], value, F.sqrt(F.sum(F.col(value) * F.col(value))))


def topic_teleport_vectors(doc_topics: DataFrame) -> DataFrame:
    """(topic, id, p): p = 1 / number of documents of the topic."""
    members = doc_topics.distinct()
    sizes = members.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return members.join(sizes, "topic").select("topic", F.col("doc_id").alias("id"), (1.0 / F.col("n")).alias("p"))


def population_variance(cells: DataFrame, n_cells: int | None = None, value: str = "value") -> DataFrame:
    """One row: variance of a matrix of n_cells cells of which only the non-zero ones are rows."""
    n = F.lit(float(n_cells)) if n_cells is not None else F.count(F.lit(1)).cast("double")
    total, squares = F.sum(value), F.sum(F.col(value) * F.col(value))
    return cells.agg((squares / n - (total / n) * (total / n)).alias("variance"))


def id_space_size(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with max id + 1 per column."""
    return df.agg(*[(F.max(c) + 1).alias(f"{c}_size") for c in cols])


def sparse_matmul(a: DataFrame, b: DataFrame) -> DataFrame:
    """(row, col, value) of A.B for A(row, col, value) and B(row, col, value)."""
    left = a.select("row", F.col("col").alias("inner"), "value")
    right = b.select(F.col("col").alias("row"), F.col("row").alias("inner"), "value")
    return tiled_product(left, right).select(F.col("left").alias("row"), F.col("right").alias("col"), "value")
