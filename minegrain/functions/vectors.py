"""Expressions over `array<double>` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def hadamard(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def subtract(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def squared_norm(a: Column | str) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x)


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def seeded_hash(seed: int, *keys: Column | str) -> Column:
    """Hexadecimal MD5 of seed and keys as text, joined by |."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]))


def seeded_uniform(seed: int, *keys: Column | str) -> Column:
    """Uniform in (0, 1) from a hash of the keys: the same on every partitioning, and in every engine that has MD5."""
    digits = F.substring(seeded_hash(seed, *keys), 1, 10)
    return (F.conv(digits, 16, 10).cast("bigint") + 0.5) / float(1 << 40)


def rounded(value: Column | str, digits: int = 6) -> Column:
    """Rounded value without a negative zero."""
    return F.round(value, digits) + F.lit(0.0)
