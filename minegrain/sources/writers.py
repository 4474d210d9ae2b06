"""Writers: text lines built by column expressions, ordered where the line number is the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_lines(df: DataFrame, line: Column, path: str, order: list[str] | None = None) -> None:
    """Write one line per row; with `order`, a range-partitioned sort makes the part files follow it."""
    rows = df.orderBy(*order) if order else df
    rows.select(line.cast("string").alias("value")).write.text(path)


def write_assignments(assign: DataFrame, path: str) -> None:
    write_lines(assign, F.concat_ws(" ", "doc_id", "cluster"), path, ["doc_id"])


def write_rank_vector(ranks: DataFrame, path: str) -> None:
    write_lines(ranks, F.format_string("%d %.6f", F.col("id").cast("bigint"), "rank"), path, ["id"])


def write_trec_run(run: DataFrame, path: str, method: str = "score", tag: str = "run-1") -> None:
    """`user-query Q0 doc rank score tag`, the score being the column named by `method`."""
    line = F.format_string(
        f"%d-%d Q0 %d %d %.6f {tag}",
        F.col("user_id").cast("bigint"),
        F.col("query_id").cast("bigint"),
        F.col("doc_id").cast("bigint"),
        F.col("rank").cast("int"),
        F.col(method),
    )
    write_lines(run, line, path)


def write_trec_runs(runs: DataFrame, path: str, rank: str = "new_rank", score: str = "fused", tag: str = "run-1") -> None:
    """Runs of all methods in one pass, each in a folder method=<name> below `path`."""
    line = F.format_string(
        f"%d-%d Q0 %d %d %.6f {tag}",
        F.col("user_id").cast("bigint"),
        F.col("query_id").cast("bigint"),
        F.col("doc_id").cast("bigint"),
        F.col(rank).cast("int"),
        F.col(score),
    )
    runs.select("method", line.alias("value")).write.partitionBy("method").text(path)


def write_predictions(scored: DataFrame, path: str, value: str = "pred") -> None:
    write_lines(scored, F.col(value), path, ["pair_id"])


def write_hard_soft(pred: DataFrame, path: str) -> None:
    write_lines(pred, F.concat_ws(" ", F.col("hard").cast("int"), F.col("soft").cast("string")), path, ["row_id"])


def write_libsvm(rows: DataFrame, path: str) -> None:
    """Rows (row_id, label, indices, values) -> `label idx:val ...`, indices ascending."""
    cells = F.array_sort(F.arrays_zip(F.col("indices"), F.col("values")))
    items = F.transform(cells, lambda c: F.concat_ws(":", c["indices"].cast("string"), c["values"].cast("string")))
    line = F.concat_ws(" ", F.col("label").cast("string"), F.array_join(items, " "))
    write_lines(rows, F.trim(line), path, ["row_id"])
