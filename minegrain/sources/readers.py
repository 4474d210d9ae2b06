"""Readers: one explicit schema per file kind, line numbers where the line is the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from minegrain.runtime import broadcast_if_small

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("stars", T.IntegerType()),
    ]
)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value): 0-based number of each line over the files of `path` in name order.

    Lines are counted per file split, the splits get running offsets, and these are sent back to the lines; the text
    itself is neither sorted nor, with fewer splits than the broadcast limit, shuffled.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__mid"),
    )
    splits = lines.groupBy("__file", "__block").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first")
    )
    # Part files follow the number in their name, which has more than five digits from 100,000 files on.
    number = F.coalesce(F.try_to_number(F.regexp_extract("__file", r"part-(\d+)[^/]*$", 1), F.lit("9" * 18)), F.lit(0))
    before = W.orderBy(number, "__file", "__block").rowsBetween(W.unboundedPreceding, -1)
    starts = splits.select(
        "__file", "__block", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    return lines.join(broadcast_if_small(starts), ["__file", "__block"]).select(
        (F.col("__start") + F.col("__mid") - F.col("__first")).alias("line_no"), "value"
    )


def _fields(value: Column | str = "value", pattern: str = " +") -> Column:
    return F.split(F.trim(value), pattern)


def _pair(item: Column, left: str, right: str, left_type: str, right_type: str) -> list[Column]:
    parts = F.split(item, ":")
    return [parts[0].cast(left_type).alias(left), parts[1].cast(right_type).alias(right)]


def read_index_counts(spark: SparkSession, path: str) -> DataFrame:
    """`idx:count` lines -> (term_id, count)."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(*_pair(F.trim("value"), "term_id", "count", "int", "bigint"))


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """`word idx` lines -> (term, term_id)."""
    return spark.read.csv(path, sep=" ", schema="term string, term_id int", quote="")


def read_doc_vectors(spark: SparkSession, path: str) -> DataFrame:
    """`term:tf term:tf ...` lines -> (doc_id, term_id, tf); an empty line is a document without terms."""
    lines = read_lines(spark, path).filter(F.trim("value") != "")
    items = lines.select(F.col("line_no").alias("doc_id"), F.explode(_fields()).alias("item"))
    return items.select("doc_id", *_pair(F.col("item"), "term_id", "tf", "int", "int"))


def read_gold_labels(spark: SparkSession, path: str) -> DataFrame:
    """One label per line -> (doc_id, label); `unlabeled` lines keep their number but give no row."""
    lines = read_lines(spark, path).select(F.col("line_no").alias("doc_id"), F.trim("value").alias("label"))
    return lines.filter(F.col("label") != "unlabeled")


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep=" ", schema="doc_id bigint, cluster int")


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep=" ", schema="src bigint, dst bigint, weight double")


def read_topic_distributions(spark: SparkSession, path: str) -> DataFrame:
    """`user query t:p t:p ...` lines -> (user_id, query_id, topic, prob)."""
    fields = spark.read.text(path).filter(F.trim("value") != "").select(_fields().alias("f"))
    items = fields.select(
        F.col("f")[0].cast("bigint").alias("user_id"),
        F.col("f")[1].cast("bigint").alias("query_id"),
        F.explode(F.slice("f", F.lit(3), F.greatest(F.size("f") - 2, F.lit(0)))).alias("item"),
    )
    return items.select("user_id", "query_id", *_pair(F.col("item"), "topic", "prob", "int", "double"))


def read_doc_topics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep=" ", schema="doc_id bigint, topic int")


def read_run_files(spark: SparkSession, folder: str) -> DataFrame:
    """Six-column run files named `user-query.*` -> (user_id, query_id, doc_id, rank, score).

    The name may be that of the file or of a folder that holds its parts, as a partitioned write leaves them.
    """
    path, name = F.col("_metadata.file_path"), r"(\d+)-(\d+)\.[^/]*(/part-[^/]*)?$"
    lines = spark.read.text(folder, recursiveFileLookup=True).select(
        F.regexp_extract(path, name, 1).cast("bigint").alias("user_id"),
        F.regexp_extract(path, name, 2).cast("bigint").alias("query_id"),
        _fields().alias("f"),
    )
    return lines.select(
        "user_id",
        "query_id",
        F.col("f")[2].cast("bigint").alias("doc_id"),
        F.col("f")[3].cast("int").alias("rank"),
        F.col("f")[4].cast("double").alias("score"),
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV item,user,rating,date -> (user_id, item_id, rating, ts)."""
    rows = spark.read.csv(path, schema="item_id bigint, user_id bigint, rating double, ts date")
    return rows.select("user_id", "item_id", "rating", "ts")


def read_query_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV item,user -> (pair_id, user_id, item_id), pair_id = line number."""
    fields = read_lines(spark, path).select("line_no", F.split("value", ",").alias("f"))
    return fields.select(
        F.col("line_no").alias("pair_id"),
        F.trim(F.col("f")[1]).cast("bigint").alias("user_id"),
        F.trim(F.col("f")[0]).cast("bigint").alias("item_id"),
    )


def read_values(spark: SparkSession, path: str) -> DataFrame:
    """One number per line -> (pair_id, value)."""
    lines = read_lines(spark, path)
    return lines.select(F.col("line_no").alias("pair_id"), F.trim("value").cast("double").alias("value"))


def read_reviews_json(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """JSON lines -> (review_id, text, stars); stars = -1 for a split without labels."""
    rows = spark.read.schema(REVIEW_SCHEMA).json(path)
    return rows if labelled else rows.withColumn("stars", F.lit(-1))


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("word"))


def read_dense_matrix(spark: SparkSession, x_path: str, y_path: str) -> DataFrame:
    """Two CSV files of numbers, aligned by line -> (row_id, label, features)."""
    x = read_lines(spark, x_path).select(
        F.col("line_no").alias("row_id"),
        F.transform(F.split("value", ","), lambda v: F.trim(v).cast("double")).alias("features"),
    )
    y = read_lines(spark, y_path).select(
        F.col("line_no").alias("row_id"), F.trim("value").cast("double").alias("label")
    )
    return x.join(y, "row_id").select("row_id", "label", "features")


def read_libsvm(spark: SparkSession, path: str) -> DataFrame:
    """`label idx:val ...` lines -> (row_id, label, indices, values), 1-based indices.

    A malformed number, an index below 1 or one that does not ascend raises an error that names the line.
    """
    fields = read_lines(spark, path).select("line_no", F.split(F.trim("value"), r"\s+").alias("f"))
    items = F.filter(F.slice("f", F.lit(2), F.size("f")), lambda s: s != "")
    parsed = fields.select(
        F.col("line_no").alias("row_id"),
        F.expr("try_cast(f[0] as double)").alias("label"),
        F.transform(items, lambda s: F.element_at(F.split(s, ":"), 1).try_cast("int")).alias("indices"),
        F.transform(items, lambda s: F.try_element_at(F.split(s, ":"), F.lit(2)).try_cast("double")).alias("values"),
    )
    ascending = F.forall(
        F.transform(
            F.sequence(F.lit(1), F.size("indices")),
            lambda i: F.element_at("indices", i) > F.when(i > 1, F.element_at("indices", F.greatest(i - 1, F.lit(1)))).otherwise(0),
        ),
        lambda ok: F.coalesce(ok, F.lit(False)),
    )
    valid = (
        F.col("label").isNotNull()
        & ((F.size("indices") == 0) | ascending)
        & F.forall("values", lambda v: v.isNotNull())
    )
    message = F.concat(F.lit("wrong input format at line "), (F.col("row_id") + 1).cast("string"))
    return parsed.select(
        "row_id",
        F.when(valid, F.col("label")).otherwise(F.raise_error(message).cast("double")).alias("label"),
        "indices",
        "values",
    )


def libsvm_dimension(rows: DataFrame) -> int:
    """Largest feature index of rows from `read_libsvm`."""
    return rows.agg(F.max(F.array_max("indices"))).first()[0] or 0
