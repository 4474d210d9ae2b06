"""Text preparation, term statistics, dictionaries and TF-IDF weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minegrain.functions.ordering import with_row_index

from minegrain.runtime import broadcast_if_small

# Characters and letter-digit mixes that cleaning removes, and the shape of a token.
NOISE_PATTERN = r"[^\w\s]|[\n]|([a-z]+[0-9]+|[0-9]+[a-z]+)[a-z0-9]*"
EDGE_SPACE_PATTERN = r"^\s+|\s+$"
TOKEN_PATTERN = r"\b\w\w+\b"


def cleaned(text: Column | str) -> Column:
    kept = F.lower(F.regexp_replace(text, NOISE_PATTERN, ""))
    return F.regexp_replace(kept, EDGE_SPACE_PATTERN, "")


def clean_text(df: DataFrame, col: str = "text") -> DataFrame:
    return df.withColumn(col, cleaned(col))


def tokenize(df: DataFrame, col: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, term): every word token of two or more word characters."""
    return df.select(key, F.explode(F.regexp_extract_all(col, F.lit(TOKEN_PATTERN), F.lit(0))).alias("term"))


def remove_stopwords(tokens: DataFrame, stopwords: DataFrame) -> DataFrame:
    listed = stopwords.select(F.col("word").alias("term")).distinct()
    kept = tokens.filter(F.col("term") != "")
    return kept.join(broadcast_if_small(listed), "term", "left_anti").select(tokens.columns)


def term_frequency(tokens: DataFrame, term: str = "term") -> DataFrame:
    return tokens.groupBy("doc_id", term).agg(F.count(F.lit(1)).cast("int").alias("tf"))


def collection_frequency(tf: DataFrame, term: str = "term") -> DataFrame:
    return tf.groupBy(term).agg(F.sum("tf").alias("ctf"))


def document_frequency(tf: DataFrame, term: str = "term") -> DataFrame:
    return tf.filter("tf > 0").groupBy(term).agg(F.count(F.lit(1)).alias("df"))


def _top_terms(stats: DataFrame, value: str, n: int, term: str) -> DataFrame:
    """The n terms of largest value, numbered from 0 in that order."""
    top = stats.orderBy(F.desc(value), term).limit(n)
    numbered = with_row_index(top, [F.desc(value), F.col(term)], "new_id")
    return numbered.select(term, F.col("new_id").cast("int"))


def number_terms(tf: DataFrame, term: str = "term") -> DataFrame:
    """(term, new_id): all terms, numbered from 0 by falling collection frequency."""
    numbered = with_row_index(collection_frequency(tf, term), [F.desc("ctf"), F.col(term)], "new_id")
    return numbered.select(term, F.col("new_id").cast("int"))


def topn_terms_ctf(tf: DataFrame, n: int = 2000, term: str = "term") -> DataFrame:
    return _top_terms(collection_frequency(tf, term), "ctf", n, term)


def topn_terms_df(tf: DataFrame, n: int = 2000, term: str = "term") -> DataFrame:
    return _top_terms(document_frequency(tf, term), "df", n, term)


def project_dictionary(tf: DataFrame, dictionary: DataFrame, term: str = "term") -> DataFrame:
    """Keep the dictionary's terms under their new ids."""
    return tf.join(broadcast_if_small(dictionary), term).select("doc_id", F.col("new_id").alias("term_id"), "tf")


def feature_rows(tf: DataFrame, labels: DataFrame) -> DataFrame:
    """(row_id, label, indices, values) for linear models: 1-based ascending term ids, one row per labelled document.

    A document without terms is a row without features; a row is bounded by the dictionary.
    """
    cells = tf.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct((F.col("term_id") + 1).alias("i"), F.col("tf").cast("double").alias("v")))).alias("c")
    )
    return labels.join(cells, "doc_id", "left").select(
        F.col("doc_id").alias("row_id"),
        "label",
        F.coalesce("c.i", F.array().cast("array<int>")).alias("indices"),
        F.coalesce("c.v", F.array().cast("array<double>")).alias("values"),
    )


def remap_vocabulary(tf_test: DataFrame, vocab_test: DataFrame, vocab_train: DataFrame) -> DataFrame:
    """Test term ids become train term ids through the word; unknown words are dropped."""
    ids = vocab_test.withColumnRenamed("term_id", "test_id").join(vocab_train, "term").select("test_id", "term_id")
    return tf_test.withColumnRenamed("term_id", "test_id").join(broadcast_if_small(ids), "test_id").select("doc_id", "term_id", "tf")


def idf_floor(df: DataFrame, n_docs: int, floor: bool = True, term: str = "term") -> DataFrame:
    """ln(N div df), or ln(N / df) with floor=False. df must not exceed N: the floored ratio would be 0."""
    ratio = F.expr(f"{int(n_docs)}L div df") if floor else F.lit(float(n_docs)) / F.col("df")
    return df.select(term, F.ln(ratio.cast("double")).alias("idf"))


def weight_by_idf(tf: DataFrame, idf: DataFrame, term: str = "term") -> DataFrame:
    return tf.join(broadcast_if_small(idf), term).select("doc_id", term, (F.col("tf") * F.col("idf")).alias("weight"))


def tfidf(tf: DataFrame, df: DataFrame, n_docs: int, floor: bool = True, term: str = "term") -> DataFrame:
    return weight_by_idf(tf, idf_floor(df, n_docs, floor, term), term)


def tfidf_smooth_l2(tf: DataFrame, n_docs: int | None = None, term: str = "term") -> DataFrame:
    """idf = ln((1 + N) / (1 + df)) + 1, rows scaled to length 1."""
    if n_docs is None:
        n_docs = tf.select("doc_id").distinct().count()
    smooth = F.ln(F.lit(1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0
    idf = document_frequency(tf, term).select(term, smooth.alias("idf"))
    raw = weight_by_idf(tf, idf, term)
    norms = raw.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return raw.join(norms, "doc_id").select("doc_id", term, (F.col("weight") / F.col("norm")).alias("weight"))
