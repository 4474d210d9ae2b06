"""Exact deduplication by content-defined chunk recipes, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minegrain.llm.common import stored

# A chunk ends after at least 512 characters where the text itself says so, and after 4,096 at the latest.
CHUNK = r"(?s).{512,4096}?[dkrt][aeht] |.{1,4096}"


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def normalised(text: Column) -> Column:
    """Null as empty; every run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def chunk_clashes(chunked: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests that stand for more than one chunk text. Each different chunk moves once, copies are combined before."""
    # The outer form, as Spark would cut every text a second time to leave out those without chunks.
    one = chunked.select(F.explode_outer("__chunks").alias("chunk")).filter("chunk is not null")
    one = one.select(digest(F.col("chunk")).alias("digest"), "chunk")
    return one.groupBy("digest", "chunk").count().groupBy("digest").count().filter("count > 1")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """Per row: id, keep_id (smallest id among the rows with an equal text), group_size, kept and text_sha256.

    A text is cut into content-defined chunks. Chunks are deduplicated and their digests verified to stand for one text
    each; a document is then its ordered list of identifiers, and only these lists are grouped and joined. Should a digest
    stand for two texts, the identifiers of all chunks are digest and text together, so the answer is exact either way.

    Null text is the empty text, which has an empty list. Null ids never become keep_id unless the whole group has none
    (keep_id null, kept true). Rows that repeat the kept id with an equal text are all kept: they are the same document.
    Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    norm = docs.select(F.col(id_col).alias("__id"), normalised(F.col(text_col)).alias("__norm"))
    chunked = norm.withColumn("__chunks", F.regexp_extract_all("__norm", F.lit(CHUNK), F.lit(0)))
    verbatim = not chunk_clashes(chunked, digest).isEmpty()

    def identifier(c: Column) -> Column:
        return F.concat(digest(c), F.lit(":"), F.length(c).cast("string"), F.lit(":"), c) if verbatim else digest(c)

    recipes = stored(
        chunked.select(
            "__id",
            F.array_join(F.transform("__chunks", identifier), ",").alias("__recipe"),
            F.sha2("__norm", 256).alias("text_sha256"),
        ),
        "recipes",
    )
    groups = recipes.groupBy("__recipe").agg(F.min("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return recipes.join(groups, "__recipe").select(
        F.col("__id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
