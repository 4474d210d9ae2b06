"""Operator inputs derived from the test tables, once as DataFrames and once as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from minegrain.operators import text as tx
from minegrain.runtime import cut_lineage


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- ratings -----------------------------------------------------------------------------------------------------

RATINGS = """ratings as (
  select o_custkey as user_id, l_partkey as item_id, cast(ceil(max(l_quantity) / 10) as double) as rating,
         cast(max(o_orderdate) as date) as ts
  from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)"""
TRAIN = RATINGS + """,
train as (select user_id, item_id, rating from ratings where (user_id * 31 + item_id) % 10 <> 0),
pairs as (select user_id * 1000000000 + item_id as pair_id, user_id, item_id, rating as gold
          from ratings where (user_id * 31 + item_id) % 10 = 0)"""


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")).agg(
        F.ceil(F.max("l_quantity") / 10).cast("double").alias("rating"), F.max("o_orderdate").cast("date").alias("ts")
    )


def _held_out() -> F.Column:
    return (F.col("user_id") * 31 + F.col("item_id")) % 10 == 0


def train(spark: SparkSession, sf: str) -> DataFrame:
    return ratings(spark, sf).filter(~_held_out()).select("user_id", "item_id", "rating")


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(pair_id, user_id, item_id, gold); pair_id follows the order (user, item)."""
    held = ratings(spark, sf).filter(_held_out())
    return held.select(
        (F.col("user_id") * 1_000_000_000 + F.col("item_id")).alias("pair_id"),
        "user_id",
        "item_id",
        F.col("rating").alias("gold"),
    )


def gold(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf).select("pair_id", "gold")


# A stand-in prediction made from the ids, the same in both engines.
PRED = "cast((user_id * 7 + item_id * 3) % 50 as double) / 10.0"


def scored_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf).withColumn("pred", F.expr(PRED))


# --- links, topics, runs -----------------------------------------------------------------------------------------

EDGES = """hops as (
  select l_partkey as src,
         lead(l_partkey) over (partition by l_orderkey order by l_linenumber, l_partkey) as dst from lineitem),
edges as (select src, dst, cast(count(*) as double) as weight from hops where dst is not null and src <> dst group by 1, 2),
vertices as (select p_partkey as id from part)"""
DOC_TOPICS = """doc_topics as (select p_partkey as doc_id, cast(split_part(p_brand, '#', 2) as integer) as topic from part)"""
USER_TOPICS = """lines as (
  select o_custkey as user_id, cast(substr(o_orderpriority, 1, 1) as bigint) as query_id, l_partkey as doc_id,
         cast(split_part(p_brand, '#', 2) as integer) as topic, l_extendedprice as price
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey),
user_share as (select user_id, topic, count(*) as n from lines group by 1, 2),
user_total as (select user_id, count(*) as total from lines group by 1),
user_queries as (select distinct user_id, query_id from lines),
user_topics as (
  select user_id, query_id, topic, cast(n as double) / total as prob
  from user_queries join user_share using (user_id) join user_total using (user_id)),
query_total as (select user_id, query_id, count(*) as total from lines group by 1, 2),
query_topics as (
  select user_id, query_id, topic, cast(count(*) as double) / max(total) as prob
  from lines join query_total using (user_id, query_id) group by 1, 2, 3)"""
RUN = """spent as (select user_id, query_id, doc_id, sum(price) as amount from lines group by 1, 2, 3),
scored as (
  select user_id, query_id, doc_id, ln(amount / sum(amount) over (partition by user_id, query_id)) as score
  from spent),
run as (
  select user_id, query_id, doc_id, score,
         cast(row_number() over (partition by user_id, query_id order by round(score, 9) desc, doc_id) as integer) as rank
  from scored)"""


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """Links between consecutive parts of an order. An order has few lines (a key of the table), so a window is enough."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("src"))
    after = F.lead("src").over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "src"))
    hops = lines.select("src", after.alias("dst")).filter("dst is not null and src <> dst")
    return hops.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def vertices(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"))


def _brand_topic() -> F.Column:
    return F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("int")


def doc_topics(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), _brand_topic().alias("topic"))


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """(user_id, query_id, doc_id, topic, price), materialised: runs and topic shares are all made from it."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("doc_id"), F.col("l_extendedprice").alias("price"))
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("user_id"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("query_id"),
    )
    # The parts grow with the input, and their compressed columns seem small: Spark would broadcast them through the driver.
    topics = doc_topics(spark, sf).hint("merge")
    return cut_lineage(lines.join(orders, "l_orderkey").join(topics, "doc_id").drop("l_orderkey"))


def user_topics(lines: DataFrame) -> DataFrame:
    share = lines.groupBy("user_id", "topic").agg(F.count(F.lit(1)).alias("n"))
    total = lines.groupBy("user_id").agg(F.count(F.lit(1)).alias("total"))
    asked = lines.select("user_id", "query_id").distinct()
    return asked.join(share, "user_id").join(total, "user_id").select(
        "user_id", "query_id", "topic", (F.col("n") / F.col("total")).alias("prob")
    )


def query_topics(lines: DataFrame) -> DataFrame:
    share = lines.groupBy("user_id", "query_id", "topic").agg(F.count(F.lit(1)).alias("n"))
    total = lines.groupBy("user_id", "query_id").agg(F.count(F.lit(1)).alias("total"))
    return share.join(total, ["user_id", "query_id"]).select(
        "user_id", "query_id", "topic", (F.col("n") / F.col("total")).alias("prob")
    )


def run(lines: DataFrame) -> DataFrame:
    spent = lines.groupBy("user_id", "query_id", "doc_id").agg(F.sum("price").alias("amount"))
    total = spent.groupBy("user_id", "query_id").agg(F.sum("amount").alias("total"))
    scored = spent.join(total, ["user_id", "query_id"]).select(
        "user_id", "query_id", "doc_id", F.ln(F.col("amount") / F.col("total")).alias("score")
    )
    order = W.partitionBy("user_id", "query_id").orderBy(F.desc(F.round("score", 9)), "doc_id")
    return scored.withColumn("rank", F.row_number().over(order))


# --- text --------------------------------------------------------------------------------------------------------

def clean_sql(col: str = "text") -> str:
    inner = f"lower(regexp_replace({col}, '{tx.NOISE_PATTERN}', '', 'g'))"
    return f"regexp_replace({inner}, '{tx.EDGE_SPACE_PATTERN}', '', 'g')"


def tokens_sql(source: str = "documents", key: str = "doc_id", name: str = "tokens") -> str:
    return (
        f"{name} as (select {key} as doc_id, unnest(regexp_extract_all({clean_sql()}, '{tx.TOKEN_PATTERN}')) as term"
        f" from {source})"
    )


TOKENS = tokens_sql()
TF = TOKENS + """,
tf as (select doc_id, term, cast(count(*) as integer) as tf from tokens group by 1, 2)"""
STATS = TF + """,
ctf as (select term, cast(sum(tf) as bigint) as ctf from tf group by 1),
df as (select term, count(*) as df from tf group by 1),
n_docs as (select count(*) as n from documents)"""
VOCABULARY = STATS + """,
dictionary as (select term, cast(row_number() over (order by ctf desc, term) - 1 as integer) as new_id from ctf)"""
# Only for the operators whose feature is a cut at the most frequent terms.
DICTIONARY_SIZE = 300
DICTIONARY = VOCABULARY[:-1] + f" qualify new_id < {DICTIONARY_SIZE})"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Texts move before they are cut into words: counts by document then need no shuffle of their many more bytes."""
    return tx.tokenize(tx.clean_text(documents(spark, sf).repartition("doc_id")))


def benchmark_tokens(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return tx.tokenize(tx.clean_text(items))


def tf(spark: SparkSession, sf: str) -> DataFrame:
    return tx.term_frequency(tokens(spark, sf))


def lang_gold(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"))


# --- vectors -----------------------------------------------------------------------------------------------------

ROWS = """rows as (select vec_id as row_id, cast(label as double) as label,
  list_transform(embedding, lambda x: cast(x as double)) as features from embeddings)"""
CELLS = ROWS + """,
cells as (select row_id, label, unnest(features) as value, unnest(range(len(features))) as feature from rows)"""


def rows(spark: SparkSession, sf: str) -> DataFrame:
    """(row_id, label, features) from the embeddings, ten classes."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        F.col("label").cast("double").alias("label"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def binary_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Two classes: +1 for embedding labels below 5, else -1."""
    return rows(spark, sf).withColumn("label", F.when(F.col("label") < 5, 1.0).otherwise(-1.0))


def regression_rows(spark: SparkSession, sf: str) -> DataFrame:
    """First component from the other ones."""
    return rows(spark, sf).select(
        "row_id",
        F.col("features")[0].alias("label"),
        F.slice("features", F.lit(2), F.size("features") - 1).alias("features"),
    )


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """(review_id, text, stars): documents that have quality labels."""
    labels = table(spark, sf, "labels").select("doc_id", (1 + 2 * F.col("quality") + F.col("toxic")).alias("stars"))
    return documents(spark, sf).join(labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("review_id"), "text", F.col("stars").cast("int")
    )


REVIEWS = """reviews as (select cast(doc_id as varchar) as review_id, text, cast(1 + 2 * quality + toxic as integer) as stars
  from documents join labels using (doc_id))"""


def uniform_sql(seed: int, *keys: str) -> str:
    text = " || '|' || ".join(f"cast({k} as varchar)" for k in (str(seed), *keys))
    return f"((cast('0x' || substr(md5({text}), 1, 10) as bigint) + 0.5) / 1099511627776.0)"


def r6(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0"
