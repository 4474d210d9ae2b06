"""Queries over text and term statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from minegrain.functions.vectors import rounded
from minegrain.operators import text as tx
from minegrain.plans import inputs as inp
from minegrain.plans.inputs import DICTIONARY, STATS, TF, TOKENS, VOCABULARY, clean_sql, r6, tokens_sql
from minegrain.plans.registry import query
from minegrain.runtime import cut_lineage


@query("clean_text", f"select doc_id, {clean_sql()} as text from documents")
def clean_text(spark, sf):
    return tx.clean_text(inp.documents(spark, sf))


@query("tokenize", f"with {TOKENS} select doc_id, term from tokens")
def tokenize(spark, sf):
    return inp.tokens(spark, sf)


_STOP = tokens_sql("benchmark", "item_id", "bench") + ", stop as (select distinct term from bench where length(term) <= 3)"


def stopwords(spark, sf):
    short = inp.benchmark_tokens(spark, sf).filter(F.length("term") <= 3)
    return short.select(F.col("term").alias("word")).distinct()


@query("remove_stopwords", f"with {TOKENS}, {_STOP} select doc_id, term from tokens where term not in (select term from stop)")
def remove_stopwords(spark, sf):
    return tx.remove_stopwords(inp.tokens(spark, sf), stopwords(spark, sf))


@query("term_frequency", f"with {TF} select doc_id, term, tf from tf")
def term_frequency(spark, sf):
    return inp.tf(spark, sf)


@query("collection_frequency", f"with {STATS} select term, ctf from ctf")
def collection_frequency(spark, sf):
    return tx.collection_frequency(inp.tf(spark, sf))


@query("document_frequency", f"with {STATS} select term, df from df")
def document_frequency(spark, sf):
    return tx.document_frequency(inp.tf(spark, sf))


def _n_docs(spark, sf):
    return inp.documents(spark, sf).count()


@query("idf_floor", f"with {STATS} select term, {r6('ln(n // df)')} as idf from df, n_docs")
def idf_floor(spark, sf):
    idf = tx.idf_floor(tx.document_frequency(inp.tf(spark, sf)), _n_docs(spark, sf))
    return idf.select("term", rounded("idf").alias("idf"))


@query(
    "weight_by_idf",
    f"with {STATS} select doc_id, term, {r6('tf * ln(cast(n as double) / df)')} as weight from tf join df using (term), n_docs",
)
def weight_by_idf(spark, sf):
    tf = cut_lineage(inp.tf(spark, sf))
    idf = tx.idf_floor(tx.document_frequency(tf), _n_docs(spark, sf), floor=False)
    return tx.weight_by_idf(tf, idf).select("doc_id", "term", rounded("weight").alias("weight"))


@query("tfidf", f"with {STATS} select doc_id, term, {r6('tf * ln(n // df)')} as weight from tf join df using (term), n_docs")
def tfidf(spark, sf):
    tf = cut_lineage(inp.tf(spark, sf))
    weights = tx.tfidf(tf, tx.document_frequency(tf), _n_docs(spark, sf))
    return weights.select("doc_id", "term", rounded("weight").alias("weight"))


@query(
    "tfidf_smooth_l2",
    f"""with {STATS},
    raw as (select doc_id, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) as w from tf join df using (term), n_docs),
    norms as (select doc_id, sqrt(sum(w * w)) as norm from raw group by 1)
    select doc_id, term, {r6('w / norm')} as weight from raw join norms using (doc_id)""",
)
def tfidf_smooth_l2(spark, sf):
    weights = tx.tfidf_smooth_l2(cut_lineage(inp.tf(spark, sf)), _n_docs(spark, sf))
    return weights.select("doc_id", "term", rounded("weight").alias("weight"))


@query(
    "topn_terms_ctf",
    f"""with {STATS} select term, cast(row_number() over (order by ctf desc, term) - 1 as integer) as new_id
    from ctf qualify new_id < 2000""",
)
def topn_terms_ctf(spark, sf):
    return tx.topn_terms_ctf(inp.tf(spark, sf), 2000)


@query(
    "topn_terms_df",
    f"""with {STATS} select term, cast(row_number() over (order by df desc, term) - 1 as integer) as new_id
    from df qualify new_id < 2000""",
)
def topn_terms_df(spark, sf):
    return tx.topn_terms_df(inp.tf(spark, sf), 2000)


@query(
    "project_dictionary",
    f"with {DICTIONARY} select doc_id, new_id as term_id, tf from tf join dictionary using (term)",
)
def project_dictionary(spark, sf):
    tf = cut_lineage(inp.tf(spark, sf))
    return tx.project_dictionary(tf, tx.topn_terms_ctf(tf, inp.DICTIONARY_SIZE))


_REMAP = f"""{VOCABULARY}, {tokens_sql("benchmark", "item_id", "bench")},
    bench_tf as (select doc_id, term, cast(count(*) as integer) as tf from bench group by 1, 2)"""


@query(
    "remap_vocabulary",
    f"with {_REMAP} select doc_id, new_id as term_id, tf from bench_tf join dictionary using (term)",
)
def remap_vocabulary(spark, sf):
    """Benchmark texts as the test split under their own term ids (a hash of the word), documents as the train split."""
    test = tx.term_frequency(inp.benchmark_tokens(spark, sf)).withColumn("term_id", F.xxhash64("term"))
    vocab_test = test.select("term", "term_id").distinct()
    train = tx.number_terms(cut_lineage(inp.tf(spark, sf)))
    vocab_train = train.select("term", F.col("new_id").alias("term_id"))
    return tx.remap_vocabulary(test.select("doc_id", "term_id", "tf"), vocab_test, vocab_train)
