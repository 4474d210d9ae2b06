"""Queries for clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from minegrain.functions.vectors import rounded
from minegrain.operators import clusters as cl
from minegrain.operators import evaluate as ev
from minegrain.operators import text as tx
from minegrain.plans import inputs as inp
from minegrain.plans.inputs import CELLS, VOCABULARY, r6, tokens_sql
from minegrain.plans.registry import query
from minegrain.runtime import cut_lineage

K = 8
VECTORS = CELLS + """,
vectors as materialized (select row_id as doc_id, cast(feature as integer) as term_id, value as weight from cells),
norms as materialized (select doc_id, sqrt(sum(weight * weight)) as norm from vectors group by 1)"""


def vectors(spark, sf):
    """Embeddings as (doc_id, term_id, weight)."""
    rows = inp.rows(spark, sf)
    return rows.select(F.col("row_id").alias("doc_id"), F.posexplode("features").alias("term_id", "weight"))


def first_documents(spark, sf, k=K):
    firsts = vectors(spark, sf).filter(F.col("doc_id") < k)
    return firsts.select(F.col("doc_id").cast("int").alias("cluster"), "term_id", F.col("weight").alias("w"))


def _assign(name: str, centroids: str, docs: str = "vectors", norms: str = "norms") -> str:
    return f"""{name}_len as (select cluster, sqrt(sum(w * w)) as length from {centroids} group by 1),
{name}_sim as (
  select doc_id, cluster, round(sum(weight * w) / max(norm) / max(length), 10) as sim
  from {docs} join {centroids} using (term_id) join {norms} using (doc_id) join {name}_len using (cluster) group by 1, 2),
{name} as materialized (
  select doc_id, cluster from {name}_sim qualify row_number() over (partition by doc_id order by sim desc, cluster) = 1)"""


def _update(name: str, assign: str, previous: str) -> str:
    return f"""{name}_n as (select cluster, count(*) as n from {assign} group by 1),
{name} as materialized (
  select cluster, term_id, sum(weight) / max(n) as w from vectors join {assign} using (doc_id) join {name}_n using (cluster) group by 1, 2
  union all select cluster, term_id, w from {previous} where cluster not in (select cluster from {name}_n))"""


START = f"c0 as materialized (select cast(doc_id as integer) as cluster, term_id, weight as w from vectors where doc_id < {K})"


@query("assign_cosine", f"with {VECTORS}, {START}, {_assign('a0', 'c0')} select doc_id, cluster from a0")
def assign_cosine(spark, sf):
    return cl.assign_cosine(vectors(spark, sf), first_documents(spark, sf))


@query(
    "update_centroids",
    f"""with {VECTORS}, {START}, {_assign('a0', 'c0')}, {_update('c1', 'a0', 'c0')}
    select cluster, term_id, {r6('w')} as w from c1""",
)
def update_centroids(spark, sf):
    data, start = vectors(spark, sf), first_documents(spark, sf)
    new = cl.update_centroids(data, cl.assign_cosine(data, start), start)
    return new.withColumn("w", rounded("w"))


def _fit_sql(steps: int) -> str:
    parts = [VECTORS, START]
    for i in range(steps):
        parts += [_assign(f"a{i}", f"c{i}"), _update(f"c{i + 1}", f"a{i}", f"c{i}")]
    parts.append(_assign("last", f"c{steps}"))
    return ", ".join(parts)


# More rounds than the fit needs on these tables; rounds after the last change repeat its result.
_ROUNDS = 30


@query("kmeans_fit", f"with {_fit_sql(_ROUNDS)} select doc_id, cluster from last")
def kmeans_fit(spark, sf):
    """From the first documents until no assignment changes."""
    _, assign, _ = cl.kmeans_fit(vectors(spark, sf), K, first_documents(spark, sf))
    return assign


GOLD = "gold as (select row_id as doc_id, cast(label as integer) as label from rows)"


@query(
    "overlap_counts",
    f"with {VECTORS}, {START}, {_assign('a0', 'c0')}, {GOLD} select label, cluster, count(*) as n from gold join a0 using (doc_id) group by 1, 2",
)
def overlap_counts(spark, sf):
    return ev.overlap_counts(_gold(spark, sf), assign_cosine(spark, sf))


def _gold(spark, sf):
    return inp.rows(spark, sf).select(F.col("row_id").alias("doc_id"), F.col("label").cast("int"))


@query(
    "cluster_macro_f1",
    f"""with {_fit_sql(_ROUNDS)}, {GOLD},
    nl as (select label, count(*) as nl from gold group by 1), nc as (select cluster, count(*) as nc from last group by 1),
    o as (select label, cluster, count(*) as n from gold join last using (doc_id) group by 1, 2),
    best as (select label, max(2.0 * n / (nl + nc)) as f1 from o join nl using (label) join nc using (cluster) group by 1)
    select {r6('avg(f1)')} as macro_f1 from best""",
)
def cluster_macro_f1(spark, sf):
    return ev.cluster_macro_f1(kmeans_fit(spark, sf), _gold(spark, sf)).select(rounded("macro_f1").alias("macro_f1"))


@query(
    "init_random_centroids",
    f"""with {VOCABULARY} select cast(c as integer) as cluster, new_id as term_id, {inp.uniform_sql(3, 'c', 'new_id')} as w
    from dictionary, range({K}) r(c)""",
)
def init_random_centroids(spark, sf):
    """Over all terms of the documents."""
    _, vocab = text_vectors(spark, sf)
    return cl.init_random_centroids(vocab, K, seed=3)


def _seeding_sql(k: int, seed: int) -> str:
    parts = [VECTORS]
    for s in range(k):
        weight = "select doc_id, 1.0 as w from norms"
        if s:
            every = " union all ".join(f"select * from d{i}" for i in range(s))
            weight = f"select doc_id, 1.0 - max(sim) as w from ({every}) group by 1 having 1.0 - max(sim) > 1e-9"
        parts.append(
            f"""p{s} as materialized (select doc_id from ({weight})
            order by -ln({inp.uniform_sql(seed, str(s), 'doc_id')}) / w, doc_id limit 1),
            d{s} as materialized (
              select v.doc_id, round(sum(v.weight * c.weight) / max(n.norm) / max(m.norm), 10) as sim
              from vectors v join vectors c using (term_id) join p{s} on c.doc_id = p{s}.doc_id
              join norms n on n.doc_id = v.doc_id join norms m on m.doc_id = c.doc_id group by 1)"""
        )
    cells = " union all ".join(
        f"select {s} as cluster, term_id, weight as w from vectors join p{s} using (doc_id)" for s in range(k)
    )
    return f"with {', '.join(parts)} {cells}"


@query("init_kmeanspp", _seeding_sql(K, 3))
def init_kmeanspp(spark, sf):
    return cl.init_kmeanspp(vectors(spark, sf), K, seed=3)


def text_vectors(spark, sf):
    """Documents over all terms: (tf, vocabulary)."""
    tf = cut_lineage(inp.tf(spark, sf))
    dictionary = cut_lineage(tx.number_terms(tf))
    return tx.project_dictionary(tf, dictionary), dictionary.select("term", F.col("new_id").alias("term_id"))


CENTROID_CELL = "((cluster * 7 + term_id * 3) % 11) / 10.0"
CLASSIFY = f"""{VOCABULARY}, {tokens_sql("benchmark", "item_id", "bench")},
bench_tf as (select doc_id, term, cast(count(*) as integer) as tf from bench group by 1, 2),
n_bench as (select count(distinct doc_id) as n from bench),
ptf as (select doc_id, new_id as term_id, tf from tf join dictionary using (term)),
pdf as (select term_id, count(*) as df from ptf group by 1),
weights as (
  select b.doc_id, d.new_id as term_id, b.tf * ln(n // df) as weight
  from bench_tf b join dictionary d using (term) join pdf on pdf.term_id = d.new_id, n_bench where df <= n),
norms as (select doc_id, sqrt(sum(weight * weight)) as norm from weights group by 1 having sum(weight * weight) > 0),
given as (select cast(c as integer) as cluster, cast(t as integer) as term_id,
          cast((c * 7 + t * 3) % 11 as double) / 10.0 as w from range(6) a(c), (select new_id as t from dictionary) b)"""


@query(
    "classify_unseen",
    f"""with {CLASSIFY}, {_assign('placed', 'given', 'weights')}
    select doc_id, coalesce(cluster, 0) as cluster from (select distinct doc_id from bench) left join placed using (doc_id)""",
)
def classify_unseen(spark, sf):
    """Benchmark texts under centroids made from the ids."""
    train, vocab = text_vectors(spark, sf)
    test = tx.term_frequency(inp.benchmark_tokens(spark, sf)).withColumn("term_id", F.xxhash64("term"))
    vocab_test = test.select("term", "term_id").distinct()
    cells = vocab.select("term_id", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("cluster"))
    centroids = cells.select("cluster", "term_id", F.expr(CENTROID_CELL).cast("double").alias("w"))
    df = tx.document_frequency(train, "term_id")
    return cl.classify_unseen(test.select("doc_id", "term_id", "tf"), vocab_test, vocab, df, centroids)


# 40 values of k, each fitted three times from three kinds of starts.
SWEEP_KS = tuple(range(5, 205, 5))


@query("kmeans_sweep")
def kmeans_sweep(spark, sf):
    tf, _ = text_vectors(spark, sf)
    sweep = cl.kmeans_sweep(tf, inp.lang_gold(spark, sf), ks=SWEEP_KS, repeats=3)
    return sweep.withColumn("f1", rounded("f1"))
