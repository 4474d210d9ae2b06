"""Queries for readers and writers: each writes a file from the test tables and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from minegrain.functions.vectors import dot, hadamard, rounded, subtract
from minegrain.operators import linear as ln
from minegrain.operators import text as tx
from minegrain.plans import inputs as inp
from minegrain.plans.cluster_queries import GOLD, START, VECTORS, _assign, assign_cosine as assigned, text_vectors
from minegrain.plans.inputs import VOCABULARY, DOC_TOPICS, EDGES, RATINGS, REVIEWS, ROWS, STATS, TRAIN, USER_TOPICS, r6
from minegrain.plans.linear_queries import CLASSES, GIVEN, given_model
from minegrain.plans.rating_queries import SCORED
from minegrain.plans.registry import query
from minegrain.runtime import scratch_path
from minegrain.sources import readers as rd
from minegrain.sources import writers as wr


def _joined(*parts, sep=" "):
    return F.concat_ws(sep, *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts])


def _written(spark, df, line, order=None):
    path = scratch_path(spark, "lines")
    wr.write_lines(df, line, path, order)
    return path


# --- readers -----------------------------------------------------------------------------------------------------

@query(
    "read_index_counts",
    f"with {VOCABULARY} select new_id as term_id, df as count from dictionary join df using (term)",
)
def read_index_counts(spark, sf):
    train, _ = text_vectors(spark, sf)
    df = tx.document_frequency(train, "term_id")
    return rd.read_index_counts(spark, _written(spark, df, _joined("term_id", "df", sep=":")))


@query("read_vocab", f"with {VOCABULARY} select term, new_id as term_id from dictionary")
def read_vocab(spark, sf):
    _, vocab = text_vectors(spark, sf)
    return rd.read_vocab(spark, _written(spark, vocab, _joined("term", "term_id")))


@query(
    "read_doc_vectors",
    f"""with {VOCABULARY}, nth as (select doc_id, row_number() over (order by doc_id) - 1 as line from documents)
    select line as doc_id, new_id as term_id, tf from tf join dictionary using (term) join nth using (doc_id)""",
)
def read_doc_vectors(spark, sf):
    tf, _ = text_vectors(spark, sf)
    items = tf.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("term_id", "tf"))).alias("v"))
    every = inp.documents(spark, sf).select("doc_id").join(items, "doc_id", "left")
    cells = F.transform("v", lambda c: F.concat_ws(":", c["term_id"].cast("string"), c["tf"].cast("string")))
    return rd.read_doc_vectors(spark, _written(spark, every, F.coalesce(F.array_join(cells, " "), F.lit("")), ["doc_id"]))


@query(
    "read_gold_labels",
    """select row_number() over (order by doc_id) - 1 as doc_id, lang as label from documents qualify lang <> 'es'""",
)
def read_gold_labels(spark, sf):
    """Spanish documents are written as unlabeled."""
    gold = inp.lang_gold(spark, sf)
    line = F.when(F.col("label") == "es", "unlabeled").otherwise(F.col("label"))
    return rd.read_gold_labels(spark, _written(spark, gold, line, ["doc_id"]))


ASSIGNED = f"with {VECTORS}, {START}, {_assign('a0', 'c0')} select doc_id, cluster from a0"


@query("read_assignments", ASSIGNED)
def read_assignments(spark, sf):
    return rd.read_assignments(spark, _written(spark, assigned(spark, sf), _joined("doc_id", "cluster")))


@query("read_edges", f"with {EDGES} select src, dst, weight from edges")
def read_edges(spark, sf):
    return rd.read_edges(spark, _written(spark, inp.edges(spark, sf), _joined("src", "dst", "weight")))


@query("read_topic_distributions", f"with {DOC_TOPICS}, {USER_TOPICS} select user_id, query_id, topic, {r6('prob')} as prob from query_topics")
def read_topic_distributions(spark, sf):
    items = inp.query_topics(inp.order_lines(spark, sf)).groupBy("user_id", "query_id").agg(
        F.array_join(F.collect_list(_joined("topic", "prob", sep=":")), " ").alias("items")
    )
    read = rd.read_topic_distributions(spark, _written(spark, items, _joined("user_id", "query_id", "items")))
    return read.withColumn("prob", rounded("prob"))


@query("read_doc_topics", f"with {DOC_TOPICS} select doc_id, topic from doc_topics")
def read_doc_topics(spark, sf):
    return rd.read_doc_topics(spark, _written(spark, inp.doc_topics(spark, sf), _joined("doc_id", "topic")))


# Runs of nations (as users) and order priorities (as queries): few enough for one file each.
NATION_RUN = """sold as (
  select c_nationkey::bigint as user_id, cast(substr(o_orderpriority, 1, 1) as bigint) as query_id, l_partkey as doc_id,
         sum(l_extendedprice) as amount
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey group by 1, 2, 3),
scored as (select user_id, query_id, doc_id, ln(amount / sum(amount) over (partition by user_id, query_id)) as score from sold),
nation_run as (
  select *, cast(row_number() over (partition by user_id, query_id order by round(score, 9) desc, doc_id) as integer) as rank
  from scored)"""


def nation_run(spark, sf):
    from minegrain.functions.ordering import rank_within

    customers = inp.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("user_id")
    )
    orders = inp.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.substring("o_orderpriority", 1, 1).cast("bigint").alias("query_id")
    )
    lines = inp.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("doc_id"), "l_extendedprice")
    sold = lines.join(orders.join(customers, "o_custkey"), "l_orderkey").groupBy("user_id", "query_id", "doc_id").agg(
        F.sum("l_extendedprice").alias("amount")
    )
    total = sold.groupBy("user_id", "query_id").agg(F.sum("amount").alias("total"))
    scored = sold.join(total, ["user_id", "query_id"]).select(
        "user_id", "query_id", "doc_id", F.ln(F.col("amount") / F.col("total")).alias("score")
    )
    return rank_within(scored, ["user_id", "query_id"], [F.desc(F.round("score", 9)), F.asc("doc_id")])


@query("read_run_files", f"with {NATION_RUN} select user_id, query_id, doc_id, rank, {r6('score')} as score from nation_run")
def read_run_files(spark, sf):
    path = scratch_path(spark, "runs")
    line = _joined(F.lit("0 Q0"), "doc_id", "rank", "score", F.lit("run"))
    run = nation_run(spark, sf).select(
        F.concat_ws("-", "user_id", "query_id").alias("q"), line.alias("value")
    ).select(F.concat("q", F.lit(".results.txt")).alias("file"), "value")
    run.write.partitionBy("file").text(path)
    return rd.read_run_files(spark, path).withColumn("score", rounded("score"))


@query("read_ratings", f"with {RATINGS} select user_id, item_id, rating, cast(ts as varchar) as ts from ratings")
def read_ratings(spark, sf):
    path = _written(spark, inp.ratings(spark, sf), _joined("item_id", "user_id", "rating", "ts", sep=","))
    return rd.read_ratings(spark, path).withColumn("ts", F.col("ts").cast("string"))


@query("read_query_pairs", f"with {TRAIN} select row_number() over (order by pair_id) - 1 as pair_id, user_id, item_id from pairs")
def read_query_pairs(spark, sf):
    return rd.read_query_pairs(spark, _written(spark, inp.pairs(spark, sf), _joined("item_id", "user_id", sep=","), ["pair_id"]))


@query("read_values", f"with {SCORED} select row_number() over (order by pair_id) - 1 as pair_id, pred as value from scored")
def read_values(spark, sf):
    return rd.read_values(spark, _written(spark, inp.scored_pairs(spark, sf), F.col("pred"), ["pair_id"]))


@query(
    "read_reviews_json",
    f"with {REVIEWS} select review_id, text, stars from reviews union all select 'unlabelled ' || review_id, text, -1 from reviews",
)
def read_reviews_json(spark, sf):
    path = scratch_path(spark, "reviews")
    inp.reviews(spark, sf).write.json(path)
    hidden = rd.read_reviews_json(spark, path, labelled=False)
    hidden = hidden.withColumn("review_id", F.concat(F.lit("unlabelled "), "review_id"))
    return rd.read_reviews_json(spark, path).unionByName(hidden)


@query("read_stopwords", f"with {STATS} select term as word from df, n_docs where df * 10 > n")
def read_stopwords(spark, sf):
    """Terms of more than a tenth of the documents."""
    df = tx.document_frequency(inp.tf(spark, sf))
    often = df.filter(F.col("df") * 10 > inp.documents(spark, sf).count())
    return rd.read_stopwords(spark, _written(spark, often, F.concat(F.lit(" "), "term", F.lit(" "))))


@query(
    "read_dense_matrix",
    f"""with {ROWS} select row_number() over (order by row_id) - 1 as row_id, label, len(features) as size,
    {r6('list_sum(features)')} as total, {r6('features[2]')} as second from rows""",
)
def read_dense_matrix(spark, sf):
    rows = inp.rows(spark, sf)
    x = _written(spark, rows, F.array_join("features", ","), ["row_id"])
    y = _written(spark, rows, F.col("label"), ["row_id"])
    read = rd.read_dense_matrix(spark, x, y)
    total = F.aggregate("features", F.lit(0.0), lambda a, v: a + v)
    return read.select(
        "row_id", "label", F.size("features").cast("bigint").alias("size"), rounded(total).alias("total"), rounded(F.col("features")[1]).alias("second")
    )


def _sparse_rows(spark, sf):
    """Documents with 1-based dictionary features; label 1 for English texts, else -1."""
    tf, _ = text_vectors(spark, sf)
    english = F.when(F.col("label") == "en", 1).otherwise(-1)
    return tx.feature_rows(tf, inp.lang_gold(spark, sf).withColumn("label", english))


LIBSVM = f"""with {VOCABULARY}, nth as (
      select doc_id, lang, row_number() over (order by doc_id) - 1 as line from documents)
    select line as row_id, case when lang = 'en' then 1.0 else -1.0 end as label, new_id + 1 as feature, cast(tf as double) as value
    from tf join dictionary using (term) join nth using (doc_id)"""


def _libsvm_long(spark, path):
    rows = rd.read_libsvm(spark, path)
    return rows.select("row_id", "label", F.explode(F.arrays_zip("indices", "values")).alias("c")).select(
        "row_id", "label", F.col("c.indices").alias("feature"), F.col("c.values").alias("value")
    )


@query("read_libsvm", LIBSVM)
def read_libsvm(spark, sf):
    path = scratch_path(spark, "libsvm")
    wr.write_libsvm(_sparse_rows(spark, sf), path)
    return _libsvm_long(spark, path)


# --- writers -----------------------------------------------------------------------------------------------------

@query("write_assignments", ASSIGNED)
def write_assignments(spark, sf):
    path = scratch_path(spark, "assignments")
    wr.write_assignments(assigned(spark, sf), path)
    return rd.read_assignments(spark, path)


@query(
    "write_rank_vector",
    "select p_partkey as line, p_partkey || ' ' || printf('%.6f', ln(p_partkey + 2)) as value from part",
)
def write_rank_vector(spark, sf):
    path = scratch_path(spark, "ranks")
    ranks = inp.vertices(spark, sf).withColumn("rank", F.ln(F.col("id") + 2))
    wr.write_rank_vector(ranks, path)
    return rd.read_lines(spark, path).withColumnRenamed("line_no", "line")


@query(
    "write_trec_run",
    f"""with {NATION_RUN} select user_id || '-' || query_id as query, 'Q0' as q0, doc_id, rank, {r6('score')} as score, 'run-1' as tag
    from nation_run""",
)
def write_trec_run(spark, sf):
    path = scratch_path(spark, "trec")
    wr.write_trec_run(nation_run(spark, sf), path)
    return spark.read.csv(path, sep=" ", schema="query string, q0 string, doc_id bigint, rank int, score double, tag string").withColumn(
        "score", rounded("score")
    )


@query("write_predictions", f"with {SCORED} select row_number() over (order by pair_id) - 1 as pair_id, pred as value from scored")
def write_predictions(spark, sf):
    path = scratch_path(spark, "predictions")
    wr.write_predictions(inp.scored_pairs(spark, sf), path)
    return rd.read_values(spark, path)


@query(
    "write_hard_soft",
    f"with {SCORED} select row_number() over (order by pair_id) - 1 as line, cast(gold as integer) || ' ' || cast(pred as varchar) as value from scored",
)
def write_hard_soft(spark, sf):
    path = scratch_path(spark, "hardsoft")
    pred = inp.scored_pairs(spark, sf).select(F.col("pair_id").alias("row_id"), F.col("gold").alias("hard"), F.col("pred").alias("soft"))
    wr.write_hard_soft(pred, path)
    return rd.read_lines(spark, path).withColumnRenamed("line_no", "line")


@query(
    "write_libsvm",
    f"""with {VOCABULARY},
    v as (select doc_id, string_agg((new_id + 1) || ':' || tf || '.0', ' ' order by new_id) as v from tf join dictionary using (term) group by 1)
    select row_number() over (order by doc_id) - 1 as line,
      case when lang = 'en' then '1' else '-1' end || coalesce(' ' || v, '') as value from documents left join v using (doc_id)""",
)
def write_libsvm(spark, sf):
    path = scratch_path(spark, "libsvm")
    wr.write_libsvm(_sparse_rows(spark, sf), path)
    return rd.read_lines(spark, path).withColumnRenamed("line_no", "line")


@query("save_load_linear_model", f"with {GIVEN} select class, feature, {r6('w')} as w from weights")
def save_load_linear_model(spark, sf):
    path = scratch_path(spark, "model")
    ln.save_linear_model(given_model(spark, sf, CLASSES), spark, path)
    return ln.load_linear_model(spark, path).to_frame(spark).withColumn("w", rounded("w"))


# --- scalar functions --------------------------------------------------------------------------------------------

@query(
    "scalar_functions",
    f"""select l_orderkey, l_partkey, l_linenumber, {r6('ln(l_quantity)')} as ln_q, {r6('exp(-l_quantity)')} as exp_q, {r6('sqrt(l_quantity)')} as sqrt_q,
      pow(2, l_linenumber::double) as pow_q, abs(l_linenumber - 4) as abs_q, cast(sign(l_linenumber - 4) as double) as sign_q,
      cast(floor(l_quantity / 7) as bigint) as floor_q, l_orderkey // 7 as div_q,
      l_quantity * 1 as mul_0, l_quantity * l_linenumber as mul_1, l_quantity - 1 as sub_0, l_quantity + l_quantity * l_linenumber as dot_q,
      lower(l_returnflag) as lower_q, trim(' ' || l_returnflag || ' ') as trim_q, regexp_replace(l_returnflag, '[AN]', 'x') as replaced,
      split_part('a-' || l_linestatus, '-', 2) as split_q, cast(cast(l_linenumber as varchar) as integer) as cast_q,
      l_orderkey || '-' || l_linenumber as concat_q, printf('%.6f', sqrt(l_quantity)) as format_q,
      0.0::double as nan_q, cast(cast(l_shipdate as date) as varchar) as date_q, l_linenumber as json_q
    from lineitem""",
)
def scalar_functions(spark, sf):
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    a, b = F.array(q, q), F.array(F.lit(1.0), n.cast("double"))
    ones = F.array(F.lit(1.0), F.lit(1.0))
    json = F.concat(F.lit('{"k": '), n.cast("string"), F.lit("}"))
    return inp.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        rounded(F.ln(q)).alias("ln_q"),
        rounded(F.exp(-q)).alias("exp_q"),
        rounded(F.sqrt(q)).alias("sqrt_q"),
        F.pow(F.lit(2.0), n.cast("double")).alias("pow_q"),
        F.abs(n - 4).alias("abs_q"),
        F.signum((n - 4).cast("double")).alias("sign_q"),
        F.floor(q / 7).alias("floor_q"),
        F.expr("l_orderkey div 7").alias("div_q"),
        hadamard(a, b)[0].alias("mul_0"),
        hadamard(a, b)[1].alias("mul_1"),
        subtract(a, ones)[0].alias("sub_0"),
        dot(a, b).alias("dot_q"),
        F.lower("l_returnflag").alias("lower_q"),
        F.trim(F.concat(F.lit(" "), "l_returnflag", F.lit(" "))).alias("trim_q"),
        F.regexp_replace("l_returnflag", "[AN]", "x").alias("replaced"),
        F.split(F.concat(F.lit("a-"), "l_linestatus"), "-")[1].alias("split_q"),
        n.cast("string").cast("int").alias("cast_q"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("concat_q"),
        F.format_string("%.6f", F.sqrt(q)).alias("format_q"),
        F.nanvl(F.lit(float("nan")) * q, F.lit(0.0)).alias("nan_q"),
        F.to_date("l_shipdate").cast("string").alias("date_q"),
        F.from_json(json, "k int")["k"].alias("json_q"),
    )
