"""Hand-computed cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from minegrain.operators import evaluate as ev
from minegrain.operators import graph as g
from minegrain.operators import neighbours as nb
from minegrain.operators import text as tx
from minegrain.sources import writers as wr


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_macro_f1(spark):
    gold = frame(spark, [(0, "a"), (1, "a"), (2, "b"), (3, "b")], "doc_id long, label string")
    assign = frame(spark, [(0, 0), (1, 0), (2, 0), (3, 1)], "doc_id long, cluster int")
    assert ev.cluster_macro_f1(assign, gold).first()[0] == pytest.approx((0.8 + 2 / 3) / 2)


def test_macro_f1_counts_unlabelled_documents(spark):
    gold = frame(spark, [(0, "a"), (1, "a")], "doc_id long, label string")
    assign = frame(spark, [(0, 0), (1, 0), (2, 0)], "doc_id long, cluster int")
    assert ev.cluster_macro_f1(assign, gold).first()[0] == pytest.approx(2 * 2 / 5)


def test_ndcg(spark):
    pairs = frame(spark, [(0, 1, 0.9, 1.0), (1, 1, 0.1, 3.0)], "pair_id long, user_id long, pred double, gold double")
    dcg = 1 / math.log(2) + 7 / math.log(3)
    ideal = 7 / math.log(2) + 1 / math.log(3)
    rows = {r.k: r.ndcg for r in ev.ndcg_at_k(pairs).collect()}
    assert rows == {k: pytest.approx(dcg / ideal) for k in (10, 20, 30)}


def test_idf_floor(spark):
    df = frame(spark, [("x", 3), ("y", 2)], "term string, df long")
    idf = {r.term: r.idf for r in tx.idf_floor(df, 5).collect()}
    assert idf == {"x": 0.0, "y": pytest.approx(math.log(2))}


def test_pagerank_fixed_point(spark):
    edges = frame(spark, [(1, 2, 1.0)], "src long, dst long, weight double")
    ranks = {r.id: r["rank"] for r in g.pagerank(edges, tol=1e-10).collect()}
    assert ranks[1] == pytest.approx(0.1 / 0.6, abs=1e-6)
    assert ranks[2] == pytest.approx(1 - 0.1 / 0.6, abs=1e-6)


def test_explicit_self_loop_replaces_the_added_one(spark):
    edges = frame(spark, [(1, 1, 3.0), (1, 2, 1.0)], "src long, dst long, weight double")
    links = {(r.src, r.dst): r.p for r in g.transition_matrix(edges).collect()}
    assert links == {(1, 1): 0.75, (1, 2): 0.25, (2, 2): 1.0}


def test_hot_source_is_salted_without_changing_ranks(spark, monkeypatch):
    edges = frame(
        spark, [(0, i, 1.0) for i in range(1, 40)] + [(i, 0, 2.0) for i in range(1, 40, 3)], "src long, dst long, weight double"
    )
    plain = {r.id: r["rank"] for r in g.pagerank(edges).collect()}
    monkeypatch.setattr(g, "HOT_DEGREE", 5)
    assert {r.id: r["rank"] for r in g.pagerank(edges).collect()} == {k: pytest.approx(v) for k, v in plain.items()}


def test_topics_in_several_walks(spark, monkeypatch):
    edges = frame(spark, [(0, 1, 1.0), (1, 2, 1.0), (2, 3, 2.0), (3, 0, 1.0)], "src long, dst long, weight double")
    topics = frame(spark, [(0, 1), (1, 1), (2, 2), (3, 3)], "doc_id long, topic int")
    plain = {(r.topic, r.id): r["rank"] for r in g.topic_sensitive_pagerank(edges, topics).collect()}
    monkeypatch.setattr(g, "TOPICS_PER_PASS", 2)
    split = {(r.topic, r.id): r["rank"] for r in g.topic_sensitive_pagerank(edges, topics).collect()}
    assert split == {k: pytest.approx(v) for k, v in plain.items()}
    assert sum(plain.values()) == pytest.approx(3.0)


def test_pair_without_evidence_is_neutral(spark):
    pairs = frame(spark, [(0, 9, 9)], "pair_id long, user_id long, item_id long")
    ratings = frame(spark, [(1, 1, 5.0)], "user_id long, item_id long, rating double")
    none = frame(spark, [], "row long, neighbour long, sim double, place int")
    assert nb.knn_predict_user(pairs, ratings, none).first()["pred"] == 3.0


def test_constant_prediction_has_no_correlation(spark):
    pred = frame(spark, [(0, 1.0), (1, 1.0)], "pair_id long, pred double")
    gold = frame(spark, [(0, 1.0), (1, 3.0)], "pair_id long, gold double")
    row = ev.mse_and_squared_correlation(pred, gold).first()
    assert row.mse == 2.0 and math.isnan(row.r2)


def test_cleaning(spark):
    text = frame(spark, [("  It's a1b2 Net5 end\nof LINE! ",)], "text string")
    assert tx.clean_text(text).first()[0] == "its  n endof line"
    tokens = tx.tokenize(text.withColumn("doc_id", F.lit(1)).transform(tx.clean_text))
    assert sorted(r.term for r in tokens.collect()) == ["endof", "its", "line"]


def test_vertices_without_links_and_repeated_links(spark):
    edges = spark.createDataFrame([(1, 3, 1.0, 0), (1, 3, 5.0, 1)], "src long, dst long, weight double, line_no long")
    links = g.transition_matrix(g.last_links(edges, "line_no"), g.dense_vertices(edges))
    assert {(r.src, r.dst): r.p for r in links.collect()} == {
        (1, 1): pytest.approx(1 / 6),
        (1, 3): pytest.approx(5 / 6),
        (2, 2): 1.0,
        (3, 3): 1.0,
    }


def test_all_fused_runs_in_one_call(spark, tmp_path):
    run = spark.createDataFrame(
        [(1, 1, 7, 1, -1.0, 0.2, 0.5), (1, 1, 8, 2, -2.0, 0.3, 0.1)],
        "user_id long, query_id long, doc_id long, rank int, score double, a double, b double",
    )
    wr.write_trec_runs(g.rerank_run(g.fuse_scores(run, ["a", "b"])), str(tmp_path / "runs"))
    read = spark.read.text(str(tmp_path / "runs")).collect()
    assert sorted({r.method for r in read}) == ["CM_a", "CM_b", "NS_a", "NS_b", "WS_a", "WS_b"]
    assert sorted(r.value for r in read if r.method == "NS_a") == ["1-1 Q0 7 2 2000.000000 run-1", "1-1 Q0 8 1 3000.000000 run-1"]


def test_walk_over_a_grid_of_links(spark, monkeypatch):
    """Ranks move as one row for each cell of the grid; links are rows of bounded size, and a hot vertex changes nothing."""
    monkeypatch.setattr(g, "HOT_DEGREE", 3)
    monkeypatch.setattr(g, "BLOCK_RANKS", 8)
    rng = np.random.default_rng(4)
    pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, 30, (60, 2)) if a != b} | {(0, i) for i in range(1, 30)})
    edges = spark.createDataFrame([(a, b, float(1 + (a + b) % 3)) for a, b in pairs], "src long, dst long, weight double")
    topics = spark.createDataFrame([(i % 3 + 1, i) for i in range(30)], "topic int, doc_id long")
    m = np.eye(30)
    for a, b in pairs:
        m[a, b] += 1 + (a + b) % 3
    m /= m.sum(axis=1, keepdims=True)
    found = {(r.topic, r.id): r["rank"] for r in g.topic_sensitive_pagerank(edges, topics, tol=None, min_iter=7).collect()}
    assert len(found) == 90
    for t in (1, 2, 3):
        jump = 0.1 / 30 + 0.1 * np.array([1 / 10 if i % 3 + 1 == t else 0.0 for i in range(30)])
        r = np.full(30, 1 / 30)
        for _ in range(7):
            r = 0.8 * m.T @ r + 0.2 * jump
        np.testing.assert_allclose([found[t, i] for i in range(30)], r / r.sum(), atol=1e-12)
    links = g.transition_matrix(edges)
    teleport = links.selectExpr("src as id").distinct().selectExpr("id", "1.0D as a", "2.0D as b")
    walk = g._Walk(links, teleport, ["a", "b"], 30)
    assert walk.teleport.count() <= walk.side == 8 and max(r.n for r in walk.links.selectExpr("size(p) as n").collect()) == 3
    assert walk.step(walk.teleport, walk.teleport, 2, 0.2).count() <= 8
    walk.close()
