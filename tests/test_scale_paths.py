"""The paths for skewed or large inputs give what brute force gives."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from minegrain.functions import ordering as od
from minegrain.operators import clusters as cl
from minegrain.operators import graph
from minegrain.operators import letor as lt
from minegrain.operators import linear as ln
from minegrain.operators import neighbours as nb
from minegrain.operators import tiles
from minegrain.operators.tiles import tiled_product


@pytest.fixture(scope="module")
def skewed():
    """60 x 40 matrix with a hot row and a hot column."""
    rng = np.random.default_rng(3)
    m = np.where(rng.random((60, 40)) < 0.1, rng.normal(size=(60, 40)), 0.0)
    m[7], m[:, 5] = rng.normal(size=40), rng.normal(size=60)
    return m


def cells(spark, m, names="row long, inner long, value double"):
    at = np.argwhere(m)
    return spark.createDataFrame([(int(a), int(b), float(m[a, b])) for a, b in at], names)


@pytest.mark.parametrize("block_rows,tile_cells", [(512, 500_000), (16, 500_000), (16, 20), (7, 5)])
def test_tiled_gram(spark, skewed, block_rows, tile_cells):
    found = tiled_product(cells(spark, skewed), block_rows=block_rows, tile_cells=tile_cells).collect()
    gram = skewed @ skewed.T
    wanted = {(i, j): gram[i, j] for i in range(60) for j in range(i + 1, 60) if gram[i, j] != 0}
    assert len(found) == len(wanted)
    assert {(r.left, r.right): r.value for r in found} == {k: pytest.approx(v, abs=1e-9) for k, v in wanted.items()}


@pytest.mark.parametrize("block_rows,tile_cells", [(512, 500_000), (9, 11)])
def test_tiled_product_of_two(spark, skewed, block_rows, tile_cells):
    other = skewed[:30] * 2.0 + (skewed[:30] != 0)
    found = tiled_product(cells(spark, skewed), cells(spark, other), block_rows, tile_cells).collect()
    wanted = skewed @ other.T
    got = np.zeros_like(wanted)
    for r in found:
        got[r.left, r.right] = r.value
    assert len(found) == len({(r.left, r.right) for r in found})
    np.testing.assert_allclose(got, wanted, atol=1e-9)


@pytest.fixture(params=["whole", "cut"])
def way(request, monkeypatch):
    """Both ways of tiles to their partners."""
    monkeypatch.setattr(tiles, "COUNTED_BLOCKS", 1 if request.param == "cut" else 10**9)
    monkeypatch.setattr(tiles, "CUT_ADVANTAGE", 0)
    return request.param


@pytest.mark.parametrize("block_rows,tile_cells", [(512, 500_000), (7, 500_000), (7, 5), (60, 9)])
def test_ways_of_tiles_agree(spark, skewed, way, block_rows, tile_cells):
    found = tiled_product(cells(spark, skewed), block_rows=block_rows, tile_cells=tile_cells).collect()
    gram = skewed @ skewed.T
    wanted = {(i, j): pytest.approx(gram[i, j], abs=1e-9) for i in range(60) for j in range(i + 1, 60) if gram[i, j] != 0}
    assert len(found) == len(wanted) and {(r.left, r.right): r.value for r in found} == wanted
    other = skewed[:30] * 2.0 + (skewed[:30] != 0)
    found = tiled_product(cells(spark, skewed), cells(spark, other), block_rows, tile_cells).collect()
    got = np.zeros((60, 30))
    for r in found:
        got[r.left, r.right] = r.value
    assert len(found) == len({(r.left, r.right) for r in found})
    np.testing.assert_allclose(got, skewed @ other.T, atol=1e-9)


def test_cut_tiles_move_shared_keys_only(spark):
    """Rows in pairs with keys of their own: blocks meet where they share a key, not each with each."""
    rows = [(r, (r // 2) * 10 + j, 1.0) for r in range(400) for j in range(3)]
    m = spark.createDataFrame(rows, "row long, inner long, value double")
    work, striped = tiles._tile_pairs(m, None, 4, 500_000)
    moved = work.select(F.size("rows").alias("n")).agg(F.count("n"), F.sum("n")).first()
    assert not striped and moved[0] <= 300 and moved[1] <= 2400  # 100 blocks: 5,050 pairs of blocks
    assert tiled_product(m, block_rows=4).count() == 200


@pytest.mark.parametrize("by,kind", [("user", "dot"), ("user", "cosine"), ("item", "cosine"), ("item", "pcc")])
def test_nearest_neighbours_with_a_hot_item(spark, monkeypatch, way, by, kind):
    """One item rated by everyone and one user who rated everything: stripes, but no list of pairs."""
    rng = np.random.default_rng(12)
    m = np.where(rng.random((40, 30)) < 0.2, rng.integers(1, 6, (40, 30)), 0)
    m[:, 3], m[5] = rng.integers(1, 6, 40), rng.integers(1, 6, 30)
    ratings = spark.createDataFrame(
        [(int(u), int(i), float(m[u, i])) for u, i in np.argwhere(m)], "user_id long, item_id long, rating double"
    )
    names = {"dot": "dot", "cosine": "cosine", "pcc": "pcc"}
    pairs = getattr(nb, f"{by}_similarity_{names[kind]}")(ratings)
    n = 40 if by == "user" else 30
    wanted = {(r.row, r.neighbour): (r.sim, r.place) for r in nb.topk_neighbours(pairs, n, 9).collect()}
    monkeypatch.setattr(tiles, "BLOCK_ROWS", (6, 6))
    monkeypatch.setattr(tiles, "TILE_CELLS", 12)
    monkeypatch.setattr(nb, "tiled_product", None)  # would list the pairs
    found = nb.nearest_neighbours(ratings, 9, by, kind)
    assert {(r.row, r.neighbour): r.place for r in found.collect()} == {p: v[1] for p, v in wanted.items()}
    assert all(abs(r.sim - wanted[r.row, r.neighbour][0]) < 1e-9 for r in found.collect())


def test_row_index_and_ranks(spark):
    rng = np.random.default_rng(1)
    keys = np.where(rng.random(500) < 0.4, 0, rng.integers(1, 20, 500))
    rows = [(int(k), float(v), i) for i, (k, v) in enumerate(zip(keys, rng.integers(0, 50, 500)))]
    df = spark.createDataFrame(rows, "k long, v double, i long").repartition(7)
    ordered = sorted(rows, key=lambda r: (r[0], -r[1], r[2]))
    index = {r.i: r.at for r in od.with_row_index(df, ["k", F.desc("v"), "i"], "at").collect()}
    assert index == {r[2]: n for n, r in enumerate(ordered)}
    ranks = {r.i: r["rank"] for r in od.rank_within(df, ["k"], [F.desc("v"), F.asc("i")]).collect()}
    wanted, seen = {}, {}
    for k, _, i in ordered:
        seen[k] = wanted[i] = seen.get(k, 0) + 1
    assert ranks == wanted
    top = {r.i: r["rank"] for r in od.rank_within(df, ["k"], [F.desc("v"), F.asc("i")], limit=3).collect()}
    assert top == {i: r for i, r in wanted.items() if r <= 3}


@pytest.mark.parametrize("chunk", [2000, 3])
def test_chunked_pairs(spark, chunk):
    left = [(k, i) for k in range(4) for i in range(20 if k == 0 else 3)]
    right = [(k, i) for k in range(1, 5) for i in range(2)] + [(0, i) for i in range(15)]
    found = od.chunked_pairs(
        spark.createDataFrame(left, "k long, a long"), spark.createDataFrame(right, "k long, b long"), "k", "a", "b", chunk
    ).collect()
    wanted = sorted((k, a, b) for k, a in left for j, b in right if j == k)
    assert sorted((r.k, r.a, r.b) for r in found) == wanted


@pytest.mark.parametrize("k", [2, 5, 8, 40])
def test_neighbour_rule_with_negatives(spark, k):
    """Zeros outrank negatives and are then dropped: k counts positives, zeros and negatives of the dense row."""
    rng = np.random.default_rng(5)
    n = 12
    sim = np.triu(np.where(rng.random((n, n)) < 0.6, np.round(rng.normal(size=(n, n)), 3), 0.0), 1)
    pairs = spark.createDataFrame([(int(a), int(b), float(sim[a, b])) for a, b in np.argwhere(sim)], "a long, b long, sim double")
    full, wanted = sim + sim.T, set()
    for row in range(n):
        others = sorted((j for j in range(n) if j != row), key=lambda j: (-full[row, j], j))
        # Among equal similarities zeros are exchangeable: only non-zero neighbours are results.
        wanted |= {(row, j) for j in others[: min(k, n - 1)] if full[row, j] != 0}
    assert {(r.row, r.neighbour) for r in nb.topk_neighbours(pairs, n, k).collect()} == wanted


def test_knn_against_dense(spark):
    rng = np.random.default_rng(8)
    m = np.where(rng.random((25, 18)) < 0.35, rng.integers(1, 6, (25, 18)), 0).astype(float)
    at = np.argwhere(m)
    ratings = spark.createDataFrame([(int(u), int(i), float(m[u, i])) for u, i in at], "user_id long, item_id long, rating double")
    asked = [(n, int(u), int(i)) for n, (u, i) in enumerate(rng.integers(0, [25, 18], (40, 2)))]
    pairs = spark.createDataFrame(asked, "pair_id long, user_id long, item_id long")
    centred = np.where(m > 0, m - 3.0, 0.0)
    sim = centred @ centred.T
    np.fill_diagonal(sim, -np.inf)
    keep = np.zeros_like(sim)
    for u in range(25):
        best = sorted(range(25), key=lambda v: (-sim[u, v], v))[:6]
        keep[u, [v for v in best if np.isfinite(sim[u, v]) and sim[u, v] != 0]] = 1.0
    total = keep.sum(axis=1, keepdims=True)
    pred = (keep / np.where(total > 0, total, 1.0)) @ centred + 3.0
    top = nb.topk_neighbours(nb.user_similarity_dot(ratings), 25, 6)
    found = {r.pair_id: r.pred for r in nb.knn_predict_user(pairs, ratings, top).collect()}
    # Rows where the cut falls among zeros of equal rank are the same set in both.
    assert found == {n: pytest.approx(pred[u, i]) for n, u, i in asked}


@pytest.mark.parametrize("by,kind", [("user", "dot"), ("user", "cosine"), ("item", "cosine"), ("item", "pcc")])
@pytest.mark.parametrize("tile_cells", [500_000, 30])
def test_nearest_neighbours_equal_ranked_pairs(spark, monkeypatch, by, kind, tile_cells):
    rng = np.random.default_rng(11)
    m = np.where(rng.random((30, 22)) < 0.3, rng.integers(1, 6, (30, 22)), 0)
    ratings = spark.createDataFrame(
        [(int(u), int(i), float(m[u, i])) for u, i in np.argwhere(m)], "user_id long, item_id long, rating double"
    )
    similarity = {
        ("user", "dot"): nb.user_similarity_dot,
        ("user", "cosine"): nb.user_similarity_cosine,
        ("item", "cosine"): nb.item_similarity_cosine,
        ("item", "pcc"): nb.item_similarity_pcc,
    }[by, kind]
    n = (m.sum(axis=1) > 0).sum() if by == "user" else (m.sum(axis=0) > 0).sum()
    for k in (3, 15, 100):
        wanted = {(r.row, r.neighbour): (r.sim, r.place) for r in nb.topk_neighbours(similarity(ratings), int(n), k).collect()}
        monkeypatch.setattr(tiles, "BLOCK_ROWS", (6, 6))
        monkeypatch.setattr(tiles, "TILE_CELLS", tile_cells)
        found = nb.nearest_neighbours(ratings, k, by, kind).collect()
        assert {(r.row, r.neighbour): r.place for r in found} == {p: v[1] for p, v in wanted.items()}
        assert all(abs(r.sim - wanted[r.row, r.neighbour][0]) < 1e-9 for r in found)


@pytest.mark.parametrize("by,kind,cut", [("user", "dot", False), ("item", "cosine", True), ("item", "pcc", False)])
def test_nearest_rows_hand_over_their_best_only(spark, monkeypatch, by, kind, cut):
    """Many groups, blocks, lots and chunks: a row leaves its task with its k best, not with the best of every block pair."""
    from minegrain.operators import nearest

    rng = np.random.default_rng(17)
    m = np.where(rng.random((50, 40)) < 0.35, rng.integers(1, 6, (50, 40)), 0)
    ratings = spark.createDataFrame(
        [(int(u), int(i), float(m[u, i])) for u, i in np.argwhere(m)], "user_id long, item_id long, rating double"
    )
    n = 50 if by == "user" else 40
    pairs = getattr(nb, f"{by}_similarity_{kind}")(ratings)
    wanted = {(r.row, r.neighbour): (r.place, pytest.approx(r.sim)) for r in nb.topk_neighbours(pairs, n, 35).collect()}
    for name, size in (("BLOCK_CELLS", 10), ("GROUP_CELLS", 60), ("LOT_CELLS", 40), ("CHUNK_PRODUCTS", 16)):
        monkeypatch.setattr(nearest, name, size)
    monkeypatch.setattr(nearest, "CUT_ADVANTAGE", 0 if cut else 10**9)
    found = nb.nearest_neighbours(ratings, 35, by, kind).collect()
    assert len(found) == len(wanted) and {(r.row, r.neighbour): (r.place, r.sim) for r in found} == wanted


def test_predictions_make_neighbours_once(spark):
    """Weights and their totals come from stored neighbours."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def sim(x):
        made.add(1)
        return float(x)

    top = spark.createDataFrame([(1, 2, 1), (1, 3, 3), (2, 1, 1)], "row long, neighbour long, x int")
    shares = nb._shares(top.select("row", "neighbour", sim("x").alias("sim")), True).collect()
    assert made.value == 3 and sorted(map(tuple, shares)) == [(1, 2, 0.25), (1, 3, 0.75), (2, 1, 1.0)]


def test_sweep_evidence_of_hot_and_other_keys(spark):
    """Pairs whose other side has more ratings than k go by their neighbours, all others by the ratings."""
    ranked = spark.createDataFrame([(1, 2, 0.5, 1), (1, 3, 0.4, 2), (2, 1, 0.5, 1)], "user_id long, neighbour long, sim double, place int")
    given = spark.createDataFrame([(u, 7, 1.0) for u in (1, 2, 3, 4)] + [(2, 8, 2.0), (4, 8, -1.0)], "neighbour long, item_id long, rating double")
    pairs = spark.createDataFrame([(10, 1, 7), (11, 1, 8), (12, 2, 8), (13, 2, 7), (14, 5, 9)], "pair_id long, user_id long, item_id long")
    found = nb._sweep_evidence(pairs, ranked, given, "user_id", "item_id", 3).select("pair_id", "neighbour", "rating", "place")
    assert sorted(map(tuple, found.collect())) == [(10, 2, 1.0, 1), (10, 3, 1.0, 2), (11, 2, 2.0, 1), (13, 1, 1.0, 1)]


def test_joined_assignment_equals_packed(spark):
    rng = np.random.default_rng(2)
    v = np.where(rng.random((80, 30)) < 0.2, rng.normal(size=(80, 30)), 0.0)
    v[:, 0] += 0.1
    c = np.where(rng.random((6, 30)) < 0.3, rng.normal(size=(6, 30)), 0.0)
    vectors = cells(spark, v, "doc_id long, term_id long, weight double").withColumn("term_id", F.col("term_id").cast("int"))
    centroids = cells(spark, c, "cluster long, term_id long, w double").select(
        F.col("cluster").cast("int"), F.col("term_id").cast("int"), "w"
    )
    packed = {r.doc_id: r.cluster for r in cl.assign_cosine(vectors, centroids).collect()}
    assert {r.doc_id: r.cluster for r in cl._assign_ranges(cl.pack_documents(vectors), centroids).collect()} == packed


from minegrain.operators.kmeans_grid import lots_of_fits as cl_lots  # noqa: E402


def test_assignment_in_ranges(spark, monkeypatch):
    """Ranges of two clusters, one cluster without length, documents without common terms or without length."""
    rng = np.random.default_rng(12)
    v = np.where(rng.random((200, 40)) < 0.1, rng.normal(size=(200, 40)), 0.0)
    v[5:9, 0] += 1e-3
    c = np.where(rng.random((9, 40)) < 0.3, rng.normal(size=(9, 40)), 0.0)
    vectors = cells(spark, v, "doc_id long, term_id long, weight double").withColumn("term_id", F.col("term_id").cast("int"))
    vectors = vectors.unionByName(spark.createDataFrame([(900, 77, 1.0), (901, 3, 0.0)], vectors.schema))
    centroids = cells(spark, c, "cluster long, term_id long, w double").select(
        F.col("cluster").cast("int"), F.col("term_id").cast("int"), "w"
    )
    centroids = centroids.unionByName(spark.createDataFrame([(20, 1, 0.0)], centroids.schema))
    one = {r.doc_id: r.cluster for r in cl.assign_cosine(vectors, centroids).collect()}
    monkeypatch.setattr(cl, "MAX_CENTROID_CELLS", 25)
    assert {r.doc_id: r.cluster for r in cl.assign_cosine(vectors, centroids).collect()} == one
    assert one[900] == one[901] == 0


def _draws_one_by_one(v, k, seed, weight):
    """Rows drawn one after the other, each by a race over all rows."""
    import hashlib

    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    chosen = []
    for step in range(k):
        w = np.ones(len(v))
        if chosen:
            sims = np.round(unit @ unit[chosen].T, 10)
            w = 1.0 - sims.max(axis=1) if weight == "distance" else sims.min(axis=1)
        keys = []
        for doc in range(len(v)):
            digits = hashlib.md5(f"{seed}|{step}|{doc}".encode()).hexdigest()[:10]
            keys.append(-np.log((int(digits, 16) + 0.5) / (1 << 40)) / w[doc] if w[doc] > 1e-9 else np.inf)
        if min(keys) == np.inf:
            break
        chosen.append(int(np.argmin(keys)))
    return chosen


@pytest.mark.parametrize("weight", ["distance", "min_similarity"])
def test_draws_of_several_steps_a_pass(spark, weight, monkeypatch):
    """The same documents as with a pass per draw, in far fewer passes."""
    from minegrain.operators import stacks

    rng = np.random.default_rng(8)
    v = rng.random((300, 6)) ** 4 + 1e-3
    v[200:] = v[:100]  # copies
    vectors = cells(spark, v, "doc_id long, term_id long, weight double")
    packed = cl.cut_lineage(cl.pack_documents(vectors))
    passes = []
    race = stacks._race
    monkeypatch.setattr(stacks, "_race", lambda *a: passes.append(1) or race(*a))
    found = stacks.draw_sequences(packed, 60, [1, 2], weight)
    for seed, rows in zip([1, 2], found, strict=True):
        expected = _draws_one_by_one(v, 60, seed, weight)
        assert [w.tolist() for _, w in rows] == [v[d].tolist() for d in expected]
    assert len(passes) <= 20


def test_draws_end_with_the_documents(spark):
    v = np.eye(4)[[0, 1, 2, 3, 0, 1]]
    vectors = cells(spark, v, "doc_id long, term_id long, weight double")
    assert [len(x) for x in cl.draw_sequences(cl.cut_lineage(cl.pack_documents(vectors)), 9, [0, 5], "distance")] == [4, 4]
    with pytest.raises(ValueError, match="only 4"):
        cl.init_kmeanspp(vectors, 5)


@pytest.mark.parametrize("limit", [20_000_000, 700])
def test_sweep_equals_single_fits(spark, monkeypatch, limit):
    rng = np.random.default_rng(3)
    tf = np.where(rng.random((70, 25)) < 0.3, rng.integers(1, 6, (70, 25)), 0)
    tf[:, 0] = 1
    rows = cells(spark, tf.astype(float), "doc_id long, term_id long, tf double").withColumn("tf", F.col("tf").cast("int"))
    rows = rows.withColumn("term_id", F.col("term_id").cast("int"))
    gold = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(70)] + [(99, "d")], "doc_id long, label string")
    ks = [2, 5, 9, 80]
    monkeypatch.setattr(cl, "lots_of_fits", lambda *a: cl_lots(*a, limit))
    found = {(r.variant, r.k, r.iteration): (r.rounds, r.f1) for r in cl.kmeans_sweep(rows, gold, ks, repeats=2).collect()}
    assert len(found) == 3 * 4 * 2
    assert all(found[v, 80, i] == (None, None) for v in ("kmeansplusplus", "custom") for i in (1, 2))
    plain = rows.select("doc_id", "term_id", F.col("tf").cast("double").alias("weight"))
    weighted = cl.tfidf(rows, cl.document_frequency(rows, "term_id"), 70, term="term_id")
    for variant, vectors, init in (("basic", plain, "random"), ("kmeansplusplus", plain, "++"), ("custom", weighted, "++")):
        for k in (2, 9):
            _, assign, rounds = cl.kmeans_fit(vectors, k, init, None, 1)
            assert found[variant, k, 2] == (rounds, pytest.approx(cl.cluster_macro_f1(assign, gold).first()[0]))


def test_kmeans_without_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(4)
    v = rng.random((60, 12)) ** 3
    vectors = cells(spark, v, "doc_id long, term_id long, weight double")
    vectors = vectors.withColumn("term_id", F.col("term_id").cast("int"))
    start = vectors.filter("doc_id < 5").select(F.col("doc_id").cast("int").alias("cluster"), "term_id", F.col("weight").alias("w"))
    _, one, n = cl.kmeans_fit(vectors, 5, start, max_iter=30)
    assert n < 30
    monkeypatch.setattr(cl, "MAX_CENTROID_CELLS", 1)
    centroids, two, _ = cl.kmeans_fit(vectors, 5, start, max_iter=30)
    assert {r.doc_id: r.cluster for r in one.collect()} == {r.doc_id: r.cluster for r in two.collect()}
    assert centroids.select("cluster").distinct().count() == 5


def test_empty_cluster_keeps_its_centroid(spark):
    vectors = spark.createDataFrame([(0, 0, 1.0), (1, 0, 2.0)], "doc_id long, term_id int, weight double")
    start = spark.createDataFrame([(0, 0, 1.0), (1, 1, 4.0)], "cluster int, term_id int, w double")
    centroids, assign, _ = cl.kmeans_fit(vectors, 2, start, max_iter=5)
    assert {(r.cluster, r.term_id): r.w for r in centroids.collect()} == {(0, 0): 1.5, (1, 1): 4.0}
    assert {r.cluster for r in assign.collect()} == {0}


@pytest.mark.parametrize("weight", ["distance", "min_similarity"])
def test_seeding_draws_distinct_documents(spark, weight):
    rng = np.random.default_rng(6)
    vectors = cells(spark, rng.random((40, 8)), "doc_id long, term_id long, weight double")
    vectors = vectors.withColumn("term_id", F.col("term_id").cast("int"))
    a = cl.init_kmeanspp(vectors, 5, seed=1, weight=weight).toPandas()
    b = cl.init_kmeanspp(vectors.repartition(5), 5, seed=1, weight=weight).toPandas()
    order = ["cluster", "term_id"]
    assert a.sort_values(order, ignore_index=True).equals(b.sort_values(order, ignore_index=True))
    assert a["cluster"].nunique() == 5


def test_rank_svm_equals_training_on_pair_rows(spark, monkeypatch):
    rng = np.random.default_rng(9)
    ratings = spark.createDataFrame(
        [(u, i, float(rng.choice([1.0, 3.0, 5.0]))) for u in range(6) for i in range(30 if u == 0 else 6)],
        "user_id long, item_id long, rating double",
    )
    users = spark.createDataFrame([(u, rng.random(3).tolist()) for u in range(6)], "id long, f array<double>")
    items = spark.createDataFrame([(i, rng.random(3).tolist()) for i in range(30)], "id long, f array<double>")
    rows = lt.pairwise_training_set(ratings, users, items)
    prefs = lt.preference_self_join(lt.filter_extreme_ratings(ratings))
    assert rows.count() == prefs.count() > 20
    rows = rows.select(F.col("y").alias("label"), F.col("x").alias("features"))
    direct = ln.linear_l2_squared_hinge(rows, C=0.05, bias=1.0, eps=1e-9).weights[0, :3]
    np.testing.assert_allclose(lt.rank_svm_weights(ratings, users, items, C=0.05), direct, atol=1e-5)
    monkeypatch.setattr(lt, "GRID_CHUNK", 4)
    monkeypatch.setattr(lt, "LOT_ROWS", 10)
    np.testing.assert_allclose(lt.rank_svm_weights(ratings, users, items, C=0.05), direct, atol=1e-5)


@pytest.mark.parametrize("n, cells, ids", [(1, 1, 3), (2, 1, 3), (150, 1, 40), (200, 9, 500), (200, 60, 4)])
def test_pairwise_sums_against_every_pair(n, cells, ids):
    """Repeated ids and scores that tie, cells with one side only, cells of one row."""
    rng = np.random.default_rng(n + cells)
    cell, item, high = np.sort(rng.integers(0, cells, n)), rng.integers(0, ids, n), rng.random(n) < 0.5
    x, w, offset = rng.integers(0, 5, (n, 3)) / 4.0, np.array([2.0, -1.0, 0.5]), 0.25
    value, grad, hess = 0.0, np.zeros(4), np.zeros((4, 4))
    for i in np.flatnonzero(high):
        for j in np.flatnonzero(~high & (cell == cell[i])):
            d = np.append(x[i] - x[j], 1.0 if item[i] < item[j] else -1.0)
            short = 1.0 - d @ np.append(w, offset)
            if short > 0:
                value, grad, hess = value + short * short, grad - 2.0 * short * d, hess + 2.0 * np.outer(d, d)
    shuffled = rng.permutation(n)
    found = lt.pairwise_sums(cell[shuffled], item[shuffled], high[shuffled], x[shuffled], w, offset, True)
    for a, b in zip(found, (value, grad, hess)):
        np.testing.assert_allclose(a, b, atol=1e-9)


def test_hot_user_is_dealt_to_cells_of_many_tasks(spark, monkeypatch):
    """One user with nearly all ratings: cells are bounded, hold each high x low pair once, and lie in several tasks."""
    monkeypatch.setattr(lt, "GRID_CHUNK", 50)
    spread = F.when(F.pmod(F.xxhash64("id"), F.lit(2)) == 0, 1.0).otherwise(5.0)
    user = F.when(F.col("id") < 590, 0).otherwise(1).alias("user_id")
    ratings = spark.range(600).select(user, F.col("id").alias("item_id"), spread.alias("rating"))
    users = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "id long, f array<double>")
    items = spark.range(600).select("id", F.array(F.col("id") / 600.0).alias("f"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one task
    try:
        cells = lt._preference_cells(ratings, users, items).withColumn("task", F.spark_partition_id()).toPandas()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert cells["task"].nunique() > 1
    sides = cells.groupby([*lt.CELL, "high"]).size().unstack(fill_value=0)
    assert sides.to_numpy().max() <= 100  # chunks by hash are near 50
    for user in (0, 1):
        own = cells[cells["user_id"] == user]
        met = own[own["high"]].merge(own[~own["high"]], on=lt.CELL)[["item_id_x", "item_id_y"]]
        n = own[own["high"]]["item_id"].nunique() * own[~own["high"]]["item_id"].nunique()
        assert len(met) == len(met.drop_duplicates()) == n > 0


def test_ndcg_of_rankers(spark):
    """From ratings to NDCG: equal to the single steps with plain-Python gains; nothing to learn from is an error."""
    rng = np.random.default_rng(3)
    rated = [(u, i, float(rng.choice([1.0, 3.0, 5.0])), int(rng.integers(4))) for u in range(12) for i in range(10)]
    schema = "user_id long, item_id long, rating double, part int"
    ratings = spark.createDataFrame(rated, schema)
    train = ratings.filter("part > 0").drop("part")
    pairs = ratings.filter("part = 0").selectExpr("user_id * 100 + item_id as pair_id", "user_id", "item_id", "rating as gold")
    found = lt.ndcg_of_rankers(train, pairs, dims=(2,), ks=(2, 5), max_iter=2, min_iter=2, seed=1).collect()
    assert {(r.dim, r.ranker, r.k) for r in found} == {(2, m, k) for m in ("pmf", "svm", "logistic") for k in (2, 5)}
    model = lt.pmf_fit(train, 2, max_iter=2, min_iter=2, seed=1)
    scored = lt.rank_svm(train, pairs, model.users, model.items).toPandas()
    for k in (2, 5):
        gains = []
        for _, own in scored.groupby("user_id"):
            def dcg(by):
                top = own.sort_values([by, "pair_id"], ascending=[False, True])["gold"].to_numpy()[:k]
                return ((2.0**top - 1.0) / np.log(np.arange(len(top)) + 2.0)).sum()

            gains.append(dcg("score") / dcg("gold"))
        ndcg = next(r.ndcg for r in found if (r.ranker, r.k) == ("svm", k))
        assert ndcg == pytest.approx(np.mean(gains))
    with pytest.raises(ValueError, match="both a highest and a lowest"):
        lt.ndcg_of_rankers(train.filter("rating > 1"), pairs)


def test_ratings_without_both_sides_train_nothing(spark):
    """Users with one side only have no pairs: weights are zero."""
    ratings = spark.createDataFrame([(0, 0, 5.0), (1, 0, 1.0)], "user_id long, item_id long, rating double")
    factors = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 1.0])], "id long, f array<double>")
    assert not lt.rank_svm_weights(ratings, factors, factors).any()


def test_small_products_stay(spark):
    from minegrain.operators.matrix import sparse_matmul

    a = spark.createDataFrame([(1, 1, 1e-7), (2, 1, 1e-7), (3, 2, 2.0), (3, 3, 1.0)], "row long, col long, value double")
    b = spark.createDataFrame([(1, 1, 1e-7), (2, 1, 1.0), (3, 1, -2.0)], "row long, col long, value double")
    found = {(r.row, r.col): r.value for r in sparse_matmul(a, b).collect()}
    assert found == {(1, 1): pytest.approx(1e-14), (2, 1): pytest.approx(1e-14)}  # exact zeros alone are left out


def test_gaps_in_cluster_ids_and_large_term_ids(spark):
    big = 10**15
    vectors = spark.createDataFrame([(10, -7, -1.0), (10, big, 0.5), (11, -7, 1.0)], "doc_id long, term_id long, weight double")
    centroids = spark.createDataFrame([(3, -7, 1.0), (5, -7, 0.5), (5, big, 1.0)], "cluster int, term_id long, w double")
    packed = {r.doc_id: r.cluster for r in cl.assign_cosine(vectors, centroids).collect()}
    assert packed == {10: 5, 11: 3}
    assert {r.doc_id: r.cluster for r in cl._assign_ranges(cl.pack_documents(vectors), centroids).collect()} == packed
    fitted, assign, _ = cl.kmeans_fit(vectors, 2, centroids)
    assert {r.doc_id: r.cluster for r in assign.collect()} == packed
    assert {r.term_id for r in fitted.collect()} == {-7, big}


@pytest.mark.parametrize("fraction", [0.2, 3.0, 40.0])
def test_holdout_draws_are_not_cut(spark, fraction):
    from minegrain.operators.sampling import holdout_split

    rows = spark.range(4000).withColumnRenamed("id", "row_id")
    train, drawn = holdout_split(rows, fraction, seed=1)
    counts = drawn.groupBy("row_id").count().toPandas()["count"]
    total = counts.sum() / 4000
    assert abs(total - fraction) < 5 * (fraction / 4000) ** 0.5
    assert train.count() + len(counts) == 4000
    if fraction >= 3:
        assert counts.max() > 6


def test_walk_without_convergence_is_an_error(spark):
    from minegrain.operators import graph as g

    edges = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (3, 1, 1.0), (1, 3, 1.0)], "src long, dst long, weight double")
    with pytest.raises(RuntimeError):
        g.pagerank(edges, tol=1e-9, min_iter=1, max_iter=2)
    assert g.pagerank(edges, tol=1e-9, min_iter=1).count() == 3


def test_lines_of_many_part_files_stay_in_order(spark, tmp_path):
    from minegrain.sources.readers import read_lines

    for i in (99_999, 100_000, 100_001):
        (tmp_path / f"part-{i:05d}-x.txt").write_text(f"{i}\n")
    lines = read_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [r.value for r in lines] == ["99999", "100000", "100001"]


def test_topic_ranks_are_not_broadcast(spark):
    """Ranks of every document and topic are far larger than Spark's estimate for them, which is that of the documents."""
    docs = spark.range(400).withColumnRenamed("id", "doc_id")
    ranks = docs.withColumn("topic", F.explode(F.array(*[F.lit(t) for t in (3, 5, 9)])))
    ranks = ranks.select("topic", F.col("doc_id").alias("id"), ((F.col("doc_id") % 7 + F.col("topic")) / 10).alias("rank"))
    ranks = ranks.filter("id % 5 <> topic")
    given = [(1, 1, 3, 0.5), (1, 1, 5, 0.25), (1, 1, 4, 0.25), (2, 1, 9, 1.0), (2, 2, 4, 1.0), (3, 1, 3, 0.0)]
    mix = spark.createDataFrame(given, "user_id bigint, query_id bigint, topic int, prob double")
    run = mix.select("user_id", "query_id").distinct().withColumn("doc_id", F.explode(F.sequence(F.lit(0), F.lit(399)).cast("array<bigint>")))
    mixed = graph.topic_weighted_sum(ranks, mix, run)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan
    want = {}
    for r in ranks.collect():
        for user, query, topic, prob in given:
            if topic == r["topic"] and prob:
                want[user, query, r["id"]] = want.get((user, query, r["id"]), 0.0) + prob * r["rank"]
    found = {(r["user_id"], r["query_id"], r["doc_id"]): r["rank"] for r in mixed.collect()}
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-12 for k in want)


def test_assignment_takes_only_terms_of_the_documents(spark, monkeypatch):
    """Centroids over a vocabulary far larger than the documents' are cut to their terms, with lengths over all of them."""
    docs = spark.createDataFrame([(1, 3, 1.0), (1, 8, 1.0), (2, 8, 2.0), (3, 9999, 1.0)], "doc_id bigint, term_id bigint, weight double")
    w = F.when((F.col("cluster") == 1) & F.col("term_id").isin(3, 8), 3.0).otherwise(F.when(F.col("cluster") == 0, 1.0).otherwise(0.5))
    centroids = spark.range(200).withColumnRenamed("id", "term_id").withColumn("cluster", F.explode(F.array(F.lit(0), F.lit(1), F.lit(4))))
    centroids = centroids.withColumn("w", w)
    wanted = {(r.doc_id, r.cluster) for r in cl._assign_ranges(cl.pack_documents(docs).checkpoint(), centroids.checkpoint()).collect()}
    monkeypatch.setattr(cl, "MAX_CENTROID_CELLS", 50)
    monkeypatch.setattr(cl, "_assign_ranges", None)
    assert {(r.doc_id, r.cluster) for r in cl.assign_cosine(docs, centroids).collect()} == wanted == {(1, 1), (2, 1), (3, 0)}
    strangers = docs.withColumn("term_id", F.col("term_id") + 50_000)
    assert {r.cluster for r in cl.assign_cosine(strangers, centroids).collect()} == {0}
    assert {(r.doc_id, r.cluster) for r in cl.assign_cosine(docs, centroids.union(centroids)).collect()} == wanted


def test_texts_move_before_they_are_words(spark, tmp_path):
    """Counts by document take one shuffle, of the texts; none of the far more bytes of documents' words."""
    from minegrain.plans import inputs as inp

    rows = [(1, "red fox, red hen"), (2, "fox"), (None, "red"), (2, "fox hen"), (3, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tf = inp.tf(spark, str(tmp_path))
    plan = tf._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(doc_id" in plan and ", term#" not in plan.split("hashpartitioning")[1].split(")")[0]
    found = sorted((r.doc_id or 0, r.term, r.tf) for r in tf.collect())
    assert found == [(0, "red", 1), (1, "fox", 1), (1, "hen", 1), (1, "red", 2), (2, "fox", 2), (2, "hen", 1)]


def test_sparse_products_are_listed(spark, monkeypatch):
    """Where the pairs of an inner key are few, they are rows; no tile moves, and the sums are those of the tiles."""
    rng = np.random.default_rng(5)
    m = np.where(rng.random((400, 300)) < 0.01, rng.integers(-3, 3, size=(400, 300)), 0).astype(float)
    with monkeypatch.context() as only:
        only.setattr(tiles, "_tile_pairs", None)
        found = {(r.left, r.right): r.value for r in tiled_product(cells(spark, m), block_rows=8).collect()}
    gram = m @ m.T
    assert found == {(i, j): gram[i, j] for i in range(400) for j in range(i + 1, 400) if gram[i, j] != 0}
    monkeypatch.setattr(tiles, "LISTED_ROWS", 1)  # a hot key goes through tiles
    assert {(r.left, r.right): r.value for r in tiled_product(cells(spark, m), block_rows=8).collect()} == found


def test_parts_of_order_lines_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Compressed columns of the parts seem far smaller to Spark than their rows are on the driver."""
    from minegrain.plans import inputs

    part = spark.createDataFrame([(1, "Brand#11"), (2, "Brand#22"), (None, "Brand#33")], "p_partkey bigint, p_brand string")
    orders = spark.createDataFrame([(7, 70, "1-URGENT"), (8, 80, None)], "o_orderkey bigint, o_custkey bigint, o_orderpriority string")
    lines = [(7, 1, 1.0), (7, 2, 2.0), (7, 2, 2.0), (8, 1, 3.0), (8, 3, 4.0), (9, 1, 5.0), (7, None, 6.0)]
    for name, df in (
        ("part", part.unionByName(part.limit(1))),
        ("orders", orders),
        ("lineitem", spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_extendedprice double")),
    ):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(inputs, "cut_lineage", kept)
    found = sorted(map(tuple, inputs.order_lines(spark, str(tmp_path)).collect()), key=str)
    assert "SortMergeJoin [doc_id" in plans[0] and "BroadcastHashJoin [doc_id" not in plans[0]
    one, two, unnamed = (1, 1.0, 70, 1, 11), (2, 2.0, 70, 1, 22), (1, 3.0, 80, None, 11)
    assert found == sorted([one, one, two, two, unnamed, unnamed], key=str)
