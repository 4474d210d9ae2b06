"""Optimality and invariants of trained models, splits, files."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from minegrain.operators import factors as fc
from minegrain.operators import linear as ln
from minegrain.operators import sampling as sm
from minegrain.operators import sga
from minegrain.operators import trainer as tr
from minegrain.runtime import scratch_path
from minegrain.sources import readers as rd
from minegrain.sources import writers as wr

C = 0.7


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(240, 6))
    z = x @ rng.normal(size=6) + 0.8 * rng.normal(size=240)
    return x, np.where(z > 0, 1.0, -1.0), np.digitize(z, [-1.5, 1.5]).astype(float), z


def rows(spark, x, y):
    return spark.createDataFrame(
        [(i, float(b), a.tolist()) for i, (a, b) in enumerate(zip(x, y))], "row_id long, label double, features array<double>"
    ).repartition(3)


@pytest.fixture(scope="module")
def two(spark, data):
    return rows(spark, data[0], data[1]).cache()


@pytest.fixture(scope="module")
def three(spark, data):
    return rows(spark, data[0], data[2]).cache()


@pytest.fixture(scope="module")
def numbers(spark, data):
    return rows(spark, data[0], data[3]).cache()


def logistic_gradient(x, y, w, c=C):
    return -c * (y / (1 + np.exp(y * (x @ w)))) @ x


def squared_hinge_gradient(x, y, w, c=C):
    return -2 * c * (y * np.maximum(0, 1 - y * (x @ w))) @ x


def sub_gradient(w, g):
    return np.where(w != 0, g + np.sign(w), np.sign(g) * np.maximum(np.abs(g) - 1, 0))


def test_l2_logistic(two, data):
    w = ln.linear_l2_logistic(two, C).weights[0]
    assert np.linalg.norm(w + logistic_gradient(data[0], data[1], w)) < 1e-4


def test_l1_logistic(two, data):
    w = ln.linear_l1_logistic(two, 0.05).weights[0]
    assert np.linalg.norm(sub_gradient(w, logistic_gradient(data[0], data[1], w, 0.05))) < 1e-4


def test_l2_squared_hinge(two, data):
    w = ln.linear_l2_squared_hinge(two, C, eps=1e-8).weights[0]
    assert np.linalg.norm(w + squared_hinge_gradient(data[0], data[1], w)) < 1e-6


def test_l1_squared_hinge(two, data):
    w = ln.linear_l1_squared_hinge(two, 0.02, eps=1e-8).weights[0]
    assert np.linalg.norm(sub_gradient(w, squared_hinge_gradient(data[0], data[1], w, 0.02))) < 1e-6


@pytest.mark.parametrize("l1", [False, True])
def test_many_features_take_the_quasi_newton_path(two, data, monkeypatch, l1):
    newton = ln._train(two, "squared_hinge", 0.1, -1.0, 1e-7, l1=l1).weights
    monkeypatch.setattr(tr, "NEWTON_LIMIT", 0)
    np.testing.assert_allclose(ln._train(two, "squared_hinge", 0.1, -1.0, 1e-7, l1=l1).weights, newton, atol=1e-4)


def nearby(f, w, n=300):
    rng = np.random.default_rng(1)
    best = f(w)
    return all(f(w + s * rng.normal(size=w.shape)) >= best - 2e-3 * abs(best) for s in (0.1, 0.01, 0.001) for _ in range(n // 3))


def test_hinge(two, data):
    x, y = data[:2]
    model = ln.linear_l2_hinge(two, C)
    f = lambda w: 0.5 * w @ w + C * np.maximum(0, 1 - y * (x @ w)).sum()
    assert nearby(f, model.weights[0])
    assert ln.objective(two, model, C) == pytest.approx(f(model.weights[0]))


def test_svr(numbers, data):
    x, z = data[0], data[3]
    w = ln.svr_squared_eps(numbers, C, p=0.2, eps=1e-9).weights[0]
    r = x @ w - z
    assert np.linalg.norm(w + 2 * C * (np.sign(r) * np.maximum(np.abs(r) - 0.2, 0)) @ x) < 1e-6
    f = lambda w: 0.5 * w @ w + C * np.maximum(0, np.abs(x @ w - z) - 0.2).sum()
    assert nearby(f, ln.svr_eps(numbers, C, p=0.2).weights[0])


def test_crammer_singer(three, data):
    x, own = data[0], data[2].astype(int)
    model = ln.multiclass_crammer_singer(three, C)

    def f(w):
        scores = x @ w.reshape(3, -1).T
        t = scores - scores[np.arange(len(x)), own][:, None] + 1.0
        t[np.arange(len(x)), own] = 0.0
        return 0.5 * (w * w).sum() + C * t.max(axis=1).sum()

    assert model.weights.shape == (3, 6) and nearby(f, model.weights.ravel())


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("fit", [ln.linear_l2_hinge, ln.svr_eps, ln.multiclass_crammer_singer])
def test_duality_gap_bounds_the_distance_from_the_optimum(two, three, numbers, data, monkeypatch, fit, limit):
    """On both solvers: the gap ends the fit, and no better weights lie further below the objective than it says."""
    from minegrain.operators import trainer

    x, kind = data[0], fit.__name__
    rows, y = {"linear_l2_hinge": (two, data[1]), "svr_eps": (numbers, data[3])}.get(kind, (three, data[2].astype(int)))

    def f(w):
        if kind == "linear_l2_hinge":
            loss = np.maximum(0, 1 - y * (x @ w[0]))
        elif kind == "svr_eps":
            loss = np.maximum(0, np.abs(x @ w[0] - y) - 0.1)
        else:
            t = x @ w.T - (x @ w.T)[np.arange(len(x)), y][:, None] + 1.0
            t[np.arange(len(x)), y] = 0.0
            loss = t.max(axis=1)
        return 0.5 * (w * w).sum() + C * loss.sum()

    tight = fit(rows, C)
    if limit is not None:
        monkeypatch.setattr(trainer, "NEWTON_LIMIT", limit)
    monkeypatch.setattr(trainer, "GAP", 0.01)
    loose = fit(rows, C)
    gap = float(loose.gap[0])
    assert 0 <= f(loose.weights) - f(tight.weights) + 1e-9 and f(loose.weights) - f(tight.weights) <= gap <= 0.01 * f(loose.weights)
    assert float(tight.gap[0]) <= 1e-4 * f(tight.weights)


def test_a_gap_that_stays_open_warns(two, monkeypatch):
    from minegrain.operators import trainer

    monkeypatch.setattr(trainer, "SMOOTHING", (0.5,))
    with pytest.warns(trainer.NotConverged):
        assert ln.linear_l2_hinge(two, C).gap[0] > 0


def test_one_vs_rest_equals_single_models(spark, three, data):
    model = ln.one_vs_rest(three, "squared_hinge", C, eps=1e-9)
    for i, label in enumerate(model.labels):
        w = model.weights[i]
        assert np.linalg.norm(w + squared_hinge_gradient(data[0], np.where(data[2] == label, 1.0, -1.0), w)) < 1e-6


def test_class_weights_scale_the_cost(two, data):
    x, y = data[:2]
    w = ln.linear_l2_squared_hinge(two, C, eps=1e-9, class_weight={1.0: 3.0}).weights[0]
    cost = np.where(y > 0, 3 * C, C)
    assert np.linalg.norm(w - 2 * (cost * y * np.maximum(0, 1 - y * (x @ w))) @ x) < 1e-6
    w = ln.linear_l2_logistic(two, C, class_weight={1.0: 3.0}).weights[0]
    assert np.linalg.norm(w - (cost * y / (1 + np.exp(y * (x @ w)))) @ x) < 1e-3


def test_cross_validation_matches_separate_fits(two, data):
    pred, metrics = ln.cross_validate(two, "squared_hinge", n=3, C=C)
    frame = pred.toPandas().set_index("row_id")
    assert len(frame) == 240 and metrics.first()[0] == pytest.approx((frame.pred == frame.label).mean())
    assert metrics.first()[0] > 0.8
    fold = sm.hashed_folds(two, 3)
    model = ln.linear_l2_squared_hinge(fold.filter("fold <> 1").drop("fold"), C, eps=1e-7)
    alone = ln.predict_label(fold.filter("fold = 1"), model).toPandas().set_index("row_id")
    assert (alone.pred == frame.pred[alone.index]).mean() > 0.98


def test_regression_cross_validation(numbers):
    _, metrics = ln.cross_validate(numbers, "squared_eps", n=4, C=1.0)
    assert metrics.first()["r2"] > 0.7


def test_crammer_singer_cross_validation(three):
    assert ln.cross_validate(three, "crammer_singer", n=3, C=C, bias=1.0)[1].first()[0] > 0.6


def test_search_c(two):
    best, rate, table = ln.search_c(two, "logistic", n=3)
    frame = table.toPandas()
    assert frame["c"].iloc[0] == ln.start_c(two, "logistic").first()[0] and frame["c"].iloc[-1] <= 1024
    assert rate == frame["rate"].max() and best == frame["c"][frame["rate"].idxmax()]
    with pytest.raises(ValueError):
        ln.search_c(two, "hinge")


def test_a_limit_on_passes_is_no_silent_end(two, recwarn):
    from minegrain.operators import trainer

    problem = trainer.Problem(two, 5, "squared_hinge", np.array([1.0]), np.array([1.0]), np.array([1.0]), np.array([-1]))
    with pytest.warns(trainer.NotConverged, match="after 1 passes"):
        trainer.minimise(problem, max_passes=1)
    recwarn.clear()
    trainer.minimise(problem)
    assert not [w for w in recwarn if w.category is trainer.NotConverged]


def test_arguments_are_checked(two):
    with pytest.raises(ValueError):
        ln.linear_l2_squared_hinge(two, C=0.0)
    with pytest.raises(ValueError):
        ln.linear_l2_squared_hinge(two, eps=0.0)
    with pytest.raises(ValueError):
        ln.svr_eps(two, p=-1.0)


def test_sparse_rows_and_bias(spark, two, data):
    dense = ln.linear_l2_squared_hinge(two, C, bias=1.0, eps=1e-8)
    sparse = two.select("row_id", "label", F.sequence(F.lit(1), F.lit(6)).alias("indices"), F.col("features").alias("values"))
    np.testing.assert_allclose(ln.linear_l2_squared_hinge(sparse, C, bias=1.0, eps=1e-8).weights, dense.weights, atol=1e-8)
    wide = sparse.withColumn("indices", F.concat("indices", F.array(F.lit(9)))).withColumn("values", F.concat("values", F.array(F.lit(5.0))))
    a = ln.decision_values(two, dense).toPandas().sort_values("row_id")["value"].to_numpy()
    b = ln.decision_values(wide, dense).toPandas().sort_values("row_id")["value"].to_numpy()
    np.testing.assert_allclose(a, b)
    assert ln.coefficient(dense, 1, -1.0) == -dense.weights[0, 0] and ln.coefficient(dense, 99, 1.0) == 0.0


def test_model_round_trip(spark, three):
    model = ln.one_vs_rest(three, "logistic", C, bias=1.0)
    path = scratch_path(spark, "model")
    ln.save_linear_model(model, spark, path)
    back = ln.load_linear_model(spark, path)
    assert (back.labels, back.loss, back.bias, back.n_features) == (model.labels, model.loss, model.bias, model.n_features)
    np.testing.assert_array_equal(back.weights, model.weights)
    p = ln.predict_probability(three, back).groupBy("row_id").agg(F.sum("prob").alias("s")).agg(F.min("s"), F.max("s")).first()
    assert p[0] == pytest.approx(1.0) and p[1] == pytest.approx(1.0)


def test_softmax_ascends(three):
    start = sga.LinearModel("softmax", [0.0, 1.0, 2.0], 6, -1.0, np.full((3, 6), 0.5))
    model = sga.softmax_sga(three, L=0.1, batch=60, eta0=0.02, epochs=3)
    assert sga.softmax_objective(three, model).first()[0] > sga.softmax_objective(three, start).first()[0]
    pred = sga.predict_hard_soft(three, model).toPandas()
    assert (pred.hard == pred.label).mean() > 0.5 and pred.soft.between(0, 2).all()


def test_binary_sga_single_rows(spark, data):
    """Batches of one row follow the row-at-a-time rule."""
    x, y = data[0][:12], (data[1][:12] > 0).astype(float)
    model = sga.binary_logreg_sga(rows(spark, x, y), batch=1, epochs=1)
    w, full = np.full(7, 0.5), np.column_stack([x, np.ones(12)])
    for t in range(12):
        w = w + 0.5 / np.sqrt(t + 1) * (y[t] - 1 / (1 + np.exp(-full[t] @ w))) * full[t]
    np.testing.assert_allclose(model.weights[0], w)


def ascend_softmax(x, y, classes, L, batch, eta0, epochs):
    w, t = np.full((len(classes), x.shape[1]), 0.5), 0
    for _ in range(epochs):
        for b in range(len(x) // batch):
            part, label = x[b * batch : (b + 1) * batch], y[b * batch : (b + 1) * batch]
            e = np.exp(part @ w.T)
            p = e / e.sum(axis=1, keepdims=True)
            t += 1
            w = w + eta0 / np.sqrt(t) * (((label[:, None] == np.asarray(classes)) - p).T @ part - L * w)
    return w


@pytest.mark.parametrize("tasks, batch, n", [(1, 50, 240), (3, 60, 240), (100, 5, 15)])
def test_tasks_in_step(spark, data, tasks, batch, n):
    """Any number of tasks takes the steps of a plain loop, also where a batch has fewer rows than there are tasks."""
    x, y = data[0][:n], data[2][:n]
    model = sga.softmax_sga(rows(spark, x, y), [0.0, 1.0, 2.0], L=0.1, batch=batch, eta0=0.02, epochs=2, tasks=tasks)
    np.testing.assert_allclose(model.weights, ascend_softmax(x, y, model.labels, 0.1, batch, 0.02, 2), atol=1e-12)


def test_large_batches_are_passes(spark, data, monkeypatch):
    """Batches of many cells take the same steps as passes of their own, and no task gets the rows of an epoch in a barrier."""
    x, y = data[0], data[2]
    monkeypatch.setattr(sga, "PASS_CELLS", 60 * x.shape[1])
    monkeypatch.setattr(sga, "BarrierTaskContext", None)
    model = sga.softmax_sga(rows(spark, x, y), [0.0, 1.0, 2.0], L=0.1, batch=60, eta0=0.02, epochs=3)
    np.testing.assert_allclose(model.weights, ascend_softmax(x, y, model.labels, 0.1, 60, 0.02, 3), atol=1e-12)
    two = rows(spark, x, (data[1] > 0).astype(float))
    curve = [tuple(r) for r in sga.learning_curve(two, two, every=3, batch=70, epochs=4).collect()]
    monkeypatch.undo()
    assert curve == [pytest.approx(tuple(r)) for r in sga.learning_curve(two, two, every=3, batch=70, epochs=4).collect()]


def test_sparse_rows_count_their_cells(spark, monkeypatch):
    """Tasks in step wait about a second for each batch: wide rows with few cells are not worth more than one."""
    worth = []
    count = sga._task_count
    monkeypatch.setattr(sga, "_task_count", lambda *a: worth.append(count(*a)) or worth[-1])
    given = [(i, float(i % 2), [i % 3 + 1, 400_000], [1.0, 0.5]) for i in range(40)] + [(40, 1.0, [], []), (41, 0.0, [], [])]
    sparse = spark.createDataFrame(given, "row_id bigint, label double, indices array<int>, values array<double>")
    monkeypatch.setattr(sga, "STEP_CELLS", 500)
    model = sga.softmax_sga(sparse, [0.0, 1.0], L=0.1, batch=21, epochs=1)
    assert worth == [1] and model.weights.shape == (2, 400_000)


def test_one_job_an_epoch(spark, three):
    """The number of Spark jobs follows the epochs, not the batches."""

    def jobs(batch, epochs):
        group = f"sga-{batch}-{epochs}"
        spark.sparkContext.setJobGroup(group, group)
        sga.softmax_sga(three, [0.0, 1.0, 2.0], batch=batch, epochs=epochs)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    jobs(60, 1)  # fills the cache
    few, many, longer = jobs(120, 1), jobs(3, 1), jobs(3, 4)
    assert few == many and longer == many + 3


def test_learning_curve_of_all_steps(spark, data):
    """Errors of one pass are those of the models that the same number of steps gives."""
    x, y = data[0], (data[1] > 0).astype(float)
    train, test = rows(spark, x[:200], y[:200]), rows(spark, x[200:], y[200:])
    curve = {r.step: r for r in sga.learning_curve(train, test, every=4, batch=10, epochs=1).collect()}
    assert sorted(curve) == [0, 4, 8, 12, 16]
    for step, r in curve.items():
        model = sga.binary_logreg_sga(train.filter(F.col("row_id") < 10 * (step + 1)), batch=10, epochs=1)
        z = np.column_stack([x, np.ones(len(x))]) @ model.weights[0]
        wrong = (z > 0) != y
        assert (r.train_err, r.test_err) == (pytest.approx(wrong[:200].mean()), pytest.approx(wrong[200:].mean()))


def test_ascent_edges(two, monkeypatch):
    with pytest.raises(ValueError, match="fewer rows"):
        sga.binary_logreg_sga(two.limit(0), batch=10)
    monkeypatch.setattr(ln, "MAX_CLASSES", 100)
    with pytest.raises(ValueError, match="different labels"):
        sga.softmax_sga(two.withColumn("label", F.col("row_id").cast("double")), batch=10, epochs=1)


def test_texts_by_language(spark, sf):
    """Words of the dictionary tell languages apart, for the softmax and for the squared hinge."""
    from minegrain.operators import text as tx
    from minegrain.plans import inputs as inp
    from minegrain.runtime import cut_lineage

    tf = cut_lineage(inp.tf(spark, sf))
    tf = tx.project_dictionary(tf, tx.topn_terms_df(tf, 200))
    labels = inp.lang_gold(spark, sf).withColumn("label", (F.col("label") == "en").cast("double"))
    docs = cut_lineage(tx.feature_rows(tf, labels))
    svm = ln.linear_l2_squared_hinge(docs, C=0.002, bias=1.0)
    hits = ln.predict_label(docs, svm).agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0]
    assert svm.n_features == 200 and hits > 0.9
    soft = sga.predict_hard_soft(docs, sga.softmax_sga(docs, L=1.0, batch=100, eta0=0.0005, epochs=2))
    assert soft.agg(F.avg((F.col("hard") == F.col("label")).cast("double"))).first()[0] > 0.8


def test_splits(two):
    train, held = sm.holdout_split(two, 0.3, seed=2)
    ids = {r.row_id for r in train.collect()}
    drawn = [r.row_id for r in held.collect()]
    assert not ids & set(drawn) and ids | set(drawn) == set(range(240)) and 40 < len(drawn) < 110
    again = sm.holdout_split(two.repartition(5), 0.3, seed=2)[0]
    assert ids == {r.row_id for r in again.collect()}
    sizes = [r["count"] for r in sm.cv_folds(two, 7).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [240 * (f + 1) // 7 - 240 * f // 7 for f in range(7)]
    batches = sm.minibatches(two, 50).groupBy("batch_id").count().collect()
    assert sorted((r.batch_id, r["count"]) for r in batches) == [(b, 50) for b in range(4)]


def test_pmf_follows_gradient_descent(spark):
    rng = np.random.default_rng(7)
    m = np.where(rng.random((14, 9)) < 0.5, rng.integers(1, 6, (14, 9)), 0).astype(float)
    m[13, 8] = 5.0
    ratings = spark.createDataFrame([(int(a), int(b), float(m[a, b])) for a, b in np.argwhere(m)], "user_id long, item_id long, rating double")
    u, v = rng.random((14, 3)), rng.random((9, 3))
    start = tuple(spark.createDataFrame([(i, f.tolist()) for i, f in enumerate(side)], "id long, f array<double>") for side in (u, v))
    model = fc.pmf_fit(ratings, 3, step=0.02, max_iter=8, start=start)
    mask, centred = m > 0, np.where(m > 0, m - 3, 0.0)
    s2, step, loss = centred.var(), 0.02, np.inf
    for i in range(1, 8):
        e = mask * (centred - u @ v.T)
        nu = u - step * (u / u.var() - e @ v / s2)
        nv = v - step * (v / v.var() - e.T @ u / s2)
        e = mask * (centred - nu @ nv.T)
        new = (e**2).sum() / (2 * s2) + np.linalg.norm(nu, axis=1).sum() / (2 * nu.var()) + np.linalg.norm(nv, axis=1).sum() / (2 * nv.var())
        assert model.history[i - 1][1] == pytest.approx(new)
        if new > loss:
            step /= 1.25
        else:
            u, v, loss = nu, nv, new
    found = np.array([r.f for r in model.users.orderBy("id").collect()])
    np.testing.assert_allclose(found, u, atol=1e-9)
    accepted = [h[1] for h in model.history if h[3]]
    assert accepted == sorted(accepted, reverse=True)


def test_step_control():
    """Steps and ends from losses alone."""
    control = fc.StepControl(1.0, min_trials=4, max_trials=50, growth=2)
    assert not control.ended
    assert control.judge(100.0) and control.step == 1.0  # the first trial has nothing to be compared with
    assert control.judge(90.0) and control.step == 1.25  # second: grows
    assert not control.judge(91.0) and control.step == 1.0  # refused: shrinks, and keeps the best
    assert control.best == 90.0 and control.trials == 4 and not control.ended
    assert control.judge(90.0 * (1 - 1e-6)) and control.step == 1.25
    assert control.converged and control.ended
    assert [h[3] for h in control.history] == [True, True, False, True] and [h[2] for h in control.history] == [1.0, 1.0, 1.25, 1.0]
    worse = fc.StepControl(1.0, min_trials=2, max_trials=4)
    for loss in (5.0, float("inf"), float("nan")):
        assert not worse.ended
        worse.judge(loss)
    assert worse.ended and not worse.converged and worse.step == pytest.approx(0.64)


def _pmf_ratings(spark, hot=False, scale=1):
    rng = np.random.default_rng(5)
    cells = {(int(u), int(i)) for u, i in rng.integers(0, (60, 40), (700, 2))} | ({(3, i) for i in range(40)} if hot else set())
    rows = [(u * scale, i * scale + 7 * (scale > 1), float(1 + (u * 7 + i * 3) % 5)) for u, i in sorted(cells)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


@pytest.mark.parametrize("block_ids, tile", [(1 << 15, (10_000, 500_000)), (8, (20, 30))])
def test_pmf_gradient_over_many_tiles(spark, monkeypatch, block_ids, tile):
    monkeypatch.setattr(fc, "BLOCK_IDS", block_ids)
    monkeypatch.setattr(fc, "TILE_RATINGS", tile)
    ratings, rng = _pmf_ratings(spark, hot=True), np.random.default_rng(1)
    u, v = rng.random((60, 3)), rng.random((40, 3))
    users, items = (spark.createDataFrame([(i, f.tolist()) for i, f in enumerate(x)], "id long, f array<double>") for x in (u, v))
    du, dv = fc.pmf_gradient(ratings, users, items, 0.7)
    e = np.zeros((60, 40))
    for r in ratings.collect():
        e[r.user_id, r.item_id] = r.rating - 3 - u[r.user_id] @ v[r.item_id]
    for d, expected in ((du, u / u.var() - e @ v / 0.7), (dv, v / v.var() - e.T @ u / 0.7)):
        np.testing.assert_allclose(np.array([r.f for r in d.orderBy("id").collect()]), expected, atol=1e-9)


def test_tiles_do_not_move(spark, monkeypatch):
    """No exchange between the scan of the tiles and the step that uses them, with and without broadcasts."""
    monkeypatch.setattr(fc, "TILE_RATINGS", (20, 30))
    ratings = _pmf_ratings(spark)
    start = [fc.seeded_factors(spark.range(n), 2, 1) for n in (60, 40)]
    for threshold in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            problem = fc._Problem(ratings, *start, 2)
            plan = problem.gradient_blocks(problem.pack(*start))._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        lines = plan.split("\n")
        scan = next(i for i, x in enumerate(lines) if "pmf_tiles" in x and "Scan" in x)
        depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
        above, at = [], depth(lines[scan])
        for x in reversed(lines[:scan]):
            if depth(x) < at:
                above.append(x)
                at = depth(x)
            if "CoGroup" in x:
                break
        assert any("CoGroup" in x for x in above) and not any("Exchange" in x for x in above), plan
        problem.close()


def test_factors_of_large_ids(spark):
    """Ids of 10^15 with factors for those that occur, fitted like their small counterparts."""
    scale = 10**13
    big, small = _pmf_ratings(spark, scale=scale), _pmf_ratings(spark)
    users = small.select("user_id").distinct().toPandas()["user_id"].tolist()
    items = small.select("item_id").distinct().toPandas()["item_id"].tolist()
    rng = np.random.default_rng(2)
    starts = []
    for k, shift in ((1, 0), (scale, 7)):
        rng = np.random.default_rng(2)
        sides = [[(int(i) * k + shift * side, rng.random(2).tolist()) for i in sorted(ids)] for side, ids in enumerate((users, items))]
        starts.append(tuple(spark.createDataFrame(x, "id long, f array<double>") for x in sides))
    a = fc.pmf_fit(small, 2, step=1e-3, max_iter=4, start=starts[0])
    b = fc.pmf_fit(big, 2, step=1e-3, max_iter=4, start=starts[1])
    assert not a.converged and a.users.count() == b.users.count() == len(users)
    seen = fc.pmf_fit(big, 2, step=1e-3, max_iter=3, dense=False)
    assert {r.id for r in seen.items.collect()} == {r.item_id for r in big.collect()}
    assert all(h[1] > 0 for h in seen.history)

@pytest.mark.parametrize("hot", [False, True])
def test_pmf_in_one_task_and_on_tiles(spark, monkeypatch, hot):
    """A small fit runs in one task, with the losses and factors of the fit on tiles."""
    ratings = _pmf_ratings(spark, hot=hot)
    one = fc.pmf_fit(ratings, 3, step=0.01, max_iter=12, seed=2)
    monkeypatch.setattr(fc, "ONE_TASK", (0, 0, 0))
    monkeypatch.setattr(fc, "TILE_RATINGS", (20, 30))
    monkeypatch.setattr(fc, "CHUNK_RATINGS", 7)
    tiles = fc.pmf_fit(ratings, 3, step=0.01, max_iter=12, seed=2)
    assert one.iterations == tiles.iterations == 12 and [h[3] for h in one.history] == [h[3] for h in tiles.history]
    np.testing.assert_allclose([h[1:3] for h in one.history], [h[1:3] for h in tiles.history])
    for a, b in ((one.users, tiles.users), (one.items, tiles.items)):
        a, b = ([r.f for r in x.orderBy("id").collect()] for x in (a, b))
        np.testing.assert_allclose(a, b, atol=1e-9)


def test_pmf_queries_are_the_whole_job(spark, monkeypatch):
    """Fits of the queries end by their rule or at 300, and the sweep has all five numbers of factors."""
    from minegrain.plans import factor_queries as fq

    pairs = spark.createDataFrame([(7, 1, 2, 4.0), (8, 5, 6, 2.0)], "pair_id long, user_id long, item_id long, gold double")
    monkeypatch.setattr(fq.inp, "train", lambda spark, sf: _pmf_ratings(spark))
    monkeypatch.setattr(fq.inp, "pairs", lambda spark, sf: pairs)
    fits, fit = [], fc.pmf_fit
    monkeypatch.setattr(fc, "pmf_fit", lambda *a, **k: fits.append(fit(*a, **k)) or fits[-1])
    assert fq.pmf_fit(spark, "").count() == 100
    rows = fq.pmf_sweep(spark, "").orderBy("dim").collect()
    assert [r.dim for r in rows] == [2, 5, 10, 20, 50]
    ends = [(m.converged, m.iterations) for m in fits] + [(r.converged, r.iterations) for r in rows]
    assert all(converged or n == 300 for converged, n in ends) and ends[0][1] > 31


def test_pmf_refuses_null_ratings(spark):
    """As on tiles: a null rating ends the fit, which would otherwise give back its start."""
    ratings = _pmf_ratings(spark).withColumn("rating", F.when(F.col("user_id") != 3, F.col("rating")))
    with pytest.raises(Exception, match="a rating is null"):
        fc.pmf_fit(ratings, 2, max_iter=3)


def test_pmf_tiles_stream_past_a_chunk(spark, monkeypatch):
    """Every rating is in one chunk of its tile, none larger than a chunk, at the place of its ids in the tile's blocks."""
    monkeypatch.setattr(fc, "TILE_RATINGS", (200, 300))
    monkeypatch.setattr(fc, "CHUNK_RATINGS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        ratings = _pmf_ratings(spark, hot=True)
        start = [fc.seeded_factors(spark.range(n), 2, 1) for n in (60, 40)]
        problem = fc._Problem(ratings, *start, 2)
        point = problem.pack(*start)
        ids = {(r.side, r.block): r.ids for r in point.blocks.collect()}
        found, parts = [], {}
        for t in problem.tiles.collect():
            assert len(t.ratings) <= 50
            parts.setdefault(t.tile, []).append(t.part)
            found += [(ids[0, t.ublock][a], ids[1, t.iblock][b], r + 3) for a, b, r in zip(t.users, t.items, t.ratings)]
        problem.close()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(found) == sorted(map(tuple, ratings.collect()))
    assert all(sorted(p) == list(range(len(p))) for p in parts.values()) and max(map(len, parts.values())) > 1


def test_pmf_steps_do_not_multiply_estimates(spark, capsys):
    """The estimated size of the factors is that of stored files after any number of steps, not a product over all steps."""
    ratings = _pmf_ratings(spark)
    for steps in (3, 9):
        model = fc.pmf_fit(ratings, 2, step=1e-3, max_iter=steps)
        capsys.readouterr()
        model.users.explain(mode="cost")
        shown = capsys.readouterr().out
        assert "sizeInBytes" in shown and "EiB" not in shown and "E+" not in shown


def test_factor_blocks_move_in_proportion(monkeypatch):
    """On 12 cores, 60 and 360 times sf0.1 (900,000 users at 60) have each factor in some four tiles or less."""
    for scale in (60, 360):
        users, items = 15_000 * scale, 20_000 * scale
        nu, ni = fc.tile_grid(540_000 * scale, users, items, 12, 5)
        assert users * ni + items * nu <= 4 * (users + items)
        assert nu * ni >= 12


@pytest.mark.parametrize("chunk", [500_000, 7])
def test_tiles_in_rows_of_bounded_size(spark, monkeypatch, chunk):
    monkeypatch.setattr(fc, "CHUNK_RATINGS", chunk)
    ratings, start = _pmf_ratings(spark), [fc.seeded_factors(spark.range(n), 2, 1) for n in (60, 40)]
    problem = fc._Problem(ratings, *start, 2)
    assert max(r.n for r in problem.tiles.selectExpr("size(ratings) as n").collect()) <= chunk
    _, squares = problem.evaluate(problem.pack(*start))
    u, v = ({r.id: np.array(r.f) for r in side.collect()} for side in start)
    expected = sum((r.rating - 3 - u[r.user_id] @ v[r.item_id]) ** 2 for r in ratings.collect())
    assert squares == pytest.approx(expected)
    problem.close()


def test_line_numbers_over_files(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"part-{n}").write_text("".join(f"{n} {i}\n" for i in range(50 * (n + 1))))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        lines = rd.read_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.line_no, r.value) for r in lines] == list(enumerate(f"{n} {i}" for n in range(3) for i in range(50 * (n + 1))))


@pytest.mark.parametrize("line", ["1 2:1 1:3", "1 0:1", "x 1:2", "1 1:", "1 1", "1 a:2", "1 2:1 2:1"])
def test_malformed_libsvm(spark, tmp_path, line):
    (tmp_path / "bad").write_text("1 1:0.5\n" + line + "\n")
    with pytest.raises(Exception, match="wrong input format at line 2"):
        rd.read_libsvm(spark, str(tmp_path / "bad")).collect()


def test_libsvm_rows(spark, tmp_path):
    (tmp_path / "ok").write_text("+1 1:0.5 3:-2\n-1\n")
    out = rd.read_libsvm(spark, str(tmp_path / "ok"))
    assert [tuple(r) for r in out.orderBy("row_id").collect()] == [(0, 1.0, [1, 3], [0.5, -2.0]), (1, -1.0, [], [])]
    assert rd.libsvm_dimension(out) == 3
    path = os.path.join(str(tmp_path), "again")
    wr.write_libsvm(out, path)
    assert [r.value for r in rd.read_lines(spark, path).orderBy("line_no").collect()] == ["1.0 1:0.5 3:-2.0", "-1.0"]


def test_run_file_names(spark, tmp_path):
    (tmp_path / "2-1.results.txt").write_text("0 Q0 15 1 -3.5 run\n0 Q0 16 2 -4.5 run\n")
    out = [tuple(r) for r in rd.read_run_files(spark, str(tmp_path)).orderBy("rank").collect()]
    assert out == [(2, 1, 15, 1, -3.5), (2, 1, 16, 2, -4.5)]


def sparse(spark, cells, labels):
    """Rows (row_id, label, indices, values), indices from 1."""
    rows = [(i, float(labels[i]), [int(c) + 1 for c in index], [float(v) for v in value]) for i, (index, value) in enumerate(cells)]
    return spark.createDataFrame(rows, "row_id long, label double, indices array<int>, values array<double>")


def test_sparse_rows_equal_dense_rows(spark):
    rng = np.random.default_rng(8)
    x = np.where(rng.random((120, 15)) < 0.3, rng.normal(size=(120, 15)), 0.0)
    y = np.where(x @ rng.normal(size=15) > 0, 1.0, -1.0)
    thin = sparse(spark, [(np.flatnonzero(r), r[np.flatnonzero(r)]) for r in x], y)
    dense = spark.createDataFrame([(i, float(y[i]), x[i].tolist()) for i in range(120)], "row_id long, label double, features array<double>")
    for fit in (ln.linear_l2_squared_hinge, ln.linear_l2_hinge):
        a, b = fit(thin, bias=1.0, eps=1e-4), fit(dense, bias=1.0, eps=1e-4)
        np.testing.assert_allclose(a.weights, b.weights, atol=1e-6)
        one = {r.row_id: r.value for r in ln.decision_values(thin, a).collect()}
        two = {r.row_id: r.value for r in ln.decision_values(dense, b).collect()}
        assert one == {k: pytest.approx(v, abs=1e-5) for k, v in two.items()}


def test_a_million_features_stay_sparse(spark):
    rng = np.random.default_rng(9)
    width, n = 1_000_000, 4000
    y = np.where(rng.random(n) < 0.5, 1.0, -1.0)
    cells = [
        (np.unique(np.append(rng.integers(10, width - 1, 6), [0 if y[i] > 0 else 1] + ([width - 1] if i == 0 else []))),) for i in range(n)
    ]
    cells = [(c[0], np.ones(len(c[0]))) for c in cells]
    rows = sparse(spark, cells, y)
    model = ln.linear_l2_squared_hinge(rows)
    assert model.n_features == width
    hits = ln.predict_label(rows, model).filter("pred = label").count()
    assert hits > 0.99 * n
