"""Regularised linear classifiers and regressors: training, prediction, cross-validation, choice of C, persistence.

Rows are (row_id, label, features array<double>), or (row_id, label, indices, values) with 1-based indices.
Two-class logistic models are MLlib's; the other losses use the shared trainer.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minegrain.functions.vectors import squared_norm
from minegrain.operators.evaluate import accuracy, mse_and_squared_correlation
from minegrain.operators.sampling import hashed_folds
from minegrain.operators.trainer import REGRESSION, JointProblem, Problem, design, minimise
from minegrain.runtime import check_driver_cells

# Most classes that are found from labels.
MAX_CLASSES = 10_000


@dataclass
class LinearModel:
    """Weights of one model per class, or one for two classes or regression; the last column is the bias feature's."""

    loss: str
    labels: list[float]  # the first of two labels is the positive one; empty for regression
    n_features: int
    bias: float
    weights: np.ndarray  # (models, n_features + 1 if bias >= 0)
    gap: np.ndarray | None = None  # after a fit with a kinked loss: how far objectives are above the optimum at most

    @property
    def two_class(self) -> bool:
        return len(self.labels) == 2 and len(self.weights) == 1

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """(class, feature, w): feature is 1-based, the bias feature being the last one."""
        m, width = self.weights.shape
        names = np.asarray(self.labels[:m] if self.labels else [0.0])
        cells = pd.DataFrame(
            {
                "class": np.repeat(names, width),
                "feature": np.tile(np.arange(1, width + 1), m),
                "w": self.weights.ravel(),
            }
        )
        return spark.createDataFrame(cells, "class double, feature int, w double")


def model_from_frame(
    weights: DataFrame, labels: list[float], n_features: int, loss: str = "logistic", bias: float = -1.0
) -> LinearModel:
    """Model from (class, feature, w) rows; absent cells are 0."""
    m = 1 if (len(labels) == 2 and loss != "crammer_singer") or not labels else len(labels)
    width = n_features + (bias >= 0)
    check_driver_cells(m * width, "the weight matrix")
    cells, w = weights.toPandas(), np.zeros((m, width))
    at = {c: i for i, c in enumerate(labels or [0.0])}
    w[cells["class"].map(at).to_numpy(), cells["feature"].to_numpy() - 1] = cells["w"].to_numpy()
    return LinearModel(loss, list(labels), n_features, bias, w)


def class_counts(rows: DataFrame, label: str = "label") -> DataFrame:
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def distinct_labels(rows: DataFrame) -> list[float]:
    """Labels ascending; more than MAX_CLASSES raise an error, as a continuous label would have."""
    found = rows.select("label").distinct().limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} different labels")
    return sorted(float(r[0]) for r in found)


def ordered_labels(rows: DataFrame) -> list[float]:
    """Labels ascending, but +1 before -1."""
    labels = distinct_labels(rows)
    return [1.0, -1.0] if labels == [-1.0, 1.0] else labels


def append_bias(rows: DataFrame, bias: float = 1.0) -> DataFrame:
    """Add a constant feature; a negative value adds none."""
    return rows if bias < 0 else rows.withColumn("features", F.concat("features", F.array(F.lit(float(bias)))))


def one_hot_labels(rows: DataFrame, classes: list[float] | None = None) -> DataFrame:
    if classes is None:
        classes = distinct_labels(rows)
    hot = F.transform(F.array(*[F.lit(c) for c in classes]), lambda c: (c == F.col("label")).cast("int"))
    return rows.withColumn("one_hot", hot)


def feature_count(rows: DataFrame) -> int:
    size = F.size("features") if "features" in rows.columns else F.array_max("indices")
    return int(rows.agg(F.max(size)).first()[0] or 0)


def _check(c: float, eps: float, p: float = 0.0) -> None:
    if eps <= 0:
        raise ValueError("eps must be positive")
    if c <= 0:
        raise ValueError("C must be positive")
    if p < 0:
        raise ValueError("p must not be negative")


def _columns(rows: DataFrame) -> list[str]:
    data = ["features"] if "features" in rows.columns else ["indices", "values"]
    return ["label", *data] + (["fold"] if "fold" in rows.columns else [])


def _tolerance(counts: dict[float, int], labels: list[float], eps: float, scale: np.ndarray) -> np.ndarray:
    """eps * min(positives, negatives) / rows of the gradient norm at 0, per model."""
    total = sum(counts.values())
    own = np.array([counts.get(c, 0) for c in labels]) if labels else np.array([total])
    smaller = np.maximum(np.minimum(own, total - own), 1) if labels else own
    return eps * smaller / total * scale


def _train(
    rows: DataFrame,
    loss: str,
    C: float,
    bias: float,
    eps: float,
    class_weight: dict[float, float] | None = None,
    l1: bool = False,
    p: float = 0.1,
    labels: list[float] | None = None,
    one_vs_rest: bool = False,
) -> LinearModel:
    _check(C, eps, p)
    rows = rows.select(*_columns(rows)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_features = feature_count(rows)
        if loss in REGRESSION:
            labels = []
        elif labels is None:
            labels = ordered_labels(rows)
        weight = class_weight or {}
        if loss == "crammer_singer":
            ascending = np.array(sorted(labels))
            cost = C * np.array([weight.get(c, 1.0) for c in ascending])
            joint = JointProblem(rows, n_features, ascending, cost, bias)
            w = minimise(joint).reshape(len(ascending), -1)
            return LinearModel(loss, list(ascending), n_features, bias, w, joint.gap)
        if not labels:
            one, rest, positive = np.array([C]), np.array([C]), np.array([0.0])
        elif len(labels) == 2 and not one_vs_rest:
            one, rest = (np.array([C * weight.get(c, 1.0)]) for c in labels)
            positive = np.array(labels[:1])
        else:  # a class weight counts on the positive side only
            one = C * np.array([weight.get(c, 1.0) for c in labels])
            rest, positive = np.full(len(labels), C), np.array(labels)
        problem = Problem(rows, n_features, loss, positive, one, rest, np.full(len(positive), -1), bias, p, l1)
        w = minimise(problem, tolerance=_start_tolerance(problem, rows, labels[: len(positive)], eps))
        return LinearModel(loss, list(labels), n_features, bias, w, problem.gap)
    finally:
        rows.unpersist()


def _start_tolerance(problem: Problem, rows: DataFrame, labels: list[float], eps: float) -> np.ndarray | None:
    if problem.loss in ("hinge", "eps"):
        return None
    counts = {float(r["label"]): r["n"] for r in class_counts(rows).collect()} if labels else {0.0: rows.count()}
    _, grad, _ = problem.evaluate(problem.start(), 1.0, False)
    scale = np.sqrt((grad * grad).sum(axis=1))
    return _tolerance(counts, labels, eps, np.maximum(scale, 1e-12))


def _mllib_rows(rows: DataFrame, labels: list[float], bias: float, class_weight: dict[float, float] | None) -> DataFrame:
    factor: Column = F.lit(1.0)
    for label, value in (class_weight or {}).items():
        factor = F.when(F.col("label") == label, F.lit(float(value))).otherwise(factor)
    prepared = append_bias(rows.select("label", "features"), bias)
    return prepared.select(
        (F.col("label") == labels[0]).cast("double").alias("label"),
        array_to_vector("features").alias("features"),
        factor.alias("weight"),
    )


def _logistic(rows: DataFrame, C: float, bias: float, eps: float, class_weight, l1: bool) -> LinearModel:
    """MLlib minimises the weighted mean loss, so its penalty factor is 1 / (C * sum of weights)."""
    _check(C, eps)
    labels = ordered_labels(rows)
    if len(labels) > 2 or "features" not in rows.columns:
        return _train(rows, "logistic", C, bias, eps, class_weight, l1, labels=labels)
    data = _mllib_rows(rows, labels, bias, class_weight).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = data.agg(F.sum("weight")).first()[0]
        common = {"regParam": 1.0 / (C * total), "standardization": False, "fitIntercept": False, "weightCol": "weight"}
        tol = min(eps, 1e-2) * 1e-6
        model = LogisticRegression(maxIter=300, tol=tol, elasticNetParam=float(l1), family="binomial", **common)
        w = model.fit(data).coefficients.toArray()
        return LinearModel("logistic", labels, len(w) - (bias >= 0), bias, w[None, :])
    finally:
        data.unpersist()


def linear_l2_logistic(rows, C=1.0, bias=-1.0, eps=0.01, class_weight=None) -> LinearModel:
    """min w.w / 2 + C sum ln(1 + exp(-y w.x))"""
    return _logistic(rows, C, bias, eps, class_weight, False)


def linear_l1_logistic(rows, C=1.0, bias=-1.0, eps=0.01, class_weight=None) -> LinearModel:
    """min |w|_1 + C sum ln(1 + exp(-y w.x))"""
    return _logistic(rows, C, bias, eps, class_weight, True)


def linear_l2_hinge(rows, C=1.0, bias=-1.0, eps=0.1, class_weight=None) -> LinearModel:
    """min w.w / 2 + C sum max(0, 1 - y w.x)"""
    return _train(rows, "hinge", C, bias, eps, class_weight)


def linear_l2_squared_hinge(rows, C=1.0, bias=-1.0, eps=0.01, class_weight=None) -> LinearModel:
    """min w.w / 2 + C sum max(0, 1 - y w.x)^2"""
    return _train(rows, "squared_hinge", C, bias, eps, class_weight)


def linear_l1_squared_hinge(rows, C=1.0, bias=-1.0, eps=0.01, class_weight=None) -> LinearModel:
    """min |w|_1 + C sum max(0, 1 - y w.x)^2"""
    return _train(rows, "squared_hinge", C, bias, eps, class_weight, l1=True)


def multiclass_crammer_singer(rows, C=1.0, bias=-1.0, eps=0.1, class_weight=None) -> LinearModel:
    """Joint multi-class hinge: one weight vector per class, also for two; C is that of the row's own class."""
    return _train(rows, "crammer_singer", C, bias, eps, class_weight)


def svr_squared_eps(rows, C=1.0, p=0.1, bias=-1.0, eps=0.001) -> LinearModel:
    """min w.w / 2 + C sum max(0, |y - w.x| - p)^2"""
    return _train(rows, "squared_eps", C, bias, eps, p=p)


def svr_eps(rows, C=1.0, p=0.1, bias=-1.0, eps=0.1) -> LinearModel:
    """min w.w / 2 + C sum max(0, |y - w.x| - p)"""
    return _train(rows, "eps", C, bias, eps, p=p)


def one_vs_rest(rows, loss: str = "squared_hinge", C=1.0, bias=-1.0, eps=0.01, class_weight=None) -> LinearModel:
    """One model per class, all trained in the same passes; exactly two classes need a single model."""
    return _train(rows, loss, C, bias, eps, class_weight)


def class_weights(rows: DataFrame, weights: dict[float, float]) -> DataFrame:
    """Rows with the factor of their class in column `weight` (1 for classes that are not named)."""
    factor: Column = F.lit(1.0)
    for label, value in weights.items():
        factor = F.when(F.col("label") == label, F.lit(float(value))).otherwise(factor)
    return rows.withColumn("weight", factor)


def objective_frame(
    rows: DataFrame, model: LinearModel, C: float = 1.0, p: float = 0.1, l1: bool = False
) -> DataFrame:
    """One row: penalty plus C times the summed loss of a two-class or regression model."""
    z, y = F.col("z"), F.when(F.col("label") == (model.labels or [0.0])[0], 1.0).otherwise(-1.0)
    over = F.greatest(F.abs(F.col("label") - z) - p, F.lit(0.0))
    short = F.greatest(1.0 - y * z, F.lit(0.0))
    term = {
        "logistic": F.log1p(F.exp(-F.abs(y * z))) + F.greatest(-y * z, F.lit(0.0)),
        "hinge": short,
        "squared_hinge": short * short,
        "eps": over,
        "squared_eps": over * over,
    }[model.loss]
    scored = rows.withColumn("z", _scores(rows, model)[0])
    w = model.weights
    penalty = np.abs(w).sum() if l1 else 0.5 * (w * w).sum()
    return scored.agg((F.lit(float(penalty)) + C * F.sum(term)).alias("objective"))


def objective(rows: DataFrame, model: LinearModel, C: float = 1.0, p: float = 0.1, l1: bool = False) -> float:
    return objective_frame(rows, model, C, p, l1).first()[0]


# --- prediction --------------------------------------------------------------------------------------------------

def _scores(rows: DataFrame, model: LinearModel) -> Column:
    """array<double> of decision values, from Arrow batches against the model's weights."""
    w, n_features, bias = model.weights, model.n_features, model.bias

    if "features" in rows.columns:

        @F.pandas_udf("array<double>")
        def score(features: pd.Series) -> pd.Series:
            return pd.Series(list(design(pd.DataFrame({"features": features}), n_features, bias) @ w.T))

        return score("features")

    @F.pandas_udf("array<double>")
    def score_sparse(indices: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series(list(design(pd.DataFrame({"indices": indices, "values": values}), n_features, bias) @ w.T))

    return score_sparse("indices", "values")


def _keys(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in ("features", "indices", "values")]


def decision_values(rows: DataFrame, model: LinearModel) -> DataFrame:
    """(row_id, class, value): w.x per model; features beyond the model are ignored."""
    names = model.labels[: len(model.weights)] or [0.0]
    classes = F.array(*[F.lit(float(c)) for c in names])
    pairs = F.zip_with(classes, "z", lambda c, v: F.struct(c.alias("class"), v.alias("value")))
    scored = rows.select("row_id", _scores(rows, model).alias("z"))
    return scored.select("row_id", F.inline(pairs))


def sparse_decision_values(cells: DataFrame, weights: DataFrame) -> DataFrame:
    """The same for long cells (row_id, feature, value) and weights (class, feature, w) that stay DataFrames."""
    products = cells.join(weights, "feature").groupBy("row_id", "class")
    return products.agg(F.sum(F.col("value") * F.col("w")).alias("value"))


def argmax_class(scores: DataFrame) -> DataFrame:
    """(row_id, class): the class of largest score, the lowest class on ties."""
    best = scores.groupBy("row_id").agg(F.max(F.struct("score", (-F.col("class")).alias("c"))).alias("b"))
    return best.select("row_id", (-F.col("b.c")).alias("class"))


def predict_label(rows: DataFrame, model: LinearModel) -> DataFrame:
    """Rows without their features plus `pred`: label by sign for two classes, else by largest value; regression value."""
    z = F.col("z")
    if not model.labels:
        pred = z[0]
    elif model.two_class:
        pred = F.when(z[0] > 0, F.lit(model.labels[0])).otherwise(F.lit(model.labels[1]))
    else:
        at = F.array_position(z, F.array_max(z)).cast("int")
        pred = F.element_at(F.array(*[F.lit(float(c)) for c in model.labels]), at)
    keep = _keys(rows)
    return rows.select(*keep, _scores(rows, model).alias("z")).select(*keep, pred.alias("pred"))


def predict_probability(rows: DataFrame, model: LinearModel) -> DataFrame:
    """(row_id, class, prob) for logistic models: complement for two classes, else divided by their sum."""
    if model.loss != "logistic":
        raise ValueError("probabilities exist for logistic models only")
    p = F.transform("z", lambda v: 1.0 / (1.0 + F.exp(-v)))
    if model.two_class:
        probs = F.array(p[0], 1.0 - p[0])
    else:
        probs = F.transform(p, lambda v: v / F.aggregate(p, F.lit(0.0), lambda a, x: a + x))
    entries = F.zip_with(
        F.array(*[F.lit(float(c)) for c in model.labels]), "p", lambda c, v: F.struct(c.alias("class"), v.alias("prob"))
    )
    scored = rows.select("row_id", _scores(rows, model).alias("z")).select("row_id", probs.alias("p"))
    return scored.select("row_id", F.inline(entries))


def model_coefficients(model: LinearModel, spark: SparkSession) -> DataFrame:
    """(feature, class, coef) for 1-based features; feature 0 is the bias term; the second of two labels is negated."""
    m, n = len(model.weights), model.n_features
    names = model.labels or [0.0]
    w = np.vstack([model.weights[0], -model.weights[0]]) if model.two_class else model.weights
    offset = model.bias * w[:, n] if model.bias > 0 else np.zeros(len(w))
    full = np.column_stack([offset, w[:, :n]])
    cells = pd.DataFrame(
        {
            "feature": np.tile(np.arange(n + 1), len(names)),
            "class": np.repeat(names, n + 1),
            "coef": full.ravel(),
        }
    )
    return spark.createDataFrame(cells, "feature int, class double, coef double")


def coefficient(model: LinearModel, feature: int, label: float | None = None) -> float:
    """One coefficient; 0 for a feature or label that the model does not have."""
    if not 1 <= feature <= model.n_features or (model.labels and label not in model.labels):
        return 0.0
    if not model.labels:
        return float(model.weights[0, feature - 1])
    at = model.labels.index(label)
    if model.two_class:
        return float(model.weights[0, feature - 1]) * (1 if at == 0 else -1)
    return float(model.weights[at, feature - 1])


# --- selection ---------------------------------------------------------------------------------------------------

def _fold_problem(rows: DataFrame, loss: str, costs: list[float], n: int, bias: float, labels: list[float], p: float) -> Problem:
    """Models for every (C, fold, class) in one problem."""
    positive = labels[:1] if len(labels) == 2 else labels or [0.0]
    grid = [(c, f, k) for c in costs for f in range(n) for k in positive]
    cost = np.array([g[0] for g in grid])
    return Problem(
        rows,
        feature_count(rows),
        loss,
        np.array([g[2] for g in grid]),
        cost,
        cost,
        np.array([g[1] for g in grid]),
        bias,
        p,
    )


def _out_of_fold(folded: DataFrame, w: np.ndarray, n: int, per_fold: int, labels: list[float], loss: str, problem) -> DataFrame:
    """Rows with the prediction of the model that did not see their fold, in column pred."""
    model = LinearModel(loss, labels, problem.n_features, problem.bias, w)
    z = F.slice("z", F.col("fold") * per_fold + 1, F.lit(per_fold))
    scored = folded.withColumn("z", _scores(folded, model)).withColumn("z", z)
    if not labels:
        pred = F.col("z")[0]
    elif len(labels) == 2:
        pred = F.when(F.col("z")[0] > 0, labels[0]).otherwise(labels[1])
    else:
        at = F.array_position("z", F.array_max("z")).cast("int")
        pred = F.element_at(F.array(*[F.lit(float(c)) for c in labels]), at)
    return scored.select("row_id", "label", "fold", pred.cast("double").alias("pred"))


def cross_validate(
    rows: DataFrame, loss: str = "squared_hinge", n: int = 5, C: float = 1.0, bias: float = -1.0, p: float = 0.1,
    eps: float = 0.01, seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """(predictions, metrics): out-of-fold prediction of every row, then accuracy, or mse and r2 for regression.

    The models of all folds and classes are trained together.
    """
    _check(C, eps, p)
    folded = rows if "fold" in rows.columns else hashed_folds(rows, n, seed)
    data = folded.persist(StorageLevel.MEMORY_AND_DISK)
    labels = [] if loss in REGRESSION else ordered_labels(data)
    if loss == "crammer_singer":
        ascending = sorted(labels)
        problem = JointProblem(
            data.select(*_columns(data)), feature_count(data), np.array(ascending), np.full(len(ascending), C), bias,
            held_out=np.arange(n),
        )
        w = minimise(problem).reshape(n * len(ascending), -1)
        labels, per_fold = ascending, len(ascending)
    else:
        problem = _fold_problem(data.select(*_columns(data)), loss, [C], n, bias, labels, p)
        w, per_fold = minimise(problem), problem.models // n
    pred = _out_of_fold(data, w, n, per_fold, labels, loss, problem)
    gold = pred.select("row_id", F.col("label").alias("gold"))
    if labels:
        metrics = pred.agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy"))
    else:
        metrics = mse_and_squared_correlation(pred, gold, "row_id")
    return pred, metrics


def start_c(rows: DataFrame, loss: str = "logistic") -> DataFrame:
    """One row: the power of two at or below 1 / (rows * largest squared norm), half of that for the squared hinge."""
    factor = {"logistic": 1.0, "squared_hinge": 2.0}[loss]
    values = "features" if "features" in rows.columns else "values"
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(squared_norm(values)).alias("m"))
    least = 1.0 / (factor * F.col("n") * F.col("m"))
    return size.select(F.pow(F.lit(2.0), F.floor(F.log2(least))).alias("c"))


def search_c(
    rows: DataFrame, loss: str = "logistic", n: int = 5, start: float | None = None, max_c: float = 1024.0,
    bias: float = -1.0, seed: int = 0,
) -> tuple[float, float, DataFrame]:
    """(best C, best rate, table (c, rate)): accuracy over folds for C doubling from a start value.

    All values of C and all folds are trained in the same passes; the smallest C of the best rate wins.
    """
    if loss not in ("logistic", "squared_hinge"):
        raise ValueError("C is searched for the logistic and squared hinge losses")
    data = hashed_folds(rows, n, seed).persist(StorageLevel.MEMORY_AND_DISK)
    labels = ordered_labels(data)
    c = start or start_c(data, loss).first()[0]
    grid = []
    while c <= max_c:
        grid.append(c)
        c *= 2.0
    table, width = [], (1 if len(labels) == 2 else len(labels)) * n
    per_pass = max(1, 40_000 // max(width * feature_count(data), 1))
    problem = warm = None
    for at in range(0, len(grid), per_pass):
        costs = grid[at : at + per_pass]
        problem = _fold_problem(data.select(*_columns(data)), loss, costs, n, bias, labels, 0.1)
        begin = None if warm is None else np.tile(warm, (len(costs), 1))
        w = minimise(problem, begin, max_passes=60)
        warm = w[-width:]
        hits = [
            _out_of_fold(data, w[i * width : (i + 1) * width], n, width // n, labels, loss, problem)
            .agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("rate"))
            .select(F.lit(float(cost)).alias("c"), "rate")
            for i, cost in enumerate(costs)
        ]
        for h in hits:
            table.append(tuple(h.first()))
    best = max(table, key=lambda r: (r[1], -r[0]))
    data.unpersist()
    return best[0], best[1], rows.sparkSession.createDataFrame(table, "c double, rate double")


# --- persistence -------------------------------------------------------------------------------------------------

def save_linear_model(model: LinearModel, spark: SparkSession, path: str) -> None:
    """Weights as parquet and one JSON row of metadata below `path`."""
    model.to_frame(spark).write.parquet(f"{path}/weights")
    meta = {"loss": model.loss, "labels": model.labels, "n_features": model.n_features, "bias": model.bias}
    spark.createDataFrame([(json.dumps(meta),)], "value string").write.text(f"{path}/meta")


def load_linear_model(spark: SparkSession, path: str) -> LinearModel:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return model_from_frame(
        spark.read.parquet(f"{path}/weights"), meta["labels"], meta["n_features"], meta["loss"], meta["bias"]
    )
