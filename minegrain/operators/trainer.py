"""Shared trainer: one Spark pass evaluates loss, gradient and curvature of many linear models at once.

Each task sums over its own rows against broadcast weights; Spark adds the partial sums up in chunks; the driver holds only
state of model size. All classes, folds and values of C of one problem ride in the same pass. Few wide parameters take
Newton steps (a handful of passes), many take limited-memory quasi-Newton steps.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minegrain.runtime import check_driver_cells

_CHUNK = 8192
_ROWS_PER_LOT = 2048
NEWTON_LIMIT = 800
CURVATURE_CELLS = 4_000_000
SMOOTHING = (0.5, 0.1, 0.02, 0.004, 0.001, 0.00025, 0.00006, 0.000015)
# Largest duality gap, as a share of the objective, at which a fit with a kinked loss ends.
GAP = 1e-4

Evaluation = tuple[np.ndarray, np.ndarray, np.ndarray | None]


def add_up(rows: DataFrame, partial: Callable[[Iterator[pd.DataFrame]], np.ndarray]) -> np.ndarray:
    """Sum of one vector per task, added by Spark chunk by chunk; None from a task counts as zero."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = partial(batches)
        if total is not None:
            starts = range(0, len(total), _CHUNK)
            yield pd.DataFrame({"chunk": range(len(starts)), "v": [total[s : s + _CHUNK] for s in starts]})

    parts = rows.mapInPandas(run, "chunk int, v array<double>")
    summed = parts.groupBy("chunk").agg(Summarizer.sum(array_to_vector("v")).alias("v"))
    chunks = summed.select("chunk", vector_to_array("v").alias("v")).collect()
    if not chunks:
        raise ValueError("no rows to train on")
    return np.concatenate([np.asarray(c["v"]) for c in sorted(chunks, key=lambda c: c["chunk"])])


class SparseRows:
    """Rows of a lot as the cells they have. Stands on the left of `@` for scores and on the right for gradients."""

    __array_ufunc__ = None  # so that numpy hands a @ rows over

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, shape: tuple[int, int]) -> None:
        self.row, self.column, self.value, self.shape = row, column, value, shape

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        n = self.shape[0]
        return np.stack([np.bincount(self.row, self.value * c[self.column], n) for c in w.T], axis=1)

    def __rmatmul__(self, a: np.ndarray) -> np.ndarray:
        width = self.shape[1]
        return np.stack([np.bincount(self.column, self.value * r[self.row], width) for r in a])

    def dense(self) -> np.ndarray:
        x = np.zeros(self.shape)
        np.add.at(x, (self.row, self.column), self.value)
        return x


def design(pdf: pd.DataFrame, n_features: int, bias: float, dense: bool = False) -> np.ndarray | SparseRows:
    """The rows of one lot; features beyond the model are ignored.

    Rows with `features` are a dense matrix. Rows with 1-based `indices` and `values` stay sparse unless `dense` is asked
    for, as curvatures do, which only narrow models have.
    """
    width = n_features + (bias >= 0)
    if "features" in pdf:
        x = np.zeros((len(pdf), width))
        for i, f in enumerate(pdf["features"]):
            x[i, : min(len(f), n_features)] = f[:n_features]
        if bias >= 0:
            x[:, n_features] = bias
        return x
    row = np.repeat(np.arange(len(pdf)), pdf["indices"].map(len).to_numpy(np.int64))
    column = np.concatenate([np.zeros(0, np.int64), *[np.asarray(i, np.int64) for i in pdf["indices"]]]) - 1
    value = np.concatenate([np.zeros(0), *[np.asarray(v, float) for v in pdf["values"]]])
    inside = column < n_features
    row, column, value = row[inside], column[inside], value[inside]
    if bias >= 0:
        row = np.concatenate([row, np.arange(len(pdf))])
        column = np.concatenate([column, np.full(len(pdf), n_features)])
        value = np.concatenate([value, np.full(len(pdf), float(bias))])
    x = SparseRows(row, column, value, (len(pdf), width))
    return x.dense() if dense else x


def lots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for start in range(0, len(pdf), _ROWS_PER_LOT):
            yield pdf.iloc[start : start + _ROWS_PER_LOT]


def log_sigmoid_loss(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    p = 0.5 * (1.0 + np.tanh(-0.5 * y * z))  # probability of the wrong side
    return np.logaddexp(0.0, -y * z), -y * p, p * (1.0 - p)


def _ramp(t: np.ndarray, mu: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """max(0, t) with the kink smoothed over a width of mu: mu ln(1 + exp(t / mu))."""
    share = 0.5 * (1.0 + np.tanh(t / (2.0 * mu)))
    return mu * np.logaddexp(0.0, t / mu), share, share * (1.0 - share) / mu


def _square(t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """max(0, t) squared."""
    up = np.maximum(t, 0.0)
    return up * up, 2.0 * up, 2.0 * (t > 0)


def loss_terms(loss: str, z: np.ndarray, y: np.ndarray, p: float, mu: float):
    """Value, slope and curvature in z of a row's loss; y is -1/+1 for classes and the target for regression."""
    if loss == "logistic":
        return log_sigmoid_loss(z, y)
    if loss in ("squared_hinge", "hinge"):
        value, slope, bend = _square(1.0 - y * z) if loss == "squared_hinge" else _ramp(1.0 - y * z, mu)
        return value, -y * slope, bend
    # Above and below the tube, each with its own one-sided loss.
    over, under = (_square(z - y - p), _square(y - z - p)) if loss == "squared_eps" else (_ramp(z - y - p, mu), _ramp(y - z - p, mu))
    return over[0] + under[0], over[1] - under[1], over[2] + under[2]


def bound_terms(loss: str, z: np.ndarray, y: np.ndarray, p: float, slope: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The loss itself, and the height at z = 0 of its lower bound of the given slope (within the loss's own slopes)."""
    if loss == "hinge":
        return np.maximum(1.0 - y * z, 0.0), -y * slope
    return np.maximum(np.abs(z - y) - p, 0.0), -slope * y - p * np.abs(slope)


SMOOTHED = ("hinge", "eps", "crammer_singer")
REGRESSION = ("squared_eps", "eps")


@dataclass
class Problem:
    """Independent models over the same rows: model m separates `positive[m]` from the rest, skips rows of fold
    `held_out[m]` (-1: none) and weighs rows by cost[m] (cost_rest[m] on the other side)."""

    rows: DataFrame  # label, features (or indices, values), optional fold
    n_features: int
    loss: str
    positive: np.ndarray
    cost: np.ndarray
    cost_rest: np.ndarray
    held_out: np.ndarray
    bias: float = -1.0
    p: float = 0.1
    l1: bool = False
    gap: np.ndarray | None = None  # of a fit with a kinked loss: objective minus dual objective, per model

    @property
    def width(self) -> int:
        return self.n_features + (self.bias >= 0)

    @property
    def models(self) -> int:
        return len(self.positive)

    def start(self) -> np.ndarray:
        return np.zeros((self.models, self.width))

    def second_order(self) -> bool:
        return self.width <= NEWTON_LIMIT and self.models * self.width**2 <= CURVATURE_CELLS

    def evaluate(self, w: np.ndarray, mu: float, curvature: bool) -> Evaluation:
        return _split(self._sums(w, mu, curvature), *w.shape, curvature)

    def certificate(self, w: np.ndarray, mu: float) -> tuple[np.ndarray, np.ndarray]:
        return _bounds(self._sums(w, mu, False, True), w)

    def _sums(self, w: np.ndarray, mu: float, curvature: bool, certify: bool = False) -> np.ndarray:
        """Value, gradient and curvature in a row; to certify, values without smoothing, gradient and heights of bounds."""
        m, width = w.shape
        loss, p, n_features, bias = self.loss, self.p, self.n_features, self.bias
        positive, cost, rest, held = self.positive, self.cost, self.cost_rest, self.held_out
        sent = self.rows.sparkSession.sparkContext.broadcast(w)

        def partial(batches: Iterator[pd.DataFrame]) -> np.ndarray | None:
            value, grad, height = np.zeros(m), np.zeros((m, width)), np.zeros(m)
            hess = np.zeros((m, width, width)) if curvature else None
            for pdf in lots(batches):
                x, label = design(pdf, n_features, bias, curvature), pdf["label"].to_numpy()[:, None]
                if loss in REGRESSION:
                    y, c = np.broadcast_to(label, (len(pdf), m)), np.broadcast_to(cost, (len(pdf), m))
                else:
                    own = label == positive[None, :]
                    y, c = np.where(own, 1.0, -1.0), np.where(own, cost, rest)
                if "fold" in pdf:
                    c = np.where(pdf["fold"].to_numpy()[:, None] == held[None, :], 0.0, c)
                z = x @ sent.value.T
                v, slope, bend = loss_terms(loss, z, y, p, mu)
                if certify:
                    v, above = bound_terms(loss, z, y, p, slope)
                    height += (c * above).sum(axis=0)
                value += (c * v).sum(axis=0)
                grad += (c * slope).T @ x
                if curvature:
                    for j in range(m):
                        hess[j] += (x * (c[:, j] * bend[:, j])[:, None]).T @ x
            return np.concatenate([value, grad.ravel(), *([hess.ravel()] if curvature else []), *([height] if certify else [])])

        total = add_up(self.rows, partial)
        sent.unpersist()
        return total


@dataclass
class JointProblem:
    """Multi-class hinge max over classes of (1[m != y] + z_m - z_y): one model of classes x features."""

    rows: DataFrame
    n_features: int
    labels: np.ndarray
    cost: np.ndarray  # per class, taken by the row's own class
    bias: float = -1.0
    loss: str = "crammer_singer"
    l1: bool = False
    held_out: np.ndarray = field(default_factory=lambda: np.array([-1]))
    gap: np.ndarray | None = None

    @property
    def width(self) -> int:
        return len(self.labels) * (self.n_features + (self.bias >= 0))

    @property
    def models(self) -> int:
        return len(self.held_out)

    def start(self) -> np.ndarray:
        return np.zeros((self.models, self.width))

    def second_order(self) -> bool:
        return self.width <= NEWTON_LIMIT and self.models * self.width**2 <= CURVATURE_CELLS

    def evaluate(self, w: np.ndarray, mu: float, curvature: bool) -> Evaluation:
        return _split(self._sums(w, mu, curvature), *w.shape, curvature)

    def certificate(self, w: np.ndarray, mu: float) -> tuple[np.ndarray, np.ndarray]:
        return _bounds(self._sums(w, mu, False, True), w)

    def _sums(self, w: np.ndarray, mu: float, curvature: bool, certify: bool = False) -> np.ndarray:
        """As for separate models."""
        g, k, width = self.models, len(self.labels), self.width
        n_features, bias, labels, cost, held = self.n_features, self.bias, self.labels, self.cost, self.held_out
        sent = self.rows.sparkSession.sparkContext.broadcast(w.reshape(g, k, -1))

        def partial(batches: Iterator[pd.DataFrame]) -> np.ndarray | None:
            f = sent.value.shape[2]
            value, grad, height = np.zeros(g), np.zeros((g, k, f)), np.zeros(g)
            hess = np.zeros((g, k, f, k, f)) if curvature else None
            for pdf in lots(batches):
                x = design(pdf, n_features, bias, curvature)
                own = np.searchsorted(labels, pdf["label"].to_numpy())
                n = np.arange(len(pdf))
                for j in range(g):
                    c = cost[own]
                    if "fold" in pdf:
                        c = np.where(pdf["fold"].to_numpy() == held[j], 0.0, c)
                    z = x @ sent.value[j].T
                    t = z - z[n, own][:, None] + 1.0
                    t[n, own] = 0.0
                    top = t.max(axis=1, keepdims=True)
                    e = np.exp((t - top) / mu)
                    share = e / e.sum(axis=1, keepdims=True)
                    if certify:
                        value[j] += (c * top[:, 0]).sum()
                        height[j] += (c * (1.0 - share[n, own])).sum()
                    else:
                        value[j] += (c * (top[:, 0] + mu * np.log(e.sum(axis=1)))).sum()
                    slope = share.copy()
                    slope[n, own] -= 1.0
                    grad[j] += (c[:, None] * slope).T @ x
                    if curvature:
                        for a in range(k):
                            for b in range(a, k):
                                bend = share[:, a] * ((a == b) - share[:, b]) * c / mu
                                block = (x * bend[:, None]).T @ x
                                hess[j, a, :, b, :] += block
                                if a != b:
                                    hess[j, b, :, a, :] += block
            return np.concatenate([value, grad.ravel(), *([hess.ravel()] if curvature else []), *([height] if certify else [])])

        total = add_up(self.rows, partial)
        sent.unpersist()
        return total


def _split(total: np.ndarray, m: int, width: int, curvature: bool) -> Evaluation:
    hess = total[m + m * width :].reshape(m, width, width) if curvature else None
    return total[:m], total[m : m + m * width].reshape(m, width), hess


def _bounds(total: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(objective at w, a value that no weights can go below), per model.

    Smoothed slopes lie within those of the loss itself, so each row has a lower bound that is linear in w; with the penalty
    the least value of their sum is heights - g.g / 2, which is the dual objective of those slopes.
    """
    m, width = w.shape
    grad = total[m : m + m * width].reshape(m, width)
    return total[:m] + 0.5 * (w * w).sum(axis=1), total[m + m * width :] - 0.5 * (grad * grad).sum(axis=1)


def _with_penalty(e: Evaluation, w: np.ndarray, l1: bool) -> Evaluation:
    """Add w.w / 2 to value, gradient and curvature; the L1 penalty is handled by the step."""
    if l1:
        return e
    value, grad, hess = e
    if hess is not None:
        hess = hess + np.eye(w.shape[1])
    return value + 0.5 * (w * w).sum(axis=1), grad + w, hess


def _violation(w: np.ndarray, grad: np.ndarray, l1: bool) -> np.ndarray:
    """Distance of 0 from the subdifferential, per model."""
    if l1:
        grad = np.where(w != 0, grad + np.sign(w), np.sign(grad) * np.maximum(np.abs(grad) - 1.0, 0.0))
    return np.sqrt((grad * grad).sum(axis=1))


def _l1_direction(w: np.ndarray, grad: np.ndarray, hess: np.ndarray, sweeps: int = 50) -> np.ndarray:
    """Minimiser d of grad.d + d.H.d / 2 + |w + d|_1, by cyclic coordinate steps."""
    hess = hess + 1e-10 * np.eye(len(w))
    d, hd = np.zeros_like(w), np.zeros_like(w)
    for _ in range(sweeps):
        largest = 0.0
        for i in range(len(w)):
            a = hess[i, i]
            target = w[i] + d[i] - (grad[i] + hd[i]) / a
            move = np.sign(target) * max(abs(target) - 1.0 / a, 0.0) - w[i] - d[i]
            if move:
                d[i] += move
                hd += move * hess[:, i]
                largest = max(largest, abs(move))
        if largest < 1e-12:
            break
    return d


class NotConverged(RuntimeWarning):
    """A fit ended at its limit of passes above its tolerance; its weights are those of the last pass."""


def _warn_at_limit(violation: np.ndarray, tolerance: np.ndarray, passes: int) -> None:
    above = violation > tolerance
    if above.any():
        worst = (violation / tolerance).max()
        warnings.warn(f"{above.sum()} of {len(above)} models at {worst:.3g} x tolerance after {passes} passes", NotConverged, 3)


def _newton(evaluate, w: np.ndarray, l1: bool, tolerance: np.ndarray | None, max_passes: int, relative: float = 1e-7):
    def objective(e: Evaluation, at: np.ndarray) -> np.ndarray:
        return e[0] + (np.abs(at).sum(axis=1) if l1 else 0.0)

    now = _with_penalty(evaluate(w, True), w, l1)
    if tolerance is None:
        tolerance = relative * np.maximum(_violation(np.zeros_like(w), now[1], l1), 1.0)
    step, direction = np.ones(len(w)), np.zeros_like(w)
    fresh = np.ones(len(w), dtype=bool)
    for _ in range(max_passes):
        active = (_violation(w, now[1], l1) > tolerance) & (step > 1e-9)
        if not active.any():
            break
        for j in np.flatnonzero(active & fresh):
            if l1:
                direction[j] = _l1_direction(w[j], now[1][j], now[2][j])
            else:
                direction[j] = -np.linalg.solve(now[2][j], now[1][j])
        trial = np.where(active[:, None], w + step[:, None] * direction, w)
        then = _with_penalty(evaluate(trial, True), trial, l1)
        expected = (now[1] * direction).sum(axis=1)
        if l1:
            expected += np.abs(w + direction).sum(axis=1) - np.abs(w).sum(axis=1)
        slack = 1e-13 * np.abs(objective(now, w))
        good = active & (objective(then, trial) <= objective(now, w) + 1e-4 * step * expected + slack)
        w = np.where(good[:, None], trial, w)
        now = tuple(np.where(good.reshape((-1,) + (1,) * (b.ndim - 1)), b, a) for a, b in zip(now, then))
        step = np.where(good, 1.0, np.where(active, step / 2.0, step))
        fresh = good
    else:
        _warn_at_limit(_violation(w, now[1], l1), tolerance, max_passes)
    return w


def _quasi_newton(
    evaluate, w: np.ndarray, l1: bool, tolerance: np.ndarray | None, max_passes: int, relative: float = 1e-6, memory: int = 10
):
    """All models as one limited-memory problem; with L1, steps stay in the orthant of the pseudo-gradient."""
    shape = w.shape

    def at(point: np.ndarray) -> tuple[float, np.ndarray]:
        value, grad, _ = _with_penalty(evaluate(point.reshape(shape), False), point.reshape(shape), l1)
        return value.sum() + (np.abs(point).sum() if l1 else 0.0), grad.ravel()

    def pseudo(point: np.ndarray, grad: np.ndarray) -> np.ndarray:
        if not l1:
            return grad
        return np.where(point != 0, grad + np.sign(point), np.sign(grad) * np.maximum(np.abs(grad) - 1.0, 0.0))

    x = w.ravel().copy()
    value, grad = at(x)
    if tolerance is None:
        tolerance = relative * np.maximum(_violation(np.zeros(shape), grad.reshape(shape), l1), 1.0)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    passes = 1
    while passes < max_passes and (_violation(x.reshape(shape), grad.reshape(shape), l1) > tolerance).any():
        pg = pseudo(x, grad)
        q, coefs = pg.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (s @ y)
            q -= a * y
            coefs.append(a)
        q *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1.0 / max(np.linalg.norm(pg), 1.0)
        for (s, y), a in zip(pairs, reversed(coefs)):
            q += s * (a - (y @ q) / (s @ y))
        d = -q
        if l1:
            d = np.where(d * pg < 0, d, 0.0)
        orthant = np.where(x != 0, np.sign(x), -np.sign(pg))
        step = 1.0
        while passes < max_passes:
            trial = x + step * d
            if l1:
                trial = np.where(trial * orthant > 0, trial, 0.0)
            new_value, new_grad = at(trial)
            passes += 1
            if new_value <= value + 1e-4 * pg @ (trial - x) or step < 1e-10:
                break
            step /= 2.0
        if new_value > value:
            break
        s, y = trial - x, new_grad - grad
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs, (s, y)][-memory:]
        x, value, grad = trial, new_value, new_grad
    if passes >= max_passes:
        _warn_at_limit(_violation(x.reshape(shape), grad.reshape(shape), l1), tolerance, passes)
    return x.reshape(shape)


def minimise(
    problem: Problem | JointProblem, start: np.ndarray | None = None, tolerance: np.ndarray | None = None, max_passes: int = 200
) -> np.ndarray:
    """Weights (models x width).

    Losses with a kink are followed through a falling width of smoothing, until the duality gap of every model is at most GAP
    of its objective; the gaps are left in `problem.gap`. A fit that ends at its limit of passes, or above that gap, warns.
    """
    w = problem.start() if start is None else start
    check_driver_cells(w.size, "the weight matrix")
    solver = _newton if problem.second_order() else _quasi_newton
    if problem.loss not in SMOOTHED:
        return solver(lambda at, curvature: problem.evaluate(at, 1.0, curvature), w, problem.l1, tolerance, max_passes)
    value, _ = problem.certificate(w, SMOOTHING[0])
    for mu in SMOOTHING:
        # The distance of a smoothed objective from its optimum is at most half the squared gradient.
        inner = np.sqrt(GAP * np.maximum(value, 1e-12) / 2.0)
        w = solver(lambda at, curvature: problem.evaluate(at, mu, curvature), w, False, inner, max_passes)
        value, bound = problem.certificate(w, mu)
        problem.gap = value - bound
        if (problem.gap <= GAP * value).all():
            return w
    _warn_at_limit(problem.gap, GAP * value, max_passes)
    return w
