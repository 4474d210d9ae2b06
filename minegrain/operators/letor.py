"""Learning to rank from latent factors: preference pairs, pairwise SVM and pairwise logistic scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minegrain.functions.ordering import chunked_pairs
from minegrain.functions.vectors import dot, hadamard, subtract
from minegrain.operators.evaluate import ndcg_at_k
from minegrain.operators.factors import gather_factors, pmf_fit, pmf_predict
from minegrain.operators.sampling import union_experiments
from minegrain.operators.sga import pairwise_logreg, _shares
from minegrain.operators.trainer import _newton, add_up
from minegrain.runtime import broadcast_if_small, cut_lineage

# Most rows of either side of a user in one cell, and rows that a task takes up at once.
GRID_CHUNK = 20_000
LOT_ROWS = 50_000
CELL = ["user_id", "hi", "lo"]


def filter_extreme_ratings(ratings: DataFrame, keep: tuple[float, ...] = (1.0, 5.0)) -> DataFrame:
    return ratings.filter(F.col("rating").isin(*keep))


def latent_pair_features(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs with x = elementwise product of the user's and the item's factors."""
    return gather_factors(pairs, users, items).withColumn("x", hadamard("u", "v")).drop("u", "v")


def preference_self_join(ratings: DataFrame) -> DataFrame:
    """(user_id, item_x, rating_x, item_y, rating_y): a user's items with different ratings, item_x < item_y.

    The pairs are the result; a user with many ratings is cut into a grid of bounded cells.
    """
    left = ratings.select("user_id", F.col("item_id").alias("item_x"), F.col("rating").alias("rating_x"))
    right = ratings.select("user_id", F.col("item_id").alias("item_y"), F.col("rating").alias("rating_y"))
    joined = chunked_pairs(left, right, "user_id", "item_x", "item_y")
    return joined.filter((F.col("item_x") < F.col("item_y")) & (F.col("rating_x") != F.col("rating_y")))


def pairwise_training_set(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """(user_id, item_x, item_y, x, y): difference of the pair features of two extreme ratings and the sign of theirs."""
    rated = latent_pair_features(filter_extreme_ratings(ratings).select("user_id", "item_id", "rating"), users, items)
    high = rated.filter("rating > 3").select("user_id", F.col("item_id").alias("item_h"), F.col("x").alias("x_h"))
    low = rated.filter("rating < 3").select("user_id", F.col("item_id").alias("item_l"), F.col("x").alias("x_l"))
    pairs = chunked_pairs(high, low, "user_id", "item_h", "item_l")
    high_first = F.col("item_h") < F.col("item_l")
    return pairs.select(
        "user_id",
        F.least("item_h", "item_l").alias("item_x"),
        F.greatest("item_h", "item_l").alias("item_y"),
        F.when(high_first, subtract("x_h", "x_l")).otherwise(subtract("x_l", "x_h")).alias("x"),
        F.when(high_first, 1.0).otherwise(-1.0).alias("y"),
    )


def _preference_cells(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Extreme ratings (user_id, hi, lo, item_id, high, x), sorted by cell inside each partition.

    A cell has the rows of one user. A user with more than GRID_CHUNK rows on a side is dealt to a grid of cells by item,
    where every row of one side meets every row of the other one in exactly one cell.
    """
    rated = latent_pair_features(filter_extreme_ratings(ratings).select("user_id", "item_id", "rating"), users, items)
    rated = cut_lineage(rated.select("user_id", "item_id", (F.col("rating") > 3).alias("high"), "x"))
    sizes = rated.groupBy("user_id").agg(F.count_if("high").alias("n_high"), F.count_if(~F.col("high")).alias("n_low"))
    hot = sizes.filter((F.col("n_high") > GRID_CHUNK) | (F.col("n_low") > GRID_CHUNK))

    def chunks(n: str):
        return F.greatest(F.ceil(F.coalesce(F.col(n), F.lit(0)) / GRID_CHUNK), F.lit(1)).cast("int")

    cut = rated.join(broadcast_if_small(hot), "user_id", "left").withColumns({"his": chunks("n_high"), "los": chunks("n_low")})
    own = F.pmod(F.xxhash64(F.lit("cell"), "item_id"), F.when(F.col("high"), F.col("his")).otherwise(F.col("los"))).cast("int")
    other = F.when(F.col("high"), F.col("los")).otherwise(F.col("his"))
    dealt = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), other - 1)))
    cells = dealt.select(
        "user_id",
        F.when(F.col("high"), F.col("own")).otherwise(F.col("other")).alias("hi"),
        F.when(F.col("high"), F.col("other")).otherwise(F.col("own")).alias("lo"),
        "item_id",
        "high",
        "x",
    )
    return cells.repartition(*CELL).sortWithinPartitions(*CELL)


def _whole_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by cell, in lots that end where a cell ends, with the cell's number in the lot as `cell`."""

    def numbered(parts: list[pd.DataFrame]) -> pd.DataFrame:
        pdf = pd.concat(parts, ignore_index=True)
        start = (pdf[CELL] != pdf[CELL].shift()).any(axis=1)
        return pdf.assign(cell=start.cumsum() - 1)

    waiting: list[pd.DataFrame] = []
    enough = LOT_ROWS
    for pdf in batches:
        waiting.append(pdf)
        if sum(map(len, waiting)) < enough:
            continue
        lot = numbered(waiting)
        last = lot["cell"] == lot["cell"].iloc[-1]
        if not last.all():
            yield lot[~last]
        waiting = [lot[last].drop(columns="cell")]
        enough = max(LOT_ROWS, 2 * len(waiting[0]))
    if waiting and any(map(len, waiting)):
        yield numbered(waiting)


def pairwise_sums(cell, item, high, x, weights: np.ndarray, offset: float, curvature: bool):
    """Value, gradient and curvature of max(0, 1 - w.(x_h - x_l) - offset * side)^2 over the high x low pairs of each cell.

    side is 1 where the high item has the lower id, else -1. A cell's rows in id order are halved again and again: between
    the halves side is fixed, so the pairs of a row that fall short are one end of the other half in score order, and
    prefix sums give their number, scores and features. n rows take n log(n)^2 steps instead of a step per pair.
    """
    order = np.lexsort((high, item, cell))
    cell, high, x = cell[order], high[order], x[order]
    n, dim = x.shape
    score = x @ weights
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[first, n])
    place = np.arange(n) - np.repeat(first, size)
    size = np.repeat(size, size)
    value, edge_pull = 0.0, 0.0
    pull, pairs, sided = np.zeros(n), np.zeros(n), np.zeros(n)
    cross = np.zeros((dim, dim))
    level = 0
    while size.max() > 1 << level:
        at = np.flatnonzero(size > 1 << level)
        up = high[at]
        # Low rows of the later half stand against high rows of the earlier one (side 1) and the other way round.
        opposed = ((place[at] >> level) & 1) ^ ~up
        side = np.where(opposed, -1.0, 1.0)
        key = score[at] - np.where(up, 1.0 - offset * side, 0.0)
        block = place[at] >> level + 1
        by = np.lexsort((up, key, opposed, block, cell[at]))
        at, up, side, key, group = at[by], up[by], side[by], key[by], (cell[at[by]], block[by], opposed[by])
        starts = np.r_[True, np.any([g[1:] != g[:-1] for g in group], axis=0)]
        begin = np.flatnonzero(starts)[np.cumsum(starts) - 1]
        end = np.r_[np.flatnonzero(starts)[1:], len(at)][np.cumsum(starts) - 1]

        def before(v: np.ndarray) -> np.ndarray:
            return np.concatenate([np.zeros((1, *v.shape[1:])), np.cumsum(v, axis=0)])

        def later(v: np.ndarray) -> np.ndarray:
            """Sum over the low rows above each high row."""
            total = before(np.where(up.reshape(-1, *[1] * (v.ndim - 1)), 0.0, v))
            return total[end[up]] - total[np.flatnonzero(up)]

        def earlier(v: np.ndarray) -> np.ndarray:
            """Sum over the high rows below each low row."""
            total = before(np.where(up, v, 0.0))
            return total[np.flatnonzero(~up)] - total[begin[~up]]

        one = np.ones(len(at))
        many, scores, own = later(one), later(key), key[up]
        short = scores - many * own
        value += (later(key * key) - 2.0 * own * scores + many * own * own).sum()
        edge_pull += (side[up] * short).sum()
        pull[at[up]] += short
        few = earlier(one)
        pull[at[~up]] -= few * key[~up] - earlier(key)
        if curvature:
            pairs[at[up]] += many
            pairs[at[~up]] += few
            sided[at[up]] += side[up] * many
            sided[at[~up]] -= side[~up] * few
            cross += x[at[up]].T @ later(x[at])
        level += 1
    grad = -2.0 * np.append(pull @ x, edge_pull)
    if not curvature:
        return value, grad, None
    hess = np.empty((dim + 1, dim + 1))
    hess[:dim, :dim] = (x.T * pairs) @ x - cross - cross.T
    hess[dim, :dim] = hess[:dim, dim] = sided @ x
    hess[dim, dim] = pairs[high].sum()
    return value, grad, 2.0 * hess


def _pairwise_evaluation(cells: DataFrame, dim: int, C: float):
    """Squared-hinge value, gradient and curvature over all preference pairs, without a step per pair."""
    width = dim + 1

    def evaluate(w: np.ndarray, curvature: bool):
        weights, offset = w[0, :dim], w[0, dim]

        def partial(batches: Iterator[pd.DataFrame]) -> np.ndarray:
            total = np.zeros(1 + width + width * width)
            for lot in _whole_cells(batches):
                x = np.concatenate(lot["x"].to_list()).reshape(-1, dim)
                columns = (lot[c].to_numpy() for c in ("cell", "item_id", "high"))
                value, grad, hess = pairwise_sums(*columns, x, weights, offset, curvature)
                total[0] += value
                total[1 : 1 + width] += grad
                if curvature:
                    total[1 + width :] += hess.ravel()
            return C * total

        total = add_up(cells, partial)
        return total[:1], total[1 : 1 + width][None, :], total[1 + width :].reshape(1, width, width)

    return evaluate


def rank_svm_weights(ratings: DataFrame, users: DataFrame, items: DataFrame, C: float = 0.002) -> np.ndarray:
    """Squared-hinge weights over all preference pairs; a regularised bias feature of 1 is trained and left out."""
    dim = users.select(F.size("f")).first()[0]
    cells = cut_lineage(_preference_cells(ratings, users, items))
    w = _newton(_pairwise_evaluation(cells, dim, C), np.zeros((1, dim + 1)), False, None, 100)
    return w[0, :dim]


def rank_svm(ratings: DataFrame, pairs: DataFrame, users: DataFrame, items: DataFrame, C: float = 0.002) -> DataFrame:
    """Pairs with score = w.x of their latent features."""
    w = rank_svm_weights(ratings, users, items, C)
    scored = latent_pair_features(pairs, users, items)
    return scored.withColumn("score", dot("x", F.lit(w.tolist()))).drop("x")


def rank_logistic(
    ratings: DataFrame,
    pairs: DataFrame,
    users: DataFrame,
    items: DataFrame,
    batch: int = 10_000,
    epochs: int = 2,
    L: float = 100.0,
    eta0: float = 0.0005,
) -> DataFrame:
    """Pairs with score = P(+1 | x) of the pairwise logistic model; preference rows are batched in hash order."""
    rows = pairwise_training_set(ratings, users, items).select(
        F.xxhash64("user_id", "item_x", "item_y").alias("row_id"), F.col("y").alias("label"), F.col("x").alias("features")
    )
    model = pairwise_logreg(cut_lineage(rows), L, batch, eta0, epochs)
    latent = latent_pair_features(pairs, users, items).withColumnRenamed("x", "features")
    return _shares(latent, model).withColumn("score", F.col("p")[1]).drop("features", "z", "p")


def preference_count(ratings: DataFrame) -> int:
    """Pairs of one user's highest and lowest ratings, counted per user, not listed."""
    sides = filter_extreme_ratings(ratings).groupBy("user_id").agg(
        F.count_if(F.col("rating") > 3).alias("high"), F.count_if(F.col("rating") < 3).alias("low")
    )
    return sides.agg(F.sum(F.col("high") * F.col("low"))).first()[0] or 0


def ndcg_of_rankers(
    train: DataFrame,
    pairs: DataFrame,
    dims: tuple[int, ...] = (10, 20, 50, 100),
    ks: tuple[int, ...] = (10, 20, 30),
    C: float = 0.002,
    batch: int = 10_000,
    **fit,
) -> DataFrame:
    """(dim, ranker, k, ndcg, converged): from ratings to the ranking of held-out pairs, for each number of factors.

    `pairs` is (pair_id, user_id, item_id, gold). Factors come from `pmf_fit` with the options of `fit`, and `converged` is
    theirs; rankers are the predicted rating ("pmf"), the ranking SVM ("svm") and the pairwise logistic model
    ("logistic"). Without a pair of a highest and a lowest rating there is nothing to learn from, and an error is raised.
    """
    train, pairs, tables = cut_lineage(train), cut_lineage(pairs), []
    preferences = preference_count(train)
    if not preferences:
        raise ValueError("no user has both a highest and a lowest rating")
    for dim in dims:
        model = pmf_fit(train, dim, **fit)
        users, items = cut_lineage(model.users), cut_lineage(model.items)
        rankings = {
            "pmf": pmf_predict(pairs, users, items),
            "svm": rank_svm(train, pairs, users, items, C).withColumnRenamed("score", "pred"),
            "logistic": rank_logistic(train, pairs, users, items, min(batch, preferences)).withColumnRenamed("score", "pred"),
        }
        for ranker, scored in rankings.items():
            gains = ndcg_at_k(scored, ks=ks)
            named = (F.lit(dim).alias("dim"), F.lit(ranker).alias("ranker"), "k", "ndcg", F.lit(model.converged).alias("converged"))
            tables.append(gains.select(*named))
    return union_experiments(tables)
