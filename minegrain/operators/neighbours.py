"""Nearest-neighbour recommendation on centred ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from minegrain.operators import tiles
from minegrain.operators.nearest import nearest_rows
from minegrain.operators.tiles import tiled_best, tiled_product
from minegrain.runtime import broadcast_if_small, cut_lineage

NEUTRAL = 3.0
# Similarities that agree to this many digits are ties, and the lower id wins.
TIE_DIGITS = 9


def center_ratings(ratings: DataFrame, offset: float = NEUTRAL) -> DataFrame:
    return ratings.withColumn("rating", F.col("rating") - F.lit(offset))


def user_mean_centering(ratings: DataFrame) -> DataFrame:
    """Subtract each user's mean of given ratings; the mean is one row per user, joined back."""
    means = ratings.groupBy("user_id").agg(F.avg("rating").alias("__mean"))
    return ratings.join(means, "user_id").withColumn("rating", F.col("rating") - F.col("__mean")).drop("__mean")


def _cells(centred: DataFrame, row: str, inner: str) -> DataFrame:
    cells = centred.select(F.col(row).alias("row"), F.col(inner).alias("inner"), F.col("rating").alias("value"))
    return cells.filter("value <> 0")


def _gram(centred: DataFrame, row: str, inner: str, cosine: bool) -> DataFrame:
    """Dot products that are not 0; for the cosine they are divided by the lengths afterwards, so that 0 stays exact."""
    cells = _cells(centred, row, inner)
    pairs = tiled_product(cells)
    if not cosine:
        return pairs
    length = broadcast_if_small(cells.groupBy("row").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("n")))
    pairs = pairs.join(length.select(F.col("row").alias("left"), F.col("n").alias("nl")), "left")
    pairs = pairs.join(length.select(F.col("row").alias("right"), F.col("n").alias("nr")), "right")
    return pairs.select("left", "right", (F.col("value") / (F.col("nl") * F.col("nr"))).alias("value"))


def _user_pairs(ratings: DataFrame, cosine: bool) -> DataFrame:
    pairs = _gram(center_ratings(ratings), "user_id", "item_id", cosine)
    return pairs.select(F.col("left").alias("u1"), F.col("right").alias("u2"), F.col("value").alias("sim"))


def _item_pairs(centred: DataFrame, cosine: bool) -> DataFrame:
    pairs = _gram(centred, "item_id", "user_id", cosine)
    return pairs.select(F.col("left").alias("i1"), F.col("right").alias("i2"), F.col("value").alias("sim"))


def user_similarity_dot(ratings: DataFrame) -> DataFrame:
    """(u1, u2, sim), u1 < u2: pairs with a non-zero sum over common items of centred ratings."""
    return _user_pairs(ratings, False)


def user_similarity_cosine(ratings: DataFrame) -> DataFrame:
    return _user_pairs(ratings, True)


def item_similarity_dot(ratings: DataFrame) -> DataFrame:
    return _item_pairs(center_ratings(ratings), False)


def item_similarity_cosine(ratings: DataFrame) -> DataFrame:
    return _item_pairs(center_ratings(ratings), True)


def item_similarity_pcc(ratings: DataFrame) -> DataFrame:
    """Cosine of items over ratings centred on each user's mean."""
    return _item_pairs(user_mean_centering(ratings), True)


def topk_neighbours(sim: DataFrame, n_items: int, k: int) -> DataFrame:
    """(row, neighbour, sim, place): the k best neighbours per row of symmetric pairs given once.

    Pairs that are not listed have similarity 0 and outrank negative ones without adding anything: the r-th best
    negative stays only if positives + zeros + r <= k. `place` is the position in that order, so a smaller k is the
    filter place <= k.
    """
    a, b = sim.columns[:2]
    both = cut_lineage(sim).select(
        F.explode(
            F.array(
                F.struct(F.col(a).alias("row"), F.col(b).alias("neighbour")),
                F.struct(F.col(b).alias("row"), F.col(a).alias("neighbour")),
            )
        ).alias("p"),
        "sim",
    )
    both = both.select("p.row", "p.neighbour", "sim").filter("sim <> 0")
    counts = both.groupBy("row").agg(F.count_if(F.col("sim") > 0).alias("n_pos"), F.count_if(F.col("sim") < 0).alias("n_neg"))
    return _placed(both, counts, n_items, k)


def _placed(pairs: DataFrame, counts: DataFrame, n_items: int, k: int) -> DataFrame:
    """Rank within row and sign, where Spark drops rows beyond k before the shuffle, then the place among all."""
    k = min(k, n_items - 1)
    level = F.round("sim", TIE_DIGITS)
    order = W.partitionBy("row", "sign").orderBy(F.desc(level), "neighbour")
    signed = pairs.withColumn("sign", F.signum("sim").cast("int"))
    ranked = signed.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)
    skipped = F.when(F.col("sign") > 0, F.lit(0)).otherwise(F.lit(n_items - 1) - F.col("n_neg"))
    return (
        ranked.join(counts, "row")
        .withColumn("place", (F.col("r") + skipped).cast("int"))
        .filter(F.col("place") <= k)
        .select("row", "neighbour", "sim", "place")
    )


def nearest_neighbours(ratings: DataFrame, k: int, by: str = "item", kind: str = "cosine") -> DataFrame:
    """`topk_neighbours` of a similarity without ever listing all similar pairs: a task keeps the k best of the rows it holds.

    by: 'user' or 'item'; kind: 'cosine', 'dot', or 'pcc' for items over ratings centred on each user's mean. A row of more
    than TILE_CELLS cells is cut by stripes, and then the tiles of each pair of blocks hand over their k best per row.
    """
    row, inner = ("user_id", "item_id") if by == "user" else ("item_id", "user_id")
    centred = user_mean_centering(ratings) if kind == "pcc" else center_ratings(ratings)
    n = ratings.select(row).distinct().count()
    cells = cut_lineage(_cells(centred, row, inner))
    longest = cells.groupBy("row").count().agg(F.max("count")).first()[0]
    if longest is None or longest <= tiles.TILE_CELLS:
        return nearest_rows(cells, n, min(k, n - 1), TIE_DIGITS, kind != "dot")
    found = cut_lineage(tiled_best(cells, min(k, n - 1), TIE_DIGITS, kind != "dot"))
    counts = found.filter("counted").groupBy("row").agg(F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"))
    return _placed(found.filter("not counted").select("row", "neighbour", "sim"), counts, n, k)


def _shares(neighbours: DataFrame, weighted: bool) -> DataFrame:
    """(row, neighbour, w): each row's weights scaled to absolute sum 1."""
    w = F.col("sim") if weighted else F.lit(1.0)
    cells = cut_lineage(neighbours.select("row", "neighbour", w.alias("w")))  # read twice
    total = cells.groupBy("row").agg(F.sum(F.abs("w")).alias("total"))
    return cells.join(total, "row").select("row", "neighbour", (F.col("w") / F.col("total")).alias("w"))


def _scored(pairs: DataFrame, evidence: DataFrame) -> DataFrame:
    sums = evidence.groupBy("pair_id").agg((F.sum(F.col("w") * F.col("rating")) + NEUTRAL).alias("pred"))
    return lookup_predictions(pairs, sums)


def lookup_predictions(pairs: DataFrame, preds: DataFrame, default: float = NEUTRAL) -> DataFrame:
    """Predictions for the requested pairs; a pair without evidence gets the default."""
    found = pairs.join(preds.select("pair_id", "pred"), "pair_id", "left")
    return found.withColumn("pred", F.coalesce("pred", F.lit(default)))


def knn_predict_user(pairs: DataFrame, ratings: DataFrame, neighbours: DataFrame, weighted: bool = False) -> DataFrame:
    """Mean (or similarity-weighted mean) of the neighbours' centred ratings of the item, plus 3."""
    shares = _shares(neighbours, weighted)
    wanted = pairs.join(shares.withColumnRenamed("row", "user_id"), "user_id").select("pair_id", "item_id", "neighbour", "w")
    given = center_ratings(ratings).select(F.col("user_id").alias("neighbour"), "item_id", "rating")
    return _scored(pairs, wanted.join(given, ["neighbour", "item_id"]))


def knn_predict_item(pairs: DataFrame, ratings: DataFrame, neighbours: DataFrame, weighted: bool = False) -> DataFrame:
    """The same over the most similar items that the user has rated."""
    shares = _shares(neighbours, weighted)
    wanted = pairs.join(shares.withColumnRenamed("row", "item_id"), "item_id").select("pair_id", "user_id", "neighbour", "w")
    given = center_ratings(ratings).select(F.col("item_id").alias("neighbour"), "user_id", "rating")
    return _scored(pairs, wanted.join(given, ["neighbour", "user_id"]))


def _sweep_evidence(pairs: DataFrame, ranked: DataFrame, given: DataFrame, row: str, other: str, k: int) -> DataFrame:
    """Ratings that the up to k neighbours of a pair's row gave to its other side.

    A pair meets the ratings of its other side first, as these are fewer than its neighbours; where they are more than k, it
    meets its neighbours first. Either way a pair has k rows at most.
    """
    size = given.groupBy(other).agg(F.count(F.lit(1)).alias("n_given"))
    sized = cut_lineage(pairs.join(size, other))
    few, many = sized.filter(F.col("n_given") <= k).drop("n_given"), sized.filter(F.col("n_given") > k).drop("n_given")
    evidence = few.join(given, other).join(ranked, [row, "neighbour"])
    if many.isEmpty():
        return evidence
    return evidence.unionByName(many.join(ranked, row).join(given, ["neighbour", other]))


def _sweep_errors(
    pairs: DataFrame, gold: DataFrame, ratings: DataFrame, ranked: DataFrame, ks: tuple[int, ...], memory: bool
) -> DataFrame:
    """(weighted, k, rmse) of all k and both weightings from one join of the pairs, their neighbours and the ratings."""
    row, other = ("user_id", "item_id") if memory else ("item_id", "user_id")
    upto = lambda k, c: F.when(F.col("place") <= k, c)
    weights = {True: F.col("sim"), False: F.lit(1.0)}
    cases = [(weighted, k) for weighted in weights for k in ks]
    ranked = ranked.withColumnRenamed("row", row)
    totals = ranked.groupBy(row).agg(
        *[F.sum(upto(k, F.abs(weights[w]))).alias(f"total_{i}") for i, (w, k) in enumerate(cases)]
    )
    given = center_ratings(ratings).select(F.col(row).alias("neighbour"), other, "rating")
    evidence = _sweep_evidence(pairs.select("pair_id", row, other), ranked, given, row, other, max(ks))
    sums = evidence.groupBy("pair_id").agg(
        *[F.sum(upto(k, weights[w] * F.col("rating"))).alias(f"sum_{i}") for i, (w, k) in enumerate(cases)]
    )
    scored = pairs.select("pair_id", row).join(sums, "pair_id", "left").join(totals, row, "left")
    scored = scored.join(gold.select("pair_id", "gold"), "pair_id")
    error = lambda i: F.coalesce(F.col(f"sum_{i}") / F.col(f"total_{i}"), F.lit(0.0)) + NEUTRAL - F.col("gold")
    out = scored.agg(*[F.sqrt(F.avg(error(i) * error(i))).alias(f"rmse_{i}") for i in range(len(cases))])
    rows = [
        F.struct(F.lit(w).alias("weighted"), F.lit(k).alias("k"), F.col(f"rmse_{i}").alias("rmse")) for i, (w, k) in enumerate(cases)
    ]
    return out.select(F.inline(F.array(*rows)))


def knn_sweep(train: DataFrame, pairs: DataFrame, gold: DataFrame, ks: tuple[int, ...] = (10, 100, 500)) -> DataFrame:
    """(memory, pcc, weighted, cosine, k, rmse) for user-based, item-based and mean-centred neighbours.

    Each similarity is computed and ranked once for the largest k, and joined once: smaller k and both weightings are
    conditional sums over the same rows.
    """
    train, pairs = cut_lineage(train), cut_lineage(pairs)
    variants = [
        (True, False, True, "cosine"),
        (True, False, False, "dot"),
        (False, False, True, "cosine"),
        (False, False, False, "dot"),
        (False, True, True, "pcc"),
    ]
    results = None
    for memory, pcc, cosine, kind in variants:
        ranked = cut_lineage(nearest_neighbours(train, max(ks), "user" if memory else "item", kind))
        found = _sweep_errors(pairs, gold, train, ranked, ks, memory).select(
            F.lit(memory).alias("memory"), F.lit(pcc).alias("pcc"), "weighted", F.lit(cosine).alias("cosine"), "k", "rmse"
        )
        results = found if results is None else results.unionByName(found)
    return results
