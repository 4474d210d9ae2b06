"""Queries for ratings and nearest neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from minegrain.functions.vectors import rounded
from minegrain.operators import evaluate as ev
from minegrain.operators import matrix as mx
from minegrain.operators import neighbours as nb
from minegrain.plans import inputs as inp
from minegrain.plans.inputs import PRED, RATINGS, TRAIN, r6
from minegrain.plans.registry import query
from minegrain.runtime import cut_lineage


@query("center_ratings", f"with {RATINGS} select user_id, item_id, rating - 3.0 as rating from ratings")
def center_ratings(spark, sf):
    return nb.center_ratings(inp.ratings(spark, sf).drop("ts"))


@query(
    "user_mean_centering",
    f"with {RATINGS} select user_id, item_id, {r6('rating - avg(rating) over (partition by user_id)')} as rating from ratings",
)
def user_mean_centering(spark, sf):
    centred = nb.user_mean_centering(inp.ratings(spark, sf).drop("ts"))
    return centred.select("user_id", "item_id", rounded("rating").alias("rating"))


@query(
    "normalize_l1_rows",
    f"""with {RATINGS}, c as (select user_id as row, item_id as col, rating - 3.0 as v from ratings),
    s as (select row, sum(abs(v)) as s from c group by 1)
    select row, col, {r6('case when s > 0 then v / s else v end')} as value from c join s using (row)""",
)
def normalize_l1_rows(spark, sf):
    scaled = mx.normalize_l1_rows(_cells(inp.ratings(spark, sf), "user_id", "item_id"))
    return scaled.withColumn("value", rounded("value"))


@query(
    "normalize_l2",
    f"""with {RATINGS}, c as (select item_id as row, user_id as col, rating - 3.0 as v from ratings),
    s as (select row, sqrt(sum(v * v)) as s from c group by 1)
    select row, col, {r6('case when s > 0 then v / s else v end')} as value from c join s using (row)""",
)
def normalize_l2(spark, sf):
    return mx.normalize_l2(_cells(inp.ratings(spark, sf), "item_id", "user_id")).withColumn("value", rounded("value"))


def _cells(ratings, row, col):
    return ratings.select(F.col(row).alias("row"), F.col(col).alias("col"), (F.col("rating") - 3.0).alias("value"))


@query(
    "population_variance",
    f"""with {RATINGS}, n as (select cast((max(user_id) + 1) * (max(item_id) + 1) as double) as n from ratings)
    select round(sum((rating - 3) * (rating - 3)) / max(n) - (sum(rating - 3) / max(n)) * (sum(rating - 3) / max(n)), 9) as variance
    from ratings, n""",
)
def population_variance(spark, sf):
    ratings = inp.ratings(spark, sf)
    size = mx.id_space_size(ratings, ["user_id", "item_id"]).first()
    variance = mx.population_variance(_cells(ratings, "user_id", "item_id"), size[0] * size[1])
    return variance.select(F.round("variance", 9).alias("variance"))


@query(
    "id_space_size",
    f"with {RATINGS} select max(user_id) + 1 as user_id_size, max(item_id) + 1 as item_id_size from ratings",
)
def id_space_size(spark, sf):
    return mx.id_space_size(inp.ratings(spark, sf), ["user_id", "item_id"])


@query(
    "sparse_matmul",
    f"""with {RATINGS},
    a as (select user_id as row, item_id as col, rating as v from ratings),
    b as (select p_partkey as row, cast(split_part(p_brand, '#', 2) as bigint) as col, cast(p_size as double) as v from part)
    select a.row, b.col, {r6('sum(a.v * b.v)')} as value from a join b on a.col = b.row group by 1, 2""",
)
def sparse_matmul(spark, sf):
    """Users x items times items x brands."""
    a = inp.ratings(spark, sf).select(F.col("user_id").alias("row"), F.col("item_id").alias("col"), F.col("rating").alias("value"))
    b = inp.table(spark, sf, "part").select(
        F.col("p_partkey").alias("row"),
        F.split_part("p_brand", F.lit("#"), F.lit(2)).cast("bigint").alias("col"),
        F.col("p_size").cast("double").alias("value"),
    )
    return mx.sparse_matmul(a, b).withColumn("value", rounded("value"))


# --- similarities ------------------------------------------------------------------------------------------------

def _sim(ratings: str, row: str, inner: str, cosine: bool, centred: str = "rating - 3.0", noisy: bool = False) -> str:
    """CTE chain ending in sim(a, b, sim) over non-zero pairs a < b; `noisy` leaves out what rounding alone may make."""
    norm = f"sqrt(sum(v * v) over (partition by {row}))" if cosine else "1.0"
    floor = "abs(sum(a.v * b.v) / (any_value(a.n) * any_value(b.n))) > 1e-12" if noisy else "sum(a.v * b.v) <> 0"
    return f"""c as (select user_id, item_id, {centred} as v from {ratings}),
    m as (select {row} as r, {inner} as i, v, {norm} as n from c where v <> 0),
    sim as (select a.r as a, b.r as b, sum(a.v * b.v) / (any_value(a.n) * any_value(b.n)) as sim
            from m a join m b on a.i = b.i and a.r < b.r group by 1, 2 having {floor})"""


_MEAN = "rating - avg(rating) over (partition by user_id)"
_SIMILARITIES = {
    "user_similarity_dot": ("u", nb.user_similarity_dot, _sim("ratings", "user_id", "item_id", False)),
    "user_similarity_cosine": ("u", nb.user_similarity_cosine, _sim("ratings", "user_id", "item_id", True)),
    "item_similarity_dot": ("i", nb.item_similarity_dot, _sim("ratings", "item_id", "user_id", False)),
    "item_similarity_cosine": ("i", nb.item_similarity_cosine, _sim("ratings", "item_id", "user_id", True)),
    "item_similarity_pcc": ("i", nb.item_similarity_pcc, _sim("ratings", "item_id", "user_id", True, _MEAN, True)),
}


def _register_similarity(name, side, operator, sim):
    @query(name, f"with {RATINGS}, {sim} select a as {side}1, b as {side}2, {r6('sim')} as sim from sim")
    def run(spark, sf):
        found = operator(inp.ratings(spark, sf))
        # Means are not exact, so both engines leave out the pairs whose sum may be rounding noise, here and in the SQL.
        found = found.filter(F.abs("sim") > 1e-12) if operator is nb.item_similarity_pcc else found
        return found.withColumn("sim", rounded("sim"))


for _name, (_side, _operator, _text) in _SIMILARITIES.items():
    _register_similarity(_name, _side, _operator, _text)


# --- neighbours and predictions ----------------------------------------------------------------------------------
# Neighbours are ranked by the similarity to 9 digits, so that ties fall the same way in both engines.

def _neighbours(k: int, ids: str) -> str:
    return f"""rs as (select a, b, sim, round(sim, 9) as level from sim),
    both_ways as (select a as row, b as neighbour, sim, level from rs union all select b, a, sim, level from rs),
    n_ids as (select count(distinct {ids}) as n from train),
    signed as (
      select *, row_number() over (partition by row, sim > 0 order by level desc, neighbour) as r,
             sum(case when sim < 0 then 1 else 0 end) over (partition by row) as n_neg from both_ways),
    placed as (select row, neighbour, sim, cast(case when sim > 0 then r else n - 1 - n_neg + r end as integer) as place
               from signed, n_ids),
    top as (select * from placed where place <= {k})"""


USER_SIM, ITEM_SIM = _sim("train", "user_id", "item_id", True), _sim("train", "item_id", "user_id", True)
USER_TOP, ITEM_TOP = _neighbours(20, "user_id"), _neighbours(20, "item_id")


def _train(spark, sf):
    return cut_lineage(inp.train(spark, sf))


@query(
    "topk_neighbours",
    f"with {TRAIN}, {ITEM_SIM}, {ITEM_TOP} select row, neighbour, {r6('sim')} as sim, place from top",
)
def topk_neighbours(spark, sf):
    top = nb.nearest_neighbours(_train(spark, sf), 20, "item", "cosine")
    return top.withColumn("sim", rounded("sim"))


def _pred(key: str, other: str, weighted: bool) -> str:
    w = "sim" if weighted else "1.0"
    return f"""shares as (select row, neighbour, {w} / sum(abs({w})) over (partition by row) as w from top),
    found as (select pair_id, sum(w * (t.rating - 3)) + 3 as pred
      from pairs p join shares s on s.row = p.{key} join train t on t.{key} = s.neighbour and t.{other} = p.{other} group by 1),
    preds as (select p.*, coalesce(f.pred, 3.0) as pred from pairs p left join found f using (pair_id))"""


USER_PRED = f"{TRAIN}, {USER_SIM}, {USER_TOP}, {_pred('user_id', 'item_id', False)}"
ITEM_PRED = f"{TRAIN}, {ITEM_SIM}, {ITEM_TOP}, {_pred('item_id', 'user_id', True)}"


@query("knn_predict_user", f"with {USER_PRED} select pair_id, user_id, item_id, gold, {r6('pred')} as pred from preds")
def knn_predict_user(spark, sf):
    train = _train(spark, sf)
    top = nb.nearest_neighbours(train, 20, "user", "cosine")
    return nb.knn_predict_user(inp.pairs(spark, sf), train, top).withColumn("pred", rounded("pred"))


def item_predictions(spark, sf):
    train = _train(spark, sf)
    top = nb.nearest_neighbours(train, 20, "item", "cosine")
    return nb.knn_predict_item(inp.pairs(spark, sf), train, top, weighted=True)


@query("knn_predict_item", f"with {ITEM_PRED} select pair_id, user_id, item_id, gold, {r6('pred')} as pred from preds")
def knn_predict_item(spark, sf):
    return item_predictions(spark, sf).withColumn("pred", rounded("pred"))


def _sweep_sql() -> str:
    chains, rows = [TRAIN], []
    for memory, pcc, cosine in ((True, False, True), (True, False, False), (False, False, True), (False, False, False), (False, True, True)):
        row, inner = ("user_id", "item_id") if memory else ("item_id", "user_id")
        tag = f"{int(memory)}{int(pcc)}{int(cosine)}"
        part = _sim("train", row, inner, cosine, _MEAN if pcc else "rating - 3.0") + ", " + _neighbours(500, row)
        names = ("c", "m", "sim", "rs", "both_ways", "n_ids", "signed", "placed", "top")
        for n in names:
            part = part.replace(f"{n} as (", f"{n}_{tag} as (").replace(f"from {n} ", f"from {n}_{tag} ").replace(f"from {n},", f"from {n}_{tag},")
            part = part.replace(f"from {n})", f"from {n}_{tag})").replace(f"join {n} ", f"join {n}_{tag} ").replace(f", {n})", f", {n}_{tag})")
        part = part.replace(f"top_{tag} as (", f"top_{tag} as materialized (")
        chains.append(part)
        for weighted in (True, False):
            for k in (10, 100, 500):
                w = "sim" if weighted else "1.0"
                rows.append(
                    f"""select {memory} as memory, {pcc} as pcc, {weighted} as weighted, {cosine} as cosine, {k} as k,
                    sqrt(avg((coalesce(pred, 3.0) - gold) * (coalesce(pred, 3.0) - gold))) as rmse
                    from pairs left join (
                      select pair_id, sum(w * (t.rating - 3)) + 3 as pred from pairs p
                      join (select row, neighbour, {w} / sum(abs({w})) over (partition by row) as w from top_{tag} where place <= {k}) s
                        on s.row = p.{row} join train t on t.{row} = s.neighbour and t.{inner} = p.{inner} group by 1) using (pair_id)"""
                )
    return f"with {', '.join(chains)} select memory, pcc, weighted, cosine, k, {r6('rmse', 4)} as rmse from ({' union all '.join(rows)})"


@query("knn_sweep", _sweep_sql())
def knn_sweep(spark, sf):
    pairs = cut_lineage(inp.pairs(spark, sf))
    sweep = nb.knn_sweep(inp.train(spark, sf), pairs, pairs.select("pair_id", "gold"))
    return sweep.withColumn("rmse", rounded("rmse", 4))


@query(
    "lookup_predictions",
    f"""with {TRAIN}, preds as (select pair_id, {PRED} as pred from pairs where gold >= 3)
    select p.pair_id, user_id, item_id, gold, coalesce(pred, 3.0) as pred from pairs p left join preds using (pair_id)""",
)
def lookup_predictions(spark, sf):
    known = inp.scored_pairs(spark, sf).filter("gold >= 3").select("pair_id", "pred")
    return nb.lookup_predictions(inp.pairs(spark, sf), known)


# --- measures ----------------------------------------------------------------------------------------------------

SCORED = f"{TRAIN}, scored as (select *, {PRED} as pred from pairs)"


@query("rmse", f"with {SCORED} select {r6('sqrt(avg((pred - gold) * (pred - gold)))')} as rmse from scored")
def rmse(spark, sf):
    return ev.rmse(inp.scored_pairs(spark, sf), inp.gold(spark, sf)).select(rounded("rmse").alias("rmse"))


@query("accuracy", f"with {SCORED} select {r6('avg(case when pred = gold then 1.0 else 0.0 end)')} as accuracy from scored")
def accuracy(spark, sf):
    return ev.accuracy(inp.scored_pairs(spark, sf), inp.gold(spark, sf)).select(rounded("accuracy").alias("accuracy"))


@query(
    "misclassification_rate",
    f"with {SCORED} select {r6('avg(abs(pred - gold))')} as misclassification from scored",
)
def misclassification_rate(spark, sf):
    rate = ev.misclassification_rate(inp.scored_pairs(spark, sf), inp.gold(spark, sf))
    return rate.select(rounded("misclassification").alias("misclassification"))


@query(
    "mse_and_squared_correlation",
    f"""with {SCORED} select {r6('avg((pred - gold) * (pred - gold))')} as mse, {r6('pow(corr(pred, gold), 2)', 9)} as r2 from scored""",
)
def mse_and_squared_correlation(spark, sf):
    fit = ev.mse_and_squared_correlation(inp.scored_pairs(spark, sf), inp.gold(spark, sf))
    return fit.select(rounded("mse").alias("mse"), rounded("r2", 9).alias("r2"))


def _ranked(value: str) -> str:
    return f"""with {SCORED} select pair_id, user_id, item_id, gold, pred,
    cast(row_number() over (partition by user_id order by {value} desc, pair_id) as integer) as rank from scored"""


@query("rank_by_prediction", _ranked("pred"))
def rank_by_prediction(spark, sf):
    return ev.rank_by_prediction(inp.scored_pairs(spark, sf))


@query("rank_by_gold", _ranked("gold"))
def rank_by_gold(spark, sf):
    return ev.rank_by_gold(inp.scored_pairs(spark, sf))


@query(
    "ndcg_at_k",
    f"""with {SCORED},
    p as (select user_id, gold, row_number() over (partition by user_id order by pred desc, pair_id) as pos from scored),
    q as (select user_id, gold, row_number() over (partition by user_id order by gold desc, pair_id) as pos from scored),
    ks as (select unnest([10, 20, 30]) as k),
    d as (select k, user_id, sum((pow(2, gold) - 1) / ln(pos + 1)) as dcg from p join ks on pos <= k group by 1, 2),
    i as (select k, user_id, sum((pow(2, gold) - 1) / ln(pos + 1)) as ideal from q join ks on pos <= k group by 1, 2)
    select k, {r6('avg(dcg / ideal)')} as ndcg from d join i using (k, user_id) group by 1""",
)
def ndcg_at_k(spark, sf):
    return ev.ndcg_at_k(inp.scored_pairs(spark, sf)).select("k", rounded("ndcg").alias("ndcg"))


@query(
    "union_experiments",
    f"""with {SCORED} select 'formula' as run, {r6('sqrt(avg((pred - gold) * (pred - gold)))')} as rmse from scored
    union all select 'neutral', {r6('sqrt(avg((3 - gold) * (3 - gold)))')} from scored
    union all select 'gold', 0.0 from scored group by 1""",
)
def union_experiments(spark, sf):
    from minegrain.operators.sampling import union_experiments as stack

    scored, gold = inp.scored_pairs(spark, sf), inp.gold(spark, sf)
    runs = {"formula": scored, "neutral": scored.withColumn("pred", F.lit(3.0)), "gold": scored.withColumn("pred", F.col("gold"))}
    tables = [
        ev.rmse(frame, gold).select(F.lit(name).alias("run"), rounded("rmse").alias("rmse")) for name, frame in runs.items()
    ]
    return stack(tables)
