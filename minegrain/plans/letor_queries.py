"""Queries for learning to rank."""

from __future__ import annotations

from pyspark.sql import functions as F

from minegrain.functions.vectors import rounded
from minegrain.operators import letor as lt
from minegrain.plans import inputs as inp
from minegrain.plans.factor_queries import DIM, GIVEN, given_factors
from minegrain.plans.inputs import RATINGS, TRAIN, r6
from minegrain.plans.registry import query
from minegrain.runtime import cut_lineage


@query("filter_extreme_ratings", f"with {RATINGS} select user_id, item_id, rating from ratings where rating in (1.0, 5.0)")
def filter_extreme_ratings(spark, sf):
    return lt.filter_extreme_ratings(inp.ratings(spark, sf)).drop("ts")


@query(
    "preference_self_join",
    f"""with {RATINGS} select a.user_id, a.item_id as item_x, a.rating as rating_x, b.item_id as item_y, b.rating as rating_y
    from ratings a join ratings b on a.user_id = b.user_id and a.item_id < b.item_id and a.rating <> b.rating""",
)
def preference_self_join(spark, sf):
    return lt.preference_self_join(inp.ratings(spark, sf))


_X = f"""x as materialized (
  select user_id, item_id, u.j, u.f * v.f as x from {{source}} join u on u.id = user_id join v on v.id = item_id and v.j = u.j)"""


def _columns(name="x"):
    return [rounded(F.col(name)[j]).alias(f"x{j}") for j in range(DIM)]


_PIVOT = ", ".join(f"{r6(f'sum(case when j = {j} then {{0}} end)')} as x{j}" for j in range(DIM))


@query(
    "latent_pair_features",
    f"with {TRAIN}, {GIVEN}, {_X.format(source='pairs')} select user_id, item_id, {_PIVOT.format('x')} from x group by 1, 2",
)
def latent_pair_features(spark, sf):
    latent = lt.latent_pair_features(inp.pairs(spark, sf), *given_factors(spark, sf))
    return latent.select("user_id", "item_id", *_columns())


@query(
    "pairwise_training_set",
    f"""with {TRAIN}, {GIVEN}, extreme as (select * from train where rating in (1.0, 5.0)), {_X.format(source='extreme')},
    prefs as (select a.user_id, a.item_id as item_x, b.item_id as item_y, sign(a.rating - b.rating) as y
      from extreme a join extreme b on a.user_id = b.user_id and a.item_id < b.item_id and a.rating <> b.rating)
    select p.user_id, item_x, item_y, cast(any_value(y) as double) as y, {_PIVOT.format('a.x - b.x').replace('case when j', 'case when a.j')}
    from prefs p join x a on a.user_id = p.user_id and a.item_id = item_x
    join x b on b.user_id = p.user_id and b.item_id = item_y and b.j = a.j group by 1, 2, 3""",
)
def pairwise_training_set(spark, sf):
    rows = lt.pairwise_training_set(inp.train(spark, sf), *given_factors(spark, sf))
    return rows.select("user_id", "item_x", "item_y", "y", *_columns())


@query("rank_svm")
def rank_svm(spark, sf):
    scored = lt.rank_svm(inp.train(spark, sf), inp.pairs(spark, sf), *given_factors(spark, sf))
    return scored.withColumn("score", rounded("score", 5))


@query("rank_logistic")
def rank_logistic(spark, sf):
    """One epoch of four batches."""
    users, items = given_factors(spark, sf)
    train = cut_lineage(inp.train(spark, sf))
    preferences = lt.preference_count(train)
    scored = lt.rank_logistic(train, inp.pairs(spark, sf), users, items, batch=preferences // 4, epochs=1)
    return scored.withColumn("score", rounded("score", 5))
