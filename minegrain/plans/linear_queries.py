"""Queries for linear models."""

from __future__ import annotations

from pyspark.sql import functions as F

from minegrain.functions.vectors import rounded
from minegrain.operators import linear as ln
from minegrain.operators import sampling as sm
from minegrain.operators import sga
from minegrain.plans import inputs as inp
from minegrain.plans.inputs import CELLS, ROWS, r6
from minegrain.plans.registry import query
from minegrain.runtime import cut_lineage

DIM = 64


def _given_weights(spark, sf, classes):
    """(class, feature, w): the mean of each feature over the rows of a class."""
    cells = inp.rows(spark, sf).select(F.col("label").alias("class"), F.posexplode("features").alias("at", "value"))
    cells = cells.filter(F.col("class").isin(classes)).withColumn("feature", F.col("at") + 1)
    return cells.groupBy("class", "feature").agg(F.avg("value").alias("w"))


def given_model(spark, sf, labels, loss="logistic"):
    """Model of the given weights; two labels use the weights of class 0."""
    m = [0.0] if len(labels) <= 2 else labels
    weights = _given_weights(spark, sf, m)
    if len(labels) == 2:
        weights = weights.withColumn("class", F.lit(labels[0]))
    return ln.model_from_frame(weights, labels, DIM, loss)


GIVEN = f"""{CELLS},
weights as materialized (
  select label as class, cast(feature + 1 as integer) as feature, avg(value) as w from cells group by 1, 2),
scores as materialized (
  select row_id, label, class, sum(value * w) as z from cells join weights on weights.feature = cells.feature + 1 group by 1, 2, 3),
binary_scores as (select row_id, case when label < 5 then 1.0 else -1.0 end as label, z from scores where class = 0)"""
CLASSES = [float(c) for c in range(10)]


@query("class_counts", f"with {ROWS} select label, count(*) as n from rows group by 1")
def class_counts(spark, sf):
    return ln.class_counts(inp.rows(spark, sf))


@query("append_bias", f"with {ROWS} select row_id, len(features) + 1 as size, {r6('list_sum(features) + 1.0')} as total, 1.0::double as last from rows")
def append_bias(spark, sf):
    wide = ln.append_bias(inp.rows(spark, sf), 1.0)
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    return wide.select("row_id", F.size("features").cast("bigint").alias("size"), rounded(total).alias("total"), F.element_at("features", -1).alias("last"))


@query(
    "one_hot_labels",
    f"with {ROWS} select row_id, c - 1 as position, case when c - 1 = label then 1 else 0 end as flag from rows, range(1, 11) t(c)",
)
def one_hot_labels(spark, sf):
    hot = ln.one_hot_labels(inp.rows(spark, sf))
    return hot.select("row_id", F.posexplode("one_hot").alias("position", "flag")).withColumn("position", F.col("position").cast("bigint"))


@query("decision_values", f"with {GIVEN} select row_id, class, {r6('z')} as value from scores")
def decision_values(spark, sf):
    values = ln.decision_values(inp.rows(spark, sf), given_model(spark, sf, CLASSES))
    return values.withColumn("value", rounded("value"))


@query("sparse_decision_values", f"with {GIVEN} select row_id, class, {r6('z')} as value from scores")
def sparse_decision_values(spark, sf):
    """The same with rows and weights joined by feature."""
    cells = inp.rows(spark, sf).select("row_id", F.posexplode("features").alias("feature", "value"))
    cells = cells.withColumn("feature", F.col("feature") + 1)
    values = ln.sparse_decision_values(cells, _given_weights(spark, sf, CLASSES))
    return values.withColumn("value", rounded("value"))


@query(
    "argmax_class",
    f"""with {GIVEN}, r as (select row_id, class, round(z, 9) as score from scores)
    select row_id, class from r qualify row_number() over (partition by row_id order by score desc, class) = 1""",
)
def argmax_class(spark, sf):
    values = ln.decision_values(inp.rows(spark, sf), given_model(spark, sf, CLASSES))
    return ln.argmax_class(values.select("row_id", "class", F.round("value", 9).alias("score")))


@query(
    "predict_label",
    f"""with {GIVEN} select row_id, label, case when z > 0 then 1.0 else -1.0 end as pred from binary_scores
    union all select row_id + 1000000, label, class as pred from scores
      qualify row_number() over (partition by row_id order by z desc, class) = 1""",
)
def predict_label(spark, sf):
    """Two classes, then ten classes with shifted row ids."""
    two = ln.predict_label(inp.binary_rows(spark, sf), given_model(spark, sf, [1.0, -1.0]))
    ten = ln.predict_label(inp.rows(spark, sf), given_model(spark, sf, CLASSES))
    return two.unionByName(ten.withColumn("row_id", F.col("row_id") + 1_000_000))


@query(
    "predict_probability",
    f"""with {GIVEN}, p as (select row_id, class, 1 / (1 + exp(-z)) as p from scores)
    select row_id, class, {r6('p / sum(p) over (partition by row_id)')} as prob from p
    union all select row_id + 1000000, 1.0, {r6('1 / (1 + exp(-z))')} from binary_scores
    union all select row_id + 1000000, -1.0, {r6('1 - 1 / (1 + exp(-z))')} from binary_scores""",
)
def predict_probability(spark, sf):
    ten = ln.predict_probability(inp.rows(spark, sf), given_model(spark, sf, CLASSES))
    two = ln.predict_probability(inp.binary_rows(spark, sf), given_model(spark, sf, [1.0, -1.0]))
    both = ten.unionByName(two.withColumn("row_id", F.col("row_id") + 1_000_000))
    return both.withColumn("prob", rounded("prob"))


@query(
    "model_coefficients",
    f"""with {GIVEN} select feature, class, {r6('w')} as coef from weights
    union all select 0, cast(c as double), 0.0 from range(10) t(c)""",
)
def model_coefficients(spark, sf):
    coefs = ln.model_coefficients(given_model(spark, sf, CLASSES), spark)
    return coefs.withColumn("coef", rounded("coef"))


@query(
    "start_c",
    f"""with {ROWS}, n as (select list_sum(list_transform(features, lambda x: x * x)) as n2 from rows),
    s as (select count(*) as n, max(n2) as m from n)
    select 'logistic' as loss, pow(2.0, floor(log2(1.0 / (n * m)))) as c from s
    union all select 'squared_hinge', pow(2.0, floor(log2(1.0 / (2 * n * m)))) from s""",
)
def start_c(spark, sf):
    rows = inp.rows(spark, sf)
    return sm.union_experiments(
        [ln.start_c(rows, loss).select(F.lit(loss).alias("loss"), "c") for loss in ("logistic", "squared_hinge")]
    )


@query(
    "predict_hard_soft",
    f"""with {GIVEN}, e as (select row_id, class, exp(z) as e from scores),
    p as (select row_id, class, e / sum(e) over (partition by row_id) as p from e),
    hard as (select row_id, class as hard from p qualify row_number() over (partition by row_id order by p desc, class) = 1)
    select row_id, hard, soft from hard join (select row_id, {r6('sum(p * class)')} as soft from p group by 1) using (row_id)""",
)
def predict_hard_soft(spark, sf):
    pred = sga.predict_hard_soft(inp.rows(spark, sf), given_model(spark, sf, CLASSES, "softmax"))
    return pred.select("row_id", "hard", rounded("soft").alias("soft"))


@query(
    "predict_threshold",
    f"with {GIVEN} select row_id, case when 1 / (1 + exp(-z)) > 0.5 then 1.0 else 0.0 end as pred from binary_scores",
)
def predict_threshold(spark, sf):
    return sga.predict_threshold(inp.rows(spark, sf), given_model(spark, sf, [1.0, 0.0])).select("row_id", "pred")


@query(
    "mean_log_likelihood",
    f"""with {GIVEN} select {r6('avg(case when label > 0 then ln(1 / (1 + exp(-z))) else ln(1 - 1 / (1 + exp(-z))) end)')}
    as log_likelihood from binary_scores""",
)
def mean_log_likelihood(spark, sf):
    rows = inp.binary_rows(spark, sf).withColumn("label", (F.col("label") > 0).cast("double"))
    value = sga.mean_log_likelihood(rows, given_model(spark, sf, [1.0, 0.0]))
    return value.select(rounded("log_likelihood").alias("log_likelihood"))


@query(
    "softmax_objective",
    f"""with {GIVEN}, e as (select row_id, label, class, exp(z) as e from scores),
    p as (select label, class, e / sum(e) over (partition by row_id) as p from e),
    norms as (select sum(n) as n from (select sqrt(sum(w * w)) as n from weights group by class))
    select {r6('(select sum(ln(p)) from p where label = class) - n')} as objective from norms""",
)
def softmax_objective(spark, sf):
    value = sga.softmax_objective(inp.rows(spark, sf), given_model(spark, sf, CLASSES, "softmax"))
    return value.select(rounded("objective").alias("objective"))


# --- stochastic training -----------------------------------------------------------------------------------------

ETA, SHRINK = 0.05, 1.0


def _sga_steps(steps: int) -> str:
    parts = [f"w0 as (select c as class, f as feature, cast(0.5 as double) as w from range(10) a(c), range({DIM}) b(f))"]
    for t in range(1, steps + 1):
        parts.append(
            f"""x{t} as materialized (select row_id, label, feature, value from cells join order_of using (row_id) where pos // half = {t - 1}),
e{t} as materialized (select row_id, label, class, exp(sum(value * w)) as e from x{t} join w{t - 1} using (feature) group by 1, 2, 3),
d{t} as materialized (
  select row_id, class, case when class = label then 1.0 else 0.0 end - e / sum(e) over (partition by row_id) as d from e{t}),
w{t} as materialized (
  select w.class, w.feature, w.w + {ETA} / sqrt({t}) * (g - {SHRINK} * w.w) as w from w{t - 1} w join (
    select class, feature, sum(value * d) as g from x{t} join d{t} using (row_id) group by 1, 2) g using (class, feature))"""
        )
    return ",\n".join(parts)


@query(
    "softmax_sga",
    f"""with {CELLS}, order_of as (
      select row_id, row_number() over (order by row_id) - 1 as pos, (select count(*) from rows) // 2 as half from rows),
    {_sga_steps(2)}
    select cast(class as double) as class, cast(feature + 1 as integer) as feature, {r6('w')} as w from w2""",
)
def softmax_sga(spark, sf):
    """One epoch of two batches over all rows."""
    rows = cut_lineage(inp.rows(spark, sf))
    model = sga.softmax_sga(rows, CLASSES, L=SHRINK, batch=rows.count() // 2, eta0=ETA, epochs=1)
    return model.to_frame(spark).withColumn("w", rounded("w"))


def _frame(model, spark):
    return model.to_frame(spark).withColumn("w", rounded("w", 4))


def _zero_one(spark, sf):
    return inp.binary_rows(spark, sf).withColumn("label", (F.col("label") > 0).cast("double"))


def _sga_places(rows_sql: str, batch: int) -> str:
    """placed (label, x, batch_id, batches): rows of full batches in order of their ids, from (row_id, label, x)."""
    return f"""placed as materialized (
      select label, x, i // {batch} as batch_id, n // {batch} as batches from (
        select label, x, row_number() over (order by row_id) - 1 as i, count(*) over () as n from ({rows_sql}))
      where i // {batch} < n // {batch})"""


def _logistic_steps(batch: int, epochs: int) -> str:
    """steps (t, w): weights of the two-class model after t batches, by recursion; x ends with the bias feature."""
    return f"""steps(t, w) as (
      select 0, list_transform(range({DIM + 1}), lambda i: cast(0.5 as double))
      union all
      select t + 1, list(w[f] + 0.5 / sqrt(t + 1) * g / {batch} order by f) from (
        select t, w, f, sum(d * x[f]) as g from (
          select t, w, x, label - 1 / (1 + exp(-list_dot_product(x, w))) as d
          from steps join placed on batch_id = t % batches where t < {epochs} * batches),
          range(1, {DIM + 2}) c(f)
        group by t, w, f)
      group by t)"""


_ZERO_ONE = "select row_id, case when label < 5 then 1.0 else 0.0 end as label, list_append(features, 1.0) as x"


@query(
    "binary_logreg_sga",
    f"""with recursive {ROWS}, {_sga_places(f"{_ZERO_ONE} from rows", 100)}, {_logistic_steps(100, 5)},
    final as (select w from steps order by t desc limit 1)
    select cast(1 as double) as class, cast(f as integer) as feature, {r6('w[f]', 4)} as w from final, range(1, {DIM + 2}) c(f)""",
)
def binary_logreg_sga(spark, sf):
    return _frame(sga.binary_logreg_sga(_zero_one(spark, sf), batch=100), spark)


@query(
    "pairwise_logreg",
    f"""with recursive {ROWS}, {_sga_places("select row_id, case when label < 5 then 1 else 0 end as label, features as x from rows", 100)},
    steps(t, u, v) as (
      select 0, list_transform(range({DIM}), lambda i: cast(0.5 as double)), list_transform(range({DIM}), lambda i: cast(0.5 as double))
      union all
      select t + 1, list(u[f] + 0.01 / sqrt(t + 1) * (-g - u[f]) order by f), list(v[f] + 0.01 / sqrt(t + 1) * (g - v[f]) order by f) from (
        select t, u, v, f, sum(d * x[f]) as g from (
          select t, u, v, x, label - 1 / (1 + exp(list_dot_product(x, u) - list_dot_product(x, v))) as d
          from steps join placed on batch_id = t % batches where t < 100 * batches),
          range(1, {DIM + 1}) c(f)
        group by t, u, v, f)
      group by t),
    final as (select u, v from steps order by t desc limit 1)
    select cast(-1 as double) as class, cast(f as integer) as feature, {r6('u[f]', 4)} as w from final, range(1, {DIM + 1}) c(f)
    union all
    select 1.0, cast(f as integer), {r6('v[f]', 4)} from final, range(1, {DIM + 1}) c(f)""",
)
def pairwise_logreg(spark, sf):
    return _frame(sga.pairwise_logreg(inp.binary_rows(spark, sf), L=1.0, batch=100, eta0=0.01), spark)


@query(
    "learning_curve",
    f"""with recursive {ROWS}, drawn as (
      select *, {" + ".join(f"cast(u < {t!r} as integer)" for t in sm.poisson_tails(0.2))} as draws
      from (select *, {inp.uniform_sql(5, 'row_id')} as u from rows)),
    sides as materialized (
      {_ZERO_ONE}, draws = 0 as train from drawn where draws = 0
      union all {_ZERO_ONE}, false from (select *, unnest(range(draws)) from drawn where draws > 0)),
    {_sga_places("select row_id, label, x from sides where train", 100)}, {_logistic_steps(100, 5)},
    errors as (
      select t - 1 as step, train, avg(abs(cast(list_dot_product(x, w) > 0 as integer) - label)) as err
      from (select * from steps where t > 0 and (t - 1) % 3 = 0), sides group by 1, 2)
    select cast(step as integer) as step, {r6('max(err) filter (train)')} as train_err, {r6('max(err) filter (not train)')} as test_err
    from errors group by step""",
)
def learning_curve(spark, sf):
    train, test = sm.holdout_split(_zero_one(spark, sf), 0.2, seed=5)
    curve = sga.learning_curve(cut_lineage(train), cut_lineage(test), every=3, batch=100)
    return curve.withColumn("train_err", rounded("train_err")).withColumn("test_err", rounded("test_err"))


@query(
    "linear_objective",
    f"""with {GIVEN}, y as (select z, label as y from binary_scores), pen as (select sum(w * w) / 2 as p from weights where class = 0)
    select 'logistic' as loss, {r6('max(p) + 0.5 * sum(ln(1 + exp(-y * z)))')} as objective from y, pen
    union all select 'hinge', {r6('max(p) + 0.5 * sum(greatest(0, 1 - y * z))')} from y, pen
    union all select 'squared_hinge', {r6('max(p) + 0.5 * sum(pow(greatest(0, 1 - y * z), 2))')} from y, pen
    union all select 'eps', {r6('max(p) + 0.5 * sum(greatest(0, abs(y - z) - 0.1))')} from y, pen
    union all select 'squared_eps', {r6('max(p) + 0.5 * sum(pow(greatest(0, abs(y - z) - 0.1), 2))')} from y, pen""",
)
def linear_objective(spark, sf):
    """Objective of every loss at given weights."""
    rows, tables = cut_lineage(inp.binary_rows(spark, sf)), []
    for loss in ("logistic", "hinge", "squared_hinge", "eps", "squared_eps"):
        model = given_model(spark, sf, [1.0, -1.0] if "eps" not in loss else [], loss)
        value = ln.objective_frame(rows, model, C=0.5, p=0.1)
        tables.append(value.select(F.lit(loss).alias("loss"), rounded("objective").alias("objective")))
    return sm.union_experiments(tables)


# --- batch training ----------------------------------------------------------------------------------------------

C = 0.5


def _register_fit(name, rows, fit):
    @query(name)
    def run(spark, sf):
        return _frame(fit(cut_lineage(rows(spark, sf))), spark)


for _name, _rows, _fit in (
    ("linear_l2_logistic", inp.binary_rows, lambda r: ln.linear_l2_logistic(r, C)),
    ("linear_l1_logistic", inp.binary_rows, lambda r: ln.linear_l1_logistic(r, C)),
    ("linear_l2_squared_hinge", inp.binary_rows, lambda r: ln.linear_l2_squared_hinge(r, C, bias=1.0)),
    ("linear_l2_hinge", inp.binary_rows, lambda r: ln.linear_l2_hinge(r, C)),
    ("linear_l1_squared_hinge", inp.binary_rows, lambda r: ln.linear_l1_squared_hinge(r, C)),
    ("multiclass_crammer_singer", inp.rows, lambda r: ln.multiclass_crammer_singer(r, C)),
    ("svr_squared_eps", inp.regression_rows, lambda r: ln.svr_squared_eps(r, C, p=0.02)),
    ("svr_eps", inp.regression_rows, lambda r: ln.svr_eps(r, C, p=0.02)),
    ("one_vs_rest", inp.rows, lambda r: ln.one_vs_rest(r, "logistic", C)),
):
    _register_fit(_name, _rows, _fit)


@query(
    "class_weights",
    f"with {ROWS} select row_id, label, case label when 0 then 3.0 when 4 then 0.5 else 1.0 end as weight from rows",
)
def class_weights(spark, sf):
    return ln.class_weights(inp.rows(spark, sf), {0.0: 3.0, 4.0: 0.5}).select("row_id", "label", "weight")


@query("class_weighted_fit")
def class_weighted_fit(spark, sf):
    rows = cut_lineage(inp.binary_rows(spark, sf))
    return _frame(ln.linear_l2_squared_hinge(rows, C, class_weight={1.0: 3.0}), spark)


@query("cross_validate")
def cross_validate(spark, sf):
    pred, _ = ln.cross_validate(cut_lineage(inp.rows(spark, sf)), "squared_hinge", n=5, C=C)
    return pred


@query("search_c")
def search_c(spark, sf):
    return ln.search_c(cut_lineage(inp.binary_rows(spark, sf)), "logistic", n=5)[2]


# --- splits ------------------------------------------------------------------------------------------------------

_TAILS = " + ".join(f"cast(u < {t!r} as integer)" for t in sm.poisson_tails(0.2))


@query(
    "holdout_split",
    f"""with {inp.ROWS}, drawn as (select row_id, {_TAILS} as n from (select row_id, {inp.uniform_sql(5, 'row_id')} as u from rows))
    select row_id, 'train' as part from drawn where n = 0
    union all select row_id, 'validation' as part from (select row_id, unnest(range(n)) from drawn where n > 0)""",
)
def holdout_split(spark, sf):
    train, validation = sm.holdout_split(inp.rows(spark, sf), 0.2, seed=5)
    return train.select("row_id", F.lit("train").alias("part")).unionByName(
        validation.select("row_id", F.lit("validation").alias("part"))
    )


@query(
    "minibatches",
    f"""with {ROWS}, i as (select row_id, row_number() over (order by row_id) - 1 as i from rows)
    select row_id, cast(i // 32 as integer) as batch_id from i where i // 32 < (select count(*) from rows) // 32""",
)
def minibatches(spark, sf):
    return sm.minibatches(inp.rows(spark, sf), 32).select("row_id", "batch_id")


@query(
    "cv_folds",
    f"""with {inp.ROWS}, placed as (
      select row_id, row_number() over (order by md5('1|' || row_id), row_id) - 1 as i, count(*) over () as n from rows)
    select row_id, cast(((i + 1) * 7 - 1) // n as integer) as fold from placed""",
)
def cv_folds(spark, sf):
    return sm.cv_folds(inp.rows(spark, sf), 7, seed=1).select("row_id", "fold")
