"""Evaluation operators on the score columns of the food view."""

from pyspark.sql import functions as F

from larkspur.learning import metrics
from larkspur.plans.registry import query

BEST_SQL = "CAST(list_position(scores, list_max(scores)) AS INTEGER)"
PRED_SQL = "list_transform(embedding, lambda e: CASE WHEN e > 0.05e0 THEN 1 ELSE 0 END)"
SETS_SQL = """SELECT list_filter(range(1, 65), lambda i: y2[i] = 1) AS a,
                     list_filter(range(1, 65), lambda i: embedding[i] > 0.05e0) AS p FROM food_v"""


def predicted_class(t):
    best = F.array_position("scores", F.array_max("scores")).cast("int")
    return t.food.select("vec_id", "class_id", best.alias("pred"))


def predicted_flags(t):
    wide = F.col("embedding").cast("array<double>")
    return t.food.select("vec_id", "y2", F.transform(wide, lambda e: F.when(e > 0.05, 1).otherwise(0)).alias("p2"))


def _rounded(df, digits=6):
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


@query("eval_accuracy", f"""
    SELECT round(avg(CASE WHEN class_id = {BEST_SQL} THEN 1.0e0 ELSE 0.0e0 END), 6) AS accuracy FROM food_v""")
def eval_accuracy(t):
    return _rounded(metrics.accuracy(predicted_class(t), "class_id", "pred"))


@query("eval_multilabel", f"""
    SELECT round(avg(len(list_intersect(a, p)) / nullif(len(list_distinct(list_concat(a, p))), 0)::DOUBLE), 6) AS jaccard,
           round(avg(len(list_intersect(a, p)) / nullif(len(p), 0)::DOUBLE), 6) AS "precision",
           round(avg(len(list_intersect(a, p)) / nullif(len(a), 0)::DOUBLE), 6) AS recall FROM ({SETS_SQL})""")
def eval_multilabel(t):
    flags = predicted_flags(t)
    places = lambda c: F.filter(F.sequence(F.lit(1), F.size(c)), lambda i: F.element_at(c, i) == 1)
    sets = flags.select(places("y2").alias("a"), places("p2").alias("p"))
    return _rounded(metrics.multilabel_scores(sets, "a", "p"))


def _report_sql(cells):
    return f"""
    WITH cells AS ({cells}),
    m AS (SELECT CAST(class AS VARCHAR) AS class, coalesce(hits * 1.0e0 / nullif(predicted, 0), 0) AS p,
                 coalesce(hits * 1.0e0 / nullif(actual, 0), 0) AS r,
                 coalesce(2.0e0 * hits / nullif(predicted + actual, 0), 0) AS f, CAST(actual AS BIGINT) AS support
          FROM cells)
    SELECT class, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1, support FROM m
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM m
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
                     round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m
    UNION ALL SELECT 'micro avg', round(sum(hits) * 1.0e0 / sum(predicted), 6), round(sum(hits) * 1.0e0 / sum(actual), 6),
                     round(2.0e0 * sum(hits) / (sum(predicted) + sum(actual)), 6), CAST(sum(actual) AS BIGINT) FROM cells"""


@query("eval_class_report", _report_sql(f"""
    SELECT class, sum(a * p) AS hits, sum(a) AS actual, sum(p) AS predicted FROM (
        SELECT c AS class, CASE WHEN class_id = c THEN 1 ELSE 0 END AS a, CASE WHEN {BEST_SQL} = c THEN 1 ELSE 0 END AS p
        FROM food_v, (SELECT unnest(range(1, 11)) AS c)) GROUP BY 1"""))
def eval_class_report(t):
    return _rounded(metrics.class_report(predicted_class(t), "class_id", "pred"))


@query("eval_label_report", _report_sql(f"""
    SELECT pos - 1 AS class, sum(a * p) AS hits, sum(a) AS actual, sum(p) AS predicted FROM (
        SELECT unnest(y2) AS a, unnest({PRED_SQL}) AS p, generate_subscripts(y2, 1) AS pos FROM food_v) GROUP BY 1"""))
def eval_label_report(t):
    """The report per ingredient of the indicator arrays."""
    return _rounded(metrics.label_report(predicted_flags(t), "y2", "p2"))


@query("eval_micro_f1", f"""
    WITH s AS (SELECT sum(a * p) AS h, sum(a) AS a, sum(p) AS p
               FROM (SELECT unnest(y2) AS a, unnest({PRED_SQL}) AS p FROM food_v)),
    pr AS (SELECT h / (p + 1e-7) AS p, h / (a + 1e-7) AS r FROM s)
    SELECT round(2 * p * r / (p + r + 1e-7), 6) AS micro_f1 FROM pr""")
def eval_micro_f1(t):
    return _rounded(metrics.micro_f1(predicted_flags(t), "y2", "p2"))


@query("eval_topk_accuracy", """
    SELECT round(avg(CASE WHEN len(list_filter(scores, lambda s, i: s > scores[class_id]
           OR (s = scores[class_id] AND i < class_id))) < 5 THEN 1.0e0 ELSE 0.0e0 END), 6) AS top5_accuracy FROM food_v""")
def eval_topk_accuracy(t):
    return _rounded(metrics.top_k_accuracy(t.food, "scores", F.col("class_id") - 1, 5))


@query("eval_regression", """
    WITH e AS (SELECT price AS y, 200000 + 1000.0e0 * number_of_reviews AS p FROM listings_v)
    SELECT round(sqrt(avg((y - p) * (y - p))), 2) AS rmse, round(avg(abs(y - p)), 2) AS mae,
           round(avg((y - p) * (y - p)) / 1e6, 2) AS mse_millions,
           round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2 FROM e""")
def eval_regression(t):
    rows = t.listings.select(
        F.col("price").alias("y"), (200000 + F.lit(1000.0) * F.col("number_of_reviews")).alias("p")
    )
    found = metrics.regression_scores(rows, "y", "p")
    return found.select(
        F.round("rmse", 2).alias("rmse"),
        F.round("mae", 2).alias("mae"),
        F.round(F.col("mse") / 1e6, 2).alias("mse_millions"),
        F.round("r2", 6).alias("r2"),
    )


@query("eval_log_loss", """
    WITH e AS (SELECT y3, class_id, 1 / (1 + exp(-scores[2])) AS q,
                      list_transform(scores, lambda s: exp(s)) AS w FROM food_v)
    SELECT 'binary' AS kind, round(avg(-ln(greatest(1e-7, least(1 - 1e-7, CASE WHEN y3 = 1 THEN q ELSE 1 - q END)))), 6)
           AS log_loss FROM e
    UNION ALL
    SELECT 'categorical', round(avg(-ln(greatest(1e-7, least(1 - 1e-7, w[class_id] / list_sum(w))))), 6) FROM e""")
def eval_log_loss(t):
    weight = F.transform("scores", F.exp)
    total = F.aggregate(weight, F.lit(0.0), lambda a, w: a + w)
    rows = t.food.select(
        "y3",
        "class_id",
        (1 / (1 + F.exp(-F.col("scores")[1]))).alias("q"),
        F.transform(weight, lambda w: w / total).alias("softmax"),
    )
    binary = metrics.binary_log_loss(rows, "y3", "q").select(F.lit("binary").alias("kind"), "log_loss")
    multi = metrics.categorical_log_loss(rows, F.col("class_id") - 1, "softmax")
    return _rounded(binary.union(multi.select(F.lit("categorical"), "log_loss")))


@query("eval_subset_accuracy", f"""
    SELECT round(avg(CASE WHEN y2 = {PRED_SQL} THEN 1.0e0 ELSE 0.0e0 END), 6) AS subset_accuracy FROM food_v""")
def eval_subset_accuracy(t):
    return _rounded(metrics.subset_accuracy(predicted_flags(t), "y2", "p2"))
