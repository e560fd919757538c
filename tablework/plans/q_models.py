"""Model, evaluation, tuning and recommendation queries."""

from __future__ import annotations

from pyspark.ml import evaluation as ev
from pyspark.ml import feature as mf
from pyspark.sql import functions as F

from ..functions.common import r
from ..ml import evaluate, features as fx, inner_product, models, recommend, ridge, trees, tuning
from ..operators import order, splits
from ..session import stage
from ..tables import load
from .derived import RATINGS_SQL, SHARES, doc_features, ratings
from .registry import QUERIES, query

_BUCKET = "((({k}) * 2654435761 + 12345) % 4294967296) % {n}"

NUMERIC_DOC = ["n_spaces", "n_lines", "n_digits", "n_chars", *SHARES]


def _docs(spark, sf):
    """Labelled documents with numeric text features and a hash split, derived
    from the texts once and staged: fits, folds and grid points read them back."""
    return stage(splits.hash_split(doc_features(spark, sf), "doc_id", [8.0, 2.0]), "doc-features")


def _train_test(df):
    return df.filter("split = 0"), df.filter("split = 1")


def _assembler(cols, out="features"):
    return mf.VectorAssembler(inputCols=cols, outputCol=out)


def _embeddings(spark, sf):
    """Vectors labelled by the tenth of its range that the first number lies in (the tables' labels do not depend on them)."""
    e = load(spark, sf, "embeddings").select("vec_id", fx.from_array("embedding").alias("features"), F.get("embedding", F.lit(0)).alias("first"))
    low, high = e.agg(F.min("first"), F.max("first")).first()
    tenth = F.greatest(F.lit(0.0), F.least(F.lit(9.0), F.floor((F.col("first") - low) / (high - low) * 10).cast("double")))
    return splits.hash_split(e.withColumn("label", tenth).drop("first"), "vec_id", [8.0, 2.0])


def _lines(spark, sf):
    """Lines labelled by quantity times retail price (their own price does not depend on the features)."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                            "l_discount", "l_tax")
    p = load(spark, sf, "part").select("p_partkey", "p_retailprice", F.col("p_size").cast("double"))
    df = li.join(p, li.l_partkey == p.p_partkey).withColumn("label", (F.col("l_quantity") * F.col("p_retailprice")).cast("double"))
    return stage(splits.hash_split(df, "l_orderkey", [8.0, 2.0]), "line-features", most=500_000)


_LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


# --- supervised models: the numbers of a fit are beyond SQL; ``<name>_holds`` checks the same fit ---

def _doc_model(kind: str, spark, sf, stages=None, scaled: bool = False, **params):
    """Scored test documents."""
    train, test = _train_test(_docs(spark, sf))
    est = models.estimator(kind, **params)
    made = stages or ([_assembler(NUMERIC_DOC, "raw"), mf.StandardScaler(inputCol="raw", outputCol="features")] if scaled
                      else [_assembler(NUMERIC_DOC)])
    return models.fit_predict([*made, est], train, test)[1]


def _line_model(kind: str, spark, sf, **params):
    train, test = _train_test(_lines(spark, sf))
    return models.fit_predict([_assembler(_LINE_FEATURES), models.estimator(kind, **params)], train, test)[1]


def _tree_binary(spark, sf):
    return _doc_model("tree_classifier", spark, sf, maxDepth=5, impurity="gini", maxBins=32, seed=42)


def _tree_multi(spark, sf):
    train, test = _train_test(_embeddings(spark, sf))
    est = models.estimator("tree_classifier", maxDepth=8, impurity="entropy", maxBins=32, seed=42)
    return models.fit_predict([est], train, test)[1]


def _logistic(spark, sf):
    return _doc_model("logistic", spark, sf, scaled=True, maxIter=50, regParam=0.01)


def _svm(spark, sf):
    return _doc_model("svm", spark, sf, scaled=True, maxIter=50, regParam=0.01)


def _forest_binary(spark, sf):
    return _doc_model("forest_classifier", spark, sf, numTrees=10, maxDepth=5, seed=42)


def _pipeline(spark, sf):
    return _doc_model("forest_classifier", spark, sf, _category_stages(), numTrees=10, maxDepth=5, seed=42)


def _tree_regression(spark, sf):
    return _line_model("tree_regressor", spark, sf, maxDepth=6, maxBins=32, seed=42)


def _forest_regression(spark, sf):
    return _line_model("forest_regressor", spark, sf, numTrees=10, maxDepth=6, seed=42)


def _gbt(spark, sf):
    return _line_model("gbt_regressor", spark, sf, maxIter=10, maxDepth=4, seed=42)


@query("ml_tree_binary")
def ml_tree_binary(spark, sf):
    return _tree_binary(spark, sf).select("doc_id", "label", "prediction")


@query("ml_tree_multi")
def ml_tree_multi(spark, sf):
    return _tree_multi(spark, sf).select("vec_id", "label", "prediction")


@query("ml_tree_regression")
def ml_tree_regression(spark, sf):
    return _tree_regression(spark, sf).select(*_LINE_KEYS, r("prediction").alias("prediction"))


@query("ml_logistic")
def ml_logistic(spark, sf):
    return _logistic(spark, sf).select("doc_id", "prediction", r(fx.to_array("probability")[1], 6).alias("p1"))


@query("ml_svm")
def ml_svm(spark, sf):
    return _svm(spark, sf).select("doc_id", "prediction")


_NB_FEATURES = ["n_spaces", "n_lines", "n_digits"]
_NB_SQL = """
WITH d AS (
  SELECT CAST(quality AS DOUBLE) AS label,
         CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS f0,
         CAST(length(text) - length(replace(text, chr(10), '')) AS DOUBLE) AS f1,
         CAST(length(regexp_replace(text, '[^0-9]', '', 'g')) AS DOUBLE) AS f2
  FROM documents JOIN labels USING (doc_id)),
cls AS (SELECT label, count(*) AS n, sum(f0) AS s0, sum(f1) AS s1, sum(f2) AS s2 FROM d GROUP BY label),
tot AS (SELECT count(*) AS nn, count(DISTINCT label) AS cc FROM d)
SELECT label, -1 AS j, 'pi' AS kind, round(ln(n + 1.0) - ln(nn + cc * 1.0), 6) AS value FROM cls, tot
UNION ALL SELECT label, 0, 'theta', round(ln(s0 + 1.0) - ln(s0 + s1 + s2 + 3.0), 6) FROM cls
UNION ALL SELECT label, 1, 'theta', round(ln(s1 + 1.0) - ln(s0 + s1 + s2 + 3.0), 6) FROM cls
UNION ALL SELECT label, 2, 'theta', round(ln(s2 + 1.0) - ln(s0 + s1 + s2 + 3.0), 6) FROM cls"""


@query("ml_naive_bayes", _NB_SQL)
def ml_naive_bayes(spark, sf):
    d = _docs(spark, sf)
    est = models.estimator("naive_bayes", smoothing=1.0, modelType="multinomial")
    model, _ = models.fit_predict([_assembler(_NB_FEATURES), est], d)
    return models.naive_bayes_params(spark, model.stages[-1])


@query("ml_forest_binary")
def ml_forest_binary(spark, sf):
    return _forest_binary(spark, sf).select("doc_id", "prediction")


@query("ml_forest_regression")
def ml_forest_regression(spark, sf):
    return _forest_regression(spark, sf).select(*_LINE_KEYS, r("prediction").alias("prediction"))


@query("ml_gbt")
def ml_gbt(spark, sf):
    return _gbt(spark, sf).select(*_LINE_KEYS, r("prediction").alias("prediction"))


def _category_stages():
    return [mf.StringIndexer(inputCols=["lang", "source"], outputCols=["lang_i", "source_i"],
                             handleInvalid="keep"),
            mf.OneHotEncoder(inputCols=["lang_i", "source_i"], outputCols=["lang_v", "source_v"]),
            _assembler(["lang_v", "source_v", *NUMERIC_DOC])]


@query("ml_pipeline")
def ml_pipeline(spark, sf):
    return _pipeline(spark, sf).select("doc_id", "prediction")


# Fixed display labels for the binary quality prediction.
QUALITY_LABELS = {0.0: "low quality", 1.0: "good quality"}


@query("ml_score_labels")
def ml_score_labels(spark, sf):
    return models.decode_prediction(_tree_binary(spark, sf), "prediction", QUALITY_LABELS, "verdict").select("doc_id", "verdict")


# --- evaluation (closed-form oracles) ------------------------------------------------

@query("eval_error_report", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(abs(l_extendedprice - l_quantity * p_retailprice), 4) AS error
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def eval_error_report(spark, sf):
    li = load(spark, sf, "lineitem")
    p = load(spark, sf, "part")
    d = li.join(p, li.l_partkey == p.p_partkey).select(
        *_LINE_KEYS, F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("prediction"))
    return evaluate.error_report(d).select(*_LINE_KEYS, r("error").alias("error"))


def _label_pairs(spark, sf):
    return load(spark, sf, "labels").select(F.col("quality").cast("double").alias("label"),
                                            F.col("toxic").cast("double").alias("prediction"))


@query("eval_auc_hard", """
SELECT round((1 + (count(*) FILTER (WHERE quality = 1 AND toxic = 1))::DOUBLE / count(*) FILTER (WHERE quality = 1)
              - (count(*) FILTER (WHERE quality = 0 AND toxic = 1))::DOUBLE / count(*) FILTER (WHERE quality = 0))
             / 2, 6) AS auc
FROM labels""")
def eval_auc_hard(spark, sf):
    auc = evaluate.binary_metric(_label_pairs(spark, sf), "label", "prediction", "areaUnderROC")
    return evaluate.metrics_frame(spark, {"auc": auc})


@query("eval_auc", """
WITH d AS (SELECT quality AS y, CAST(n_chars AS DOUBLE) AS s FROM documents JOIN labels USING (doc_id)),
rk AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM d),
a AS (SELECT sum(rk) FILTER (WHERE y = 1) AS r1, count(*) FILTER (WHERE y = 1) AS n1,
             count(*) FILTER (WHERE y = 0) AS n0 FROM rk)
SELECT round((r1 - n1 * (n1 + 1) / 2.0) / (n1 * n0), 6) AS auc FROM a""")
def eval_auc(spark, sf):
    d = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id").select(
        F.col("quality").cast("double").alias("label"), F.col("n_chars").cast("double").alias("score"))
    return evaluate.metrics_frame(spark, {"auc": evaluate.binary_metric(d, "label", "score")})


@query("eval_auc_pr", """
WITH d AS (SELECT quality AS y, CAST(n_chars AS DOUBLE) AS s FROM documents JOIN labels USING (doc_id)),
t AS (SELECT s, sum(y) AS p, count(*) - sum(y) AS n FROM d GROUP BY s),
c AS (SELECT s, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS fp FROM t),
q AS (SELECT s, tp::DOUBLE / (SELECT sum(y) FROM d) AS rec, tp::DOUBLE / (tp + fp) AS prec FROM c),
w AS (SELECT rec, prec, lag(rec, 1, 0.0) OVER (ORDER BY s DESC) AS rec0,
             coalesce(lag(prec) OVER (ORDER BY s DESC), prec) AS prec0 FROM q)
SELECT round(sum((rec - rec0) * (prec + prec0) / 2), 6) AS auc_pr FROM w""")
def eval_auc_pr(spark, sf):
    d = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id").select(
        F.col("quality").cast("double").alias("label"), F.col("n_chars").cast("double").alias("score"))
    return evaluate.metrics_frame(spark, {"auc_pr": evaluate.binary_metric(d, "label", "score", "areaUnderPR")})


@query("eval_accuracy_f1", """
WITH d AS (SELECT CAST(quality AS DOUBLE) AS y, CAST(toxic AS DOUBLE) AS p FROM labels),
n AS (SELECT count(*) AS n FROM d),
cls AS (SELECT y AS c, count(*) AS actual FROM d GROUP BY y),
pred AS (SELECT p AS c, count(*) AS predicted FROM d GROUP BY p),
tp AS (SELECT y AS c, count(*) AS tp FROM d WHERE y = p GROUP BY y),
f AS (SELECT c, actual, coalesce(predicted, 0) AS predicted, coalesce(tp, 0) AS tp
      FROM cls LEFT JOIN pred USING (c) LEFT JOIN tp USING (c)),
m AS (SELECT c, actual, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS prec, tp / actual AS rec FROM f)
SELECT round((SELECT count(*) FROM d WHERE y = p)::DOUBLE / (SELECT n FROM n), 6) AS accuracy,
       round(sum(actual::DOUBLE / (SELECT n FROM n)
                 * CASE WHEN prec + rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END), 6) AS f1
FROM m""")
def eval_accuracy_f1(spark, sf):
    d = _label_pairs(spark, sf)
    return evaluate.metrics_frame(spark, {
        "accuracy": evaluate.multiclass_metric(d, "label", "prediction", "accuracy"),
        "f1": evaluate.multiclass_metric(d, "label", "prediction", "f1")})


@query("eval_regression", """
WITH d AS (SELECT l_extendedprice AS y, l_quantity * p_retailprice AS p
           FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
       round(1 - sum((y - p) * (y - p)) / sum((y - (SELECT avg(y) FROM d)) * (y - (SELECT avg(y) FROM d))), 6) AS r2,
       round(avg(abs(y - p)), 6) AS mae
FROM d""")
def eval_regression(spark, sf):
    li = load(spark, sf, "lineitem")
    p = load(spark, sf, "part")
    d = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * F.col("p_retailprice")).alias("prediction"))
    return evaluate.regression_metrics(d, "label", "prediction")


# --- tuning (rows-only) ----------------------------------------------------------------

def _auc_evaluator():
    return ev.BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                            metricName="areaUnderROC")


@query("tune_sweep")
def tune_sweep(spark, sf):
    train, valid = _train_test(_docs(spark, sf))
    est = models.estimator("tree_classifier", seed=42)
    return tuning.sweep(spark, [_assembler(NUMERIC_DOC)], est, "maxDepth", [2, 4, 6], _auc_evaluator(),
                        train, valid).drop("seconds")


@query("tune_grid")
def tune_grid(spark, sf):
    train, valid = _train_test(_docs(spark, sf))
    est = models.estimator("tree_classifier", seed=42)
    return tuning.grid(spark, [_assembler(NUMERIC_DOC)], est, {"maxDepth": [3, 5], "impurity": ["gini", "entropy"]},
                       _auc_evaluator(), train, valid).drop("seconds")


@query("tune_tvs")
def tune_tvs(spark, sf):
    d = _docs(spark, sf)
    est = models.estimator("forest_classifier", seed=42)
    t = tuning.tvs([_assembler(NUMERIC_DOC)], est, {"numTrees": [5, 10]}, _auc_evaluator(), 0.8)
    m = t.fit(d)
    return tuning.results(spark, m, m.validationMetrics)


@query("tune_cv")
def tune_cv(spark, sf):
    d = _docs(spark, sf)
    est = models.estimator("logistic", maxIter=20)
    c = tuning.cv([_assembler(NUMERIC_DOC)], est, {"regParam": [0.01, 0.1]}, _auc_evaluator(), folds=3)
    m = c.fit(d)
    return tuning.results(spark, m, m.avgMetrics)


@query("tune_best")
def tune_best(spark, sf):
    d = _lines(spark, sf)
    train, valid = _train_test(d)
    est = models.estimator("tree_regressor", seed=42)
    e = ev.RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse")
    table = tuning.grid(spark, [_assembler(_LINE_FEATURES)], est, {"maxDepth": [3, 6]}, e, train, valid)
    return tuning.best(table, e.isLargerBetter()).drop("seconds")


_RIDGE = ["l_quantity", "l_discount", "p_size"]
_PENALTIES = [0.0, 10.0, 1000.0]


def _ridge_sql() -> str:
    """Ridge for each fold and penalty by Cramer's rule over centred sums."""
    x = ["l_quantity", "l_discount", "CAST(p_size AS DOUBLE)"]
    y = "l_extendedprice / 1000"
    sums = [f"sum({a}) AS s{i}" for i, a in enumerate(x)] + [f"sum({y}) AS sy", f"sum({y} * {y}) AS yy", "count(*) AS n"]
    sums += [f"sum({x[i]} * {x[j]}) AS x{i}{j}" for i in range(3) for j in range(i, 3)] + [f"sum({a} * {y}) AS xy{i}" for i, a in enumerate(x)]
    names = [c.rsplit(" AS ", 1)[1] for c in sums]
    rest = ", ".join(f"t.{c} - g.{c} AS {c}" for c in names)
    held = ", ".join(f"g.{c} AS v_{c}" for c in names)
    a = [[f"(x{min(i, j)}{max(i, j)} - s{i} * s{j} / n" + (" + penalty)" if i == j else ")") for j in range(3)] for i in range(3)]
    b = [f"(xy{i} - s{i} * sy / n)" for i in range(3)]

    def det(m):
        return (f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]}) - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]})"
                f" + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))")

    w = ", ".join(f"{det([[b[i] if j == k else a[i][j] for j in range(3)] for i in range(3)])} / {det(a)} AS w{k}" for k in range(3))
    sse = ("v_yy - 2 * (c * v_sy + w0 * v_xy0 + w1 * v_xy1 + w2 * v_xy2) + c * c * v_n + 2 * c * (w0 * v_s0 + w1 * v_s1 + w2 * v_s2)"
           " + w0 * w0 * v_x00 + w1 * w1 * v_x11 + w2 * w2 * v_x22 + 2 * (w0 * w1 * v_x01 + w0 * w2 * v_x02 + w1 * w2 * v_x12)")
    return f"""
WITH g AS (SELECT CAST({_BUCKET.format(k='l_orderkey', n=5)} AS INTEGER) AS fold, {', '.join(sums)}
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
t AS (SELECT {', '.join(f'sum({c}) AS {c}' for c in names)} FROM g),
r AS (SELECT fold, penalty, {rest}, {held} FROM g, t, (SELECT unnest({_PENALTIES}) AS penalty)),
w AS (SELECT *, {w} FROM r),
c AS (SELECT *, (sy - w0 * s0 - w1 * s1 - w2 * s2) / n AS c FROM w),
cv AS (SELECT fold, CAST(penalty AS DOUBLE) AS penalty, CAST(n AS BIGINT) AS n_train, round(c, 6) AS intercept, round(w0, 6) AS w_l_quantity,
              round(w1, 6) AS w_l_discount, round(w2, 6) AS w_p_size, round(sqrt(({sse}) / v_n), 6) AS rmse FROM c)
"""


def _ridge_folds(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_extendedprice")
    rows = li.join(load(spark, sf, "part").select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.withColumn("fold", splits.hash_bucket("l_orderkey", 5)).withColumn("price", F.col("l_extendedprice") / 1000)
    return ridge.cross_validate(rows, _RIDGE, "price", "fold", _PENALTIES)


@query("tune_ridge_cv", _ridge_sql() + "SELECT * FROM cv")
def tune_ridge_cv(spark, sf):
    """Five folds and three penalties, solved from one scan's sums of products."""
    return _ridge_folds(spark, sf)


@query("tune_ridge_best", _ridge_sql() + """
SELECT penalty, round(avg(rmse), 5) AS rmse FROM cv GROUP BY penalty ORDER BY avg(rmse), penalty DESC LIMIT 1""")
def tune_ridge_best(spark, sf):
    return ridge.best(_ridge_folds(spark, sf)).withColumn("rmse", F.round("rmse", 5))


# --- recommendation --------------------------------------------------------------------

def _ratings_split(spark, sf):
    """Ratings by dense 32-bit user and item numbers with a hash split, and the two number tables."""
    rt = stage(ratings(spark, sf).select(F.col("user").alias("user_id"), F.col("item").alias("item_id"),
                                         F.col("rating").cast("float").alias("rating")), "ratings")
    users, items = recommend.index_ids(rt, "user_id", "user"), recommend.index_ids(rt, "item_id", "item")
    # the bucket depends on the key modulo 2^32 alone
    pair_key = F.pmod("user_id", F.lit(1 << 32)) * 7919 + F.pmod("item_id", F.lit(1 << 32))
    rt = recommend.with_ids(rt, users, items).withColumn("split", F.when(splits.hash_bucket(pair_key, 10) < 8, 0).otherwise(1))
    return stage(rt, "ratings-indexed"), users, items


def _named(df, users, items):
    """Numbers back to ids."""
    return df.join(users, "user").join(items, "item").drop("user", "item") \
        .withColumnsRenamed({"user_id": "user", "item_id": "item"})


@query("als_fit")
def als_fit(spark, sf):
    rt, _, _ = _ratings_split(spark, sf)
    model = recommend.als(rank=5, max_iter=5).fit(rt)
    return model.transform(rt).select(F.col("user_id").alias("user"), F.col("item_id").alias("item"),
                                      r("prediction").alias("prediction"))


def _active(rt, c, k=10):
    counts = rt.groupBy(c, f"{c}_id").agg(F.count(F.lit(1)).alias("n"))
    return order.top_k(counts, k, [("n", "desc"), f"{c}_id"]).select(c)


@query("als_top_items")
def als_top_items(spark, sf):
    rt, users, items = _ratings_split(spark, sf)
    model = recommend.als(rank=5, max_iter=5).fit(rt)
    top = _named(recommend.top_items(model, _active(rt, "user"), 5), users, items)
    titles = load(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.col("p_name").alias("title"))
    return top.join(titles, "item", "left").select("user", "item", "title", r("score").alias("score"))


@query("als_top_users")
def als_top_users(spark, sf):
    rt, users, items = _ratings_split(spark, sf)
    model = recommend.als(rank=5, max_iter=5).fit(rt)
    top = _named(recommend.top_users(model, _active(rt, "item"), 5), users, items)
    return top.select("item", "user", r("score").alias("score"))


@query("als_rmse")
def als_rmse(spark, sf):
    rt, _, _ = _ratings_split(spark, sf)
    train, test = rt.filter("split = 0"), rt.filter("split = 1")
    model = recommend.als(rank=5, max_iter=5).fit(train)
    return recommend.rmse(model, test).withColumn("rmse", r("rmse"))


@query("als_tune")
def als_tune(spark, sf):
    rt, _, _ = _ratings_split(spark, sf)
    e = ev.RegressionEvaluator(labelCol="rating", predictionCol="prediction", metricName="rmse")
    est = recommend.als(max_iter=5, blocks=recommend.blocks_of(rt))
    t = tuning.tvs([], est, {"rank": [4, 8], "regParam": [0.05, 0.1]}, e, 0.8)
    m = t.fit(rt)
    return tuning.best(tuning.results(spark, m, m.validationMetrics), e.isLargerBetter())


# --- invariants of fitted results, exact in SQL -----------------------------------------

def _holds(name: str, source: str, floor: str):
    """Register ``<name>_holds``: rows scored, rows outside the label set, and whether the fit reaches a floor."""
    sql = f"SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_odd, true AS {floor} FROM {source}"

    def deco(fn):
        return query(f"{name}_holds", sql)(fn)
    return deco


_TEST_DOCS = f"documents JOIN labels USING (doc_id) WHERE {_BUCKET.format(k='doc_id', n=100)} >= 80"
_TEST_VECS = f"embeddings WHERE {_BUCKET.format(k='vec_id', n=100)} >= 80"
_TEST_LINES = f"lineitem JOIN part ON l_partkey = p_partkey WHERE {_BUCKET.format(k='l_orderkey', n=100)} >= 80"


def _class_check(pred, labels: list[float]):
    """(n_rows, n_odd, beats_guess): the accuracy is above the share of the commonest label."""
    hit = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    least = F.greatest(*[F.avg((F.col("label") == x).cast("double")) for x in labels])
    return pred.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("prediction").isin(labels)).alias("n_odd"),
                    (hit > least).alias("beats_guess"))


def _value_check(pred, most: float = 0.5):
    """(n_rows, n_odd, bounded): the mean squared error is below ``most`` of the labels' variance,
    which always guessing their mean would reach."""
    return pred.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.isnan("prediction") | F.col("prediction").isNull()).alias("n_odd"),
                    (F.avg((F.col("prediction") - F.col("label")) ** 2) < most * F.var_pop("label")).alias("bounded"))


for _name, _fit, _source in (("ml_tree_binary", _tree_binary, _TEST_DOCS), ("ml_forest_binary", _forest_binary, _TEST_DOCS),
                             ("ml_logistic", _logistic, _TEST_DOCS), ("ml_svm", _svm, _TEST_DOCS), ("ml_pipeline", _pipeline, _TEST_DOCS)):
    _holds(_name, _source, "beats_guess")(lambda spark, sf, fit=_fit: _class_check(fit(spark, sf), [0.0, 1.0]))

_holds("ml_tree_multi", _TEST_VECS, "beats_guess")(lambda spark, sf: _class_check(_tree_multi(spark, sf), [float(i) for i in range(10)]))

for _name, _fit in (("ml_tree_regression", _tree_regression), ("ml_forest_regression", _forest_regression), ("ml_gbt", _gbt)):
    _holds(_name, _TEST_LINES, "bounded")(lambda spark, sf, fit=_fit: _value_check(fit(spark, sf)))


@query("ml_score_labels_holds", f"""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_odd, true AS beats_guess FROM {_TEST_DOCS}""")
def ml_score_labels_holds(spark, sf):
    """The shown labels, turned back into numbers, are as good as the model's."""
    pred = models.decode_prediction(_tree_binary(spark, sf), "prediction", QUALITY_LABELS, "verdict")
    back = F.when(F.col("verdict") == QUALITY_LABELS[0.0], 0.0).when(F.col("verdict") == QUALITY_LABELS[1.0], 1.0)
    return _class_check(pred.withColumn("prediction", back), [0.0, 1.0])


def _tuned(name: str, n: int):
    """Register ``<name>_holds``: rows of a search by area under the curve, rows with an impossible area, and whether the
    best is well above a guess's half."""
    @query(f"{name}_holds", f"SELECT CAST({n} AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_odd, true AS good")
    def check(spark, sf):
        area = F.col("metric")
        return QUERIES[name](spark, sf).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~area.between(0, 1) | F.isnan(area)).alias("n_odd"),
                                            (F.max(area) > 0.8).alias("good"))


for _name, _n in (("tune_sweep", 3), ("tune_grid", 4), ("tune_tvs", 2), ("tune_cv", 2)):
    _tuned(_name, _n)


# --- trees as tables ----------------------------------------------------------------------

def _tree_and_rows(spark, sf, kind, **params):
    train, test = _train_test(_docs(spark, sf))
    model, pred = models.fit_predict([_assembler(NUMERIC_DOC), models.estimator(kind, seed=42, **params)], train, test)
    return trees.nodes(spark, model.stages[-1]), pred, model


_TRAIN_DOCS = _TEST_DOCS.replace(">= 80", "< 80")


@query("tree_leaves", f"""
SELECT count(*) AS n_rows, CAST(count_if(quality = 1) AS DOUBLE) AS n_good, CAST(0 AS BIGINT) AS n_apart FROM {_TRAIN_DOCS}""")
def tree_leaves(spark, sf):
    """Over the leaves of a tree the training rows and the rows of label 1 add up; every inner node has its children's."""
    table, _, _ = _tree_and_rows(spark, sf, "tree_classifier", maxDepth=5)
    leaves = table.filter("left is null").agg(F.sum("n").alias("n_rows"), F.sum(F.get("stats", F.lit(1))).alias("n_good"))
    child = table.select(F.col("id").alias("c"), F.col("n").alias("m"))
    sums = table.filter("left is not null").select("id", "n", F.explode(F.array("left", "right")).alias("c")).join(child, "c") \
        .groupBy("id", "n").agg(F.sum("m").alias("m"))
    apart = sums.agg(F.count_if(F.col("n") != F.col("m")).alias("n_apart"))
    # two one-row aggregates side by side
    return leaves.withColumn("_k", F.lit(1)).join(apart.withColumn("_k", F.lit(1)), "_k").drop("_k")


@query("tree_scores", f"""
SELECT kind, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_apart FROM {_TEST_DOCS.replace(' WHERE', ", (SELECT unnest(['tree', 'forest']) AS kind) WHERE")}
GROUP BY kind""")
def tree_scores(spark, sf):
    """Rows taken down a tree and a forest by joins get what the models predict."""
    out = None
    for name, kind, params in (("tree", "tree_classifier", {"maxDepth": 5}), ("forest", "forest_classifier", {"maxDepth": 4, "numTrees": 8})):
        table, pred, _ = _tree_and_rows(spark, sf, kind, **params)
        own = trees.predict(pred.select("doc_id", "features"), table, ["doc_id"], classes=2).withColumnRenamed("prediction", "own")
        n = pred.select("doc_id", "prediction").join(own, "doc_id", "left").agg(
            F.lit(name).alias("kind"), F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("own").eqNullSafe(F.col("prediction"))).alias("n_apart"))
        out = n if out is None else out.unionByName(n)
    return out


@query("tree_rules")
def tree_rules(spark, sf):
    """Each leaf of a tree with the conditions that lead to it."""
    table, _, _ = _tree_and_rows(spark, sf, "tree_classifier", maxDepth=4)
    return trees.rules(table, NUMERIC_DOC).drop("tree")


@query("als_fit_holds", f"""
WITH {RATINGS_SQL} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_odd, true AS bounded FROM ratings""")
def als_fit_holds(spark, sf):
    rt, _, _ = _ratings_split(spark, sf)
    pred = recommend.als(rank=5, max_iter=5).fit(rt).transform(rt).withColumnRenamed("rating", "label")
    return _value_check(pred, 0.8)  # on the pairs it was fitted to; regularised


@query("als_top_items_holds", f"""
WITH {RATINGS_SQL},
act AS (SELECT "user", count(*) AS n FROM ratings GROUP BY "user" ORDER BY n DESC, "user" LIMIT 10)
SELECT "user", 5 AS n_items FROM act""")
def als_top_items_holds(spark, sf):
    """Every asked user gets five different items with a title."""
    rt, users, items = _ratings_split(spark, sf)
    model = recommend.als(rank=5, max_iter=5).fit(rt)
    top = _named(recommend.top_items(model, _active(rt, "user"), 5), users, items)
    parts = load(spark, sf, "part").select(F.col("p_partkey").alias("item"))
    return top.join(parts, "item").select("user", "item").distinct().groupBy("user") \
        .agg(F.count(F.lit(1)).cast("int").alias("n_items"))


@query("als_top_all_holds", f"""
WITH {RATINGS_SQL} SELECT count(DISTINCT "user") AS n_users, count(DISTINCT "user") * 5 AS n_rows, CAST(0 AS BIGINT) AS n_unsound,
       true AS spared FROM ratings""")
def als_top_all_holds(spark, sf):
    """Five different items for every user, and not all products computed to find them."""
    top, computed, pairs = _als_top_all(spark, sf)
    per = top.groupBy("user").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("item").alias("d"))
    return per.agg(F.count(F.lit(1)).alias("n_users"), F.sum("n").alias("n_rows"), F.count_if(F.col("d") != 5).alias("n_unsound")) \
        .withColumn("spared", F.lit(computed < pairs))


def _als_top_all(spark, sf):
    rt, users, items = _ratings_split(spark, sf)
    model = recommend.als(rank=5, max_iter=5).fit(rt)
    people, things = (stage(f.withColumnRenamed("id", c), f"factors-{c}") for f, c in ((model.userFactors, "user"), (model.itemFactors, "item")))
    top, computed = inner_product.top_products(people, things, 5, block=256)
    return _named(top, users, items), computed, people.count() * things.count()


@query("als_top_all")
def als_top_all(spark, sf):
    """The best five items of every user of a fitted model."""
    return _als_top_all(spark, sf)[0].withColumn("score", r("score"))


_MIX = ", ".join(f"CAST(sum(CASE WHEN l_returnflag = '{f}' THEN l_quantity ELSE 0 END) AS BIGINT) AS {f}" for f in "ANR")


@query("top_products_all", f"""
WITH u AS (SELECT o_custkey AS "user", {_MIX} FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
i AS (SELECT l_partkey AS item, {_MIX} FROM lineitem GROUP BY 1),
s AS (SELECT "user", item, CAST(u.A * i.A + u.N * i.N + u.R * i.R AS DOUBLE) AS score FROM u, i)
SELECT "user", item, score FROM s QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) <= 5""")
def top_products_all(spark, sf):
    """For every customer the five parts whose quantities by return flag have the greatest product with the customer's own."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_quantity")
    mix = F.array(*[F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity")).otherwise(0.0)) for f in "ANR"]).alias("features")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    people = li.join(o, li.l_orderkey == o.o_orderkey).groupBy(F.col("o_custkey").alias("user")).agg(mix)
    things = li.groupBy(F.col("l_partkey").alias("item")).agg(mix)
    return inner_product.top_products(people, things, 5, block=256)[0]


@query("csc_layout", f"""
WITH {RATINGS_SQL}, c AS (SELECT item, count(*) AS nnz FROM ratings GROUP BY item)
SELECT item, nnz, coalesce(sum(nnz) OVER (ORDER BY item ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS indptr
FROM c""")
def csc_layout(spark, sf):
    return recommend.csc_layout(ratings(spark, sf), "user", "item")


@query("csc_entries", f"""
WITH {RATINGS_SQL}
SELECT row_number() OVER (ORDER BY item, "user") - 1 AS at, row_number() OVER (PARTITION BY item ORDER BY "user") - 1 AS place,
       item, "user", rating FROM ratings""")
def csc_entries(spark, sf):
    """Every entry of the sparse rating matrix with its place in the layout and in its column."""
    return recommend.csc_entries(ratings(spark, sf), "user", "item", "rating")


@query("csc_times", f"""
WITH {RATINGS_SQL} SELECT "user", round(sum(rating * p_size), 4) AS y FROM ratings JOIN part ON item = p_partkey GROUP BY 1""")
def csc_times(spark, sf):
    """The rating matrix times the items' sizes."""
    layout = recommend.csc_entries(ratings(spark, sf), "user", "item", "rating")
    size = load(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.col("p_size").cast("double").alias("size"))
    return recommend.csc_times(layout, size, "user", "item", "rating", "size").withColumn("y", r("y"))
