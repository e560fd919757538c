"""Supervised models (M01-M11, M22) as Spark ML estimators."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as mc
from pyspark.ml import regression as mr
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ESTIMATORS = {
    "tree_classifier": mc.DecisionTreeClassifier,
    "forest_classifier": mc.RandomForestClassifier,
    "logistic": mc.LogisticRegression,
    "svm": mc.LinearSVC,
    "naive_bayes": mc.NaiveBayes,
    "gbt_classifier": mc.GBTClassifier,
    "tree_regressor": mr.DecisionTreeRegressor,
    "forest_regressor": mr.RandomForestRegressor,
    "gbt_regressor": mr.GBTRegressor,
    "linear_regression": mr.LinearRegression,
}


def estimator(kind: str, features: str = "features", label: str = "label", **params):
    """An estimator by name with its parameters (``maxDepth``, ``impurity``,
    ``maxBins``, ``numTrees``, ``regParam``, ``smoothing``...)."""
    return ESTIMATORS[kind](featuresCol=features, labelCol=label, **params)


def fit_predict(stages: list, train: DataFrame, test: DataFrame | None = None) -> tuple[PipelineModel, DataFrame]:
    """Fit a pipeline on ``train`` and score ``test`` (or ``train``)."""
    model = Pipeline(stages=stages).fit(train)
    return model, model.transform(test if test is not None else train)


def save(model, path: str, overwrite: bool = True) -> None:
    w = model.write()
    if overwrite:
        w = w.overwrite()
    w.save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def explain(model) -> str:
    """Tree / ensemble structure as text (``toDebugString``)."""
    return model.toDebugString


def importances(spark: SparkSession, model, names: list[str]) -> DataFrame:
    """Feature importances of a tree model as ``(feature, importance)``."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(names, [float(x) for x in imp])), "feature string, importance double")


def naive_bayes_params(spark: SparkSession, model: mc.NaiveBayesModel, digits: int = 6) -> DataFrame:
    """Class log-priors (``j = -1``) and per-feature log-likelihoods."""
    pi = model.pi.toArray().tolist()
    theta = model.theta.toArray().tolist()
    rows = [(float(c), -1, "pi", round(float(p), digits)) for c, p in enumerate(pi)]
    rows += [(float(c), j, "theta", round(float(t), digits)) for c, row in enumerate(theta) for j, t in enumerate(row)]
    return spark.createDataFrame(rows, "label double, j int, kind string, value double")


def decode_prediction(df: DataFrame, col: str, labels: dict, out: str) -> DataFrame:
    """Human label for a numeric prediction (literal map, no driver loop)."""
    from itertools import chain

    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return df.withColumn(out, m[F.col(col)])
