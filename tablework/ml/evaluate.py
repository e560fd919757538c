"""Model evaluation (M12-M16) with Spark ML evaluators.

Every metric is computed by a distributed aggregation; only the scalar
result reaches the driver.  ``metrics_frame`` returns metrics as a one-row
DataFrame so they compose with the rest of a job.
"""

from __future__ import annotations

from pyspark.ml import evaluation as ev
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import r


def error_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                 out: str = "error") -> DataFrame:
    """Per-row absolute error ``|label - prediction|``."""
    return df.withColumn(out, F.abs(F.col(label) - F.col(prediction)))


def binary_metric(df: DataFrame, label: str, score: str, metric: str = "areaUnderROC",
                  num_bins: int = 0) -> float:
    """AUC ROC / PR.  ``score`` may be a double (hard or soft) or a vector of
    class probabilities.  ``num_bins=0`` disables down-sampling (exact)."""
    if dict(df.dtypes)[score] == "double":
        df = df.withColumn("_raw", array_to_vector(F.array(F.lit(0.0) - F.col(score), F.col(score))))
        score = "_raw"
    e = ev.BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, metricName=metric,
                                         numBins=num_bins)
    return e.evaluate(df.withColumn(label, F.col(label).cast("double")))


def multiclass_metric(df: DataFrame, label: str, prediction: str, metric: str = "accuracy") -> float:
    e = ev.MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName=metric)
    return e.evaluate(df.select(F.col(label).cast("double").alias(label),
                                F.col(prediction).cast("double").alias(prediction)))


def regression_metric(df: DataFrame, label: str, prediction: str, metric: str = "rmse") -> float:
    e = ev.RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName=metric)
    return e.evaluate(df.select(F.col(label).cast("double").alias(label),
                                F.col(prediction).cast("double").alias(prediction)))


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       digits: int = 6) -> DataFrame:
    """RMSE, R² and MAE in one aggregate pass (same definitions as
    ``RegressionEvaluator``: R² against the label mean)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    a = df.agg(F.count(F.lit(1)).alias("n"), F.sum((y - p) * (y - p)).alias("sse"),
               F.sum(F.abs(y - p)).alias("sae"), F.var_pop(y).alias("vy"))
    sst = F.col("vy") * F.col("n")  # numerically stable total sum of squares
    return a.select(r(F.sqrt(F.col("sse") / F.col("n")), digits).alias("rmse"),
                    r(F.lit(1.0) - F.col("sse") / sst, digits).alias("r2"),
                    r(F.col("sae") / F.col("n"), digits).alias("mae"))


def metrics_frame(spark, values: dict[str, float], digits: int = 6) -> DataFrame:
    """One-row DataFrame of named metric values (rounded)."""
    return spark.createDataFrame([tuple(round(float(v), digits) for v in values.values())],
                                 ", ".join(f"{k} double" for k in values))
