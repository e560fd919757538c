"""Feature preparation (X01-X21) as Spark ML stages.

Stages run distributed; fitted state that reaches the driver is bounded by
the model itself (a vocabulary of ``k`` terms, per-feature statistics, a
category list).  Helpers return plain columns where a vector is not needed,
so results can be compared and stored without vector types.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import feature as mf
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import r


def assemble(df: DataFrame, cols: list[str], out: str = "features", handle_invalid: str = "error") -> DataFrame:
    return mf.VectorAssembler(inputCols=cols, outputCol=out, handleInvalid=handle_invalid).transform(df)


def from_array(c: str | Column) -> Column:
    """array<float|double> column → dense ML vector."""
    return array_to_vector(F.col(c) if isinstance(c, str) else c)


def to_array(c: str | Column) -> Column:
    """ML vector → array<double> (dense)."""
    return vector_to_array(F.col(c) if isinstance(c, str) else c)


def slots(df: DataFrame, vec: str, names: list[str], digits: int | None = 6) -> DataFrame:
    """Vector column → one double column per slot (rounded)."""
    arr = to_array(vec)
    cols = [(r(arr[i], digits) if digits is not None else arr[i]).alias(n) for i, n in enumerate(names)]
    return df.select(*[c for c in df.columns if c != vec], *cols)


def pipeline(stages: list) -> Pipeline:
    return Pipeline(stages=stages)


def fit_transform(stages: list, df: DataFrame) -> tuple[PipelineModel, DataFrame]:
    model = Pipeline(stages=stages).fit(df)
    return model, model.transform(df)


def top_vocabulary(tokens: DataFrame, col: str, k: int, min_df: int = 1, id_col: str | None = None) -> list[str]:
    """The ``k`` most frequent terms (ties by term), found with a
    distributed count and a top-k; only ``k`` strings reach the driver."""
    t = tokens.select(*([id_col] if id_col else []), F.explode(col).alias("_t"))
    g = t.groupBy("_t").agg(F.count(F.lit(1)).alias("_n"),
                             (F.count_distinct(id_col) if id_col else F.count(F.lit(1))).alias("_df"))
    g = g.filter(F.col("_df") >= min_df)
    return [r["_t"] for r in g.orderBy(F.col("_n").desc(), F.col("_t")).limit(k).collect()]


def term_counts(tokens: DataFrame, keys: list[str], col: str, term: str = "term", out: str = "tf") -> DataFrame:
    """Bag of words over every term, in long form: (``keys``, term, count)."""
    return (tokens.select(*keys, F.explode(col).alias(term)).groupBy(*keys, term)
            .agg(F.count(F.lit(1)).alias(out)))


def tf_idf(tokens: DataFrame, keys: list[str], col: str, term: str = "term", out: str = "tfidf") -> DataFrame:
    """tf * ln((m + 1) / (df + 1)) for every term of every document, m documents in all.

    The document frequencies are a table of their own, joined on the term;
    nothing is collected but m.
    """
    tf = term_counts(tokens, keys, col, term, "_tf")
    df = tf.groupBy(term).agg(F.count(F.lit(1)).alias("_df"))
    m = tokens.count()
    return tf.join(df, term).select(*keys, term, (F.col("_tf") * F.log(F.lit(m + 1.0) / (F.col("_df") + 1.0))).alias(out))


def count_vectorizer(vocabulary: list[str], in_col: str, out_col: str) -> mf.CountVectorizerModel:
    """Bag of words over a given vocabulary (fitted models use the same)."""
    return mf.CountVectorizerModel.from_vocabulary(vocabulary, inputCol=in_col, outputCol=out_col)


def sparse_entries(df: DataFrame, vec: str, keys: list[str], names: list[str] | None = None,
                   index: str = "index", value: str = "value") -> DataFrame:
    """Non-zero slots of a vector column as rows ``(keys..., index|name, value)``.
    Intended for vectors of bounded width (vocabularies, feature sets)."""
    arr = to_array(vec)
    e = df.select(*keys, F.posexplode(arr).alias(index, value)).filter(F.col(value) != 0)
    if names is not None:
        lookup = F.array(*[F.lit(n) for n in names])
        e = e.withColumn(index, lookup[F.col(index)])
    return e


def tokenizer(in_col: str, out_col: str) -> mf.Tokenizer:
    return mf.Tokenizer(inputCol=in_col, outputCol=out_col)


def ngrams(df: DataFrame, tokens: str, n: int, out: str = "ngrams") -> DataFrame:
    return mf.NGram(n=n, inputCol=tokens, outputCol=out).transform(df)


def binarize(df: DataFrame, col: str, threshold: float, out: str) -> DataFrame:
    return mf.Binarizer(threshold=threshold, inputCol=col, outputCol=out).transform(df)


def bucketize(df: DataFrame, col: str, splits: list[float], out: str, keep_invalid: bool = True) -> DataFrame:
    b = mf.Bucketizer(splits=splits, inputCol=col, outputCol=out)
    if keep_invalid:
        b = b.setHandleInvalid("keep")
    return b.transform(df)


def string_index(df: DataFrame, col: str, out: str) -> tuple[mf.StringIndexerModel, DataFrame]:
    """Index by frequency (most frequent = 0), ties alphabetical."""
    m = mf.StringIndexer(inputCol=col, outputCol=out, stringOrderType="frequencyDesc").fit(df)
    return m, m.transform(df)


def index_to_string(df: DataFrame, col: str, out: str, labels: list[str]) -> DataFrame:
    return mf.IndexToString(inputCol=col, outputCol=out, labels=labels).transform(df)


def scale(df: DataFrame, vec: str, out: str, kind: str = "standard", **kw) -> DataFrame:
    """``standard`` (withMean/withStd, sample std), ``minmax`` (min/max
    params), ``maxabs`` or ``normalizer`` (p)."""
    if kind == "normalizer":
        return mf.Normalizer(inputCol=vec, outputCol=out, p=kw.get("p", 2.0)).transform(df)
    est = {"standard": mf.StandardScaler, "minmax": mf.MinMaxScaler, "maxabs": mf.MaxAbsScaler}[kind]
    return est(inputCol=vec, outputCol=out, **kw).fit(df).transform(df)


def elementwise(df: DataFrame, vec: str, scaling: list[float], out: str) -> DataFrame:
    from pyspark.ml.linalg import Vectors

    return mf.ElementwiseProduct(scalingVec=Vectors.dense(scaling), inputCol=vec, outputCol=out).transform(df)


def one_hot(df: DataFrame, index_col: str, out: str, drop_last: bool = True) -> DataFrame:
    return mf.OneHotEncoder(inputCols=[index_col], outputCols=[out], dropLast=drop_last).fit(df).transform(df)


def hot_position(vec: str) -> Column:
    """Slot holding the 1 of a one-hot vector, -1 for the all-zero vector."""
    return (F.array_position(to_array(vec), F.lit(1.0)) - 1).cast("int")
