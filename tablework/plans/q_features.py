"""Feature-transformer queries."""

from __future__ import annotations

import numpy as np
from pyspark.ml import feature as mf
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from ..functions.common import r
from ..ml import features as fx, pca
from ..tables import load
from .derived import doc_features
from .registry import query

_LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("ft_binarizer", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS DOUBLE) AS flag
FROM lineitem""")
def ft_binarizer(spark, sf):
    li = load(spark, sf, "lineitem").select(*_LI_KEYS, "l_discount")
    return fx.binarize(li, "l_discount", 0.05, "flag").drop("l_discount")


@query("ft_bucketizer", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 25 THEN 1 WHEN l_quantity < 40 THEN 2 ELSE 3 END
            AS DOUBLE) AS bucket
FROM lineitem""")
def ft_bucketizer(spark, sf):
    li = load(spark, sf, "lineitem").select(*_LI_KEYS, "l_quantity")
    splits = [float("-inf"), 10.0, 25.0, 40.0, float("inf")]
    return fx.bucketize(li, "l_quantity", splits, "bucket").drop("l_quantity")


@query("ft_chisq")
def ft_chisq(spark, sf):
    d = doc_features(spark, sf)
    stages = [mf.StringIndexer(inputCols=["lang", "source"], outputCols=["lang_i", "source_i"]),
              mf.Bucketizer(splits=[0, 1, 5, 20, float("inf")], inputCol="n_lines", outputCol="lines_b"),
              mf.VectorAssembler(inputCols=["lang_i", "source_i", "lines_b"], outputCol="cat"),
              mf.UnivariateFeatureSelector(featuresCol="cat", labelCol="label", outputCol="selected",
                                           selectionMode="numTopFeatures")
              .setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(1)]
    _, out = fx.fit_transform(stages, d)
    return out.select("doc_id", fx.to_array("selected")[0].alias("selected"))


_CHISQ_SQL = """
WITH d AS (SELECT quality AS y, lang, source, length(text) - length(replace(text, chr(10), '')) AS lines
           FROM documents JOIN labels USING (doc_id)),
v AS (SELECT 0 AS feature, lang AS v, y FROM d UNION ALL SELECT 1, source, y FROM d
      UNION ALL SELECT 2, CASE WHEN lines < 1 THEN '0' WHEN lines < 5 THEN '1' WHEN lines < 20 THEN '2' ELSE '3' END, y
      FROM d),
n AS (SELECT count(*)::DOUBLE AS n FROM d),
rows_ AS (SELECT feature, v, count(*) AS a FROM v GROUP BY ALL),
cols_ AS (SELECT feature, y, count(*) AS b FROM v GROUP BY ALL),
cells AS (SELECT feature, v, y, count(*) AS o FROM v GROUP BY ALL)
SELECT feature, round(sum((coalesce(o, 0) - a * b / n) ** 2 / (a * b / n)), 6) AS statistic,
       CAST((count(DISTINCT v) - 1) * (count(DISTINCT y) - 1) AS INTEGER) AS degrees
FROM rows_ JOIN cols_ USING (feature) LEFT JOIN cells USING (feature, v, y), n GROUP BY feature"""


@query("ft_chisq_stat", _CHISQ_SQL)
def ft_chisq_stat(spark, sf):
    """Pearson's statistic of each categorical feature against the label."""
    stages = [mf.StringIndexer(inputCols=["lang", "source"], outputCols=["lang_i", "source_i"]),
              mf.Bucketizer(splits=[0, 1, 5, 20, float("inf")], inputCol="n_lines", outputCol="lines_b"),
              mf.VectorAssembler(inputCols=["lang_i", "source_i", "lines_b"], outputCol="cat")]
    _, out = fx.fit_transform(stages, doc_features(spark, sf))
    t = ChiSquareTest.test(out, "cat", "label", flatten=True)
    return t.select(F.col("featureIndex").alias("feature"), r("statistic", 6).alias("statistic"),
                    F.col("degreesOfFreedom").cast("int").alias("degrees"))


_TOK_SQL = "tok AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS term FROM conversations)"


def _conv_tokens(spark, sf):
    return load(spark, sf, "conversations").select("conv_id", "turn", F.split("text", " ").alias("tokens"))


@query("ft_count_vector", f"""
WITH {_TOK_SQL} SELECT conv_id, turn, term, count(*) AS count FROM tok GROUP BY conv_id, turn, term""")
def ft_count_vector(spark, sf):
    return fx.term_counts(_conv_tokens(spark, sf), ["conv_id", "turn"], "tokens", out="count")


@query("ft_tf_idf", f"""
WITH {_TOK_SQL},
tf AS (SELECT conv_id, turn, term, count(*) AS tf FROM tok GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
m AS (SELECT count(*) AS m FROM conversations)
SELECT conv_id, turn, term, round(tf * ln((m + 1.0) / (df + 1.0)), 6) AS tfidf
FROM tf JOIN df USING (term), m""")
def ft_tf_idf(spark, sf):
    e = fx.tf_idf(_conv_tokens(spark, sf), ["conv_id", "turn"], "tokens")
    return e.withColumn("tfidf", r("tfidf", 6))


@query("ft_dct", """
SELECT vec_id, CAST(k AS INTEGER) AS k, round(sqrt(2.0 / 64) * CASE WHEN k = 0 THEN sqrt(0.5) ELSE 1.0 END
       * list_sum(list_transform(embedding, lambda x, i: CAST(x AS DOUBLE) * cos(pi() * (2 * (i - 1) + 1) * k / 128.0))),
       5) AS c
FROM embeddings, range(64) t(k)""")
def ft_dct(spark, sf):
    e = load(spark, sf, "embeddings").select("vec_id", fx.from_array("embedding").alias("v"))
    out = mf.DCT(inverse=False, inputCol="v", outputCol="dct").transform(e)
    return out.select("vec_id", F.posexplode(fx.to_array("dct")).alias("k", "c")).withColumn("c", r("c", 5))


_ASSEMBLED = ["l_quantity", "l_discount", "l_tax"]


@query("ft_elementwise", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity * 1.0, 6) AS q,
       round(l_discount * 2.0, 6) AS d2, round(l_tax * 3.0, 6) AS t3
FROM lineitem""")
def ft_elementwise(spark, sf):
    li = fx.assemble(load(spark, sf, "lineitem").select(*_LI_KEYS, *_ASSEMBLED), _ASSEMBLED, "v")
    out = fx.elementwise(li, "v", [1.0, 2.0, 3.0], "p")
    return fx.slots(out.select(*_LI_KEYS, "p"), "p", ["q", "d2", "t3"])


@query("ft_hasher")
def ft_hasher(spark, sf):
    """All non-zero slots of the hashed features (compared with a brute-force hash in the tests)."""
    li = load(spark, sf, "lineitem").select(*_LI_KEYS, "l_quantity", "l_returnflag", "l_linestatus")
    h = mf.FeatureHasher(inputCols=["l_quantity", "l_returnflag", "l_linestatus", "l_linenumber"],
                         outputCol="h", numFeatures=64, categoricalCols=["l_linenumber"]).transform(li)
    return fx.sparse_entries(h, "h", _LI_KEYS, index="slot", value="value")


@query("ft_hashing_tf", """
SELECT conv_id, turn, CAST(len(string_split(text, ' ')) AS DOUBLE) AS n FROM conversations""")
def ft_hashing_tf(spark, sf):
    h = _hashed_terms(spark, sf)
    return h.select("conv_id", "turn", F.aggregate(fx.to_array("h"), F.lit(0.0), lambda a, x: a + x).alias("n"))


@query("ft_hashing_tf_slots")
def ft_hashing_tf_slots(spark, sf):
    """All non-zero slots of the hashed term counts (compared with a brute-force hash in the tests)."""
    return fx.sparse_entries(_hashed_terms(spark, sf), "h", ["conv_id", "turn"], index="slot", value="count")


def _hashed_terms(spark, sf):
    return mf.HashingTF(inputCol="tokens", outputCol="h", numFeatures=1024).transform(_conv_tokens(spark, sf))


_SEG_RANK = """seg AS (SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS idx
            FROM customer GROUP BY c_mktsegment)"""


@query("ft_string_index", f"""
WITH {_SEG_RANK}
SELECT c_custkey, CAST(idx AS DOUBLE) AS idx FROM customer JOIN seg USING (c_mktsegment)""")
def ft_string_index(spark, sf):
    _, out = fx.string_index(load(spark, sf, "customer"), "c_mktsegment", "idx")
    return out.select("c_custkey", "idx")


@query("ft_index_to_string", "SELECT c_custkey, c_mktsegment AS segment FROM customer")
def ft_index_to_string(spark, sf):
    m, out = fx.string_index(load(spark, sf, "customer"), "c_mktsegment", "idx")
    return fx.index_to_string(out, "idx", "segment", m.labels).select("c_custkey", "segment")


def _cust_vec(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double"))
    return fx.assemble(c, ["c_acctbal", "c_nationkey"], "v").select("c_custkey", "v")


@query("ft_maxabs", """
SELECT c_custkey, round(c_acctbal / max(abs(c_acctbal)) OVER (), 6) AS a0,
       round(c_nationkey / max(abs(c_nationkey)) OVER (), 6) AS a1 FROM customer""")
def ft_maxabs(spark, sf):
    out = fx.scale(_cust_vec(spark, sf), "v", "s", "maxabs")
    return fx.slots(out.select("c_custkey", "s"), "s", ["a0", "a1"])


@query("ft_minmax", """
SELECT c_custkey,
       round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 6) AS a0,
       round((c_nationkey - min(c_nationkey) OVER ()) / (max(c_nationkey) OVER () - min(c_nationkey) OVER ()), 6)
         AS a1
FROM customer""")
def ft_minmax(spark, sf):
    out = fx.scale(_cust_vec(spark, sf), "v", "s", "minmax", min=0.0, max=1.0)
    return fx.slots(out.select("c_custkey", "s"), "s", ["a0", "a1"])


@query("ft_standard", """
SELECT c_custkey,
       round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER (), 6) AS a0,
       round((c_nationkey - avg(c_nationkey) OVER ()) / stddev_samp(c_nationkey) OVER (), 6) AS a1
FROM customer""")
def ft_standard(spark, sf):
    out = fx.scale(_cust_vec(spark, sf), "v", "s", "standard", withMean=True, withStd=True)
    return fx.slots(out.select("c_custkey", "s"), "s", ["a0", "a1"])


@query("ft_ngram", """
SELECT conv_id, turn, t[i] || ' ' || t[i + 1] AS ngram
FROM (SELECT conv_id, turn, t, unnest(generate_series(1, len(t) - 1)) AS i
      FROM (SELECT conv_id, turn, string_split(text, ' ') AS t FROM conversations))""")
def ft_ngram(spark, sf):
    g = fx.ngrams(_conv_tokens(spark, sf), "tokens", 2, "ng")
    return g.select("conv_id", "turn", F.explode("ng").alias("ngram"))


@query("ft_normalizer", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT vec_id, CAST(k AS INTEGER) AS slot, round(v[k + 1] / sqrt(list_dot_product(v, v)), 6) AS value
FROM e, range(64) t(k)""")
def ft_normalizer(spark, sf):
    e = load(spark, sf, "embeddings").select("vec_id", fx.from_array("embedding").alias("v"))
    out = fx.scale(e, "v", "n", "normalizer", p=2.0)
    return out.select("vec_id", F.posexplode(fx.to_array("n")).alias("slot", "value")).withColumn("value", r("value", 6))


@query("ft_onehot", f"""
WITH {_SEG_RANK}
SELECT c_custkey, CAST(CASE WHEN idx < (SELECT count(*) FROM seg) - 1 THEN idx ELSE -1 END AS INTEGER) AS hot
FROM customer JOIN seg USING (c_mktsegment)""")
def ft_onehot(spark, sf):
    _, idx = fx.string_index(load(spark, sf, "customer"), "c_mktsegment", "idx")
    out = fx.one_hot(idx, "idx", "oh", drop_last=True)
    return out.select("c_custkey", fx.hot_position("oh").alias("hot"))


@query("ft_pca")
def ft_pca(spark, sf):
    e = load(spark, sf, "embeddings").select("vec_id", fx.from_array("embedding").alias("v"))
    out = mf.PCA(k=2, inputCol="v", outputCol="pc").fit(e).transform(e)
    return fx.slots(out.select("vec_id", "pc"), "pc", ["pc0", "pc1"])


@query("pca_components", """
WITH v AS (SELECT embedding::DOUBLE[] AS e FROM embeddings),
x AS (SELECT unnest(range(1, 65)) AS i, unnest(e) AS x FROM v),
n AS (SELECT count(*) AS n FROM v)
SELECT 3 AS n_components, (SELECT n FROM n) AS n_rows, round(sum(var), 6) AS total_variance, true AS eigen, true AS orthonormal,
       true AS falling, true AS captured, true AS signs
FROM (SELECT i, var_samp(x) AS var FROM x GROUP BY i)""")
def pca_components(spark, sf):
    """Three components of the vectors: what makes them the leading ones holds, and the scores of the rows have their variances."""
    e = load(spark, sf, "embeddings").select("embedding")
    c = pca.fit(e, "embedding", 3)
    scores = e.select(c.scores("embedding").alias("s"))
    found = np.array(scores.agg(*[F.var_samp(F.get("s", F.lit(i))) for i in range(3)]).first())
    residual = np.abs(c.covariance @ c.vectors.T - c.vectors.T * c.variances).max()
    most = np.linalg.eigvalsh(c.covariance)[::-1][:3]
    row = (3, c.n, round(float(np.trace(c.covariance)), 6), bool(residual < 1e-9 * c.variances[0]),
           bool(np.abs(c.vectors @ c.vectors.T - np.eye(3)).max() < 1e-9), bool((np.diff(c.variances) <= 0).all()),
           bool(np.abs(found - most).max() < 1e-6 * most[0]), bool((np.take_along_axis(c.vectors, np.abs(c.vectors).argmax(1)[:, None], 1) > 0).all()))
    return spark.createDataFrame([row], "n_components int, n_rows long, total_variance double, eigen boolean, orthonormal boolean, "
                                        "falling boolean, captured boolean, signs boolean")


@query("ft_tokenizer", r"""
SELECT conv_id, turn, unnest(string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s')) AS token
FROM conversations""")
def ft_tokenizer(spark, sf):
    c = load(spark, sf, "conversations")
    t = fx.tokenizer("text", "tokens").transform(c)
    return t.select("conv_id", "turn", F.explode("tokens").alias("token"))


@query("ft_assembler", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity, 6) AS f0,
       round(l_discount, 6) AS f1, round(l_tax, 6) AS f2 FROM lineitem""")
def ft_assembler(spark, sf):
    li = fx.assemble(load(spark, sf, "lineitem").select(*_LI_KEYS, *_ASSEMBLED), _ASSEMBLED, "v")
    return fx.slots(li.select(*_LI_KEYS, "v"), "v", ["f0", "f1", "f2"])


@query("ft_vector_indexer", """
WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_linenumber AS DOUBLE) AS ln, l_tax,
                   l_quantity FROM lineitem),
k AS (SELECT count(DISTINCT ln) AS k0, count(DISTINCT l_tax) AS k1, count(DISTINCT l_quantity) AS k2 FROM li),
r AS (SELECT *, dense_rank() OVER (ORDER BY ln) - 1 AS r0, dense_rank() OVER (ORDER BY l_tax) - 1 AS r1,
             dense_rank() OVER (ORDER BY l_quantity) - 1 AS r2 FROM li)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(CASE WHEN k0 <= 10 THEN r0 ELSE ln END, 6) AS i0,
       round(CASE WHEN k1 <= 10 THEN r1 ELSE l_tax END, 6) AS i1,
       round(CASE WHEN k2 <= 10 THEN r2 ELSE l_quantity END, 6) AS i2
FROM r, k""")
def ft_vector_indexer(spark, sf):
    li = load(spark, sf, "lineitem").select(*_LI_KEYS, F.col("l_linenumber").cast("double").alias("ln"),
                                            "l_tax", "l_quantity")
    v = fx.assemble(li, ["ln", "l_tax", "l_quantity"], "v")
    m = mf.VectorIndexer(maxCategories=10, inputCol="v", outputCol="vi").fit(v)
    return fx.slots(m.transform(v).select(*_LI_KEYS, "vi"), "vi", ["i0", "i1", "i2"])
