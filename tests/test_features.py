import random
from collections import Counter
from math import log

from pyspark.ml import feature as mf
from pyspark.ml.linalg import Vectors

from pyspark.sql import functions as F

from tablework.ml import evaluate, features as fx
from tablework.plans import QUERIES

from .conftest import SF_SMALL, rows


def test_binarizer_bucketizer(spark):
    marks = spark.createDataFrame([(x,) for x in (12.0, 7.5, 7.6, -3.0)], ["mark"])
    assert [r["b"] for r in fx.binarize(marks, "mark", 7.5, "b").collect()] == [1.0, 0.0, 1.0, 0.0]  # strictly above
    temps = spark.createDataFrame([(x,) for x in (-40.0, 0.0, 17.9, 18.0, 99.0, float("nan"))], ["t"])
    out = fx.bucketize(temps, "t", [-float("inf"), 0.0, 18.0, float("inf")], "b")
    assert [r["b"] for r in out.collect()] == [0.0, 1.0, 1.0, 2.0, 2.0, 3.0]  # lower bound inside, NaN kept apart


def test_string_index_roundtrip(spark):
    fruit = ["plum", "fig", "fig", "kiwi", "plum", "fig", "date"]
    df = spark.createDataFrame(list(enumerate(fruit)), ["n", "fruit"])
    m, idx = fx.string_index(df, "fruit", "i")
    want = {"fig": 0.0, "plum": 1.0, "date": 2.0, "kiwi": 3.0}  # by frequency, ties by name
    assert [r["i"] for r in idx.orderBy("n").collect()] == [want[f] for f in fruit]
    back = fx.index_to_string(idx, "i", "again", m.labels)
    assert all(r["again"] == r["fruit"] for r in back.collect())
    hot = fx.one_hot(idx, "i", "v", drop_last=True).orderBy("n").select(fx.hot_position("v").alias("h"))
    assert [r["h"] for r in hot.collect()] == [1, 0, 0, -1, 1, 0, 2]


def test_scalers(spark):
    df = spark.createDataFrame([(Vectors.dense(8.0, -5.0),), (Vectors.dense(-2.0, 10.0),), (Vectors.dense(3.0, 0.0),)], ["f"])
    assert [list(r["s"]) for r in fx.scale(df, "f", "s", "maxabs").collect()] == [[1.0, -0.5], [-0.25, 1.0], [0.375, 0.0]]
    low_high = [[round(x, 9) for x in r["s"]] for r in fx.scale(df, "f", "s", "minmax", min=0.0, max=1.0).collect()]
    assert low_high == [[1.0, 0.0], [0.0, 1.0], [0.5, 0.333333333]]
    m = mf.StandardScaler(inputCol="f", outputCol="s", withMean=True, withStd=True).fit(df)
    assert [round(x, 9) for x in m.mean] == [3.0, 1.666666667] and abs(m.std[0] - 5.0) < 1e-9  # sample deviation of 8, -2, 3
    v = spark.createDataFrame([(Vectors.dense([5.0, 12.0]),)], ["d"])
    assert [round(x, 9) for x in fx.scale(v, "d", "n", "normalizer", p=2.0).first()["n"]] == [0.384615385, 0.923076923]


def test_ngram_elementwise_tokenizer_assembler(spark):
    df = spark.createDataFrame([("to be or not".split(),)], ["t"])
    assert fx.ngrams(df, "t", 3, "g").first()["g"] == ["to be or", "be or not"]
    v = spark.createDataFrame([(Vectors.dense([4.0, -1.0]),)], ["v"])
    assert list(fx.elementwise(v, "v", [0.5, 7.0], "p").first()["p"]) == [2.0, -7.0]
    t = spark.createDataFrame([("Über  Nacht",)], ["text"])
    assert fx.tokenizer("text", "w").transform(t).first()["w"] == ["über", "", "nacht"]
    a = spark.createDataFrame([(9, 0.5)], ["a", "b"])
    assert list(fx.assemble(a, ["b", "a"]).first()["features"]) == [0.5, 9.0]


def test_terms_keep_the_whole_vocabulary(spark):
    rng = random.Random(4)
    docs = [(i, [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(0, 40))]) for i in range(60)]
    df = spark.createDataFrame(docs, "id long, words array<string>")
    tf = {(i, w): n for i, ws in docs for w, n in Counter(ws).items()}
    got = {(r["id"], r["term"]): r["tf"] for r in fx.term_counts(df, ["id"], "words").collect()}
    assert got == tf and len({w for _, w in tf}) > 50
    df_of = Counter(w for _, w in tf)
    want = {k: n * log(61 / (df_of[k[1]] + 1)) for k, n in tf.items()}
    idf = {(r["id"], r["term"]): r["tfidf"] for r in fx.tf_idf(df, ["id"], "words").collect()}
    assert idf.keys() == want.keys() and all(abs(idf[k] - want[k]) < 1e-9 for k in want)


def test_count_vectorizer_given_vocab(spark):
    df = spark.createDataFrame([(0, "tea milk tea".split()), (1, "milk bread".split())], ["id", "words"])
    vocab = fx.top_vocabulary(df, "words", 2)
    assert vocab == ["milk", "tea"]
    out = fx.count_vectorizer(vocab, "words", "tf").transform(df)
    assert rows(fx.sparse_entries(out, "tf", ["id"], vocab, "term", "n")) == [(0, "milk", 1.0), (0, "tea", 2.0), (1, "milk", 1.0)]


def murmur3(data: bytes, seed: int = 42) -> int:
    """MurmurHash3 x86 32 bit, signed; the bytes behind the last whole word count one by one,
    as the hashing transformers do."""
    def rotated(x, n):
        return (x << n | x >> (32 - n)) & 0xFFFFFFFF

    def mixed(h, k):
        k = rotated(k * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
        return (rotated(h ^ k, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF

    h, n = seed, len(data)
    whole = n - n % 4
    for i in range(0, whole, 4):
        h = mixed(h, int.from_bytes(data[i:i + 4], "little"))
    tail = int.from_bytes(data[whole:], "little")
    if n % 4:
        h ^= rotated(tail * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
    h ^= n
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_hashed_terms_match_a_plain_hash(spark):
    got = {}
    for r in QUERIES["ft_hashing_tf_slots"](spark, SF_SMALL).collect():
        got[r["conv_id"], r["turn"], r["slot"]] = r["count"]
    want = Counter()
    for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect():
        for w in r["text"].split(" "):
            want[r["conv_id"], r["turn"], murmur3(w.encode()) % 1024] += 1
    assert got == dict(want)


def test_hashed_features_match_a_plain_hash(spark):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    got = Counter()
    for r in QUERIES["ft_hasher"](spark, SF_SMALL).collect():
        got[tuple(r[k] for k in keys), r["slot"], round(r["value"], 6)] += 1
    want = Counter()
    for r in spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").collect():
        slots = Counter()
        slots[murmur3(b"l_quantity") % 64] += r["l_quantity"]
        for c in ("l_returnflag", "l_linestatus", "l_linenumber"):
            slots[murmur3(f"{c}={r[c]}".encode()) % 64] += 1.0
        for slot, v in slots.items():
            if v:
                want[tuple(r[k] for k in keys), slot, round(v, 6)] += 1
    assert got == want


def test_vector_indexer_and_chisq(spark):
    df = spark.createDataFrame([(Vectors.dense(5.0, 0.1, 2.0),), (Vectors.dense(9.0, 0.7, 2.0),), (Vectors.dense(5.0, 0.4, 2.0),)], ["a"])
    m = mf.VectorIndexer(maxCategories=2, inputCol="a", outputCol="i").fit(df)
    assert sorted(m.categoryMaps) == [0, 2]  # 0.1, 0.7, 0.4 are too many to be categories
    assert [list(r["i"]) for r in m.transform(df).collect()] == [[0.0, 0.1, 0.0], [1.0, 0.7, 0.0], [0.0, 0.4, 0.0]]
    # the second feature follows the label, the first does not
    data = [(Vectors.dense([float(i % 2), float(i // 4)]), float(i // 4)) for i in range(8)]
    sel = mf.UnivariateFeatureSelector(featuresCol="f", labelCol="y", outputCol="s", selectionMode="numTopFeatures") \
        .setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(1) \
        .fit(spark.createDataFrame(data, ["f", "y"]))
    assert sel.selectedFeatures == [1]


def test_evaluators(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    # hard predictions: AUC = (TPR + TNR) / 2 = (0.5 + 1) / 2
    assert abs(evaluate.binary_metric(df, "label", "prediction") - 0.75) < 1e-9
    assert abs(evaluate.multiclass_metric(df, "label", "prediction", "accuracy") - 0.75) < 1e-9
    reg = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "label double, prediction double")
    assert abs(evaluate.regression_metric(reg, "label", "prediction", "mae") - 0.5) < 1e-9


def test_registered_class_checks_fail_on_constant_predictions(spark, monkeypatch):
    """Each registered check, on its real test rows, with the commonest label predicted everywhere."""
    from tablework.plans import QUERIES, q_models

    real = q_models.models.fit_predict

    def constant(stages, train, test=None):
        model, pred = real(stages, train, test)
        most = pred.groupBy("label").count().orderBy("count", ascending=False).first()["label"]
        return model, pred.withColumn("prediction", F.lit(most))

    monkeypatch.setattr(q_models.models, "fit_predict", constant)
    for name in ("ml_tree_binary", "ml_forest_binary", "ml_logistic", "ml_svm", "ml_pipeline", "ml_score_labels", "ml_tree_multi"):
        assert not QUERIES[f"{name}_holds"](spark, SF_SMALL).first()["beats_guess"], name


def test_model_checks_fail_on_guesses(spark):
    from tablework.plans import q_models

    df = spark.createDataFrame([(float(i % 3 > 1), float(i)) for i in range(30)], "label double, x double")
    assert not q_models._class_check(df.selectExpr("label", "0D AS prediction"), [0.0, 1.0]).first()["beats_guess"]
    assert q_models._class_check(df.selectExpr("label", "label AS prediction"), [0.0, 1.0]).first()["beats_guess"]
    assert not q_models._value_check(df.selectExpr("x AS label", "14.5D AS prediction")).first()["bounded"]
    assert q_models._value_check(df.selectExpr("x AS label", "x + 1 AS prediction")).first()["bounded"]
