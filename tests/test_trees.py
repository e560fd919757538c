"""Trees as tables against the models they come from."""
import random

import pytest
from pyspark.ml.feature import VectorAssembler, VectorIndexer

from tablework.ml import models, trees

from .conftest import rows


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(11)
    made = [(i, rng.uniform(-5, 5), float(rng.randint(0, 4)), rng.choice([0.5, 1.5, 2.5])) for i in range(600)]
    made = [(i, a, c, b, float((a > 1) + (c in (1.0, 3.0))), a * b + 10 * (c in (0.0, 2.0))) for i, a, c, b in made]
    df = spark.createDataFrame(made, "id long, a double, c double, b double, kind double, y double")
    df = VectorAssembler(inputCols=["a", "c", "b"], outputCol="raw").transform(df)
    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5).fit(df).transform(df)  # c and b are categories


@pytest.mark.parametrize("kind, label, params, classes", [
    ("tree_classifier", "kind", {"maxDepth": 5}, 3), ("forest_classifier", "kind", {"maxDepth": 4, "numTrees": 5}, 3),
    ("tree_regressor", "y", {"maxDepth": 6}, None), ("forest_regressor", "y", {"maxDepth": 4, "numTrees": 5}, None),
    ("tree_classifier", "kind", {"maxDepth": 0}, 3)])
def test_descent_equals_transform(spark, data, kind, label, params, classes):
    model = models.estimator(kind, label=label, seed=3, **params).fit(data)
    table = trees.nodes(spark, model)
    assert trees.depth(table) <= params["maxDepth"]
    own = dict(rows(trees.predict(data, table, ["id"], classes)))
    for r in model.transform(data).select("id", "prediction").collect():
        assert own[r["id"]] == pytest.approx(r["prediction"], abs=1e-9)


def test_rules_select_the_rows_of_their_leaf(spark, data):
    model = models.estimator("tree_classifier", label="kind", seed=3, maxDepth=4).fit(data)
    table = trees.nodes(spark, model)
    leaves = trees.rules(table, ["a", "c", "b"]).collect()
    assert sum(r["n"] for r in leaves) == 600 and len({r["id"] for r in leaves}) == len(leaves) and any(" in (" in r["rule"] for r in leaves)
    # VectorIndexer numbers the categories of b by size
    at = data.selectExpr("id", "a", "c", "case b when 0.5 then 0D when 1.5 then 1D else 2D end as b")
    down = {r["id"]: r["leaf"] for r in trees.descend(data, table).select("id", "leaf").collect()}
    for r in leaves:
        chosen = at.filter(r["rule"]) if r["rule"] else at
        assert {x["id"] for x in chosen.collect()} == {i for i, leaf in down.items() if leaf == r["id"]}
        assert len([1 for leaf in down.values() if leaf == r["id"]]) == r["n"]
