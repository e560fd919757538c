"""Inner product search and ridge validation against numpy."""
import numpy as np
import pytest

from tablework.ml import inner_product, pca, recommend, ridge

from .conftest import rows


def best(users, items, k):
    out = []
    for u, f in users:
        ranked = sorted((-sum(a * b for a, b in zip(f, g)), i) for i, g in items)
        out += [(u, i, -s) for s, i in ranked[:k]]
    return sorted(out)


def test_top_products_equal_brute_force(spark):
    """Whole numbers, so that equal scores are equal; users and items without length, negative factors, ties."""
    rng = np.random.default_rng(2)
    items = [(i, (rng.integers(-3, 4, 4) * (20 if i % 37 == 0 else 1)).tolist()) for i in range(300)] + [(300, [0, 0, 0, 0])]
    users = [(f"u{i:03d}", rng.integers(-5, 6, 4).tolist()) for i in range(90)] + [("z", [0, 0, 0, 0]), ("y", [-1, -1, -1, -1])]
    u = spark.createDataFrame([(a, [float(x) for x in f]) for a, f in users] + [(None, [1.0] * 4), ("null", None)], "user string, features array<float>")
    i = spark.createDataFrame([(a, [float(x) for x in f]) for a, f in items] + [(None, [9.0] * 4)], "item long, features array<float>")
    for k, block in ((4, 16), (7, 4096), (1, 1)):
        got, computed = inner_product.top_products(u, i, k, block=block, chunk=25)
        assert rows(got) == best(users, items, k)
        assert computed <= 91 * 301 and (block != 16 or computed < 0.7 * 91 * 301)
    few, _ = inner_product.top_products(u, i.filter("item < 3"), 5)
    assert rows(few) == best(users, items[:3], 5)
    none, computed = inner_product.top_products(u, i.limit(0), 5)
    assert none.count() == 0 and computed == 0
    assert inner_product.top_products(u.limit(0), i, 5)[0].count() == 0


def test_top_products_hold_no_chunk_in_a_row(spark, monkeypatch):
    """Users and items travel as rows of their own, in memory and in the shuffle, so no batch grows with chunk times blocks."""
    staged, stage = [], inner_product.stage
    monkeypatch.setattr(inner_product, "stage", lambda df, label: staged.append((label, df.schema.simpleString())) or stage(df, label))
    u = spark.createDataFrame([(a, [1.0, float(a)]) for a in range(9)], "user int, features array<double>")
    i = spark.createDataFrame([(a, [float(a), 2.0]) for a in range(9)], "item int, features array<double>")
    assert inner_product.top_products(u, i, 2, block=4, chunk=4)[0].count() == 18
    assert len(staged) > 5 and not [x for x in staged if "array<struct" in x[1]]


def test_ridge_equals_fits_on_rows(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(0, [1, 5, 0.1], (400, 3))
    y = 3 + x @ [2, -0.5, 7] + rng.normal(0, 0.3, 400)
    fold = rng.integers(0, 4, 400)
    data = [(int(f), *map(float, r), float(v)) for f, r, v in zip(fold, x, y)] + [(0, None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(data, "fold int, a double, b double, c double, y double")
    got = {(r["fold"], r["penalty"]): r for r in ridge.cross_validate(df, ["a", "b", "c"], "y", "fold", [0.0, 50.0]).collect()}
    assert len(got) == 8
    for (f, p), r in got.items():
        t, h = fold != f, fold == f
        centred = x[t] - x[t].mean(0)
        w = np.linalg.solve(centred.T @ centred + p * np.eye(3), centred.T @ (y[t] - y[t].mean()))
        c = y[t].mean() - x[t].mean(0) @ w
        assert [r["intercept"], r["w_a"], r["w_b"], r["w_c"]] == pytest.approx([c, *w], abs=2e-6)
        assert r["rmse"] == pytest.approx(np.sqrt(np.mean((y[h] - c - x[h] @ w) ** 2)), abs=2e-6) and r["n_train"] == t.sum()
    table = ridge.cross_validate(df, ["a", "b", "c"], "y", "fold", [0.0, 50.0])
    assert ridge.best(table).first()["penalty"] == 0.0
    # a feature that is twice another: still a solution
    assert ridge.cross_validate(df.selectExpr("fold", "a", "2 * a as b", "y"), ["a", "b"], "y", "fold", [0.0]).count() == 4


def test_components_equal_an_eigendecomposition(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 6)) @ np.diag([5, 3, 3.001, 1, 0.5, 0]) @ rng.normal(size=(6, 6)) + 2
    df = spark.createDataFrame([(v.tolist(),) for v in x] + [(None,)], "v array<double>").repartition(7)
    c = pca.fit(df, "v", 3)
    w, e = np.linalg.eigh(np.cov(x.T))
    assert c.n == 500 and c.variances == pytest.approx(w[::-1][:3], rel=1e-9)
    assert np.abs(np.abs(c.vectors @ e[:, ::-1][:, :3]) - np.eye(3)).max() < 1e-6
    assert all(v[np.abs(v).argmax()] > 0 for v in c.vectors)
    own = np.array([r["s"] for r in df.filter("v is not null").select(c.scores("v").alias("s")).collect()])
    assert sorted(own[:, 0]) == pytest.approx(sorted((x - x.mean(0)) @ c.vectors[0]), abs=1e-9)
    assert pca.fit(df, "v", 6).variances[-1] == pytest.approx(0, abs=1e-9)
    for bad in (df.limit(0), df.unionAll(spark.createDataFrame([([1.0],)], "v array<double>"))):
        with pytest.raises(ValueError):
            pca.fit(bad, "v", 1)


def test_sparse_layout_of_a_crowded_column(spark):
    data = [(u, 1 if u % 3 else u % 7, float(u)) for u in range(200)]
    lay = recommend.csc_entries(spark.createDataFrame(data, "u long, i long, v double"), "u", "i", "v", 4)
    ranked = sorted(data, key=lambda e: (e[1], e[0]))
    place = [sum(1 for f in ranked[:k] if f[1] == e[1]) for k, e in enumerate(ranked)]
    assert rows(lay, "at", "place", "i", "u", "v") == [(k, p, e[1], e[0], e[2]) for k, (p, e) in enumerate(zip(place, ranked))]
    x = spark.createDataFrame([(1, 2.0), (0, -1.0)], "i long, w double")
    got = dict(rows(recommend.csc_times(lay, x, "u", "i", "v", "w")))
    assert got == {u: v * {1: 2.0, 0: -1.0}[i] for u, i, v in data if i in (0, 1)}
