"""Ridge regression over a grid of penalties and folds from one scan.

The sums of products of (1, features, label) over a fold are all that least squares needs of it.  One
aggregate makes them for every fold; a fold's training sums are the total less its own, so each
fold and penalty is solved, and its validation error computed, without another look at the rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gram(df: DataFrame, features: list[str], label: str, fold: str) -> dict:
    """Sums of products of (1, features, label) for each fold; rows with a null among them are left out.

    One row of (p + 2) (p + 3) / 2 sums for each fold reaches the driver.
    """
    z = [F.lit(1.0), *[F.col(c).cast("double") for c in [*features, label]]]
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    rows = df.dropna(subset=[*features, label, fold]).groupBy(fold).agg(*[F.sum(z[i] * z[j]).alias(f"g_{i}_{j}") for i, j in pairs])
    out = {}
    for r in rows.collect():
        g = np.zeros((len(z), len(z)))
        for i, j in pairs:
            g[i, j] = g[j, i] = r[f"g_{i}_{j}"]
        out[r[fold]] = g
    return out


def solve(g: np.ndarray, penalty: float) -> np.ndarray:
    """(intercept, weights) that minimise the squared error plus ``penalty`` times the squared weights.

    Features that do not vary apart get the shortest solution.
    """
    n, sx = g[0, 0], g[0, 1:-1]
    mean = sx / n
    a = g[1:-1, 1:-1] - np.outer(sx, mean) + penalty * np.eye(len(sx))
    b = g[1:-1, -1] - mean * g[0, -1]
    w = np.linalg.lstsq(a, b, rcond=1e-13)[0]
    return np.concatenate([[g[0, -1] / n - mean @ w], w])


def squared_error(g: np.ndarray, solution: np.ndarray) -> float:
    """Sum of squared errors of ``solution`` over the rows whose sums ``g`` holds."""
    c = np.append(-solution, 1.0)
    return float(c @ g @ c)


def cross_validate(df: DataFrame, features: list[str], label: str, fold: str, penalties: list[float], digits: int = 6) -> DataFrame:
    """A row for each fold and penalty: fold, penalty, n_train, intercept, a weight for each feature, and rmse over the fold.

    A fold that holds all rows has nothing to learn from and is left out.
    """
    sums = gram(df, features, label, fold)
    total = sum(sums.values())
    out = []
    for k, own in sums.items():
        rest = total - own
        if rest[0, 0] <= 0:
            continue
        for p in penalties:
            s = solve(rest, p)
            rmse = float(max(squared_error(own, s), 0.0) / own[0, 0]) ** 0.5
            out.append((k, float(p), int(rest[0, 0]), *[round(float(x), digits) + 0.0 for x in s], round(rmse, digits)))
    kind = df.schema[fold].dataType.simpleString()
    names = ", ".join(f"`w_{f}` double" for f in features)
    return df.sparkSession.createDataFrame(out, f"`{fold}` {kind}, penalty double, n_train long, intercept double, {names}, rmse double")


def best(table: DataFrame) -> DataFrame:
    """(penalty, rmse): the penalty with the least mean error over the folds (ties: the greatest)."""
    mean = table.groupBy("penalty").agg(F.avg("rmse").alias("rmse"))
    return mean.orderBy("rmse", F.col("penalty").desc()).limit(1)
