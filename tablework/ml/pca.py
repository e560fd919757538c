"""Principal components from one aggregate.

Every task adds up the products of its rows' components; their sum, a matrix of the vectors' width, is all
that the driver needs.  Its leading eigenvectors come from subspace iteration, and their signs are
fixed by a rule, so the same data always give the same components.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Components:
    """``vectors`` has a component in each row, by falling variance; ``covariance`` is the sample covariance (n - 1)."""
    mean: np.ndarray
    covariance: np.ndarray
    vectors: np.ndarray
    variances: np.ndarray
    n: int

    def scores(self, values: str, center: bool = True) -> Column:
        """Array of the products of an array column with each component, of the vector less the mean if ``center``."""
        def product(v: np.ndarray) -> Column:
            terms = F.zip_with(F.col(values), F.lit(v.tolist()), lambda x, y: x.cast("double") * y)
            return F.aggregate(terms, F.lit(-float(v @ self.mean) if center else 0.0), lambda s, x: s + x)
        return F.array(*[product(v) for v in self.vectors])


def sums(df: DataFrame, values: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, sum and sum of products of an array column's rows; null rows are left out, all others have to have the same length."""
    v = df.filter(F.col(values).isNotNull()).select(F.transform(values, lambda x: x.cast("double")).alias("v"))
    low, high = v.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if low is None:
        raise ValueError("no vectors")
    if low != high:
        raise ValueError(f"vectors have {low} to {high} components")

    def run(batches):
        n, total, both = 0, np.zeros(low), np.zeros((low, low))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, low)
            n, total, both = n + len(x), total + x.sum(0), both + x.T @ x
        rows = np.vstack([np.append(total, n), np.hstack([both, np.zeros((low, 1))])])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(low + 1)), pa.array(rows.tolist(), pa.list_(pa.float64()))], names=["i", "row"])

    # a row for each component and task, added up before it reaches the driver
    got = (v.mapInArrow(run, "i long, row array<double>").groupBy("i")
           .agg(F.array(*[F.sum(F.get("row", F.lit(j))) for j in range(low + 1)]).alias("row")).collect())
    rows = np.zeros((low + 1, low + 1))
    for r in got:
        rows[r["i"]] = r["row"]
    return int(rows[0, -1]), rows[0, :-1], rows[1:, :-1]


def fit(df: DataFrame, values: str, k: int, tolerance: float = 1e-12, rounds: int = 10_000) -> Components:
    """The ``k`` components of greatest variance of an array column.

    Subspace iteration with a few spare vectors goes on until a round turns no component by more than ``tolerance``; it raises
    after ``rounds``.  Each component's entry of greatest magnitude (the first of equals) is positive.
    """
    n, total, both = sums(df, values)
    mean = total / n
    cov = (both - n * np.outer(mean, mean)) / max(1, n - 1)
    width = len(mean)
    if not 0 < k <= width:
        raise ValueError(f"{k} components of {width}")
    spare = min(width, k + 8)
    space = np.linalg.qr(np.random.default_rng(0).normal(size=(width, spare)))[0]
    before = np.zeros((width, k))
    for _ in range(rounds):
        space, _ = np.linalg.qr(cov @ space)
        small, turn = np.linalg.eigh(space.T @ cov @ space)
        space, small = space @ turn[:, ::-1], small[::-1]
        now = space[:, :k] * np.sign(np.take_along_axis(space[:, :k], np.abs(space[:, :k]).argmax(0)[None], 0))
        if np.abs(now - before).max() <= tolerance or np.abs(cov @ now - now * small[:k]).max() <= tolerance * max(small[0], 1e-300):
            return Components(mean, cov, now.T.copy(), small[:k].copy(), n)
        before = now
    raise RuntimeError(f"no fixed point within {rounds} rounds: components {k} and {k + 1} vary about equally")
