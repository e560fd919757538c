"""Small column helpers shared by operators and queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r(c: Column | str, digits: int = 4) -> Column:
    """Round a double to ``digits`` places as ``round(x * 10^d) / 10^d``.

    This is the binary-exact rounding of IEEE engines: the result depends only
    on the double itself, so engines agree even when the value sits on an
    exact decimal tie (plain ``F.round`` rounds the shortest decimal string
    half-up, which can differ on such ties).
    """
    p = float(10 ** digits)
    return F.round(col(c).cast("double") * F.lit(p), 0) / F.lit(p)


def ts_str(c: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp rendered as text so both engines compare the same value."""
    return F.date_format(col(c), fmt)


def join_array(c: Column | str, sep: str = ",") -> Column:
    return F.array_join(col(c), sep)


def literal_cuts(df: DataFrame, key: list[str], parts: int, per_part: int = 32, seed: int = 7) -> list[tuple]:
    """At most ``parts - 1`` ascending key tuples that cut ``df`` into parts of about equal size.

    They come from a random sample of about ``parts * per_part`` keys, drawn where
    the rows are, and are plain values from then on, so every evaluation of a
    plan that uses them deals rows alike.  Null keys sort first and are never a cut.
    """
    share = min(1.0, parts * per_part / max(1, df.count()))
    got = df.select(*key).dropna().sample(share, seed=seed).collect()
    keys = sorted(tuple(r) for r in got)
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []
