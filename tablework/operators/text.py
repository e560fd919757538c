"""Text operators: tokenising and word counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def words(df: DataFrame, col: str = "text", sep: str = " ", out: str = "word",
          drop_empty: bool = False, keep: list[str] | None = None) -> DataFrame:
    """One row per token of ``col`` split on the literal separator ``sep``.

    Like a ``flatMap(line.split(sep))`` this keeps empty tokens between
    consecutive separators unless ``drop_empty`` is set.
    """
    pattern = _literal_regex(sep)
    tok = F.explode(F.split(F.col(col), pattern)).alias(out)
    keep = [c for c in (keep or []) if c != col]
    res = df.select(*keep, tok)
    if drop_empty:
        res = res.filter(F.col(out) != "")
    return res


def word_count(df: DataFrame, col: str = "text", sep: str = " ",
               drop_empty: bool = False, out: str = "word", count: str = "n") -> DataFrame:
    """Count every token.  The aggregation is partial (map-side) before the
    shuffle, so a hot word costs one row per task, not one row per use."""
    return (words(df, col, sep, out, drop_empty)
            .groupBy(out).agg(F.count(F.lit(1)).alias(count)))


def top_words(counts: DataFrame, k: int, word: str = "word", count: str = "n",
              drop_empty: bool = True) -> DataFrame:
    """The ``k`` most frequent words; ties broken by the word itself."""
    if drop_empty:
        counts = counts.filter(F.col(word) != "")
    return counts.orderBy(F.col(count).desc(), F.col(word).asc()).limit(k)


def split_list(df: DataFrame, col: str = "text", sep: str = " ", out: str = "tokens") -> DataFrame:
    """``map(line.split(sep))``: keep each line's tokens as one array."""
    return df.withColumn(out, F.split(F.col(col), _literal_regex(sep)))


def _literal_regex(sep: str) -> str:
    import re
    return re.escape(sep)
