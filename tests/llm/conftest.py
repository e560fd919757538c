import pytest

from tablework.llm import queries

from ..conftest import SF_SMALL, rows  # noqa: F401


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with the cases that every operator has to stand: nulls, empty and blank texts, very long
    ones, repeated rows, ties, other scripts, control characters."""
    long = " ".join(f"word{i % 701}" for i in range(30_000))
    texts = [None, "", " \t\n ", "the cat sat on the mat", "the cat sat on the mat", "The CAT sat\ton the  mat",
             long, long + " end", "x" * 5000, "naïve café Ünïcode 中文 \U0001F600 ok", "a\x1cb\x85c d", "'s don't  I'll ",
             "one", "one two", "<|startoftext|> <|endoftext|>", "\\### a </turn> b"]
    data = [(i, t, "en", "s", 0 if t is None else len(t)) for i, t in enumerate(texts)]
    data += [data[3], (None, "the cat sat on the mat", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def clashing(docs):
    """The same with extra columns named like outputs and helpers."""
    from pyspark.sql import functions as F

    extra = ["ids", "Decoded", "score", "predicted", "fp", "component_id", "pii", "spans", "row", "part", "gid", "key",
             "text_in", "start", "id_", "candidates_", "samples", "token"]
    return docs.select("*", *[F.lit(f"mine {c}").alias(c) for c in extra])


def small(spark, table):
    return spark.read.parquet(f"{SF_SMALL}/{table}.parquet")


def run(spark, name):
    return [r.asDict() for r in queries.QUERIES[name](spark, SF_SMALL).collect()]
