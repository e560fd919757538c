from collections import Counter

from tablework.operators import text

from .conftest import SF_SMALL


def test_word_count_matches_brute_force(spark):
    """Word count over every document of the small fixture equals a plain
    Python count of ``line.split(" ")`` tokens (empty tokens kept)."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r["word"]: r["n"] for r in text.word_count(docs, "text").collect()}
    want = Counter(w for r in docs.select("text").collect() for w in r["text"].split(" "))
    assert got == dict(want)


def test_drop_empty_and_top(spark):
    df = spark.createDataFrame([("a  b a",), ("b a",)], "text string")
    wc = {r["word"]: r["n"] for r in text.word_count(df).collect()}
    assert wc == {"a": 3, "b": 2, "": 1}
    wc2 = {r["word"]: r["n"] for r in text.word_count(df, drop_empty=True).collect()}
    assert "" not in wc2
    top = [r["word"] for r in text.top_words(text.word_count(df), 1).collect()]
    assert top == ["a"]


def test_split_list_keeps_nesting(spark):
    df = spark.createDataFrame([("x y",), ("z",)], "text string")
    got = sorted(len(r["tokens"]) for r in text.split_list(df).collect())
    assert got == [1, 2]
