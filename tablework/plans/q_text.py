"""Text queries over ``documents`` / ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text
from ..tables import load
from .registry import query


@query("word_count", """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
GROUP BY word
""")
def word_count(spark, sf):
    return text.word_count(load(spark, sf, "documents"), "text")


@query("top_words", """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
WHERE word <> ''
GROUP BY word ORDER BY n DESC, word LIMIT 20
""")
def top_words(spark, sf):
    return text.top_words(text.word_count(load(spark, sf, "documents"), "text"), 20)


@query("explode_words", """
SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations
""")
def explode_words(spark, sf):
    return text.words(load(spark, sf, "conversations"), "text", keep=["conv_id", "turn"])


@query("split_nested", """
SELECT conv_id, turn, len(string_split(text, ' ')) AS n_tokens,
       array_to_string(string_split(text, ' '), chr(31)) AS tokens
FROM conversations
""")
def split_nested(spark, sf):
    """Each row keeps its tokens as one list (rendered with unit separators)."""
    df = text.split_list(load(spark, sf, "conversations"), "text", out="tokens")
    return df.select("conv_id", "turn", F.size("tokens").alias("n_tokens"),
                     F.array_join("tokens", "\x1f").alias("tokens"))


@query("filter_blank", """
SELECT conv_id, turn, line
FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM conversations)
WHERE length(trim(line)) > 0
""")
def filter_blank(spark, sf):
    lines = text.words(load(spark, sf, "conversations"), "text", sep="\n", out="line",
                       keep=["conv_id", "turn"])
    return lines.filter(F.length(F.trim("line")) > 0)


@query("filter_length", """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations)
WHERE length(word) = 5
GROUP BY word
""")
def filter_length(spark, sf):
    w = text.words(load(spark, sf, "conversations"), "text")
    return w.filter(F.length("word") == 5).groupBy("word").agg(F.count(F.lit(1)).alias("n"))

