"""URL filters: allow and block rules matched by a sort-merge range join.

A rule is a host and a path prefix.  It fits the urls of its host and of all its
subdomains whose path starts with the rule's path; the longest rule wins.

Host labels are reversed (``www.example.com`` -> ``com.example.www``) and followed by
a separator and the path.  In that order a rule is the interval of all keys that
start with its own, and two intervals are nested or apart.  A url asks once for each
of its host suffixes with at most as many labels as the longest rule host, so a rule of
``example.com`` meets ``www.example.com`` under the key of the suffix ``example.com``.
Distinct keys and rules are dealt by literal bounds into ranges, sorted, and swept once
with a stack of the rules that are open at a key: the top of the stack is the longest
rule of that suffix.  A rule whose interval spans several ranges is sent to each of
them.  What a key has found is joined back to all addresses that asked for it.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, literal_bounds, lower_ascii, others, shuffle_partitions, staged

#: Stands between host and path; sorts below every character of either.
SEP = "\x00"
#: Above every key that starts with the text before it.
TOP = "\U0010ffff"


def url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``; both empty for a null url or one without ``://``.

    The host runs from the first ``://`` to the next ``/``, ``?`` or ``#`` and is
    lower-cased in A-Z; the path runs from there to ``?`` or ``#``.
    """
    rest = F.when(F.instr(F.col(f"`{url}`"), "://") > 0,
                  F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return df.select(*[F.col(f"`{c}`") for c in others(df, ["host", "path"])],
                     lower_ascii(host).alias("host"), path.alias("path"))


def _key(host, path):
    labels = F.reverse(F.split(host, r"\."))
    return F.concat(F.array_join(labels, "."), F.lit(SEP), path)


def _labels(host):
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def judge(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to each row.

    ``rules`` has host, path and verdict; hosts are taken in lower case, a null path
    as the empty prefix, rules without a host are ignored.  The longest rule (host
    and path together, then the longer host) decides; of rules with the same
    host and path the verdict that sorts last counts, so ``block`` beats ``allow``.  A url without a fitting rule has a null
    rule and the ``default`` verdict.  Rows that repeat a url are judged once and all
    get the verdict.
    """
    spark = df.sparkSession
    urls = url_parts(df, url)
    parts = shuffle_partitions(spark)
    # one row for each distinct address; a very common url is gathered before its shuffle
    asked = staged(urls.select("host", "path").distinct(), "url-keys")
    ruled = (rules.filter(F.col("host").isNotNull())
             .select(lower_ascii(F.col("host")).alias("h"), F.coalesce("path", F.lit("")).alias("p"), "verdict")
             .groupBy("h", "p").agg(F.max("verdict").alias("verdict"))
             .select(_key(F.col("h"), F.col("p")).alias("key"), F.concat("h", "p").alias("rule"),
                     F.length("h").alias("host_len"), "verdict"))
    # a suffix with more labels than any rule host can meet no rule
    most = rules.agg(F.max(_labels(F.col("host")))).first()[0] or 1
    keys = (asked.select("host", "path", F.explode(F.sequence(F.lit(1), F.least(F.lit(most), _labels(F.col("host"))))).alias("k"))
            .select("host", "path", _key(F.expr("substring_index(host, '.', -k)"), F.col("path")).alias("key")))
    swept = staged(keys.select("key").distinct(), "url-distinct-keys")
    bounds = [b[:512] for b in literal_bounds(swept, "key", parts * 4)]
    none = [F.lit(None).cast(t).alias(c) for c, t in (("rule", "string"), ("host_len", "int"), ("verdict", "string"))]
    dealt = swept.select("key", *none).unionByName(ruled)
    schema = T.StructType([T.StructField("part", T.IntegerType()), *dealt.schema.fields])

    def deal(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                first = bisect_right(bounds, r["key"])
                last = first if r["rule"] is None else bisect_right(bounds, r["key"] + TOP)
                out += [{"part": i, **r} for i in range(first, last + 1)]
            yield pa.RecordBatch.from_pylist(out, schema=ARROW_DEALT)

    def sweep(batches):
        part, stack = None, []
        for batch in batches:
            got = {"key": [], "rule": [], "host_len": [], "verdict": []}
            for r in batch.to_pylist():
                if r["part"] != part:
                    part, stack = r["part"], []
                while stack and not r["key"].startswith(stack[-1]["key"]):
                    stack.pop()
                if r["rule"] is not None:
                    stack.append(r)
                elif stack:
                    got["key"].append(r["key"])
                    for c in ("rule", "host_len", "verdict"):
                        got[c].append(stack[-1][c])
            yield pa.RecordBatch.from_pydict(got, schema=ARROW_HIT)

    # in a range, a rule comes before the keys that it fits, the shorter rule first
    found = (dealt.mapInArrow(deal, schema).repartition(parts, "part")
             .sortWithinPartitions("part", "key", F.col("rule").isNull())
             .mapInArrow(sweep, dealt.schema))
    best = keys.join(found, "key").groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("n"), "host_len", "rule", "verdict")).alias("w"))
    kept = others(df, ["host", "path", "rule", "verdict"])
    host, path = free_name(df, "host_"), free_name(df, "path_")
    best = staged(best.select(F.col("host").alias(host), F.col("path").alias(path),
                              F.col("w.rule").alias("rule"), F.col("w.verdict").alias("verdict")), "url-rules")
    return (urls.select(*[F.col(f"`{c}`") for c in kept], "host", "path")
            .join(best, (F.col("host") == F.col(host)) & (F.col("path") == F.col(path)), "left")
            .select(*[F.col(f"`{c}`") for c in kept], "host", "path", "rule",
                    F.coalesce("verdict", F.lit(default)).alias("verdict")))


ARROW_DEALT = pa.schema([("part", pa.int32()), ("key", pa.string()), ("rule", pa.string()), ("host_len", pa.int32()), ("verdict", pa.string())])
ARROW_HIT = pa.schema([("key", pa.string()), ("rule", pa.string()), ("host_len", pa.int32()), ("verdict", pa.string())])
