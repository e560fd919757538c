"""Document fingerprints by consistent weighted sampling.

A text is the set of its words weighted by how often they occur.  For each term and
each of the samples, a hash gives fixed random values r and c (gamma distributed with
shape 2) and beta (uniform); with t = floor(ln(weight) / r + beta) the term bids
ln(c) - r * (t - beta) - r.  The lowest bid of a text is its sample.  Two texts agree
in a sample with a chance equal to the generalised Jaccard similarity of their terms:
the sum of smaller weights over the sum of greater ones.

All of it is DataFrame expressions.  The bids are plain columns of one aggregate, so
they run in generated code; the gamma values are read from small quantile tables
that are built by rule (a logarithm is taken only below the first quantile).
"""

from __future__ import annotations

from math import exp, log, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, lower_ascii, shuffle_partitions

SAMPLES = 64
NODES = 64


def _gamma_quantile(u: float) -> float:
    """c with 1 - exp(-c) * (1 + c) = u, by bisection."""
    low, high = 0.0, 60.0
    for _ in range(100):
        c = (low + high) / 2
        low, high = (c, high) if 1 - exp(-c) * (1 + c) < u else (low, c)
    return (low + high) / 2


def terms(text: Column) -> Column:
    """array<struct<h, tf>>: each distinct word's hash and count; the empty text has one term of its own."""
    words = F.filter(F.split(lower_ascii(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))

    def runs(s: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                         lambda i: (i == 0) | (F.get(s, i) != F.get(s, F.greatest(i - 1, F.lit(0)))))
        return let(first, lambda at: F.transform(at, lambda p, j: F.struct(
            F.get(s, p).alias("h"), (F.coalesce(F.get(at, j + 1), F.size(s)) - p).alias("tf"))))

    none = F.array(F.struct(F.xxhash64(F.lit("")).alias("h"), F.lit(1).alias("tf")))
    return let(hashes, lambda s: F.when(F.size(s) == 0, none).otherwise(runs(s)))


def _bid(h: Column, log_weight: Column, k: int) -> Column:
    """The term's bid in sample ``k``."""
    steps = [_gamma_quantile((i + 0.5) / NODES) for i in range(NODES)]
    marks = [log(_gamma_quantile(min((i or 1e-9) / NODES, 1 - 1e-6))) for i in range(NODES + 1)]
    bits = F.xxhash64(h, F.lit(k))
    r = F.get(F.lit(steps), bits.bitwiseAND(63).cast("int"))
    beta = F.shiftrightunsigned(bits, 6).bitwiseAND(0xFFFF) / F.lit(65536.0)
    cell = F.shiftrightunsigned(bits, 58).cast("int")
    part = F.shiftrightunsigned(bits, 22).bitwiseAND((1 << 36) - 1).cast("double") / F.lit(float(1 << 36))
    u = (part + F.lit(1e-12)) / NODES  # only for the first cell
    low = F.lit(0.5) * F.log(2 * u) + F.sqrt(2 * u) / 3
    rise = [b - a for a, b in zip(marks, marks[1:])]
    log_c = F.when(cell == 0, low).otherwise(F.get(F.lit(marks), cell) + part * F.get(F.lit(rise), cell))
    t = F.floor(log_weight / r + beta)
    return log_c + r * (beta - t - 1)


def likeness(a: Column, b: Column) -> Column:
    """Share of samples in which two fingerprints agree."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.lit(float(SAMPLES))


def as_text(samples: Column) -> Column:
    """A fingerprint as text: four hexadecimal digits of a hash of each sample."""
    return F.array_join(F.transform(samples, lambda x: F.lower(F.lpad(F.hex(F.xxhash64(x).bitwiseAND(0xFFFF)), 4, "0"))), "")


def fingerprints(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    """``by`` and ``samples`` (array<float>), the fingerprint of ``text``, for each value of ``by``.

    A null text counts as empty; an empty text has one term of its own, so empty
    texts agree with each other and with nothing else.  Rows that repeat ``by`` are
    sampled together: with equal texts that is the text's fingerprint.  The bids of
    a row are reduced where they are made, before any shuffle.
    """
    cols = [F.col(f"`{c}`") for c in by]
    term = df.select(*cols, F.explode(terms(F.coalesce(F.col(f"`{text}`"), F.lit("")))).alias("t_")).select(
        *cols, F.col("t_.h").alias("h_"),
        F.when(F.col("t_.tf") == 1, F.lit(0.0)).otherwise(F.log(F.col("t_.tf").cast("double"))).alias("w_"))
    bids = [F.min(_bid(F.col("h_"), F.col("w_"), k).cast("float")).alias(f"s_{k}") for k in range(SAMPLES)]
    return term.groupBy(*cols).agg(*bids).select(*cols, F.array(*[F.col(f"s_{k}") for k in range(SAMPLES)]).alias("samples"))


def edit_and_compare(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every text and an edited copy, and compare them with each other and with the next text.

    Returns ``key``, n_chars, edited_sha256, samples, edited_samples (array<float>),
    near_edited and near_next (double).  The edited text has its last quarter (rounded
    down) replaced by as much from the start of the next text in ascending order of
    the numeric ``key``, nulls first, equal keys by text; the first text follows the
    last.  Null texts count as empty; repeated rows each get a row; an empty table
    gives none.

    Rows are dealt once into ranges of keys by literal cuts at approximate quantiles
    (any cut gives the same result), and the first row of a range is sent to the range
    before it as well; all the rest happens inside a range.
    """
    parts = shuffle_partitions(df.sparkSession)
    rows = df.select(F.col(f"`{key}`").alias("id_"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    share = [i / (4 * parts) for i in range(1, 4 * parts)]
    cuts = sorted(set(rows.agg(F.percentile_approx("id_", share, 10_000)).collect()[0][0] or []))
    rank = _rank(F.col("id_"), cuts)
    firsts = (rows.select("id_", rank.alias("bucket")).groupBy("bucket")
              .agg(F.min(F.struct("id_")).alias("first")).orderBy("bucket").collect())  # a row for each range
    if not firsts:
        firsts = [{"bucket": 0, "first": {"id_": None}}]
    numbers = [r["bucket"] for r in firsts]
    kind = rows.schema["id_"].dataType.simpleString()
    first_of = F.create_map(*[F.lit(x) for r in firsts for x in (r["bucket"], r["first"]["id_"])]).cast(f"map<int,{kind}>")
    before = F.create_map(*[F.lit(x) for b, a in zip(numbers, [numbers[-1], *numbers[:-1]]) for x in (b, a)])
    to = F.when(F.col("id_").eqNullSafe(F.element_at(first_of, F.col("rank"))), F.array(
        F.struct(F.col("rank").alias("bucket"), F.lit(0).alias("copy")),
        F.struct(F.element_at(before, F.col("rank")).alias("bucket"), F.lit(1).alias("copy")))).otherwise(
        F.array(F.struct(F.col("rank").alias("bucket"), F.lit(0).alias("copy"))))
    dealt = (rows.withColumn("rank", rank).withColumn("to", F.explode(to))
             .select("id_", "text", "to.bucket", "to.copy").repartition(parts, "bucket"))
    order = Window.partitionBy("bucket").orderBy("copy", "id_", "text")
    n, quarter = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 4) as int))"),
                      F.expr("left(coalesce(next, ''), cast(floor(length(text) / 4) as int))"))
    ready = (dealt.withColumn("at", F.row_number().over(order)).withColumn("next", F.lead("text").over(order))
             .select("bucket", "at", "copy", "id_", n.cast("long").alias("n_chars"), "text",
                     F.when((F.col("copy") == 0) & (quarter >= 0), edited).alias("edited")))
    # own text first, then the edited one: with the next row's own text these are the rows to compare
    both = ready.select("bucket", "at", "copy", "id_", "n_chars", F.explode(F.filter(F.array(
        F.struct(F.lit(0).alias("tag"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("tag"), F.col("edited").alias("body"))), lambda x: x["body"].isNotNull())).alias("x")).select(
        "bucket", "at", "copy", "id_", "n_chars", "x.tag", "x.body",
        F.when(F.col("x.tag") == 1, F.sha2(F.col("x.body").cast("binary"), 256)).alias("sha"))
    printed = fingerprints(both, "body", ["bucket", "at", "copy", "id_", "n_chars", "tag", "sha"])
    line = Window.partitionBy("bucket").orderBy("at", "tag")
    lined = printed.select("*", F.lead("samples").over(line).alias("edited_samples"), F.lead("sha").over(line).alias("edited_sha256"),
                           F.lead("samples", 2).over(line).alias("next_samples"))
    return lined.filter("copy = 0 and tag = 0").select(
        F.col("id_").alias(key), "n_chars", "edited_sha256", "samples", "edited_samples",
        likeness(F.col("samples"), F.col("edited_samples")).alias("near_edited"),
        likeness(F.col("samples"), F.col("next_samples")).alias("near_next"))


def _rank(key: Column, cuts: list) -> Column:
    """Number of cuts below ``key`` (none for a null key), found in two steps."""
    if not cuts:
        return F.lit(0)
    wide = max(1, round(sqrt(len(cuts))))
    coarse = F.size(F.filter(F.lit(cuts[::wide]), lambda c: c < key))
    base = F.greatest(coarse - 1, F.lit(0)) * wide
    return base + F.size(F.filter(F.slice(F.lit(cuts), base + 1, wide), lambda c: c < key))
