"""The registered queries: each operator over its whole table, and the digests its contract asks for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import load
from . import (bpe, chat, cws, embed_dedup, infill, packing, passages, pii, pst, simhash, toxicity, urlrules,
               vector_codes)
from .common import staged_rows

QUERIES = {}
ORACLE = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(path: str) -> bytes:
    """Content of a tokenizer file (about 1 MB); read where the query is built and sent with its functions."""
    with open(path, "rb") as f:
        return f.read()


@_query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.encode(docs, data, public_tokenizers.PATTERN, keep=["doc_id"], with_decoded=True)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@_query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(load(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"), c["end"].cast("string"))), ",")

    base = F.filter("pii", lambda c: c["base"])

    def count(kind):
        return F.size(F.filter("pii", lambda c: c["base"] & (c["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


@_query
def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = staged_rows(spark, RULES, "host string, path string, verdict string", "rules")
    judged = urlrules.judge(load(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_CASES = "".join(f" WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
                 for h, p, _ in sorted(RULES, key=lambda r: -len(r[0] + r[1])))
_BLOCKED = ", ".join(f"'{h}{p}'" for h, p, v in RULES if v == "block")
ORACLE["op3_url_rules"] = rf"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT *, CASE{_CASES} ELSE NULL END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ({_BLOCKED}) THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


@_query
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    awkward = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(awkward).alias("text"))
    return chat.read_back(chat.format_turns(rows.unionByName(extra)))


@_query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, training_labels(load(spark, sf_dir, "labels")))
    return toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def held_out():
    """Whether a document's labels are kept from training."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", "toxic").filter(~held_out())


@_query
def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(load(spark, sf_dir, "embeddings"))


ORACLE["op6_embedding_dedup"] = """
WITH RECURSIVE unit AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM unit UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN degree USING (vec_id)
"""


@_query
def op7_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = cws.edit_and_compare(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_chars", "edited_sha256", cws.as_text(F.col("samples")).alias("fingerprint"),
                       cws.as_text(F.col("edited_samples")).alias("edited_fingerprint"), "near_edited", "near_next")


@_query
def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pst.score(load(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    packed = packing.pack(load(spark, sf_dir, "documents").select("doc_id", "text"), data)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
                         "tier", "step_group")


@_query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.transform(load(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE["op11_infill"] = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
numbers AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || substr(d, 1, 8))::BIGINT % (len(u) + 1) AS a,
         ('0x' || substr(d, 9, 8))::BIGINT % (len(u) + 1) AS b,
         ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4 FROM cut),
formed AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS pre, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS mid,
         array_to_string(u[greatest(a, b) + 1:], '') AS suf,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM formed
"""


@_query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, entries = vector_codes.compress(load(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.sha256(entries)).alias("codebooks_sha256"))


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every round as a table: the parts' distances to all entries, the nearest, the moved entries."""
    out = [f"""
WITH kept AS (
  SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) r(p)),
first AS (SELECT id, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM kept QUALIFY e < {entries}),
book0 AS MATERIALIZED (SELECT p, e, x AS y FROM cut JOIN first USING (id))"""]
    for i in range(rounds + 1):
        out.append(f"""
near{i} AS MATERIALIZED (
  SELECT id, p, any_value(x) AS x, min(struct_pack(d := list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := e)) AS best
  FROM cut JOIN book{i} USING (p) GROUP BY id, p)""")
        if i < rounds:
            out.append(f"""
mean{i} AS (
  SELECT p, e, list(m ORDER BY j) AS y FROM (
    SELECT p, best.e AS e, j, floor(sum(x[j]) / count(*))::BIGINT AS m
    FROM near{i}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM cut) + 1)) AS j) GROUP BY p, best.e, j) GROUP BY p, e),
book{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(mean{i}.y, book{i}.y) AS y FROM book{i} LEFT JOIN mean{i} USING (p, e))""")
    return ",".join(out) + f""",
done AS (SELECT id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM done JOIN kept USING (id)
"""


ORACLE["op12_vector_codes"] = _codes_sql()


@_query
def op13_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = passages.remove_repeats(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE["op13_passages"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
word AS (SELECT id, doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM docs),
win AS (
  SELECT id, doc_id, i, md5(array_to_string(d.w[i:i + 49], ' ')) AS h
  FROM docs d, LATERAL (SELECT unnest(range(1, len(d.w) - 48)) AS i)),
least AS (SELECT h, min(doc_id) AS low FROM win GROUP BY h),
hit AS (SELECT id, i FROM win JOIN least USING (h) WHERE low < doc_id),
marked AS (
  SELECT word.id, word.i, word.w, count(hit.i) OVER (PARTITION BY word.id ORDER BY word.i ROWS 49 PRECEDING) > 0 AS gone
  FROM word LEFT JOIN hit ON word.id = hit.id AND word.i = hit.i),
done AS (
  SELECT id, count(*) FILTER (gone) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM marked GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN done USING (id)
"""
