"""Fill-in-the-middle, vector codes and removal of repeated passages against plain Python."""
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablework.llm import infill, passages, vector_codes
from tablework.llm.common import coded_words

from .conftest import run, small


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# fill in the middle

def filled(key, text):
    text = text or ""
    unit = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = infill.choices(key)
    low, high = sorted((h[0] % (len(unit) + 1), h[1] % (len(unit) + 1)))
    pre, mid, suf = ("".join(u) for u in (unit[:low], unit[low:high], unit[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(unit), "plain", None, None, text
    out = f"<S>{suf}<P>{pre}<M>{mid}" if h[3] % 100 < 20 else f"<P>{pre}<S>{suf}<M>{mid}"
    return len(unit), "spm" if h[3] % 100 < 20 else "psm", len(pre), len(mid), out


@pytest.fixture(scope="module")
def awkward(spark, docs):
    texts = ["<P", "<", "ab<P>c", "< S>", "<S", "M>", "<<<P", "é<é>", "<M" * 50, "word " * 20_000, "y" * 200_000, "é" * 40_000 + "x" * 70_000]
    more = [(1000 + i, t) for i, t in enumerate(texts * 6)] + [(7, "same id, other text"), (7, "same id, other text")]
    return docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))


def test_infill_equals_plain_python(spark, awkward):
    got = infill.transform(awkward, with_text=True)
    want = sorted(((r["doc_id"] is None, r["doc_id"], *filled(r["doc_id"], r["text"]), r["text"] or "") for r in awkward.collect()), key=repr)
    assert sorted(((r["doc_id"] is None, r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"])
                   for r in got.collect()), key=repr) == want
    digests = infill.transform(awkward).select("output_sha256", "restored_sha256").collect()
    assert sorted(tuple(r) for r in digests) == sorted((sha(w[6]), sha(w[7])) for w in want)
    assert {w[3] for w in want} == {"plain", "psm", "spm"}


def test_infill_reads_no_other_column_and_stands_an_empty_table(spark, clashing, docs):
    out = infill.transform(clashing.withColumn("form", F.lit(1)).withColumn("output_sha256", F.lit(2)))
    assert out.count() == docs.count() and dict(out.dtypes)["form"] == "string"
    assert infill.transform(docs.limit(0)).count() == 0
    with pytest.raises(TypeError):
        infill.transform(docs.withColumn("doc_id", F.lit("a")))


def test_parser_takes_any_chunks():
    rng = random.Random(4)
    for _ in range(300):
        p, m, s = ("".join(rng.choice("<PSM>ab") for _ in range(rng.randint(0, 8))) for _ in range(3))
        if any(x in p + m + s for x in ("<P>", "<S>", "<M>")):
            continue
        form, out = rng.choice([("psm", f"<P>{p}<S>{s}<M>{m}"), ("spm", f"<S>{s}<P>{p}<M>{m}"), ("plain", p + m + s)])
        parser, found, at = infill.Parser(form), [], 0
        while at < len(out):
            n = rng.randint(1, 5)
            found += parser.feed(out[at:at + n].encode())
            at += n
        found += parser.end()
        assert b"".join(b for _, _, b in sorted(found)).decode() == p + m + s


def test_infill_has_one_shuffle(spark, docs):
    plan = infill.transform(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 2


def test_op11_equals_plain_python(spark):
    want = {r["doc_id"]: (*filled(r["doc_id"], r["text"]), r["text"] or "") for r in small(spark, "documents").collect()}
    got = {r["doc_id"]: r for r in run(spark, "op11_infill")}
    assert set(got) == set(want)
    for k, (n, form, pre, mid, out, text) in want.items():
        r = got[k]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, pre, mid)
        assert (r["output_sha256"], r["restored_sha256"]) == (sha(out), sha(text))


# repeated passages

def kept_words(rows, w):
    """(key, words, kept words) of each row, judged window by window."""
    split = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    least = {}
    for k, ws in split:
        k = passages.NULL_KEY if k is None else k
        for i in range(len(ws) - w + 1):
            least[tuple(ws[i:i + w])] = min(k, least.get(tuple(ws[i:i + w]), k))
    out = []
    for k, ws in split:
        me = passages.NULL_KEY if k is None else k
        gone = set()
        for i in range(len(ws) - w + 1):
            if least[tuple(ws[i:i + w])] < me:
                gone.update(range(i, i + w))
        out.append((k is None, k, len(ws), len(gone), " ".join(x for i, x in enumerate(ws) if i not in gone)))
    return sorted(out, key=repr)


def found(df, **args):
    got = passages.remove_repeats(df, **args).collect()
    for r in got:
        assert sum(x["end"] - x["start"] for x in r["removed"]) == r["n_removed"]
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))  # maximal
    return sorted(((r["doc_id"] is None, r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=repr)


def test_passages_equal_brute_force(spark):
    rng = random.Random(3)
    for words, letters in ((3, "ab"), (4, "abc"), (50, "abcdefgh")):
        passage = " ".join(rng.choice(letters) for _ in range(70))
        rows = []
        for i in range(150):
            t = "  ".join(rng.choice(letters) for _ in range(rng.randint(0, 90)))
            rows.append((rng.choice([None, i, i, i // 3]), rng.choice([t, t, f"{t}\n{passage} {t}", passage, None])))
        rows += [rows[5]] * 40 + [(-3, passage), (None, passage), (None, passage)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        assert found(df, words=words) == kept_words(rows, words)


def test_passages_edge_rows(spark, docs, clashing):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs, words=4) == kept_words(rows, 4)
    assert found(clashing.withColumn("n_words", F.lit("x")).withColumn("low", F.lit(1)), words=4) == kept_words(rows, 4)
    assert passages.remove_repeats(docs.limit(0)).count() == 0
    short = docs.select(F.col("doc_id").cast("int").alias("doc_id"), "text")
    assert dict(passages.remove_repeats(short).dtypes)["doc_id"] == "int"


def test_a_key_with_a_third_of_the_text_has_several_buckets(spark, monkeypatch):
    rng = random.Random(8)
    common = " ".join(rng.choice("pqrst") for _ in range(60))
    rows = [(i, common + " " + " ".join(rng.choice("pqrstuvw") for _ in range(80))) for i in range(300)]
    hot = [(None, f"{common} null {i} " + "z " * 200) for i in range(150)] + [(999, f"{i} {common} " + "k " * 300) for i in range(150)]
    dealt = []
    real = passages._deal_texts
    monkeypatch.setattr(passages, "_deal_texts", lambda n, spread: dealt.append(spread) or real(n, spread))
    df = spark.createDataFrame(rows + hot, "doc_id long, text string").repartition(6)
    assert found(df) == kept_words(rows + hot, 50)
    assert set(dealt[0]) == {passages.NULL_KEY, 999} or max(dealt[0].values()) > 1


def test_windows_in_blocks_and_agreeing_halves(monkeypatch):
    texts = pa.array(["a b c a b c a", "", "b c a", " x"])
    hasher = passages.Hasher(3)
    whole = [np.concatenate(x) for x in zip(*hasher.of_texts(*coded_words(texts)))]
    monkeypatch.setattr(passages, "BLOCK", 2)
    parts = [np.concatenate(x) for x in zip(*hasher.of_texts(*coded_words(texts)))]
    assert all((a == b).all() for a, b in zip(whole, parts))
    assert whole[0].tolist() == [0, 0, 0, 0, 0, 2] and len(set(whole[2].tolist())) == 3
    order, first = passages.by_window(np.array([5, 5, 5, 1], np.uint64), np.array([2, 1, 2, 0], np.uint32))
    assert order.tolist() == [3, 1, 0, 2] and first.tolist() == [0, 1, 2]


def test_packing_of_keys_and_hashes():
    for ids in ([passages.NULL_KEY, -5, 0, (1 << 63) - 1], [7], [3, 3]):
        ids = np.array(ids, np.int64)
        assert (passages.unpacked_keys(*passages.packed_keys(ids)) == ids).all()


# vector codes

def coded(rows, parts=8, entries=16, rounds=6):
    kept = [(k, [int(np.floor(4096 * x)) for x in v], lab) for k, v, lab in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * width:(p + 1) * width] for r in first] for p in range(parts)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = [r[1][p * width:(p + 1) * width] for r in kept]
            to = [nearest(x, p)[1] for x in own]
            books[p] = [[sum(c) // len(c) for c in zip(*mine)] if (mine := [x for x, t in zip(own, to) if t == e]) else y
                        for e, y in enumerate(books[p])]
    out, by_label = [], {}
    for k, v, lab in kept:
        best = [nearest(v[p * width:(p + 1) * width], p) for p in range(parts)]
        out.append((k, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), lab))
        by_label[lab] = by_label.get(lab, 0) + out[-1][2]
    return sorted(((k, c, e, by_label[lab]) for k, c, e, lab in out), key=repr), books


VECTORS = "vec_id long, embedding array<float>, label int"


def test_vector_codes_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(0, 150)), [float(np.float32(x)) for x in rng.choice([0.0, 0.25, -0.5, rng.normal()], 16)], int(i % 3) or None)
            for i in range(120)]
    rows += [rows[0]] * 5 + [(None, rows[3][1], 1), (900, None, 1), (901, [1.0] * 15 + [None], 1), (902, [float("nan")] * 16, 2), (903, [float("inf")] * 16, 2)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("mine")).withColumn("ints_", F.lit(1))
    got, entries = vector_codes.compress(df)
    want, books = coded(rows)
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got.collect()), key=repr) == want
    assert entries.tolist() == books and got.columns == ["vec_id", "embedding", "label", "ints_", "code", "error", "label_error"]


def test_vector_codes_of_few_or_odd_rows(spark):
    few = [(2, [0.5] * 8, 1), (1, [0.5] * 8, None)]
    got, _ = vector_codes.compress(spark.createDataFrame(few, VECTORS))
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got.collect()) == [(1, "00" * 8, 0), (2, "00" * 8, 0)]
    none, entries = vector_codes.compress(spark.createDataFrame([(1, None, 1)], VECTORS))
    assert none.count() == 0 and entries.size == 0
    for bad in ([(1, [0.0] * 7, 1)], [(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], [(1, [1e9] * 8, 1)]):
        with pytest.raises(ValueError):
            vector_codes.compress(spark.createDataFrame(bad, VECTORS))


def test_bounds_prune_and_never_miss():
    rng = np.random.default_rng(5)
    centres = rng.integers(-100_000, 100_000, (16, 8))
    parts = np.concatenate([centres[rng.integers(0, 16, 3000)] + rng.integers(-2000, 2000, (3000, 8)), rng.integers(-(1 << 27), 1 << 27, (200, 8))])
    pivots = centres[:4]

    def to(x):
        return np.sqrt(vector_codes.distances(x[:, None], pivots[None]).astype(float))

    code, d, evaluated = vector_codes.nearest(parts, to(parts), centres, to(centres))
    every = vector_codes.distances(parts[:, None], centres[None])
    assert (code == every.argmin(1)).all() and (d == every.min(1)).all()
    assert evaluated < 0.4 * every.size


def test_op12_and_op13_equal_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in small(spark, "embeddings").collect()]
    want, books = coded(rows)
    got = run(spark, "op12_vector_codes")
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=repr) == want
    assert {r["codebooks_sha256"] for r in got} == {sha(",".join(str(x) for b in books for e in b for x in e))}
    docs = [(r["doc_id"], r["text"]) for r in small(spark, "documents").collect()]
    want = [(k, n, gone, sha(kept)) for _, k, n, gone, kept in kept_words(docs, 50)]
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in run(spark, "op13_passages")) == sorted(want)
