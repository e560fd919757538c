"""Byte-level BPE and packing against the public libraries."""
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablework.llm import bpe, packing
from tablework.llm.queries import vocabulary

from .conftest import run, small

BPE = vocabulary(P.path("byte_bpe_multi_50k.tiktoken"))
WORDS = vocabulary(P.path("word_bpe_49k.json"))
PIECES = ["a", "th", "er", "  ", " ", "\n", "\t", "\x1c", "\x85", " ", "é", "ß", "'s", "'", "1", "23", "!!", "中", "\U0001F600",
          "don't", "  \n y", "\r\n", "Z", "İ", "Σ", "<|", "endoftext", "|>", "é"]


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(BPE), special_tokens={})


def odd_texts(n):
    rng = random.Random(n)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_codec_equals_the_library(encoding):
    codec = bpe.Codec(BPE, P.PATTERN)
    texts = ["", " ", "a ", "  a", "\n b", "x" * 300, "ab" * 5000, "é" * 100, *odd_texts(1500)]
    ids = [np.frombuffer(i, np.int32) for i in codec.encode(pa.array(texts))]
    assert [i.tolist() for i in ids] == [encoding.encode_ordinary(t) for t in texts]
    assert [codec.decode(i) for i in ids] == [t.encode() for t in texts]


def test_both_mergers_agree(encoding):
    ranks = bpe.read_ranks(BPE)
    merger = bpe.Merger(ranks)
    rng = random.Random(2)
    matches = [bytes(rng.choice(b"theronab ") for _ in range(rng.randint(1, 64))) for _ in range(400)] + [b"a" * 65, b"\x00\xff"]
    alone = [bpe.merge(m, ranks, merger.longest) for m in matches]
    assert [np.frombuffer(i, np.int32).tolist() for i in merger.merge_all(matches)] == alone


def test_ties_go_to_the_leftmost_pair():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257}
    assert bpe.merge(b"aaaa", ranks, 3) == [256, 256] and bpe.merge(b"aaaaa", ranks, 3) == [256, 257]


def test_ids_and_ranks_outside_the_vocabulary_raise():
    codec = bpe.Codec(BPE, P.PATTERN)
    for bad in (-1, len(codec.table), 1 << 30):
        with pytest.raises(ValueError, match="not in the vocabulary"):
            codec.decode(np.array([65, bad], np.int64))
    with pytest.raises(ValueError, match="2\\*\\*20"):
        bpe.Merger({bytes([b]): b for b in range(256)} | {b"ab": 1 << 20})


def test_op1_equals_the_library(spark, encoding):
    got = {r["doc_id"]: r for r in run(spark, "op1_bpe")}
    for r in small(spark, "documents").collect():
        ids = encoding.encode_ordinary(r["text"] or "")
        g = got.pop(r["doc_id"])
        assert g["n_tokens"] == len(ids) and g["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert not got


def test_bpe_edge_rows(spark, docs, clashing, encoding):
    out = bpe.encode(clashing, BPE, P.PATTERN, with_decoded=True)
    assert "Decoded" not in out.columns and "decoded" in out.columns and out.first()["score"] == "mine score"
    got = out.select("text", "ids", "decoded").collect()
    assert len(got) == docs.count()
    for r in got:
        assert list(r["ids"]) == encoding.encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode()
    back = bpe.decode(out.select("ids", F.lit(1).alias("decoded")), BPE)
    assert sorted(bytes(r["decoded"]) for r in back.collect()) == sorted((r["text"] or "").encode() for r in got)
    assert bpe.encode(docs.limit(0), BPE, P.PATTERN).count() == 0


def check_packed(pieces, texts):
    """Every id lies in one piece, sequences have no gap, and none needs padding."""
    tokenizer = Tokenizer.from_str(WORDS.decode())
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    for doc, text in texts.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted(by_doc.pop(doc), key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            part = ids[at:at + p["length"]].tobytes()
            assert p["ids_crc32"] == zlib.crc32(part) if "ids_crc32" in p else bytes(p["ids"]) == part
            at += p["length"]
        assert at == len(ids)
    assert not by_doc
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["tier"] == own[0]["tier"] and p["step_group"] == own[0]["step_group"]
            at += p["length"]
        assert at == own[0]["tier"] <= 2048 and at & (at - 1) == 0


def test_op9_packs_all_ids(spark):
    check_packed(run(spark, "op9_packing"), {r["doc_id"]: r["text"] or "" for r in small(spark, "documents").collect()})


def test_packing_edge_rows(spark, clashing):
    one = clashing.filter("doc_id is not null").dropDuplicates(["doc_id"]).coalesce(1)
    out = packing.pack(one, WORDS)
    assert out.columns[0] == "doc_id" and "score" not in out.columns
    check_packed([r.asDict() for r in out.collect()], {r["doc_id"]: r["text"] or "" for r in one.collect()})
    assert packing.pack(one.limit(0), WORDS).count() == 0
    # repeated rows and null keys are packed like others
    n = packing.pack(clashing, WORDS).agg(F.sum("length")).first()[0]
    assert n == sum(len(Tokenizer.from_str(WORDS.decode()).encode(r["text"] or "", add_special_tokens=False).ids) + 1
                    for r in clashing.select("text").collect())


def test_words_equal_the_tokenizer_on_odd_texts():
    tokenizer = Tokenizer.from_str(WORDS.decode())
    texts = odd_texts(1200)
    got = packing.WordIds(WORDS).batch(pa.array(texts))
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want


def test_packer_fills_long_windows_from_shorter_tiers():
    sequences = []
    p = packing.Packer((256, 512, 1024, 2048), 64, lambda pieces, tier: sequences.append((tier, pieces)))
    rng = random.Random(8)
    lengths = [rng.choice([1, 100, 300, 700, 1500, 2048, 5000]) for _ in range(500)]
    for i, n in enumerate(lengths):
        p.add(i, n)
    p.pack()
    assert sum(n for _, pieces in sequences for _, _, n in pieces) == sum(lengths) == sum(t for t, _ in sequences)
    whole = sum(1 for i, n in enumerate(lengths) if n < 2048 and sum(r == i for _, ps in sequences for r, _, _ in ps) == 1)
    assert whole > 0.5 * sum(n < 2048 for n in lengths)  # most short documents stay in one piece


def test_step_groups_cost_about_the_same(spark):
    rows_ = run(spark, "op9_packing")
    tokens = {}
    for r in rows_:
        tokens[r["step_group"], r["tier"]] = tokens.get((r["step_group"], r["tier"]), 0) + r["length"]
    assert max(tokens.values()) <= 65_536
    by_tier = {}
    for (_, tier), n in tokens.items():
        by_tier.setdefault(tier, []).append(n)
    for sizes in by_tier.values():  # all but a tier's last group are full
        assert sum(n < 65_536 for n in sizes) <= 1
