"""Embedding and SimHash near-duplicates, weighted sampling and the suffix tree, against brute force."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from tablework import session
from tablework.llm import blocks, cws, embed_dedup, pst, simhash
from tablework.llm.components import components

from .conftest import run, small


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


# --- components and blocks ---------------------------------------------------------------------

def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(6)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 800)] + [(7, 7), (8, 9), (9, 8), (8, 9)]
    links += [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(250)]
    sets = Sets({x for ab in links for x in ab})
    for a, b in links:
        sets.join(a, b)
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: sets.root(i) for ab in links if ab[0] != ab[1] for i in ab}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_blocks_compare_every_pair_once(spark):
    """A bucket far above the block size: each pair counts in one group, and no group grows with the bucket."""
    data = [(1, i) for i in range(1000)] + [(2, i) for i in range(2000, 2030)]
    met = blocks.in_blocks(spark.createDataFrame(data, "key long, item long"), "key", "item", 100).collect()
    groups = {}
    for r in met:
        groups.setdefault(r["gid"], []).append((r["side"], r["key"], r["item"]))
    pairs = Counter()
    for own in groups.values():
        assert len(own) <= 350
        for i, (s, k, a) in enumerate(own):
            for t, k2, b in own[i + 1:]:
                if k == k2 and (s == t == 0 or {s, t} == {1, 2}):
                    pairs[min(a, b), max(a, b)] += 1
    assert len(pairs) == 1000 * 999 // 2 + 30 * 29 // 2 and set(pairs.values()) == {1}


# --- SimHash -------------------------------------------------------------------------------------

def brute_fp(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps, distance=3):
    sets = Sets(fps)
    values = np.array(list(fps), np.uint64)
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ v) <= distance):
            sets.join(int(v), int(values[i + 1 + j]))
    return sets


def test_op10_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in small(spark, "documents").collect()}
    fps = {d: brute_fp(t) for d, t in texts.items()}
    sets = brute_classes(set(fps.values()))
    first = {}
    for d in sorted(texts):
        first.setdefault(sets.root(fps[d]), d)
    got = {r["doc_id"]: r for r in run(spark, "op10_simhash")}
    assert got.keys() == texts.keys()
    for d, r in got.items():
        assert r["fingerprint"] == f"{fps[d]:016x}" and r["component_id"] == first[sets.root(fps[d])]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("distance,block", [(3, 2048), (3, 16), (0, 2048), (5, 64)])
def test_links_find_all_near_fingerprints(spark, distance, block):
    """Groups of fingerprints a few bits apart, some of them chains, one very large, and bits that vary together."""
    rng = random.Random(distance)
    fps = set()
    for group in range(120):
        base = rng.getrandbits(48) << 16 | (0xFFFF if group % 2 else 0)
        for _ in range(300 if group == 0 else rng.randint(1, 6)):
            x = base
            for _ in range(rng.randint(0, distance + 2)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    sets = brute_classes(fps, distance)
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    found = Sets(fps)
    for r in simhash.links(df, distance, block).collect():  # each row's link to the first of its block's component
        found.join(r["a"] % (1 << 64), r["b"] % (1 << 64))

    def classes(s):
        out = {}
        for x in fps:
            out.setdefault(s.root(x), set()).add(x)
        return {frozenset(c) for c in out.values()}

    assert classes(found) == classes(sets)


def test_thresholds_keep_the_pigeonhole_rule():
    for m, widths in ((2, [32, 32]), (3, [22, 21, 21]), (4, [16] * 4)):
        for meets in ([1.0] * m, [1e6] + [1.0] * (m - 1), [1e4] * m):
            cost, chosen = simhash.allocate(widths, meets, 3)
            assert sum(chosen) == 3 - m + 1 and len(chosen) == m and cost > 0
    # a crowded partition is left out when the others can pay for it
    assert simhash.allocate([16] * 4, [1e9, 1.0, 1.0, 1.0], 3)[1][0] == -1
    ties = np.eye(64)
    ties[:8, :8] = 1
    groups = simhash.partitions(ties, 4)
    assert sorted(b for g in groups for b in g) == list(range(64)) and any(set(range(8)) <= set(g) for g in groups)


def test_simhash_edge_rows(spark, clashing):
    out = simhash.near_duplicates(clashing)
    rows_ = clashing.select("doc_id", "text").collect()
    got = Counter((r["doc_id"], r["fp"], r["component_id"]) for r in out.collect())
    sets = brute_classes({brute_fp(r["text"]) for r in rows_})
    first = {}
    for r in rows_:
        root = sets.root(brute_fp(r["text"]))
        if r["doc_id"] is not None:
            first[root] = min(first.get(root, r["doc_id"]), r["doc_id"])
    want = Counter((r["doc_id"], signed(brute_fp(r["text"])), first.get(sets.root(brute_fp(r["text"])))) for r in rows_)
    assert got == want
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(first.values())
    assert simhash.near_duplicates(clashing.limit(0)).count() == 0 and simhash.keep_one(clashing.limit(0)).count() == 0


# --- embeddings ------------------------------------------------------------------------------------

def brute_vectors(rows_, threshold=0.98):
    ok = [i for i, (k, v, l) in enumerate(rows_) if k is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
          and any(v)]
    n, sets = Counter(), Sets({r[0] for r in rows_ if r[0] is not None})
    unit = {i: np.array(rows_[i][1], float) / np.sqrt((np.array(rows_[i][1], float) ** 2).sum()) for i in ok}
    for x, i in enumerate(ok):
        for j in ok[x + 1:]:
            if rows_[i][2] == rows_[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                n[i] += 1
                n[j] += 1
                sets.join(rows_[i][0], rows_[j][0])
    return [(k, n[i], sets.root(k) if k is not None else None) for i, (k, _, _) in enumerate(rows_)]


def near_vectors(seed, groups=25, dim=32):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        base = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 9))):
            out.append((len(out), (base + rng.normal(size=dim) * rng.choice([0, 0.02, 0.1, 0.15])).astype(np.float32).tolist(), g % 3))
    return out


@pytest.mark.parametrize("block", [2048, 20])
def test_vectors_equal_brute_force(spark, block):
    rows_ = near_vectors(1)
    rows_ += [(len(rows_) + i, rows_[0][1], rows_[0][2]) for i in range(40)]  # many copies of one vector
    k = len(rows_)
    rows_ += [(k, None, 1), (k + 1, [0.0] * 32, 1), (k + 2, [float("nan")] + [1.0] * 31, 1), (k + 3, [None] + [1.0] * 31, 1), (k + 4, rows_[0][1], None),
              (None, rows_[0][1], 0), (k + 5, [1.0, 2.0], 1), (k + 6, [1.0, 2.0], 1), (k + 7, [], 1), (k + 8, [float("inf")] * 32, 1)]
    df = spark.createDataFrame([(*r, "mine") for r in rows_], "vec_id long, embedding array<float>, label int, n_links string")
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embed_dedup.near_duplicates(df, block=block).collect())
    assert got == Counter(brute_vectors(rows_))
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_the_bound_holds():
    rng = np.random.default_rng(0)
    dim, theta = 64, 0.98
    x = rng.normal(size=dim)
    x /= np.linalg.norm(x)
    u = rng.normal(size=dim)
    u -= (u @ x) * x
    y = theta * x + math.sqrt(1 - theta ** 2) * u / np.linalg.norm(u)
    estimates = []
    for seed in range(400):
        r = embed_dedup.rotation(dim, seed)
        turned = r @ x
        code = np.where(turned > 0, 1, -1) / math.sqrt(dim)
        factor = code @ turned
        estimates.append(code @ (r @ y) / factor)
        assert abs(estimates[-1] - theta) <= math.sqrt(1 - theta ** 2) * math.sqrt(1 - factor ** 2) / factor + 1e-9
    assert abs(np.mean(estimates) - theta) < 0.01


def test_codes_spare_exact_work():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 64))
    x[300:] = x[:300] + rng.normal(size=(300, 64)) * 0.05
    stats, every = {}, np.arange(600)
    a, b = embed_dedup.near_links(x, 0.98, np.zeros((600, 1), int), 0, every, every, 3, stats)
    assert sorted(zip(a.tolist(), b.tolist())) == [(i, i + 300) for i in range(300)]
    assert stats["exact"] < 0.02 * stats["pairs"]


def test_a_row_that_is_a_third_of_all_is_collapsed_before_its_shuffle(spark):
    """Copies alike in key and text, some with other columns: one stays, and no exchange by key gets more than one for each task."""
    words = [f"w{i % 89}x{i}" for i in range(3000)]
    rows_ = [(5, " ".join(words[:60]), "b", None)] * 200 + [(5, " ".join(words[:60]), "a", 1)] * 3 + [(None, "z", "n", 2)] * 50
    rows_ += [(100 + i, " ".join(words[60 + i * 25:60 + i * 25 + 40]), "c", i) for i in range(100)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, source string, n_chars long").repartition(4)
    kept = simhash.keep_one(df)
    got = [tuple(r) for r in kept.collect()]
    assert len([r for r in got if r[0] == 5]) == 1 and (5, " ".join(words[:60]), "a", 1) in got
    assert len([r for r in got if r[0] is None]) == 1 and len({r[0] for r in got}) == len(got)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min_by" in plan
    with_map = df.withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    assert simhash.keep_one(with_map).count() == len(got)


def test_number_of_tables_keeps_the_chance_to_miss():
    for rows_ in (10, 10_000, 10 ** 7, 10 ** 9):
        signs, tables = embed_dedup.tables_for(rows_, 0.98, 1e-6)
        assert (1 - (1 - math.acos(0.98) / math.pi) ** signs) ** tables <= 1e-6


# --- consistent weighted sampling --------------------------------------------------------------------

def counted(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))


def jaccard(a, b):
    return sum(min(a[k], b[k]) for k in a | b) / max(1, sum(max(a[k], b[k]) for k in a | b))


def test_op7_equals_brute_force(spark):
    texts = sorted((r["doc_id"], r["text"] or "") for r in small(spark, "documents").collect())
    got = {r["doc_id"]: r for r in run(spark, "op7_weighted_sampling")}
    errors, by_text = [], {}
    for i, (d, t) in enumerate(texts):
        after, quarter = texts[(i + 1) % len(texts)][1], len(t) // 4
        edited = t[:len(t) - quarter] + after[:quarter]
        assert got[d]["n_chars"] == len(t) and got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors += [got[d]["near_edited"] - jaccard(counted(t), counted(edited)), got[d]["near_next"] - jaccard(counted(t), counted(after))]
        by_text.setdefault(t, set()).add(got[d]["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_collision_rate_is_the_weighted_similarity(spark):
    """Pairs with few terms and large weights, where counts matter and plain sets would not do."""
    rng = random.Random(9)
    data, want = [], []
    for i in range(300):
        a = {f"t{i}_{j}": rng.randint(1, 30) for j in range(5)}
        b = {k: max(1, v + rng.randint(-12, 12)) for k, v in a.items()}
        data.append((i, *(" ".join(w for k, n in x.items() for w in [k] * n) for x in (a, b))))
        want.append(jaccard(Counter(a), Counter(b)))
    df = spark.createDataFrame(data, "id long, a string, b string")
    both = cws.fingerprints(df, "a", ["id"]).withColumnRenamed("samples", "sa").join(
        cws.fingerprints(df, "b", ["id"]).withColumnRenamed("samples", "sb"), "id")
    got = {r["id"]: r["s"] for r in both.select("id", cws.likeness(F.col("sa"), F.col("sb")).alias("s")).collect()}
    off = [got[i] - want[i] for i in range(300)]
    assert abs(np.mean(off)) < 0.015 and np.std(off) < 0.08 and np.corrcoef([got[i] for i in range(300)], want)[0, 1] > 0.75


def test_cws_edge_rows(spark, clashing):
    rows_ = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["text"] or "", r["doc_id"]) for r in clashing.select("doc_id", "text").collect())
    out = cws.edit_and_compare(clashing).collect()
    want = Counter()
    for i, (_, t, d) in enumerate(rows_):
        after, quarter = rows_[(i + 1) % len(rows_)][1], len(t) // 4
        want[d, len(t), hashlib.sha256((t[:len(t) - quarter] + after[:quarter]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in out) == want
    empties = {tuple(r["samples"]) for r in out if r["n_chars"] == 0}
    assert len(empties) == 1 and all(0 <= r["near_next"] <= 1 for r in out)
    assert cws.edit_and_compare(clashing.limit(0)).count() == 0
    one = cws.edit_and_compare(clashing.filter("doc_id = 3").limit(1)).first()  # its own next text
    assert one["near_next"] == 1.0


def test_cws_plan_is_native(spark):
    plan = cws.edit_and_compare(small(spark, "documents").select("doc_id", "text"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- suffix tree -----------------------------------------------------------------------------------------

def brute_unigrams(texts):
    tokens = {d: re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) + [b""] for d, t in texts}
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in texts}
    c = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    return tokens, held, c


def test_op8_base_and_gain(spark):
    texts = [(r["doc_id"], r["text"]) for r in small(spark, "documents").collect()]
    tokens, held, c = brute_unigrams(texts)
    n, v = sum(c.values()), len(c)
    gain = 0.0
    for r in run(spark, "op8_suffix_tree"):
        ws = tokens[r["doc_id"]]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), sum(c[w] > 0 for w in ws), n)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base)
        gain += (r["score"] - r["base_score"]) * r["held_out"]
    assert gain > 0  # on held-out texts the contexts pay


def test_distributions_sum_to_one(spark):
    """Behind every context of the training texts, by the weights that scores are made of."""
    rng = random.Random(4)
    grammar = {"a": "bbbc", "b": "cccd", "c": "aaad", "d": "abcd"}
    texts = []
    for i in range(200):
        word, text = "a", []
        for _ in range(rng.randint(3, 30)):
            text.append(word)
            word = rng.choice(grammar[word])
        texts.append(" ".join(text) + (f" rare{i}" if i % 9 == 0 else ""))
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    longest, part_bits = 3, 3
    bits = spark.sparkContext.broadcast(pst.recurring_bits(train, longest, part_bits, 2))
    counts = pst.staged_apart(pst.count_sequences(train, longest, part_bits, 2, bits), "test-sequences")
    words = [[*t.split(), ""] for t in texts]
    c = Counter(w for ws in words for w in ws)
    mass = sum(c.values()) + 0.5 * (len(c) + 1)
    gain = []  # by the number of tokens in a context; a sequence may be an entry of the first and a context of the second
    for depth in (1, 2):
        gain.append({})
        for r in pst.grow_tables(counts, mass, depth, 0.01, 20.0)[0].collect():
            gain[-1][r["code"] % (1 << 64)] = gain[-1].get(r["code"] % (1 << 64), 0.0) + r["w"]
    gain[1] = {code: w - gain[0].get(code, 0.0) for code, w in gain[1].items()}
    own = pd.util.hash_array(np.array([w.encode() for w in c], object), categorize=False).astype(np.uint64)
    code_of = dict(zip(c, own.tolist()))
    code_of[None] = int(pst.BEGIN)

    def code(seq):
        out = code_of[seq[0]]
        for w in seq[1:]:
            out = (out * int(pst.FACTOR) + code_of[w]) % (1 << 64)
        return out

    seen = {tuple([None, *ws][i:i + m]) for ws in words for m in (1, 2) for i in range(len(ws) + 1 - m)}
    assert len(seen) > 20
    for ctx in seen:
        left = sum(gain[m - 1].get(code(ctx[-m:]), 0.0) for m in range(1, len(ctx) + 1))
        total = 0.5 / mass * 10 ** left  # the unknown token
        for w, n in c.items():
            total += (n + 0.5) / mass * 10 ** (left + sum(gain[m - 1].get(code((*ctx[-m:], w)), 0.0) for m in range(1, len(ctx) + 1)))
        assert abs(total - 1) < 1e-9, ctx


def test_pst_edge_rows(spark, clashing):
    texts = [(r["doc_id"], r["text"]) for r in clashing.select("doc_id", "text").collect()]
    out = pst.score(clashing).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(d for d, _ in texts)
    c, held = Counter(), {}
    for d, t in texts:
        ws, h, _ = brute_unigrams([(d, t)])
        held[d] = h[d]
        if not h[d]:
            c.update(ws[d])
    assert {r["train_tokens"] for r in out} == {sum(c.values())}
    assert all(r["held_out"] == held[r["doc_id"]] and math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    assert pst.score(clashing.limit(0)).count() == 0
    only_held = clashing.filter("doc_id = 0").withColumn("doc_id", F.lit(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)).cast("long"))
    assert pst.score(only_held).first()["train_tokens"] == 0


def brute_tree(texts, depth, least=0.01, weight=20.0):
    """Score of each text by the definition, with plain counts of every sequence that recurs."""
    tokens, held, c = brute_unigrams(texts)
    mass = sum(c.values()) + 0.5 * (len(c) + 1)
    grams = Counter()
    for d, ws in tokens.items():
        ws = [None, *ws]
        if not held[d]:
            grams.update(tuple(ws[i:i + m]) for m in range(1, depth + 2) for i in range(len(ws) - m + 1))
    follow, kept = {}, {}
    for g, n in grams.items():
        if len(g) > 1 and n > 1:
            follow.setdefault(g[:-1], {})[g[-1]] = n

    def prob(ctx, w):
        if not ctx:
            return (c[w] + 0.5) / mass
        lower = prob(ctx[1:], w)
        if ctx not in kept:
            return lower
        probs, gamma = kept[ctx]
        return probs[w] if w in probs else gamma * lower

    for ctx in sorted(follow, key=len):
        total, lower = grams[ctx], {w: prob(ctx[1:], w) for w in follow[ctx]}
        share = {w: n / total for w, n in follow[ctx].items()}
        rest, rest_lower = (max(1 - sum(x.values()), 1e-12) for x in (share, lower))
        gain = sum(p * math.log(p / lower[w]) for w, p in share.items()) + rest * math.log(rest / rest_lower)
        if gain >= least and gain * total >= len(share) + 1:
            probs = {w: (n + weight * lower[w]) / (total + weight) for w, n in follow[ctx].items()}
            kept[ctx] = probs, max(1 - sum(probs.values()), 1e-12) / rest_lower
    out = {}
    for d, ws in tokens.items():
        ws = [None, *ws]
        out[d] = sum(math.log10(prob(tuple(ws[max(0, i - depth):i]), ws[i])) for i in range(1, len(ws)))
    return out, kept


@pytest.mark.parametrize("depth", [2, 3])
def test_op8_uses_every_recurring_context(spark, depth):
    rng = random.Random(8)
    texts = [(i, " ".join(f"w{min(rng.randrange(400), rng.randrange(400))}" for _ in range(120))) for i in range(300)]
    # each pair of names is rare, and always followed by the same word
    texts += [(1000 + i, f"w1 w2 name{i // 9} of{i // 9} Town{i // 9} w3") for i in range(900)] + [(5000, ""), (5001, None)]
    want, kept = brute_tree(texts, depth)
    out = {r["doc_id"]: r for r in pst.score(spark.createDataFrame(texts, "doc_id long, text string"), depth=depth).collect()}
    assert len(out) == len(texts) and len(kept) > 200
    assert all(abs(r["score"] - want[d]) < 1e-6 * max(1, abs(want[d])) for d, r in out.items())
    assert out[1001]["score"] > out[1001]["base_score"] + 4


def test_pst_keeps_no_staged_levels(spark):
    """What is read no more is deleted: the sequences, levels and weights would stand beside the scoring shuffle."""
    before = set(session._SCRATCH)
    texts = [(i, f"a b c{i % 7} d{i % 5} a b") for i in range(200)]
    out = pst.score(spark.createDataFrame(texts, "doc_id long, text string"))
    paths = [p for p in session._SCRATCH if p not in before]
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    there = {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in paths
             if fs.Path(p).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs.Path(p))}
    assert there == {"pst-judged", "pst-bits"}
    assert out.count() == 200  # what is left is all that the result reads


def test_pst_sequences_by_numbers(spark):
    """A sequence whose ends have numbers comes back with the same context and suffix as one sent with their hashes."""
    texts = [f"a b c{i % 7} d{i % 5} a b" for i in range(60)]
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    bits = spark.sparkContext.broadcast(pst.recurring_bits(train, 4, 3, 2))
    want = Counter(tuple(r) for r in pst.count_sequences(train, 4, 3, 2, bits).collect())
    assert {m for m, *_ in want} == {1, 2, 3, 4}
    for names in ([b"a", b"b", b""], [b"a", b"b", b"", *(b"c%d" % i for i in range(7)), *(b"d%d" % i for i in range(5))]):
        assert Counter(tuple(r) for r in pst.count_sequences(train, 4, 3, 2, bits, pst.Numbers(names)).collect()) == want
