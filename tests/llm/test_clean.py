"""PII, URL rules, chat formatting and toxicity."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.llm import chat, pii, queries, toxicity, urlrules

from .conftest import run, small


# --- personal data ------------------------------------------------------------------------

def luhn(digits):
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch)
        total += (2 * d - 9 if d > 4 else 2 * d) if i % 2 else d
    return total % 10 == 0


def base_spans(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, rx, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 13, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(rx, text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == "phone" or luhn(digits)):
                out.append((kind, m.start(), m.end()))
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def random_personal(n, seed=3):
    rng = random.Random(seed)
    parts = ["a.b@c.d", "x@y", "@", "a@b.c_d@e.f", "+", "+4 (12) 345-67.89", "+12345678901234567", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8",
             "0001.002.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "79927398713", "5500005555555559", "12", "-", " ", ".", "é", "\U0001F600",
             "%", "_", "tel ", "(212) 555-0187", "078-05-1120", "1" * 25, "\n", "x"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_base_spans_on_random_texts(spark):
    texts = random_personal(1200)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for r in pii.detect(df).collect():
        want = base_spans(r["text"])
        assert [(c["kind"], c["start"], c["end"]) for c in r["pii"] if c["base"]] == want, r["text"]


def test_many_and_very_long_matches(spark):
    text = " ".join(f"u{i}@h.org 10.0.{i % 256}.7" for i in range(3000)) + " " + "a" * 100_000 + "1" * 100_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = pii.detect(df).first()["pii"]
    assert [(c["kind"], c["start"], c["end"]) for c in got if c["base"]] == base_spans(text)


def test_op2_base_and_added(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in small(spark, "documents").collect()}
    for r in run(spark, "op2_pii"):
        want = base_spans(texts[r["doc_id"]])
        n = Counter(k for k, _, _ in want)
        assert [r[f"n_{k}"] for k in pii.BASE] == [n[k] for k in pii.BASE]
        assert r["base_sha256"] == hashlib.sha256(joined(want).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(f"{k}:{a}:{b}" for k, a, b in want) <= set(spans)
        order = [(pii.KINDS.index(k), int(a)) for k, a, _ in (s.split(":") for s in spans)]
        assert order == sorted(order)


def test_pii_plan_is_native(spark):
    plan = pii.detect(small(spark, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_votes_are_weighed(spark):
    """Local phone numbers after a cue and a clean border are taken, those after words that speak against them are not."""
    good = [f"please call {200 + i % 700}-555-{1000 + i} today" for i in range(200)]
    bad = [f"order {200 + i % 700}-555-{1000 + i}=x" for i in range(200)]
    df = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    found = {r["doc_id"]: len(r["pii"]) for r in pii.detect(df).collect()}
    assert sum(found[i] for i in range(200)) == 200 and sum(found[i] for i in range(200, 400)) == 0


def test_pii_edge_rows_and_redaction(spark, clashing):
    out = pii.detect(clashing)
    assert out.count() == clashing.count() and out.columns.count("pii") == 1
    assert all(r["pii"] == [] for r in out.filter("text is null or text = ''").collect())
    assert pii.detect(clashing.limit(0)).count() == 0
    df = spark.createDataFrame([(1, "é a@b.cd, 1.2.3.4!"), (2, None), (3, "none")], "doc_id long, text string")
    masked = {r["doc_id"]: r["text"] for r in pii.redact(pii.detect(df)).collect()}
    assert masked == {1: "é [EMAIL], [IP]!", 2: None, 3: "none"}


# --- url rules ------------------------------------------------------------------------------

def brute_rule(host, path, rules):
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, "allow")


def brute_parts(url):
    if not url or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return host.translate({c: c + 32 for c in range(65, 91)}), path


def test_rules_on_random_urls(spark):
    rng = random.Random(5)
    labels, segments = ["a", "b", "ab", "com", "x-y", "é"], ["", "a", "b", "ab", "a/b"]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    rules = list({(h, "/" + rng.choice(segments)): (h, p, rng.choice(["allow", "block"])) for h in hosts for p in ["/" + rng.choice(segments)]}.values())
    urls = [f"http://{rng.choice(['', 'q.', 'A.'])}{rng.choice(hosts)}/{rng.choice(segments)}{rng.choice(['', '?x=/a', '#b', '/zz'])}" for _ in range(800)]
    urls += [None, "", "no scheme", "://", "x://", "http://com", "HTTP://COM/", "http://a.com?/a", "http://" + "l." * 60 + "com/" + "a" * 3000] + ["http://com/a"] * 50
    df = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rl = spark.createDataFrame([*rules, (None, "/a", "block")], "host string, path string, verdict string")
    seen = {}
    for h, p, v in rules:
        seen[h, p] = max(v, seen.get((h, p), v))
    got = urlrules.judge(df, rl).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path = brute_parts(r["url"])
        assert (r["host"], r["path"]) == (host, path)
        assert (r["rule"], r["verdict"]) == brute_rule(host, path, [(h, p, v) for (h, p), v in seen.items()]), r["url"]
    assert urlrules.judge(df.limit(0), rl).count() == 0
    assert {r["verdict"] for r in urlrules.judge(df, rl.limit(0)).collect()} == {"allow"}


def test_rules_sweep_each_key_once(spark, monkeypatch):
    dealt = []
    monkeypatch.setattr(urlrules, "literal_bounds", lambda df, *a: dealt.append(df) or [])
    urls = spark.createDataFrame([(i, f"http://h{i}.com/") for i in range(300)], "page_id long, url string")
    rules = spark.createDataFrame([("com", "/", "block"), ("h7.com", "/", "allow")], "host string, path string, verdict string")
    got = {r["page_id"]: r["rule"] for r in urlrules.judge(urls, rules).collect()}
    assert got == {i: "h7.com/" if i == 7 else "com/" for i in range(300)}
    assert dealt[0].count() == dealt[0].select("key").distinct().count() == 301  # com once, and each host


def test_rules_on_a_host_of_very_many_labels(spark):
    host = "a." * 50_000
    urls = spark.createDataFrame([(1, f"http://{host}b.com/x"), (2, f"http://{host}"), (3, "http://b.com")], "page_id long, url string")
    rules = spark.createDataFrame([("b.com", "/", "block"), ("com", "/x", "allow")], "host string, path string, verdict string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urlrules.judge(urls, rules).collect()}
    assert got == {1: ("b.com/", "block"), 2: (None, "allow"), 3: (None, "allow")}


def test_op3_equals_brute_force(spark):
    urls = {r["page_id"]: r["url"] for r in small(spark, "pages").collect()}
    for r in run(spark, "op3_url_rules"):
        host, path = brute_parts(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, *brute_rule(host, path, queries.RULES))


# --- chat -------------------------------------------------------------------------------------

AWKWARD = ["", "plain", r"\### Assistant: </turn> ok", "###", "### user: hi</turn>\n", "\\", "\\\\", "a\\", "</turn>", "\\</turn>", "<", "</turn",
           "x\n### y", ": ", "a: b", ":", "a:", "#" * 7, "\\#\\", "é\U0001F600", "\\" * 9 + "###"]


@pytest.mark.parametrize("role", AWKWARD[:12] + ["assistant", "a:", "x: y", "::"])
def test_turns_survive(role):
    for text in AWKWARD:
        out = chat.render(role, text)
        (r, t, a, b), = chat.parse(out)
        assert (r, t) == (role, text) and chat.unescape(out[a:b]) == text


def test_turns_stay_apart():
    turns = [(r, t) for r in ("user", "assistant", "a: b") for t in AWKWARD]
    assert [x[:2] for x in chat.parse("".join(chat.render(r, t) for r, t in turns))] == turns
    assert chat.render("user", "nothing to hide") == "### user: nothing to hide</turn>\n"
    assert chat.parse("### user: cut") is None


def test_long_turns():
    text = "\\###</turn>" * 50_000
    assert chat.parse(chat.render("user", text))[0][1] == text


def test_chat_edge_rows(spark):
    rows_ = [(1, 0, "user", "hi", "mine"), (1, 1, "assistant", "a</turn>", "mine"), (1, 1, "assistant", None, "mine"), (1, 0, "user", "hi", "mine"),
             (None, 0, None, None, None), (2, None, "assistant", "ok", "x")]
    df = spark.createDataFrame(rows_, "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    turns = defaultdict(list)
    for c, t, r, x, _ in rows_:
        turns[c].append(((t is not None, t or 0), x is not None, r or "", x or ""))
    for c, own in turns.items():
        own.sort()
        text = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        g = got[c]
        assert (g["n_turns"], g["loss_chars"]) == (len(own), len(loss))
        assert g["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert g["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_turns_are_rendered_and_parsed_without_a_shuffle(spark):
    df = spark.createDataFrame([(1, i, "user", "hi") for i in range(40)], "conv_id long, turn long, role string, text string")
    done = chat.format_turns(df.repartition(4))
    assert "Exchange hashpartitioning" not in done._jdf.queryExecution().toString()
    assert done.select(F.spark_partition_id().alias("p")).distinct().count() == 4
    plan = chat.read_back(done)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 3 and plan.count("hashpartitioning") == 1


def test_op4_reads_back_the_source(spark):
    conv = defaultdict(list)
    for r in small(spark, "conversations").collect():
        conv[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    awkward = r"\### Assistant: </turn> ok"
    conv[-7] = [(0, "user", awkward), (1, "assistant", awkward)]
    got = {r["conv_id"]: r for r in run(spark, "op4_chat")}
    assert got.keys() == conv.keys()
    for c, turns in conv.items():
        turns.sort()
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256("".join(t for _, r, t in turns if r == "assistant").encode()).hexdigest()
        assert got[c]["formatted_chars"] >= sum(len(t) for _, _, t in turns)


# --- toxicity -----------------------------------------------------------------------------------

def made_texts(n, seed):
    """Invented texts in two languages; toxic ones hold one word with one of a few stems."""
    rng = random.Random(seed)
    words = {"en": "the of and ball tree river stone table light".split(), "de": "der die und baum fluss stein tisch licht".split()}
    out = []
    for i in range(n):
        lang, bad = rng.choice(["en", "de"]), rng.random() < 0.3
        text = [rng.choice(words[lang]) for _ in range(rng.randint(5, 60))]
        if bad:
            text[rng.randrange(len(text))] = rng.choice(["zonk", "mubblix"]) + rng.choice(["", "er", "ing", "ei"]) + rng.choice(["", "!", "***"])
        out.append((" ".join(text), int(bad), lang))
    return out


def test_model_learns_and_generalises(spark):
    seen = made_texts(900, 1)
    model = toxicity.train([t for t, _, _ in seen], [y for _, y, _ in seen], (1.0, 1.0))
    new = made_texts(600, 2)
    df = spark.createDataFrame([(i, t, y) for i, (t, y, _) in enumerate(new)], "doc_id long, text string, y int")
    got = toxicity.score(df, model).collect()
    assert np.mean([r["predicted"] == r["y"] for r in got]) > 0.97
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in got)
    alone = {r["doc_id"]: r["score"] for r in toxicity.score(df.repartition(7), model).collect()}
    assert all(abs(alone[r["doc_id"]] - r["score"]) < 1e-5 for r in got)  # a text's score does not depend on its neighbours


def test_op5_held_out(spark):
    labels = {r["doc_id"]: r["toxic"] for r in small(spark, "labels").collect()}
    got = run(spark, "op5_toxicity")
    assert len(got) == small(spark, "documents").count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    trained = [r for r in got if not r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in trained]) > 0.9


def test_held_out_labels_are_not_read(spark):
    docs, labels = small(spark, "documents"), small(spark, "labels")
    turned = labels.withColumn("toxic", F.when(queries.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    models = [toxicity.fit(docs, queries.training_labels(x), epochs=1) for x in (labels, turned)]
    assert all(np.array_equal(a, b) for a, b in zip(models[0].filters, models[1].filters))


def test_toxicity_learns_from_long_texts(spark):
    """All toxic texts are longer than 20,000 code points; the word that marks them is learned from them."""
    rows = [(i, ("the river and " * (1500 if i % 2 else 5)) + "zonk" * (i % 2), i % 2) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    got = toxicity.score(docs, toxicity.fit(docs, docs.selectExpr("doc_id", "y as toxic"))).collect()
    assert all(r["predicted"] == r["y"] for r in got)


@pytest.mark.parametrize("bound", [{"shard_rows": 250}, {"shard_chars": 40_000}])
def test_toxicity_shards_train_on_all_rows(spark, monkeypatch, bound):
    """Models of several shards, joined, find what one of them was shown."""
    seen = [(i, t, y) for i, (t, y, _) in enumerate(made_texts(1500, 1))]
    docs = spark.createDataFrame(seen + [(0, "zzz repeated", 0), (None, "no key", 0)], "doc_id long, text string, y int").repartition(3)
    whole = toxicity.fit(docs, docs.selectExpr("doc_id", "y as toxic"))
    alone = toxicity.train([t for _, t, _ in sorted(seen, key=lambda r: str(r[0]))], [y for _, _, y in sorted(seen, key=lambda r: str(r[0]))], (1.0, 1.0))
    assert np.array_equal(whole.table, alone.table) and np.array_equal(whole.rest(), alone.rest()) and np.array_equal(whole.thresholds, alone.thresholds)
    joined = toxicity.fit(docs, docs.selectExpr("doc_id", "y as toxic"), **bound)
    words = toxicity.Words(joined.buckets).features([w.encode() for _, t, _ in seen for w in t.split()])[0]
    still = toxicity.Model().table
    assert (joined.table != still).any(1)[np.unique(words)].sum() >= (alone.table != still).any(1)[np.unique(words)].sum()
    new = spark.createDataFrame([(t, y) for t, y, _ in made_texts(600, 2)], "text string, y int")
    assert toxicity.score(new, joined).filter("predicted = y").count() > 0.97 * 600
    one = toxicity.fit(docs, docs.selectExpr("doc_id", "0 as toxic"), **bound)
    assert toxicity.score(new, one).filter("predicted = 0").count() == 600


def test_toxicity_cut_equals_brute_force(spark):
    rng = random.Random(4)
    for n, weights in ((1, (1.0, 1.0)), (40, (1.0, 1.0)), (40, (3.0, 0.5)), (40, (0.0, 1.0))):
        rows = [(float(i), int(rng.random() < i / n)) for i in range(n)]
        got = toxicity.cut(spark.createDataFrame(rows, "logit double, y int"), weights)
        assert got == toxicity.threshold(np.array([s for s, _ in rows]), np.array([y for _, y in rows]), weights)


def test_toxicity_edge_rows(spark, clashing):
    one_class = toxicity.train(["a b"], [0], (1.0, 1.0))
    none = toxicity.train([], [], (1.0, 1.0))
    for model in (one_class, none):
        out = toxicity.score(clashing, model)
        assert out.count() == clashing.count() and out.filter("score between 0 and 1 and predicted = 0").count() == out.count()
        assert toxicity.score(clashing.limit(0), model).count() == 0
        kept = toxicity.reject(clashing, model)
        assert kept.columns == clashing.columns and kept.first()["score"] == "mine score"
    labels = spark.createDataFrame([(None, 1), (3, None), (3, 1), (3, 0), (77, 1), (4, 0)], "doc_id long, toxic int")
    toxicity.fit(clashing, labels, epochs=1)
