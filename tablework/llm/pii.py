"""Personal data by weak supervision, in DataFrame expressions only.

Patterns propose candidate spans of several kinds.  Labelers then vote on each
candidate: the kind's own check (digits, Luhn, ranges), a gazetteer (top-level domains,
card prefixes, reserved addresses, area codes), cue words before the span, words
before it that speak against personal data, and its borders.  Expectation-maximisation
estimates, for each kind, how reliable each labeler is without any true label, and from
that each candidate's probability; a logistic classifier over votes and shape is then
trained on these probabilities and decides.  Spans of the four base kinds that pass
their exact checks are always kept.

The corpus is reduced to counts of vote patterns (their number is fixed by the number
of labelers and shape classes), so the estimation itself is a small loop over a small
table.  Texts are read once; the candidates of a row stay in the row, so nothing is
shuffled but those counts.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let, others, staged

#: Base kinds in their order, then the kinds that the method adds.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "local_phone", "id_number")

#: Patterns equal to the base definitions; possessive, and anchored at the start of a run of
#: characters (or where the last match ended), so that no text takes more than linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local_phone": r"(?<![0-9A-Za-z+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9A-Za-z])",
    "id_number": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}
#: A cheap test that every text with a match passes.
HINTS = {"email": "@", "phone": "+"}

DOMAINS = "com org net edu gov mil int io info biz de fr es it nl uk us eu ch at be pl se no dk".split()
CUES = {
    "email": "mail|e-mail|contact|courriel|correo|kontakt|write to|an",
    "ip": "ip|host|server|address|adresse|client|login|from",
    "card": "card|visa|mastercard|credit|karte|carte|tarjeta|payment",
    "phone": "phone|tel|call|fax|mobile|telefon|téléphone|teléfono|contact",
    "local_phone": "phone|tel|call|fax|mobile|telefon|téléphone|teléfono|contact",
    "id_number": "ssn|social|security|id|number|nummer",
}
AGAINST = "version|v|isbn|order|invoice|ref|page|chapter|figure|section|release|build|doi|sku"
LABELERS = ("check", "gazetteer", "cue", "against", "border")
#: Code points of text before a span that labelers read.
BEFORE = 24


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + let(
        F.substring(digits, n - i + 1, F.lit(1)).cast("int"),
        lambda d: F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))))
    return total % 10 == 0


def _check(kind: str, s: Column) -> Column:
    """Whether a match of a base pattern is personal data of that kind."""
    digits = F.regexp_replace(s, r"[^0-9]", "")
    if kind == "ip":
        return s.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "id_number":
        return ~s.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _gazetteer(kind: str, s: Column) -> Column:
    """1, 0, or -1 where the lists say nothing."""
    if kind == "email":
        return F.when(F.lower(F.regexp_extract(s, r"\.([A-Za-z0-9-]+)$", 1)).isin(DOMAINS), 1).otherwise(0)
    if kind == "ip":
        return F.when(s.rlike(r"^(?:0|127|255)\.|^(?:[0-9]\.){3}[0-9]$"), 0).otherwise(-1)
    if kind == "card":
        return F.when(s.rlike(r"^(?:4|5[1-5]|3[47]|6011|65|35|2[2-7])"), 1).otherwise(0)
    if kind == "phone":
        return F.when(s.rlike(r"^\+(?:1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"), 1).otherwise(0)
    if kind == "local_phone":
        return F.when(s.rlike(r"^\(?(?:[01]|[0-9]11)"), 0).otherwise(-1)
    return F.lit(-1)


def _prefix_sums(lengths: Column) -> Column:
    """Sum of all lengths before each; block by block, so that many lengths take no quadratic time."""
    width = 256
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / width).cast("int")),
                         lambda b: F.slice(lengths, b * width + 1, F.lit(width)))
    return let(blocks, lambda bs: let(F.transform(bs, total), lambda sums: F.flatten(F.transform(bs, lambda b, j: let(
        total(F.slice(sums, F.lit(1), j)), lambda base: F.transform(b, lambda x, i: base + total(F.slice(b, F.lit(1), i))))))))


def _matches(text: Column, kind: str) -> Column:
    """array<struct<start, s, before, after>> of the pattern's matches, leftmost and not overlapping."""
    rx = F.lit(PATTERNS[kind])

    def placed(found: Column) -> Column:
        def around(parts: Column) -> Column:
            # text before a match, the match, text before the next one ...
            lengths = F.zip_with(parts, found, lambda p, m: F.length(p) + F.coalesce(F.length(m), F.lit(0)))
            return let(_prefix_sums(lengths), lambda sums: F.transform(found, lambda m, i: F.struct(
                (F.get(sums, i) + F.length(F.get(parts, i))).alias("start"), m.alias("s"),
                F.right(F.get(parts, i), F.lit(BEFORE)).alias("before"),
                F.substring(F.get(parts, i + 1), 1, 1).alias("after"))))
        return let(F.split(text, PATTERNS[kind], -1), around)

    empty = F.array().cast("array<struct<start:int,s:string,before:string,after:string>>")
    found = let(F.regexp_extract_all(text, rx, F.lit(0)), lambda m: F.when(F.size(m) == 0, empty).otherwise(placed(m)))
    hint = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else text.rlike("[0-9]")
    return F.when(hint, found).otherwise(empty)


def _shape(s: Column) -> Column:
    """A small class of the span's length, for the final classifier."""
    return F.least(F.lit(3), F.floor(F.length(s) / 8)).cast("int")


def candidates(text: Column) -> Column:
    """array<struct<kind, start, end, base, votes, shape>>: all candidate spans; ``kind`` is the place in ``KINDS``."""
    def judge(k: int, kind: str):
        def judged(m: Column) -> Column:
            s = m["s"]
            passed = _check(kind, s)
            votes = [
                F.when(passed, 1).otherwise(0),
                _gazetteer(kind, s),
                F.when(m["before"].rlike(rf"(?iu)(?:^|[^\p{{L}}])(?:{CUES[kind]})[^\p{{L}}]*$"), 1).otherwise(-1),
                F.when(m["before"].rlike(rf"(?iu)(?:^|[^\p{{L}}])(?:{AGAINST})[^\p{{L}}]*$"), 0).otherwise(-1),
                F.when(m["before"].rlike(r"[\p{L}\p{N}_=/$€-]$") | m["after"].rlike(r"^[\p{L}\p{N}_=/%]"), 0).otherwise(1),
            ]
            return F.struct(F.lit(k).alias("kind"), m["start"].alias("start"), (m["start"] + F.length(s)).alias("end"),
                            (passed if kind in BASE else F.lit(False)).alias("base"),
                            F.array(*[v.cast("int") for v in votes]).alias("votes"), _shape(s).alias("shape"))
        return judged

    def proposed(c: Column) -> Column:
        """A match of a base pattern that fails its check is only worth a vote behind a cue word."""
        return c["base"] | (c["kind"] >= len(BASE)) | (F.get(c["votes"], F.lit(LABELERS.index("cue"))) == 1)

    return F.filter(F.concat(*[F.transform(_matches(text, kind), judge(k, kind)) for k, kind in enumerate(KINDS)]), proposed)


class Classifier:
    """Final weights: for each kind a bias, one weight for each vote of each labeler, one for each shape."""

    def __init__(self, bias: dict[int, float], vote: dict[tuple[int, int, int], float], shape: dict[tuple[int, int], float]):
        self.bias, self.vote, self.shape = bias, vote, shape

    def accepts(self, c: Column) -> Column:
        """Whether a candidate's logit is at least zero."""
        def pick(pairs, key):
            e = F.lit(0.0)
            for value, weight in pairs:
                e = F.when(key == value, F.lit(weight)).otherwise(e)
            return e

        total = pick(sorted(self.bias.items()), c["kind"])
        for j in range(len(LABELERS)):
            pairs = [(k * 10 + v, w) for (k, l, v), w in sorted(self.vote.items()) if l == j]
            total = total + pick(pairs, c["kind"] * 10 + F.get(c["votes"], F.lit(j)))
        return total + pick([(k * 10 + s, w) for (k, s), w in sorted(self.shape.items())], c["kind"] * 10 + c["shape"]) >= 0


def estimate(patterns: list[tuple[int, list[int], int, int]], rounds: int = 50) -> Classifier:
    """EM over the labelers' votes, then a logistic fit to the resulting probabilities.

    ``patterns``: (kind, votes, shape, count).  A vote of -1 abstains.
    """
    bias, vote, shape = {}, {}, {}
    for kind in range(len(KINDS)):
        rows = [(v, s, n) for k, v, s, n in patterns if k == kind]
        if not rows:
            continue
        prior = 0.5
        # chance that a labeler votes 1 (given that it votes) on a true and on a false candidate
        rates = [[0.8, 0.2] for _ in LABELERS]
        prob = []
        for _ in range(rounds):
            prob = []
            for v, _, _ in rows:
                a, b = log(prior), log(1 - prior)
                for (t, f), x in zip(rates, v):
                    if x >= 0:
                        a += log(t if x else 1 - t)
                        b += log(f if x else 1 - f)
                prob.append(1 / (1 + exp(min(700, b - a))))
            weight = sum(n for _, _, n in rows)
            prior = min(0.95, max(0.05, (1 + sum(p * n for p, (_, _, n) in zip(prob, rows))) / (weight + 2)))
            for j in range(len(LABELERS)):
                for side in (0, 1):
                    share = [(p if side == 0 else 1 - p) * n for p, (_, _, n) in zip(prob, rows)]
                    votes = sum(w for w, (v, _, _) in zip(share, rows) if v[j] >= 0)
                    ones = sum(w for w, (v, _, _) in zip(share, rows) if v[j] == 1)
                    start = 0.8 if side == 0 else 0.2  # a labeler is assumed to be better than chance until shown otherwise
                    rates[j][side] = min(0.98, max(0.02, (ones + 4 * start) / (votes + 4)))
        _logistic(kind, rows, prob, bias, vote, shape)
    return Classifier(bias, vote, shape)


def _logistic(kind: int, rows, prob, bias: dict, vote: dict, shape: dict, steps: int = 300, rate: float = 0.5) -> None:
    """Gradient steps on the weighted log-likelihood of the probabilities."""
    weight = float(sum(n for _, _, n in rows))
    names = [["b", *((j, x) for j, x in enumerate(v) if x >= 0), ("s", s)] for v, s, _ in rows]
    w = {name: 0.0 for ns in names for name in ns}
    for _ in range(steps):
        grad = dict.fromkeys(w, 0.0)
        for ns, p, (_, _, n) in zip(names, prob, rows):
            z = sum(w[x] for x in ns)
            off = (p - 1 / (1 + exp(-max(-700, min(700, z))))) * n / weight
            for x in ns:
                grad[x] += off
        for x in w:
            w[x] += rate * (grad[x] - 1e-4 * w[x])
    for name, value in w.items():
        if name == "b":
            bias[kind] = value
        elif name[0] == "s":
            shape[kind, name[1]] = value
        else:
            vote[kind, name[0], name[1]] = value


def _fit(found: DataFrame, column: str) -> Classifier:
    rows = (found.select(F.explode(column).alias("c")).groupBy("c.kind", "c.votes", "c.shape")
            .agg(F.count(F.lit(1)).alias("n")).collect())  # at most kinds * 3^labelers * shapes
    return estimate(sorted((r["kind"], list(r["votes"]), r["shape"], r["n"]) for r in rows))


def detect(df: DataFrame, text: str = "text", keep: list[str] | None = None, out: str = "pii") -> DataFrame:
    """Add ``out``: array<struct<kind string, start, end, base>>, the personal data in ``text``, by kind and start.

    Positions count code points, ends exclusive.  Base spans are all matches of the
    base patterns that pass their checks; others come from the classifier.  The
    candidates, with the columns in ``keep`` (all, if none are given), are written to
    the shared checkpoint folder, and the result reads them from there.  A null or empty text
    has no spans; repeated rows are judged each; an input column named ``out`` is replaced.
    """
    names = [c for c in others(df, [out]) if keep is None or c in keep]
    own = free_name(df, "candidates_")
    found = staged(df.select(*[F.col(f"`{c}`") for c in names],
                             candidates(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias(own)), "pii-candidates")
    model = _fit(found, own)
    accepted = F.filter(F.col(own), lambda c: c["base"] | model.accepts(c))
    # an added span gives way to a base span that it overlaps
    clear = let(accepted, lambda a: let(F.filter(a, lambda c: c["base"]), lambda b: F.filter(
        a, lambda c: c["base"] | ~F.exists(b, lambda o: (o["start"] < c["end"]) & (c["start"] < o["end"])))))
    named = F.transform(clear, lambda c: F.struct(F.element_at(F.lit(list(KINDS)), c["kind"] + 1).alias("kind"),
                                                  c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base")))
    return found.select(*[F.col(f"`{c}`") for c in names], named.alias(out))


def redact(df: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """Replace each span in ``text`` by ``[KIND]`` (of spans that overlap, one mark for all) and drop ``spans``."""
    found = F.array_sort(F.transform(F.col(f"`{spans}`"), lambda c: F.struct(c["start"], c["end"], c["kind"])))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    body = F.col(f"`{text}`")

    def add(acc, c):
        gap = F.greatest(c["start"] - acc["at"], F.lit(0))
        mark = F.when(c["start"] < acc["at"], F.lit("")).otherwise(F.concat(F.lit("["), F.upper(c["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["at"], c["end"]).alias("at"),
                        F.concat(acc["out"], F.array(F.substring(body, acc["at"] + 1, gap), mark)).alias("out"))

    done = F.aggregate(found, start, add, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(body, acc["at"] + 1, F.length(body))))
    new = F.when(F.size(f"`{spans}`") > 0, done).otherwise(body)
    return df.select(*[(new.alias(c) if c == text else F.col(f"`{c}`")) for c in df.columns if c != spans])
