"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's vector is the sum of the rows that the word and its first letters hash to.
Filters of several widths run over the words of a text, each filter's greatest
response is kept, and a linear layer turns them into a logit.  Embeddings, filters and
the layer are trained in numpy on all labelled rows, dealt into shards of bounded size: a
shard trains a model from the same start, and the models are averaged.  A threshold is
calibrated for each language, which is guessed from the text's function words; the
score is the logistic function of the logit's distance from that threshold.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.splits import running_sum
from .common import Memory, coded_words, free_name, map_text, staged, staged_apart, unstage

WIDTHS = (1, 2, 3)
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#&%$-_/\\"
#: Function words that tell languages apart.
STOPWORDS = {
    "en": "the of and to in is that was for it with this be by from are".split(),
    "de": "der die das und ist nicht mit den von zu ein im auf sich".split(),
    "fr": "le les et des est dans pour une du qui pas sur avec au".split(),
    "es": "el los las y del por con para una es al como su lo".split(),
}
LANGS = ["", *STOPWORDS]
_LANG_OF_BYTES = {w.encode(): i for i, lang in enumerate(LANGS) if lang for w in STOPWORDS[lang]}
CACHE_ENTRIES = 100_000
#: Words that are laid out at a time (or one text).
PIECE_WORDS = 65_536


class Words:
    """Rows of the hashed embedding table, and the language, of words."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def features(self, names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each word the rows of itself and of its first 3 to 6 letters, and the place of its language."""
        rows, langs = [], []
        crc, none, marks, lang_of = zlib.crc32, zlib.crc32(b""), PUNCTUATION.encode(), _LANG_OF_BYTES.get
        for name in names:
            if name.isascii():
                spelt = name.lower().strip(marks)
                heads = spelt[:3], spelt[:4], spelt[:5], spelt[:6]
                size = len(spelt)
            else:
                plain = name.decode("utf-8", "replace").lower().strip(PUNCTUATION)
                spelt = plain.encode("utf-8", "replace")
                heads = [plain[:m].encode("utf-8", "replace") for m in (3, 4, 5, 6)]
                size = len(plain)
            rows += (crc(spelt, 1), crc(heads[0], 13) if size > 2 else none, crc(heads[1], 14) if size > 3 else none,
                     crc(heads[2], 15) if size > 4 else none, crc(heads[3], 16) if size > 5 else none)
            langs.append(lang_of(spelt, 0))
        rows, langs = np.array(rows, np.int64).reshape(-1, 5) % self.buckets, np.array(langs, np.int64)
        return rows, langs


class Model:
    """Embeddings, filters, linear layer and the thresholds of the languages."""

    def __init__(self, buckets: int = 1 << 15, dim: int = 16, filters: int = 16, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.buckets = buckets
        self.table = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
        self.filters = [rng.normal(0, (w * dim) ** -0.5, (w, dim, filters)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(filters, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.1, filters * len(WIDTHS)).astype(np.float32)
        self.base = np.zeros(1, np.float32)
        self.thresholds = np.zeros(len(LANGS))

    def pooled(self, vectors: np.ndarray, starts: np.ndarray, ends: np.ndarray, where: bool = False):
        """Greatest response of each filter in each text; with ``where`` also its first word's position.

        ``vectors`` holds the texts one after another, each followed by as many zero rows
        as the widest filter takes in, so that no window reaches into the next text.
        """
        out, at = [], []
        for w, f, b in zip(WIDTHS, self.filters, self.bias):
            n = len(vectors) - w + 1
            response = sum(vectors[j:j + n] @ f[j] for j in range(w)) + b
            response = np.concatenate([response, np.full((w - 1, response.shape[1]), -1e30, np.float32)]) if w > 1 else response
            # windows that begin between a text's end and the next one's start are left out
            out.append(np.maximum.reduceat(response, np.stack([starts, ends], 1).ravel(), axis=0)[::2])
            if where:
                turned = np.ascontiguousarray(response.T)  # a filter's responses next to each other
                at.append(np.stack([s + turned[:, s:e].argmax(1) for s, e in zip(starts, ends)]))
        pooled = np.concatenate(out, 1)
        return (pooled, np.concatenate(at, 1)) if where else pooled

    def logits(self, vectors: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return np.maximum(self.pooled(vectors, starts, ends), 0) @ self.out + self.base[0]

    def rest(self) -> np.ndarray:
        """All parameters but the table's, one after another, in rows as wide as the table's; zeros fill the last."""
        flat = np.concatenate([p.ravel() for p in (*self.filters, *self.bias, self.out, self.base)])
        return np.pad(flat, (0, -len(flat) % self.table.shape[1])).reshape(-1, self.table.shape[1])

    def set_rest(self, rows: np.ndarray) -> None:
        flat, first = rows.ravel(), 0
        for p in (*self.filters, *self.bias, self.out, self.base):
            p[...] = flat[first:first + p.size].reshape(p.shape)
            first += p.size

    def scores(self, logits: np.ndarray, langs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logits - self.thresholds[langs], -40, 40).astype(np.float64)))


GAP = max(WIDTHS)


def laid_out(words: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' words in one array with ``GAP`` pads behind each, and each text's start and end; an empty text is one pad long."""
    sizes = np.array([len(w) + GAP for w in words], np.int64)
    ends = np.cumsum(sizes)
    flat = np.full(int(ends[-1]) if len(ends) else 0, pad, np.int64)
    for w, e, n in zip(words, ends, sizes):
        flat[e - n:e - GAP] = w
    return flat, ends - sizes, np.maximum(ends - GAP, ends - sizes + 1)


def pieces(sizes: list[int]) -> list[tuple[int, int]]:
    """Bounds of runs of texts with about ``PIECE_WORDS`` words, or one text."""
    out, first = [], 0
    while first < len(sizes):
        last, n = first, 0
        while last < len(sizes) and (n == 0 or n + sizes[last] < PIECE_WORDS):
            n += sizes[last] + GAP
            last += 1
        out.append((first, last))
        first = last
    return out


def guess(words: np.ndarray, langs: np.ndarray) -> int:
    """The language with the most function words; 0 if there are none."""
    counts = np.bincount(langs[words], minlength=len(LANGS))
    best = int(counts[1:].argmax()) + 1
    return best if counts[best] else 0


def train(texts: list[str], labels: list[int], weights: tuple[float, float], epochs: int = 5, batch: int = 48,
          rate: float = 0.05, seed: int = 5, **shape) -> Model:
    """Fit a model; ``weights`` are the rows that a clean and a toxic sample row stand for.

    A fifth of the rows is kept aside to calibrate the thresholds.  Without rows of
    both labels the model gives every text the share of toxic labels.
    """
    return train_part(texts, labels, weights, epochs, batch, rate, seed, **shape)[0]


def train_part(texts: list[str], labels: list[int], weights: tuple[float, float] | None, epochs: int = 5, batch: int = 48,
               rate: float = 0.05, seed: int = 5, **shape) -> tuple[Model, np.ndarray]:
    """A model and the places of the rows for calibration.

    Without ``weights`` the rows are one shard of many: rows of one label are trained on as well, and
    the thresholds are left to be calibrated when the shards' models are joined.
    """
    model = Model(**shape)
    y = np.array(labels, np.float32)
    if not len(y) or (weights is not None and y.min() == y.max()):
        share = float(y.mean()) if len(y) else 0.0
        model.out[:] = 0
        model.thresholds[:] = -np.log(min(max(share, 1e-6), 1 - 1e-6) / (1 - min(max(share, 1e-6), 1 - 1e-6)))
        return model, np.arange(len(y))
    rng = np.random.default_rng(seed)
    codes, cuts, names = coded_words(pa.array(texts, pa.string()))
    ids = [codes[a:b].astype(np.int64) for a, b in zip(cuts[:-1], cuts[1:])]
    features, langs = Words(model.buckets).features(names)
    pad = len(names)
    features = np.concatenate([features, np.zeros((1, 5), np.int64)])
    langs = np.append(langs, 0)
    aside = rng.random(len(y)) < 0.2
    if aside.all() or y[~aside].min() == y[~aside].max():
        aside[:] = False
    rows = np.flatnonzero(~aside)
    params = [*model.filters, *model.bias, model.out, model.base]
    sums = [np.full_like(p, 1e-6) for p in params]
    table_sum = np.full(model.table.shape, 1e-6, np.float32)
    k = model.bias[0].size

    def embedded(words: np.ndarray) -> np.ndarray:
        vectors = model.table[features[words]].sum(-2)
        vectors[words == pad] = 0
        return vectors

    for _ in range(epochs):
        rng.shuffle(rows)
        for first in range(0, len(rows), batch):
            now = rows[first:first + batch]
            pooled, words = [], [[] for _ in range(GAP)]  # words: for each filter those from its window's first on
            for a, b in pieces([len(ids[i]) for i in now]):
                flat, starts, stops = laid_out([ids[i] for i in now[a:b]], pad)
                found, at = model.pooled(embedded(flat), starts, stops, where=True)
                pooled.append(found)
                for j in range(GAP):
                    words[j].append(flat[np.minimum(at + j, len(flat) - 1)])
            pooled, words = np.concatenate(pooled), [np.concatenate(w) for w in words]
            hidden = np.maximum(pooled, 0)
            logit = hidden @ model.out + model.base[0]
            off = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[now]) / len(now)
            back = np.outer(off, model.out) * (pooled > 0)
            grads = [np.zeros_like(p) for p in params]
            grads[-2][:] = hidden.T @ off
            grads[-1][:] = off.sum()
            touched, moves = [], []
            for i, w in enumerate(WIDTHS):
                g = back[:, i * k:(i + 1) * k]
                grads[len(WIDTHS) + i][:] = g.sum(0)
                for j in range(w):
                    word = words[j][:, i * k:(i + 1) * k]
                    grads[i][j] = np.einsum("nk,nkd->dk", g, embedded(word))
                    touched.append(word.ravel())
                    moves.append((g[:, :, None] * model.filters[i][j].T[None]).reshape(-1, model.table.shape[1]))
            for p, s, g in zip(params, sums, grads):
                s += g * g
                p -= rate * g / np.sqrt(s)
            word, move = np.concatenate(touched), np.concatenate(moves)
            used = (np.abs(move).max(1) > 0) & (word != pad)
            at_rows, which = np.unique(features[word[used]], return_inverse=True)
            total = np.zeros((len(at_rows), model.table.shape[1]), np.float32)
            which = which.reshape(-1, features.shape[1])
            wide, flat_total, moved = np.arange(total.shape[1]), total.reshape(-1), move[used].ravel()
            for c in range(which.shape[1]):
                np.add.at(flat_total, (which[:, c, None] * total.shape[1] + wide).ravel(), moved)
            table_sum[at_rows] += total * total
            model.table[at_rows] -= rate * total / np.sqrt(table_sum[at_rows])
    checked = np.flatnonzero(aside) if aside.any() else rows
    if weights is None:
        return model, checked
    logit = np.zeros(len(y))
    for first in range(0, len(checked), batch):
        now = checked[first:first + batch]
        for a, b in pieces([len(ids[i]) for i in now]):
            flat, starts, stops = laid_out([ids[i] for i in now[a:b]], pad)
            logit[now[a:b]] = model.logits(embedded(flat), starts, stops)
    guessed = np.array([guess(i, langs) for i in ids])
    general = threshold(logit[checked], y[checked], weights)
    for lang in range(len(LANGS)):
        own = checked[guessed[checked] == lang]
        enough = len(own) and min((y[own] == 1).sum(), (y[own] == 0).sum()) >= 20
        model.thresholds[lang] = threshold(logit[own], y[own], weights) if enough else general
    return model, checked


def threshold(logits: np.ndarray, y: np.ndarray, weights: tuple[float, float]) -> float:
    """The logit that misjudges the least weight; in the middle of the best gap."""
    order = np.argsort(logits, kind="stable")
    s, t = logits[order], y[order]
    # cut i: the first i rows are called clean
    wrong = np.concatenate([[0], np.cumsum(t == 1) * weights[1]]) + np.concatenate([[0], np.cumsum(t[::-1] == 0) * weights[0]])[::-1]
    edges = np.concatenate([[s[0] - 1], (s[1:] + s[:-1]) / 2, [s[-1] + 1]])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    return float(edges[best[len(best) // 2]])


def reject(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that the model does not call toxic, with their columns as they are."""
    names = free_name(docs, "score_"), free_name(docs, "toxic_")
    judged = score(docs, model, text, out=names)
    return judged.filter(F.col(names[1]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        shard_rows: int = 8_192, shard_chars: int = 48 << 20, **options) -> Model:
    """Train on all labelled rows.

    Rows are dealt by a hash of their key into shards of about ``shard_rows`` rows and ``shard_chars`` code
    points, which are trained next to each other for all epochs; a parameter is the mean over the shards
    that have moved it, by their rows.  A single shard's model is that of ``train``.  What reaches the driver
    has the size of the model.  Null keys and labels are left out; a key with several labels counts as toxic if
    one of them says so.
    """
    named = (labels.select(F.col(f"`{key}`").alias("id_"), F.col(f"`{label}`").cast("int").alias("y"))
             .filter("id_ is not null and y is not null").groupBy("id_").agg(F.max("y").alias("y")).filter("y in (0, 1)"))
    seen = {r["y"]: r["n"] for r in named.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = staged_apart(docs.select(F.col(f"`{key}`").alias("id_"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
                        .join(named, "id_").groupBy("id_", "y").agg(F.min("t").alias("t")).select("id_", "y", "t"), "toxicity-rows")
    size = rows.agg(*[F.count_if(F.col("y") == y).alias(f"n{y}") for y in (0, 1)], F.sum(F.length("t")).alias("chars")).first()
    weights = tuple(seen.get(y, 0) / max(1, size[f"n{y}"]) for y in (0, 1))
    n = size["n0"] + size["n1"]
    shards = max(1, -(-n // shard_rows), -(-(size["chars"] or 0) // shard_chars))
    if not size["n0"] or not size["n1"]:
        unstage(rows)
        return train([""] * min(n, 1), [int(size["n1"] > 0)] * min(n, 1), weights, **options)
    alone = shards == 1
    dealt = rows.coalesce(1) if alone else rows.repartition(shards, "id_")  # a partition is a shard
    schema = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("v", T.ArrayType(T.FloatType())),
                           T.StructField("limits", T.ArrayType(T.DoubleType())), T.StructField("y", T.IntegerType()), T.StructField("t", T.StringType())])
    kinds = pa.schema([("at", pa.int32()), ("n", pa.int64()), ("v", pa.list_(pa.float32())), ("limits", pa.list_(pa.float64())),
                       ("y", pa.int32()), ("t", pa.string())])

    def trained(shard: list[tuple]):
        """Rows of the table that have moved, the other parameters behind them, the thresholds or the rows for calibration."""
        shard.sort(key=lambda r: str(r[0]))
        model, checked = train_part([t for _, _, t in shard], [y for _, y, _ in shard], weights if alone else None, **options)
        moved, rest = np.flatnonzero((model.table != untrained(options).table).any(1)), model.rest()
        at = [*moved.tolist(), *range(model.buckets, model.buckets + len(rest))]
        v = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate([model.table[moved], rest]).ravel()), rest.shape[1]).cast(kinds.field("v").type)
        blank = {f.name: pa.nulls(len(at), f.type) for f in kinds}
        yield pa.RecordBatch.from_arrays(list({**blank, "at": pa.array(at, pa.int32()), "n": pa.array([len(shard)] * len(at), pa.int64()), "v": v}.values()), schema=kinds)
        if alone:
            yield pa.RecordBatch.from_pylist([{"limits": model.thresholds.tolist()}], schema=kinds)
        else:
            for i in range(0, len(checked), 256):
                yield pa.RecordBatch.from_pylist([{"y": shard[c][1], "t": shard[c][2]} for c in checked[i:i + 256]], schema=kinds)

    def each(batches):
        shard = [row for batch in batches for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("id_", "y", "t")))]
        if shard:
            yield from trained(shard)

    parts = staged_apart(dealt.mapInArrow(each, schema), "toxicity-models")
    unstage(rows)
    model = untrained(options)
    width, moved = model.table.shape[1], parts.filter("at is not null")
    if not alone:
        moved = moved.groupBy("at").agg(F.array(*[F.sum(F.col("v")[j].cast("double") * F.col("n")) / F.sum("n") for j in range(width)]).alias("v"))
    found = moved.select("at", "v").toArrow().sort_by("at")
    at, v = found.column("at").to_numpy(), found.column("v").combine_chunks().flatten().to_numpy().reshape(-1, width)
    model.table[at[at < model.buckets]] = v[at < model.buckets]
    model.set_rest(v[at >= model.buckets])
    if alone:
        model.thresholds[:] = parts.filter("limits is not null").first()["limits"]
    else:
        calibrate(model, parts.filter("t is not null").select("y", "t"), weights)
    unstage(parts)
    return model


def untrained(options: dict) -> Model:
    """The model that ``train`` starts from with these options."""
    return Model(**{k: v for k, v in options.items() if k not in ("epochs", "batch", "rate", "seed")})


def calibrate(model: Model, rows: DataFrame, weights: tuple[float, float]) -> None:
    """Set the thresholds by labelled rows (``y``, ``t``) of any number: the general one, and that of each language with
    20 rows of either label."""
    outputs = T.StructType([T.StructField("logit", T.DoubleType()), T.StructField("lang", T.IntegerType())])
    judged = staged(map_text(rows, "t", outputs, lambda: judge(model), keep=["y"]), "toxicity-logits")
    numbers = {r["lang"]: r for r in judged.groupBy("lang").agg(*[F.count_if(F.col("y") == y).alias(f"n{y}") for y in (0, 1)]).collect()}
    model.thresholds[:] = cut(judged, weights)
    for lang in range(len(LANGS)):
        if lang in numbers and min(numbers[lang]["n0"], numbers[lang]["n1"]) >= 20:
            model.thresholds[lang] = cut(judged.filter(F.col("lang") == lang), weights)


def cut(judged: DataFrame, weights: tuple[float, float]) -> float:
    """``threshold`` of a table's ``logit`` and ``y``, with cuts between different logits only."""
    gain = F.sum(F.when(F.col("y") == 1, F.lit(float(weights[1]))).otherwise(F.lit(-float(weights[0]))))
    sums = staged(running_sum(judged.groupBy("logit").agg(gain.alias("gain")), "logit", "gain", "before"), "toxicity-cuts")
    ends = sums.agg(F.max("logit").alias("last"), F.sum("gain").alias("total"), F.min("before").alias("least")).first()
    least = min(ends["least"], ends["total"])
    best = sums.filter(F.col("before") <= least + 1e-6)
    n = best.count()
    middle = (n + (ends["total"] <= least + 1e-6)) // 2
    if middle == n:
        return ends["last"] + 1
    above = best.orderBy("logit").select("logit").offset(middle).first()["logit"]
    below = sums.filter(F.col("logit") < above).agg(F.max("logit").alias("logit")).first()["logit"]
    return above - 1 if below is None else (above + below) / 2


def judge(model: Model):
    """A function from texts to their logits and languages."""
    words, known = Words(model.buckets), Memory(CACHE_ENTRIES)

    def embedded(names: list[bytes]) -> list[tuple[np.ndarray, int]]:
        rows, langs = words.features(names)
        return list(zip(model.table[rows].sum(1), langs.tolist()))

    def step(texts):
        codes, cuts, names = coded_words(texts)
        found = known.lookup(names, embedded)
        pad = len(names)
        vectors = np.zeros((pad + 1, model.table.shape[1]), np.float32)
        langs = np.zeros(pad + 1, np.int64)
        if found:
            vectors[:pad] = [v for v, _ in found]
            langs[:pad] = [g for _, g in found]
        ids = [codes[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        logit = np.empty(len(ids))
        for first, last in pieces([len(i) for i in ids]):
            flat, starts, stops = laid_out(ids[first:last], pad)
            logit[first:last] = model.logits(vectors[flat], starts, stops)
        return [pa.array(logit), pa.array(np.array([guess(i, langs) for i in ids], np.int32))]

    return step


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
          out: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Add ``out``: the score (double, 0 to 1) and the decision (1 if the score is at least 0.5).

    Only the text is read; null and empty texts have a score as well.
    """
    def make():
        logits = judge(model)

        def step(texts):
            logit, guessed = (a.to_numpy() for a in logits(texts))
            s = model.scores(logit, guessed)
            return [pa.array(s), pa.array((s >= 0.5).astype(np.int32))]

        return step

    return map_text(df, text, T.StructType([T.StructField(out[0], T.DoubleType()),
                                            T.StructField(out[1], T.IntegerType())]), make, keep)
