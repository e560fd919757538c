"""Language-model scoring with a probabilistic suffix tree over tokens.

The tree predicts a text's next token from the longest of its retained contexts that
ends the tokens before it; a text begins behind a mark of its own.  Every sequence of up to
``depth`` + 1 tokens that the training texts have at least ``min_count`` times is counted,
so the tree grows with the corpus.  A context is retained if its next-token distribution
diverges from what its own suffix predicts.  In a retained context the next tokens that
recur have probabilities of their own, smoothed towards the suffix's; all others share
what is left in the proportions of the suffix.  The empty context is the add-half
unigram distribution over the training tokens and one unknown token.  Everything sums to one.

A sequence goes by a 64-bit polynomial hash of its tokens' hashes, whatever its length; two of n
sequences share one with a chance of about n * n / 2^65.  Counts, contexts and entries are
distributed tables.  A score is a sum: an entry adds to the unigram
log probability what it gains over its suffix, a retained context without the entry the logarithm of the
share it leaves.  So each sequence has one weight, and a text's sequences meet the weights part by part
of the hash range.  Workers receive only the numbers of frequent tokens (at most 1 / token_share) and a
bit map of fixed size that says which hashes may recur; where it is full, more is shuffled and the result is the same.
"""

from __future__ import annotations

from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded_words, shuffle_partitions, slices, staged_apart, unstage

#: The end token; words are never empty.
END = b""


#: Bytes of text whose distinct tokens are handled together.
SLICE = 4 << 20
#: The texts are scored in so many shares, one after another: what meets the weights stands on disk for one of them.
SHARES = 2
#: Texts that a worker receives at a time.
TEXTS = 1000


def coded_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """All texts' tokens one after another as places in a list of the distinct ones, each text's start, and that list.

    Tokens are words of all but ASCII white space, A-Z lower-cased, then the end token.
    """
    codes, at, names = coded_words(texts, lower=True)
    if b"" in names:
        names[names.index(b"")] = b" "  # never counted: what white space at a text's ends left in the list
    n = len(texts)
    flat = np.full(len(codes) + n, len(names), np.int64)
    word = np.ones(len(flat), bool)
    word[at[1:] + np.arange(n)] = False
    flat[word] = codes
    return flat, at[:-1] + np.arange(n), [*names, END]


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, n) over all rows of ``texts`` (text)."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, 0, SLICE):
                flat, _, names = coded_tokens(part.column(0))
                n = np.bincount(flat, minlength=len(names))
                seen = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in seen], pa.binary()), pa.array(n[seen], pa.int64())],
                                                 names=["token", "n"])

    return texts.mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


class Numbers:
    """Numbers of the frequent tokens; -1 for all others."""

    def __init__(self, names: list[bytes]):
        self.names = names
        self.of = {t: i for i, t in enumerate(names)}
        self.end = self.of.get(END, -1)

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """``coded_tokens`` with the tokens' numbers in front."""
        flat, starts, names = coded_tokens(texts)
        get = self.of.get
        return np.array([get(t, -1) for t in names], np.int64)[flat], starts, flat, names


def find(sorted_codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Place of each code, or -1."""
    if not len(sorted_codes):
        return np.full(len(code), -1)
    i = np.minimum(np.searchsorted(sorted_codes, code), len(sorted_codes) - 1)
    return np.where(sorted_codes[i] == code, i, -1)


def numbered(counted: DataFrame, token_share: float) -> tuple[Numbers, np.ndarray, np.ndarray, dict]:
    """The tokens with at least ``token_share`` of all, their counts and unigram probabilities, and totals."""
    total, distinct = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).collect()[0]
    totals = {"tokens": total, "distinct": distinct, "least": token_share * total, "mass": total + 0.5 * (distinct + 1)}
    frequent = counted.filter(F.col("n") >= F.lit(totals["least"])).toArrow()  # at most 1 / token_share rows
    named = sorted(zip(frequent.column("token").to_pylist(), frequent.column("n").to_pylist()))
    count = np.array([n for _, n in named], np.int64)
    return Numbers([t for t, _ in named]), count, (count + 0.5) / totals["mass"], totals


#: Hash of the mark before a text.
BEGIN = np.uint64(0x9E6C63D0876A9A47)
#: Factor of the polynomial hash.
FACTOR = np.uint64(0xD1342543DE82EF95)
#: The bit map has 2 ** MAP_BITS bits.
MAP_BITS = 28
#: Distinct sequences that a worker gathers before it sends them on.
GATHER = 3_000_000


def hashes(names: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array(names, object), categorize=False).astype(np.uint64)


def hashed(flat: np.ndarray, starts: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens, with the mark in front of each text, and each one's place in its text; ``own`` are the distinct tokens'."""
    out = np.insert(own[flat], starts, BEGIN)
    first = starts + np.arange(len(starts))
    return out, np.arange(len(out)) - np.repeat(first, np.diff(np.append(first, len(out))))


def sequences(tokens: np.ndarray, place: np.ndarray, longest: int):
    """For each length: the places where a sequence ends, its hash, and those of it without its last and without its first token."""
    code = tokens
    yield 1, np.arange(len(code)), code, np.zeros(len(code), np.uint64), np.zeros(len(code), np.uint64)
    for m in range(2, longest + 1):
        before = np.concatenate([code[:1], code[:-1]])
        longer = before * FACTOR + tokens
        ends = np.flatnonzero(place >= m - 1)
        yield m, ends, longer[ends], before[ends], code[ends]
        code = longer


def may_recur(bits: np.ndarray, code: np.ndarray) -> np.ndarray:
    at = code >> np.uint64(64 - MAP_BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def by_part(code: np.ndarray, shift: int):
    """(part, from, to) of the sorted hashes; a hash without its last ``shift`` bits is its part."""
    parts = (code >> np.uint64(shift)).astype(np.int64)
    first = np.flatnonzero(np.diff(parts, prepend=-1))
    return zip(parts[first].tolist(), first.tolist(), [*first[1:].tolist(), len(code)])


def parted(batches, key):
    """The rows of each key, one key after another, of rows sorted by it."""
    at, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and key(row) != at:
                yield at, rows
                rows = []
            at = key(row)
            rows.append(row)
    if rows:
        yield at, rows


def packed(x: np.ndarray) -> bytes:
    """The numbers in as few bytes each as the largest needs, that width first."""
    x = x.astype(np.uint64)
    width = max(1, (int(x.max()).bit_length() + 7) // 8)
    return bytes([width]) + x.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8, offset=1).reshape(-1, data[0])
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, :data[0]] = rows
    return out.view(np.uint64).ravel()


def steps(code: np.ndarray, part: int, shift: int) -> bytes:
    """Sorted hashes of a part, which begins at ``part`` << ``shift``, as the differences of each to the one before."""
    return packed(np.diff(code, prepend=np.uint64(part) << np.uint64(shift)))


def stepped(data: bytes, part: int, shift: int) -> np.ndarray:
    return np.cumsum(unpacked(data)) + (np.uint64(part) << np.uint64(shift))


def _tasks(df: DataFrame, part_bits: int) -> int:
    """Tasks for the parts of the hash range: one takes several parts, one after another, where there are very many."""
    return min(1 << part_bits, max(8 * shuffle_partitions(df.sparkSession), 64))


def totalled(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, the place of one of each, and the sums."""
    order, begin = runs(code)
    first = order[begin]
    return code[first], first, np.add.reduceat(n[order].astype(np.int64), begin) if len(begin) else np.zeros(0, np.int64)


def runs(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts the hashes, and where in it a new one begins."""
    order = np.argsort(code)
    code = code[order]
    return order, np.flatnonzero(np.diff(code, prepend=~code[:1]))


def singles(flat: np.ndarray, own: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct tokens and of the mark, and how often they occur."""
    n = np.bincount(flat, minlength=len(own))
    seen = np.flatnonzero(n)
    return np.append(own[seen], BEGIN), np.append(n[seen], texts)


def recurring_bits(texts: DataFrame, longest: int, part_bits: int, min_count: int) -> np.ndarray:
    """The bit map of the hashes of all sequences that ``texts`` have at least ``min_count`` times.

    32 bits below a part's tell sequences apart here; one marked in error is counted for nothing.
    """
    cut = np.uint64(32 - part_bits)

    def send(batches):
        held, size = [], 0

        def flush():
            code, _, n = totalled(np.concatenate([c for c, _ in held]), np.concatenate([m for _, m in held]))
            rows = [(p, steps(code[a:b], p, 32), packed(np.minimum(n[a:b], min_count))) for p, a, b in by_part(code, 32)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                                              names=["part", "code", "n"])

        for batch in batches:
            for piece in slices(batch, 0, SLICE):
                flat, starts, names = coded_tokens(piece.column(0))
                own = hashes(names)
                for m, _, code, _, _ in sequences(*hashed(flat, starts, own), longest):
                    if m == 1:
                        code, n = singles(flat, own, len(starts))
                        held.append((code >> cut, n))
                    else:
                        held.append(np.unique(code >> cut, return_counts=True))
                    size += len(held[-1][0])
                if size > GATHER:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    def mark(batches):
        width = 1 << MAP_BITS - part_bits
        for part, rows in parted(batches, lambda r: r["part"]):
            code, _, n = totalled(np.concatenate([stepped(r["code"], part, 32) for r in rows]), np.concatenate([unpacked(r["n"]) for r in rows]))
            bits = np.zeros(width, np.uint8)
            bits[(code[n >= min_count] >> np.uint64(32 + part_bits - MAP_BITS)).astype(np.int64) - part * width] = 1
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()])],
                                             names=["part", "bits"])

    found = staged_apart(texts.mapInArrow(send, "part int, code binary, n binary").repartition(_tasks(texts, part_bits), "part")
                         .sortWithinPartitions("part").mapInArrow(mark, "part int, bits binary"), "pst-bits", TEXTS).toArrow()
    out = np.zeros((1 << part_bits, (1 << MAP_BITS - part_bits) // 8), np.uint8)
    for part, bits in zip(found.column("part").to_pylist(), found.column("bits").to_pylist()):
        out[part] = np.frombuffer(bits, np.uint8)
    return out.reshape(-1)


def count_sequences(texts: DataFrame, longest: int, part_bits: int, min_count: int, bits, numbers: Numbers | None = None) -> DataFrame:
    """(m, code, ctx, suf, n): the sequences of 1 to ``longest`` tokens found at least ``min_count`` times, with
    the hashes of them without their last and without their first token.

    Where the first and the last token have numbers, these are sent: the hash of a sequence and those of its ends tell the other two.
    """
    shift, inverse = 64 - part_bits, np.uint64(pow(int(FACTOR), -1, 1 << 64))
    names_ = numbers.names if numbers else []
    ends_ = np.append(hashes(names_), BEGIN)  # by number; the mark's is the last

    def send(batches):
        seen = bits.value
        held, size = {}, 0
        get = numbers.of.get if numbers else lambda t, none: none

        def flush():
            rows = []
            for m in list(held):
                code, n, ctx, suf, one, last = (np.concatenate(x) if x[0] is not None else None for x in zip(*held.pop(m)))
                code, first, n = totalled(code, n)
                if m == 1:
                    sets = [(code, n, ())]
                else:
                    one, last = one[first], last[first]
                    known = (last >= 0) & (one >= 0) if m > 2 else last >= 0
                    ctx, suf = ctx[first[~known]], suf[first[~known]]
                    sets = [(code[known], n[known], (None, None, one[known] if m > 2 else None, last[known])),
                            (code[~known], n[~known], (ctx, suf))]
                for code, n, more in sets:
                    rows += [(p, m, steps(code[a:b], p, shift), packed(n[a:b]), *(None if x is None else packed(x[a:b]) for x in more), *[None] * (4 - len(more)))
                             for p, a, b in by_part(code, shift)]
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                              names=["part", "m", "code", "n", "ctx", "suf", "one", "last"])

        def take(texts):
            flat, starts, names = coded_tokens(texts)
            own, size = hashes(names), 0
            number = np.insert(np.array([get(t, -1) for t in names], np.int32)[flat], starts, len(names_))
            for m, ends, code, ctx, suf in sequences(*hashed(flat, starts, own), longest):
                if m == 1:
                    code, n = singles(flat, own, len(starts))
                    at = may_recur(seen, code)
                    held.setdefault(m, []).append((code[at], n[at], None, None, None, None))
                else:
                    at = np.flatnonzero(may_recur(seen, code))
                    order, begin = runs(code[at])
                    first = at[order[begin]]
                    held.setdefault(m, []).append((code[first], np.diff(begin, append=len(at)), ctx[first], suf[first],
                                                   number[ends[first] - (m - 1)], number[ends[first]]))
                size += len(held[m][-1][0])
            return size

        for batch in batches:
            for piece in slices(batch, 0, SLICE):
                size += take(piece.column(0))
                if size > GATHER // 2:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    def count(batches):
        for (part, m), rows in parted(batches, lambda r: (r["part"], r["m"])):
            made = []
            for r in rows:
                code, n = stepped(r["code"], part, shift), unpacked(r["n"])
                if m == 1:
                    ctx = suf = np.zeros_like(code)
                elif r["last"] is None:
                    ctx, suf = unpacked(r["ctx"]), unpacked(r["suf"])
                else:
                    last = ends_[unpacked(r["last"]).astype(np.int64)]
                    ctx = (code - last) * inverse
                    suf = last if m == 2 else code - ends_[unpacked(r["one"]).astype(np.int64)] * np.uint64(pow(int(FACTOR), m - 1, 1 << 64))
                made.append((code, n, ctx, suf))
            code, n, ctx, suf = (np.concatenate(x) for x in zip(*made))
            code, first, n = totalled(code, n)
            keep = n >= min_count
            first = first[keep]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), m, np.int32)), *[pa.array(c.view(np.int64)) for c in (code[keep], ctx[first], suf[first])],
                                              pa.array(n[keep])], names=["m", "code", "ctx", "suf", "n"])

    return (texts.mapInArrow(send, "part int, m int, code binary, n binary, ctx binary, suf binary, one binary, last binary")
            .repartition(_tasks(texts, part_bits), "part").sortWithinPartitions("part", "m")
            .mapInArrow(count, "m int, code long, ctx long, suf long, n long"))


#: Rows that go to the parts of a hash range, sorted by ``code``: ``kind`` 0 is looked up, 1 looks it up.
DEALT = "part int, kind int, code binary, a binary, b binary, c binary"


def gathered(batches, most: int = GATHER // 10):
    """The rows of several batches as one table, of about ``most`` rows or fewer."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def dealt(kind: int, code: np.ndarray, shift: int, *others: np.ndarray) -> pa.RecordBatch:
    """``DEALT`` rows of a column of hashes and up to three more of eight bytes."""
    order = np.argsort(code)
    code, others = code[order], [x[order].view(np.uint64) for x in others]
    rows = [(p, kind, steps(code[a:b], p, shift), *(packed(x[a:b]) for x in others), *[None] * (3 - len(others))) for p, a, b in by_part(code, shift)]
    kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, kinds)], names=["part", "kind", "code", "a", "b", "c"])


def met(batches, shift: int):
    """For each part with rows that look up: the columns of what they look up, and theirs."""
    for part, rows in parted(batches, lambda r: r["part"]):
        sides = []
        for kind in (0, 1):
            some = [r for r in rows if r["kind"] == kind]
            names = [c for c in "abc" if some and some[0][c] is not None]
            sides.append((np.concatenate([stepped(r["code"], part, shift) for r in some] or [np.zeros(0, np.uint64)]),
                          *(np.concatenate([unpacked(r[c]) for r in some]) for c in names)))
        yield sides


def grow_tables(counts: DataFrame, mass: float, depth: int, least_divergence: float, weight: float, part_bits: int = 3) -> tuple[DataFrame, DataFrame]:
    """(code, w): what a sequence adds to a text's log10 probability each time the text has it; and of these the contexts of one token.

    ``counts`` as of ``count_sequences``, stored.  A context is retained if it diverges from its suffix by
    ``least_divergence`` nats and by more than its number of entries would bring by chance; ``weight`` is the
    weight of the suffix's distribution in a smoothed one.  A sequence that recurs has a recurring
    context and suffix, so each level finds both in the one before: the rows go to the parts of their
    suffixes' hashes for the probability of the last token there, then to those of their contexts'.
    """
    shift, tasks = 64 - part_bits, _tasks(counts, part_bits)

    def together(one: DataFrame, other: DataFrame) -> DataFrame:
        return one.unionByName(other).repartition(tasks, "part").sortWithinPartitions("part", "kind")

    def sender(kind: int, code: str, *others: str):
        def send(batches):
            for table in gathered(batches):
                code_, *others_ = (table.column(c).to_numpy() for c in (code, *others))
                yield dealt(kind, code_.view(np.uint64), shift, *others_)
        return send

    def lend(batches):
        held, size = [], 0
        for (code, p), asks in met(batches, shift):
            if len(asks) > 1:
                suf, own, ctx, n = asks
                order = np.argsort(code)
                held.append((ctx, own, n, p[order][find(code[order], suf)]))
                size += len(suf)
            if size > GATHER // 10:
                yield dealt(1, *(np.concatenate(x) for x in list(zip(*held))[:1]), shift, *(np.concatenate(x) for x in list(zip(*held))[1:]))
                held, size = [], 0
        if held:
            yield dealt(1, *(np.concatenate(x) for x in list(zip(*held))[:1]), shift, *(np.concatenate(x) for x in list(zip(*held))[1:]))

    def tester(m: int):
        def rows(m_, open_, code, n, p, w):
            columns = [pa.array(np.full(len(code), m_, np.int32)), pa.array(np.full(len(code), open_)), pa.array(code.view(np.int64)),
                       pa.array(n), pa.array(p), pa.array(w)]
            return pa.RecordBatch.from_arrays(columns, names=["m", "open", "code", "n", "p", "w"])

        def rest(share):
            return np.maximum(1 - share, 1e-12)

        def test(batches):
            for (code, size, w), asks in met(batches, shift):
                order = np.argsort(code)
                code, size, w = code[order], size[order].astype(np.float64), w[order].view(np.float64)
                if len(asks) > 1:
                    ctx, own, n, q = asks
                    q = q.view(np.float64)
                    order, begin = runs(ctx)
                    own, n, q, ctx = own[order], n[order], q[order], ctx[order[begin]]
                    entries = np.diff(begin, append=len(own))
                    at = find(code, ctx)
                    total = np.repeat(size[at], entries)
                    lower, share = np.exp(q), n / total
                    smooth = (n + weight * lower) / (total + weight)
                    gain, shares, lowers, smooths = (np.add.reduceat(x, begin) for x in (share * (np.log(share) - q), share, lower, smooth))
                    divergence = gain + rest(shares) * np.log(rest(shares) / rest(lowers))
                    kept = (divergence >= least_divergence) & (divergence * size[at] >= entries + 1)
                    left = np.log(rest(smooths) / rest(lowers))
                    w[at[kept]] += left[kept]
                    kept, left = np.repeat(kept, entries), np.repeat(left, entries)
                    p = np.where(kept, np.log(smooth), q) if m <= depth else np.zeros(len(own))  # the last level has no next
                    yield rows(m, m <= depth, own, n.view(np.int64) if m <= depth else np.zeros(len(own), np.int64), p, np.where(kept, np.log(smooth) - q - left, 0.0))
                code, w = code[w != 0], w[w != 0]
                yield rows(m - 1, False, code, np.zeros(len(code), np.int64), np.zeros(len(code)), w)
        return test

    # p: natural logarithm of the probability of a sequence's last token after the others; w: what it gains over the suffix
    known = counts.filter("m = 1").select("code", "n", F.log((F.col("n") + 0.5) / F.lit(mass)).alias("p"), F.lit(0.0).alias("w"))
    level = None
    for m in range(2, depth + 2):
        asks = counts.filter(F.col("m") == m).select("code", "ctx", "suf", "n").mapInArrow(sender(1, "suf", "code", "ctx", "n"), DEALT)
        lower = known.select("code", "p").mapInArrow(sender(0, "code", "p"), DEALT)
        lent = together(asks, lower).mapInArrow(lend, DEALT)
        whole = known.select("code", "n", "w").mapInArrow(sender(0, "code", "n", "w"), DEALT)
        tested = together(lent, whole).mapInArrow(tester(m), "m int, open boolean, code long, n long, p double, w double")
        before = level
        level = staged_apart(tested if before is None else tested.unionByName(before.filter("not open")), "pst-level")
        if before is not None:
            unstage(before)
        known = level.filter("open").select("code", "n", "p", "w")
    weights = level.filter("w <> 0").select("m", "code", (F.col("w") / log(10)).alias("w"))
    return weights.drop("m"), weights.filter("m = 1").drop("m")


def of_numbers(single: DataFrame, numbers: Numbers) -> np.ndarray:
    """The weight of each numbered token as a context, 0 where it is none."""
    own = hashes(numbers.names)
    order = np.argsort(own)
    ranked = own[order]

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(find(ranked, batch.column(0).to_numpy().view(np.uint64)) >= 0))

    found = single.mapInArrow(run, "code long, w double").toArrow()  # at most one row for each number
    out = np.zeros(len(own))
    out[order[find(ranked, found.column("code").to_numpy().view(np.uint64))]] = found.column("w").to_numpy()
    return out


def judge_texts(docs: DataFrame, numbers: Numbers, root: np.ndarray, rare: DataFrame, mass: float, weights: DataFrame, single: DataFrame,
                longest: int, part_bits: int, bits, share: int = 0) -> DataFrame:
    """Stored rows of two kinds: 1 what a part of the hash range adds to a text (row, known, base, tree), 2 texts.

    ``rare`` (token, n) holds the tokens without a number.  ``share`` is the place of these texts among the ``SHARES``.
    """
    kind = docs.schema["id_"].dataType.simpleString()
    schema = (f"part int, kind int, code binary, times binary, at binary, words binary, row long, id_ {kind}, held_out boolean, n_tokens long, "
              "known long, base double, tree double")
    log_root, left, shift = np.log10(root), of_numbers(single, numbers), 64 - part_bits

    def table(id_type, **columns):
        """A batch of ``schema`` with nulls in the columns not given."""
        size = len(columns["part"])
        kinds = dict(part=pa.int32(), kind=pa.int32(), code=pa.binary(), times=pa.binary(), at=pa.binary(), words=pa.binary(), row=pa.int64(),
                     id_=id_type, held_out=pa.bool_(), n_tokens=pa.int64(), known=pa.int64(), base=pa.float64(), tree=pa.float64())
        made = [columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns else pa.nulls(size, t)
                for c, t in kinds.items()]
        return pa.RecordBatch.from_arrays(made, names=list(kinds))

    def judge(batches):
        part, row, seen = (TaskContext.get().partitionId() * SHARES + share) << 33, 0, bits.value
        held, since, id_type = [], 0, None

        def flush():
            code, owner = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order, begin = runs(code)
            code, owner, begin = code[order[begin]], owner[order], np.append(begin, len(code))
            times = np.diff(begin)
            sent = [(p, steps(code[a:b], p, shift), packed(times[a:b]), packed(owner[begin[a]:begin[b]])) for p, a, b in by_part(code, shift)]
            return table(id_type, part=[s[0] for s in sent], kind=[1] * len(sent), code=[s[1] for s in sent], times=[s[2] for s in sent],
                         at=[s[3] for s in sent], row=[part + since] * len(sent))

        def take(piece):
            """What is known of a slice's texts and which tokens without a number they have; their sequences are held."""
            flat, starts, codes, names = numbers.rows(piece.column(0))
            common = flat >= 0
            base = np.zeros(len(flat))
            base[common] = log_root[flat[common]]
            tree = np.zeros(len(flat))
            tree[common] = left[flat[common]]
            count, first = piece.num_rows, part + row
            rows = np.arange(first, first + count)
            made = [table(id_type, part=rows % (1 << part_bits), kind=np.full(count, 2), row=rows, id_=piece.column(1), held_out=piece.column(2),
                          n_tokens=np.diff(np.append(starts, len(flat))), known=np.add.reduceat(common, starts, dtype=np.int64),
                          base=np.add.reduceat(base, starts), tree=np.add.reduceat(tree, starts))]
            own = hashes(names)
            place = np.flatnonzero(~common)
            if len(place):
                order = np.lexsort((codes[place], own[codes[place]]))
                place = place[order]
                owner = np.searchsorted(starts, place, side="right") - 1
                begin = np.flatnonzero(np.diff(codes[place], prepend=-1))
                word, begin = codes[place[begin]], np.append(begin, len(place))
                times = np.diff(begin)
                sent = [(p, a, packed(times[a:b]), packed(owner[begin[a]:begin[b]])) for p, a, b in by_part(own[word], shift)]
                words = [names[i] for i in word.tolist()]  # without blanks
                words = [b" ".join(words[a:b]) for a, b in zip([s[1] for s in sent], [*[s[1] for s in sent[1:]], len(words)])]
                made.append(table(id_type, part=[s[0] for s in sent], kind=[1] * len(sent), times=[s[2] for s in sent], at=[s[3] for s in sent],
                                  words=words, row=[first] * len(sent)))
            tokens, place = hashed(codes, starts, own)
            text_of = np.cumsum(place == 0) - 1 + (row - since)
            for m, ends, some, _, _ in sequences(tokens, place, longest):
                if m == 1:  # what numbered tokens leave to others is in ``left``
                    hit = np.flatnonzero(~np.insert(common, starts, False))
                    hit = hit[may_recur(seen, some[hit])]
                else:
                    hit = np.flatnonzero(may_recur(seen, some))
                held.append((some[hit], text_of[ends[hit]].astype(np.uint32)))
            return made

        for batch in batches:
            for piece in slices(batch, 0, SLICE):
                id_type = piece.column(1).type
                yield from take(piece)
                row += piece.num_rows
                if sum(len(x) for x, _ in held) > GATHER * 2 // 3:
                    yield flush()
                    since = row
        if held:
            yield flush()

    def send_weights(batches):
        for some in gathered(batches):
            code, w = some.column(0).to_numpy().view(np.uint64), some.column(1).to_numpy()
            order = np.argsort(code)
            code, w = code[order], w[order]
            sent = [(p, steps(code[a:b], p, shift), w[a:b].tobytes()) for p, a, b in by_part(code, shift)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*sent), (pa.int32(), pa.binary(), pa.binary()))],
                                             names=["part", "code", "at"])

    def send_words(batches):
        for some in gathered(batches, GATHER // 10):
            words, n = some.column(0).to_pylist(), some.column(1).to_numpy()
            own = hashes(words)
            order = np.argsort(own)
            sent = [(p, b" ".join([words[i] for i in order[a:b].tolist()]), n[order[a:b]].tobytes()) for p, a, b in by_part(own[order], shift)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*sent), (pa.int32(), pa.binary(), pa.binary()))],
                                             names=["part", "words", "at"])

    def meet(batches):
        part = None
        for batch in batches:
            kinds = batch.column(1).to_numpy()
            plain = batch.filter(pa.array(kinds >= 2))
            if plain.num_rows:
                yield plain
            sums, asked = [], []

            def answer():
                """What the tokens asked for add to the base; those that training has not seen count 0."""
                words, n = (pa.concat_arrays([x for x, _ in heard]), np.concatenate([x for _, x in heard])) if heard else (pa.array([], pa.binary()), np.zeros(0, np.int64))
                found = pc.fill_null(pc.index_in(pa.concat_arrays([x for x, _, _ in asked]), value_set=words), -1).to_numpy()
                c = np.append(n, 0)[found]
                found = np.repeat(c, np.concatenate([t for _, t, _ in asked]))
                sums.append((np.concatenate([t for _, _, t in asked]), found > 0, np.log10((found + 0.5) / mass), np.zeros(len(found))))
                asked.clear()

            for i in np.flatnonzero(kinds < 2).tolist():
                p, k, code, times, at = (batch.column(c)[i].as_py() for c in range(5))
                words, first = batch.column(5)[i].as_py(), batch.column(6)[i].as_py()
                if p != part:
                    if asked:
                        answer()
                    part, parts, own, w, heard = p, [], None, None, []
                if k == 0 and words is not None:
                    heard.append((pa.array(words.split(b" "), pa.binary()), np.frombuffer(at, np.int64)))
                elif k == 0:
                    parts.append((stepped(code, p, shift), np.frombuffer(at, np.float64)))
                elif words is not None:
                    asked.append((pa.array(words.split(b" "), pa.binary()), unpacked(times).astype(np.int64), first + unpacked(at).astype(np.int64)))
                elif parts:
                    if own is None:
                        code_, w_ = (np.concatenate(x) for x in zip(*parts))
                        own, where = np.unique(code_, return_inverse=True)
                        w = np.append(np.bincount(where, w_, len(own)), 0.0)
                    text = unpacked(at).astype(np.int64)
                    found = np.bincount(text, np.repeat(w[find(own, stepped(code, p, shift))], unpacked(times).astype(np.int64)))
                    text = np.flatnonzero(found)
                    sums.append((first + text, np.zeros(len(text), bool), np.zeros(len(text)), found[text]))
            if asked:
                answer()
            if sums:
                text, known, base, tree = (np.concatenate(x) for x in zip(*sums))
                rows, where = np.unique(text, return_inverse=True)
                yield table(batch.column(7).type, part=np.zeros(len(rows), np.int32), kind=np.ones(len(rows), np.int32), row=rows,
                            known=np.bincount(where, known, len(rows)).astype(np.int64), base=np.bincount(where, base, len(rows)),
                            tree=np.bincount(where, tree, len(rows)))

    sent = weights.mapInArrow(send_weights, "part int, code binary, at binary").withColumn("kind", F.lit(0))
    words = rare.mapInArrow(send_words, "part int, words binary, at binary").withColumn("kind", F.lit(0))
    return staged_apart(docs.mapInArrow(judge, schema).unionByName(sent, allowMissingColumns=True).unionByName(words, allowMissingColumns=True)
                        .repartition(_tasks(docs, part_bits), "part").sortWithinPartitions("part", "kind")
                        .mapInArrow(meet, schema).select("kind", "row", "id_", "held_out", "n_tokens", "known", "base", "tree"), "pst-judged", TEXTS)


def score(df: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 5, held_fold: int = 1, depth: int = 2,
          min_count: int = 2, least_divergence: float = 0.01, weight: float = 20.0, token_share: float = 2e-6) -> DataFrame:
    """One row per input row: ``key``, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32 of the key as text leaves ``held_fold`` when divided by ``folds`` are held
    out; the others train (a null key counts as empty text).  ``base_score`` is the add-half
    unigram log10 probability, ``score`` the suffix tree's (see ``grow_tables`` for its options); both give the same to a token
    that training has not seen.  Null texts count as empty and have the end token only;
    repeated rows are counted and scored each; an empty table gives an empty result.
    """
    held = F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")) % folds == held_fold
    docs = df.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.col(f"`{key}`").alias("id_"), held.alias("held"))
    train = docs.filter(~F.col("held")).select("text")
    spark, longest = df.sparkSession, depth + 1
    counted = staged_apart(count_tokens(train), "pst-tokens")
    numbers, _, root, totals = numbered(counted, token_share)
    # parts of about eight million sequences; the hash deals them evenly
    part_bits = min(MAP_BITS - 3, max(3, int(totals["tokens"] * longest / 8e6).bit_length()))
    bits = spark.sparkContext.broadcast(recurring_bits(train, longest, part_bits, min_count))
    counts = staged_apart(count_sequences(train, longest, part_bits, min_count, bits, numbers), "pst-sequences", TEXTS)
    weights, single = grow_tables(counts, totals["mass"], depth, least_divergence, weight, part_bits)
    unstage(counts)
    rare = counted.filter(F.col("n") < F.lit(totals["least"])).select("token", "n")
    judged = None
    for share in range(SHARES):
        some = judge_texts(docs.filter(F.pmod(F.xxhash64("text"), F.lit(SHARES)) == share), numbers, root, rare, totals["mass"], weights, single, longest,
                           part_bits, bits, share)
        judged = some if judged is None else judged.unionByName(some)
    unstage(weights)
    unstage(counted)
    more = (judged.filter("kind = 1").groupBy(F.col("row").alias("r"))
            .agg(*[F.sum(c).alias(f"more_{c}") for c in ("known", "base", "tree")]))
    base = F.col("base") + F.coalesce("more_base", F.lit(0.0))
    return (judged.filter("kind = 2").join(more, F.col("row") == F.col("r"), "left")
            .select(F.col("id_").alias(key), "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                    F.lit(totals["tokens"]).cast("long").alias("train_tokens"),
                    base.alias("base_score"), (base + F.col("tree") + F.coalesce("more_tree", F.lit(0.0))).alias("score")))
