"""Substring dedup: passages of words that a document with a smaller key has as well are removed.

Every window of ``words`` consecutive words of one document gets a Rabin-Karp hash: a
polynomial in the words' hashes modulo three primes (96 bits together), computed for all
windows of a slice of text from prefix sums.  A slice sends each distinct window once, with
its smallest key, to the part of the hash range it falls into; a window that it holds
under a greater key as well is a hit there and then.  A part keeps the smallest key of
each window and puts out the others as hits while it reads, so it holds its distinct
windows and no more, however common one of them is.  Hits and texts meet in buckets of
keys, where a document's hits become marked windows and these maximal intervals.

A key with a large share of the text has several buckets, its rows dealt by a hash of
their text, and its hits go to all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import coded_words, shuffle_partitions, slices, staged, staged_apart

#: The three greatest primes below 2**32, and a base for each (any numbers below them).
PRIMES = (4294967291, 4294967279, 4294967231)
BASES = (2654435761, 2246822519, 3266489917)

#: Words hashed at a time; window hashes that a part holds before it merges them; hits sent together.
BLOCK, MERGE, SEND = 1_000_000, 1_000_000, 500_000

#: Stands for a null key, which counts as the smallest.
NULL_KEY = -1 << 63


class Powers:
    """Powers of ``base`` modulo ``prime``, as many as have been asked for so far."""

    def __init__(self, base: int, prime: int):
        self.base, self.prime, self.have = base, prime, np.ones(1, np.uint64)

    def first(self, n: int) -> np.ndarray:
        while len(self.have) < n:
            step = pow(self.base, len(self.have), self.prime)
            self.have = np.concatenate([self.have, self.have * np.uint64(step) % np.uint64(self.prime)])
        return self.have[:n]


class Hasher:
    """Rabin-Karp hashes of all windows of ``words`` words."""

    def __init__(self, words: int):
        self.words = words
        self.up = [Powers(b, p) for b, p in zip(BASES, PRIMES)]
        self.down = [Powers(pow(b, -1, p), p) for b, p in zip(BASES, PRIMES)]

    def windows(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 and 32 bits for the window at each place of ``values`` (a row of three residues for each word)."""
        n, w = len(values), self.words
        out = []
        for i, p in enumerate(PRIMES):
            p = np.uint64(p)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(values[:, i] * self.up[i].first(n) % p, out=sums[1:])
            out.append((sums[w:] - sums[:-w]) % p * self.down[i].first(n - w + 1) % p)
        return out[0] << np.uint64(32) | out[1], out[2].astype(np.uint32)

    def of_texts(self, codes: np.ndarray, at: np.ndarray, names: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, place of the first word, 64 bits, 32 bits) of the texts' windows, a block of words at a time;
        ``codes``, ``at`` and ``names`` as of ``coded_words``."""
        digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, names)), "<u4").reshape(-1, 4)
        residues = digests[:, :3].astype(np.uint64) % np.array(PRIMES, np.uint64)
        text = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))
        for start in range(0, len(codes), BLOCK):
            stop = min(len(codes), start + BLOCK + self.words - 1)
            if stop - start < self.words:
                break
            key, extra = self.windows(residues[codes[start:stop]])
            place = np.arange(start, start + len(key))
            own = text[start:start + len(key)]
            whole = np.flatnonzero(place + self.words <= at[own + 1])
            yield own[whole], place[whole], key[whole], extra[whole]


def by_window(key: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal windows side by side and keeps theirs, and where in it each window begins."""
    order = np.argsort(key, kind="stable")
    k, e = key[order], extra[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    if (~new[1:] & (e[1:] != e[:-1])).any():  # two windows that agree in 64 bits
        order = np.lexsort((extra, key))
        k, e = key[order], extra[order]
        new[1:] = (k[1:] != k[:-1]) | (e[1:] != e[:-1])
    return order, np.flatnonzero(new)


def planes(x: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second ones and so on: bytes that hardly vary compress well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def packed_keys(ids: np.ndarray) -> tuple[int, bytes]:
    low = int(ids.min())
    return low, planes(ids.view(np.uint64) - np.int64(low).view(np.uint64))


def unpacked_keys(low: int, data: bytes) -> np.ndarray:
    return (unplaned(data) + np.int64(low).view(np.uint64)).view(np.int64)


def bucket_of(ids: np.ndarray, salt: np.ndarray | int, buckets: int) -> np.ndarray:
    x = (ids.astype(np.int64).view(np.uint64) + np.uint64(1) + np.uint64(0x9E3779B97F4A7C15) * np.asarray(salt, np.uint64))
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(33))) % np.uint64(buckets)).astype(np.int32)


def runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """From and to of each run of equal values."""
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else []
    return zip(first, [*first[1:], len(values)])


SENT = pa.schema([("part", pa.int32()), ("low", pa.int64()), ("ids", pa.binary()), ("keys", pa.binary()), ("extras", pa.binary())])


class Sender:
    """Packs hits by bucket; ``spread`` says how many buckets a key with very much text has."""

    def __init__(self, buckets: int, spread: dict[int, int]):
        self.buckets, self.spread, self.held, self.size = buckets, spread, [], 0

    def add(self, ids: np.ndarray, keys: np.ndarray) -> bool:
        """Whether it is time to send."""
        self.held.append((ids, keys))
        self.size += len(ids)
        return self.size >= SEND

    def send(self) -> pa.RecordBatch | None:
        if not self.size:
            return None
        ids, keys = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.size = [], 0
        to, which = bucket_of(ids, 0, self.buckets), np.arange(len(ids))
        for key, n in self.spread.items():
            own = np.flatnonzero(ids == key)
            for salt in range(1, n if len(own) else 0):
                to = np.concatenate([to, bucket_of(ids[own], salt, self.buckets)])
                which = np.concatenate([which, own])
        order = np.lexsort((which, to))
        to, ids, keys = to[order], ids[which[order]], keys[which[order]]
        rows = [(-1 - int(to[a]), *packed_keys(ids[a:b]), keys[a:b].tobytes(), None) for a, b in runs(to)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SENT)], schema=SENT)


def _text_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array]:
    """Keys (null as NULL_KEY) and texts in the order of keys."""
    ids = pc.fill_null(batch.column(0), NULL_KEY).to_numpy()
    order = np.argsort(ids, kind="stable")
    return ids[order], batch.column(1).take(pa.array(order))


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 50) -> DataFrame:
    """Remove each word that lies in a window of ``words`` words that also begins in a text with a smaller key.

    Words are runs of all but ASCII white space, unchanged; windows are judged on the input.
    Returns a row for each input row: ``key``, n_words (long), removed (array of start and end
    of each maximal interval of removed words, end exclusive), n_removed (long) and kept
    (string: the other words joined by one space).  No other column is returned.

    ``key`` is an integer column.  A null key counts as the smallest long and stays null; rows
    with the same key do not remove each other's words.  A null text counts as empty and gives
    an empty ``kept``; an empty table gives none.

    Windows are compared by 96 bits of hash, so n windows hold a false match with a chance of about
    n squared / 2**97.
    """
    kind = df.schema[key].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"the key column has to hold integers, not {kind.simpleString()}")
    spark = df.sparkSession
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    volume = staged(rows.groupBy(F.coalesce("id", F.lit(NULL_KEY)).alias("id")).agg(F.sum(F.octet_length("text")).alias("n")), "passages-volume")
    total = volume.agg(F.sum("n")).first()[0] or 0
    parts = 1 << (max(4 * shuffle_partitions(spark), total // (8 * MERGE)) - 1).bit_length()
    buckets = max(8 * shuffle_partitions(spark), total // (16 << 20))
    # at most 1,000 keys have more than a thousandth of the text
    share = max(total // 1000, 64 << 10)
    spread = {r["id"]: -(-r["n"] // share) for r in volume.filter(F.col("n") > share).collect()}
    hits = staged_apart(
        rows.mapInArrow(_send_windows(words, parts, buckets, spread), T.StructType.fromDDL(SENT_DDL))
        .repartition("part").sortWithinPartitions("part")
        .mapInArrow(_least_keys(buckets, spread), T.StructType.fromDDL(SENT_DDL)), "passages-hits")
    gone = hits.select((-1 - F.col("part")).alias("bucket"), F.lit(0).alias("kind"), "low", "ids", "keys",
                       F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("copies"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("low", "long"), ("ids", "binary"), ("keys", "binary"))]
    texts = rows.mapInArrow(_deal_texts(buckets, spread), "bucket int, id long, text string, copies int").select(
        "bucket", F.lit(1).alias("kind"), *none, "id", "text", "copies")
    done = (gone.unionByName(texts).repartition("bucket").sortWithinPartitions("bucket", "kind")
            .mapInArrow(_remove(words), OUT_DDL))
    return done.select(F.col("id").cast(kind).alias(key), "n_words", "removed", "n_removed", "kept")


SENT_DDL = "part int, low long, ids binary, keys binary, extras binary"
OUT_DDL = "id long, n_words long, removed array<struct<start: long, end: long>>, n_removed long, kept string"


def _send_windows(words: int, parts: int, buckets: int, spread: dict[int, int]):
    shift = np.uint64(65 - parts.bit_length())

    def run(batches):
        hasher, sender = Hasher(words), Sender(buckets, spread)
        for batch in batches:
            for piece in slices(batch, 1):
                ids, texts = _text_rows(piece)
                for own, _, key, extra in hasher.of_texts(*coded_words(texts)):
                    if not len(key):
                        continue
                    order, first = by_window(key, extra)  # of equal windows, the one of the smallest key comes first
                    own = ids[own[order]]
                    low = own[first]
                    later = np.flatnonzero(own > np.repeat(low, np.diff(np.append(first, len(own)))))
                    if len(later) and sender.add(own[later], key[order[later]]):
                        yield sender.send()
                    key, extra = key[order[first]], extra[order[first]]
                    part = (key >> shift).astype(np.int32) if parts > 1 else np.zeros(len(key), np.int32)
                    sent = [(int(part[a]), *packed_keys(low[a:b]), planes(np.diff(key[a:b], prepend=np.uint64(0))), extra[a:b].tobytes())
                            for a, b in runs(part)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*sent), SENT)], schema=SENT)
        if (last := sender.send()) is not None:
            yield last

    return run


def _least_keys(buckets: int, spread: dict[int, int]):
    def run(batches):
        sender, at, held, size = Sender(buckets, spread), None, [], 0

        def merge():
            """What is held, with one row for each window; whether there are hits to send."""
            key, extra, ids = (np.concatenate(x) for x in zip(*held))
            order, first = by_window(key, extra)
            ids = ids[order]
            low = np.minimum.reduceat(ids, first)
            later = np.flatnonzero(ids > np.repeat(low, np.diff(np.append(first, len(ids)))))
            full = len(later) and sender.add(ids[later], key[order[later]])
            return [(key[order[first]], extra[order[first]], low)], full

        for batch in batches:
            for r in batch.to_pylist():
                if r["part"] < 0:  # hits of a slice go on as they are
                    yield pa.RecordBatch.from_pylist([r], schema=SENT)
                    continue
                if held and (r["part"] != at or size >= MERGE):
                    kept, full = merge()
                    if full:
                        yield sender.send()
                    held, size = ([], 0) if r["part"] != at else (kept, 0)
                at = r["part"]
                held.append((np.cumsum(unplaned(r["keys"]), dtype=np.uint64), np.frombuffer(r["extras"], np.uint32),
                             unpacked_keys(r["low"], r["ids"])))
                size += len(held[-1][0])
        if held:
            merge()
        if (last := sender.send()) is not None:
            yield last

    return run


def _deal_texts(buckets: int, spread: dict[int, int]):
    """Texts with the bucket they go to; rows of a slice that are alike become one with a count."""
    def run(batches):
        for batch in batches:
            for piece in slices(batch, 1):
                seen: dict[tuple, int] = {}
                for row in zip(piece.column(0).to_pylist(), piece.column(1).cast(pa.binary()).to_pylist()):
                    seen[row] = seen.get(row, 0) + 1
                ids = np.array([NULL_KEY if i is None else i for i, _ in seen], np.int64)
                salt = np.zeros(len(ids), np.int64)
                if spread:
                    for j, (i, (_, t)) in enumerate(zip(ids.tolist(), seen)):
                        if i in spread:
                            salt[j] = xxhash.xxh3_64_intdigest(t) % spread[i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket_of(ids, salt, buckets)), pa.array([i for i, _ in seen], pa.int64()),
                     pa.array([t for _, t in seen], pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int32())],
                    names=["bucket", "id", "text", "copies"])

    return run


def _remove(words: int):
    def run(batches):
        hasher = Hasher(words)
        bucket, held = None, []
        ids, keys = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            to, kind = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("bucket", "kind"))
            for a, b in runs(to * 2 + kind):
                some = batch.slice(a, b - a)
                if to[a] != bucket:
                    bucket, held = to[a], []
                    ids, keys = np.zeros(0, np.int64), np.zeros(0, np.uint64)
                if kind[a] == 0:
                    held += [(unpacked_keys(low, i), np.frombuffer(k, np.uint64)) for low, i, k in zip(
                        *(some.column(some.schema.get_field_index(c)).to_pylist() for c in ("low", "ids", "keys")))]
                    continue
                if held:  # the hits of a bucket come before its texts
                    ids, keys = (np.concatenate(x) for x in zip(*held))
                    order = np.argsort(ids, kind="stable")
                    ids, keys, held = ids[order], keys[order], []
                part = some.select(["id", "text", "copies"])
                for piece in slices(part, 1):
                    yield _kept(piece, hasher, ids, keys)

    return run


def _kept(piece: pa.RecordBatch, hasher: Hasher, hit_ids: np.ndarray, hit_keys: np.ndarray) -> pa.RecordBatch:
    codes, at, names = coded_words(piece.column(1))
    ids = pc.fill_null(piece.column(0), NULL_KEY).to_numpy()
    left, right = np.searchsorted(hit_ids, ids, "left"), np.searchsorted(hit_ids, ids, "right")
    # 1 where a marked window begins, -1 behind its end
    edge = np.zeros(len(codes) + 1, np.int64)
    if (left < right).any():
        for own, place, key, _ in hasher.of_texts(codes, at, names):
            for a, b in runs(own):
                i = own[a]
                if left[i] < right[i]:
                    first = place[a:b][np.isin(key[a:b], hit_keys[left[i]:right[i]])]
                    edge[first] += 1
                    edge[first + hasher.words] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    spell = np.array(names + [b""], object)[:-1]
    start, end, sizes, kept = [], [], [], []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        own = gone[a:b]
        turn = np.flatnonzero(np.diff(own, prepend=False, append=False)) if own.any() else np.zeros(0, np.int64)
        start.append(turn[::2])
        end.append(turn[1::2])
        sizes.append(len(turn) // 2)
        kept.append(b" ".join(spell[codes[a:b][~own]].tolist()))
    total = np.concatenate([[0], np.cumsum(gone)])
    made = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
        pa.StructArray.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (start, end)], ["start", "end"]))
    out = pa.RecordBatch.from_arrays(
        [piece.column(0), pa.array(np.diff(at), pa.int64()), made, pa.array(total[at[1:]] - total[at[:-1]], pa.int64()),
         pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_words", "removed", "n_removed", "kept"])
    copies = piece.column(2).to_numpy()
    return out if (copies == 1).all() else out.take(pa.array(np.repeat(np.arange(len(copies)), copies)))
