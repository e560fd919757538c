"""Fill-in-the-middle texts by a secondary sort of their pieces.

A text is cut at two places into prefix, middle and suffix and put together in another
order behind marks (``<P>``prefix``<S>``suffix``<M>``middle, or suffix first).  A unit is a run of
ASCII letters or any other code point; cuts lie between units.

No text is assembled in memory.  Each is emitted as pieces of some thousand units, keyed by
document and output position; partitioned by document and sorted by position inside the
partitions, they stream into incremental digests.  A parser follows the same stream, finds the
marks and gives each piece its place in the original text; sorted again by that place,
without another shuffle, the pieces stream into the digest of the restored text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, slices

MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDER = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
RANK = {"prefix": 0, "middle": 1, "suffix": 2}

#: Units in a piece, and the bytes beyond which a piece of long units is cut again.
UNITS, PIECE = 4096, 1 << 16


def choices(key: int | None) -> tuple[int, int, int, int]:
    """Four numbers that depend on a document's key alone (a null key: on no digits)."""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


def units(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units begin in the UTF-8 bytes of texts that begin at ``first``, and which bytes begin a code point."""
    letter = ((data | 0x20) >= 97) & ((data | 0x20) <= 122)
    point = (data & 0xC0) != 0x80
    begins = point.copy()
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[first[first < len(data)]] = True
    return np.flatnonzero(begins), point


def pieces_of(parts: list[tuple[bytes, int, int]], begins: np.ndarray, whole: memoryview) -> Iterator[bytes]:
    """The output in pieces: (mark, from, to) of each part, cut at every ``UNITS``-th unit."""
    for mark, a, b in parts:
        at = begins[np.searchsorted(begins, a):np.searchsorted(begins, b):UNITS].tolist()
        if not at:
            yield mark
        for i, j in zip(at, [*at[1:], b]):
            for k in range(i, j, PIECE):
                yield (mark if k == a else b"") + bytes(whole[k:min(k + PIECE, j)])


class Parser:
    """Follows an output as a stream; puts out (place in the original text, bytes) as it learns them."""

    def __init__(self, form: str):
        self.order, self.stage, self.tail, self.n = ORDER.get(form), -1, b"", 0

    def _place(self, data: bytes) -> list[tuple[int, int, bytes]]:
        if not data:
            return []
        self.n += 1
        return [(RANK[self.order[self.stage]] if self.order else 0, self.n, data)]

    def feed(self, data: bytes) -> list[tuple[int, int, bytes]]:
        if self.order is None:
            return self._place(data)
        data, out = self.tail + data, []
        while self.stage < 2 and (at := data.find(mark := MARKS[self.order[self.stage + 1]])) >= 0:
            out += self._place(data[:at])
            data, self.stage = data[at + len(mark):], self.stage + 1
        # the next mark may begin in the last two bytes
        keep = min(2, len(data)) if self.stage < 2 else 0
        self.tail = data[len(data) - keep:]
        return out + self._place(data[:len(data) - keep])

    def end(self) -> list[tuple[int, int, bytes]]:
        return self._place(self.tail)


HEAD = [("key", pa.int64()), ("row", pa.int64()), ("rank", pa.int32()), ("at", pa.int32())]
META = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
        ("copies", pa.int32()), ("output_sha256", pa.string()), ("output", pa.string())]
PIECES = pa.schema([*HEAD, ("body", pa.binary()), *META])
PIECES_DDL = ("key long, row long, rank int, at int, body binary, n long, form string, prefix_chars long, middle_chars long, "
              "copies int, output_sha256 string, output string")


class Rows:
    """Rows of a schema gathered into batches of some MB."""

    def __init__(self, schema: pa.Schema, limit: int = 4 << 20):
        self.schema, self.limit, self.rows, self.size = schema, limit, [], 0

    def add(self, row: tuple, size: int = 0) -> bool:
        self.rows.append(row)
        self.size += size + 64
        return self.size >= self.limit

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema)
        self.rows, self.size = [], 0
        return out


def _plan(key: int | None, text: bytes, n: int, begins: np.ndarray, a: int, b: int, plain_from: int, spm_below: int):
    """Form and cut places (bytes) of the text at ``a`` to ``b`` with the units ``begins``."""
    h1, h2, h3, h4 = choices(key)
    if not n or h3 % 100 >= plain_from or any(m in text for m in MARKS.values()):
        return "plain", a, a
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    cut = [int(begins[k]) if k < n else b for k in (low, high)]
    return "spm" if h4 % 100 < spm_below else "psm", *cut


def emit(df: DataFrame, key: str = "doc_id", text: str = "text", plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """The pieces of all outputs: key, row (64 bits of the text, which tell rows of one key apart), rank, at (output
    position) and body; the piece of rank -1 has no body, but the text's numbers and how many rows it stands for."""
    def run(batches):
        rows = Rows(PIECES)
        for batch in batches:
            for piece in slices(batch, 1):
                counted: dict[tuple, int] = {}
                for row in zip(piece.column(0).to_pylist(), as_bytes(piece.column(1))):
                    counted[row] = counted.get(row, 0) + 1
                joined = b"".join(t for _, t in counted)
                at = np.cumsum([0, *(len(t) for _, t in counted)])
                begins, point = units(np.frombuffer(joined, np.uint8), at[:-1])
                place = np.searchsorted(begins, at)
                chars = np.concatenate([[0], np.cumsum(point)])
                view = memoryview(joined)
                for i, ((k, t), copies) in enumerate(counted.items()):
                    a, b = int(at[i]), int(at[i + 1])
                    own = begins[place[i]:place[i + 1]]
                    form, low, high = _plan(k, t, len(own), own, a, b, plain_from, spm_below)
                    row = xxhash.xxh3_64_intdigest(t) - (1 << 63)
                    spans = {"prefix": (a, low), "middle": (low, high), "suffix": (high, b)}
                    parts = [(b"", a, b)] if form == "plain" else [(MARKS[p], *spans[p]) for p in ORDER[form]]
                    counts = (None, None) if form == "plain" else (int(chars[low] - chars[a]), int(chars[high] - chars[low]))
                    if rows.add((k, row, -1, 0, None, len(own), form, *counts, copies, None, None)):
                        yield rows.batch()
                    for j, body in enumerate(pieces_of(parts, own, view)):
                        if rows.add((k, row, 0, j, body, *[None] * 7), len(body)):
                            yield rows.batch()
        if rows.rows:
            yield rows.batch()

    src = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return src.mapInArrow(run, PIECES_DDL)


def documents(batches) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """Each document's head and its pieces' (rank, at, body) in order, of sorted rows; rows that are there twice count
    once, and a head says how many rows it stands for."""
    def rows():
        for batch in batches:
            yield from batch.to_pylist()

    stream = rows()
    row = next(stream, None)
    while row is not None:
        head, me = row, (row["key"], row["row"])
        row = next(stream, None)
        while row is not None and row["rank"] < 0 and (row["key"], row["row"]) == me:
            head["copies"] += row["copies"]
            row = next(stream, None)

        def bodies():
            nonlocal row
            last = None
            while row is not None and (row["key"], row["row"]) == me:
                if (row["rank"], row["at"]) != last:
                    last = (row["rank"], row["at"])
                    yield row["body"]
                row = next(stream, None)

        own = bodies()
        yield head, own
        for _ in own:  # what was not read
            pass


def digest_and_place(with_text: bool):
    """Digest each output and give its pieces their places in the original text."""
    def run(batches):
        rows = Rows(PIECES)
        for head, bodies in documents(batches):
            digest, parser, whole = hashlib.sha256(), Parser(head["form"]), []
            me = (head["key"], head["row"])

            def placed(found):
                return [(*me, rank, n, body, *[None] * 7) for rank, n, body in found]

            for body in bodies:
                digest.update(body)
                if with_text:
                    whole.append(body)
                for row in placed(parser.feed(body)):
                    if rows.add(row, len(row[4])):
                        yield rows.batch()
            for row in placed(parser.end()):
                rows.add(row, len(row[4]))
            rows.add((*me, -1, 0, None, head["n"], head["form"], head["prefix_chars"], head["middle_chars"], head["copies"],
                      digest.hexdigest(), b"".join(whole).decode() if with_text else None))
        if rows.rows:
            yield rows.batch()

    return run


RESULT = pa.schema([("key", pa.int64()), *META, ("restored_sha256", pa.string()), ("restored", pa.string())])
RESULT_DDL = ("key long, n long, form string, prefix_chars long, middle_chars long, copies int, output_sha256 string, output string, "
              "restored_sha256 string, restored string")


def digest_restored(with_text: bool):
    def run(batches):
        rows = Rows(RESULT)
        for head, bodies in documents(batches):
            digest, whole = hashlib.sha256(), []
            for body in bodies:
                digest.update(body)
                if with_text:
                    whole.append(body)
            made = (head["key"], *(head[f] for f, _ in META), digest.hexdigest(), b"".join(whole).decode() if with_text else None)
            for _ in range(head["copies"]):
                if rows.add(made, len(made[-1] or "")):
                    yield rows.batch()
        if rows.rows:
            yield rows.batch()

    return run


def transform(df: DataFrame, key: str = "doc_id", text: str = "text", plain_from: int = 90, spm_below: int = 20,
              with_text: bool = False) -> DataFrame:
    """Cut, rearrange and restore every text.

    Returns a row for each input row: ``key``, n (long: units), form (plain, psm or spm), prefix_chars and
    middle_chars (long: code points; null if plain), output_sha256 and restored_sha256, and with ``with_text``
    the texts themselves, output and restored (then one text at a time is held in memory).  No other column is
    returned.

    The cuts depend on the integer ``key`` alone.  A text stays plain if it is empty, holds a mark, or its key's
    third number modulo 100 is ``plain_from`` or more; of the others, the suffix comes first where the fourth is
    below ``spm_below``.  A null text counts as empty, a null key as no digits; rows that are alike are handled once
    and each get the result; an empty table gives none.
    """
    kind = df.schema[key].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"the key column has to hold integers, not {kind.simpleString()}")
    order = ["key", "row", "rank", "at"]
    outputs = emit(df, key, text, plain_from, spm_below).repartition("key", "row").sortWithinPartitions(*order)
    placed = outputs.mapInArrow(digest_and_place(with_text), PIECES_DDL).sortWithinPartitions(*order)
    done = placed.mapInArrow(digest_restored(with_text), RESULT_DDL)
    texts = ["output", "restored"] if with_text else []
    return done.select(F.col("key").cast(kind).alias(key), "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                       "restored_sha256", *texts)
