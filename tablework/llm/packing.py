"""Hierarchical packing of tokenised documents into sequences of several lengths.

Each document's ids (one end id last) are cut into full windows of the longest tier;
those need no partner.  The rest of it is routed to the shortest tier that holds it.
Tiers are then packed from the longest down: a rest opens a sequence of its tier, and
the gap behind it is filled with whole rests of shorter tiers, the largest that fit
first, and at last by cutting one to measure.  What a partition has left over at its
end is laid out in sequences of falling powers of two, so no sequence needs padding.

Finished sequences are dealt to step groups: within a tier, as many as make up the
tokens of one training step, so that all steps cost about the same.

A partition packs its own documents with a bounded pool, without a shuffle; a group
of documents however large is just more documents.  Sequence ids start with the
partition's number; the same input splits give the same result after a retry.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Memory, free_name, slices, strung

#: Runs of letters or other signs, and words left whole, that a worker remembers.
RUNS_KEPT = 400_000
#: Bytes of text whose distinct runs are looked up together.
SLICE = 8 << 20


def _table(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in spans:
        out[a:b + 1] = True
    return out


_SPACE = _table((0x09, 0x0D), (0x20, 0x20))
#: Bytes of words that are cut into runs here: ASCII signs but the apostrophe, and the letters of two bytes that begin with C3.
_PLAIN = _table((0x21, 0x26), (0x28, 0x7E), (0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF), (0xC3, 0xC3))
#: 0 for white space, 1 for bytes of letters, 2 for digits, 3 for other signs.
_KIND = np.full(256, 3, np.uint8)
_KIND[_SPACE] = 0
_KIND[_table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))] = 1
_KIND[0x30:0x3A] = 2


def coded_runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """``coded_words`` for the units that the tokenizer works on: runs of letters, single digits and runs of other
    signs, lower-cased.

    A word with any other character, or with a part of a special token's marks, is one unit as it stands.
    """
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = texts.buffers()[2] if len(texts) else None
    b = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    first = at[:-1][at[:-1] < at[1:]]  # of texts that have bytes
    kind = _KIND[b]
    space = kind == 0
    begins = np.empty(len(b), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    begins[first] = True
    begins &= ~space
    # upper case: A-Z, and the letters C3 80 to C3 9E; in either way 32 below their lower case
    big = (b >= 0x41) & (b <= 0x5A)
    big[1:] |= (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E)
    low = b + big.view(np.uint8) * np.uint8(32)
    odd = ~(_PLAIN[b] | space)
    pair = ((b[:-1] == 0x3C) & (b[1:] == 0x7C)) | ((b[:-1] == 0x7C) & (b[1:] == 0x3E))
    odd[1:] |= pair
    if odd.any():
        word = ~space
        word[1:] &= space[:-1]
        word[first] = ~space[first]
        starts = np.flatnonzero(word)
        own = np.repeat(np.add.reduceat(odd, starts, dtype=np.int64) > 0, np.diff(np.append(starts, len(b))))
        whole = np.zeros(len(b), bool)
        whole[starts[0]:] = own
        begins &= ~whole | word
        low = np.where(whole, b, low)
    keep = ~space
    offsets = np.flatnonzero(begins[keep])
    kept = low[keep]
    units = pa.Array.from_buffers(pa.binary(), len(offsets), [None, pa.py_buffer(np.append(offsets, len(kept)).astype(np.int32)), pa.py_buffer(kept)])
    coded = units.dictionary_encode()
    return coded.indices.to_numpy(), np.searchsorted(np.flatnonzero(begins), at), coded.dictionary.to_pylist()


#: A unit that the tokenizer would not cut: lower-case letters, a digit, or other signs of ``_PLAIN``.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|(?!.*(?:<\||\|>))[!-&(-/:-@\[-`{-~]+")


def _byte_spelling() -> dict[int, str]:
    """The character that byte-level vocabularies spell each byte with: printable bytes as they are, the others, in
    order, as the characters from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class WordIds:
    """Ids of texts under a tokenizer that lower-cases, drops white space and encodes words apart.

    Each distinct run of a slice of text is looked up once; only those not remembered are tokenized.
    """

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data.decode())
        special = [(t.content, i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.mark = next((x for x in special if x[0].startswith("<|")), None)
        self.runs = Memory(RUNS_KEPT)
        # a byte-level model spells every byte as one character
        spec = json.loads(data)
        self.spelling = _byte_spelling() if "ByteLevel" in json.dumps(spec["pre_tokenizer"]) and spec["model"]["type"] == "BPE" else None

    def _encode(self, units: list[bytes]) -> list[bytes]:
        """Ids of each unit: a run goes straight to the model, what is left whole through all of the tokenizer."""
        if self.spelling is None:
            return self._encode_whole(units)
        model, plain, out = self.tokenizer.model, _RUN.fullmatch, []
        whole = []
        for u in units:
            if plain(u):
                text = u.decode() if u.isascii() else u.decode("latin-1").translate(self.spelling)
                out.append(array("I", [t.id for t in model.tokenize(text)]).tobytes())
            else:
                whole.append(len(out))
                out.append(b"")
        for i, ids in zip(whole, self._encode_whole([units[i] for i in whole])):
            out[i] = ids
        return out

    def _encode_whole(self, units: list[bytes]) -> list[bytes]:
        """Ids of each unit.  Special tokens part texts, so plain units go as one text with marks between."""
        texts = [u.decode("utf-8", "replace") for u in units]
        out = []
        for i in range(0, len(texts), 1024):
            part = texts[i:i + 1024]
            if self.mark is None or any("<|" in t or "|>" in t for t in part):
                got = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
                out += [array("I", e.ids).tobytes() for e in got]
                continue
            ids = np.array(self.tokenizer.encode(f" {self.mark[0]} ".join(part), add_special_tokens=False).ids, "<u4")
            start = 0
            for end in [*np.flatnonzero(ids == self.mark[1]).tolist(), len(ids)]:
                out.append(ids[start:end].tobytes())
                start = end + 1
        return out

    def batch(self, texts: pa.Array) -> list[bytes]:
        """32-bit ids of each text, in native order."""
        codes, at, names = coded_runs(texts)
        return strung(self.runs.lookup(names, self._encode), codes, at)


_ids: dict[str, WordIds] = {}


def _word_ids(data: bytes) -> WordIds:
    key = hashlib.sha256(data).hexdigest()
    if key not in _ids:
        _ids.clear()
        _ids[key] = WordIds(data)
    return _ids[key]


class Packer:
    """Packs pieces (row, start, length) of one partition; ``emit`` gets a finished sequence's pieces and its tier."""

    def __init__(self, tiers: tuple[int, ...], pool: int, emit):
        self.tiers, self.pool, self.emit = sorted(tiers), pool, emit
        self.rests: dict[int, list[tuple[int, int, int]]] = {t: [] for t in self.tiers}  # (length, row, start), ascending
        self.held = 0

    def add(self, row: int, length: int) -> None:
        top = self.tiers[-1]
        for start in range(0, length - top + 1, top):
            self.emit([(row, start, top)], top)
        if rest := length % top:
            self._route(row, length - rest, rest)
            if self.held >= self.pool:
                self.pack(leave=self.pool // 4)

    def _route(self, row: int, start: int, length: int) -> None:
        tier = next(t for t in self.tiers if length <= t)
        insort(self.rests[tier], (length, row, start))
        self.held += 1

    def _take(self, gap: int) -> tuple[int, int, int] | None:
        """The longest rest of a shorter tier that fits into ``gap``."""
        best = None
        for t in self.tiers:
            if t <= 2 * gap and (rests := self.rests[t]):
                i = bisect_right(rests, (gap, 1 << 62, 0))
                if i and (best is None or rests[i - 1][0] > best[0]):
                    best, at = rests[i - 1], (t, i - 1)
        if best:
            del self.rests[at[0]][at[1]]
            self.held -= 1
        return best

    def _cut(self, gap: int) -> tuple[int, int, int] | None:
        """The first ``gap`` ids of the shortest rest that is longer; the remainder is routed anew."""
        for t in self.tiers:
            if rests := self.rests[t]:
                i = bisect_right(rests, (gap, 1 << 62, 0))
                if i < len(rests):
                    length, row, start = rests.pop(i)
                    self.held -= 1
                    self._route(row, start + gap, length - gap)
                    return gap, row, start
        return None

    def pack(self, leave: int = 0) -> None:
        """Pack the pool, the longest tier first, until ``leave`` rests are left."""
        for tier in reversed(self.tiers):
            while self.held > leave and self.rests[tier]:
                length, row, start = self.rests[tier].pop()
                self.held -= 1
                pieces, gap = [(row, start, length)], tier - length
                while gap and (got := self._take(gap) or self._cut(gap)):
                    pieces.append((got[1], got[2], got[0]))
                    gap -= got[0]
                if gap:  # nothing is left to fill it with
                    self._lay_out(pieces)
                else:
                    self.emit(pieces, tier)

    def _lay_out(self, pieces: list[tuple[int, int, int]]) -> None:
        """Sequences of falling powers of two that hold ``pieces`` exactly."""
        total = sum(p[2] for p in pieces)
        while total:
            room = 1 << (total.bit_length() - 1)
            total -= room
            size, now = room, []
            while room:
                row, start, length = pieces.pop(0)
                now.append((row, start, took := min(length, room)))
                if took < length:
                    pieces.insert(0, (row, start + took, length - took))
                room -= took
            self.emit(now, size)


def pack(df: DataFrame, data: bytes, text: str = "text", key: str = "doc_id", end_id: int = 1,
         tiers: tuple[int, ...] = (256, 512, 1024, 2048), step_tokens: int = 65_536, pool: int = 2048) -> DataFrame:
    """One row per piece: ``key``, start, length, ids, doc_tokens, sequence_id, offset, tier, step_group.

    ``data`` is the content of a tokenizer file whose words white space parts (it
    travels with the function); ``tiers`` are powers of two.  A piece is ``length`` ids
    from ``start`` of its document (``doc_tokens`` ids with the end id; a null or empty
    text has that id alone) at ``offset`` of its sequence.  ``ids`` holds them as
    unsigned 32-bit integers in little-endian order, as a training file would.
    ``tier`` is the length of the sequence, which its pieces fill; ``step_group`` has
    sequences of one tier with ``step_tokens`` tokens together (a partition's last
    groups may have fewer).  Repeated rows and rows with a null key are packed like
    any others; an empty table has no pieces.  At most ``pool`` rests of documents
    wait for a partner at a time.  Other input columns are not returned.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError(f"tiers must be powers of two: {tiers}")
    own = free_name(df, "text_in")
    src = df.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(own), F.col(f"`{key}`"))
    schema = T.StructType([src.schema.fields[1]] + [T.StructField(n, T.LongType()) for n in ("start", "length")]
                          + [T.StructField("ids", T.BinaryType())]
                          + [T.StructField(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset", "tier", "step_group")])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        part = TaskContext.get().partitionId() << 40
        words = _word_ids(data)
        waiting: dict[int, tuple] = {}  # documents with ids to place: key, ids, ids left
        made = {c: [] for c in schema.names}
        count, tokens, groups, group_of = 0, {}, 0, {}
        key_type = None

        def emit(pieces, tier):
            nonlocal count, groups
            if tier not in group_of or tokens[tier] + tier > step_tokens:
                group_of[tier], tokens[tier] = groups, 0
                groups += 1
            tokens[tier] += tier
            offset = 0
            for row, start, length in pieces:
                doc = waiting[row]
                made[schema.names[0]].append(doc[0])
                made["start"].append(start)
                made["length"].append(length)
                made["ids"].append(doc[1][4 * start:4 * (start + length)])
                made["doc_tokens"].append(len(doc[1]) // 4)
                made["sequence_id"].append(part + count)
                made["offset"].append(offset)
                made["tier"].append(tier)
                made["step_group"].append(part + group_of[tier])
                offset += length
                doc[2] -= length
                if not doc[2]:
                    del waiting[row]
            count += 1

        def flush():
            cols = [pa.array(made[c], key_type if i == 0 else pa.binary() if c == "ids" else pa.int64())
                    for i, c in enumerate(schema.names)]
            for values in made.values():
                values.clear()
            return pa.RecordBatch.from_arrays(cols, names=schema.names)

        packer, row = Packer(tiers, pool, emit), 0
        for batch in batches:
            key_type = batch.column(1).type
            for piece in slices(batch, 0, SLICE):
                for doc, ids in zip(piece.column(1).to_pylist(), words.batch(piece.column(0))):
                    ids += end
                    waiting[row] = [doc, ids, len(ids) // 4]
                    packer.add(row, len(ids) // 4)
                    row += 1
                yield flush()
        if row:
            packer.pack()
            yield flush()

    return src.mapInArrow(run, schema)
