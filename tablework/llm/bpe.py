"""Byte-level BPE encoding and decoding.

A text is split by the vocabulary's pattern; each match is merged on its own.  The
merge keeps a segment tree over the match's byte positions.  A leaf holds the rank
of the pair that starts there, and an inner node the least (rank, position) below
it, so the root names the leftmost pair of lowest rank.  A merge changes the pairs
of two live neighbours and retires one position: three point updates of logarithmic
cost, so a match of n bytes takes O(n log n) whatever it holds.

Splitting is done in two steps.  A space followed by a character that is no white
space always starts a match of its own, whatever stands before it; a text may
therefore be cut there first.  The distinct pieces of a slice of text are looked up
once, in a table of bounded size that each worker keeps, and the matches of new
pieces are merged together, as many trees in the rows of one array.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import Memory, map_text, strung

#: Unicode white space, as in the pattern languages of the public tokenizers.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Pieces that a worker remembers.
PIECES_KEPT = 1_000_000
_NONE = 1 << 62
_POS = (1 << 32) - 1


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The rank table of a .tiktoken file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Token ids of one match of the split pattern."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    size = 1
    while size < n:
        size *= 2
    end = list(range(1, n + 1))  # end[i]: where the token that starts at i ends
    prev = list(range(-1, n - 1))
    tree = [_NONE] * (2 * size)
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i:i + 2])
        if rank is not None:
            tree[size + i] = rank << 32 | i
    for node in range(size - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b

    def put(i: int, key: int) -> None:
        node = size + i
        tree[node] = key
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            low = a if a < b else b
            if tree[node] == low:
                return
            tree[node] = low
            node >>= 1

    def pair(i: int) -> int:
        middle = end[i]
        if middle >= n or end[middle] - i > longest:
            return _NONE
        rank = get(piece[i:end[middle]])
        return _NONE if rank is None else rank << 32 | i

    while tree[1] != _NONE:
        i = tree[1] & _POS
        gone = end[i]
        after = end[i] = end[gone]
        if after < n:
            prev[after] = i
        put(gone, _NONE)
        put(i, pair(i))
        if prev[i] >= 0:
            put(prev[i], pair(prev[i]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Merger:
    """Merges many short matches at once: the same trees, one row each, in arrays."""

    #: Matches of up to so many bytes are merged here.
    WIDEST = 64

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >= 1 << 20:
            raise ValueError("pairs are packed into 40 bits: ranks have to be below 2**20")
        self.ranks, self.longest = ranks, max(map(len, ranks))
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens make together, or none."""
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], _NONE >> 32)

    def merge_all(self, matches: list[bytes]) -> list[bytes]:
        """Ids of each match as 32-bit integers."""
        out: list[bytes | None] = [None] * len(matches)
        by_size: dict[int, list[int]] = {}
        for i, m in enumerate(matches):
            if m in self.ranks:
                out[i] = array("i", [self.ranks[m]]).tobytes()
            elif len(m) > self.WIDEST:
                out[i] = array("i", merge(m, self.ranks, self.longest)).tobytes()
            else:
                by_size.setdefault(max(2, 1 << (len(m) - 1).bit_length()), []).append(i)
        for size, rows in by_size.items():
            for first in range(0, len(rows), 1 << 15):
                part = rows[first:first + (1 << 15)]
                for i, ids in zip(part, self._same_size([matches[i] for i in part], size)):
                    out[i] = ids
        return out

    def _same_size(self, matches: list[bytes], size: int) -> list[bytes]:
        n = len(matches)
        length = np.array([len(m) for m in matches])
        spelt = np.frombuffer(b"".join(m.ljust(size, b"\0") for m in matches), np.uint8).reshape(n, size)
        place = np.arange(size)
        token = np.where(place < length[:, None], self.byte[spelt], -1)
        after = np.where(place + 1 < length[:, None], place + 1, size)  # start of the next token; size: none
        before = np.tile(place - 1, (n, 1))
        tree = np.full((n, 2 * size), _NONE, np.int64)
        row, left = np.nonzero(after < size)
        tree[row, size + left] = self.rank(token[row, left], token[row, left + 1]) << 32 | left
        for node in range(size - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        row = np.arange(n)
        while len(row := row[tree[row, 1] < _NONE]):
            low = tree[row, 1]
            i = low & _POS
            gone = after[row, i]
            then = after[row, gone]
            token[row, i] = low >> 32
            token[row, gone] = -1
            after[row, i] = then
            inner = then < size
            before[row[inner], then[inner]] = i[inner]
            prev = before[row, i]
            # three point updates: the retired position and the pairs of the two live neighbours
            tree[row, size + gone] = _NONE
            new = np.where(inner, self.rank(token[row, i], token[row, np.minimum(then, size - 1)]) << 32 | i, _NONE)
            tree[row, size + i] = np.minimum(new, _NONE)
            outer = prev >= 0
            r, p = row[outer], prev[outer]
            tree[r, size + p] = np.minimum(self.rank(token[r, p], token[r, i[outer]]) << 32 | p, _NONE)
            for r, leaf in ((row, gone), (row, i), (r, p)):
                node = (size + leaf) >> 1
                while node[0] if len(node) else 0:
                    tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
                    node = node >> 1
        kept = token >= 0
        ends = np.cumsum(kept.sum(1))
        flat = token[kept].astype(np.int32)
        return [flat[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


class Codec:
    """Encoder and decoder of one rank table and split pattern."""

    def __init__(self, data: bytes, pattern: str):
        import regex

        self.ranks = read_ranks(data)
        self.merger = Merger(self.ranks)
        # \s is spelt out: the module's own class differs in a few control characters
        spelt = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
        self.split = regex.compile(spelt)
        self.cut = regex.compile(f" (?=[^{WHITE}])")
        self.odd = regex.compile(f" [{WHITE}]| $")
        self.pieces = Memory(PIECES_KEPT)
        self.table: list[bytes | None] = [None] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.table[rank] = token

    def _new_pieces(self, pieces: list[str]) -> list[bytes]:
        split = list(map(self.split.findall, pieces))
        distinct = list(set(chain.from_iterable(split)))
        ids = dict(zip(distinct, self.merger.merge_all([m.encode() for m in distinct])))
        return [ids[ms[0]] if len(ms) == 1 else b"".join([ids[m] for m in ms]) for ms in split]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as 32-bit integers in native order."""
        parts = pc.split_pattern(texts, " ")
        at = parts.offsets.to_numpy()
        at = at - at[0]
        codes = np.empty(int(at[-1]), np.int64)
        inner = np.ones(len(codes), bool)
        odd = [bool(self.odd.search(t)) for t in texts.to_pylist()]
        firsts = at[:-1]
        inner[firsts] = False
        for i in np.flatnonzero(odd):  # here a space alone tells too little; the text is cut by the pattern below
            inner[at[i]:at[i + 1]] = False
        coded = parts.flatten().filter(pa.array(inner)).dictionary_encode()
        names = [" " + p for p in coded.dictionary.to_pylist()]  # the space that was cut off belongs to the piece
        codes[inner] = coded.indices.to_numpy()
        # what stands before the first space of a text, and the pieces of an odd one
        extra: dict[str, int] = {}
        spans, lists_ = [], []
        for i, first in enumerate(parts.flatten().take(pa.array(firsts)).to_pylist()):
            cut = [first]
            if odd[i]:
                first, *rest = self.cut.split(texts[i].as_py())
                cut = [first, *[" " + p for p in rest]]
            lists_.append(np.array([extra.setdefault(p, len(extra)) for p in cut], np.int64) + len(names))
            spans.append(lists_[-1])
            if not odd[i]:
                spans.append(codes[at[i] + 1:at[i + 1]])
        sizes = [len(own) + (0 if odd[i] else int(at[i + 1] - at[i]) - 1) for i, own in enumerate(lists_)]
        values = self.pieces.lookup([*names, *extra], self._new_pieces)
        return strung(values, np.concatenate(spans) if spans else codes[:0], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))

    def decode(self, ids: np.ndarray) -> bytes:
        parts = [self.table[i] if 0 <= i < len(self.table) else None for i in ids.tolist()]
        if None in parts:
            raise ValueError(f"id {ids[parts.index(None)]} is not in the vocabulary")
        return b"".join(parts)


_codecs: dict[str, Codec] = {}


def _codec(data: bytes, pattern: str) -> Codec:
    """The worker's codec for a vocabulary; kept between tasks."""
    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(data, pattern)
    return _codecs[key]


def lists(parts: list[bytes], kind: pa.DataType = pa.int32(), width: int = 4) -> pa.Array:
    """A list column from the native bytes of each row's values."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int64)
    np.cumsum([len(p) // width for p in parts], out=offsets[1:])
    values = pa.Array.from_buffers(kind, int(offsets[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def encode(df: DataFrame, data: bytes, pattern: str, text: str = "text", keep: list[str] | None = None,
           with_decoded: bool = False) -> DataFrame:
    """Add ``ids`` (array<int>), the token ids of ``text``; special tokens are ordinary text.

    ``data`` is the content of a .tiktoken rank file (about 1 MB, of fixed size) and
    travels with the function, so the file need not lie on the executors.  A null or
    empty text has no ids.  With ``with_decoded`` also ``decoded`` (binary): the
    bytes that the ids stand for.
    """
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    if with_decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))

    def make():
        codec = _codec(data, pattern)

        def step(texts: pa.Array) -> list[pa.Array]:
            ids = codec.encode(texts)
            out = [lists(ids)]
            if with_decoded:
                out.append(pa.array([codec.decode(np.frombuffer(i, np.int32)) for i in ids], pa.binary()))
            return out

        return step

    return map_text(df, text, T.StructType(fields), make, keep, limit=8 << 20)


def decode(df: DataFrame, data: bytes, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out`` (binary): the bytes that an array of ids stands for.

    Null arrays decode to no bytes.  An id outside the vocabulary raises.
    """
    from .common import free_name, others

    names = others(df, [out])
    own = free_name(df, "ids_in")
    src = df.selectExpr(f"coalesce(cast(`{ids}` as array<int>), cast(array() as array<int>)) as {own}",
                        *[f"`{c}`" for c in names])
    schema = T.StructType(src.schema.fields[1:] + [T.StructField(out, T.BinaryType())])

    def run(batches):
        codec = _codec(data, r"\s+")
        for batch in batches:
            col = batch.column(0)
            flat, at = col.flatten().to_numpy(zero_copy_only=False), col.offsets.to_numpy()
            at = at - at[0]
            got = pa.array([codec.decode(flat[a:b]) for a, b in zip(at, at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays(batch.columns[1:] + [got], names=schema.names)

    return src.mapInArrow(run, schema)
