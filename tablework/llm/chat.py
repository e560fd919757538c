"""Chat formatting with a grammar round trip.

A turn is rendered as ``### <role>: <text></turn>`` and a newline.  Inside a role or
text, a backslash in front of a ``#`` that begins ``###``, of ``</turn>`` or of another
backslash makes it ordinary; in a role also in front of ``: ``.  The parser is deterministic: it reads
up to the first mark that no backslash guards and drops the guards.

The formatter first renders what it was given as it stands, reparses it, and compares
the recovered turns with the source.  What does not come back identical is escaped
and rendered again, until it does; text without control strings is never touched.
Every turn ends in its own mark, so a conversation is formatted turn by turn, and a
very long one never has to fit into memory.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import others, shuffle_partitions

HEAD, MID, TAIL = "### ", ": ", "</turn>\n"
_ROLE = re.compile(r"### ((?:[^\\:]++|\\.|:(?! ))*+): ", re.S)
_TEXT = re.compile(r"((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)
_GUARD_TEXT = re.compile(r"\\|#(?=##)|</turn>")
_GUARD_ROLE = re.compile(r"\\|#(?=##)|</turn>|: |:$")
_UNGUARD = re.compile(r"\\(.)", re.S)


def escape(s: str, role: bool = False) -> str:
    return (_GUARD_ROLE if role else _GUARD_TEXT).sub(lambda m: "\\" + m[0], s)


def unescape(s: str) -> str:
    return _UNGUARD.sub(r"\1", s) if "\\" in s else s


def parse(rendered: str) -> list[tuple[str, str, int, int]] | None:
    """Turns of a rendered text: role, text, and where the text's characters lie; None if it is not well formed."""
    turns, at = [], 0
    while at < len(rendered):
        head = _ROLE.match(rendered, at)
        body = head and _TEXT.match(rendered, head.end())
        # a bare header inside a text would be read as the start of another turn by other readers
        if not body or re.search(r"(?<!\\)###", unguarded(body[1])) or re.search(r"(?<!\\)###", unguarded(head[1])):
            return None
        turns.append((unescape(head[1]), unescape(body[1]), body.start(1), body.end(1)))
        at = body.end()
    return turns


def unguarded(s: str) -> str:
    """``s`` without its escaped backslashes, so that a remaining backslash guards what follows."""
    return s.replace("\\\\", "") if "\\" in s else s


def render(role: str, text: str) -> str:
    """One turn, escaped no more than its round trip needs."""
    tries = [(role, text), (role, escape(text)), (escape(role, True), text), (escape(role, True), escape(text))]
    for r, t in tries:
        out = f"{HEAD}{r}{MID}{t}{TAIL}"
        got = parse(out)
        if got and len(got) == 1 and got[0][:2] == (role, text):
            return out
    raise ValueError(f"a turn does not survive its round trip: {role!r}")


def format_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """Each row's turn rendered: ``formatted``, with ``mask_start`` and ``mask_end`` of the text to train on.

    Each row is rendered where it lies, without a shuffle; the rendered conversation is
    the concatenation of its rows in order of (turn, role, text).
    ``mask_start`` and ``mask_end`` are positions in ``formatted`` (end exclusive); they are
    null for turns of other roles than assistant.  Null roles and texts count as
    empty, a null conversation id as one conversation, and repeated rows as turns of
    their own.  Input columns named like an output are replaced.
    """
    names = others(df, ["formatted", "mask_start", "mask_end"])
    src = df.select(*[F.col(f"`{c}`") for c in names])
    i_role, i_text = names.index(role), names.index(text)
    schema = T.StructType(src.schema.fields + [T.StructField("formatted", T.StringType()),
                                               T.StructField("mask_start", T.LongType()),
                                               T.StructField("mask_end", T.LongType())])

    def run(batches):
        for batch in batches:
            out, starts, ends = [], [], []
            for r, t in zip(batch.column(i_role).to_pylist(), batch.column(i_text).to_pylist()):
                r, t = r or "", t or ""
                rendered = render(r, t)
                _, _, a, b = parse(rendered)[0]
                out.append(rendered)
                starts.append(a if r == "assistant" else None)
                ends.append(b if r == "assistant" else None)
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(out, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                names=schema.names)

    return src.mapInArrow(run, schema)


def read_back(formatted: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """Parse the rendered turns of ``format_turns`` again and digest each conversation.

    Turns are parsed, and the text under the loss mask is cut from the rendered output by
    the mask's positions, where the rows lie.  Only what the digests need is shuffled
    and sorted by (conversation, turn, role, text), since a running digest needs
    its conversation's turns in order; it streams over them and holds running hashes only.
    """
    parsed = T.StructType([formatted.schema[conv], *[T.StructField(n, formatted.schema[c].dataType) for n, c in
                                                     (("o1", turn), ("o2", role), ("o3", text))],
                           T.StructField("turns", T.StringType()), T.StructField("loss", T.StringType()), T.StructField("size", T.LongType())])
    order = [F.col(f"`{c}`") for c in (conv, turn, role, text)]
    parts = formatted.select(*order, "formatted", "mask_start", "mask_end")

    def parse_turns(batches):
        for batch in batches:
            turns, loss, size = [], [], []
            for rendered, a, b in zip(*(batch.column(i).to_pylist() for i in (4, 5, 6))):
                turns.append("".join(f"{r}\n{t}\n" for r, t, _, _ in parse(rendered)))
                loss.append(None if a is None else unescape(rendered[a:b]))
                size.append(len(rendered))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(turns, pa.string()), pa.array(loss, pa.string()),
                                              pa.array(size, pa.int64())], names=parsed.names)

    src = (parts.mapInArrow(parse_turns, parsed).repartition(shuffle_partitions(formatted.sparkSession), F.col(f"`{conv}`"))
           .sortWithinPartitions(F.col(f"`{conv}`"), "o1", "o2", "o3").select(F.col(f"`{conv}`").alias("conv_id"), "turns", "loss", "size"))
    schema = T.StructType([src.schema["conv_id"], T.StructField("n_turns", T.LongType()),
                           T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                           T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def run(batches):
        at, state = None, None

        def closed():
            n, turns, loss_n, loss, chars = state
            return {"conv_id": at, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_n,
                    "loss_sha256": loss.hexdigest(), "formatted_chars": chars}

        for batch in batches:
            done = []
            for conv_id, turn_, loss_, size in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv_id != at:
                    if state is not None:
                        done.append(closed())
                    at, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(turn_.encode())
                if loss_ is not None:
                    state[2] += len(loss_)
                    state[3].update(loss_.encode())
                state[4] += size
            yield pa.RecordBatch.from_pylist(done, schema=arrow_of(batch))
        if state is not None:
            yield pa.RecordBatch.from_pylist([closed()], schema=arrow_of(batch))

    def arrow_of(batch):
        return pa.schema([("conv_id", batch.schema.field(0).type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                          ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    return src.mapInArrow(run, schema)
