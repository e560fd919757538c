"""Motif search: conjunctive edge patterns as joins whose intermediate tables stay small.

Each term of a pattern is a relation over two vertex names.  With three or more terms,
relations are first reduced by semi-joins along the pattern, from its leaves to its root and
back, so an edge that no match can use is gone before any row is multiplied.  Matches then
grow by one vertex name at a time, from the smallest relation on.  A name that two or more
terms tie to what is bound already (a cycle) is extended, row by row, through the term in
which the row's vertex has the fewest edges; the other terms close it at once.  Rows hold
vertex ids and the edge attributes asked for; vertex attributes are attached once, at the end.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

_TERM = re.compile(r"^\s*(!?)\s*\((\w*)\)\s*-\s*\[(\w*)\]\s*->\s*\((\w*)\)\s*$")


@dataclass
class Term:
    """An edge of the pattern between two vertex names; anonymous ones have names that begin with ``_``."""
    a: str
    e: str
    b: str
    rows: DataFrame = field(default=None, repr=False)
    size: int = 0

    @property
    def ends(self) -> set[str]:
        return {self.a, self.b}


def parse(pattern: str) -> tuple[list[Term], list[tuple[str, str]]]:
    """The terms that have to match and the ends of those that must not."""
    terms: list[Term] = []
    never: list[tuple[str, str]] = []
    for i, text in enumerate(t for t in pattern.split(";") if t.strip()):
        m = _TERM.match(text)
        if not m:
            raise ValueError(f"bad motif term {text!r}")
        neg, a, e, b = m.groups()
        if neg:
            never.append((a, b))
        else:
            terms.append(Term(a or f"_a{i}", e or f"_e{i}", b or f"_b{i}"))
    bound = set().union(*(t.ends for t in terms)) if terms else set()
    if not bound or any(x not in bound for ends in never for x in ends):
        raise ValueError("negated terms need bound end points")
    names = [t.e for t in terms]
    if len(set(names)) < len(names) or bound & set(names):
        raise ValueError("an edge name stands for one term and for no vertex")
    return terms, never


def in_order(terms: list[Term]) -> list[Term]:
    """Terms so that each is connected to one before it, breadth first."""
    left, out, reached = list(terms[1:]), [terms[0]], [terms[0].a, terms[0].b]
    while left:
        t = next((t for x in reached for t in left if x in t.ends), None)
        if t is None:
            raise ValueError("motif terms must be connected")
        left.remove(t)
        out.append(t)
        reached += [x for x in (t.a, t.b) if x not in reached]
    return out


def find(graph, pattern: str, where: dict[str, str] | None = None, use: dict[str, list[str]] | None = None) -> DataFrame:
    """Matches of ``pattern`` as rows with a struct column for each name.

    ``where`` has a condition on the attributes of a vertex or edge name; it is applied before any join.  ``use``
    has the attributes wanted of each name, none for one that it leaves out; without ``use`` all attributes of all names
    are returned.  A vertex struct always has ``id``, an edge struct ``src`` and ``dst``.
    """
    terms, never = parse(pattern)
    where = where or {}
    edge_names = {t.e for t in terms}
    vertex_names = list(dict.fromkeys(x for t in terms for x in (t.a, t.b)))
    known = edge_names | set(vertex_names)
    if unknown := (set(where) | set(use or {})) - known:
        raise ValueError(f"no such name in the pattern: {sorted(unknown)}")
    ids = graph.vertices.select("id")
    narrowed = {v: graph.vertices.filter(where[v]).select("id") for v in vertex_names if v in where}
    for t in in_order(terms):
        wanted = [c for c in graph.edges.columns if c not in ("src", "dst") and (use is None or c in use.get(t.e, []))]
        if t.e.startswith("_"):
            wanted = []
        edges = graph.edges.filter(where[t.e]) if t.e in where else graph.edges
        cols = [F.col("src").alias(t.a)] + ([F.col("dst").alias(t.b)] if t.a != t.b else [])
        rows = edges.filter("src = dst") if t.a == t.b else edges
        rows = rows.select(*cols, F.struct("src", "dst", *wanted).alias(t.e) if wanted else F.lit(None).alias(t.e))
        for v in sorted(t.ends):
            rows = rows.join(narrowed.get(v, ids).withColumnRenamed("id", v), v, "left_semi")
        t.rows = rows if wanted else rows.drop(t.e)
    ordered = in_order(terms)
    if len(ordered) > 2:
        reduced(ordered)
    rows = _grow(ordered)
    for a, b in never:
        apart = graph.edges.select(F.col("src").alias("_na"), F.col("dst").alias("_nb"))
        rows = rows.join(apart, (F.col(a) == F.col("_na")) & (F.col(b) == F.col("_nb")), "left_anti")
    out = {}
    for v in (v for v in vertex_names if not v.startswith("_")):
        attributes = graph.vertices.columns if use is None else ["id", *[c for c in use.get(v, []) if c != "id"]]
        if attributes == ["id"]:
            out[v] = F.struct(F.col(v).alias("id"))
        else:
            held = graph.vertices.select(F.col("id").alias(f"_id_{v}"), F.struct(*attributes).alias(f"_v_{v}"))
            rows = rows.join(held, F.col(v) == F.col(f"_id_{v}")).drop(f"_id_{v}")
            out[v] = F.col(f"_v_{v}")
    for t in (t for t in terms if not t.e.startswith("_")):
        out[t.e] = F.col(t.e) if t.e in rows.columns else F.struct(F.col(t.a).alias("src"), F.col(t.b).alias("dst"))
    named = [x for x in dict.fromkeys(x for t in terms for x in (t.a, t.e, t.b)) if not x.startswith("_")]
    return rows.select(*[out[x].alias(x) for x in named])


def reduced(ordered: list[Term]) -> None:
    """Semi-join each relation with those behind it, last to first, then with those before it, and stage it."""
    def meet(t: Term, others: list[Term]) -> None:
        for o in others:
            for x in sorted(t.ends & o.ends):
                t.rows = t.rows.join(o.rows.select(x).distinct(), x, "left_semi")
        t.rows = stage(t.rows, f"motif-{t.a}-{t.b}")

    for i in range(len(ordered) - 1, -1, -1):
        meet(ordered[i], ordered[i + 1:])
    for i in range(1, len(ordered)):
        meet(ordered[i], ordered[:i])
    for t in ordered:
        t.size = t.rows.count()


def _grow(ordered: list[Term]) -> DataFrame:
    first = min(ordered, key=lambda t: t.size)
    rows, bound, left = first.rows, set(first.ends), [t for t in ordered if t is not first]
    while left:
        for t in [t for t in left if t.ends <= bound]:
            rows = rows.join(t.rows, sorted(t.ends))
            left.remove(t)
        if not left:
            break
        nearest = min((t for t in left if t.ends & bound), key=lambda t: t.size)
        new = (nearest.ends - bound).pop()
        ties = [t for t in left if new in t.ends and len(t.ends) == 2 and (t.ends - {new}) <= bound]
        rows = rows.join(ties[0].rows, (ties[0].ends - {new}).pop()) if len(ties) == 1 else _close(rows, new, ties)
        bound.add(new)
        left = [t for t in left if t not in ties]
    return rows


def _close(rows: DataFrame, new: str, ties: list[Term]) -> DataFrame:
    """Extend each row to ``new`` through the tie with the fewest edges at the row's vertex; the others close it."""
    ends = [(t.ends - {new}).pop() for t in ties]
    for i, (t, x) in enumerate(zip(ties, ends)):
        rows = rows.join(t.rows.groupBy(x).agg(F.count(F.lit(1)).alias(f"_n{i}")), x)
    least = F.least(*[F.col(f"_n{i}") for i in range(len(ties))])
    choice = reduce(lambda rest, i: F.when(F.col(f"_n{i}") == least, i).otherwise(rest), reversed(range(len(ties))), F.lit(-1))
    rows = stage(rows.withColumn("_by", choice).drop(*[f"_n{i}" for i in range(len(ties))]), "motif-rows")
    out = []
    for i, (t, x) in enumerate(zip(ties, ends)):
        some = rows.filter(F.col("_by") == i).drop("_by").join(t.rows, x)
        for j, (u, y) in enumerate(zip(ties, ends)):
            if j != i:
                some = some.join(u.rows, sorted({y, new}))
        out.append(some)
    return reduce(DataFrame.unionByName, out)
