"""A graph of airports: a hub with spokes, a long one-way line, a loop, a pair of its own and a lone field."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablework.graph import graph
from tablework.graph.graph import Graph

from .conftest import rows

#: hub 1 <-> spokes 2, 3, 4; a ring 4 -> 5 -> 6 -> 4; a line 6 -> 10 -> 11 -> 12 -> 13; a loop at 13; a pair 20 <-> 21; 30 alone
SPOKES = [(1, s) for s in (2, 3, 4)] + [(s, 1) for s in (2, 3, 4)]
RING = [(4, 5), (5, 6), (6, 4)]
LINE = [(6, 10), (10, 11), (11, 12), (12, 13), (13, 13)]
PAIR = [(20, 21), (21, 20)]
IDS = [1, 2, 3, 4, 5, 6, 10, 11, 12, 13, 20, 21, 30]


@pytest.fixture(scope="module")
def g(spark):
    v = spark.createDataFrame([(i, f"field{i}", i * 100) for i in IDS], "id long, name string, height int")
    e = spark.createDataFrame([(a, b, "day" if (a + b) % 2 else "night") for a, b in SPOKES + RING + LINE + PAIR],
                              "src long, dst long, kind string")
    return Graph(v, e)


def edges(g):
    return {(r["src"], r["dst"]) for r in g.edges.collect()}


def test_degrees_and_attrs(g):
    out = {1: 3, 2: 1, 3: 1, 4: 2, 5: 1, 6: 2, 10: 1, 11: 1, 12: 1, 13: 1, 20: 1, 21: 1}
    assert dict(rows(g.out_degrees)) == out  # no row for field 30
    assert dict(rows(g.in_degrees)) == {1: 3, 2: 1, 3: 1, 4: 2, 5: 1, 6: 1, 10: 1, 11: 1, 12: 1, 13: 2, 20: 1, 21: 1}
    assert g.vertices.agg(F.max("height")).first()[0] == 3000


def test_motifs_match_brute_force(g):
    es = edges(g)
    mutual = g.find("(x)-[p]->(y); (y)-[q]->(x)")
    assert rows(mutual.select("x.id", "y.id")) == sorted((a, b) for a, b in es if (b, a) in es)
    two = g.find("(x)-[]->(y); (y)-[]->(z)").filter("x.id != z.id").select("x.id", "y.id", "z.id")
    assert rows(two) == sorted((a, b, d) for a, b in es for c, d in es if b == c and a != d)
    oneway = g.find("(x)-[]->(y); !(y)-[]->(x)").select("x.id", "y.id")
    assert rows(oneway) == sorted((a, b) for a, b in es if (b, a) not in es)
    chain = g.find("(w)-[p]->(x); (x)-[q]->(y); (y)-[r]->(z)")
    days = sum(F.when(F.col(f"{x}.kind") == "day", 1).otherwise(0) for x in "pqr")
    day = {e: (e[0] + e[1]) % 2 for e in es}
    want = [1 for a in es for b in es if a[1] == b[0] for c in es if b[1] == c[0] and day[a] + day[b] + day[c] >= 2]
    assert chain.filter(days >= 2).count() == len(want)


def test_cyclic_and_filtered_motifs_match_brute_force(spark):
    """A hub with many spokes each way, loops, parallel edges and an edge to a vertex that is not there."""
    es = [(0, i, i % 3) for i in range(1, 30)] + [(i, 0, i % 2) for i in range(1, 25)]
    es += [(i, i % 7 + 1, 1) for i in range(3, 20)] + [(2, 5, 0), (2, 5, 1), (5, 5, 2), (5, 99, 1)]
    v = spark.createDataFrame([(i, i * 10) for i in range(40)], "id long, age long")
    g = Graph(v, spark.createDataFrame(es, "src long, dst long, kind long"))
    es = [e for e in es if e[1] != 99]

    def matches(n, ends, keep=lambda *e: True):
        """All choices of n edges, by nested loops; ``ends`` has the pattern's vertex names."""
        out = []

        def step(i, names, chosen):
            if i == n:
                if keep(*chosen):
                    out.append(tuple(names[x] for x in sorted(names)) + tuple(e[2] for e in chosen))
                return
            for e in es:
                a, b = ends[i]
                new = dict(names)
                if new.setdefault(a, e[0]) == e[0] and new.setdefault(b, e[1]) == e[1]:
                    step(i + 1, new, [*chosen, e])

        step(0, {}, [])
        return sorted(out)

    for pattern, ends in (("(a)-[p]->(b); (b)-[q]->(c); (c)-[r]->(a)", ["ab", "bc", "ca"]),
                          ("(a)-[p]->(b); (b)-[q]->(c); (a)-[r]->(c)", ["ab", "bc", "ac"]),
                          ("(a)-[p]->(b); (b)-[q]->(b); (b)-[r]->(c)", ["ab", "bb", "bc"])):
        m = g.find(pattern, use={e: ["kind"] for e in "pqr"})
        assert rows(m.select("a.id", "b.id", "c.id", "p.kind", "q.kind", "r.kind")) == matches(3, ends)
    square = g.find("(a)-[p]->(b); (b)-[q]->(c); (c)-[r]->(d); (d)-[s]->(a)", where={"a": "age between 10 and 60", "q": "kind = 1"})
    want = matches(4, ["ab", "bc", "cd", "da"], lambda p, q, r, s: 1 <= p[0] <= 6 and q[2] == 1)
    assert rows(square.select("a.id", "b.id", "c.id", "d.id", "p.kind", "q.kind", "r.kind", "s.kind")) == want
    assert square.columns == ["a", "p", "b", "q", "c", "r", "d", "s"] and square.select("d.age").count() == len(want)
    loop = g.find("(a)-[p]->(a)")
    assert rows(loop.select("a.id", "p.src", "p.kind")) == [(5, 5, 2)]
    for bad in ("(a)-[p]->(b); (c)-[q]->(d)", "(a)-[p]->(b); (b)-[p]->(c)", "(a)-[]->(b); !(b)-[]->(c)", "(a)->(b)"):
        with pytest.raises(ValueError):
            g.find(bad)
    with pytest.raises(ValueError):
        g.find("(a)-[]->(b)", where={"z": "id = 1"})


def test_reduction_and_closing_keep_tables_small(spark):
    """A hub of 300 spokes each way has 90,000 wedges, but one triangle; no join may come near the wedges."""
    es = [(0, i) for i in range(1, 301)] + [(i, 0) for i in range(301, 601)] + [(1, 301)]
    g = Graph(spark.range(601), spark.createDataFrame(es, "src long, dst long"))
    m = g.find("(a)-[]->(b); (b)-[]->(c); (c)-[]->(a)")
    assert sorted(r["a"]["id"] for r in m.collect()) == [0, 1, 301]
    seen = joined_rows(m._jdf.queryExecution().executedPlan())
    assert seen and max(seen) < 2000


def joined_rows(plan) -> list[int]:
    """The row counts of all joins of a plan that has run."""
    out, todo = [], [plan]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        if "Join" in name and p.metrics().contains("numOutputRows"):
            out.append(p.metrics().apply("numOutputRows").value())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_subgraphs(g):
    s = g.filter_vertices("height < 500").filter_edges("kind = 'day'").drop_isolated_vertices()
    assert edges(s) == {(1, 2), (2, 1), (1, 4), (4, 1)}
    assert sorted(r["id"] for r in s.vertices.collect()) == [1, 2, 4]
    up = g.find("(x)-[e]->(y)").filter("x.height < y.height AND e.kind = 'night'")
    sub = Graph(g.vertices, up.select("e.*")).drop_isolated_vertices()
    assert edges(sub) == {(1, 3), (6, 10)}


def test_bfs(g):
    p = g.bfs("id = 2", "height > 1000")
    assert rows(p.select("from.id", "v1.id", "v2.id", "v3.id", "v4.id", "v5.id", "to.id")) == [(2, 1, 4, 5, 6, 10, 11)]
    assert rows(g.bfs("id = 13", "id = 13").select("from.id", "to.id")) == [(13, 13)]


def test_bfs_without_a_path_keeps_the_types(spark):
    v = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    e = spark.createDataFrame([("a", "a")], "src string, dst string")
    p = Graph(v, e).bfs("id = 'a'", "id = 'b'")
    assert p.count() == 0 and p.schema["from"].dataType["id"].dataType.simpleString() == "string"
    assert p.schema["to"].dataType.names == ["id", "n"]


def test_components(g):
    cc = dict(rows(g.connected_components().select("id", "component")))
    assert cc == {**{i: 1 for i in IDS if i < 20}, 20: 20, 21: 20, 30: 30}
    assert dict(rows(g.connected_components(method="propagate").select("id", "component"))) == cc
    scc = dict(rows(g.strongly_connected_components().select("id", "component")))
    assert scc == {**{i: 1 for i in (1, 2, 3, 4, 5, 6)}, **{i: i for i in (10, 11, 12, 13)}, 20: 20, 21: 20, 30: 30}


def test_long_path_runs_to_the_end(spark):
    """A path needs many rounds; nothing may be cut off on the way."""
    n = 60
    v = spark.range(0, n + 4).select("id")
    path = spark.range(0, n - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    tri = spark.createDataFrame([(n, n + 1), (n + 1, n + 2), (n + 2, n)], "src long, dst long")
    both = Graph(v, path.union(tri))
    cc = dict(rows(both.connected_components().select("id", "component")))
    assert [cc[i] for i in range(n)] == [0] * n
    assert [cc[i] for i in range(n, n + 4)] == [n, n, n, n + 3]
    scc = dict(rows(both.strongly_connected_components().select("id", "component")))
    assert scc == {**{i: i for i in range(n + 4)}, n + 1: n, n + 2: n}
    far = Graph(v, path).shortest_paths([n - 1]).filter("id = 0").first()["distances"]
    assert far == {n - 1: n - 1}


def test_shortest_paths_triangles_messages(g):
    sp = {r["id"]: dict(r["distances"]) for r in g.shortest_paths([1, 13]).collect()}
    assert sp[2] == {1: 1, 13: 8} and sp[6] == {1: 2, 13: 4} and sp[13] == {13: 0} and sp[20] == {}
    assert dict(rows(g.triangle_count().select("id", "count"))) == {**{i: 0 for i in IDS}, 4: 1, 5: 1, 6: 1}
    got = dict(rows(g.aggregate_messages(F.sum, to_src=F.col("dst.height"), to_dst=F.col("src.height"))))
    want = {}
    for a, b in edges(g):
        want[a] = want.get(a, 0) + b * 100
        want[b] = want.get(b, 0) + a * 100
    assert got == want


def test_pagerank(g):
    def plain(rounds):
        es, rank = edges(g), dict.fromkeys(IDS, 1.0)
        deg = {a: sum(x == a for x, _ in es) for a in IDS}
        for _ in range(rounds):
            rank = {i: 0.15 + 0.85 * sum(rank[a] / deg[a] for a, b in es if b == i) for i in IDS}
        total = sum(rank.values())
        return {i: x * len(IDS) / total for i, x in rank.items()}

    pr = dict(rows(g.pagerank(max_iter=10).select("id", "pagerank")))
    assert all(abs(pr[i] - x) < 1e-9 for i, x in plain(10).items())
    near = dict(rows(g.pagerank(max_iter=None, tol=1e-4).select("id", "pagerank")))
    assert all(abs(near[i] - x) < 1e-2 for i, x in plain(80).items())
    with pytest.raises(RuntimeError, match="rounds"):
        g.pagerank(max_iter=2, tol=1e-9)
    ppr = g.personalized_pagerank([1, 20], max_iter=10)
    assert {r["source"]: round(r["s"], 9) for r in ppr.groupBy("source").agg(F.sum("pagerank").alias("s")).collect()} == {1: 1.0, 20: 1.0}


def test_label_propagation_of_a_pair(g):
    lp = dict(rows(g.label_propagation(max_iter=3).select("id", "label")))
    assert lp[30] == 30 and {lp[20], lp[21]} == {20, 21}  # a pair swaps its labels each round


def test_save_load(g, spark, tmp_path):
    p = str(tmp_path / "graph")
    g.save(p)
    back = Graph.load(spark, p)
    assert back.vertices.count() == len(IDS) and edges(back) == edges(g)


def components_by_search(ids, es):
    """Smallest id of each vertex's strongly connected component, by reachability."""
    after = {i: set() for i in ids}
    for a, b in es:
        after[a].add(b)

    def reach(i):
        seen, todo = {i}, [i]
        while todo:
            for j in after[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        return seen

    to = {i: reach(i) for i in ids}
    return sorted((i, min(j for j in to[i] if i in to[j])) for i in ids)


def test_strong_components_of_random_graphs_match_search(spark):
    rng = random.Random(12)
    for n, m in ((25, 22), (25, 40), (12, 60)):
        es = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        es += [(100, 101), (101, 102), (102, 100), (103, 104), (104, 0), (0, 105), (105, 106), (106, 0)]  # a lone cycle, a way in, a chain round
        ids = sorted(set(range(n)) | set(range(100, 107)))
        g = Graph(spark.createDataFrame([(i,) for i in ids], "id long"), spark.createDataFrame(es, "src long, dst long"))
        assert rows(g.strongly_connected_components(), "id", "component") == components_by_search(ids, es)


def test_a_long_line_into_a_ring_takes_few_rounds(spark, monkeypatch):
    """10,000 vertices in a line, then a ring of 50: rounds are logarithmic in the line."""
    n = 10_000
    es = spark.range(n).selectExpr("id as src", "id + 1 as dst").union(spark.range(n, n + 50).selectExpr("id as src", f"if(id = {n + 49}, {n}, id + 1) as dst"))
    cuts, rounds = [], []
    real, whole = graph._materialize, graph.chains.contract
    monkeypatch.setattr(graph, "_materialize", lambda df: cuts.append(1) or real(df))
    monkeypatch.setattr(graph.chains, "contract", lambda *a: rounds.append((r := whole(*a))[3]) or r)
    got = Graph(spark.range(n + 50), es).strongly_connected_components()
    ring = got.filter(f"id >= {n}").select("component").distinct().collect()
    assert [r[0] for r in ring] == [n] and got.filter(f"id < {n} and component = id").count() == n
    assert sum(rounds) <= 40 and len(rounds) <= 4


def test_push_stays_within_its_bound(spark):
    rng = np.random.default_rng(3)
    n, es = 30, {(int(a), int(b)) for a, b in rng.integers(0, 30, (110, 2)) if a != b and a != 7} | {(0, i) for i in range(1, 30)}
    g = Graph(spark.range(n), spark.createDataFrame(sorted(es), "src long, dst long"))
    w = np.zeros((n, n))
    for a, b in es:
        w[a, b] = 1
    w /= np.maximum(w.sum(1, keepdims=True), 1)
    exact = 0.15 * np.linalg.inv(np.eye(n) - 0.85 * w)
    for least in (1e-2, 1e-4):
        got = g.push_pagerank([0, 7, 11], 0.15, least).collect()
        for s in (0, 7, 11):
            own = {r["id"]: r for r in got if r["source"] == s}
            bound = sum(r["residual"] for r in own.values())
            off = [exact[s, v] - (own[v]["pagerank"] if v in own else 0.0) for v in range(n)]
            assert min(off) > -1e-12 and max(off) <= bound + 1e-12
            assert sum(r["touched"] for r in own.values()) <= 1 / (0.15 * least)
            if least == 1e-4:
                assert max(off) < 0.01
