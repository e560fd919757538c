"""Graph queries (G01-G19, F09) over the graph of customers and their successive orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import r
from ..graph.build import ORDER_GRAPH_SQL as G
from ..graph.build import order_graph
from ..operators import order
from ..operators.rows import fold_conditions
from ..session import stage
from .registry import query


def _with(body: str) -> str:
    """Prefix the graph's CTEs (``body`` may add CTEs after a comma)."""
    return f"WITH {G}\n{body}"


@query("graph_edges", _with("SELECT src, dst, weight, relationship FROM edges"))
def graph_edges(spark, sf):
    return order_graph(spark, sf).edges


@query("graph_in_degree", _with('SELECT dst AS id, count(*) AS "inDegree" FROM edges GROUP BY dst'))
def graph_in_degree(spark, sf):
    return order_graph(spark, sf).in_degrees


@query("graph_out_degree", _with('SELECT src AS id, count(*) AS "outDegree" FROM edges GROUP BY src'))
def graph_out_degree(spark, sf):
    return order_graph(spark, sf).out_degrees


@query("graph_attr", _with("""
SELECT (SELECT min(orders) FROM vertices) AS min_orders,
       (SELECT count(*) FROM edges WHERE relationship = 'follow') AS n_follow"""))
def graph_attr(spark, sf):
    g = order_graph(spark, sf)
    m = g.vertices.groupBy().min("orders").withColumnRenamed("min(orders)", "min_orders")
    n = g.edges.filter("relationship = 'follow'").agg(F.count(F.lit(1)).alias("n_follow"))
    # two one-row aggregates side by side
    return m.withColumn("_k", F.lit(1)).join(n.withColumn("_k", F.lit(1)), "_k").drop("_k")


@query("motif_mutual", _with("""
SELECT e.src AS a_id, e.dst AS b_id FROM edges e JOIN edges e2 ON e.src = e2.dst AND e.dst = e2.src"""))
def motif_mutual(spark, sf):
    m = order_graph(spark, sf).find("(a)-[e]->(b); (b)-[e2]->(a)", use={})
    return m.select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))


@query("motif_two_hop", _with("""
SELECT e1.src AS a_id, e1.dst AS b_id, e2.dst AS c_id
FROM edges e1 JOIN edges e2 ON e1.dst = e2.src WHERE e1.src <> e2.dst"""))
def motif_two_hop(spark, sf):
    m = order_graph(spark, sf).find("(a)-[]->(b); (b)-[]->(c)", use={}).filter("a.id != c.id")
    return m.select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), F.col("c.id").alias("c_id"))


@query("motif_no_return", _with("""
SELECT e.src AS a_id, e.dst AS b_id FROM edges e
WHERE NOT EXISTS (SELECT 1 FROM edges r WHERE r.src = e.dst AND r.dst = e.src)"""))
def motif_no_return(spark, sf):
    m = order_graph(spark, sf).find("(a)-[]->(b); !(b)-[]->(a)", use={})
    return m.select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))


@query("motif_chain_state", _with("""
SELECT ab.src AS a_id, ab.dst AS b_id, bc.dst AS c_id, cd.dst AS d_id
FROM edges ab JOIN edges bc ON ab.dst = bc.src JOIN edges cd ON bc.dst = cd.src
WHERE (CASE WHEN ab.relationship = 'friend' THEN 1 ELSE 0 END)
    + (CASE WHEN bc.relationship = 'friend' THEN 1 ELSE 0 END)
    + (CASE WHEN cd.relationship = 'friend' THEN 1 ELSE 0 END) >= 2"""))
def motif_chain_state(spark, sf):
    m = order_graph(spark, sf).find("(a)-[ab]->(b); (b)-[bc]->(c); (c)-[cd]->(d)",
                                   use={e: ["relationship"] for e in ("ab", "bc", "cd")})
    friends = fold_conditions([F.col(f"{e}.relationship") == "friend" for e in ("ab", "bc", "cd")], "_nf")
    return m.withColumn("_nf", friends).filter("_nf >= 2").select(
        F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), F.col("c.id").alias("c_id"),
        F.col("d.id").alias("d_id"))


@query("motif_triangle", _with("""
SELECT ab.src AS a_id, bc.src AS b_id, ca.src AS c_id, ab.weight + bc.weight + ca.weight AS weight
FROM edges ab JOIN edges bc ON ab.dst = bc.src JOIN edges ca ON ca.src = bc.dst AND ca.dst = ab.src"""))
def motif_triangle(spark, sf):
    m = order_graph(spark, sf).find("(a)-[ab]->(b); (b)-[bc]->(c); (c)-[ca]->(a)", use={e: ["weight"] for e in ("ab", "bc", "ca")})
    return m.select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), F.col("c.id").alias("c_id"),
                    (F.col("ab.weight") + F.col("bc.weight") + F.col("ca.weight")).alias("weight"))


@query("motif_filtered_path", _with("""
SELECT a.id AS a_id, e3.dst AS d_id, d.name AS d_name, count(*) AS ways
FROM vertices a JOIN edges e1 ON a.id = e1.src JOIN edges e2 ON e1.dst = e2.src JOIN edges e3 ON e2.dst = e3.src
JOIN vertices d ON d.id = e3.dst
WHERE a.orders >= 18 AND e2.relationship = 'friend' AND d.region = 2 GROUP BY 1, 2, 3"""))
def motif_filtered_path(spark, sf):
    m = order_graph(spark, sf).find("(b)-[e]->(c); (a)-[]->(b); (c)-[]->(d)",
                                    where={"a": "orders >= 18", "e": "relationship = 'friend'", "d": "region = 2"}, use={"d": ["name"]})
    return m.groupBy(F.col("a.id").alias("a_id"), F.col("d.id").alias("d_id"), F.col("d.name").alias("d_name")).agg(
        F.count(F.lit(1)).alias("ways"))


@query("motif_younger", _with("""
SELECT e.src AS a_id, e.dst AS b_id FROM edges e JOIN vertices a ON a.id = e.src JOIN vertices b ON b.id = e.dst
WHERE a.orders < b.orders"""))
def motif_younger(spark, sf):
    m = order_graph(spark, sf).find("(a)-[e]->(b)", use={"a": ["orders"], "b": ["orders"]}).filter("a.orders < b.orders")
    return m.select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))


@query("subgraph_filter", _with("""
SELECT v.id, (SELECT count(*) FROM edges e JOIN vertices d ON d.id = e.dst
              WHERE e.src = v.id AND e.relationship = 'follow' AND d.region < 3) AS out_degree
FROM vertices v
WHERE v.region < 3 AND EXISTS (
  SELECT 1 FROM edges e JOIN vertices s ON s.id = e.src JOIN vertices d ON d.id = e.dst
  WHERE e.relationship = 'follow' AND s.region < 3 AND d.region < 3 AND (e.src = v.id OR e.dst = v.id))"""))
def subgraph_filter(spark, sf):
    g = (order_graph(spark, sf).filter_vertices("region < 3").filter_edges("relationship = 'follow'")
         .drop_isolated_vertices())
    out = g.out_degrees
    return g.vertices.join(out, "id", "left").select(
        "id", F.coalesce("outDegree", F.lit(0)).alias("out_degree"))


@query("subgraph_motif", _with("""
SELECT e.src, e.dst, e.relationship FROM edges e JOIN vertices a ON a.id = e.src JOIN vertices b ON b.id = e.dst
WHERE a.orders < b.orders AND e.relationship = 'follow'"""))
def subgraph_motif(spark, sf):
    m = order_graph(spark, sf).find("(a)-[e]->(b)") \
        .filter("a.orders < b.orders AND e.relationship = 'follow'")
    return m.select("e.*").select("src", "dst", "relationship")


BFS_FROM, BFS_TO = "id = 1", "orders >= 20"


@query("graph_bfs", f"""
WITH RECURSIVE {G},
lvl(v, d) AS (
  SELECT id, 0 FROM vertices WHERE {BFS_FROM}
  UNION SELECT e.dst, l.d + 1 FROM lvl l JOIN edges e ON e.src = l.v WHERE l.d < 10),
dist AS (SELECT v, min(d) AS d FROM lvl GROUP BY v),
goal AS (SELECT min(d) AS d FROM dist JOIN vertices ON id = v WHERE {BFS_TO}),
walk(cur, hops, path) AS (
  SELECT v, 0, CAST(v AS VARCHAR) FROM dist WHERE d = 0
  UNION ALL
  SELECT e.dst, w.hops + 1, w.path || '>' || CAST(e.dst AS VARCHAR)
  FROM walk w JOIN edges e ON e.src = w.cur JOIN dist x ON x.v = e.dst AND x.d = w.hops + 1
  WHERE w.hops < (SELECT d FROM goal))
SELECT (SELECT id FROM vertices WHERE {BFS_FROM}) AS from_id, cur AS to_id, hops, path
FROM walk JOIN vertices ON id = cur WHERE hops = (SELECT d FROM goal) AND {BFS_TO}""")
def graph_bfs(spark, sf):
    p = order_graph(spark, sf).bfs(BFS_FROM, BFS_TO, max_path_length=10)
    hops = len([c for c in p.columns if c.startswith("e")])
    ids = [F.col("from.id")] + [F.col(f"v{i}.id") for i in range(1, hops)] + ([F.col("to.id")] if hops else [])
    return p.select(F.col("from.id").alias("from_id"), F.col("to.id").alias("to_id"),
                    F.lit(hops).alias("hops"), F.concat_ws(">", *[c.cast("string") for c in ids]).alias("path"))


@query("graph_cc", f"""
WITH RECURSIVE {G},
und AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
reach(v, w) AS (SELECT id, id FROM vertices UNION SELECT r.v, u.b FROM reach r JOIN und u ON r.w = u.a)
SELECT v AS id, min(w) AS component FROM reach GROUP BY v""")
def graph_cc(spark, sf):
    return order_graph(spark, sf).connected_components().select("id", "component")


@query("graph_scc", f"""
WITH RECURSIVE {G},
dreach(v, w) AS (SELECT id, id FROM vertices UNION SELECT r.v, e.dst FROM dreach r JOIN edges e ON r.w = e.src)
SELECT x.v AS id, min(x.w) AS component FROM dreach x JOIN dreach y ON x.v = y.w AND x.w = y.v GROUP BY x.v""")
def graph_scc(spark, sf):
    return order_graph(spark, sf).strongly_connected_components().select("id", "component")


def _lpa_sql(iters: int = 5) -> str:
    parts = ["und AS (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges)",
             "l0 AS (SELECT id, id AS label FROM vertices)"]
    for k in range(1, iters + 1):
        parts.append(
            f"m{k} AS (SELECT u.dst AS id, l.label, count(*) AS n FROM und u JOIN l{k - 1} l ON l.id = u.src "
            f"GROUP BY 1, 2)")
        parts.append(
            f"b{k} AS (SELECT id, label FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, label) "
            f"AS rn FROM m{k}) WHERE rn = 1)")
        parts.append(
            f"l{k} AS MATERIALIZED (SELECT l.id, coalesce(b.label, l.label) AS label FROM l{k - 1} l LEFT JOIN b{k} b USING (id))")
    return f"WITH {G},\n" + ",\n".join(parts) + f"\nSELECT id, label FROM l{iters}"


@query("graph_lpa", _lpa_sql())
def graph_lpa(spark, sf):
    return order_graph(spark, sf).label_propagation(max_iter=5).select("id", "label")


def _pagerank_sql(iters: int = 10, reset: float = 0.15) -> str:
    parts = [
        "we AS (SELECT e.src, e.dst, CAST(1.0 AS DOUBLE) / o.outdeg AS weight FROM edges e "
        "JOIN (SELECT src, count(*) AS outdeg FROM edges GROUP BY src) o USING (src))",
        "r0 AS (SELECT id, CAST(1.0 AS DOUBLE) AS rank FROM vertices)"]
    for k in range(1, iters + 1):
        parts.append(
            f"r{k} AS MATERIALIZED (SELECT v.id, {reset} + {1 - reset} * coalesce(c.s, 0) AS rank FROM vertices v LEFT JOIN "
            f"(SELECT we.dst, sum(p.rank * we.weight) AS s FROM r{k - 1} p JOIN we ON we.src = p.id "
            f"GROUP BY we.dst) c ON c.dst = v.id)")
    body = ",\n".join(parts)
    return (f"WITH {G},\n{body}\nSELECT id, round(rank * (SELECT count(*) FROM vertices) / "
            f"(SELECT sum(rank) FROM r{iters}), 6) AS pagerank FROM r{iters}")


@query("graph_pagerank", _pagerank_sql())
def graph_pagerank(spark, sf):
    pr = order_graph(spark, sf).pagerank(0.15, max_iter=10)
    return pr.select("id", r("pagerank", 6).alias("pagerank"))


def _pagerank_tol_sql(tol: float, most: int = 30, reset: float = 0.15) -> str:
    """Rounds unrolled up to ``most``; the first whose largest change is below ``tol`` is the result."""
    inner = _pagerank_sql(most, reset)
    ctes = inner[:inner.rindex("\nSELECT id, round(rank")]
    moved = ",\n".join(f"d{k} AS (SELECT {k} AS k, max(abs(a.rank - b.rank)) AS d FROM r{k} a JOIN r{k - 1} b USING (id))"
                       for k in range(1, most + 1))
    moves = " UNION ALL ".join(f"SELECT * FROM d{k}" for k in range(1, most + 1))
    ranks = " UNION ALL ".join(f"SELECT {k} AS k, id, rank FROM r{k}" for k in range(1, most + 1))
    return (f"{ctes},\n{moved},\nstop AS (SELECT min(k) AS k FROM ({moves}) WHERE d < {tol}),\n"
            f"last AS (SELECT id, rank FROM ({ranks}) WHERE k = (SELECT k FROM stop))\n"
            f"SELECT id, round(rank * (SELECT count(*) FROM vertices) / (SELECT sum(rank) FROM last), 6) AS pagerank FROM last")


@query("graph_pagerank_tol", _pagerank_tol_sql(0.05))
def graph_pagerank_tol(spark, sf):
    pr = order_graph(spark, sf).pagerank(0.15, max_iter=None, tol=0.05)
    return pr.select("id", r("pagerank", 6).alias("pagerank"))


PPR_SOURCES = [0, 1]


def _ppr_sql(iters: int = 10, reset: float = 0.15) -> str:
    srcs = ", ".join(str(s) for s in PPR_SOURCES)
    parts = [
        "we AS (SELECT e.src, e.dst, CAST(1.0 AS DOUBLE) / o.outdeg AS weight FROM edges e "
        "JOIN (SELECT src, count(*) AS outdeg FROM edges GROUP BY src) o USING (src))",
        f"seeds AS (SELECT id AS source, id FROM vertices WHERE id IN ({srcs}))",
        "p0 AS (SELECT source, id, CAST(1.0 AS DOUBLE) AS rank FROM seeds)"]
    for k in range(1, iters + 1):
        parts.append(
            f"p{k} AS MATERIALIZED (SELECT coalesce(c.source, s.source) AS source, coalesce(c.id, s.id) AS id, "
            f"coalesce(s.r, 0) + {1 - reset} * coalesce(c.s, 0) AS rank "
            f"FROM (SELECT source, id, {reset} AS r FROM seeds) s FULL JOIN "
            f"(SELECT p.source, we.dst AS id, sum(p.rank * we.weight) AS s FROM p{k - 1} p JOIN we "
            f"ON we.src = p.id GROUP BY 1, 2) c ON s.source = c.source AND s.id = c.id)")
    body = ",\n".join(parts)
    return (f"WITH {G},\n{body}\nSELECT source, id, "
            f"round(rank / sum(rank) OVER (PARTITION BY source), 6) AS pagerank FROM p{iters}")


@query("graph_ppr", _ppr_sql())
def graph_ppr(spark, sf):
    pr = order_graph(spark, sf).personalized_pagerank(PPR_SOURCES, 0.15, max_iter=10)
    return pr.select("source", "id", r("pagerank", 6).alias("pagerank"))


PUSH_SOURCES, PUSH_LEAST = list(range(1, 101)), 1e-4


@query("graph_ppr_push", _with(f"""
SELECT id AS source, true AS certified, true AS bounded FROM vertices WHERE id IN ({", ".join(map(str, PUSH_SOURCES))})"""))
def graph_ppr_push(spark, sf):
    """For each of a hundred sources: whether what is missing at every vertex, by the equation that PageRank solves, is the residual
    that the push reports, and whether no vertex could still send and the edges touched are within the bound."""
    g = order_graph(spark, sf)
    got = stage(g.push_pagerank(PUSH_SOURCES, 0.15, PUSH_LEAST), "push")
    we = g.edges.join(g.out_degrees.withColumnRenamed("id", "src"), "src").select("src", "dst", (1 / F.col("outDegree")).alias("w"))
    into = (got.select("source", F.col("id").alias("src"), "pagerank").join(we, "src")
            .groupBy("source", F.col("dst").alias("id")).agg(F.sum(F.col("pagerank") * F.col("w")).alias("flow")))
    both = got.join(into, ["source", "id"], "full").join(g.out_degrees, "id", "left")
    p, flow = F.coalesce("pagerank", F.lit(0.0)), F.coalesce("flow", F.lit(0.0))
    missing = F.when(F.col("id") == F.col("source"), 1.0).otherwise(0.0) - (p - 0.85 * flow) / 0.15
    residual = F.coalesce("residual", F.lit(0.0))
    return both.groupBy("source").agg(
        (F.max(F.abs(missing - residual)) < 1e-9).alias("certified"),
        ((F.max(residual / F.greatest(F.coalesce("outDegree", F.lit(1)), F.lit(1))) <= PUSH_LEAST) & (F.sum("touched") <= 1 / (0.15 * PUSH_LEAST))).alias("bounded"))


LANDMARKS = [0, 1]


@query("graph_shortest_paths", f"""
WITH RECURSIVE {G},
sp(lm, v, d) AS (
  SELECT id, id, 0 FROM vertices WHERE id IN ({", ".join(map(str, LANDMARKS))})
  UNION
  SELECT s.lm, e.src, s.d + 1 FROM sp s JOIN edges e ON e.dst = s.v WHERE s.d < 40),
dist AS (SELECT lm, v, min(d) AS d FROM sp GROUP BY lm, v)
SELECT id, coalesce((SELECT string_agg(CAST(lm AS VARCHAR) || '=' || CAST(d AS VARCHAR), ',' ORDER BY lm)
                     FROM dist WHERE v = id), '') AS distances
FROM vertices""")
def graph_shortest_paths(spark, sf):
    sp = order_graph(spark, sf).shortest_paths(LANDMARKS)
    return sp.select("id", order.map_text("distances").alias("distances"))


@query("graph_triangles", _with("""
, ue AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges WHERE src <> dst),
tri AS (SELECT x.a, x.b, y.b AS c FROM ue x JOIN ue y ON x.b = y.a JOIN ue z ON z.a = x.a AND z.b = y.b),
per AS (SELECT v, count(*) AS n FROM (SELECT a AS v FROM tri UNION ALL SELECT b FROM tri UNION ALL
                                      SELECT c FROM tri) GROUP BY v)
SELECT id, coalesce(n, 0) AS count FROM vertices LEFT JOIN per ON v = id"""))
def graph_triangles(spark, sf):
    return order_graph(spark, sf).triangle_count().select("id", "count")


@query("graph_messages", _with("""
SELECT id, sum(msg) AS msg FROM (
  SELECT e.src AS id, d.orders AS msg FROM edges e JOIN vertices d ON d.id = e.dst
  UNION ALL
  SELECT e.dst AS id, s.orders AS msg FROM edges e JOIN vertices s ON s.id = e.src) GROUP BY id"""))
def graph_messages(spark, sf):
    g = order_graph(spark, sf)
    return g.aggregate_messages(F.sum, to_src=F.col("dst.orders"), to_dst=F.col("src.orders"))
