"""Property graphs on plain DataFrames.

A graph is a pair of DataFrames: ``vertices`` (``id`` + attributes) and
``edges`` (``src``, ``dst`` + attributes).  Every algorithm is a sequence of
joins and aggregations.  Iterative algorithms run until nothing changes any
more (or raise at a limit that the caller set).  They test that with one small
count per round and cut their lineage with a reliable ``checkpoint()`` to the
shared ``spark.checkpoint.dir``: in every round that runs an action, else
every few rounds.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import chains, motif

CHECKPOINT_EVERY = 4


def _materialize(df: DataFrame) -> DataFrame:
    """Write an algorithm's input once (reliable checkpoint) so that rounds
    read it back instead of re-deriving it from the source tables."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _cut(df: DataFrame, i: int, every: int = CHECKPOINT_EVERY) -> DataFrame:
    """Truncate lineage every ``every`` rounds (reliable checkpoint)."""
    if i % every == every - 1:
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df


@dataclass(frozen=True)
class Graph:
    vertices: DataFrame
    edges: DataFrame

    # --- persistence (S21, K12) -------------------------------------------------
    def save(self, path: str, mode: str = "error") -> None:
        self.vertices.write.mode(mode).parquet(f"{path}/vertices")
        self.edges.write.mode(mode).parquet(f"{path}/edges")

    @staticmethod
    def load(spark, path: str) -> Graph:
        return Graph(spark.read.parquet(f"{path}/vertices"), spark.read.parquet(f"{path}/edges"))

    # --- degrees and sub-graphs (G02, G03, G09) ------------------------------------
    @property
    def in_degrees(self) -> DataFrame:
        return self.edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("inDegree"))

    @property
    def out_degrees(self) -> DataFrame:
        return self.edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("outDegree"))

    @property
    def degrees(self) -> DataFrame:
        both = self.edges.select(F.col("src").alias("id")).unionAll(self.edges.select(F.col("dst").alias("id")))
        return both.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))

    def filter_vertices(self, cond: str | Column) -> Graph:
        """Keep matching vertices and the edges between kept vertices."""
        v = self.vertices.filter(cond)
        ids = v.select("id")
        e = (self.edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
             .join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi"))
        return Graph(v, e.select(*self.edges.columns))

    def filter_edges(self, cond: str | Column) -> Graph:
        return Graph(self.vertices, self.edges.filter(cond))

    def drop_isolated_vertices(self) -> Graph:
        ends = self.edges.select(F.col("src").alias("id")).union(self.edges.select(F.col("dst").alias("id")))
        return Graph(self.vertices.join(ends.distinct(), "id", "left_semi"), self.edges)

    # --- motifs (G05-G08, G10) -------------------------------------------------------
    def find(self, pattern: str, where: dict[str, str] | None = None, use: dict[str, list[str]] | None = None) -> DataFrame:
        """Motif search, e.g. ``"(x)-[p]->(y); !(y)-[]->(x)"``.

        Named vertices/edges become struct columns; ``()``/``[]`` are
        anonymous; a term prefixed with ``!`` must not match (anti join).
        ``where`` filters names before any join, ``use`` names the
        attributes wanted of each (all, if not given); see ``motif.find``.
        """
        return motif.find(self, pattern, where, use)

    # --- traversal (G11, G17) ----------------------------------------------------------
    def bfs(self, from_expr: str | Column, to_expr: str | Column, edge_filter: str | Column | None = None,
            max_path_length: int = 10) -> DataFrame:
        """All shortest paths from any ``from`` vertex to any ``to`` vertex.

        Columns ``from, e0, v1, e1, ..., to`` (structs), like a motif.  The
        search stops at the first length with a hit.  Extensions into a
        vertex already reached from the same start are pruned (they cannot
        lie on a shortest path), so the frontier is bounded by
        |starts| x |vertices| states plus the shortest paths themselves.
        """
        edges = self.edges.filter(edge_filter) if edge_filter is not None else self.edges
        vcols, ecols = self.vertices.columns, edges.columns
        vstruct = self.vertices.select(F.col("id").alias("_vid"), F.struct(*vcols).alias("_v"))
        targets = self.vertices.filter(to_expr).select(F.col("id").alias("_tid"))
        starts = self.vertices.filter(from_expr)
        hit0 = starts.join(targets, starts.id == targets._tid, "left_semi")
        if hit0.limit(1).count() > 0:
            return hit0.select(F.struct(*vcols).alias("from"), F.struct(*vcols).alias("to"))
        paths = starts.select(F.struct(*vcols).alias("from"), F.col("id").alias("_start"), F.col("id").alias("_cur"))
        visited = starts.select(F.col("id").alias("_start"), F.col("id").alias("_seen"))
        es = _materialize(edges.select(F.col("src").alias("_src"), F.col("dst").alias("_dst"),
                                       F.struct(*ecols).alias("_e")))
        for k in range(max_path_length):
            step = paths.join(es, paths._cur == es._src).drop("_src")
            step = step.join(visited, (step._start == visited._start) & (step._dst == visited._seen),
                             "left_anti")
            step = _materialize(step.withColumnRenamed("_e", f"e{k}"))  # what follows reads the round's one evaluation
            done = _materialize(step.join(targets, step._dst == targets._tid, "left_semi"))
            if done.limit(1).count() > 0:
                res = done.join(vstruct, done._dst == vstruct._vid).withColumnRenamed("_v", "to")
                return res.drop("_start", "_cur", "_dst", "_vid")
            if step.limit(1).count() == 0:
                break
            paths = step.join(vstruct, step._dst == vstruct._vid).withColumnRenamed("_v", f"v{k + 1}") \
                .drop("_cur", "_vid").withColumnRenamed("_dst", "_cur")
            visited = _materialize(visited.unionByName(step.select("_start", F.col("_dst").alias("_seen"))).distinct())
        none = self.vertices.limit(0)
        return none.select(F.struct(*vcols).alias("from"), F.struct(*vcols).alias("to"))

    def shortest_paths(self, landmarks: list) -> DataFrame:
        """Hops from every vertex to each landmark along edge direction;
        ``distances`` is a map landmark -> hops (unreachable landmarks absent)."""
        lm = self.vertices.filter(F.col("id").isin(landmarks)).select(
            F.col("id").alias("_lm"), F.col("id").alias("_v"), F.lit(0).alias("_d"))
        known = lm
        frontier = lm
        rev = _materialize(self.edges.select(F.col("dst").alias("_v"), F.col("src").alias("_nv")).distinct())
        i = 0
        while True:
            nxt = (frontier.join(rev, "_v").select("_lm", F.col("_nv").alias("_v"), (F.col("_d") + 1).alias("_d"))
                   .join(known.select("_lm", "_v"), ["_lm", "_v"], "left_anti")
                   .groupBy("_lm", "_v").agg(F.min("_d").alias("_d")))
            nxt = _cut(nxt, 0, 1)
            if nxt.limit(1).count() == 0:
                break
            known = _cut(known.unionByName(nxt), i)
            frontier, i = nxt, i + 1
        dist = known.groupBy(F.col("_v").alias("id")).agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("_lm", "_d")))).alias("distances"))
        id_type = self.vertices.schema["id"].dataType.simpleString()
        empty = F.map_from_arrays(F.array().cast(f"array<{id_type}>"), F.array().cast("array<int>"))
        return self.vertices.join(dist, "id", "left").withColumn("distances", F.coalesce("distances", empty))

    # --- components (G12-G14) -----------------------------------------------------------
    def _undirected(self) -> DataFrame:
        e = self.edges.select("src", "dst")
        return e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) \
                .filter(F.col("src") != F.col("dst")).distinct()

    def connected_components(self, method: str = "star") -> DataFrame:
        """Weakly connected components; ``component`` = smallest vertex id.

        ``method="star"`` (default) alternates the large-star and small-star
        edge rewrites of Kiveris et al. (2014) until the edge set stops
        changing; the number of rounds grows with log(n), not with the graph
        diameter.  ``method="propagate"`` is plain min-label propagation.
        Both use only joins and two-phase min aggregates, so a hub vertex
        costs one partial row per task.
        """
        if method == "propagate":
            return self._components_by_propagation()
        und = self._undirected()
        # undirected edges stored once as (hi, lo) with hi > lo
        edges = _materialize(und.filter(F.col("src") > F.col("dst"))
                             .select(F.col("src").alias("hi"), F.col("dst").alias("lo")))
        before = None
        while before != (now := self._signature(edges)):
            before = now
            edges = _materialize(self._small_star(self._large_star(edges)))
        # at the fixed point every component is a star around its minimum
        comp = edges.groupBy(F.col("hi").alias("id")).agg(F.min("lo").alias("_c"))
        return self.vertices.join(comp, "id", "left") \
            .withColumn("component", F.coalesce("_c", "id")).drop("_c")

    @staticmethod
    def _signature(edges: DataFrame) -> tuple:
        """Number of edges and two sums over their hashes: equal for equal edge sets."""
        return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")),
                               F.bit_xor(F.xxhash64("lo", "hi", F.lit(1)))).first())

    @staticmethod
    def _large_star(edges: DataFrame) -> DataFrame:
        """Connect every larger neighbour of ``u`` to min(u, N(u))."""
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("_m")).withColumn("_m", F.least("u", "_m"))
        return (both.filter(F.col("v") > F.col("u")).join(m, "u")
                .select(F.col("v").alias("hi"), F.col("_m").alias("lo")).distinct())

    @staticmethod
    def _small_star(edges: DataFrame) -> DataFrame:
        """Connect ``u`` and its smaller neighbours to the smallest of them."""
        m = edges.groupBy("hi").agg(F.min("lo").alias("_m"))
        j = edges.join(m, "hi")
        moved = j.filter(F.col("lo") != F.col("_m")).select(F.col("lo").alias("hi"), F.col("_m").alias("lo"))
        return moved.union(m.select("hi", F.col("_m").alias("lo"))).distinct()

    def _components_by_propagation(self) -> DataFrame:
        und = _materialize(self._undirected())
        labels = _materialize(self.vertices.select("id", F.col("id").alias("component")))
        while True:
            cand = (und.join(labels.withColumnRenamed("id", "src"), "src")
                    .groupBy(F.col("dst").alias("id")).agg(F.min("component").alias("_c")))
            new = (labels.join(cand, "id", "left")
                   .select("id", F.least("component", F.coalesce("_c", "component")).alias("component")))
            new = _materialize(new)
            changed = new.join(labels.withColumnRenamed("component", "_old"), "id") \
                .filter(F.col("component") != F.col("_old")).limit(1).count()
            labels = new
            if changed == 0:
                break
        return self.vertices.join(labels, "id")

    def strongly_connected_components(self) -> DataFrame:
        """Strongly connected components; ``component`` is the smallest vertex id of each.

        The graph is first shrunk by peeling and by contracting chains (see
        ``chains``), in turns, as long as that takes away a tenth of it.
        What is left is coloured forward with the smallest id that reaches
        a vertex, and swept backward from each colour's root; both loops
        run to their end.  Contracted chains are resolved last.
        """
        remaining = _materialize(self.vertices.select("id"))
        edges = _materialize(self.edges.select("src", "dst").filter(F.col("src") != F.col("dst")).distinct())
        found = [_materialize(self.vertices.select("id", F.col("id").alias("component")).limit(0))]
        contracted: list[DataFrame] = []
        while True:
            size = remaining.count()
            while size:  # shrink
                alone, remaining, edges = chains.peel(remaining, edges, _materialize)
                cycles, some, edges, _ = chains.contract(edges, _materialize)
                found += [alone.select("id", F.col("id").alias("component")), cycles]
                contracted.append(some)
                remaining = _materialize(remaining.join(cycles, "id", "left_anti").join(some, "id", "left_anti"))
                before, size = size, remaining.count()
                if size > 0.9 * before:
                    break
            if not size:
                break
            color = remaining.select("id", F.col("id").alias("color"))
            while True:  # forward: colour = min id that reaches v
                cand = (edges.join(color.withColumnRenamed("id", "src"), "src")
                        .groupBy(F.col("dst").alias("id")).agg(F.min("color").alias("_c")))
                new = _materialize(color.join(cand, "id", "left").select(
                    "id", F.least("color", F.coalesce("_c", "color")).alias("color"),
                    (F.coalesce("_c", "color") < F.col("color")).alias("_moved")))
                changed = new.filter("_moved").limit(1).count()
                color = new.drop("_moved")
                if changed == 0:
                    break
            # backward: members of root r's colour class that reach r
            members = frontier = _materialize(color.filter(F.col("id") == F.col("color")))
            ce = _materialize(
                edges.join(color.select(F.col("id").alias("src"), F.col("color").alias("_cs")), "src")
                .join(color.select(F.col("id").alias("dst"), F.col("color").alias("_cd")), "dst")
                .filter(F.col("_cs") == F.col("_cd")).select("src", "dst", F.col("_cs").alias("color")))
            while True:
                frontier = _materialize(
                    frontier.withColumnRenamed("id", "dst").join(ce, ["dst", "color"])
                    .select(F.col("src").alias("id"), "color").distinct()
                    .join(members.select("id"), "id", "left_anti"))
                if frontier.limit(1).count() == 0:
                    break
                members = _materialize(members.unionByName(frontier))
            found.append(members.select("id", F.col("color").alias("component")))
            remaining = _materialize(remaining.join(members, "id", "left_anti"))
            edges = _materialize(self._between(edges, remaining))
        done = _materialize(reduce(DataFrame.unionByName, found))
        for some in reversed(contracted):  # the ends of a chain were found after it was taken away
            done = _materialize(done.unionByName(chains.resolve(done, some)))
        least = done.groupBy("component").agg(F.min("id").alias("_least"))
        return self.vertices.join(done.join(least, "component").select("id", F.col("_least").alias("component")), "id")

    @staticmethod
    def _between(edges: DataFrame, ids: DataFrame) -> DataFrame:
        """Edges whose both ends are in ``ids``."""
        return (edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
                .join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst"))

    def label_propagation(self, max_iter: int = 5) -> DataFrame:
        """Synchronous LPA over both edge directions: every vertex takes the
        most frequent neighbour label (ties: smallest label); vertices
        without neighbours keep their own."""
        und = _materialize(self.edges.select("src", "dst").union(
            self.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))))
        labels = _materialize(self.vertices.select("id", F.col("id").alias("label")))
        for i in range(max_iter):
            msgs = und.join(labels.withColumnRenamed("id", "src"), "src") \
                .groupBy(F.col("dst").alias("id"), "label").agg(F.count(F.lit(1)).alias("_n"))
            # most frequent label, ties to the smallest: min over (-count, label),
            # an aggregate with a partial stage, so a hub vertex is not one task
            best = msgs.groupBy("id").agg(
                F.min(F.struct((-F.col("_n")).alias("k"), F.col("label").alias("l"))).alias("_b")) \
                .select("id", F.col("_b.l").alias("_best"))
            labels = labels.join(best, "id", "left").select(
                "id", F.coalesce("_best", "label").alias("label"))
            labels = _cut(labels, i)
        return self.vertices.join(labels, "id")

    # --- ranking (G15, G16) ----------------------------------------------------------------
    def _weighted_edges(self) -> DataFrame:
        out = self.out_degrees
        return self.edges.select("src", "dst").join(out.withColumnRenamed("id", "src"), "src") \
            .select("src", "dst", (F.lit(1.0) / F.col("outDegree")).alias("weight"))

    def pagerank(self, reset_probability: float = 0.15, max_iter: int | None = 10,
                 tol: float | None = None) -> DataFrame:
        """PageRank: start 1.0; rank = reset + (1-reset) * sum(rank_u / outdeg_u);
        ranks are finally scaled to sum to the vertex count (mass lost at
        sinks is restored).  With ``tol`` it runs until the largest change is
        below it, and raises if that takes more than ``max_iter`` rounds
        (no limit if that is None); else it runs ``max_iter`` rounds."""
        if tol is None and max_iter is None:
            raise ValueError("give max_iter or tol")
        # dealt by source once; every round joins the ranks to it
        we = _materialize(self._weighted_edges().repartition("src"))
        base = _materialize(self.vertices.select("id"))
        ranks = base.withColumn("rank", F.lit(1.0))
        i = 0
        while True:
            contrib = (we.join(ranks.withColumnRenamed("id", "src"), "src")
                       .groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("weight")).alias("_s")))
            new = base.join(contrib, "id", "left").select(
                "id", (F.lit(reset_probability) + F.lit(1 - reset_probability) * F.coalesce("_s", F.lit(0.0))).alias("rank"))
            i += 1
            if tol is None:
                ranks = _cut(new, i - 1)
                if i >= max_iter:
                    break
                continue
            new = _materialize(new)
            delta = new.join(ranks.withColumnRenamed("rank", "_o"), "id") \
                .agg(F.max(F.abs(F.col("rank") - F.col("_o")))).first()[0]
            ranks = new
            if delta is None or delta < tol:
                break
            if max_iter is not None and i >= max_iter:
                raise RuntimeError(f"PageRank still changes by {delta} after {i} rounds; the tolerance is {tol}")
        ranks = _materialize(ranks)
        n, total = ranks.agg(F.count(F.lit(1)), F.sum("rank")).first()
        return self.vertices.join(ranks.select("id", (F.col("rank") * F.lit(n / total if total else 1.0)).alias("pagerank")), "id")

    def personalized_pagerank(self, source_ids: list, reset_probability: float = 0.15,
                              max_iter: int = 10) -> DataFrame:
        """One PageRank per source (``source`` column): restarts jump to the
        source only; each source's ranks are scaled to sum to 1.  A vector
        only holds the vertices that it reaches (absent = 0)."""
        we = _materialize(self._weighted_edges().repartition("src"))
        seeds = self.vertices.filter(F.col("id").isin(source_ids)).select(F.col("id").alias("source"), "id")
        ranks = seeds.withColumn("rank", F.lit(1.0))
        restart = seeds.withColumn("_r", F.lit(reset_probability))
        for i in range(max_iter):
            contrib = (we.join(ranks.withColumnRenamed("id", "src"), "src")
                       .groupBy("source", F.col("dst").alias("id"))
                       .agg(F.sum(F.col("rank") * F.col("weight")).alias("_s")))
            ranks = _cut(restart.join(contrib, ["source", "id"], "full").select(
                "source", "id", (F.coalesce("_r", F.lit(0.0)) + F.lit(1 - reset_probability)
                                 * F.coalesce("_s", F.lit(0.0))).alias("rank")), i)
        total = ranks.groupBy("source").agg(F.sum("rank").alias("_t"))
        return ranks.join(total, "source").select("source", "id", (F.col("rank") / F.col("_t")).alias("pagerank"))

    def push_pagerank(self, sources: list, reset_probability: float = 0.15, least: float = 1e-4) -> DataFrame:
        """Personalised PageRank of many sources by forward push: rows (source, id, pagerank, residual, touched).

        Every source starts with a residual of one.  A vertex with more residual than ``least`` for each of its out-edges
        keeps the reset share of it and sends the rest along them, in rounds for all sources at once; the others do
        nothing, so the work for a source is bounded by 1 / (``reset_probability`` * ``least``) edges, whatever
        the size of the graph.  ``pagerank`` is a lower bound of the fixed point of "reset share of the source plus the rest along
        the edges" (not scaled; mass that reaches a vertex without out-edges stays there), and no value is off by more
        than the sum of the source's residuals.  ``touched`` counts the edges that a vertex has sent along.
        """
        keep = F.lit(reset_probability)
        we = _materialize(self._weighted_edges().select("src", "dst", "weight").repartition("src"))
        degree = _materialize(we.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("_n")))
        state = (self.vertices.filter(F.col("id").isin(sources))
                 .select(F.col("id").alias("source"), "id", F.lit(0.0).alias("pagerank"), F.lit(1.0).alias("residual"), F.lit(0).cast("long").alias("touched")))
        i = 0
        while True:
            at = state.join(degree, "id", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
            at = at.withColumn("_on", F.col("residual") > least * F.greatest("_n", F.lit(1)))
            if i % CHECKPOINT_EVERY == 0:
                at = _materialize(at)
                if at.filter("_on").limit(1).count() == 0:
                    return at.select("source", "id", "pagerank", "residual", "touched")
            sent = (at.filter("_on").select("source", F.col("id").alias("src"), "residual").join(we, "src")
                    .groupBy("source", F.col("dst").alias("id")).agg(F.sum((1 - keep) * F.col("residual") * F.col("weight")).alias("_got")))
            kept = at.select("source", "id", (F.col("pagerank") + F.when(F.col("_on"), keep * F.col("residual")).otherwise(0.0)).alias("pagerank"),
                             F.when(F.col("_on"), 0.0).otherwise(F.col("residual")).alias("residual"),
                             (F.col("touched") + F.when(F.col("_on"), F.col("_n")).otherwise(0)).alias("touched"))
            state = kept.join(sent, ["source", "id"], "full").select(
                "source", "id", F.coalesce("pagerank", F.lit(0.0)).alias("pagerank"),
                (F.coalesce("residual", F.lit(0.0)) + F.coalesce("_got", F.lit(0.0))).alias("residual"), F.coalesce("touched", F.lit(0)).alias("touched"))
            i += 1

    # --- local structure (G18, G19) --------------------------------------------------------
    def triangle_count(self) -> DataFrame:
        """Triangles through each vertex of the undirected simple graph.

        Edges are oriented from the lower to the higher (degree, id) rank,
        so every vertex has at most O(sqrt(m)) out-neighbours and wedge
        enumeration is bounded by O(m^1.5) instead of O(max_degree^2).
        """
        und = self._undirected().filter(F.col("src") < F.col("dst"))
        deg = und.select(F.col("src").alias("id")).union(und.select(F.col("dst").alias("id"))) \
            .groupBy("id").agg(F.count(F.lit(1)).alias("d"))
        ranked = (und.join(deg.withColumnRenamed("id", "src").withColumnRenamed("d", "ds"), "src")
                  .join(deg.withColumnRenamed("id", "dst").withColumnRenamed("d", "dd"), "dst"))
        lower = (F.col("ds") < F.col("dd")) | ((F.col("ds") == F.col("dd")) & (F.col("src") < F.col("dst")))
        o = ranked.select(F.when(lower, F.col("src")).otherwise(F.col("dst")).alias("a"),
                          F.when(lower, F.col("dst")).otherwise(F.col("src")).alias("b"),
                          F.when(lower, F.col("ds")).otherwise(F.col("dd")).alias("da"),
                          F.when(lower, F.col("dd")).otherwise(F.col("ds")).alias("db"))
        o = _cut(o, 0, 1)
        o1 = o.select("a", F.col("b").alias("x"), F.col("db").alias("dx"))
        o2 = o.select("a", F.col("b").alias("y"), F.col("db").alias("dy"))
        rank_lt = (F.col("dx") < F.col("dy")) | ((F.col("dx") == F.col("dy")) & (F.col("x") < F.col("y")))
        wedges = o1.join(o2, "a").filter(rank_lt)
        closing = o.select(F.col("a").alias("x"), F.col("b").alias("y"))
        tri = wedges.join(closing, ["x", "y"]).select("a", "x", "y")
        per = tri.select(F.explode(F.array("a", "x", "y")).alias("id")).groupBy("id") \
            .agg(F.count(F.lit(1)).alias("count"))
        return self.vertices.join(per, "id", "left").withColumn("count", F.coalesce("count", F.lit(0)))

    def aggregate_messages(self, agg, to_src: Column | None = None, to_dst: Column | None = None) -> DataFrame:
        """Send a message along each edge to its source and/or destination
        and aggregate per receiving vertex.  Message expressions may use
        ``src.*``, ``dst.*`` and ``edge.*`` columns; ``agg`` receives the
        column ``msg``.  Only vertices that received a message appear.
        """
        vs = self.vertices
        trip = (self.edges.select(F.struct(*self.edges.columns).alias("edge"))
                .join(vs.select(F.struct(*vs.columns).alias("src")), F.col("src.id") == F.col("edge.src"))
                .join(vs.select(F.struct(*vs.columns).alias("dst")), F.col("dst.id") == F.col("edge.dst")))
        parts = []
        if to_src is not None:
            parts.append(trip.select(F.col("src.id").alias("id"), to_src.alias("msg")))
        if to_dst is not None:
            parts.append(trip.select(F.col("dst.id").alias("id"), to_dst.alias("msg")))
        msgs = reduce(lambda a, b: a.unionByName(b), parts)
        return msgs.groupBy("id").agg(agg(F.col("msg")).alias("msg"))
