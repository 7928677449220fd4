"""Graph queries on the supplier-part graph of `lineitem` (GR1-GR8, SRC9, SRT7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindling.operators.graph import (
    adjacency_degrees, bfs, build_graph, by_cell, by_source, degrees_of_separation, distances_with_unreached,
    pregel, reach, top_degrees,
)
from kindling.operators.sizing import pin_small
from kindling.plans.common import T
from kindling.plans.fixtures import graph_edges, graph_root, graph_vertices
from kindling.sources.text import adjacency_line_degrees

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Fixed parameters: the target is part 0 (vertex 2*0+1).
TARGET = 1
MAX_ITER = 10
REACH = 2

_E = """e AS (SELECT DISTINCT src, dst FROM (
   SELECT 2*l_suppkey AS src, 2*l_partkey+1 AS dst FROM lineitem
   UNION ALL SELECT 2*l_partkey+1, 2*l_suppkey FROM lineitem))"""
_WALK = f"""root AS (SELECT 2*min(l_suppkey) AS id FROM lineitem),
walk(id, d) AS (SELECT id, 0 FROM root UNION
                SELECT e.dst, w.d + 1 FROM walk w JOIN e ON e.src = w.id WHERE w.d < {MAX_ITER}),
m AS (SELECT id, min(d) AS d FROM walk GROUP BY id)"""
_V = "v AS (SELECT src AS id FROM e UNION SELECT dst FROM e)"
_NAMES = """names AS (SELECT id, max(name) AS name FROM (
   SELECT 2*s_suppkey AS id, s_name AS name FROM supplier
   UNION ALL SELECT 2*p_partkey+1, p_name FROM part) GROUP BY id)"""


def _vertex_ids(edges):
    return edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id"))).distinct()


def _hops(spark, sf):
    e = by_source(graph_edges(spark, sf))
    return distances_with_unreached(_vertex_ids(e.edges), bfs(e, graph_root(spark, sf), MAX_ITER))


@register("graph_degrees_topk", f"""
WITH e AS (SELECT 2*l_suppkey AS src, 2*l_partkey+1 AS dst FROM lineitem),
d AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e)
      GROUP BY id ORDER BY degree DESC, id LIMIT 10), {_NAMES}
SELECT d.id, coalesce(n.name, 'Nobody') AS name, d.degree FROM d LEFT JOIN names n ON n.id = d.id
""")
def graph_degrees_topk(spark, sf):
    li = T(spark, sf, "lineitem")
    edges = li.select((F.col("l_suppkey") * 2).alias("src"), (F.col("l_partkey") * 2 + 1).alias("dst"))
    return top_degrees(edges, graph_vertices(spark, sf), 10)


@register("graph_vertices_default", f"""
WITH e AS (SELECT 2*l_suppkey AS src, 2*l_partkey+1 AS dst FROM lineitem),
ids AS (SELECT src AS id FROM e UNION SELECT dst FROM e UNION SELECT 2*s_suppkey FROM supplier),
snames AS (SELECT 2*s_suppkey AS id, max(s_name) AS name FROM supplier GROUP BY 1)
SELECT ids.id, coalesce(snames.name, 'Nobody') AS name FROM ids LEFT JOIN snames ON snames.id = ids.id
""")
def graph_vertices_default(spark, sf):
    """GR1/JOIN7: vertices = supplier rows + edge endpoints; parts have no row -> 'Nobody'."""
    li = T(spark, sf, "lineitem")
    edges = li.select((F.col("l_suppkey") * 2).alias("src"), (F.col("l_partkey") * 2 + 1).alias("dst"))
    sup = T(spark, sf, "supplier").select((F.col("s_suppkey") * 2).alias("id"), F.col("s_name").alias("name"))
    return build_graph(sup, edges, "Nobody")


@register("adjacency_top", r"""
WITH lines AS (SELECT CAST(l_suppkey AS VARCHAR) || ' ' || string_agg(CAST(l_partkey AS VARCHAR), '  ') AS line
               FROM lineitem GROUP BY l_orderkey, l_suppkey, floor(l_linenumber / 16)),
t AS (SELECT string_split_regex(trim(line), '\s+') AS tok FROM lines),
deg AS (SELECT CAST(tok[1] AS BIGINT) AS id, CAST(sum(len(tok) - 1) AS BIGINT) AS degree
        FROM t GROUP BY 1 ORDER BY degree DESC, id LIMIT 10)
SELECT deg.id, s.s_name AS name, deg.degree FROM deg LEFT JOIN supplier s ON s.s_suppkey = deg.id
""")
def adjacency_top(spark, sf):
    """SRC9 + AGG11 + SRT3 + JOIN4: adjacency lines ``supp part part ...`` (one per
    order, supplier and block of 16 line numbers, so a line holds at most 16
    parts however big an order is, and an id spans many lines) -> most
    connected suppliers."""
    li = T(spark, sf, "lineitem")
    block = F.floor(F.col("l_linenumber") / 16)
    lines = li.groupBy("l_orderkey", "l_suppkey", block.alias("_blk")).agg(
        F.concat_ws(" ", F.col("l_suppkey").cast("string"),
                    F.concat_ws("  ", F.collect_list(F.col("l_partkey").cast("string")))).alias("line")
    )
    deg = adjacency_degrees(adjacency_line_degrees(lines, "line"))
    top = pin_small(deg.orderBy(F.desc("degree"), F.asc("id")).limit(10))
    sup = T(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    names = sup.join(F.broadcast(top.select("id")), "id")
    return top.join(names, "id", "left").select("id", "name", "degree")


@register("bfs_hops", f"""
WITH RECURSIVE {_E}, {_WALK}, {_V}
SELECT v.id, coalesce(CAST(m.d AS DOUBLE), 'inf'::DOUBLE) AS hops FROM v LEFT JOIN m ON m.id = v.id
""")
def bfs_hops(spark, sf):
    return _hops(spark, sf)


@register("bfs_target", f"""
WITH RECURSIVE {_E}, {_WALK}, {_V}
SELECT v.id, coalesce(CAST(m.d AS DOUBLE), 'inf'::DOUBLE) AS hops FROM v LEFT JOIN m ON m.id = v.id
WHERE v.id = {TARGET}
""")
def bfs_target(spark, sf):
    """GR5: the search ends in the round that reaches the target."""
    e = by_source(graph_edges(spark, sf))
    dist = bfs(e, graph_root(spark, sf), MAX_ITER, target=TARGET)
    return distances_with_unreached(_vertex_ids(e.edges).filter(F.col("id") == TARGET), dist)


@register("bfs_reach", f"""
WITH RECURSIVE {_E}, {_WALK}, {_V}
SELECT v.id, CASE WHEN m.d <= {REACH} THEN CAST(m.d AS DOUBLE) ELSE 'inf'::DOUBLE END AS hops,
       CASE WHEN m.d <= {REACH} THEN 'reached' WHEN m.d IS NOT NULL THEN 'beyond' ELSE 'unreachable' END AS state
FROM v LEFT JOIN m ON m.id = v.id
""")
def bfs_reach(spark, sf):
    """GR4 with a limit that binds: vertices farther than two hops told apart from those no path leads to.
    The search has no limit of rounds; the SQL's walk of ten hops passes the graph's depth."""
    e = by_source(graph_edges(spark, sf))
    return reach(_vertex_ids(e.edges), bfs(e, graph_root(spark, sf), max_iter=None), REACH)


@register("bfs_first_n", f"""
WITH RECURSIVE {_E}, {_WALK}, {_V}, {_NAMES}
SELECT v.id, coalesce(n.name, 'Nobody') AS name, coalesce(CAST(m.d AS DOUBLE), 'inf'::DOUBLE) AS hops
FROM v LEFT JOIN m ON m.id = v.id LEFT JOIN names n ON n.id = v.id
ORDER BY v.id LIMIT 100
""")
def bfs_first_n(spark, sf):
    """SRT7: distances joined with names, first 100 by id (made deterministic)."""
    hops = pin_small(_hops(spark, sf).orderBy("id").limit(100))
    names = graph_vertices(spark, sf).join(F.broadcast(hops.select("id")), "id").groupBy("id").agg(
        F.max("name").alias("name"))
    return hops.join(names, "id", "left").select(
        "id", F.coalesce("name", F.lit("Nobody")).alias("name"), "hops")


@register("degrees_of_separation", f"""
WITH RECURSIVE {_E}, {_WALK},
td AS (SELECT (SELECT d FROM m WHERE id = {TARGET}) AS d)
SELECT (SELECT id FROM root) AS start, CAST({TARGET} AS BIGINT) AS target, CAST(td.d AS INTEGER) AS degree,
       CAST((SELECT count(*) FROM e JOIN m ON e.src = m.id WHERE e.dst = {TARGET} AND m.d = td.d - 1) AS BIGINT) AS hits
FROM td
""")
def q_degrees_of_separation(spark, sf):
    edges = by_source(graph_edges(spark, sf))
    start = graph_root(spark, sf).first()["root"]  # one scalar: the loop's start id
    return degrees_of_separation(edges, start, TARGET, MAX_ITER)


@register("pregel_min_label", f"""
WITH RECURSIVE {_E}, {_V},
near(id, label, d) AS (SELECT id, id, 0 FROM v UNION ALL
                       SELECT e.dst, min(n.label), n.d + 1 FROM near n JOIN e ON e.src = n.id WHERE n.d < {MAX_ITER} GROUP BY e.dst, n.d)
SELECT id, min(label) AS label FROM near GROUP BY id
""")
def pregel_min_label(spark, sf):
    """GR8: min-label propagation, at most 10 supersteps (label = least id within 10 hops)."""
    edges = by_cell(graph_edges(spark, sf, distinct=False), distinct=True)
    verts = _vertex_ids(edges.edges).select("id", F.col("id").alias("attr"))
    send = F.when(F.col("src_attr") < F.col("dst_attr"), F.col("src_attr"))
    out = pregel(verts, edges, send, "min", max_iter=MAX_ITER)
    return out.select("id", F.col("attr").alias("label"))


@register("hops_by_pregel", f"""
WITH RECURSIVE {_E}, {_WALK}, {_V}
SELECT v.id, coalesce(CAST(m.d AS DOUBLE), 'inf'::DOUBLE) AS hops FROM v LEFT JOIN m ON m.id = v.id
""")
def hops_by_pregel(spark, sf):
    """GR8 with an edge attribute and an initial message: every edge has weight
    1, vertices start at infinity, the root's initial attribute is 0."""
    edges = by_cell(graph_edges(spark, sf, distinct=False).withColumn("weight", F.lit(1.0)), distinct=True)
    root = graph_root(spark, sf).first()["root"]  # one scalar
    verts = _vertex_ids(edges.edges).select("id", F.when(F.col("id") == root, 0.0).otherwise(F.lit(float("inf"))).alias("attr"))
    out = pregel(verts, edges, F.col("src_attr") + F.col("weight"), "min", max_iter=MAX_ITER, initial=float("inf"),
                 reads_target=False)
    return out.select("id", F.col("attr").alias("hops"))
