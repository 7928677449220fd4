"""Graph operators against brute force on a hand-made graph (FIXTURES.md §5 edge cases)."""

import math
from collections import deque

import pytest
from pyspark.sql import functions as F

from kindling.operators.graph import (
    bfs, build_graph, by_cell, by_source, degrees, degrees_of_separation, distances_with_unreached, edges_from, pregel, reach,
    top_degrees, with_target_state, ALL_JOIN_KEYS, _grid_triplets, _turned_off,
)
from tests.conftest import explain_text, rows

# A chain 0-1-...-11 (hop 10 and hop 11), a diamond (node 21 reached from two
# frontier nodes at once), a self-loop, a repeated edge, an isolated vertex 99.
DIRECTED = [(i, i + 1) for i in range(11)] + [(0, 20), (0, 22), (20, 21), (22, 21), (5, 5), (3, 4)]


def _undirected(edges):
    return sorted({(a, b) for a, b in edges} | {(b, a) for a, b in edges})


def _bfs(edges, root, max_iter):
    adj = {}
    for a, b in edges:
        adj.setdefault(a, set()).add(b)
    dist, q = {root: 0}, deque([root])
    while q:
        u = q.popleft()
        if dist[u] == max_iter:
            continue
        for v in adj.get(u, ()):
            if v not in dist:
                dist[v] = dist[u] + 1
                q.append(v)
    return dist


def test_degrees_count_multi_edges(spark):
    e = spark.createDataFrame(DIRECTED, "src BIGINT, dst BIGINT")
    got = dict(rows(degrees(e)))
    assert got[5] == 4  # 4->5, 5->6, self-loop counted twice
    assert got[4] == 3  # 3->4 twice (repeated edge), 4->5
    assert 99 not in got


def test_top_degrees_and_default_names(spark):
    e = spark.createDataFrame(DIRECTED, "src BIGINT, dst BIGINT")
    v = spark.createDataFrame([(5, "five"), (99, "alone")], "id BIGINT, name STRING")
    top = top_degrees(e, v, 2).collect()
    assert [(r["id"], r["name"], r["degree"]) for r in top] == [(5, "five", 4), (0, "Nobody", 3)]
    g = dict(rows(build_graph(v, e, "Nobody")))
    assert g[99] == "alone" and g[21] == "Nobody"


def test_bfs_matches_brute_force(spark):
    und = _undirected(DIRECTED)
    e = spark.createDataFrame(und, "src BIGINT, dst BIGINT")
    want = _bfs(und, 0, 10)
    got = dict(rows(bfs(e, 0, 10)))
    assert got == want
    assert 11 not in got and got[10] == 10 and got[21] == 2
    verts = spark.createDataFrame([(i,) for i in range(12)] + [(20,), (21,), (22,), (99,)], "id BIGINT")
    full = dict(rows(distances_with_unreached(verts, bfs(e, 0, 10))))
    assert math.isinf(full[99]) and math.isinf(full[11])


def test_degrees_of_separation_hits(spark):
    e = spark.createDataFrame(_undirected(DIRECTED), "src BIGINT, dst BIGINT")
    r = degrees_of_separation(e, 0, 21, 10).first()
    assert (r["degree"], r["hits"]) == (2, 2)  # reached from 20 and 22 in the same round
    far = degrees_of_separation(e, 0, 11, 10).first()
    assert far["degree"] is None and far["hits"] == 0
    assert degrees_of_separation(e, 0, 10, 10).first()["degree"] == 10


def test_pregel_min_label_is_min_within_k_hops(spark):
    und = _undirected(DIRECTED)
    e = spark.createDataFrame(und, "src BIGINT, dst BIGINT")
    ids = sorted({a for a, _ in und})
    v = spark.createDataFrame([(i, i) for i in ids], "id BIGINT, attr BIGINT")
    send = F.when(F.col("src_attr") < F.col("dst_attr"), F.col("src_attr"))
    got = dict(rows(pregel(v, e, send, "min", max_iter=3)))
    want = {i: min(_bfs(und, i, 3)) for i in ids}
    assert got == want


def _hub_graph():
    """900 edges of which a third leave vertex 0 and a third enter vertex 1, besides a chain of 30."""
    return [(0, 100 + i) for i in range(300)] + [(100 + i, 1) for i in range(300)] + [(1000 + i, 2000 + i) for i in range(270)] + [
        (1, 500)] + [(500 + i, 501 + i) for i in range(29)]


def _largest(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


@pytest.fixture
def plain_shuffles(spark):
    """Tables as small as these keep their shuffle partitions apart, as large ones do."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hub_edges_are_spread_and_results_stay(spark, plain_shuffles):
    pairs = _hub_graph()
    e = by_source(spark.createDataFrame(pairs, "src BIGINT, dst BIGINT"), hub_rows=20, targets=True)
    assert rows(e.sources, "src") == [(0,)] and rows(e.targets, "dst") == [(1,)]
    assert rows(e.edges, "src", "dst") == sorted(pairs)
    # Even shares are 113 of 900 edges; the hub's 300 edges must not meet in one task.
    assert _largest(e.edges) < 250
    ids = sorted({i for p in pairs for i in p})
    state = spark.createDataFrame([(i, i) for i in ids], "id BIGINT, attr BIGINT")
    active = state.selectExpr("id AS src", "attr AS src_attr")
    triplets = with_target_state(e, edges_from(e, active, len(ids), 0), state)
    assert _largest(triplets) < 250
    found = triplets.collect()
    assert sorted((r["src"], r["dst"]) for r in found) == sorted(pairs)
    assert all(r["src_attr"] == r["src"] and r["dst_attr"] == r["dst"] for r in found)
    send, back = F.when(F.col("src_attr") < F.col("dst_attr"), F.col("src_attr")), [(b, a) for a, b in pairs]
    for bound in (0, 10**6):
        assert dict(rows(bfs(e, 0, 10, broadcast_rows=bound))) == _bfs(pairs, 0, 10)
        r = degrees_of_separation(e, 0, 1, 10, broadcast_rows=bound).first()
        assert (r["degree"], r["hits"]) == (2, 300)
        got = dict(rows(pregel(state, e, send, "min", max_iter=3, broadcast_rows=bound)))
        assert got == {i: min(_bfs(back, i, 3)) for i in ids}


def test_grid_of_edges_stays_in_place_and_results_stay(spark, plain_shuffles):
    pairs = _hub_graph()
    e = by_cell(spark.createDataFrame(pairs * 2 + [(None, 5), (5, None)], "src BIGINT, dst BIGINT"), distinct=True, side=3)
    assert sorted((r["src"], r["dst"]) for r in e.edges.where("src IS NOT NULL AND dst IS NOT NULL").collect()) == sorted(pairs)
    ids = sorted({i for p in pairs for i in p})
    state = spark.createDataFrame([(i, i) for i in ids] + [(None, None)], "id BIGINT, attr BIGINT").checkpoint()
    active = state.selectExpr("id AS src", "attr AS src_attr")
    with _turned_off(spark, ALL_JOIN_KEYS):
        trip = _grid_triplets(e, active, len(ids), state, len(ids), 0)
        # Only the sources' and the targets' states are shuffled, not the edges.
        assert explain_text(trip, "simple").count("Exchange hashpartitioning") == 2
        found = trip.collect()
    assert sorted((r["src"], r["dst"]) for r in found) == sorted(pairs)
    assert all(r["src_attr"] == r["src"] and r["dst_attr"] == r["dst"] for r in found)
    send, back = F.when(F.col("src_attr") < F.col("dst_attr"), F.col("src_attr")), [(b, a) for a, b in pairs]
    for bound in (0, 100, 10**6):
        got = dict(rows(pregel(state, e, send, "min", max_iter=3, broadcast_rows=bound)))
        assert got == {i: min(_bfs(back, i, 3)) for i in ids} | {None: None}
        got = dict(rows(pregel(state, e, F.col("src_attr"), "min", max_iter=3, broadcast_rows=bound, reads_target=False)))
        assert got == {i: min(_bfs(back, i, 3)) for i in ids} | {None: None}


def test_no_hub_no_parts(spark):
    e = by_source(spark.createDataFrame(_hub_graph(), "src BIGINT, dst BIGINT"), targets=True)
    assert e.sources is None and e.targets is None and e.edges.columns == ["src", "dst"]
    empty = spark.createDataFrame([], "src BIGINT, dst BIGINT")
    assert rows(bfs(empty, 3)) == [(3, 0)]


def test_search_ends_at_the_target(spark):
    e = spark.createDataFrame(_undirected(DIRECTED), "src BIGINT, dst BIGINT")
    got = dict(rows(bfs(e, 0, 10, target=21)))
    assert got == {k: d for k, d in _bfs(_undirected(DIRECTED), 0, 10).items() if d <= 2}
    assert rows(bfs(e, 0, 10, target=0)) == [(0, 0)]
    assert dict(rows(bfs(e, 0, 10, target=99))) == _bfs(_undirected(DIRECTED), 0, 10)


def test_beyond_the_limit_is_not_unreachable(spark):
    pairs = _undirected(DIRECTED)
    verts = spark.createDataFrame([(i,) for i in (0, 10, 11, 99, None)], "id BIGINT")
    e = spark.createDataFrame(pairs + [(0, None), (None, 99)], "src BIGINT, dst BIGINT")
    got = {r["id"]: (r["hops"], r["state"]) for r in reach(verts, bfs(e, 0, max_iter=None), 10).collect()}
    assert got == {0: (0, "reached"), 10: (10, "reached"), 11: (math.inf, "beyond"),
                   99: (math.inf, "unreachable"), None: (math.inf, "unreachable")}


def test_levels_of_a_long_chain_are_written_as_one(spark):
    chain = [(i, i + 1) for i in range(20)]
    e = by_source(spark.createDataFrame(chain, "src BIGINT, dst BIGINT"))
    assert dict(rows(bfs(e, 0, max_iter=None))) == {i: i for i in range(21)}
