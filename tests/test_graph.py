"""Graph operators against brute force on small random graphs with a hub."""

import random
from collections import defaultdict
from itertools import combinations

import pytest

from millrace.operators import graph


def random_edges(seed, vertices=40, edges=70, hub=True):
    draw = random.Random(seed)
    out = [(draw.randrange(vertices), draw.randrange(vertices)) for _ in range(edges)]
    return out + [(0, v) for v in range(1, vertices, 2)] if hub else out


@pytest.fixture(params=[1, 2])
def edges(request):
    return random_edges(request.param)


def frame(spark, edges):
    return spark.createDataFrame(edges, "src bigint, dst bigint")


def test_transitive_closure(spark):
    edges = random_edges(3, 30, 32, hub=False)
    known = set(edges)
    while True:
        more = {(a, d) for a, b in known for c, d in edges if b == c} | known
        if more == known:
            break
        known = more
    assert {tuple(r) for r in graph.transitive_closure(frame(spark, edges)).collect()} == known


def test_connected_components(spark):
    edges = random_edges(5, 60, 35, hub=False) + [(i, i + 1) for i in range(100, 130)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {r["id"]: r["component"] for r in graph.connected_components(frame(spark, edges)).collect()} == {v: find(v) for v in list(parent)}


def test_triangles(spark, edges):
    around = defaultdict(set)
    for a, b in edges:
        if a != b:
            around[a].add(b)
            around[b].add(a)
    expected = defaultdict(int)
    for a, b, c in combinations(sorted(around), 3):
        if b in around[a] and c in around[a] and c in around[b]:
            for v in (a, b, c):
                expected[v] += 1
    assert {r["id"]: r["triangles"] for r in graph.triangle_counts(frame(spark, edges)).collect()} == dict(expected)


def plain_ranks(edges, rounds, keep_all):
    out = defaultdict(int)
    for a, _ in edges:
        out[a] += 1
    everyone = {v for e in edges for v in e}
    ranks = {v: 1.0 for v in (everyone if keep_all else out)}
    for _ in range(rounds):
        got = defaultdict(float)
        for a, b in edges:
            if a in ranks:
                got[b] += ranks[a] / out[a]
        ranks = {v: 0.15 + 0.85 * got[v] for v in (everyone if keep_all else got)}
    return ranks


@pytest.mark.parametrize("per_salt", [1_000_000, 3])
def test_pagerank(spark, edges, monkeypatch, per_salt):
    monkeypatch.setattr(graph, "EDGES_PER_SALT", per_salt)
    distinct = sorted(set(edges))
    got = {r["id"]: r["rank"] for r in graph.pagerank_links(frame(spark, edges), iterations=6, cut_every=2).collect()}
    assert got == pytest.approx(plain_ranks(distinct, 6, keep_all=False))
    got = {r["id"]: r["rank"] for r in graph.pagerank(frame(spark, distinct), iterations=4).collect()}
    assert got == pytest.approx(plain_ranks(distinct, 4, keep_all=True))


def test_pagerank_tolerance(spark, edges):
    distinct = sorted(set(edges))
    got = {r["id"]: r["rank"] for r in graph.pagerank(frame(spark, distinct), iterations=None, tolerance=1e-4).collect()}
    assert got == pytest.approx(plain_ranks(distinct, 80, keep_all=True), abs=1e-3)


def test_power_iteration_separates_groups(spark):
    """Two dense rings that hang together by one weak edge."""
    rows = []
    for start, n in ((0, 10), (100, 30)):
        rows += [(start + i, start + (i + d) % n, 1.0) for i in range(n) for d in (1, 2, 3)]
    rows.append((0, 100, 0.001))
    similarity = spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    got = defaultdict(set)
    for r in graph.power_iteration_clusters(similarity, 2, iterations=20).collect():
        got[r["id"] >= 100].add(r["cluster"])
    assert len(got[False]) == 1 and len(got[True]) == 1 and got[False] != got[True]


def test_placed_edges_are_counted_outside_their_parts(spark):
    """The nine parts hold whatever the table holds, so no task may gather the pairs of one."""
    edges = frame(spark, random_edges(3, vertices=30, edges=400))
    for strategy in ("RandomVertexCut", "CanonicalRandomVertexCut", "EdgePartition1D", "EdgePartition2D"):
        report = graph.placement_report(edges, strategy, 9)
        text = report._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(src#" in text and ", 9), REPARTITION" not in text and "FileScan parquet" in text
        assert report.collect() == [(strategy, edges.count(), True)]


def test_triangles_move_a_row_per_edge_and_not_per_wedge(spark):
    """Neighbours above both ends of an edge are met as arrays; loops, repeats, both directions and nulls do not count."""
    size = 12
    rows = [(i, j) for i in range(size) for j in range(size)] + [(0, 1), (None, 3), (3, None), (50, 0), (50, 1), (60, 0)]
    found = graph.triangle_counts(spark.createDataFrame(rows, "src bigint, dst bigint"))
    assert "array_intersect" in found._jdf.queryExecution().optimizedPlan().toString()
    each = (size - 1) * (size - 2) // 2
    assert {r["id"]: r["triangles"] for r in found.collect()} == {i: each + (i < 2) for i in range(size)} | {50: 1}


def test_lists_of_neighbours_are_not_broadcast(spark, edges):
    """Their files are far smaller than the lists in memory, which the driver would have to build."""
    found = graph.triangle_counts(frame(spark, edges))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
