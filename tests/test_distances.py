"""Shortest paths by length against Dijkstra's algorithm."""

import heapq
import random
from collections import defaultdict

import pytest

from wayword.operators import distances, graph as roads, skew


def brute_force(lengths, src, dst):
    """The smallest (length, edges, vertices)."""
    queue, done = [(0, 0, (src,))], set()
    while queue:
        length, hops, way = heapq.heappop(queue)
        if way[-1] == dst:
            return length, way
        if way[-1] in done:
            continue
        done.add(way[-1])
        for to, more in lengths[way[-1]]:
            heapq.heappush(queue, (length + more, hops + 1, (*way, to)))
    return None


def check(spark, points, edges, requests, max_m=None, width_m=None):
    graph = roads.Graph(
        spark.createDataFrame(points, "id bigint, lat double, lon double"),
        spark.createDataFrame(edges, "src bigint, dst bigint"),
    )
    lengths = defaultdict(list)
    for r in roads.with_edge_length(graph).distinct().collect():
        if r["length_m"] is not None:
            lengths[r["src"]].append((r["dst"], int(r["length_m"] * 1000 + 0.5)))
    ids = {p[0] for p in points}
    pairs = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(requests)], "pair_id int, src bigint, dst bigint")
    got = distances.shortest_by_length(graph, pairs, max_m, width_m).collect()
    assert len(got) == len(requests)
    for r in got:
        want = brute_force(lengths, r["src"], r["dst"]) if {r["src"], r["dst"]} <= ids else None
        if want and max_m is not None and want[0] > 1000 * max_m:
            want = None
        assert r["path"] == (list(want[1]) if want else None), (r["src"], r["dst"])
        assert r["length_m"] == (want[0] / 1000 if want else None)


@pytest.mark.parametrize("large", [False, True])
def test_random_graphs_with_hubs_and_equal_places(spark, monkeypatch, large):
    if large:  # nothing is broadcast on purpose, and the edges of hubs are parted
        monkeypatch.setattr(distances, "FRONT_BYTES", 0)
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 1)
        monkeypatch.setattr(skew, "HOT_ROWS", 5)
        monkeypatch.setattr(skew, "HOT_SHARE", 0.05)
    rnd = random.Random(3)
    # Few places for many vertices: edges of no length, and many paths of the same length.
    points = [(i, rnd.choice([50.0, 50.001, 50.002]), rnd.choice([8.0, 8.001])) for i in range(30)] + [(30, None, 8.0)]
    edges = [(rnd.randrange(33), rnd.randrange(33)) for _ in range(70)] + [(0, i) for i in range(1, 30, 2)] + [(4, 4), (1, 2), (1, 2)]
    requests = [(rnd.randrange(32), rnd.choice([3, 7, rnd.randrange(32)])) for _ in range(30)] + [(5, 5), (None, 3), (0, 99), (0, 1), (0, 1)]
    check(spark, points, edges, requests, width_m=60.0 if large else None)


def test_a_longer_way_of_fewer_edges_and_a_bound(spark):
    points = [(i, 50.0 + 0.001 * i, 8.0) for i in range(6)] + [(9, 50.0, 9.0)]
    edges = [(i, i + 1) for i in range(5)] + [(0, 9), (9, 5), (0, 5)]
    check(spark, points, edges, [(0, 5), (0, 9), (5, 0), (2, 4)], width_m=1.0)
    check(spark, points, edges, [(0, 5), (0, 9), (2, 4)], max_m=300.0)


def test_no_edges_and_no_requests(spark):
    check(spark, [(1, 0.0, 0.0), (2, 0.0, 0.0)], [(7, 8)], [(1, 1), (1, 2)])
    check(spark, [(1, 0.0, 0.0), (2, 0.0, 0.0)], [(1, 2)], [])


def test_labels_hold_numbers_only(spark, monkeypatch):
    """Labels have a fixed size, whatever the length of the way."""
    kept, add = set(), distances._Labels.add
    monkeypatch.setattr(distances._Labels, "add", lambda self, rows, *at: kept.update(t for _, t in rows.dtypes) or add(self, rows, *at))
    check(spark, [(i, 50.0 + 0.001 * i, 8.0) for i in range(3)], [(0, 1), (1, 2)], [(0, 2)])
    assert kept == {"bigint"}
