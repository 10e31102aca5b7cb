import glob
import math
import os
import random
from collections import defaultdict, deque

import pytest
from conftest import column, rows

from wayword.functions import tags
from wayword.functions.geo import haversine_m
from wayword.operators import graph as roads, paths, skew
from wayword.plans import jobs, queries, standins
from wayword.sources import osm, sinks, text as files
from pyspark.sql import functions as F

OSM = """<?xml version="1.0" encoding="UTF-8"?>
<osm version="0.6">
  <node id="1" lat="1.0" lon="103.0" version="3"/>
  <node id="2" lat="1.1" lon="103.0"><tag k="highway" v="crossing"/></node>
  <node id="3" lat="1.2" lon="103.1"/>
  <node id="4" lat="1.3" lon="103.1"/>
  <node id="5" lat="9.9" lon="99.9"/>
  <way id="10"><nd ref="1"/><nd ref="2"/><nd ref="3"/><tag k="highway" v="service"/></way>
  <way id="11"><nd ref="3"/><nd ref="4"/><tag k="highway" v="x"/><tag k="oneway" v="yes"/></way>
  <way id="12"><nd ref="4"/><nd ref="1"/><tag k="highway" v="x"/><tag k="oneway" v="-1"/></way>
  <way id="13"><nd ref="1"/><nd ref="5"/><tag k="building" v="yes"/></way>
  <way id="14"><nd ref="1"/><nd ref="5"/></way>
  <way id="15"><nd ref="2"/><tag k="highway" v="x"/></way>
  <way id="16"><tag k="highway" v="x"/></way>
  <way id="17"><nd ref="2"/><nd ref="2"/><tag k="highway" v="x"/><tag k="oneway" v="yes"/></way>
  <way id="18"><nd ref="2"/><nd ref="77"/><tag k="highway" v="x"/></way>
  <way id="19"><nd ref="1"/><nd ref="2"/><tag k="highway" v="x"/><tag k="oneway" v="yes"/></way>
</osm>
"""
EDGES = [
    (1, 2), (2, 1), (2, 3), (3, 2), (3, 4), (4, 1), (1, 4), (2, 2), (2, 77), (77, 2), (1, 2),
]


@pytest.fixture
def osm_file(tmp_path):
    path = tmp_path / "map.osm"
    path.write_text(OSM)
    return str(path)


def make_graph(spark, ids, edges):
    return roads.Graph(
        spark.createDataFrame([(i, float(i % 90), float(i % 180)) for i in ids], "id bigint, lat double, lon double"),
        spark.createDataFrame(edges, "src bigint, dst bigint"),
    )


def test_read_map(spark, osm_file):
    assert osm.read_nodes(spark, osm_file).count() == 5
    ways = {r["_id"]: r for r in osm.read_ways(spark, osm_file).collect()}
    assert [n["_ref"] for n in ways[10]["nd"]] == [1, 2, 3]
    assert ways[14]["tag"] is None and ways[16]["nd"] is None


def test_tags(spark, osm_file):
    got = osm.read_ways(spark, osm_file).select(
        "_id", tags.is_highway("tag"), tags.is_oneway("tag"), tags.tag_value("tag", "oneway")
    )
    flags = {r[0]: tuple(r)[1:] for r in got.collect()}
    assert flags[10] == (True, False, None)
    assert flags[11] == (True, True, "yes")
    assert flags[12] == (True, False, "-1")
    assert flags[13] == flags[14] == (False, False, None)


def test_ways_to_edges(spark, osm_file):
    assert rows(roads.ways_to_edges(osm.read_ways(spark, osm_file))) == sorted(EDGES, key=repr)


def test_consecutive_pairs(spark):
    df = spark.sql("SELECT * FROM VALUES (array(1, 2, 2, 3)), (array(1)), (array()), (null) AS t(n)")
    got = column(df.select(tags.consecutive_pairs(F.col("n"))))
    assert [[tuple(p) for p in pairs] for pairs in got] == [[(1, 2), (2, 2), (2, 3)], [], [], []]


def test_map_job(spark, osm_file, tmp_path):
    (tmp_path / "pairs.txt").write_text("1 3\n5 1\n4 3\n2 2\n3 x\n1 4\n")
    jobs.map_roads(spark, osm_file, str(tmp_path / "pairs.txt"), str(tmp_path / "adj"), str(tmp_path / "paths"))
    lines = column(files.read_lines(spark, str(tmp_path / "adj")))
    assert sorted(lines) == ["1 2 4", "2 1 2 3 77", "3 2 4", "4 1"]
    assert column(files.read_lines(spark, str(tmp_path / "paths"))) == [
        "1 -> 2 -> 3", "", "4 -> 1 -> 2 -> 3", "2", "", "1 -> 4",
    ]


def test_drop_isolated_keeps_ends(spark):
    graph = roads.drop_isolated(make_graph(spark, [1, 2, 3, 4], [(1, 2), (9, 3)]))
    assert sorted(column(graph.vertices, "id")) == [1, 2, 3]


@pytest.mark.parametrize("part_size", [None, 2, 4])
def test_adjacency(spark, part_size):
    edges = [(1, d) for d in (9, 3, 5, 7, 3, 2, 4)] + [(2, 1), (2, 1), (2, 1), (8, 1)]
    graph = make_graph(spark, [1, 2, 3], edges)
    got = roads.adjacency(graph, part_size).collect()
    neighbours = defaultdict(list)
    for r in got:
        assert r["dsts"] == sorted(r["dsts"])
        neighbours[r["id"]] += r["dsts"]
    assert {k: sorted(v) for k, v in neighbours.items()} == {1: [2, 3, 4, 5, 7, 9], 2: [1], 3: []}
    sizes = [len(r["dsts"]) for r in sorted(got, key=lambda r: r["part"]) if r["id"] == 1]
    assert sizes == {None: [6], 2: [2, 2, 2], 4: [4, 2]}[part_size]
    assert len(got) == len(sizes) + 2 and all(r["part"] == 0 for r in got if r["id"] != 1)


def test_adjacency_lines(spark, tmp_path):
    graph = make_graph(spark, [1, 2], [(1, 5), (1, 3)])
    sinks.write_adjacency(roads.adjacency(graph), str(tmp_path / "adj"))
    assert sorted(column(files.read_lines(spark, str(tmp_path / "adj")))) == ["1 3 5", "2 "]


def test_haversine(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 180.0), (0.0, 0.0, 0.0, 1.0), (1.3, 1.3, 103.8, 103.8), (90.0, -90.0, 5.0, 77.0)],
        "a double, b double, c double, d double",
    )
    half = math.pi * 6371 * 1000
    got = column(df.select(haversine_m(F.col("a"), F.col("b"), F.col("c"), F.col("d"))))
    assert got == pytest.approx([half, half / 180, 0.0, half])


@pytest.mark.parametrize("broadcast", [500_000, 1])
def test_edge_lengths(spark, monkeypatch, broadcast):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", broadcast)
    graph = roads.Graph(
        spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 1.0)], "id bigint, lat double, lon double"),
        spark.createDataFrame([(1, 2), (1, 2), (2, 2), (1, 3)], "src bigint, dst bigint"),
    )
    got = {(r["src"], r["dst"]): r["length_m"] for r in roads.with_edge_length(graph).collect()}
    assert got[(1, 2)] == pytest.approx(math.pi * 6371 * 1000 / 180)
    assert got[(2, 2)] == 0 and got[(1, 3)] is None
    assert roads.with_edge_length(graph).count() == 4


def brute_force(ids, edges, src, dst, max_hops):
    """Smallest of the shortest paths, by walking all of them."""
    if src not in ids or dst not in ids:
        return None
    out = defaultdict(set)
    for a, b in edges:
        if a in ids and b in ids:
            out[a].add(b)
    hops = {src: 0}
    queue = deque([src])
    while queue:
        node = queue.popleft()
        for n in out[node]:
            if n not in hops:
                hops[n] = hops[node] + 1
                queue.append(n)
    if dst not in hops or (max_hops is not None and hops[dst] > max_hops):
        return None
    whole = [[src]]
    for _ in range(hops[dst]):
        whole = [p + [n] for p in whole for n in out[p[-1]] if hops[n] == len(p)]
    return min(p for p in whole if p[-1] == dst)


def check_paths(spark, ids, edges, requests, max_hops):
    numbered = [(i, a, b) for i, (a, b) in enumerate(requests)]
    pairs = spark.createDataFrame(numbered, "pair_id int, src bigint, dst bigint")
    got = paths.shortest_paths(make_graph(spark, ids, edges), pairs, max_hops).collect()
    assert len(got) == len(requests)
    for r in got:
        want = brute_force(set(ids), edges, r["src"], r["dst"], max_hops)
        assert r["path"] == want, (r["src"], r["dst"])
        assert r["hops"] == (None if want is None else len(want) - 1)


def test_paths_on_a_line(spark):
    edges = [(i, i + 1) for i in range(13)] + [(4, 4), (0, 1)]
    requests = [(0, 10), (0, 11), (10, 0), (3, 3), (0, 1), (0, 99), (99, 0), (99, 99), (0, 10), (2, 10)]
    check_paths(spark, range(14), edges, requests, 10)
    check_paths(spark, range(14), edges, [(0, 12), (1, 13)], 12)
    check_paths(spark, range(14), edges, [(0, 2), (0, 1), (5, 5)], 1)


def test_long_paths_have_no_limit(spark):
    edges = [(i, i + 1) for i in range(30)] + [(30, 0), (2, 40), (40, 4), (15, 41), (41, 17)]
    check_paths(spark, [*range(31), 40, 41], edges, [(0, 30), (30, 29), (1, 25), (5, 5), (0, 30)], None)


def test_no_requests_and_no_edges(spark):
    check_paths(spark, [1, 2], [(1, 2)], [], 10)
    check_paths(spark, [1, 2], [], [(1, 1), (1, 2)], 10)


def test_levels_and_edges_hold_numbers_of_fixed_size(spark, monkeypatch):
    """Steps are hashed and not sorted, and a node has one row of edges."""
    kept, write_level = [], paths._Search.write_level

    def seen(self, level):
        kept.append((level.dtypes, self.edges.where("NOT back").count()))
        return write_level(self, level)

    monkeypatch.setattr(paths._Search, "write_level", seen)
    check_paths(spark, range(5), [(0, 1), (0, 2), (1, 3), (2, 3), (3, 4)], [(0, 4)], None)
    assert len(kept) == 3
    for types, n_edges in kept:
        assert {t for _, t in types} <= {"boolean", "bigint"} and n_edges == 4


@pytest.mark.parametrize("small", [True, False])
def test_paths_on_random_graphs(spark, monkeypatch, small):
    rng = random.Random(5)
    ids = list(range(40))
    hub = [(0, d) for d in range(1, 40, 2)] + [(s, 0) for s in range(20, 30)]
    edges = hub + [(rng.randrange(44), rng.randrange(44)) for _ in range(60)]
    requests = [(rng.randrange(42), rng.choice([3, 7, rng.randrange(42)])) for _ in range(40)]
    if not small:
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 1)
    check_paths(spark, ids, edges, requests, None)


def test_a_hop_moves_only_its_front(spark, monkeypatch):
    """No exchange below the join with edges or levels but those of the front and of its steps; nothing stays behind."""
    monkeypatch.setattr(paths, "FRONT_BYTES", 0)
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    monkeypatch.setattr(skew, "HOT_SHARE", 0.02)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans, folders = [], []
    write = paths._Search.write_level

    def seen(self, level):
        plans.append(level._jdf.queryExecution().executedPlan().toString())
        folders.append(self.folder)
        return write(self, level)

    monkeypatch.setattr(paths._Search, "write_level", seen)
    try:
        edges = [(i, i + 1) for i in range(13)] + [(4, i) for i in range(20, 40)] + [(i, 7) for i in range(20, 40)]
        check_paths(spark, range(40), edges, [(0, 13), (0, 7), (3, 7), (25, 9)], None)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert len(plans) > 4
    for plan in plans[1:]:
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert "SelectedBucketsCount" in plan
        # The salted front goes to the edges, and the steps go to their buckets.
        assert sum("salt" in line for line in exchanges) == 1
        assert sum("search" in line and "to#" in line for line in exchanges) == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("wayword_paths")]
    left = {name for folder in folders for name in os.listdir(folder)}
    assert not left & {"edges", "bucketed", "levels"}


def test_pairs_file(spark, tmp_path):
    (tmp_path / "pairs.txt").write_text("12 34\n5\nx 7\n")
    got = [tuple(r)[1:] for r in files.read_pairs(spark, str(tmp_path / "pairs.txt")).orderBy("pair_id").collect()]
    assert got == [(12, 34), (5, None), (None, 7)]


def test_map_files_are_small(spark, monkeypatch, tmp_path):
    """An XML file is read by one task."""
    monkeypatch.setattr(queries, "MAP_FILE_ELEMENTS", 500, raising=False)
    tables = "/root/testdata/sf0.001"
    queries._write_map(spark, tables, str(tmp_path))
    for name, read, given in (("nodes", osm.read_nodes, standins.map_nodes), ("ways", osm.read_ways, standins.map_ways)):
        files_of = glob.glob(f"{tmp_path}/{name}/part*")
        assert sum(read(spark, f).count() for f in files_of) == given(spark, tables).count()
        assert all(read(spark, f).count() <= 500 for f in files_of)
    edges = roads.ways_to_edges(osm.read_ways(spark, f"{tmp_path}/ways"))
    assert rows(edges) == rows(roads.ways_to_edges(standins.map_ways(spark, tables)))
