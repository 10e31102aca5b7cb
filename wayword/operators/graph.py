"""Road graphs: from map elements to vertices, edges, adjacency lists and edge lengths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import haversine_m
from ..functions.tags import consecutive_pairs, is_highway, is_oneway
from ..session import materialise, scratch_path
from .skew import sized_join


@dataclass(frozen=True)
class Graph:
    """``vertices`` has ``id, lat, lon``; ``edges`` has ``src, dst`` and may hold parallel edges."""

    vertices: DataFrame
    edges: DataFrame


def to_vertices(nodes: DataFrame) -> DataFrame:
    """Vertices of map nodes."""
    return nodes.select(F.col("_id").alias("id"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))


def ways_to_edges(ways: DataFrame) -> DataFrame:
    """Directed edges of all ways that are highways.

    Neighbouring nodes of a way make an edge, and one in the other direction too unless the way is one-way.
    Self-loops and parallel edges stay.
    """
    roads = ways.where(is_highway("tag")).select(
        is_oneway("tag").alias("oneway"),
        F.explode_outer(consecutive_pairs(F.col("nd._ref"))).alias("pair"),
    ).where("pair IS NOT NULL")
    forward = F.struct(F.col("pair.src").alias("src"), F.col("pair.dst").alias("dst"))
    back = F.struct(F.col("pair.dst").alias("src"), F.col("pair.src").alias("dst"))
    directions = F.when(F.col("oneway"), F.array(forward)).otherwise(F.array(forward, back))
    return roads.select(F.inline_outer(directions))


def road_graph(nodes: DataFrame, ways: DataFrame) -> Graph:
    """The graph of a map, vertices without an edge included."""
    return Graph(to_vertices(nodes), ways_to_edges(ways))


def written(graph: Graph) -> Graph:
    """The same graph read from tables in the shared folder, for use in several passes."""
    folder = scratch_path(graph.edges.sparkSession, "graph")
    return Graph(
        materialise(graph.vertices, f"{folder}/vertices"), materialise(graph.edges, f"{folder}/edges")
    )


def endpoints(edges: DataFrame) -> DataFrame:
    """Every id that starts or ends an edge, once."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def drop_isolated(graph: Graph) -> Graph:
    """Keep the vertices that start or end an edge."""
    return Graph(graph.vertices.join(endpoints(graph.edges), "id", "left_semi"), graph.edges)


def adjacency(graph: Graph, part_size: int | None = None) -> DataFrame:
    """Distinct neighbours of every vertex in rows ``id, part, dsts``, sorted within.

    A vertex has one row, with ``part`` 0. With ``part_size`` it has as many rows as it takes for at most so many
    neighbours in each. A vertex without outgoing edges has an empty list. A neighbour need not be a vertex itself.
    Copies of an edge are dropped before its neighbours are brought together.
    """
    pairs = graph.edges.select(F.col("src").alias("id"), "dst").distinct()
    part = F.lit(0)
    if part_size:
        place = F.row_number().over(Window.partitionBy("id").orderBy("dst"))
        part = F.floor((place - 1) / part_size).cast("int")
    lists = pairs.withColumn("part", part).groupBy("id", "part").agg(F.array_sort(F.collect_list("dst")).alias("dsts"))
    ids = graph.vertices.select("id").distinct()
    dsts = F.coalesce("dsts", F.array().cast("array<bigint>")).alias("dsts")
    return ids.join(lists, "id", "left").select("id", F.coalesce("part", F.lit(0)).alias("part"), dsts)


def adjacency_line(id: Column | str, dsts: Column) -> Column:
    """``id d1 d2 ...``; a vertex without neighbours keeps the blank after its id."""
    return F.concat_ws(" ", F.col(id) if isinstance(id, str) else id,
                       F.concat_ws(" ", dsts.cast("array<string>")))


def with_edge_length(graph: Graph) -> DataFrame:
    """Edges with ``length_m``, the distance between their ends; null where an end is no vertex."""
    points = graph.vertices.select("id", "lat", "lon")
    n = points.count()
    edges = graph.edges.select("src", "dst")
    for end in ("src", "dst"):
        ends = points.select(
            F.col("id").alias(end), F.col("lat").alias(f"{end}_lat"), F.col("lon").alias(f"{end}_lon")
        )
        edges = sized_join(edges, ends, [end], "left", n)
    length = haversine_m(*map(F.col, ("src_lat", "dst_lat", "src_lon", "dst_lon")))
    return edges.select("src", "dst", length.alias("length_m"))
