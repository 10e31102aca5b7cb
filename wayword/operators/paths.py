"""Paths with the fewest hops, for all pairs in one loop.

The search goes out from both ends, forward from every start and backward from every end, a level of each at a time. A
pair is found when the newest forward level of its start meets one of the two newest backward levels of its end. So a
search reaches half as far as the path is long, and a level holds only searches that still have a pair to find. A
backward row carries the smallest next vertex on a shortest way to the end. For the first half, the vertices on shortest
ways are traced back from the meeting points to the start, each with its smallest next vertex. Of several shortest paths,
the one that goes from next to next is the smallest by its vertices from the start on. Only numbers are compared and
moved on the way; the paths are put together at the end, one row per pair.

The edges are written once, a row for every node they leave with the nodes they lead to, in buckets of the former, and
every level in buckets of its key. A hop moves its front to the edges and the steps to their buckets; edges and earlier
levels stay where they are, whatever their number. The edges of a node with very many are dealt to several buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..session import discard, materialise_counted, scratch_path
from .graph import Graph, endpoints
from .skew import hot_keys, n_salts, replicate, sized_join

# A front is broadcast up to so many bytes, as counted when it was written.
FRONT_BYTES = 16_000_000

# A row of a front counts as so many bytes.
ROW_BYTES = 32

KEY = ["back", "search", "node"]
BY_BLOCK = ["back", "block", "salt"]

# Paths are written down after so many further vertices, so that a plan does not grow with them.
HOPS_AT_ONCE = 4

# Edges are dealt by blocks of so many ids, since near ids are mostly near on the map: then most steps of a search to one
# vertex are made in one task and become one row before they are moved.
BLOCK = 32


def block_of(node: str) -> Column:
    return F.floor(F.col(node) / BLOCK).cast("bigint").alias("block")


def meet_edges(edges: DataFrame, front: DataFrame, on: list[str], small: bool) -> DataFrame:
    """Rows of ``front`` with those of ``edges`` of the same ``node``, both brought together by ``on``: their blocks.

    The node itself is no key of the join, which would deal the nodes of a block to different tasks.
    """
    front = front.withColumnRenamed("node", "met")
    front = F.broadcast(front) if small else front
    same = F.col("node").between(F.col("met"), F.col("met"))
    return front.join(edges, on).where(same).drop("node")


def _inner_edges(graph: Graph) -> DataFrame:
    """Distinct edges between two different vertices of the graph."""
    edges = graph.edges.select("src", "dst").where("src <> dst").distinct()
    loose = endpoints(edges).join(graph.vertices.select("id"), "id", "left_anti")
    loose, n_loose = materialise_counted(loose, scratch_path(edges.sparkSession, "loose-ends"))
    if n_loose:
        for end in ("src", "dst"):
            edges = sized_join(edges, loose.select(F.col("id").alias(end)), [end], "left_anti", n_loose)
    return edges


class _Search:
    """The search for all requests; every step is a table in the shared folder.

    A level holds ``back, search, node, next``: on the side ``back``, or else on the forward one, the search from or to
    ``search`` first reaches ``node`` there. On the backward side ``next`` is the smallest next vertex on a shortest way
    to the end, null in the end itself; on the forward one only the levels themselves are needed.
    """

    def __init__(self, graph: Graph, pairs: DataFrame, max_hops: int | None):
        self.spark = pairs.sparkSession
        self.folder = scratch_path(self.spark, "paths")
        self.max_hops = max_hops
        # As many buckets as a shuffle has partitions, so that what is shuffled fits them.
        self.n_buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"wayword_paths_{uuid.uuid4().hex}"
        wanted = pairs.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct()
        for end in ("src", "dst"):
            wanted = wanted.join(graph.vertices.select(F.col("id").alias(end)), end, "left_semi")
        self.open, self.n_open = self.write(wanted.select("src", "dst"), "wanted")
        self.write_edges(_inner_edges(graph))
        nowhere = F.lit(None).cast("bigint").alias("next")
        self.counts: list[int] = []
        self.write_level(self.searches().distinct().select("back", "search", F.col("search").alias("node"), nowhere))
        # Meeting points by their forward level, with their backward one.
        self.met: dict[int, DataFrame] = {}

    def write_edges(self, edges: DataFrame) -> None:
        """``back, block, salt, node, tos`` in buckets; ``salt`` parts the edges of a node that has very many."""
        step = F.struct(F.lit(False).alias("back"), F.col("src").alias("node"), F.col("dst").alias("to"))
        step_back = F.struct(F.lit(True).alias("back"), F.col("dst").alias("node"), F.col("src").alias("to"))
        edges, _ = self.write(edges.select(F.inline(F.array(step, step_back))), "edges")
        self.hot = hot_keys(edges, ["back", "node"])
        salt = F.pmod(F.xxhash64("to"), n_salts(["back", "node"], self.hot)).cast("int")
        rows = edges.withColumn("salt", salt).groupBy("back", "node", "salt").agg(F.collect_list("to").alias("tos"))
        rows = rows.withColumn("block", block_of("node")).repartition(self.n_buckets, *BY_BLOCK)
        writer = rows.write.format("parquet").bucketBy(self.n_buckets, *BY_BLOCK).sortBy(*BY_BLOCK)
        writer.option("path", f"{self.folder}/bucketed").saveAsTable(f"{self.name}_edges")

    @property
    def edges(self) -> DataFrame:
        return self.spark.table(f"{self.name}_edges")

    def write_level(self, level: DataFrame) -> int:
        """Add a level to the table of all of them; how many rows it has."""
        seen = Observation()
        counted = level.select(*KEY, "next").observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = counted.withColumn("depth", F.lit(len(self.counts))).write.format("parquet").mode("append")
        writer = writer.partitionBy("depth").bucketBy(self.n_buckets, *KEY)
        writer.option("path", f"{self.folder}/levels").saveAsTable(f"{self.name}_levels")
        self.counts.append(seen.get["rows"])
        return self.counts[-1]

    def close(self) -> None:
        """Forget the tables and delete what the found paths do not read."""
        for name in ("edges", "levels"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{name}")
            discard(self.spark, f"{self.folder}/{name}")
        discard(self.spark, f"{self.folder}/bucketed")

    def write(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        return materialise_counted(df, f"{self.folder}/{name}")

    def level(self, depth: int) -> DataFrame:
        return self.levels().where(F.col("depth") == depth).drop("depth")

    def levels(self) -> DataFrame:
        return self.spark.table(f"{self.name}_levels")

    @property
    def depth(self) -> int:
        return len(self.counts) - 1

    def searches(self) -> DataFrame:
        """``back, search`` of all searches with a pair that is still open."""
        ends = F.array(
            F.struct(F.lit(False).alias("back"), F.col("src").alias("search")),
            F.struct(F.lit(True).alias("back"), F.col("dst").alias("search")),
        )
        return self.open.select(F.inline(ends))

    def run(self) -> None:
        changed = True
        while self.n_open:
            changed = self.meet()
            reached = self.max_hops is not None and 2 * self.depth >= self.max_hops
            if reached or not self.n_open or not self.grow(changed):
                return

    def grow(self, changed: bool) -> int:
        """Add the next level of both sides; how many rows it has."""
        front = self.level(self.depth).drop("next")
        if changed:
            front = sized_join(front, self.searches(), ["back", "search"], "left_semi", 2 * self.n_open)
        # A small front is broadcast; a larger one is moved to the buckets of the edges, which stay.
        front = replicate(front, n_salts(["back", "node"], self.hot)).withColumnRenamed("_salt", "salt")
        front = front.withColumn("block", block_of("node"))
        met = meet_edges(self.edges, front, BY_BLOCK, ROW_BYTES * self.counts[-1] <= FRONT_BYTES)
        met = met.select("back", "search", "met", F.explode("tos").alias("to"))
        steps = met.groupBy("back", "search", F.col("to").alias("node")).agg(F.min(F.col("met")).alias("next"))
        # The steps are dealt by the same key into as many parts as the levels have buckets.
        return self.write_level(steps.join(self.levels().select(KEY), KEY, "left_anti"))

    def meet(self) -> bool:
        """Find the pairs whose newest levels share a vertex; whether there are any."""
        depth = self.depth
        levels = self.levels().where(F.col("depth").between(max(0, depth - 1), depth))
        ahead = levels.where(~F.col("back") & (F.col("depth") == depth)).select(F.col("search").alias("src"), "node")
        behind = levels.where("back").select(F.col("search").alias("dst"), "node", F.col("depth").alias("behind"))
        if self.max_hops is not None:
            behind = behind.where(F.col("behind") + depth <= self.max_hops)
        ahead = sized_join(ahead, self.open, ["src"], "inner", self.n_open)
        points = sized_join(ahead, behind, ["dst", "node"], "inner", sum(self.counts[-2:]))
        points, n = self.write(points.select("src", "dst", "node", "behind"), f"met-{depth}")
        if n:
            self.met[depth] = points
            left = sized_join(self.open, points.select("src", "dst"), ["src", "dst"], "left_anti", n)
            self.open, self.n_open = self.write(left, f"open-{depth}")
        return bool(n)

    def nearest(self, points: DataFrame) -> DataFrame:
        """``src, dst, node, next`` of the meeting points that are on a shortest path: the nearest to the end."""
        least = points.groupBy("src", "dst").agg(F.min("behind").alias("behind"))
        return points.join(least, ["src", "dst", "behind"]).select("src", "dst", "node", F.lit(None).cast("bigint").alias("next"))

    def traced(self) -> list[tuple[DataFrame, int]]:
        """For every forward level ``src, dst, node, next`` of the vertices on shortest paths; no next in meeting points."""
        levels: list[tuple[DataFrame, int]] = []
        for depth in range(max(self.met, default=-1), -1, -1):
            rows = self.nearest(self.met[depth]) if depth in self.met else None
            if levels:
                # One step back, to vertices of the level before.
                on_way, n = levels[-1]
                steps = self.edges.where("back").select("node", "tos")
                back = sized_join(steps, on_way.select("src", "dst", "node"), ["node"], "inner", n)
                back = back.select("src", "dst", "node", F.explode("tos").alias("before"))
                back = back.groupBy("src", "dst", "before").agg(F.min("node").alias("next"))
                level = self.level(depth).where("NOT back")
                level = level.select(F.col("search").alias("src"), F.col("node").alias("before"))
                back = sized_join(back, level, ["src", "before"], "left_semi", self.counts[depth])
                back = back.select("src", "dst", F.col("before").alias("node"), "next")
                rows = back if rows is None else rows.unionByName(back)
            levels.append(self.write(rows, f"on-way-{depth}"))
        return levels[::-1]

    def found(self) -> tuple[DataFrame, int]:
        """``src, dst, path`` of every pair that was found."""
        ahead = self.traced()
        if not ahead:
            return self.spark.createDataFrame([], "src bigint, dst bigint, path array<bigint>"), 0
        # From next to next, first to the meeting point, then to the end. Levels that a path does not touch leave it as it is.
        nexts = [(level, n) for level, n in ahead[:-1]]
        for depth in range(self.depth, 0, -1):
            level = self.level(depth).where("back").select(F.col("search").alias("dst"), "node", "next")
            nexts.append((level, self.counts[depth]))
        paths = ahead[0][0].select("src", "dst", F.array("node").alias("path"))
        for k, (level, rows) in enumerate(nexts, 1):
            at = paths.withColumn("node", F.element_at("path", -1))
            joined = sized_join(at, level, ["src", "dst", "node"] if k < len(ahead) else ["dst", "node"], "left", rows)
            further = F.when(F.col("next").isNull(), F.col("path")).otherwise(F.concat("path", F.array("next")))
            paths = joined.select("src", "dst", further.alias("path"))
            if k % HOPS_AT_ONCE == 0:
                paths, _ = self.write(paths, f"paths-{k}")
        return self.write(paths, "found")


def shortest_paths(graph: Graph, pairs: DataFrame, max_hops: int | None = None) -> DataFrame:
    """A path with the fewest edges for every row ``pair_id, src, dst`` of ``pairs``.

    Adds ``hops`` and ``path``; both are null where there is no path, or none of at most ``max_hops`` edges if that is
    given, or an end is no vertex. Of several shortest paths it is the smallest by its vertices from the start on. Only
    edges between vertices of the graph are walked.
    """
    search = _Search(graph, pairs, max_hops)
    try:
        search.run()
        found, n = search.found()
    finally:
        search.close()
    # A path counts as many rows as it may have vertices.
    joined = sized_join(pairs, found, ["src", "dst"], "left", n * 2 * len(search.counts))
    return joined.select("pair_id", "src", "dst", (F.size("path") - 1).alias("hops"), "path")


def path_line(path: Column | str) -> Column:
    """``a -> b -> c``."""
    path = F.col(path) if isinstance(path, str) else path
    return F.array_join(path.cast("array<string>"), " -> ")
