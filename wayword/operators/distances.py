"""Shortest paths by length, for all pairs in one loop.

Every end has a search, which goes backward from it; a label is the least length from a vertex to the end, then the fewest
edges of that length, then the smallest next vertex. The graph is cut into blocks of near vertices with so many edges.
A search is settled within a block at a time, by Dijkstra's algorithm (``reach``), and moves on with the labels of the
edges that leave the block; a block is visited again when one of its labels gets better. So a round is a step from block
to block and not from vertex to vertex. It moves the labels at borders, and the edges of the blocks that have any.

Searches go as far as the current limit, in rounds until no label gets better; labels below the limit are final then and
pairs whose start has one are done. The limit grows by a factor, and only searches go on that have an open pair and were
cut. A search that has its starts in the block of its end needs no limit: it runs until it has them, and no farther.

Labels at borders are kept, those within a block are not. A start that is found comes with the vertices up to the border
of its block. The rest of a path that leaves it is found by settling the next block again, now from final labels.

Vertices are dealt to blocks by their ids and by their places, and that of the two is taken which cuts fewer edges. The
edges of hubs are parted, and so are the searches of a block that has very many. Lengths are whole millimetres, so their
sums are exact.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..session import discard, materialise_counted, scratch_path
from . import skew
from .graph import Graph, written, with_edge_length
from .paths import FRONT_BYTES, ROW_BYTES
from .reach import CUT, EDGE, FOUND, OUT, SCHEMA, explorer
from .skew import hot_keys, n_salts, replicate, sized_join

KEY = ["search", "node"]
PAIR = ["src", "dst"]
UNIT = ["search", "block"]
GROUP = ["block", "salt", "part"]

# What a label is compared by, and what else it holds: where it enters, where it comes from.
LABEL = ["length", "hops", "next", "block", "parts", "via"]

# The first limit in mean edge lengths, unless the caller gives one, and what it grows by.
WIDTH = 2
GROWTH = 4

# A block has about so many edges, which are in the memory of a task.
BLOCK_EDGES = 25_000


def cell(lat: Column, lon: Column) -> Column:
    """The place in a grid of 65,536 times as many cells, along a curve on which near cells are mostly near."""

    def spread(degrees: Column, half: int) -> Column:
        step = F.floor((degrees + half) / (2 * half) * 65_536).cast("long")
        bits = F.greatest(F.lit(0), F.least(F.lit(65_535), step)).cast("long")
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return bits

    return spread(lon, 180).bitwiseOR(F.shiftleft(spread(lat, 90), 1))


class _Labels:
    """The tables of one call: the blocks with their edges, the labels at borders, and the open pairs."""

    def __init__(self, graph: Graph, pairs: DataFrame, width_m: float | None):
        self.spark = pairs.sparkSession
        self.folder = scratch_path(self.spark, "distances")
        self.name = f"wayword_distances_{uuid.uuid4().hex}"
        self.n_buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.made: list[str] = []
        self.rounds = self.rows = self.sweeps = 0
        self.first = self.write_edges(graph, width_m)
        wanted = pairs.select(*PAIR).where("src IS NOT NULL AND dst IS NOT NULL").distinct()
        for end in PAIR:
            home = self.homes.select(F.col("id").alias(end), F.col("block").alias(f"{end}_block"))
            wanted = sized_join(wanted, home, [end], "inner", self.n_homes)
        self.open, self.n_open = self.write(wanted, "wanted")
        self.closed: list[DataFrame] = []
        starts = self.open.select(F.col("dst").alias("search"), F.col("dst").alias("node"), F.col("dst_block").alias("block"))
        nothing = F.lit(None).cast("long")
        starts = starts.distinct().withColumn("parts", n_salts(["node"], self.hot).cast("long"))
        zero = F.lit(0).cast("long")
        self.add(starts.withColumns({"length": zero, "hops": zero, "next": nothing, "via": nothing, "most": nothing}))

    def write(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        self.made.append(name)
        return materialise_counted(df, f"{self.folder}/{name}")

    def write_homes(self, vertices: DataFrame, n_edges: int) -> DataFrame:
        """``id, by_id, by_place``: the block of every vertex, of as many in both orders."""
        places = vertices.where("id IS NOT NULL").groupBy("id").agg(F.min(cell(F.col("lat"), F.col("lon"))).alias("place"))
        places, self.n_homes = self.write(places, "places")
        self.n_blocks = max(1, math.ceil(max(n_edges, self.n_homes) / BLOCK_EDGES))
        block = F.spark_partition_id().cast("long")
        by_id = places.repartitionByRange(self.n_blocks, "id").select("id", "place", block.alias("by_id"))
        by_id, _ = self.write(by_id, "by-id")
        by_place = by_id.repartitionByRange(self.n_blocks, "place", "id").select("id", "by_id", block.alias("by_place"))
        return self.write(by_place, "homes")[0]

    def write_edges(self, graph: Graph, width_m: float | None) -> int:
        """The blocks with the shortest of parallel edges by the vertex they lead to; the first limit in millimetres."""
        roads = graph.edges.select(*PAIR).where("src <> dst").distinct()
        measured = with_edge_length(Graph(graph.vertices, roads)).where("length_m IS NOT NULL")
        length = F.round(F.col("length_m") * 1000).cast("long")
        edges = measured.groupBy(*PAIR).agg(F.min(length).alias("length"))
        seen = Observation()
        edges, n = self.write(edges.observe(seen, F.avg("length").alias("mean")), "edges")
        homes = self.write_homes(graph.vertices, n)
        for end in PAIR:
            home = homes.select(F.col("id").alias(end), *(F.col(c).alias(f"{end}_{c}") for c in ("by_id", "by_place")))
            edges = sized_join(edges, home, [end], "inner", self.n_homes)
        cuts = Observation()
        cut = (F.count_if(F.col(f"src_{c}") != F.col(f"dst_{c}")).alias(c) for c in ("by_id", "by_place"))
        edges, _ = self.write(edges.observe(cuts, *cut), "edges-at-home")
        order = min(("by_id", "by_place"), key=lambda c: cuts.get[c])
        self.homes = homes.select("id", F.col(order).alias("block"))
        self.hot = hot_keys(edges, ["dst"])
        salt = F.pmod(F.xxhash64("src"), n_salts(["dst"], self.hot)).cast("long").alias("salt")
        edges = edges.select(
            F.col(f"dst_{order}").alias("block"), salt, F.col("dst").alias("node"), F.col("src").alias("to"), "length",
            F.col(f"src_{order}").alias("to_block"), n_salts(["src"], self.hot).cast("long").alias("to_parts"),
        )
        lists = F.collect_list(F.struct(*EDGE)).alias("ways")
        blocks = edges.groupBy("block", "salt").agg(lists).select("block", "salt", *(F.col(f"ways.{c}") for c in EDGE))
        self.blocks, self.n_parts = self.write(blocks, "blocks")
        return max(1, round(1000 * width_m if width_m else WIDTH * (seen.get["mean"] or 0)))

    def add(self, labels: DataFrame) -> int:
        """Write the labels of a round; how many there are."""
        seen = Observation()
        counted = labels.select(*KEY, *LABEL, "most").observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = counted.withColumn("round", F.lit(self.rounds)).write.format("parquet").mode("append")
        writer = writer.partitionBy("round").bucketBy(self.n_buckets, *KEY)
        writer.option("path", f"{self.folder}/labels").saveAsTable(f"{self.name}_labels")
        self.rounds += 1
        self.rows = seen.get["rows"]
        return self.rows

    def labels(self) -> DataFrame:
        return self.spark.table(f"{self.name}_labels")

    def best(self) -> DataFrame:
        """The best label of every search and vertex; rows are grouped where they lie."""
        best = self.labels().groupBy(*KEY).agg(F.min(F.struct(*LABEL)).alias("label"), F.min("most").alias("most"))
        return best.select(*KEY, "label.*", "most")

    def of_units(self, rows: DataFrame, units: DataFrame, n: int) -> DataFrame:
        """Rows of so many units with the columns of these. Few units are broadcast."""
        return rows.join(F.broadcast(units) if n * ROW_BYTES <= FRONT_BYTES else units, UNIT)

    def sweep(
        self, units: DataFrame, n: int, targets: DataFrame, limit: int | None, cap: int | float = math.inf
    ) -> tuple[DataFrame, dict[str, int]]:
        """Settle searches in blocks, and how many rows of each kind there are; see ``reach``.

        ``units`` has ``search, block, open``, at most ``n`` of them, ``targets`` ``search, block, node``. Without a limit
        only the targets count.
        """
        self.sweeps += 1
        doors = replicate(self.of_units(self.best(), units, n), F.col("parts")).withColumnRenamed("_salt", "salt")
        asked = self.of_units(targets, units, n).withColumn("salt", F.lit(0).cast("long"))
        front = doors.unionByName(asked, allowMissingColumns=True)
        front, rows = self.write(front, f"front-{self.sweeps}")
        parts = n_salts(["block"], hot_keys(front, ["block"]) if rows > skew.HOT_ROWS else {})
        front = front.withColumn("part", F.pmod(F.xxhash64("search"), parts).cast("long"))
        blocks = replicate(self.blocks, parts).withColumn("part", F.col("_salt").cast("long")).drop("_salt")
        blocks = sized_join(blocks, front.select(*GROUP).distinct(), GROUP, "left_semi", min(n, self.n_parts))
        # What takes time are the searches, so groups are dealt to tasks by their number and not by bytes.
        dealt = max(self.n_buckets, self.n_parts)
        both = (df.repartition(dealt, *GROUP).groupBy(*GROUP) for df in (front, blocks))
        swept = next(both).cogroup(next(both)).applyInArrow(explorer(limit, cap, self.rounds == 1), SCHEMA)
        seen = Observation()
        found, outs, cuts = (F.col("kind") == kind for kind in (FOUND, OUT, CUT))
        swept = swept.observe(
            seen, F.count_if(found).alias("found"), F.count_if(outs).alias("outs"), F.count_if(cuts).alias("cuts"),
            F.count_if(found & F.col("next").isNotNull()).alias("further"), F.min(F.when(cuts, F.col("length"))).alias("cut"),
            F.coalesce(F.sum(F.size("piece")), F.lit(0)).alias("vertices"),
        )
        return self.write(swept, f"swept-{self.sweeps}")[0], seen.get

    def better(self, swept: DataFrame) -> DataFrame:
        """The labels at borders that are better than those known."""
        label = F.struct(*LABEL)
        steps = swept.where(F.col("kind") == OUT).groupBy(*KEY).agg(F.min(label).alias("step"), F.min("most").alias("most"))
        known = self.labels().groupBy(*KEY).agg(F.min(label).alias("label"))
        better = steps.join(known, KEY, "left").where("label IS NULL OR step < label")
        return better.select(*KEY, "step.*", "most")

    def of_open(self, units: DataFrame) -> DataFrame:
        """``search, block, open`` of the searches that have so many open pairs, if any."""
        searches = self.open.groupBy(F.col("dst").alias("search")).agg(F.count(F.lit(1)).alias("open"))
        return sized_join(units.select(*UNIT).distinct(), searches, ["search"], "inner", self.n_open)

    def run(self, max_m: float | None) -> None:
        cap = math.inf if max_m is None else round(1000 * max_m)
        limit, units, most = min(self.first, cap), self.labels(), self.rows
        while self.n_open:
            swept: list[DataFrame] = []
            cut, found, cuts = math.inf, 0, 0
            while True:
                starts = self.open.select(F.col("dst").alias("search"), F.col("src_block").alias("block"), F.col("src").alias("node"))
                rows, n = self.sweep(self.of_open(units), most, starts, limit, cap)
                swept.append(rows)
                found, cuts = found + n["found"], cuts + n["cuts"]
                cut = min(cut, n["cut"] or math.inf)
                if not n["outs"] or not self.add(self.better(rows)):
                    break
                units, most = self.labels().where(F.col("round") == self.rounds - 1), self.rows
            self.settle(swept, found)
            if cut == math.inf or limit == cap:
                return
            units = reduce(DataFrame.union, (rows.where(F.col("kind") == CUT).select(*UNIT) for rows in swept))
            limit, most = min(cap, max(GROWTH * limit, cut)), cuts

    def settle(self, swept: list[DataFrame], n: int) -> None:
        """Close the pairs whose start has a final label: that of the last time its block was settled."""
        if not n:
            return
        found = reduce(DataFrame.union, (
            rows.where(F.col("kind") == FOUND).select("search", "node", F.struct(F.lit(k).alias("k"), "length", "next", "via", "piece").alias("way"))
            for k, rows in enumerate(swept)
        ))
        found = found.groupBy(F.col("search").alias("dst"), F.col("node").alias("src")).agg(F.max("way").alias("way"))
        way = (F.col(f"way.{c}") for c in ("length", "next", "via", "piece"))
        found, n = self.write(found.select(*PAIR, *way), f"found-{len(self.closed)}")
        self.closed.append(found)
        left = sized_join(self.open, found.select(*PAIR), PAIR, "left_anti", n)
        self.open, self.n_open = self.write(left, f"open-{len(self.closed)}")

    def found(self) -> tuple[DataFrame, int]:
        """``src, dst, length, path`` of the pairs that have a path, and how many vertices their paths have."""
        none = self.spark.createDataFrame([], "src bigint, dst bigint, length bigint, next bigint, via bigint, piece array<bigint>")
        paths, seen = reduce(DataFrame.union, self.closed, none).withColumnRenamed("piece", "path"), Observation()
        while True:
            further, vertices = F.count("next").alias("further"), F.coalesce(F.sum(F.size("path")), F.lit(0)).alias("vertices")
            paths, _ = self.write(paths.observe(seen, further, vertices), f"paths-{self.sweeps}")
            left = seen.get["further"]
            if not left:
                return paths.select(*PAIR, "length", "path"), seen.get["vertices"]
            # Paths that left a block go on in the next one, up to its border.
            at = paths.where("next IS NOT NULL").select(F.col("dst").alias("search"), F.col("via").alias("block"), F.col("next").alias("node"))
            at = at.distinct()
            pieces, n = self.sweep(at.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("open")), left, at, None)
            pieces = pieces.select(
                F.col("search").alias("dst"), F.col("node").alias("next"), F.col("next").alias("then"), F.col("via").alias("to"), "piece"
            )
            joined = sized_join(paths, pieces, ["dst", "next"], "left", n["vertices"])
            path = F.when(F.col("piece").isNull(), F.col("path")).otherwise(F.concat("path", "piece")).alias("path")
            paths, seen = joined.select(*PAIR, "length", F.col("then").alias("next"), F.col("to").alias("via"), path), Observation()

    def close(self) -> None:
        """Forget the tables and delete all but the found paths."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_labels")
        for name in ("labels", *self.made):
            if name != f"paths-{self.sweeps}":
                discard(self.spark, f"{self.folder}/{name}")


def shortest_by_length(
    graph: Graph, pairs: DataFrame, max_m: float | None = None, width_m: float | None = None
) -> DataFrame:
    """The shortest path in metres for every row ``pair_id, src, dst`` of ``pairs``.

    Adds ``length_m`` and ``path``; both are null where there is no path, or none of at most ``max_m`` metres if that is
    given, or an end is no vertex. An edge is as long as the way between its ends, in whole millimetres; it counts only if
    both are vertices with a position. Of several shortest paths it is the one of fewest edges, then the smallest by its
    vertices from the start on. ``width_m`` is the width of the buckets of length: narrow ones relax fewer labels in vain,
    wide ones need fewer rounds.
    """
    labels = _Labels(written(graph), pairs, width_m)
    try:
        labels.run(max_m)
        found, n = labels.found()
    finally:
        labels.close()
    # A path counts as many rows as it has vertices on the average.
    joined = sized_join(pairs, found, PAIR, "left", n)
    return joined.select("pair_id", *PAIR, (F.col("length") / 1000).alias("length_m"), "path")
