"""Join of texts whose sets of word n-grams are similar, by chosen paths.

1. Every text becomes the set of its five-word shingles (of lower-case words), a signature of ``COORDINATES`` minimum
   hashes, and a digest of the set. Texts with the same set are one class and go on as one.
2. A run starts with all classes in one node. A node draws some coordinates, each with probability
   ``1 / (similarity * COORDINATES)``, and sends a class to one child per drawn coordinate, named by the class's value
   there. Nodes with one class end. Nodes above ``LEAF`` classes are split again, up to ``DEPTH`` times.
3. In the remaining nodes all signatures are compared, in tiles of bounded size, and similar ones are linked. The runs
   are repeated until a pair at the threshold would be found with probability ``RECALL``. The runs after the first ones
   skip nodes whose classes are connected already.
4. Inside each group that is connected so far, all pairs of sets are compared exactly, again in tiles: products of the
   matrices of shared shingles. No list of pairs is made; a tile gives the number of links of every class and a forest
   of what is linked.

Texts of one to four words have one shingle, the whole text. Null texts and texts without words resemble nothing, not
even each other. Rows may share a key: they are told apart by their text; equal rows are copies of each other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialise, materialise_counted, scratch_path
from .arrow import with_columns_of_texts
from .components import by_count, connected

SHINGLE = 5
SIMILARITY = 0.8
COORDINATES = 64
RECALL = 0.995
DEPTH = 3

# Classes in a node that are compared without a further split, and in one side of a tile.
LEAF = 1024
TILE = 256

# Runs after which nodes inside one connected group are skipped.
FIRST_RUNS = 3

# Signatures are linked from so many standard deviations below the similarity on.
SLACK = 3.0

# Words whose hashes a task remembers, and shingles that are hashed at once.
REMEMBERED = 500_000
CHUNK = 8192

# Odd multipliers of a common 64-bit finaliser, and one that spreads numbers.
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Turns texts into sorted sets of shingle hashes, and remembers the hashes of words."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.lower().split() if text else []
        if not words:
            return np.empty(0, dtype=np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        n = min(SHINGLE, len(words))
        total = np.full(len(words) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            total = total * SPREAD + hashes[i : len(words) - n + 1 + i]
        return np.unique(mix(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of every coordinate's hash over the set."""
    factors, offsets = coordinate_hashes()
    least = np.full(COORDINATES, 2**32 - 1, dtype=np.uint64)
    for a in range(0, len(shingles), CHUNK):
        part = shingles[a : a + CHUNK, None] * factors + offsets
        np.minimum(least, (part >> np.uint64(32)).min(axis=0), out=least)
    return least.astype(np.uint32)


_HASHES: list[tuple[np.ndarray, np.ndarray]] = []


def coordinate_hashes() -> tuple[np.ndarray, np.ndarray]:
    if not _HASHES:
        seeds = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * SPREAD)
        _HASHES.append((seeds[:COORDINATES] | np.uint64(1), seeds[COORDINATES:]))
    return _HASHES[0]


def sketches(df: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """``doc, place, class, n, sig`` for every row; ``class`` is null for texts without words."""

    def start():
        shingles = Shingles()

        def sketch(texts):
            out: dict[str, list] = {"class": [], "n": [], "sig": []}
            for text in texts:
                found = shingles(text)
                out["n"].append(len(found))
                out["class"].append(xxhash.xxh128_digest(found.tobytes()) if len(found) else None)
                out["sig"].append(signature(found).tobytes() if len(found) else None)
            return out

        return sketch

    rows = df.select(F.col(key_col).alias("doc"), F.xxhash64(text_col).alias("place"), F.col(text_col).alias("text"))
    made = {"class": ("binary", pa.binary()), "n": ("int", pa.int32()), "sig": ("binary", pa.binary())}
    return with_columns_of_texts(rows, "text", ["doc", "place"], made, start)


def runs_needed(recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold was in a common node of the last level with this probability.

    The common nodes of such a pair are a branching process with one child on average.
    """
    together = 1.0
    for _ in range(depth):
        together = 1 - math.exp(-together)
    return math.ceil(math.log(1 - recall) / math.log(1 - together))


def children(nodes: DataFrame, similarity: float, schema: str) -> DataFrame:
    """``node, class`` one level further down; ``nodes`` has ``node, class, sig``."""
    chance = np.uint64(int(2**64 / (similarity * COORDINATES)))
    numbers = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * SPREAD)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint32)
            sig = sig.reshape(-1, COORDINATES).astype(np.uint64)
            row, drawn = np.nonzero(mix(node[:, None] ^ numbers) < chance)
            child = mix(node[row] * SPREAD + mix(sig[row, drawn] * SPREAD + drawn.astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(child.view(np.int64)), batch.column("class").take(pa.array(row))], names=["node", "class"]
            )

    return nodes.select("node", "class", "sig").mapInArrow(split, schema)


def forest(linked: np.ndarray) -> np.ndarray:
    """The first row connected to each row of a symmetric matrix of links."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label, len(label)).min(axis=1)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def tiled(rows: DataFrame, group: str, block: int, sizes: DataFrame, n_rows: int) -> DataFrame:
    """Rows with the tiles ``pack, i, j`` they take part in, and their block.

    ``sizes`` has the rows ``n_group`` of each group. A group of up to ``block`` rows is one tile, and small groups share
    a pack. A larger group has a tile for each two of its blocks.
    """
    n_sizes = sizes.count()
    rows = rows.join(by_count(sizes, n_sizes), group)
    blocks = F.ceil(F.col("n_group") / F.lit(block)).cast("int")
    rows = rows.withColumn("blocks", blocks)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("class", F.lit(7)), F.col("blocks")).cast("int"))
    packs = max(1, math.ceil(n_rows / block))
    pack = F.when(F.col("blocks") > 1, F.xxhash64(group)).otherwise(F.pmod(F.xxhash64(group), F.lit(packs)))
    rows = rows.withColumns({"pack": pack, "other": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))})
    return rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})


def over_tiles(rows: DataFrame, group: str, schema: str,
               compare: Callable[[list[bytes], list[int]], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``class, root, links`` of every tile: how many are linked, and the first class connected in the tile."""

    def tile(table: pa.Table) -> pa.Table:
        table = table.sort_by([(group, "ascending"), ("class", "ascending")])
        groups = table.column(group).to_pylist()
        names, data = table.column("class").to_pylist(), table.column("data").to_pylist()
        block = table.column("block").to_numpy()
        cross = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        out: dict[str, list] = {"class": [], "root": [], "links": []}
        a = 0
        while a < len(groups):
            b = a
            while b < len(groups) and groups[b] == groups[a]:
                b += 1
            if b - a > 1:
                linked = compare(data[a:b])
                np.fill_diagonal(linked, False)
                if cross:
                    linked &= block[a:b, None] != block[None, a:b]
                counts, root = linked.sum(axis=1), forest(linked)
                for at in np.flatnonzero(counts):
                    out["class"].append(names[a + at])
                    out["root"].append(names[a + root[at]])
                    out["links"].append(int(counts[at]))
            a = b
        kinds = {"class": pa.binary(), "root": pa.binary(), "links": pa.int64()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})

    return rows.select("pack", "i", "j", "block", group, "class", "data").groupBy("pack", "i", "j").applyInArrow(tile, schema)


TILE_SCHEMA = "class binary, root binary, links bigint"


def similar_signatures(least: int) -> Callable:
    def compare(data: list[bytes]) -> np.ndarray:
        sig = np.frombuffer(b"".join(data), dtype=np.uint32).reshape(-1, COORDINATES)
        same = np.zeros((len(sig), len(sig)), dtype=np.uint8)
        for c in range(COORDINATES):
            same += sig[:, c, None] == sig[None, :, c]
        return same >= least

    return compare


def similar_sets(similarity: float) -> Callable:
    def compare(data: list[bytes]) -> np.ndarray:
        sets = [np.frombuffer(d, dtype=np.uint64) for d in data]
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        common = shared(sets)
        return common * (1 + similarity) >= similarity * (sizes[:, None] + sizes[None, :]) - 1e-6

    return compare


def shared(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all intersections, by products of the 0-1 matrices of the shingles that several sets have."""
    common = np.zeros((len(sets), len(sets)))
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    lengths = np.diff(np.append(starts, len(every)))
    number = np.repeat(np.cumsum(lengths > 1) - 1, lengths)
    several = np.repeat(lengths > 1, lengths)
    number, owner = number[several], owner[several]
    for a in range(0, int(number[-1]) + 1 if len(number) else 0, columns):
        low, high = np.searchsorted(number, [a, a + columns])
        matrix = np.zeros((len(sets), columns), dtype=np.float32)
        matrix[owner[low:high], number[low:high] - a] = 1
        common += matrix @ matrix.T
    return common


class Join:
    """The steps of one join; every step is a table in the shared folder."""

    def __init__(self, df: DataFrame, key_col: str, text_col: str, similarity: float):
        self.df, self.key_col, self.text_col, self.similarity = df, key_col, text_col, similarity
        self.spark = df.sparkSession
        self.folder = scratch_path(self.spark, "jaccard")
        self.rows = self.write(sketches(df, key_col, text_col), "rows")
        first = F.min(F.struct("doc", "place"))
        classes = self.rows.where("class IS NOT NULL").groupBy("class").agg(
            first.alias("first"), F.count("*").alias("n_copies"), F.first("sig").alias("sig")
        )
        self.classes = self.write(classes.select("class", "first.doc", "first.place", "n_copies", "sig"), "classes")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return materialise(df, f"{self.folder}/{name}")

    def leaves(self, runs: range, groups: DataFrame | None, n_groups: int) -> DataFrame:
        """``node, class`` of the last nodes of some runs that hold several classes (of several groups)."""
        kind = self.classes.schema["class"].dataType.simpleString()
        schema = f"node bigint, class {kind}"
        roots = mix(np.arange(runs.start + 1, runs.stop + 1, dtype=np.uint64) * SPREAD).view(np.int64).tolist()
        start = F.explode(F.array(*[F.lit(r) for r in roots])).alias("node")
        above = self.classes.select(start, "class", "sig")
        found = None
        for depth in range(1, DEPTH + 1):
            name = f"level-{runs.start}-{depth}"
            level = self.write(children(above, self.similarity, schema).distinct(), name)
            labelled = level.withColumn("group", F.col("class"))
            if groups is not None:
                known = by_count(groups.select(F.col("id").alias("class"), "root"), n_groups)
                labelled = level.join(known, "class", "left").withColumn("group", F.coalesce("root", "class"))
            sizes = labelled.groupBy("node").agg(
                F.count("*").alias("n"), F.min("group").alias("low"), F.max("group").alias("high")
            )
            sizes, n_sizes = materialise_counted(
                sizes.where("n > 1 AND low <> high").select("node", "n"), f"{self.folder}/{name}-sizes"
            )
            kept = level.join(by_count(sizes, n_sizes), "node")
            large = F.lit(depth < DEPTH) & (F.col("n") > LEAF)
            done = kept.where(~large).select("node", "class")
            found = done if found is None else found.unionByName(done)
            above = kept.where(large).join(self.classes.select("class", "sig"), "class").select("node", "class", "sig")
            if depth < DEPTH and not sizes.where(F.col("n") > LEAF).count():
                break
        return found

    def candidates(self) -> tuple[DataFrame, int]:
        """``id, root`` of the groups connected by similar signatures."""
        deviation = math.sqrt(self.similarity * (1 - self.similarity) / COORDINATES)
        least = math.floor(COORDINATES * (self.similarity - SLACK * deviation))
        n_runs = runs_needed(RECALL, DEPTH)
        links, groups, n_groups = None, None, 0
        for runs in (range(0, FIRST_RUNS), range(FIRST_RUNS, n_runs)):
            leaves, n_leaves = materialise_counted(
                self.leaves(runs, groups, n_groups), f"{self.folder}/leaves-{runs.start}"
            )
            sizes = self.write(leaves.groupBy("node").agg(F.count("*").alias("n_group")), f"sizes-{runs.start}")
            tiles = tiled(leaves, "node", LEAF, sizes, n_leaves)
            tiles = tiles.join(self.classes.select("class", F.col("sig").alias("data")), "class")
            found = over_tiles(tiles, "node", TILE_SCHEMA, similar_signatures(least))
            found = self.write(found.where("class <> root").select("class", "root").distinct(), f"near-{runs.start}")
            links = found if links is None else links.unionByName(found)
            groups, n_groups = materialise_counted(connected(links, "class", "root"), f"{self.folder}/groups-{runs.start}")
        return groups, n_groups

    def sets(self, members: DataFrame, n_members: int) -> DataFrame:
        """Members with the set of their text in ``data``; only their texts are read again."""
        rows = self.df.select(
            F.col(self.key_col).alias("doc"), F.xxhash64(self.text_col).alias("place"),
            F.col(self.text_col).alias("text"),
        )
        same = rows["doc"].eqNullSafe(members["doc"]) & (rows["place"] == members["place"])
        chosen = rows.join(by_count(members, n_members), same).select(members["group"], members["class"], rows["text"])

        def start():
            shingles = Shingles()
            return lambda texts: {"data": [shingles(t).tobytes() for t in texts]}

        made = {"data": ("binary", pa.binary())}
        # Copies of the row that stands for a class give the same set.
        return with_columns_of_texts(chosen, "text", ["group", "class"], made, start)

    def links(self) -> tuple[DataFrame, DataFrame]:
        """``class, n_links``, and ``id, root`` of the groups that exact links connect."""
        groups, n_groups = self.candidates()
        members = groups.select(F.col("id").alias("class"), F.col("root").alias("group"))
        members = self.write(members.join(self.classes.select("class", "doc", "place"), "class"), "members")
        sizes = self.write(members.groupBy("group").agg(F.count("*").alias("n_group")), "group-sizes")
        sets = self.write(self.sets(members, n_groups).dropDuplicates(["class"]), "sets")
        tiles = tiled(sets, "group", TILE, sizes, n_groups)
        found = self.write(over_tiles(tiles, "group", TILE_SCHEMA, similar_sets(self.similarity)), "links")
        counts = found.groupBy("class").agg(F.sum("links").alias("n_links"))
        return counts, connected(found, "class", "root")


def similar_texts(df: DataFrame, key_col: str = "doc_id", text_col: str = "text",
                  similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``df``: its key, ``class_id``, ``copy_id``, ``n_links``, ``n_copies``, ``place``, ``first``.

    ``class_id`` is the smallest key among all texts that links connect with this one, ``copy_id`` the smallest key
    among those with the same set; ``n_links`` counts the other sets that are similar to this one, ``n_copies`` the rows
    with the same set. ``place`` tells rows with the same key apart, and ``first`` says whether the row (or one equal to
    it) stands for its connected group.
    """
    join = Join(df, key_col, text_col, similarity)
    counts, roots = join.links()
    classes = join.classes.drop("sig").join(counts, "class", "left")
    classes = classes.join(roots.withColumnRenamed("id", "class"), "class", "left")
    classes = join.write(classes.withColumn("root", F.coalesce("root", "class")), "classes-linked")
    first = F.min(F.struct("doc", "place")).alias("first")
    groups = classes.where("n_links > 0").groupBy("root").agg(first)
    groups = groups.select("root", F.col("first").alias("group_first"))
    own = F.struct(F.col("doc"), F.col("place"))
    classes = classes.join(groups, "root", "left").select(
        "class", F.col("doc").alias("copy_id"), "n_links", "n_copies", F.coalesce("group_first", own).alias("head")
    )
    rows = join.rows.select("doc", "place", "class").join(classes, "class", "left")
    alone = F.col("class").isNull()
    head = F.col("head")
    return rows.select(
        F.col("doc").alias(key_col),
        F.when(alone, F.col("doc")).otherwise(head["doc"]).alias("class_id"),
        F.when(alone, F.col("doc")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        "place",
        (alone | (F.col("doc").eqNullSafe(head["doc"]) & (F.col("place") == head["place"]))).alias("first"),
    )


def one_of_each_group(df: DataFrame, key_col: str = "doc_id", text_col: str = "text",
                      similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` without those that repeat another text; the smallest key of each connected group stays.

    Of equal rows one stays. Texts without words all stay.
    """
    judged = similar_texts(df, key_col, text_col, similarity).where("first")
    judged = judged.groupBy(F.col(key_col).alias("doc"), "place").agg(F.count("*").alias("n_rows"))
    judged = materialise(judged, scratch_path(df.sparkSession, "jaccard-first"))
    # The row is one column meanwhile, so that no name of it can be mistaken.
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(key_col).alias("key"),
        F.xxhash64(text_col).alias("here"), F.coalesce(F.rlike(text_col, F.lit(r"\S")), F.lit(False)).alias("has_words"),
    )
    same = F.col("key").eqNullSafe(F.col("doc")) & (F.col("here") == F.col("place"))
    kept = rows.join(by_count(judged, judged.count()), same)
    # Equal rows have their own branch, so that only they are moved to be made one.
    repeated = (F.col("n_rows") > 1) & F.col("has_words")
    single = kept.where(~repeated).select("row.*")
    return single.unionByName(kept.where(repeated).dropDuplicates(["doc", "place"]).select("row.*"))
