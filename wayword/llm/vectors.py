"""Vectors in blocks, and top lists that are merged as a tree."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise, scratch_path

# Vectors in one block of queries and in one shard of candidates. Two blocks lie in a tile's memory.
QUERY_BLOCK = 512
SHARD = 4096

# All query blocks together are broadcast up to so many bytes; beyond it they are repeated per salt and shuffled.
BROADCAST_BYTES = 64_000_000

# So many top lists are merged by one group of the tree.
FAN_IN = 32

BLOCK_SCHEMA = "dim int, block bigint, n int, ids binary, matrix binary"


def usable_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` with one row per id: finite vectors of doubles that have no null component.

    Rows without an id or with an empty vector take no part. Of rows that share an id the smallest vector counts.
    """
    vec = F.col(vec_col).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), bad.alias("bad"))
    usable = usable.where("id IS NOT NULL AND size(vec) > 0 AND NOT bad")
    return usable.groupBy("id").agg(F.min("vec").alias("vec"))


def pack(vectors: DataFrame, block: int, stretch: float = float("inf")) -> DataFrame:
    """Blocks of at most ``block`` vectors of one length: ``dim, block, n, ids, matrix``. No shuffle.

    A block also ends before a vector whose norm is more than ``stretch`` times that of its first one.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, np.ndarray]]] = {}
        made = 0

        def flush(dim: int) -> pa.RecordBatch:
            nonlocal made
            rows = waiting.pop(dim)
            ids = np.array([i for i, _ in rows], dtype=np.int64)
            matrix = np.stack([v for _, v in rows])
            number = (TaskContext.get().partitionId() << 32) + made
            made += 1
            return pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([dim], pa.int32()),
                    "block": pa.array([number], pa.int64()),
                    "n": pa.array([len(rows)], pa.int32()),
                    "ids": pa.array([ids.tobytes()], pa.binary()),
                    "matrix": pa.array([matrix.tobytes()], pa.binary()),
                }
            )

        for batch in batches:
            vecs = batch.column("vec")
            flat, ends = vecs.values.to_numpy(zero_copy_only=False), vecs.offsets.to_numpy()
            for row, key in enumerate(batch.column("id").to_pylist()):
                vec = flat[ends[row] : ends[row + 1]]
                first = waiting.get(len(vec))
                if first and stretch < float("inf") and vec @ vec > stretch**2 * (first[0][1] @ first[0][1]):
                    yield flush(len(vec))
                waiting.setdefault(len(vec), []).append((key, vec))
                if len(waiting[len(vec)]) == block:
                    yield flush(len(vec))
        for dim in sorted(waiting):
            yield flush(dim)

    return vectors.select("id", "vec").mapInArrow(blocks, BLOCK_SCHEMA)


def unpack(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{prefix}ids"], dtype=np.int64)
    return ids, np.frombuffer(row[f"{prefix}matrix"], dtype=np.float64).reshape(len(ids), -1)


def tiles(queries: DataFrame, shards: DataFrame) -> DataFrame:
    """Every query block next to every shard of the same vector length, one row per tile.

    Both sides are written tables. The blocks are broadcast where their bytes, which are counted, allow it.
    Otherwise a copy of them goes to every salt and a shard to one salt, so that all tasks take part.
    """
    named = [F.col(c).alias(f"q_{c}") for c in queries.columns if c != "dim"]
    blocks = queries.select("dim", *named)
    size = queries.agg(F.coalesce(F.sum(F.length("matrix")), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        return shards.join(F.broadcast(blocks), "dim")
    salts = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = shards.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)))
    copies = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted.join(copies, ["dim", "salt"])


def tile_lists(found: list[tuple[int, int, np.ndarray, np.ndarray]]) -> dict:
    """Columns of one Arrow batch of top lists ``query_id, block, ids, scores``."""
    return {
        "query_id": pa.array([f[0] for f in found], pa.int64()),
        "block": pa.array([f[1] for f in found], pa.int64()),
        "ids": pa.array([f[2] for f in found], pa.list_(pa.int64())),
        "scores": pa.array([f[3] for f in found]),
    }


def merge_top(lists: DataFrame, k: int, n_shards: int, spark_name: str) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of all lists of a query.

    The lists are merged in groups of about ``FAN_IN`` until one per query is left. Ties go to the smaller id.
    """
    spark = lists.sparkSession
    top = F.transform(
        F.arrays_zip("scores", "ids"), lambda x: F.struct((-x["scores"]).alias("less"), x["ids"].alias("vec_id"))
    )
    lists = materialise(lists.select("query_id", "block", top.alias("top")), scratch_path(spark, spark_name))
    groups = n_shards
    while True:
        groups = math.ceil(groups / FAN_IN)
        node = F.pmod(F.xxhash64("block"), F.lit(groups))
        merged = lists.groupBy("query_id", node.alias("block")).agg(F.flatten(F.collect_list("top")).alias("top"))
        lists = merged.withColumn("top", F.slice(F.array_sort("top"), 1, k))
        if groups <= 1:
            break
    ranked = lists.select("query_id", F.posexplode("top").alias("pos", "x"))
    return ranked.select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.less")).alias("score")
    )


