"""Search by collision counting.

Every vector is projected on many random lines. For each line a shard keeps its vectors in the order of their
projections. A query opens a window around its own place on every line, and a vector collides with it wherever it lies
in the window. The windows of all lines are widened together (virtual rehashing: the index stays as it is) until enough
vectors of the shard collide on four fifths of the lines; all of these are verified with the true inner product.

The largest inner product is turned into the smallest distance with one more coordinate, which lifts all vectors of a
shard to the norm of its longest one. Shards are ranges of the norm, so one long vector does not flatten the others.

Vectors that are null, zero, empty, or hold a null or non-finite component take no part, neither do rows without an id.
Of rows that share an id the smallest vector counts. Only vectors of the same length are compared. Equal vectors
collide alike, so all or none of them are verified; ties go to the smaller id. Every row is in the index, and nothing
caps how many vectors are verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise, scratch_path
from .topk import best
from .vectors import BLOCK_SCHEMA, QUERY_BLOCK, SHARD, merge_top, pack, tile_lists, tiles, unpack, usable_vectors

# The longest vector of a shard is at most so many times as long as its shortest.
STRETCH = 1.5

# Random lines, and the share of them on which a vector must collide to be verified.
LINES = 64
COLLISIONS = 0.8

# Windows are widened until so many times k vectors and this share of the shard are to be verified.
SPARE = 8
VERIFIED = 0.27

# First half width of a window in units of the longest norm, and the factor by which windows grow.
FIRST_WIDTH = 1.3
GROWTH = 1.06

# Queries of a block that begin at the first width.
SCOUTS = 16


def lines(dim: int, n_lines: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, n_lines))


def index_shards(shards: DataFrame, n_lines: int, seed: int) -> DataFrame:
    """Adds ``longest`` and, line after line, the sorted projections and who they belong to.

    ``longest`` is the largest norm in units of the shard's largest component.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, x = unpack(row)
                # In units of the largest component no square of it is lost or too large, so the longest norm is 1 or more.
                x = x / np.abs(x).max()
                norms = np.sqrt((x * x).sum(axis=1))
                longest = float(norms.max())
                lift = np.sqrt(np.maximum(longest**2 - norms**2, 0))
                places = (np.column_stack([x, lift]) @ lines(row["dim"] + 1, n_lines, seed)).T
                order = np.argsort(places, axis=1, kind="stable")
                row |= {
                    "longest": longest,
                    "places": np.take_along_axis(places, order, axis=1).tobytes(),
                    "owners": order.astype(np.int64).tobytes(),
                }
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema(
        [("dim", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("matrix", pa.binary()),
         ("longest", pa.float64()), ("places", pa.binary()), ("owners", pa.binary())]
    )
    return shards.mapInArrow(index, f"{BLOCK_SCHEMA}, longest double, places binary, owners binary")


def colliding(places: np.ndarray, owners: np.ndarray, at: np.ndarray, least: int, wanted: int, width: float):
    """For every query the vectors that collide with it on at least ``least`` lines, once there are ``wanted``.

    ``places`` and ``owners`` have a row per line, ``at`` has the place of each query on each line. Gives the widths at
    which the queries ended too.
    """
    n_lines, n = places.shape
    n_queries = len(at)
    counts = np.zeros((n_queries, n), dtype=np.int64)
    low = np.zeros((n_queries, n_lines), dtype=np.int64)
    for j in range(n_lines):
        low[:, j] = np.searchsorted(places[j], at[:, j])
    high = low.copy()
    starts = np.arange(n_lines) * n
    flat = owners.reshape(-1)
    found: list = [None] * n_queries
    ended = np.zeros(n_queries)
    open_queries = np.arange(n_queries)
    while len(open_queries):
        left = np.empty((len(open_queries), n_lines), dtype=np.int64)
        right = left.copy()
        for j in range(n_lines):
            left[:, j] = np.searchsorted(places[j], at[open_queries, j] - width, "left")
            right[:, j] = np.searchsorted(places[j], at[open_queries, j] + width, "right")
        still = []
        for row, query in enumerate(open_queries):
            # Only what the wider windows add is counted.
            a, b = (starts + left[row]).tolist(), (starts + np.minimum(low[query], right[row])).tolist()
            c, d = (starts + np.maximum(high[query], left[row])).tolist(), (starts + right[row]).tolist()
            parts = [flat[x:y] for x, y in zip(a, b)] + [flat[x:y] for x, y in zip(c, d)]
            counts[query] += np.bincount(np.concatenate(parts), minlength=n)
            low[query], high[query] = left[row], right[row]
            met = np.flatnonzero(counts[query] >= least)
            if len(met) >= wanted:
                found[query], ended[query] = met, width
            else:
                still.append(query)
        open_queries = np.array(still, dtype=np.int64)
        width *= GROWTH
    return found, ended


def collisions(places: np.ndarray, owners: np.ndarray, at: np.ndarray, least: int, wanted: int, width: float) -> list:
    """``colliding`` for a block: the first queries show at which width the others may begin."""
    found, ended = colliding(places, owners, at[:SCOUTS], least, wanted, width)
    if len(at) > SCOUTS:
        found += colliding(places, owners, at[SCOUTS:], least, wanted, float(np.median(ended)) / GROWTH)[0]
    return found


def near_search(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
                n_lines: int = LINES, verified: float = VERIFIED, seed: int = 42) -> DataFrame:
    """About the ``k`` rows with the largest inner product for every query row, itself left out.

    ``is_query`` is a condition on the column ``id``. Returns ``query_id, rank, vec_id, score``; ``score`` is the inner
    product of the original vectors in double precision. Every query gets ``k`` rows, or all if there are fewer.
    """
    spark = df.sparkSession
    vectors = usable_vectors(df, id_col, vec_col)
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    vectors = vectors.withColumn("norm", norm).where(F.exists("vec", lambda x: x != 0))
    vectors = materialise(vectors.repartitionByRange("norm", "id"), scratch_path(spark, "ann-vectors"))
    queries = materialise(pack(vectors.where(is_query), QUERY_BLOCK), scratch_path(spark, "ann-queries"))
    ranges = vectors.repartitionByRange("norm", "id").sortWithinPartitions("norm", "id")
    shards = materialise(
        index_shards(pack(ranges, SHARD, STRETCH), n_lines, seed), scratch_path(spark, "ann-shards")
    )
    least = max(1, int(n_lines * COLLISIONS))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q = unpack(row, "q_")
                ids, x = unpack(row)
                n = len(ids)
                places = np.frombuffer(row["places"], dtype=np.float64).reshape(n_lines, n)
                owners = np.frombuffer(row["owners"], dtype=np.int64).reshape(n_lines, n)
                longest = row["longest"]
                # A query's length does not change the order of its neighbours.
                unit = q / np.abs(q).max(axis=1, keepdims=True)
                unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
                at = (unit * longest) @ lines(row["dim"] + 1, n_lines, seed)[:-1]
                # One more, as the query may be in the shard itself.
                wanted = min(n, SPARE * k + 1 + int(np.ceil(verified * n)))
                found = []
                met = collisions(places, owners, at, least, wanted, FIRST_WIDTH * longest)
                for i, query in enumerate(q_ids):
                    near = met[i][ids[met[i]] != query]
                    vectors = x[near]
                    rough = vectors @ q[i]
                    if len(near) > k:
                        # What can be among the best, whatever the last bits are.
                        bound = np.partition(rough, len(near) - k)[len(near) - k]
                        keep = rough >= bound - 1e-9 * (np.abs(rough).max() + longest * np.abs(x).max() * np.abs(q[i]).sum())
                        near, vectors = near[keep], vectors[keep]
                    # Summed row by row in one order, so that equal vectors have equal scores.
                    scores = (vectors * q[i]).sum(axis=1)
                    chosen = best(scores, ids[near], k)
                    found.append((query, row["block"], ids[near][chosen], scores[chosen]))
                yield pa.RecordBatch.from_pydict(tile_lists(found))

    schema = "query_id bigint, block bigint, ids array<bigint>, scores array<double>"
    lists = tiles(queries, shards).mapInArrow(search, schema)
    return merge_top(lists, k, max(1, shards.count()), "ann-lists")
