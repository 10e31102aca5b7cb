"""Exact search: products of query blocks and shards, the best of each tile, and a tree of merged lists.

Vectors that are null, empty, or hold a null or non-finite component take no part, neither do rows without an id. Of
rows that share an id the smallest vector counts. Only vectors of the same length are compared. Ties go to the smaller
id. Without queries or candidates the result is empty. Other columns are not read. A score beyond 64 bits counts as the
largest or smallest one and ties with others beyond them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise, scratch_path
from .vectors import QUERY_BLOCK, SHARD, merge_top, pack, tile_lists, tiles, unpack, usable_vectors

# Sums of whole numbers are exact in a double below this.
EXACT = 2.0**53

# Scores are clamped to this, so that their negative is a 64-bit number too.
MOST = 2**63 - 1


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Integer inner products of whole-numbered matrices, as int64; beyond it the largest or smallest of them."""
    bound = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * queries.shape[1]
    if bound < EXACT:
        return (queries @ shard.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(queries) @ whole(shard).T
    return np.clip(exact, -MOST, MOST).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def exact_top_k(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
                scale: int = 1024) -> DataFrame:
    """The ``k`` rows with the largest inner product for every query row, itself left out.

    Components become ``floor(scale * x)``, so the scores are whole numbers and exact. ``is_query`` is a condition on
    the column ``id``. Returns ``query_id, rank, vec_id, score``.
    """
    spark = df.sparkSession
    whole = F.transform("vec", lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    vectors = usable_vectors(df, id_col, vec_col).select("id", whole.alias("vec"))
    vectors = materialise(vectors, scratch_path(spark, "topk-vectors"))
    queries = materialise(pack(vectors.where(is_query), QUERY_BLOCK), scratch_path(spark, "topk-queries"))
    shards = materialise(pack(vectors, SHARD), scratch_path(spark, "topk-shards"))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q = unpack(row, "q_")
                ids, x = unpack(row)
                scores = products(q, x)
                found = []
                for i, query in enumerate(q_ids):
                    places = np.flatnonzero(ids != query)
                    places = places[best(scores[i, places], ids[places], k)]
                    found.append((query, row["block"], ids[places], scores[i, places]))
                yield pa.RecordBatch.from_pydict(tile_lists(found))

    schema = "query_id bigint, block bigint, ids array<bigint>, scores array<bigint>"
    lists = tiles(queries, shards).mapInArrow(multiply, schema)
    return merge_top(lists, k, max(1, shards.count()), "topk-lists")
