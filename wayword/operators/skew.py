"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.lookup import lookup

# A side is broadcast only when it was counted and has no more rows than this. It is meant for narrow rows:
# a few numbers each, so at most some tens of megabytes.
BROADCAST_ROWS = 500_000

# Keys that hold more than this share of the rows are spread over several tasks. There can be at most
# 1 / HOT_SHARE of them, which bounds the list that reaches the driver.
HOT_SHARE = 1e-3

# A key with fewer rows than this is never worth spreading.
HOT_ROWS = 10_000


def hot_keys(df: DataFrame, on: Sequence[str]) -> dict[str, int]:
    """Hash of every hot key, with the number of tasks its rows should be spread over.

    A hot key holds more than ``HOT_SHARE`` of the rows and more than ``HOT_ROWS`` of them.
    """
    seen = Observation()
    rows = (
        df.select(F.xxhash64(*on).alias("key_hash"))
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .groupBy("key_hash")
        .count()
        .where(F.col("count") > HOT_ROWS)
        .orderBy(F.desc("count"), "key_hash")
        .limit(math.ceil(1 / HOT_SHARE))
        .collect()
    )
    if not rows:
        return {}
    share = max(seen.get["rows"] * HOT_SHARE, HOT_ROWS)
    return {str(r["key_hash"]): math.ceil(r["count"] / share) for r in rows if r["count"] > share}


def n_salts(on: Sequence[str], hot: Mapping[str, int]) -> Column:
    """Over how many salts the key of a row is spread; the sum over all keys is at most 2 / HOT_SHARE."""
    return F.coalesce(lookup(F.xxhash64(*on).cast("string"), hot, "int"), F.lit(1))


def row_salt(df: DataFrame, salts: Column) -> Column:
    """A salt below ``salts`` that follows from the row and the partition it is in.

    A task that is run again after a lost executor sends each row to the same place, and copies of one row
    from several partitions are spread as well.
    """
    return F.pmod(F.pmod(F.xxhash64(*df.columns), salts) + F.spark_partition_id(), salts).cast("int")


def replicate(df: DataFrame, salts: Column) -> DataFrame:
    """Repeat every row for each salt its key may have."""
    return df.withColumn("_salt", F.explode_outer(F.sequence(F.lit(0), salts - 1)))


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, hot: Mapping[str, int] | None = None
) -> DataFrame:
    """Join in which hot keys of ``left`` are spread and their matches in ``right`` are repeated.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``: the kinds in which a row of ``right`` may
    be seen by several tasks without changing the result.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot do {how!r}")
    hot = hot_keys(left, on) if hot is None else hot
    if not hot:
        return left.join(right, list(on), how)
    salts = n_salts(on, hot)
    salted = left.withColumn("_salt", row_salt(left, salts))
    return salted.join(replicate(right, salts), [*on, "_salt"], how).drop("_salt")


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than so many rows."""
    return df.count() <= rows


def sized_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, rows: int | None = None,
    hot: Mapping[str, int] | None = None,
) -> DataFrame:
    """Broadcast ``right`` when its counted rows allow it, otherwise shuffle both sides.

    ``rows`` is the row count of ``right`` where the caller knows it. A hot key of a shuffled join is split by adaptive
    execution; with ``hot``, the keys known to be hot are salted besides.
    """
    small = rows <= BROADCAST_ROWS if rows is not None else at_most(right, BROADCAST_ROWS)
    if small:
        return left.join(F.broadcast(right), list(on), how)
    if hot:
        return salted_join(left, right, on, how, hot)
    return left.join(right, list(on), how)
